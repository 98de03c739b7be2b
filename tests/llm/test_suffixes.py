"""Repeated byte strings against brute force."""

import random

import numpy as np
import pytest

from geoloom.llm import suffixes
from geoloom.llm.suffixes import common_prefixes, merged_runs, segments_of, suffix_array, without_repeats

SCHEMA = "doc_id bigint, text string, spans string, kept string, _k1 string, anchor string"


def by_definition(texts, length):
    """(bytes, removed runs, kept) of every text."""
    bodies = [(t or "").encode() for t in texts]
    seen = {}
    for i, b in enumerate(bodies):
        for p in range(len(b) - length + 1):
            seen.setdefault(b[p:p + length], []).append((i, p))
    gone = [np.zeros(len(b), bool) for b in bodies]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i][p:p + length] = True
    out = []
    for b, g in zip(bodies, gone, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(int), [0]])))
        out.append((len(b), [(int(a), int(e - a)) for a, e in zip(edges[::2], edges[1::2], strict=True)],
                    bytes(np.frombuffer(b, np.uint8)[~g].tobytes())))
    return out


def check(frame, texts, length):
    rows = without_repeats(frame([(i, t, "s", "k", "1", "a") for i, t in enumerate(texts)], SCHEMA), length=length).collect()
    got = {r["doc_id"]: (r["n_bytes"], [(s["start"], s["length"]) for s in r["spans"]], bytes(r["kept"])) for r in rows}
    assert len(rows) == len(texts)
    want = by_definition(texts, length)
    for i in range(len(texts)):
        assert got[i] == want[i], (i, texts[i][:80] if texts[i] else texts[i], got[i], want[i])


def corpus(rng, n, length):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(length - 3, 4 * length))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            if kind < 0.45:
                parts.append(rng.choice(passages)[rng.randint(0, 3):])
            elif kind < 0.55:
                parts.append(rng.choice(["ab", "x", "abc\n", "\x00", "\x00\x01"]) * rng.randint(1, 2 * length))
            else:
                parts.append("".join(rng.choice("abcdefgh €") for _ in range(rng.randint(0, 2 * length))))
        texts.append("".join(parts))
    return texts


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    rng = random.Random(1)
    for trial in range(200):
        data = bytes(rng.choice([0, 1, 65, 255] if trial % 2 else [65]) for _ in range(rng.randint(0, 60)))
        data = (data[:7] * 20)[:60] if trial % 5 == 0 else data
        monkeypatch.setattr(suffixes, "LANES", rng.choice([1, 3, 4096]))
        order, rank, key = suffix_array(np.frombuffer(data, np.uint8))
        want = sorted(range(len(data)), key=lambda i: data[i:])
        assert order.tolist() == want and all(rank[o] == i for i, o in enumerate(order))
        shared = [0] * min(1, len(data))
        for a, b in zip(want, want[1:], strict=False):
            n = 0
            while n < len(data) - max(a, b) and data[a + n] == data[b + n]:
                n += 1
            shared.append(n)
        assert common_prefixes(order, rank, key, 1000).tolist() == shared


@pytest.mark.parametrize("most,buffer", [(4096, 1 << 19), (5, 64)])
def test_equal_windows_have_equal_anchors_and_segments_cover_all_windows(monkeypatch, most, buffer):
    monkeypatch.setattr(suffixes, "MOST_WINDOWS", most)
    monkeypatch.setattr(suffixes, "BUFFER", buffer)
    texts = [t.encode() for t in corpus(random.Random(2), 40, 30)]
    of, start, windows, anchor, segment, twice = segments_of(texts, 30, 8)
    named, inner, bodies = {}, {}, {}
    for t, s, n, a, h, w in zip(of.tolist(), start.tolist(), windows.tolist(), anchor.tolist(), segment.tolist(), twice.tolist(), strict=True):
        assert bodies.setdefault(h, texts[t][s:s + n + 29]) == texts[t][s:s + n + 29]
        own = [texts[t][p:p + 30] for p in range(s, s + n)]
        assert n <= most and (w or len(set(own)) == n)
        for p, body in enumerate(own):
            assert named.setdefault(body, a) == a
            inner[t, s + p] = True
    assert len(inner) == sum(max(0, len(t) - 29) for t in texts) == windows.sum()


@pytest.mark.parametrize("shard", [1 << 21, 600])
def test_repeats_are_those_of_the_definition(frame, monkeypatch, shard):
    """Small shards split every anchor that has more than 300 bytes, so windows meet across shards."""
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffixes, "RANGE_ROWS", shard)
    rng = random.Random(3)
    texts = corpus(rng, 60, 30)
    texts += [texts[5], texts[5], texts[7] + "é", None, "", "short", "x" * 29, "y" * 30, "z" * 31, "w" * 5000]
    check(frame, texts, 30)


def test_a_passage_of_a_third_of_all_documents(frame, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 4000)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(80))
    texts = [" ".join(word() for _ in range(60)) + (passage if i % 3 == 0 else "") + " ".join(word() for _ in range(60)) for i in range(150)]
    check(frame, texts, 400)


def test_odd_rows_and_an_empty_table(spark, frame):
    rows = [(None, "q" * 450, *"skka"), (None, "q" * 450, *"skka"), (1, None, *"skka"), (1, "é" * 250, *"skka")]
    got = without_repeats(frame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], len(r["kept"]), len(r["spans"])) for r in got) == [
        ("1", 0, 0, 0), ("1", 500, 0, 1), ("None", 450, 0, 1), ("None", 450, 0, 1)]
    assert without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_merged_runs_compare_both_halves():
    def run(*entries):
        return np.array([(d, c, 1, at, at, single) for d, c, at, single in entries], suffixes.RUN)
    found = merged_runs([run((5, 1, 0, True), (7, 1, 1, True)), run((5, 2, 2, True), (9, 3, 3, True)), run((5, 1, 4, False), (9, 4, 5, True))])
    assert found["at"].tolist() == [0]
    assert len(merged_runs([run()])) == 0
    edges = suffixes.edges_of(3).tolist()
    assert suffixes.edges_of(1).tolist() == [] and edges == sorted(edges) and -2 ** 63 < edges[0] < 0 < edges[1] < 2 ** 63

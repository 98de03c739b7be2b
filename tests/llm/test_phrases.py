"""Phrases against counts by definition, the burst trie against a plain dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from geoloom.llm import phrases
from geoloom.llm.phrases import BurstTrie, collocations, words_of

SCHEMA = "doc_id bigint, text string, lang string, phrase string, words string, f string"


def by_definition(docs, least, top):
    total, found = Counter(), {}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f = found.setdefault(lang, Counter())
                    f[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in found.items():
        ranked = []
        longer = [(p, a) for p, a in f.items() if len(p) > 2 and a >= least]
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and 100 * b >= 100 * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in longer):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def corpus(rng, n):
    words = ["The", "of", "é", "\x00", "x y", "thE", " ", "b'"] + [f"w{i}" for i in range(12)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts.append(rng.choice(words) if rng.random() < 0.7 else "new york city of light")
            parts.append(rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ", " ", " "]))
        docs.append(("".join(parts), rng.choice(["en", "en", "de", None])))
    return docs


@pytest.mark.parametrize("size,burst,entries,bits", [(2 << 20, 4096, 600_000, 32), (50, 2, 40, 32), (2 << 20, 4096, 600_000, 1), (50, 2, 40, 0)])
def test_collocations_are_those_of_the_definition(frame, monkeypatch, size, burst, entries, bits):
    """Small limits cut long texts inside pieces, burst containers and spill subtrees many times; small maps let most phrases through."""
    monkeypatch.setattr(phrases, "BITS_EACH", bits)
    monkeypatch.setattr(phrases, "MOST_BITS", phrases.MOST_BITS if bits else 8)
    monkeypatch.setattr(phrases, "SLICE_BYTES", size)
    monkeypatch.setattr(phrases, "MOST_ENTRIES", entries)
    monkeypatch.setattr(phrases, "HELD_HASHES", 4 * entries)
    monkeypatch.setattr(phrases, "RANGE_HASHES", 4 * entries)
    monkeypatch.setattr(BurstTrie.__init__, "__defaults__", (burst, 2))
    docs = corpus(random.Random(5), 120) + [(None, "en"), ("", "fr"), ("one two one two", "fr"), (" .,\n", None)]
    docs += [docs[3]] * 9 + [("hot hot hot. " * 400, "en")]
    rows = collocations(frame([(1, t, g, "p", "w", "f") for t, g in docs], SCHEMA), least=6, top=40).collect()
    assert sorted(tuple(r) for r in rows) == by_definition(docs, 6, 40)
    assert len(rows) > 60


def test_an_empty_table_has_no_phrases(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_words_are_split_as_stated():
    assert [w for w in words_of("A\tb  C.d;\x0be\x1cÉ".encode()) if w] == [b"a", b"b", b"c", b".", b"d", b".", b".", "e\x1cÉ".encode()]


def test_burst_tries_count_like_a_dictionary():
    rng, want, got = random.Random(6), Counter(), Counter()
    trie = BurstTrie(burst=3, depth=2)
    for _ in range(4000):
        first, rest = rng.randrange(5), tuple(rng.randrange(6) for _ in range(3))
        want[first, rest] += 2
        trie.add(first, [np.array(rest, "<i4").tobytes()], [2])
        if trie.entries > 300:
            before = trie.entries
            for f, rests, counts in trie.spill(150):
                for r, n in zip(rests, counts, strict=True):
                    got[f, tuple(np.frombuffer(r, "<i4").tolist())] += n
            assert trie.entries <= 150 < before
    for f, rests, counts in trie.spill(0):
        for r, n in zip(rests, counts, strict=True):
            got[f, tuple(np.frombuffer(r, "<i4").tolist())] += n
    assert got == want and trie.entries == 0


def test_equal_codes_do_not_add_up_different_phrases():
    rows = np.array([[1, 2], [3, 4], [1, 2], [3, 4], [3, 4]], np.int32)
    found, counts = phrases._grouped(rows, np.zeros(5, np.uint64))
    assert sorted(zip(map(tuple, found.tolist()), counts.tolist())) == [((1, 2), 2), ((3, 4), 3)]


def test_runs_of_hashes_are_restored():
    rng = np.random.default_rng(15)
    for values in ([], [0], [5], [2**32 - 1, 2**32, 2**48 - 1], rng.integers(0, 2**48, 5000), rng.integers(0, 2**33, 50)):
        h = np.unique(np.array(values, np.uint64))
        assert (phrases._unpacked(phrases._packed(h)) == h).all()

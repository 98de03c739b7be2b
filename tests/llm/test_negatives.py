"""Hard negatives against all pairs, bounds against true scores."""

import math

import numpy as np
import pytest

from geoloom.llm import negatives
from geoloom.llm.negatives import Block, _pack, hard_negatives, overlap, window
from tests.test_repeated import sent_after_repeating

SCHEMA = "vec_id bigint, embedding array<double>, label int, row string, id string, q string"


def by_definition(rows, low=30, high=90, k=5, m=10):
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 2 ** 63 * (1 - 1e-9):
            kept.append((i, q, label))
    out = []
    for a, (i, q, label) in enumerate(kept):
        if i % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(q, p, strict=True)), j, n, other == label)
                  for n, (j, p, other) in enumerate(kept) if n != a and len(p) == len(q)]
        for s, j, _, _ in sorted(x for x in scores if x[3])[:k]:
            fit = sorted(x for x in scores if not x[3] and low * -s <= 100 * -x[0] <= high * -s)[:m]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (t, n, _, _) in enumerate(fit)]
    return sorted(out)


def check(frame, rows):
    got = hard_negatives(frame([(i, v, label, "r", "i", "q") for i, v, label in rows], SCHEMA)).collect()
    want = by_definition(rows)
    assert sorted(tuple(r) for r in got) == want
    return want


def vectors(rng, n, dim, spread):
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] + spread * rng.normal(size=dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("spread,block,anchors,references", [(0.3, 1024, 1024, 16), (0.3, 40, 3, 4), (3.0, 64, 2, 1), (0.01, 30, 4, 16)])
def test_negatives_are_those_of_all_pairs(frame, monkeypatch, spread, block, anchors, references):
    for name, value in (("BLOCK", block), ("ANCHORS", anchors), ("REFERENCES", references), ("HELD", 20 * block)):
        monkeypatch.setattr(negatives, name, value)
    monkeypatch.setattr(negatives.choose_references, "__defaults__", (references,))
    assert check(frame, vectors(np.random.default_rng(7), 900, 12, spread))


def test_odd_rows(frame):
    rng = np.random.default_rng(8)
    rows = vectors(rng, 150, 4, 0.5)
    rows += [(None, [1.0] * 4, 1), (200, None, 1), (201, [1.0] * 4, None), (300, [1.0, None, 1.0, 1.0], 2), (301, [float("nan")] * 4, 1),
             (302, [float("inf")] * 4, 1), (400, [1e300] * 4, 1), (500, [], 1), (501, [], 1), (502, [], 2), (600, [0.0] * 4, 1), (601, [0.0] * 4, 1),
             (602, [0.0] * 4, 3), (700, [1.0, 2.0], 1), (701, [1.0, 2.0], 1), (702, [0.5, 1.0], 2), (-100, [0.5] * 4, 1), (800, [-3.0] * 4, 1),
             (900, [5e6] * 4, 1), (901, [5.000001e6] * 4, 1), (902, [2e6] * 4, 2), (903, [1e7, -1e7, 3e6, 1e6], 2)]
    rows += [rows[0], rows[0], rows[100], rows[101]]  # repeated rows, anchors among them
    assert check(frame, rows)


def test_ties_go_to_smaller_ids(frame):
    rows = [(i, [1.0, 1.0], 1) for i in range(0, 90)] + [(i, [0.5, 0.5], 2) for i in range(190, 80, -1)]
    want = check(frame, rows)
    assert [w[1] for w in want[::10]] == [1, 2, 3, 4, 5] and [w[3] for w in want[:10]] == list(range(81, 91))


def test_an_empty_table_has_no_negatives(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bounds_never_leave_out_a_score():
    rng = np.random.default_rng(9)
    skipped = 0
    for trial in range(300):
        dim = int(rng.integers(1, 6))
        make = lambda n: np.floor(256 * (rng.normal(size=dim) * rng.choice([0, 1, 5]) + rng.normal(size=(n, dim)) * rng.choice([1e-3, 0.3, 2])))
        references = negatives.choose_references(make(8), 4)
        def rows(q):
            norm = np.sqrt((q ** 2).sum(axis=1))
            angles = negatives._angles(q, norm, references).astype("<f4")
            cell = int(angles[0].argmin())
            order = np.argsort(angles[:, cell])
            return cell, [{"id": int(i), "label": 0, "norm": float(norm[i]), "q": q[i].astype("<i8").tobytes(), "angles": angles[i].tobytes()} for i in order]
        cell, packed = rows(make(20))
        row = _pack(1, dim, cell, packed)
        block = Block(row)
        _, others = rows(make(3))
        around = _pack(2, dim, 0, others)
        alphas = [np.frombuffer(a["angles"], "<f4").astype(float) for a in others]
        scores = [block.q @ np.frombuffer(a["q"], "<i8") for a in others]
        low, high = sorted(rng.choice(np.concatenate(scores), 2).tolist())
        bounds = np.concatenate([np.frombuffer(around["bounds"], "<f8"), [low, high]])
        if any(((s >= low) & (s <= high)).any() for s in scores):
            assert overlap(bounds, np.frombuffer(row["bounds"], "<f8"))
        for a, alpha, score in zip(others, alphas, scores, strict=True):
            anchor = {"norm": a["norm"], "alpha": alpha, "q": np.frombuffer(a["q"], "<i8")}
            first, last = window(anchor, low, high, block)
            inside = np.flatnonzero((score >= low) & (score <= high))
            assert all(first <= i < last for i in inside), trial
            at, _ = negatives.scored(anchor, low, high, block, np.ones(20, bool))
            assert set(inside) <= set(at.tolist())
            skipped += 20 - len(at)
    assert skipped > 3000


def test_the_first_of_every_key():
    found = [(1, 5, 9, 100), (1, 4, 8, 100), (2, 1, 1, 7), (1, 6, 3, 200), (1, 4, 7, 100)]
    assert negatives.leading(found, 2) == [(1, 6, 3, 200), (1, 4, 7, 100), (2, 1, 1, 7)]
    two = [(1, 1, 3, 3, 5), (1, 2, 3, 3, 4), (1, 1, 2, 2, 5)]
    assert negatives.leading(two, 1) == [(1, 1, 2, 2, 5), (1, 2, 3, 3, 4)]


def test_anchors_are_not_sent_through_the_driver(spark, monkeypatch):
    """Groups of anchors are not gathered into one row, repeated per block and broadcast."""
    for name, value in (("BLOCK", 30), ("ANCHORS", 4)):
        monkeypatch.setattr(negatives, name, value)
    plans, write = [], negatives.materialise

    def kept(df):
        plans.extend(sent_after_repeating(df, "collect_list"))
        return write(df)
    monkeypatch.setattr(negatives, "materialise", kept)
    rows = vectors(np.random.default_rng(10), 900, 8, 0.5)
    got = hard_negatives(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert sorted(map(tuple, got.collect())) == by_definition(rows)
    assert not plans

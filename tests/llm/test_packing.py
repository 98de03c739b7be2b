"""Best-two-fit packing against a piece-by-piece version, and the packed table."""

import random

import public_tokenizers

from geoloom.llm.packing import pack_documents, place_rows, plan_best_two_fit

FILE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, sequence_id string, _block string"


def one_by_one(sizes, capacity):
    """Bins of the same rule, taking single pieces from a list."""
    left, bins = sorted(sizes, reverse=True), []
    while left:
        held, i = [], 0
        while i < len(left):
            if sum(held) + left[i] <= capacity:
                held.append(left.pop(i))
            else:
                i += 1
        gap = capacity - sum(held)
        if gap and len(held) > 1:
            small = min(held)
            pairs = [(left[a] + left[b], a, b) for a in range(len(left)) for b in range(a + 1, len(left)) if left[a] + left[b] <= gap + small]
            best = max(pairs, default=(0, 0, 0))
            if best[0] > small:
                held.remove(small)
                held += [left[best[1]], left[best[2]]]
                for k in sorted(best[1:], reverse=True):
                    left.pop(k)
                left = sorted([*left, small], reverse=True)
        bins.append(sorted(held))
    return bins


def test_repeated_patterns_equal_packing_one_by_one():
    rng = random.Random(4)
    for _ in range(150):
        capacity = rng.choice([10, 30, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        plan = plan_best_two_fit({n: sizes.count(n) for n in set(sizes)}, capacity)
        bins = [sorted(n for n, c in used.items() for _ in range(c)) for times, used in plan for _ in range(times)]
        assert sorted(x for b in bins for x in b) == sorted(sizes)
        assert all(sum(b) <= capacity for b in bins)
        assert len(bins) == len(one_by_one(sizes, capacity))


def test_plan_does_not_grow_with_the_pieces():
    counts = {n: 1 + n * 37 % 101 for n in range(1, 300)}
    small, large = plan_best_two_fit(counts, 299), plan_best_two_fit({n: c * 10**9 for n, c in counts.items()}, 299)
    assert len(large) < 3 * 300 and len(small) < 3 * 300
    assert sum(n * t * c for t, used in large for n, c in used.items()) == sum(n * c for n, c in counts.items()) * 10**9
    assert len(list(place_rows(large))) < 3 * 3 * 300


def test_odd_rows_are_packed_gapless(spark, frame):
    long = "word " * 5000
    rows = [(1, "a b c", "x", "y"), (1, "a b c", "x", "y"), (None, None, "x", "y"), (3, "", None, None), (4, long, "z", "z"), (5, None, "", "")]
    got = pack_documents(frame(rows, SCHEMA), FILE, capacity=64, with_ids=True).collect()
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64
    whole = {}
    for r in sorted(got, key=lambda r: (str(r["doc_id"]), r["piece"])):
        assert len(r["ids"]) == r["length"] and r["start"] == 64 * r["piece"]
        whole.setdefault(r["doc_id"], []).extend(r["ids"])
    assert whole[None] == whole[3] == whole[5] == [0] and len(whole[4]) == 5001 and len(whole[1]) == 8
    assert pack_documents(spark.createDataFrame([], SCHEMA), FILE).count() == 0

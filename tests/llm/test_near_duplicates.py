"""SimHash components and vector links against brute force."""

import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from geoloom.llm import blocks, pivots, simhash
from geoloom.llm.simhash import allot, choose_parts, fingerprint, near_duplicates, one_of_each, similar_documents
from geoloom.llm.sketches import shingle_hashes

SCHEMA = "doc_id bigint, text string, fp string, component string, _block string"


def by_definition(text, k=4):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(ids, link):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if link(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(ids))]


def test_fingerprint_is_that_of_the_definition():
    for text in ["", None, " \t\n", "One", "one two THREE", "É a b c d\x0be\x85f", "a b c d " * 500, "x\x1cy z w v u"]:
        assert fingerprint(text) == by_definition(text), text


@pytest.mark.parametrize("block,small", [(4096, 128), (8, 4)])
def test_components_are_those_of_all_pairs(spark, frame, monkeypatch, block, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(40):
        base = rng.choice(vocabulary, 120).tolist()
        for _ in range(rng.integers(1, 12)):
            copy = list(base)
            for _ in range(rng.integers(0, 3)):
                copy[rng.integers(len(copy))] = "other"
            texts.append(" ".join(copy))
    texts += [None, "", " ", "x", "x", "X", "word " * 60_000]
    rows = [(i if i % 9 else None, t, None, "c", "d") for i, t in enumerate(texts)]
    got = near_duplicates(frame(rows, SCHEMA), block=block).collect()
    fps = [by_definition(t) for _, t, *_ in rows]
    wanted = component_ids([r[0] for r in rows], lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    expected = sorted(((r[0], f - (f >> 63 << 64), w) for r, f, w in zip(rows, fps, wanted)), key=str)
    assert sorted((tuple(r) for r in got), key=str) == expected
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_thresholds_are_the_cheapest_that_sum_up():
    rng = np.random.default_rng(2)
    costs = np.sort(rng.random((4, 3)), axis=1).tolist()
    import itertools

    best = min((sum(0 if t < 0 else costs[i][t] for i, t in enumerate(ts)), ts) for ts in itertools.product(range(-1, 3), repeat=4) if sum(ts) == 1)
    assert np.isclose(allot(costs, 1)[0], best[0])


@pytest.mark.parametrize("n", [1e3, 1e6, 1e9])
def test_every_pair_within_the_radius_meets(n):
    rng = np.random.default_rng(5)
    fp = rng.integers(-2**63, 2**63 - 1, 500)
    bits = simhash._bits(fp)
    products = np.vstack([bits.T @ bits, np.zeros(64)]) * (n / len(fp))
    products[64, 0] = n
    parts = choose_parts(products, fp, 4)
    for x in fp[:100].view(np.uint64):
        flips = rng.choice(64, 4, replace=False)
        y = x ^ np.uint64(sum(1 << int(f) for f in flips))
        keys = [(simhash._key(np.array([v]), p)[0], t) for p, t in parts for v in (x, y)]
        assert any(int(a[0] ^ b[0]).bit_count() <= a[1] for a, b in zip(keys[::2], keys[1::2]))


def test_similar_documents_and_one_of_each(frame, spark):
    rng = np.random.default_rng(3)
    rows, group = [], 0
    for _ in range(60):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for k in range(4):
            copy = list(base)
            if k:  # one edit in about 75 words: a similarity near 0.88
                for at in range(int(rng.integers(0, 75)), 300, 75):
                    copy[at] = f"e{rng.integers(1000)}"
            rows.append((len(rows), " ".join(copy), "x", str(group), "z"))
        group += 1
    line = "the very same line stands in many documents of this table"
    rows += [(len(rows) + i, " ".join([line] * 12 + [f"u{x}" for x in rng.integers(0, 10**6, 150)]), "x", f"alone{i}", "z") for i in range(30)]
    rows += [(None, "", "x", "empty", "z"), (9000, None, "x", "empty", "z"), (9001, "one", "x", "one", "z"), (9001, "one", "x", "one", "z")]
    from geoloom.operators.checkpoints import materialise

    docs = materialise(frame(rows, SCHEMA))
    sets = {r[0]: set(shingle_hashes(r[1] or "").tolist()) for r in rows if r[0] is not None and r[0] < 240}
    comp = {r["doc_id"]: r["component"] for r in similar_documents(docs).collect()}
    close = [(a, b) for a in sets for b in sets if a < b and a // 4 == b // 4 and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    assert len(close) > 100 and np.mean([comp[a] == comp[b] for a, b in close]) >= 0.98
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    groups = [r["component"] for r in kept.collect()]
    assert len(set(groups)) == len({r[3] for r in rows}) and len(groups) <= len(set(groups)) + 3
    assert [r["doc_id"] for r in kept.filter("component IN ('empty', 'one')").orderBy("doc_id").collect()] == [9000, 9001]
    assert one_of_each(materialise(spark.createDataFrame([], SCHEMA))).count() == 0


@pytest.mark.parametrize("block,most", [(512, 16 << 20), (40, 30_000)])
def test_no_pair_below_the_similarity_is_linked(frame, monkeypatch, block, most):
    monkeypatch.setattr(simhash, "TEXT_BYTES", most)
    from geoloom.operators.checkpoints import materialise

    rng = np.random.default_rng(10)
    rows, similar = [], []
    for pair in range(600):  # a run of new words at the end leaves a similarity of (n - k) / (n + k)
        base, k = [f"p{pair}w{x}" for x in range(304)], int(rng.integers(30, 54))
        rows += [(2 * pair, " ".join(base), "x", "c", "z"), (2 * pair + 1, " ".join(base[:-k] + [f"q{pair}w{x}" for x in range(k)]), "x", "c", "z")]
        similar.append((300 - k) / (300 + k))
    # Near copies that are over 0.8 to one text and share one component, and documents of one template at 0.7.
    base = [f"b{x}" for x in range(304)]
    rows += [(2000 + i, " ".join(base[:-20] + [f"n{i}w{x}" for x in range(20)]), "x", "c", "z") for i in range(100)]
    base = [f"t{x}" for x in range(304)]
    rows += [(3000 + i, " ".join(base[:-53] + [f"m{i}w{x}" for x in range(53)]), "x", "c", "z") for i in range(100)]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(materialise(frame(rows, SCHEMA)), text_block=block).collect()}
    together = np.array([got[2 * i] == got[2 * i + 1] for i in range(600)])
    above = np.array(similar) >= 0.8
    assert above.sum() > 50 and (~above).sum() > 300
    assert together[above].mean() >= 0.95 and not together[~above].any()
    assert {got[2000 + i] for i in range(100)} == {2000}
    assert all(got[3000 + i] == 3000 + i for i in range(100))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_short_texts_miss_no_link(frame):
    """Every pair of short texts at 0.8 or more, from one word on, whatever the size of the group it meets in."""
    from geoloom.operators.checkpoints import materialise

    rng = np.random.default_rng(11)
    texts = ["one", "one", "two", "", None, "a b c d", "a b c d"]
    for pair in range(700):
        n = int(rng.integers(5, 70))
        base = [f"p{pair}w{x}" for x in range(n)]
        copy = base[:-1] if n < 30 else [*base[:-int(rng.integers(1, 7))], f"q{pair}"]
        texts += [" ".join(base), " ".join(copy)]
    hub = [f"h{x}" for x in range(8)]  # nine words and eight of them, in groups of many
    texts += [" ".join([*hub, f"t{i}"]) for i in range(200)] + [" ".join(hub)]
    rows = [(i, t, "x", "c", "z") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(materialise(frame(rows, SCHEMA))).collect()}
    sets = [set(shingle_hashes(t or "").tolist()) for t in texts]
    holders = {}
    for i, x in enumerate(sets):
        for h in x or {None}:
            holders.setdefault(h, []).append(i)
    near = {(i, j) for held in holders.values() for i in held for j in held if i < j and jaccard(sets[i], sets[j]) >= 0.8}
    wanted = component_ids(list(range(len(texts))), lambda i, j: (j, i) in near)
    assert len(near) > 600 and [got[i] for i in range(len(texts))] == wanted


def test_recall_by_length(frame):
    """Isolated pairs just over 0.8, by words of the text; the README gives the shares."""
    from geoloom.operators.checkpoints import materialise

    rows, lengths = [], [9, 24, 60, 100, 160, 300, 1000]
    for k, n in enumerate(lengths):
        for pair in range(120):
            base = [f"p{k}x{pair}w{x}" for x in range(n)]
            cut = int((n - 4) / 9)  # new words at the end: (n - 4 - cut) / (n - 4 + cut) is 0.8
            cut = cut if (n - 4 - cut) / (n - 4 + cut) >= 0.8 else cut - 1
            copy = base[:n - cut] + [f"q{pair}w{x}" for x in range(cut)] if cut else base[:-1]
            rows += [(len(rows), " ".join(base), "x", "c", "z"), (len(rows) + 1, " ".join(copy), "x", "c", "z")]
    got = {r["doc_id"]: r["component_id"] for r in similar_documents(materialise(frame(rows, SCHEMA))).collect()}
    found = np.array([got[i] == got[i + 1] for i in range(0, len(rows), 2)]).reshape(len(lengths), -1).mean(axis=1)
    print(dict(zip(lengths, found.round(3).tolist())))
    assert (found[:3] == 1).all() and found.min() >= 0.95


def test_columns_of_any_name_are_kept(frame):
    from geoloom.operators.checkpoints import materialise

    docs = materialise(frame([(1, "a b c d e f", "kept"), (2, "a b c d e f", "gone"), (3, "other", "too")], "doc_id bigint, text string, _near_key string"))
    kept = one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["_near_key"] for r in kept.collect()) == ["kept", "too"]


VECTORS = "vec_id bigint, embedding array<float>, n string, cid string"


def brute(rows):
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v /= np.abs(v).max()
        return v / np.sqrt(v @ v)
    units = [unit(np.array(r[1], np.float32).tolist() if r[1] and None not in r[1] else r[1]) for r in rows]

    def link(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and len(a) == len(b) and a @ b >= 0.9
    n = [sum(link(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return n, component_ids([r[0] for r in rows], link), units


@pytest.mark.parametrize("block,small", [(1024, 128), (6, 3)])
def test_vector_links_are_those_of_all_pairs(spark, frame, monkeypatch, block, small):
    monkeypatch.setattr(pivots, "SMALL", small)
    rng = np.random.default_rng(4)
    rows = []
    for c in rng.normal(size=(60, 24)):
        for _ in range(rng.integers(1, 10)):
            rows.append(c + rng.normal(size=24) * 0.12)
    rows += [rows[0]] * 30 + list(rng.normal(size=(5, 7)))
    rows = [(i, [float(np.float32(x)) for x in v], "n", "c") for i, v in enumerate(rows)]
    k = len(rows)
    rows += [(k, None, "", ""), (k + 1, [], "", ""), (k + 2, [0.0] * 24, "", ""), (k + 3, [None] + [1.0] * 23, "", ""), (k + 4, [float("nan")] * 24, "", ""),
             (k + 5, [float("inf")] + [1.0] * 23, "", ""), (k + 6, [3e38] * 24, "", ""), (k + 7, [1e-38] * 24, "", ""), (None, rows[0][1], "", "")]
    n, comp, _ = brute(rows)
    got = {r["vec_id"]: r for r in pivots.near_vectors(frame(rows, VECTORS), block=block).collect()}
    assert len(got) == len(rows)
    found, true = sum(got[r[0]]["n_links"] for r in rows), sum(n)
    assert 0.99 * true <= found <= true
    wrong = [r[0] for r, c, m in zip(rows, comp, n) if (got[r[0]]["component_id"], got[r[0]]["n_links"]) != (c if c is not None else r[0], m)]
    assert len(wrong) <= 0.02 * len(rows), wrong
    assert all(got[i]["kept"] and got[i]["n_links"] == 0 for i in range(k, k + 6)) and got[k + 6]["n_links"] == 1
    assert pivots.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0


def test_vectors_of_a_narrow_cone_still_link(frame):
    two = [[1.0, 0.0], [0.95, float(np.sqrt(1 - 0.95**2))]]
    got = pivots.near_vectors(frame([(i, v, "", "") for i, v in enumerate(two)], VECTORS)).collect()
    assert [(r["n_links"], r["component_id"]) for r in got] == [(1, 0)] * 2
    rng = np.random.default_rng(8)
    cone = np.eye(24)[0] + rng.normal(size=(300, 24)) * 0.07  # cosines of pairs from 0.8 to 0.95
    rows = [(i, [float(np.float32(x)) for x in v], "", "") for i, v in enumerate(cone)]
    n, comp, _ = brute(rows)
    assert 0 < sum(n) < 300 * 299
    got = {r["vec_id"]: r for r in pivots.near_vectors(frame(rows, VECTORS), block=64).collect()}
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(300)] == list(zip(n, comp))


def test_recall_near_the_threshold(frame):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    cos = rng.uniform(0.901, 0.93, 1500)[:, None]
    both = np.vstack([base, cos * base + np.sqrt(1 - cos**2) * away])
    got = pivots.near_vectors(frame([(i, v.tolist(), "", "") for i, v in enumerate(both)], VECTORS)).filter("n_links > 0").count()
    assert got >= 0.97 * 3000


@pytest.mark.parametrize("many,least", [(1000, 0.97), (4096, 0.95)])
def test_recall_holds_with_many_pivots(spark, many, least):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(1000, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    cos = rng.uniform(0.901, 0.93, 1000)[:, None]
    # Most pivots are drawn from the others, as in a large table.
    every = np.vstack([base, cos * base + np.sqrt(1 - cos**2) * away, rng.normal(size=(5 * many, 64))])
    rows = spark.createDataFrame(pa.table({"vec_id": np.arange(len(every)), "embedding": list(every)})).repartition(4)
    got = pivots.near_vectors(rows, pivots=many).filter("n_links > 0").count()
    print("recall", many, got / 2000)
    assert got >= least * 2000


def test_blocks_meet_once(spark, frame):
    from geoloom.operators.checkpoints import materialise

    rows = materialise(frame([("a", i) for i in range(50)] + [("b", 1)], "key string, id bigint"))
    dealt = blocks.deal_blocks(rows, ["key"], "id", 8).collect()
    groups = {}
    for r in dealt:
        groups.setdefault((r["key"], r["_low"], r["_high"]), []).append((r["id"], r["_own"]))
    met = [tuple(sorted((x[0], y[0]))) for (k, low, high), g in groups.items() for i, x in enumerate(g) for y in g[:i] if low == high or x[1] != y[1]]
    assert sorted(met) == [(a, b) for a in range(50) for b in range(a + 1, 50)]
    assert max(map(len, groups.values())) < 50


@pytest.mark.parametrize("rows,lanes,most", [(3000, 4, 56), (6, 4, 56), (3000, 2, 30), (400, 1, 4)])
def test_unlike_fingerprints_are_not_gathered(rows, lanes, most):
    """Links of one key are those of all pairs, and pairs of unlike fingerprints are told apart without listing them."""
    import tracemalloc
    rng = np.random.default_rng(rows + lanes)
    fp = rng.integers(0, 2**64, (rows, lanes), dtype=np.uint64)
    fp[rows // 2] = fp[1] ^ np.uint64(0b111)
    fp[rows // 3, lanes - 1] = fp[0, lanes - 1]
    probe = rng.random(rows) < 0.3
    probe[[1, rows // 2]] = True, False
    group = [np.full(rows, 5)] * 4
    tracemalloc.start()
    a, b = simhash._edges([*group, np.arange(rows), probe, fp.view(np.int64)], most)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = set()
    for i in range(rows):
        apart = sum(np.bitwise_count(fp[i, k] ^ fp[i + 1:, k]).astype(int) for k in range(lanes))
        want |= {frozenset((i, i + 1 + int(j))) for j in np.flatnonzero((apart <= most) & ~(probe[i] & probe[i + 1:]))}
    assert {frozenset(p) for p in zip(a.tolist(), b.tolist())} == want
    assert frozenset((1, rows // 2)) in want
    assert peak < 15e6

"""SimHash fingerprints and near-duplicate components by the general pigeonhole principle.

Fingerprints within ``radius`` bits of each other agree, for some part ``i`` of the 64 bits, within
``t_i`` bits, whenever the thresholds of the ``m`` parts sum to ``radius - m + 1`` (a threshold of
-1 leaves a part out). Correlated bits are put into one part, and the thresholds are dealt out by
dynamic programming on the estimated numbers of candidates and of probes per part. Every fingerprint
is listed under its own part values and probes all values within the threshold; what meets is
verified on all 64 bits, so results are exact whatever the estimates say.

Only distinct fingerprints are compared. Rows under one key are cut into blocks of bounded size and
compared block pair by block pair; a task returns links of a spanning forest, never all pairs, and
the links of all tasks become components by star rounds.

Defined results for odd rows: a NULL or blank text has no words and the fingerprint 0, which links
like any other; repeated rows share their component; NULL ids never become a component id unless
the component has no other; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.blocks import SMALL, columns, deal_blocks, forest, new_group, together, whole_groups
from geoloom.llm.sketches import shingle_hashes
from geoloom.operators.checkpoints import materialise
from geoloom.operators.components import connected_components

BITS = 64
SEED = 42
#: Fingerprints of one key compared in one task at most, twice.
BLOCK = 4096
#: Texts of one component compared by their shingles in one task at most, twice, and their bytes (a longer text comes alone).
TEXT_BLOCK, TEXT_BYTES = 512, 16 << 20
#: Sets of so many shingles also meet by their rarest shingles: their few shingles make bits too noisy.
SHORT = 80
#: Shingles gathered at once.
GATHERED = 4_000_000
#: Lanes compared for all pairs at once (their bits fit a byte); the others only for pairs these leave.
FIRST_LANES = 3
#: Share of pairs at the limit of similarity that may meet in no part of any lane.
MISSED = 0.02
#: Fingerprints drawn for the estimates of candidate counts; results do not depend on it.
SAMPLED = 2048
#: Relative costs of moving one probe and of comparing one candidate.
PROBE_COST, COMPARE_COST = 1000.0, 1.0


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """SimHash of a whole text over its word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_per_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    counts = np.zeros(BITS, np.int64)
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 50_000):
        to = min(n, at + 50_000)
        spans = zip(starts[at:to].tolist(), ends[at + k - 1:to + k - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def wide_fingerprint(hashes: np.ndarray, lanes: int) -> list[int]:
    """SimHash of ``lanes`` times 64 bits over distinct shingle hashes, mixed anew for every lane."""
    out = []
    for lane in range(lanes):
        counts = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), 50_000):
            h = (hashes[at:at + 50_000] + np.uint64(lane + 1)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            counts += np.unpackbits(h.view(np.uint8)).reshape(-1, BITS).sum(0, dtype=np.int32)
        out.append(int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big"))
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 4, lanes: int = 0,
                 key: str | None = None) -> DataFrame:
    """``doc_id, fp[, set_key, few][, key]`` of every document; ``fp`` is an array of signed longs, 64 bits each.

    Without ``lanes`` it has one, of XXH64 over lower-cased text; with them it has so many, of a mixed hash over the distinct
    shingles of the text as it is, so that repeated lines do not make texts alike; ``set_key`` is equal for equal sets of shingles and ``few``
    are the shingle hashes of sets of at most ``SHORT``.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            found, sets, few = [], [], []
            for t in texts:
                if lanes:
                    hashes = np.unique(shingle_hashes(t or "", words_per_shingle))
                    found.append(wide_fingerprint(hashes, lanes))
                    sets.append(xxhash.xxh3_128_hexdigest(hashes.tobytes()))
                    few.append(hashes.view(np.int64) if len(hashes) <= SHORT else None)
                else:
                    found.append([fingerprint(t, words_per_shingle)])
            fp = np.array(found, np.uint64).reshape(len(texts), -1).view(np.int64)
            some = [pa.array(sets, pa.string()), pa.array(few, pa.list_(pa.int64()))] if lanes else []
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(fp), pa.list_(pa.int64())), *some, *b.columns[2:]],
                                             names=["doc_id", "fp", *(["set_key", "few"] if lanes else []), *b.schema.names[2:]])

    kind = docs.schema[doc_id].dataType.simpleString()
    keys = [F.col(key)] if key else []
    return docs.select(F.col(doc_id), F.col(text), *keys).mapInArrow(
        each, f"doc_id {kind}, fp array<bigint>" + (", set_key string, few array<bigint>" if lanes else "") + (f", {key} {docs.schema[key].dataType.simpleString()}" if key else ""))


# ---- parts and thresholds -------------------------------------------------------------------------------------


def bit_products(classes: DataFrame, lane: int = 0) -> np.ndarray:
    """How often two bits of a lane are both set, over all distinct fingerprints; row 64 has the number of fingerprints."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        rows = 0
        for b in batches:
            bits = _bits(b.column(0).to_numpy())
            total += bits.T @ bits
            rows += len(bits)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, BITS), pa.int32()), pa.array(np.append(j, 0), pa.int32()),
                                          pa.array(np.append(total.ravel(), rows))], names=["i", "j", "n"])

    sums = classes.select(F.col("fp")[lane]).mapInArrow(each, "i int, j int, n double").groupBy("i", "j").agg(F.sum("n").alias("n"))
    out = np.zeros((BITS + 1, BITS))
    for i, j, n in sums.collect():  # 64 x 64 sums
        out[i, j] = n
    return out


def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint64).astype(">u8").view(np.uint8)).reshape(-1, BITS).astype(np.float64)


def correlations(products: np.ndarray) -> np.ndarray:
    n = max(products[BITS, 0], 1.0)
    mean = products[:BITS].diagonal() / n
    cov = products[:BITS] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(cov.diagonal(), 1e-12))
    return np.abs(cov / np.outer(scale, scale))


def group_bits(corr: np.ndarray, m: int) -> list[list[int]]:
    """``m`` parts of nearly equal width; each grows by the free bit most correlated with it."""
    free, parts = set(range(BITS)), []
    for k in range(m):
        width = len(free) // (m - k)
        left = sorted(free)
        inner = corr[np.ix_(left, left)] - np.eye(len(left))
        part = [left[int(inner.sum(1).argmax())]]
        free.discard(part[0])
        while len(part) < width:
            best = max(sorted(free), key=lambda b: corr[b, part].sum())
            part.append(best)
            free.discard(best)
        parts.append(sorted(part))
    return parts


def near_share(sample: np.ndarray, part: list[int], most: int) -> list[float]:
    """Estimated share of pairs within 0..``most`` bits on a part: from sampled pairs, at least that of even bits."""
    values = _key(sample, part)
    seen = np.zeros(most + 1)
    for at in range(0, len(values), 256):
        apart = np.bitwise_count(values[at:at + 256, None] ^ values[None, :])
        seen += [(apart <= t).sum() for t in range(most + 1)]
    pairs = max(1, len(values) * (len(values) - 1))
    even = np.cumsum([math.comb(len(part), t) / 2.0 ** len(part) for t in range(most + 1)])
    return np.maximum((seen - len(values)) / pairs, even).tolist()


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds of least cost summing to ``total``; ``costs[i][t]`` is that of threshold ``t`` in part ``i``, -1 is free."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for at, (spent, chosen) in best.items():
            for t, c in enumerate([0.0, *cost], -1):
                if at + t not in step or spent + c < step[at + t][0]:
                    step[at + t] = (spent + c, [*chosen, t])
        best = step
    return best[total]


def choose_parts(products: np.ndarray, sample: np.ndarray, radius: int) -> list[tuple[list[int], int]]:
    """``(bits, threshold)`` of every part that is used, for the number of parts of least estimated cost."""
    n, corr, found = products[BITS, 0], correlations(products), None
    for m in range(2, radius + 2):
        parts = group_bits(corr, m)
        costs = []
        for part in parts:
            shares = near_share(sample, part, radius)
            probes = np.cumsum([math.comb(len(part), t) for t in range(radius + 1)])
            costs.append([n * float(p) * PROBE_COST + n * n * s * COMPARE_COST for p, s in zip(probes, shares, strict=True)])
        cost, chosen = allot(costs, radius - m + 1)
        if found is None or cost < found[0]:
            found = (cost, [(p, t) for p, t in zip(parts, chosen, strict=True) if t >= 0])
    return found[1]


def missed(parts: list[tuple[list[int], int]], flip: float) -> float:
    """Chance that two fingerprints meet in no part, if each bit differs by itself with chance ``flip``."""
    return math.prod(1 - sum(math.comb(len(p), k) * flip**k * (1 - flip) ** (len(p) - k) for k in range(t + 1)) for p, t in parts)


def _key(fp: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of a part (0 is the highest of the 64), packed."""
    fp = fp.view(np.uint64)
    out = np.zeros(len(fp), np.uint64)
    for at, bit in enumerate(part):
        out |= ((fp >> np.uint64(BITS - 1 - bit)) & np.uint64(1)) << np.uint64(at)
    return out


def signatures(classes: DataFrame, lanes: list[list[tuple[list[int], int]]]) -> DataFrame:
    """``part, key, cid, probe, fp``: every fingerprint under its own values of all parts of all lanes, and as a probe under all values within the threshold."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            fp = columns(b, ["fp"])[0]
            part_number = itertools.count()
            for lane, parts in enumerate(lanes):
                for part, threshold in parts:
                    i, key = next(part_number), _key(np.ascontiguousarray(fp[:, lane]), part)
                    for t in range(threshold + 1):
                        for flipped in itertools.combinations(range(len(part)), t):
                            mask = np.uint64(sum(1 << f for f in flipped))
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(fp), i, np.int32)), pa.array((key ^ mask).view(np.int64)), b.column("cid"),
                                 pa.array(np.full(len(fp), t > 0)), b.column("fp")], names=["part", "key", "cid", "probe", "fp"])

    return classes.select("cid", "fp").mapInArrow(each, "part int, key bigint, cid bigint, probe boolean, fp array<bigint>")


# ---- comparing ------------------------------------------------------------------------------------------------


def links(signature_rows: DataFrame, most: int, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` (class ids) that span what meets under a key and differs in ``most`` bits or fewer. ``signature_rows`` is a written table."""
    group = ["part", "key", "_low", "_high"]
    dealt = together(deal_blocks(signature_rows, ["part", "key"], "cid", block), group)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, [*group, "cid", "probe", "fp"], len(group)):
            a, b = _edges(rows, most)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(each, "a bigint, b bigint")


def _apart(lanes: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Differing bits of the first ``FIRST_LANES`` lanes. Of unlike pairs half of the bits differ: with the limit for four lanes one lane leaves nearly all
    of them to be gathered and tested one by one, three leave hardly any."""
    apart = np.bitwise_count(lanes[0][0] ^ lanes[0][1])
    for a, b in lanes[1:FIRST_LANES]:
        apart += np.bitwise_count(a ^ b)
    return apart


def _edges(rows: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links (class, smallest class of its component) of all verified links within the groups of ``rows``."""
    cid, probe, fp = rows[4], rows[5].astype(bool), [np.ascontiguousarray(lane) for lane in rows[6].view(np.uint64).T]
    group = np.cumsum(new_group(rows[:4])) - 1
    sizes = np.bincount(group)
    found_a, found_b = [cid[:0]], [cid[:0]]

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        u, v = forest(cid[a], cid[b])
        found_a.append(u)
        found_b.append(v)

    at = np.flatnonzero(sizes[group] <= SMALL)
    g, p = group[at], probe[at]
    small = [lane[at] for lane in fp]
    for d in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        near = np.flatnonzero((_apart([(x[:-d], x[d:]) for x in small]) <= most) & (g[:-d] == g[d:]) & ~(p[:-d] & p[d:]))
        near = near[sum(np.bitwise_count(x[near] ^ x[near + d]).astype(np.int16) for x in small) <= most]
        keep(at[near], at[near + d])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for k in np.flatnonzero(sizes > SMALL):
        end = starts[k + 1]
        for s in range(starts[k], end, 64):
            t = min(s + 64, end)
            i, j = np.nonzero(_apart([(x[s:t, None], x[None, s:end]) for x in fp]) <= most)
            i, j = i[i < j] + s, j[i < j] + s
            ok = ~(probe[i] & probe[j])
            i, j = i[ok], j[ok]
            ok = sum(np.bitwise_count(x[i] ^ x[j]).astype(np.int16) for x in fp) <= most
            keep(i[ok], j[ok])
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def components(prints: DataFrame, most: int, radius: int, lanes: int = 1, block: int = BLOCK, flip: float | None = None,
               similarity: float | None = None) -> DataFrame:
    """``fp, component, component_id``: the component of every distinct fingerprint of the written table ``prints``, and its smallest document id.

    With ``flip`` the radius of a lane grows until all lanes together miss at most ``MISSED`` of the pairs whose bits differ with that chance; with
    ``similarity``, sets of few shingles are joined to all they may reach it with.
    """
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")).withColumn("cid", F.monotonically_increasing_id()))
    parts = []
    for lane in range(lanes):
        products = bit_products(classes, lane)
        share = min(1.0, 2.0 * SAMPLED / max(products[BITS, 0], 1.0))
        drawn = classes.filter(F.pmod(F.xxhash64("fp"), F.lit(1_000_000_007)) < int(share * 1_000_000_007)).select(F.col("fp")[lane]).limit(SAMPLED)
        sample, reach = np.array([r[0] for r in drawn.collect()], np.int64), radius
        chosen = choose_parts(products, sample, reach)
        while flip is not None and missed(chosen, flip) ** lanes > MISSED:
            reach += 1
            chosen = choose_parts(products, sample, reach)
        parts.append(chosen)
    found = links(materialise(signatures(classes, parts)), most, block)
    if similarity is not None:
        found = found.unionByName(rare_links(prints, classes, similarity))
    reached = materialise(connected_components(classes, materialise(found.distinct()), "cid"))
    ids = reached.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return materialise(reached.join(ids, "component").select("fp", "component", "component_id"))


def rare_links(prints: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` (class ids) that join all pairs of sets of few shingles whose similarity may reach the limit, by prefix filtering.

    In an order common to all sets, here the rarest first, two such sets share one of the first ``n - ceil(similarity * n) + 1`` shingles of each.
    The sets that have a shingle there are joined to the first of them, so a list of any length gives one link per set. Sets without shingles are equal.
    """
    sets = materialise(prints.filter("few IS NOT NULL").groupBy("set_key", "fp").agg(F.first("few").alias("few")).join(classes.select("fp", "cid"), "fp").select(
        "cid", "set_key", "few"))
    flat = materialise(sets.select("cid", "set_key", F.explode("few").alias("shingle")))
    often = materialise(flat.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    ranked = flat.join(often, "shingle", "left").groupBy("cid", "set_key").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "shingle"))).alias("all"))
    length = F.size("all") - F.ceil(F.size("all") * F.lit(similarity) - 1e-9).cast("int") + 1
    first = ranked.select("cid", F.explode(F.slice("all", F.lit(1), length)).alias("s")).filter("s.n > 1").select("cid", F.col("s.shingle").alias("shingle"))
    first = materialise(first.distinct())
    heads = materialise(first.groupBy("shingle").agg(F.min("cid").alias("b")))
    return first.join(heads, "shingle").filter("cid <> b").select(F.col("cid").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = 4,
                    words_per_shingle: int = 4, block: int = BLOCK) -> DataFrame:
    """``doc_id, fp, component_id`` of every document; 64-bit fingerprints link at ``radius`` or fewer differing bits, and no link is missed."""
    prints = materialise(fingerprints(docs, doc_id, text, words_per_shingle))
    labels = components(prints, radius, radius, block=block)
    return prints.join(labels, "fp").select("doc_id", F.col("fp")[0].alias("fp"), "component_id")


def bits_at(similarity: float, bits: int) -> float:
    """Expected differing bits of two texts whose shingle sets have this Jaccard similarity."""
    return bits * math.acos(2 * similarity / (1 + similarity)) / math.pi


def _similar_sets(rows: list[np.ndarray], similarity: float, words_per_shingle: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (set, root of its component) that span the pairs of each group whose Jaccard similarity is ``similarity`` or more.

    One exact rule for groups of all sizes: pairs that share none of their rarest shingles (see :func:`rare_links`) cannot reach it, the
    others are compared, unless their sizes rule it out or other links have joined them already.
    """
    edges = np.append(np.flatnonzero(new_group(rows[:3])), len(rows[0]))
    for first, end in itertools.pairwise(edges.tolist()):
        m = end - first
        own, sid = rows[3][first:end], rows[4][first:end]
        cross = rows[1][first] != rows[2][first]
        sets = [np.unique(shingle_hashes(t or "", words_per_shingle)) for t in rows[5][first:end]]
        sizes = np.array([len(x) for x in sets])
        starts = np.cumsum(sizes) - sizes
        names, ids, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(m), sizes)
        by_rarity = np.lexsort((ids, often[ids], owner))
        place = np.arange(len(ids)) - starts[owner]
        prefix = place < (sizes - np.ceil(sizes * similarity - 1e-9) + 1)[owner]
        token, holder = ids[by_rarity][prefix], owner[prefix]
        order = np.argsort(token, kind="stable")
        token, holder = token[order], holder[order]
        # Where each set's rare shingles begin and end in the list of holders.
        own_token = ids[by_rarity][prefix]
        list_begin, list_end = np.searchsorted(token, own_token, side="left"), np.searchsorted(token, own_token, side="right")
        own_begin = np.searchsorted(owner[prefix], np.arange(m + 1))
        mark, root = np.zeros(len(names), bool), np.arange(m)
        for i in range(m - 1):
            a, b = list_begin[own_begin[i]:own_begin[i + 1]], list_end[own_begin[i]:own_begin[i + 1]]
            n = b - a
            held = holder[np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())] if len(n) else np.flatnonzero(sizes == 0)
            j = np.unique(held[held > i])
            near = (root[j] != root[i]) & (np.minimum(sizes[j], sizes[i]) >= similarity * np.maximum(sizes[j], sizes[i]))
            if cross:
                near &= own[j] != own[i]
            j = j[near]
            mark[ids[starts[i]:starts[i] + sizes[i]]] = True
            while len(j):
                if not sizes[i]:
                    root[np.isin(root, root[j])] = root[i]
                    break
                some = j[:max(1, int(np.searchsorted(np.cumsum(sizes[j]), GATHERED)))]
                j, n = j[len(some):], sizes[some]
                begin = np.cumsum(n) - n
                at = np.repeat(starts[some] - begin, n) + np.arange(n.sum())
                common = np.add.reduceat(mark[ids[at]].astype(np.int64), begin)
                joined = some[common / (sizes[i] + n - common) >= similarity]
                if len(joined):
                    root[np.isin(root, root[joined])] = root[i]
                    j = j[root[j] != root[i]]
            mark[ids[starts[i]:starts[i] + sizes[i]]] = False
        other = np.flatnonzero(root != np.arange(m))
        yield sid[other], sid[root[other]]


def _deal_texts(sets: DataFrame, block: int) -> DataFrame:
    """Sets (``_met, sid, _first, bytes``) of components of candidates with two or more, dealt to pairs of blocks as in :func:`deal_blocks`; a block holds
    ``block`` sets or ``TEXT_BYTES`` at most in the mean."""
    crowded = materialise(sets.groupBy("_met").agg(F.count(F.lit(1)).alias("_n"), F.sum("bytes").alias("_bytes")).filter("_n > 1").select(
        "_met", F.greatest(F.ceil(F.col("_n") / block), F.ceil(F.col("_bytes") / TEXT_BYTES)).cast("int").alias("_blocks")))
    own = sets.join(crowded, "_met").withColumn("_own", F.pmod(F.xxhash64("sid"), F.col("_blocks")).cast("int"))
    other = own.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return other.select("_met", "sid", "_first", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"), "_own")


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = 0.8, lanes: int = 4,
                      words_per_shingle: int = 5, radius: int = 6, block: int = BLOCK, key: str | None = None,
                      text_block: int = TEXT_BLOCK) -> DataFrame:
    """``doc_id, component_id, component[, key]``: documents whose Jaccard similarity is ``similarity`` or more are linked.

    Bits only find candidates. 64 are too few for a similarity of 0.8, so fingerprints have ``lanes`` times 64; every lane is
    indexed by the general pigeonhole principle, for ``radius`` or as many bits more as it takes for pairs at the limit to meet
    (``MISSED``), and what meets within three standard deviations above the expected bits is a candidate. Sets of at most ``SHORT`` shingles, whose
    bits are noisy, also meet by their rarest shingles, which misses none. The texts of each component of candidates then come together, large
    components in blocks that meet pair by pair, and link by their shingle sets: no two documents below ``similarity`` are linked, but
    components of links are transitive.

    ``docs`` is a written table, as in :func:`one_of_each`; ``key`` tells its rows apart.
    """
    row = key or fresh_name(docs)
    if key is None:
        docs = docs.withColumn(row, F.monotonically_increasing_id())
    mean = bits_at(similarity, lanes * BITS)
    most = round(mean + 3 * math.sqrt(mean * (1 - mean / (lanes * BITS))))
    prints = materialise(fingerprints(docs, doc_id, text, words_per_shingle, lanes, row))
    met = components(prints, most, radius, lanes, block, mean / (lanes * BITS), similarity).select("fp", F.col("component").alias("_met"))
    sizes = docs.select(F.col(row).alias("_first"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).alias("bytes"))
    sets = prints.groupBy("set_key", "fp").agg(F.min("doc_id").alias("first_id"), F.min(row).alias("_first"))
    sets = materialise(sets.join(met, "fp").join(sizes, "_first").withColumn("sid", F.monotonically_increasing_id()))
    group = ["_met", "_low", "_high"]
    texts = docs.select(F.col(row).alias("_first"), F.col(text).alias("text"))
    dealt = together(_deal_texts(sets, text_block).join(texts, "_first"), group)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, [*group, "_own", "sid", "text"], len(group)):
            for a, b in _similar_sets(rows, similarity, words_per_shingle):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    found = materialise(dealt.select(*group, "_own", "sid", "text").mapInArrow(each, "a bigint, b bigint").distinct())
    reached = materialise(connected_components(sets.select("sid", "set_key", "first_id"), found, "sid"))
    ids = reached.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = materialise(reached.join(ids, "component").select("set_key", "component", "component_id"))
    return prints.join(labels, "set_key").select("doc_id", "component_id", "component", *([key] if key else []))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of every component of :func:`similar_documents`: that of the smallest id, with all columns.

    ``docs`` is a written table, which numbers its rows alike each time it is read.
    """
    key = fresh_name(docs)
    numbered = docs.withColumn(key, F.monotonically_increasing_id())
    groups = similar_documents(numbered, doc_id, text, key=key, **options)
    first = groups.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key)).alias("first"))
    return numbered.join(first.select(F.col("first").getField(key).alias(key)), key, "left_semi").drop(key)


def fresh_name(docs: DataFrame) -> str:
    """A column name that ``docs`` does not have, in any case."""
    name = "_near_key"
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

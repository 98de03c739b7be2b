"""Near-duplicate vectors through a pivot-permutation index.

A bounded sample of vectors serves as pivots. Each distinct vector is described by its ``nearest``
pivots (as a set, without their order) and entered into the inverted list of every pair of them. Two vectors of a list become
candidates if they share at least ``shared`` pivots, in the list of their two lowest shared pivots
only, so every pair is looked at once. Vectors without a candidate leave; the others bring their
components to the lists, and candidates are verified by cosine in double precision. Tasks return
link counts and spanning links per vector, never pairs; long lists are cut into blocks that meet
pair by pair.

Retrieval is approximate, verification exact: no link below the threshold is ever returned. The more
pivots, the longer the permutations, so that recall near the threshold does not fall as the table grows;
the tests measure it with 1,000 and 4,096 pivots.

Defined results for odd rows: vectors that are NULL, empty, zero or hold NULL or non-finite components
link with nothing and are kept; vectors link only with those of the same length; equal vectors are one
class and count each other as links; a row with a NULL id takes part, and its component is the smallest
id that is not NULL; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.blocks import SMALL, deal_blocks, forest, new_group, together, whole_groups
from geoloom.operators.checkpoints import materialise
from geoloom.operators.components import connected_components

#: Nearest pivots of a vector, up to 256 pivots; two more for every fourfold number (see :func:`nearest_of`).
NEAREST, SHARED = 8, 3
#: Pivots: twice the square root of the number of vectors, within these bounds.
FEWEST_PIVOTS, MOST_PIVOTS = 64, 4096
#: Pivots are drawn twice over and taken while their cosine with every earlier one is below this.
PIVOTS_APART = 0.8
BLOCK = 1024


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, padded with zeros to ``width``."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, col] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def vector_classes(rows: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows ``vec_id, k1, k2`` (NULL keys: unusable) and classes of equal vectors ``cid, k1, k2, first_id, n, vector``."""
    vector = F.col(embedding).cast("array<double>")
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(~odd & F.exists("vector", lambda x: x != 0), F.lit(False))
    keyed = rows.select(F.col(vec_id).alias("vec_id"), vector.alias("vector")).withColumns({
        "k1": F.when(usable, F.xxhash64("vector")), "k2": F.when(usable, F.xxhash64(F.lit(1), "vector"))})
    classes = keyed.filter("k1 IS NOT NULL").groupBy("k1", "k2", "vector").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    return (materialise(keyed.select("vec_id", "k1", "k2")),
            materialise(classes.withColumn("cid", F.monotonically_increasing_id())))


def _apart(drawn: np.ndarray, most: int, least: int) -> np.ndarray:
    """The first ``most`` drawn vectors that are far from all before them: equal pivots would make the order a matter of chance.

    If these are fewer than ``least`` (all vectors in a narrow cone), the next drawn ones fill up, near as they are.
    """
    kept, near = drawn[:0], []
    for i, v in enumerate(drawn):
        if not len(kept) or (kept @ v).max() < PIVOTS_APART:
            if len(kept) == most:
                break
            kept = np.concatenate([kept, v[None]])
        else:
            near.append(i)
    return np.concatenate([kept, drawn[near[:max(0, least - len(kept))]]])


def nearest_of(pivots: int) -> int:
    """Length of permutations among so many pivots."""
    return NEAREST + 2 * max(0, math.ceil(math.log(max(pivots, 1) / 256, 4)))


def pivot_index(classes: DataFrame, nearest: int | None = None, pivots: int | None = None) -> tuple[DataFrame, int]:
    """``cid, dim, n, permutation, unit`` of every class (a written table), and the number of pivots."""
    size, width = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if pivots is None:
        pivots = min(MOST_PIVOTS, max(FEWEST_PIVOTS, round(2 * math.sqrt(size))))
    drawn = classes.orderBy(F.xxhash64(F.lit(7), "k1", "k2"), "cid").limit(2 * max(pivots, nearest or NEAREST)).select("vector").toArrow()["vector"]
    centres = _apart(_unit(_matrix(drawn.combine_chunks(), width)), pivots, nearest or NEAREST).T if size else np.zeros((0, 0))
    pivots = centres.shape[1]
    nearest = min(nearest or nearest_of(pivots), pivots)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                unit = _unit(_matrix(b.column("vector"), width))
                near = np.sort(np.argpartition(-(unit @ centres), nearest - 1, axis=1)[:, :nearest], axis=1).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [b.column("cid"), b.column("vector").value_lengths().cast(pa.int32()), b.column("n"),
                     pa.array([p.tobytes() for p in near], pa.binary()), pa.array(list(unit), pa.list_(pa.float64()))],
                    names=["cid", "dim", "n", "permutation", "unit"])

    return materialise(classes.select("cid", "n", "vector").mapInArrow(
        describe, "cid bigint, dim int, n bigint, permutation binary, unit array<double>")), pivots


def inverted_lists(index: DataFrame, pivots: int) -> DataFrame:
    """``dim, list, cid, permutation``: every class in the list of each pair of its nearest pivots.

    Where all pivots are the nearest ones of every class, one list has them all, and its blocks are compared without loss.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            near = np.frombuffer(b"".join(b.column("permutation").to_pylist()), "<u2").reshape(b.num_rows, -1).astype(np.int64)
            some = range(near.shape[1] if near.shape[1] < pivots else min(2, pivots))
            for i, j in itertools.combinations(some, 2):
                yield pa.RecordBatch.from_arrays(
                    [b.column("dim"), pa.array(near[:, i] * pivots + near[:, j]), b.column("cid"), b.column("permutation")],
                    names=["dim", "list", "cid", "permutation"])

    return index.select("dim", "cid", "permutation").mapInArrow(each, "dim int, list bigint, cid bigint, permutation binary")


def _masks(near: np.ndarray, pivots: int) -> np.ndarray:
    """Permutations as bit sets: one row of 64-bit words per vector."""
    out = np.zeros((len(near), (pivots + 63) // 64), np.uint64)
    rows = np.arange(len(near))
    for c in near.T.astype(np.int64):
        out[rows, c // 64] |= np.uint64(1) << (c % 64).astype(np.uint64)
    return out


def _candidates(a: np.ndarray, b: np.ndarray, below: np.ndarray, shared: int) -> np.ndarray:
    """Whether pairs of bit sets share enough pivots and the list is that of their two lowest shared ones."""
    count = np.zeros(np.broadcast_shapes(a.shape, b.shape)[:-1], np.int16)
    lower = count.copy()
    for w in range(a.shape[-1]):
        both = a[..., w] & b[..., w]
        count += np.bitwise_count(both)
        lower += np.bitwise_count(both & below[..., w])
    return (count >= shared) & (lower == 1)


def _below(lists: np.ndarray, pivots: int) -> np.ndarray:
    """Bit sets of the pivots below the second one of each list."""
    second = (lists % pivots)[:, None]
    words = np.arange((pivots + 63) // 64)[None, :] * 64
    n = np.clip(second - words, 0, 64).astype(np.uint64)
    full = ~np.uint64(0)
    return np.where(n == 64, full, (np.uint64(1) << (n & np.uint64(63))) - np.uint64(1))


GROUP = ["dim", "list", "_low", "_high"]


def _pairs_of_groups(rows: list[np.ndarray], pivots: int, shared: int, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs (row numbers) of the groups in ``rows``; rows of different blocks only where the blocks differ."""
    group = np.cumsum(new_group(rows[:4])) - 1
    sizes = np.bincount(group)
    masks, below = _masks(rows[5], pivots), _below(rows[1], pivots)
    cross = rows[2] != rows[3]
    at = np.flatnonzero((sizes <= SMALL)[group])
    for d in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        i = np.flatnonzero(group[at[:-d]] == group[at[d:]])
        a, b = at[i], at[i + d]
        ok = _candidates(masks[a], masks[b], below[a], shared) & ~(cross[a] & (own[a] == own[b]))
        yield a[ok], b[ok]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for k in np.flatnonzero(sizes > SMALL):
        first, end = starts[k], starts[k + 1]
        for s in range(first, end, 256):
            a, b = np.arange(s, min(end, s + 256)), np.arange(s, end)
            ok = _candidates(masks[a][:, None], masks[b][None, :], below[a][:, None], shared) & (a[:, None] < b[None, :])
            if cross[s]:
                ok &= own[a][:, None] != own[b][None, :]
            i, j = np.nonzero(ok)
            yield a[i], b[j]


def near_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9,
                 nearest: int | None = None, shared: int = SHARED, pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; vectors link at a cosine of ``threshold`` or more."""
    members, classes = vector_classes(rows, vec_id, embedding)
    index, pivots = pivot_index(classes, nearest, pivots)
    shared = min(shared, nearest or NEAREST, pivots)
    lists = materialise(inverted_lists(index, pivots))
    dealt = together(deal_blocks(lists, ["dim", "list"], "cid", block), GROUP)

    def retrieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cut in whole_groups(batches, [*GROUP, "cid", "permutation", "_own"], len(GROUP)):
            met = np.zeros(len(cut[0]), bool)
            for a, b in _pairs_of_groups(cut, pivots, shared, cut[6]):
                met[a] = met[b] = True
            yield pa.RecordBatch.from_arrays([pa.array(cut[i][met]) for i in (0, 1, 2, 3, 6, 4)], names=[*GROUP, "_own", "cid"])

    candidates = materialise(dealt.mapInArrow(retrieve, "dim int, list bigint, _low int, _high int, _own int, cid bigint"))
    brought = together(candidates.join(index.drop("dim"), "cid"), GROUP)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cut in whole_groups(batches, [*GROUP, "cid", "permutation", "_own", "n", "unit"], len(GROUP)):
            cid, n, unit = cut[4], cut[7], cut[8]
            links = np.zeros(len(cid), np.int64)
            linked_a, linked_b = [cid[:0]], [cid[:0]]
            for some_a, some_b in _pairs_of_groups(cut, pivots, shared, cut[6]):
                for at in range(0, len(some_a), 100_000):
                    a, b = some_a[at:at + 100_000], some_b[at:at + 100_000]
                    ok = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
                    a, b = a[ok], b[ok]
                    np.add.at(links, a, n[b])
                    np.add.at(links, b, n[a])
                    u, v = forest(cid[a], cid[b])
                    linked_a.append(u)
                    linked_b.append(v)
            some = np.flatnonzero(links)
            u, v = forest(np.concatenate(linked_a), np.concatenate(linked_b))
            none = pa.nulls(len(some), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([pa.array(cid[some]), pa.array(u)]), pa.concat_arrays([none, pa.array(v)]),
                 pa.array(np.concatenate([links[some], np.zeros(len(u), np.int64)]))], names=["cid", "root", "links"])

    found = materialise(brought.mapInArrow(verify, "cid bigint, root bigint, links bigint"))
    counts = found.filter("root IS NULL").groupBy("cid").agg(F.sum("links").alias("links"))
    edges = found.filter("root IS NOT NULL").select(F.col("cid").alias("a"), F.col("root").alias("b")).distinct()
    reached = materialise(connected_components(classes.drop("vector"), edges, "cid").join(counts, "cid", "left"))
    ids = reached.groupBy("component").agg(F.min("first_id").alias("component_id"))
    labels = materialise(reached.join(ids, "component").select(
        "k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")))
    return members.join(labels, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

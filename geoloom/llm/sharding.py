"""Sharding by sampled splitters: shards of nearly equal bytes, with equal texts kept together where they fit.

Rows are keyed by a hash of their text. Sample points are drawn along the bytes, so a row's chance
grows with its size; quantiles of the sampled keys are the splitters of many small ranges. Exact
bytes per range are then counted, ranges over twice their share are subdivided (by a second hash of
the key, or, where one key fills the range, by a hash of the row's id and size), and whole ranges go
to shards, largest first, each to the shard with the fewest bytes. Only sample points and ranges,
both bounded by parameters, reach the driver.

Defined results for odd rows: a NULL text has no bytes and the hash of a text of its own; repeated
rows share a range until it overflows; a NULL id is kept; an empty table gives no rows; other columns
are ignored. Slots are gapless within a shard.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.positions import gapless
from geoloom.operators.checkpoints import materialise

SHARDS = 24
#: Ranges per shard, and sample points per range.
RANGES_PER_SHARD, POINTS_PER_RANGE = 64, 8
#: Bytes that a row takes besides its text.
OVERHEAD = 8


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Written table ``doc_id, size, text_crc32, key, _block``: bytes of the text plus ``OVERHEAD`` and a hash of the text."""
    body = F.col(text).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"), F.xxhash64(F.col(text)).alias("key"))
    return materialise(rows.withColumn("_block", F.spark_partition_id()))


def splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """At most ``ranges - 1`` keys at quantiles of size-weighted sample points."""
    step = max(1.0, total / (ranges * POINTS_PER_RANGE))
    # A row of s bytes holds s / step points on average: the whole part, and one more with the rest as its chance.
    even = (F.pmod(F.xxhash64(F.lit(3), "key", "doc_id", "size", "_block"), F.lit(1 << 30)) / float(1 << 30))
    points = rows.select("key", F.floor(F.col("size") / step + even).cast("bigint").alias("n")).filter("n > 0")
    drawn = points.groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()  # about ranges * POINTS_PER_RANGE keys
    keys, n = np.array([r[0] for r in drawn], np.int64), np.array([r[1] for r in drawn], np.int64)
    if not len(keys):
        return keys
    ends = np.cumsum(n)
    at = np.searchsorted(ends, np.arange(1, ranges) * ends[-1] / ranges)
    cuts = keys[np.minimum(at, len(keys) - 1)]
    # A key that spans a whole share of points becomes a range of its own: it ends one range and begins the next.
    wide = keys[n >= 2 * POINTS_PER_RANGE]
    return np.unique(np.concatenate([cuts, wide, wide[wide > np.iinfo(np.int64).min] - 1]))


def in_ranges(rows: DataFrame, cuts: np.ndarray, parts: dict[int, tuple[int, bool]]) -> DataFrame:
    """Add ``range``: the range of the key among ``cuts`` and, in an overfull one, its subdivision."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = np.ones(len(cuts) + 1, np.int64)
        by_row = np.zeros(len(cuts) + 1, bool)
        for r, (n, one_key) in parts.items():
            split[r], by_row[r] = n, one_key
        base = np.concatenate([[0], np.cumsum(split)[:-1]])
        for b in batches:
            r = np.searchsorted(cuts, b.column("key").to_numpy(), "left")
            second = np.where(by_row[r], b.column("_of_row").to_numpy(), b.column("_of_key").to_numpy())
            names = [n for n in b.schema.names if n not in ("_of_row", "_of_key")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(base[r] + second % split[r])],
                                             names=[*names, "range"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    # Repeated rows of one id part by the block that wrote them.
    marked = rows.withColumns({"_of_key": F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(1 << 40)),
                               "_of_row": F.pmod(F.xxhash64(F.lit(5), "doc_id", "size", "_block"), F.lit(1 << 40))})
    return marked.mapInArrow(place, f"{kept}, range bigint")


def assign_shards(sizes: dict[int, int], shards: int) -> np.ndarray:
    """Shard of every range: largest first, each to the shard with the fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = np.zeros(max(sizes, default=-1) + 1, np.int32)
    for r in sorted(sizes, key=lambda r: (-sizes[r], r)):
        held, s = heapq.heappop(heap)
        out[r] = s
        heapq.heappush(heap, (held + sizes[r], s))
    return out


def _count(placed: DataFrame) -> list:
    """Exact bytes and the span of keys per range: as many rows as there are ranges."""
    return placed.groupBy("range").agg(F.sum("size").alias("size"), F.min("key").alias("low"), F.max("key").alias("high")).collect()


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row, shards 0 to ``shards - 1`` of nearly equal bytes."""
    rows = sized(docs, doc_id, text)
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = shards * RANGES_PER_SHARD
    cuts = splitters(rows, total, ranges)
    share = max(1.0, total / ranges)
    placed = in_ranges(rows, cuts, {})
    counted = _count(placed)
    # One text whose copies fill at most half a shard stays whole; larger groups are parted by row.
    whole = total / shards / 2
    parts = {int(c["range"]): (-(-int(c["size"]) // int(share)), c["low"] == c["high"]) for c in counted
             if c["size"] > 2 * share and (c["low"] < c["high"] or c["size"] > whole)}
    if parts:
        placed = in_ranges(rows, cuts, parts)
        counted = _count(placed)
    shard_of = assign_shards({int(c["range"]): int(c["size"]) for c in counted}, shards)

    def to_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [n for n in b.schema.names if n not in ("range", "key")]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(shard_of[b.column("range").to_numpy()])],
                                             names=[*names, "shard"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    dealt = placed.mapInArrow(to_shard, f"doc_id {kind}, size bigint, text_crc32 bigint, _block int, shard int")
    return gapless(materialise(dealt), "shard", ["doc_id", "text_crc32", "size"], "slot").drop("_block")

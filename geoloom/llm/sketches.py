"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so its size grows with
the text, sketches of parts merge by union, and the containment of a short text in a long one is
estimated without bias however unequal they are. A text none of whose hashes passes keeps its
smallest one, which lies above the threshold and so shows what it is; :func:`merged` drops it beside
others. A fingerprint is the sorted kept hashes (40 bits each) in base64.

Shingles are five words (the whole word sequence of shorter texts) of the whole text, with white
space between words taken as one space.

Defined results for odd rows: a NULL text is the empty string, whose fingerprint is empty; two empty
fingerprints are alike (1.0), an empty one and another are not (0.0); equal texts have equal
fingerprints; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = 5
#: One hash in so many is kept.
SCALE = 8
HASH_BITS = 40
_ODD = np.uint64(0x9E3779B97F4A7C15)  # any odd constant: base of the polynomial over bytes
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(1 << 16, _ODD), _powers(1 << 16, _INVERSE)


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hash of every shingle: a polynomial over its bytes modulo 2^64, mixed, top 40 bits."""
    global _UP, _DOWN
    parts = text.encode("utf-8", "surrogatepass").split()
    if not parts:
        return np.zeros(0, np.uint64)
    k = min(words, len(parts))
    data = np.frombuffer(b" ".join(parts), np.uint8)
    if len(data) > len(_UP):
        n = 1 << len(data).bit_length()
        _UP, _DOWN = _powers(n, _ODD), _powers(n, _INVERSE)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    gaps = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], gaps + 1])[:len(parts) - k + 1]
    ends = np.concatenate([gaps, [len(data)]])[k - 1:]
    h = (sums[ends] - sums[starts]) * _DOWN[starts] + (ends - starts).astype(np.uint64)
    for shift, by in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(by)
    return (h ^ (h >> np.uint64(32))) >> np.uint64(64 - HASH_BITS)


def sketch(text: str, scale: int = SCALE, words: int = WORDS) -> np.ndarray:
    """Sorted distinct kept hashes of a whole text."""
    found = shingle_hashes(text, words)
    kept = np.unique(found[found < np.uint64((1 << HASH_BITS) // scale)])
    return kept if len(kept) or not len(found) else found.min(keepdims=True)


def to_text(kept: np.ndarray) -> str:
    return base64.b64encode(kept.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BITS // 8:].tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    data = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, HASH_BITS // 8)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, 8 - HASH_BITS // 8:] = data
    return wide.view(">u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Sketch of two texts together."""
    both = np.union1d(a, b)
    kept = both[both < np.uint64((1 << HASH_BITS) // scale)]
    return kept if len(kept) else both[:1]


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the shingles of ``a`` that are in ``b``."""
    return 1.0 if not len(a) else len(np.intersect1d(a, b, assume_unique=True)) / len(a)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity."""
    if not len(a) and not len(b):
        return 1.0
    same = len(np.intersect1d(a, b, assume_unique=True))
    return same / (len(a) + len(b) - same)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """``doc_id, n_chars, fingerprint`` of every document."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([to_text(sketch(t, scale, words)) for t in texts], pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(each, f"doc_id {kind}, n_chars bigint, fingerprint string")


# ---- each document beside the next ------------------------------------------------------------------------------

#: Ranges of the order at most, so that the list of their first keys stays small (a few MB); a range may be any size.
MOST_RANGES, RANGE_BYTES, POINTS_PER_RANGE = 1 << 16, 4 << 20, 4
RANGES_PER_TASK = 4


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows with a total order ``(_null, _id, _tie, _spread)``: NULL ids last, equal ids by text, equal rows by where they were read."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(doc_id).isNull().alias("_null"),
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)).alias("_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_tie"),
        F.monotonically_increasing_id().alias("_spread"))


ORDER = ["_null", "_id", "_tie", "_spread"]


def _kept(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows dealt to ranges of the order, with the first row of the range after it in each; sorted within ranges.

    Columns ``_range`` and ``_guest`` (the row belongs to the next range, or, in the last range, is the
    very first row) tell what a row is there for. The texts are shuffled once. ``docs`` must read the
    same each time, as a table does.
    """
    keyed = _keyed(docs, doc_id, text)
    slim = keyed.select(*ORDER, F.octet_length("text").alias("size"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    ranges = int(min(MOST_RANGES, max(1, total // RANGE_BYTES)))
    step = max(1.0, (total + 1) / (ranges * POINTS_PER_RANGE))
    # Sample points fall along the bytes, so ranges hold similar amounts of text.
    chance = F.pmod(F.xxhash64(F.lit(9), *ORDER), F.lit(1 << 30)) / float(1 << 30)
    points = [tuple(r) for r in slim.filter(chance < (F.col("size") + 1) / step).orderBy(*ORDER).select(*ORDER).collect()]
    cuts = sorted({points[i * len(points) // ranges] for i in range(1, ranges)}) if points else []

    def ranges_of(b: pa.RecordBatch) -> tuple[list[tuple], list[int]]:
        keys = list(zip(*(b.column(n).to_pylist() for n in ORDER), strict=True))
        return keys, [bisect.bisect_right(cuts, k) for k in keys]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ranges_of(b)[1], pa.int32())], names=[*b.schema.names, "_range"])

    first = slim.select(*ORDER).mapInArrow(place, f"{_kept(slim.select(*ORDER))}, _range int").groupBy("_range").agg(
        F.min(F.struct(*ORDER)).alias("first")).orderBy("_range").collect()  # one row per range
    hosts = {tuple(r["first"]): first[i - 1]["_range"] for i, r in enumerate(first)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, own = ranges_of(b)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32()), pa.array([False] * len(own))],
                                             names=[*b.schema.names, "_range", "_guest"])
            guests = [i for i, k in enumerate(keys) if k in hosts]
            if guests:
                some = b.take(pa.array(guests))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([hosts[keys[i]] for i in guests], pa.int32()), pa.array([True] * len(guests))],
                    names=[*b.schema.names, "_range", "_guest"])

    dealt = keyed.mapInArrow(deal, f"{_kept(keyed)}, _range int, _guest boolean")
    return dealt.repartition(-(-ranges // RANGES_PER_TASK), "_range").sortWithinPartitions("_range", "_guest", *ORDER)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of code points replaced by as many first ones (or all) of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scale: int = SCALE, words: int = WORDS) -> DataFrame:
    """Every document beside its edited text and the next document: fingerprints and their likeness."""
    ordered = in_order(docs, doc_id, text)
    kind = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for b in batches:
            out: list[list] = [[] for _ in names]
            for this, body, r in zip(b.column("doc_id"), b.column("text").to_pylist(), b.column("_range").to_pylist(), strict=True):
                now = (this, body, sketch(body, scale, words), r)
                if before is not None and before[3] == r:
                    change = edited(before[1], body)
                    changed = sketch(change, scale, words)
                    for column, value in zip(out, (
                            before[0].as_py(), len(before[1]), hashlib.sha256(change.encode()).hexdigest(), to_text(before[2]),
                            to_text(changed), likeness(before[2], changed), likeness(before[2], now[2])), strict=True):
                        column.append(value)
                before = now
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, (b.schema.field("doc_id").type, pa.int64(), pa.string(), pa.string(), pa.string(),
                                                      pa.float64(), pa.float64()), strict=True)], names=names)

    return ordered.mapInArrow(each, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")

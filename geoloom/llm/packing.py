"""Best-two-fit packing of token pieces into sequences of fixed capacity.

Packing depends on lengths alone, and there are at most ``capacity`` different lengths however many
pieces there are. The plan is therefore made on the table of counts per length (at most ``capacity``
rows, the only thing that reaches the driver): a bin is filled greedily, largest piece first; when
nothing more fits, its smallest piece is replaced by the two unpacked pieces that fill the widened
gap best, if they fill it better. The same bin is repeated as often as the counts allow, so the plan
has one entry per pattern and its size does not grow with the data. Pieces then find their place by
their position within their length.

Defined results for odd rows: a NULL text is the empty string, whose only token is the end token;
repeated rows are packed as pieces of their own; NULL ids are kept; an empty table gives no rows;
columns of the input other than id and text are not carried, so no name can clash.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.positions import gapless
from geoloom.llm.tokens import word_encoder
from geoloom.operators.checkpoints import materialise

CAPACITY = 2048


def plan_best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Bin patterns ``(times, {length: pieces})`` for ``counts[length]`` pieces of every length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(n < 1 or n > capacity for n in left):
        raise ValueError("lengths must be 1 to capacity")
    lengths = sorted(left)
    plan: list[tuple[int, dict[int, int]]] = []
    while lengths:
        used: dict[int, int] = {}
        gap = capacity
        at = len(lengths)
        # Greedy: the largest unpacked length that fits, as often as it fits.
        while at > 0 and (at := bisect.bisect_right(lengths, gap, 0, at)) > 0:
            n = lengths[at - 1]
            take = min(left[n], gap // n)
            used[n] = take
            gap -= take * n
            at -= 1
        need = dict(used)
        if gap and sum(used.values()) > 1:
            smallest = min(used)
            pair = _best_pair(lengths, left, used, gap + smallest)
            if pair and sum(pair) > smallest:
                used[smallest] -= 1
                for n in pair:
                    used[n] = used.get(n, 0) + 1
                used = {n: c for n, c in used.items() if c}
                for n, c in used.items():
                    need[n] = max(need.get(n, 0), c)
        times = min(left[n] // c for n, c in need.items())
        plan.append((times, used))
        for n, c in used.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
                lengths.pop(bisect.bisect_left(lengths, n))
    return plan


def _best_pair(lengths: list[int], left: dict[int, int], used: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two unpacked pieces with the largest sum that is at most ``room``."""
    best, low, high = None, 0, bisect.bisect_right(lengths, room) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        free_a, free_b = left[a] - used.get(a, 0), left[b] - used.get(b, 0)
        if not free_a or (low == high and free_a < 2):
            low += 1
        elif not free_b:
            high -= 1
        elif a + b > room:
            high -= 1
        else:
            if best is None or a + b > sum(best):
                best = (a, b)
            low += 1
    return best


def place_rows(plan: list[tuple[int, dict[int, int]]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """``(length, first, end, per_bin, sequence, offset)``: ranks ``first`` to ``end`` of a length go to bins from ``sequence``."""
    sequence, rank = 0, {}
    for times, used in plan:
        offset = 0
        for n in sorted(used, reverse=True):
            first = rank.get(n, 0)
            rank[n] = first + times * used[n]
            yield n, first, rank[n], used[n], sequence, offset
            offset += n * used[n]
        sequence += times


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a written table of ``pieces`` with a ``_block`` column."""
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy(length).count().collect()}  # at most ``capacity`` rows
    # A few places per length, bounded by the capacity: small enough to travel with the tasks.
    grid = np.array(sorted(place_rows(plan_best_two_fit(counts, capacity))), dtype=np.int64).reshape(-1, 6)
    span = int(grid[:, 2].max()) + 1 if len(grid) else 1
    starts = grid[:, 0] * span + grid[:, 1]
    ranked = gapless(pieces, length, ["_row"], "_rank")

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranks, sizes = b.column("_rank").to_numpy(), b.column(length).to_numpy()
            key = sizes * span + ranks
            i = np.searchsorted(starts, key, "right") - 1
            p = grid[i]
            inside = ranks - p[:, 1]
            keep = [n for n in b.schema.names if n not in ("_rank", "_row", "_block")]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in keep] + [pa.array(p[:, 4] + inside // p[:, 3]), pa.array(p[:, 5] + inside % p[:, 3] * sizes)],
                names=[*keep, "sequence_id", "offset"])

    kept = [f for f in ranked.schema.fields if f.name not in ("_rank", "_row", "_block")]
    return ranked.mapInArrow(locate, T.StructType([*kept, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
                 doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Token pieces ``doc_id, piece, start, length, ids_crc32[, ids]`` of every document, as a written table for :func:`pack`.

    A document is its token ids followed by ``end_id``; only longer ones than ``capacity`` are cut.
    """
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("_row", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, row = word_encoder(vocabulary), 0
        for b in batches:
            where, pieces, starts, sizes, crcs, ids = [], [], [], [], [], []
            for i, ids_bytes in enumerate(encode(b.column(1).to_pylist())):
                whole = ids_bytes + end
                for k, at in enumerate(range(0, len(whole), step)):
                    part = whole[at:at + step]
                    where.append(i)
                    pieces.append(k)
                    starts.append(at // 4)
                    sizes.append(len(part) // 4)
                    crcs.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [b.column(0).take(pa.array(where, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                       pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()), pa.array(range(row, row + len(where)), pa.int64())]
            row += len(where)
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), names=[f.name for f in fields])

    cut_rows = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))).mapInArrow(cut, T.StructType(fields))
    return materialise(cut_rows.withColumn("_block", F.spark_partition_id()))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = 0, capacity: int = CAPACITY,
                   doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """All documents as pieces placed in as few sequences as best-two-fit finds."""
    return pack(token_pieces(docs, vocabulary, end_id, capacity, doc_id, text, with_ids), capacity=capacity)

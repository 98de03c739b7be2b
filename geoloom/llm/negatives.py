"""Hard negatives by angular triangle filtering and exact integer scores.

Vectors are scaled and rounded down to integers; the score of two rows is their integer inner product. An anchor's positives are the
first rows of its own label, its negatives for a positive are the first rows of other labels whose score lies in a window
given by the positive's score.

* **Stored angles.** Every row keeps its angle to ``REFERENCES`` reference directions, drawn from at most ``SAMPLE`` rows. By the triangle
  inequality the angle of two rows lies between the difference and the sum of their angles to any reference, which gives an interval for their
  cosine and, times both lengths, for their score. Intervals are widened by more than rounding can move them.
* **Blocks.** Rows are sorted by nearest reference and angle to it and packed into blocks; a block knows the extremes of its angles and lengths.
  Anchors are blocked the same way. A block of anchors meets only the row blocks whose score bounds overlap what
  one of its anchors still looks for.
* **Windows.** Inside a block an anchor's score range is a range of angles, hence one window of the sorted rows, found by binary search; rows of
  it whose own bounds overlap the range are scored in integers. The same rows come out for any references.

Defined results for odd rows: rows with a NULL label, NULL vector, NULL id, or a NULL or non-finite component take no part, nor do
rows whose squared integer length passes 2^63 (no score could then leave 64 bits); vectors of different lengths have no inner product and are not
compared; repeated rows are rows of their own; equal scores go to the smaller id; an anchor without positives gives no rows; an empty table
gives no rows. Columns of the input besides the three named ones are left aside, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import repeated

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 30, 90
REFERENCES, SAMPLE = 16, 1024
BLOCK, ANCHORS, PACKED_TOGETHER = 1024, 1024, 8
#: Row blocks in a task: as many as ``TASKS`` tasks ask for, within these limits (a block takes about 1 MB). Rows a task holds before it drops those that cannot be among the first.
LEAST_BLOCKS, MOST_BLOCKS, TASKS, HELD = 8, 64, 256, 200_000
#: Angles are stored in 32 bits (error under 3e-7); cosines near 1 turn rounding of 1e-13 into angles of 5e-7.
SLACK = 4e-6
#: Scores are bounded up to this share of both lengths, and one.
ROUND = 1e-9


def integers(values: np.ndarray) -> np.ndarray:
    """Components times ``SCALE``, rounded down, as doubles (whole numbers)."""
    return np.floor(values.astype(np.float64) * SCALE)


def _angles(q: np.ndarray, norm: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of every row to every reference; a right angle for rows of length zero."""
    with np.errstate(divide="ignore", invalid="ignore"):
        cos = (q @ references.T) / norm[:, None]
    return np.where(norm[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), np.pi / 2)


def choose_references(rows: np.ndarray, most: int = REFERENCES) -> np.ndarray:
    """Unit directions far apart: each is the row farthest in angle from those chosen before."""
    norm = np.sqrt((rows ** 2).sum(axis=1))
    unit = rows[norm > 0] / norm[norm > 0][:, None]
    if not len(unit):
        return np.eye(1, rows.shape[1])
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(most, len(unit)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, unit @ unit[chosen[-1]])
    return unit[chosen]


_KEPT = "id bigint, label bigint, dim int, q binary, norm double"


def prepared(vectors: DataFrame, vec_id: str, vector: str, label: str | Column) -> DataFrame:
    """Rows that take part: ``id, label, dim, q`` (64-bit little-endian integers) and ``norm``."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                q = integers(flat)
                row = np.repeat(np.arange(len(sizes)), sizes)
                bad = np.bincount(row, weights=~np.isfinite(flat), minlength=len(sizes)) > 0
                squared = np.bincount(row, weights=np.where(np.isfinite(q), q, 0) ** 2, minlength=len(sizes))
                ok = np.flatnonzero(~bad & (squared < 2.0 ** 63 * (1 - 1e-9)))
            edges = np.append(0, np.cumsum(sizes))
            whole = np.where(np.isfinite(q) & (np.abs(q) < 2.0 ** 62), q, 0).astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(ok)), b.column("label").take(pa.array(ok)), pa.array(sizes[ok].astype(np.int32)),
                 pa.array([whole[edges[i]:edges[i + 1]].tobytes() for i in ok], pa.binary()), pa.array(np.sqrt(squared[ok]))],
                names=["id", "label", "dim", "q", "norm"])

    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    whole = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    return rows.filter(whole).mapInArrow(each, _KEPT)


def references_of(rows: DataFrame) -> dict[int, np.ndarray]:
    """Reference directions per vector length, from at most ``SAMPLE`` rows drawn by a hash of the id."""
    some = rows.orderBy(F.xxhash64("id", "q"), "id").limit(SAMPLE).select("dim", "q").collect()
    out = {}
    for dim in {r["dim"] for r in some}:
        out[dim] = choose_references(np.array([np.frombuffer(r["q"], "<i8") for r in some if r["dim"] == dim], np.float64))
    return out


def with_angles(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    """Add ``angles`` (32-bit, to each reference), ``cell`` (the nearest reference) and ``angle`` (to it)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims, norm = b.column("dim").to_numpy(), b.column("norm").to_numpy()
            stored, cells, angle = np.empty(len(dims), object), np.zeros(len(dims), np.int32), np.zeros(len(dims), np.float32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                q = np.frombuffer(b"".join(b.column("q").take(pa.array(at)).to_pylist()), "<i8").reshape(len(at), dim).astype(np.float64)
                found = _angles(q, norm[at], references.get(dim, np.ones((1, dim)) / max(1, dim) ** 0.5)).astype("<f4")
                cells[at] = found.argmin(axis=1)
                angle[at] = found.min(axis=1)
                stored[at] = [x.tobytes() for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(stored), pa.binary()), pa.array(cells), pa.array(angle)],
                                             names=[*b.schema.names, "angles", "cell", "angle"])

    return rows.mapInArrow(each, f"{_KEPT}, angles binary, cell int, angle float")


#: Row numbers: partition, block in it (20 bits), row (11 bits). Columns of a block that hold one value per row, and how they are stored.
PACKED = {"ids": "<i8", "labels": "<i8", "norms": "<f8", "q": "<i8", "angles": "<f4"}
_BLOCK = "block bigint, dim int, cell int, size int, ids binary, labels binary, norms binary, q binary, angles binary, bounds binary"


def _pack(block: int, dim: int, cell: int, rows: list[dict]) -> dict:
    """A block of rows sorted by their angle to the cell's reference. ``bounds``: lowest and highest angle per reference, then length."""
    angles = np.frombuffer(b"".join(r["angles"] for r in rows), "<f4").reshape(len(rows), -1)
    norms = np.array([r["norm"] for r in rows])
    bounds = np.concatenate([angles.min(axis=0), angles.max(axis=0), [norms.min()], [norms.max()]]).astype("<f8")
    return {"block": block, "dim": dim, "cell": cell, "size": len(rows), "ids": np.array([r["id"] for r in rows], "<i8").tobytes(),
            "labels": np.array([r["label"] for r in rows], "<i8").tobytes(), "norms": norms.astype("<f8").tobytes(),
            "q": b"".join(r["q"] for r in rows), "angles": angles.tobytes(), "bounds": bounds.tobytes()}


def _schema(text: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split(" ") for c in text.split(", "))])


ORDER = ["dim", "cell", "angle", "_tie"]


def blocks_of(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """Rows packed into blocks of at most ``most`` neighbours in angle; equal rows are parted by a hash."""
    schema = _schema(_BLOCK)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 20, []
        for b in batches:
            for r in b.to_pylist():
                if held and (len(held) == most or (r["dim"], r["cell"]) != (held[0]["dim"], held[0]["cell"])):
                    yield pa.RecordBatch.from_pylist([_pack(number, held[0]["dim"], held[0]["cell"], held)], schema)
                    number, held = number + 1, []
                held.append(r)
        if held:
            yield pa.RecordBatch.from_pylist([_pack(number, held[0]["dim"], held[0]["cell"], held)], schema)

    tied = rows.withColumn("_tie", F.xxhash64("id", "q", "label"))
    return tied.repartitionByRange(parts, *ORDER).sortWithinPartitions(*ORDER, "id").mapInArrow(each, _BLOCK)


class Block:
    """An unpacked block."""

    def __init__(self, row: dict) -> None:
        self.number, self.dim, self.cell = row["block"], row["dim"], row["cell"]
        for name, kind in PACKED.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        n = row["size"]
        self.q = self.q.reshape(n, self.dim)
        self.angles = self.angles.reshape(n, -1).astype(np.float64)
        self.rows = (self.number << 11) + np.arange(n)
        self.theta = self.angles[:, self.cell]
        self.longest, self.shortest = self.norms.max(), self.norms.min()


def _range(least, most, length_low, length_high):
    """Bounds of scores whose cosine lies between ``least`` and ``most`` and whose product of lengths lies in the given range."""
    pad = ROUND * length_high + 1
    return (np.where(least < 0, least * length_high, least * length_low) - pad, np.where(most > 0, most * length_high, most * length_low) + pad)


def _apart(alpha_low, alpha_high, theta_low, theta_high):
    """Smallest and largest angle of two directions from ranges of their angles to the same references (last axis)."""
    least = np.maximum(np.maximum(alpha_low - theta_high, theta_low - alpha_high), 0).max(axis=-1) - SLACK
    sums_low, sums_high = alpha_low + theta_low, alpha_high + theta_high
    # Beyond half a turn the sum of angles bounds the angle from the other side.
    top = np.where(sums_high <= np.pi, sums_high, np.where(sums_low >= np.pi, 2 * np.pi - sums_low, np.pi))
    return np.maximum(least, 0), np.minimum(top.min(axis=-1) + SLACK, np.pi)


def window(anchor: dict, low: float, high: float, block: Block) -> tuple[int, int]:
    """The run of a block's rows whose score with the anchor may lie in ``low`` to ``high``, by their angle to the cell's reference alone."""
    theta, alpha = block.theta, anchor["alpha"][block.cell]
    longest, shortest = anchor["norm"] * block.longest, anchor["norm"] * block.shortest
    pad = ROUND * longest + 1
    least, most = low - pad, high + pad
    # A score of ``least`` needs this cosine at least, for the length that asks for the smallest one; ``most`` allows that one at most.
    length = longest if least > 0 else shortest
    need = least / length if length > 0 else -1.0
    length = shortest if most > 0 else longest
    allowed = most / length if length > 0 else 1.0
    if need > 1 or allowed < -1 or least > longest:
        return 0, 0
    reach = np.arccos(max(need, -1.0)) + 2 * SLACK  # the angle is no less than the difference of both angles
    a, b = alpha - reach, alpha + reach
    if allowed < 1:  # and no more than their sum, or what is left of a whole turn
        gap = np.arccos(allowed) - 2 * SLACK
        a, b = max(a, gap - alpha), min(b, 2 * np.pi - gap - alpha)
    return int(np.searchsorted(theta, a, side="left")), int(np.searchsorted(theta, b, side="right"))


def scored(anchor: dict, low: float, high: float, block: Block, take: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows among ``take`` (a mask) whose score bounds overlap ``low`` to ``high``, and their scores."""
    a, b = window(anchor, low, high, block)
    at = a + np.flatnonzero(take[a:b])
    if not len(at):
        return at, np.zeros(0, np.int64)
    theta = block.angles[at]
    nearest, farthest = _apart(anchor["alpha"], anchor["alpha"], theta, theta)
    length = anchor["norm"] * block.norms[at]
    least, most = _range(np.cos(farthest), np.cos(nearest), length, length)
    at = at[(least <= high) & (most >= low)]
    return at, block.q[at] @ anchor["q"]


def best(at: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places in ``at`` of the first k by score, then by smaller id."""
    return np.lexsort((at, ids[at], -score))[:k]


_ANCHOR = "row bigint, id bigint, label bigint, dim int, q binary, norm double, cell int, angle float, angles binary, least bigint"


def anchors_of(blocks: DataFrame, every: int, positives: int) -> DataFrame:
    """Rows whose id is divisible by ``every``, with the score of the last of its best positives in its own block (``least``), a bound below the true one."""
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("q", pa.binary()), ("norm", pa.float64()),
                        ("cell", pa.int32()), ("angle", pa.float32()), ("angles", pa.binary()), ("least", pa.int64())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                block, out = Block(r), []
                for i in np.flatnonzero(block.ids % every == 0).tolist():
                    same = block.labels == block.labels[i]
                    same[i] = False
                    score = np.sort(block.q[same] @ block.q[i])
                    out.append({"row": int(block.rows[i]), "id": int(block.ids[i]), "label": int(block.labels[i]), "dim": block.dim,
                                "q": block.q[i].tobytes(), "norm": float(block.norms[i]), "cell": block.cell, "angle": float(block.theta[i]),
                                "angles": block.angles[i].astype("<f4").tobytes(),
                                "least": int(score[-positives]) if len(score) >= positives else None})
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema)

    return blocks.mapInArrow(each, _ANCHOR)


def _summaries(groups: DataFrame) -> DataFrame:
    """Per block of anchors: extremes of angles and lengths, and the scores they look for."""
    def each(t: pa.Table) -> pa.Table:
        angles = np.frombuffer(b"".join(t.column("angles").to_pylist()), "<f4").reshape(t.num_rows, -1).astype(np.float64)
        norm = t.column("norm").to_numpy()
        low, high = t.column("low").to_numpy(), t.column("high").to_numpy()
        return pa.table([t.column("group")[:1], t.column("dim")[:1], pa.array([_bounds(angles, norm, low, high).astype("<f8").tobytes()], pa.binary())],
                        names=["agroup", "adim", "abounds"])

    return groups.groupBy("group", "dim").applyInArrow(each, "agroup int, adim int, abounds binary")


def _bounds(angles: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return np.concatenate([angles.min(axis=0), angles.max(axis=0), [norm.min()], [norm.max()], [low.min()], [high.max()]])


def overlap(anchor: np.ndarray, rows: np.ndarray) -> bool:
    """Whether scores between a block of anchors and a block of rows may be ones that an anchor looks for."""
    m = (len(rows) - 2) // 2
    near, far = _apart(anchor[:m], anchor[m:2 * m], rows[:m], rows[m:2 * m])
    least, most = _range(np.cos(far), np.cos(near), anchor[2 * m] * rows[2 * m], anchor[2 * m + 1] * rows[2 * m + 1])
    return bool(least <= anchor[2 * m + 3] and most >= anchor[2 * m + 2])


def meet(blocks: DataFrame, anchors: DataFrame, groups: int, each_pair, names: list[str], k: int) -> DataFrame:
    """Rows ``(key..., id, row, score)`` that ``each_pair(anchors, block)`` lists for the pairs of a group of anchors and a row block whose bounds
    overlap; of a key, a task gives its first ``k``. Anchors have ``group, low, high``.

    A task holds some row blocks and reads the groups of anchors that meet one of them, one after the other: a block is sent once, a
    group once per task, and neither per pair."""
    summaries = _summaries(anchors)
    count = blocks.count()
    most = min(max(LEAST_BLOCKS, -(-count // TASKS)), MOST_BLOCKS)
    tasks = max(1, -(-count // most))
    # Neighbours in angle meet the same anchors and are dealt to different tasks: about 8 blocks come from a partition, see blocks_of.
    ordinal = F.shiftright("block", 20) * PACKED_TOGETHER + F.col("block").bitwiseAND((1 << 20) - 1)
    dealt = materialise(blocks.select("block", F.col("dim").alias("rdim"), "bounds").withColumn("task", (ordinal % tasks).cast("int")))
    asked = repeated(dealt.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [overlap(np.frombuffer(x, "<f8"), np.frombuffer(y, "<f8")) for x, y in zip(b.column("abounds").to_pylist(), b.column("bounds").to_pylist(), strict=True)]
            yield b.filter(pa.array(keep, pa.bool_())).select(["task", "group"])

    met = materialise(asked.join(summaries, (F.col("adim") == F.col("rdim")) & (F.col("group") == F.col("agroup"))).select(
        "task", "group", "abounds", "bounds").mapInArrow(near, "task int, group int").distinct())
    sent = anchors.join(repeated(met), "group").withColumns({"_anchor": F.struct(*anchors.columns), "_kind": F.lit(1)})
    held_blocks = blocks.join(repeated(dealt.select("block", "task")), "block").withColumns({"_block": F.struct(*blocks.columns), "_kind": F.lit(0)})
    both = held_blocks.select("task", "_kind", "_block").unionByName(sent.select("task", "_kind", "_anchor", "group"), allowMissingColumns=True)
    both = both.repartition(2 * tasks, "task").sortWithinPartitions("task", "_kind", "group")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        task, here, group, some = None, [], None, []

        def compared() -> Iterator[pa.RecordBatch]:
            """The anchors read so far of a group against all blocks of the task they may look at."""
            nonlocal held, some
            for dim in {a["dim"] for a in some}:
                own = [a for a in some if a["dim"] == dim]
                around = _bounds(np.array([a["alpha"] for a in own]), *(np.array([a[k] for a in own]) for k in ("norm", "low", "high")))
                for block, bounds in here:
                    if block.dim != dim or not overlap(around, bounds):
                        continue
                    held += each_pair(own, block)
                    if len(held) > HELD:
                        held = leading(held, k)
                        if len(held) > HELD // 2:
                            yield _batch(held, names)
                            held = []
            some = []

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if row["task"] != task or row["group"] != group or len(some) == ANCHORS:
                    yield from compared()
                if row["task"] != task:
                    task, here = row["task"], []
                group = row["group"]
                if row["_kind"] == 0:
                    here.append((Block(row["_block"]), np.frombuffer(row["_block"]["bounds"], "<f8")))
                else:
                    a = row["_anchor"]
                    some.append(a | {"q": np.frombuffer(a["q"], "<i8"), "alpha": np.frombuffer(a["angles"], "<f4").astype(np.float64)})
        yield from compared()
        if held:
            yield _batch(leading(held, k), names)

    return both.mapInArrow(work, ", ".join(f"{n} bigint" for n in names))


def leading(found: list[tuple], k: int) -> list[tuple]:
    """Of rows ``(key..., id, row, score)`` the first k of every key: higher scores, then smaller ids and rows."""
    columns = np.array(found, np.int64).T
    keys = columns[:-3]
    order = np.lexsort((columns[-2], columns[-3], -columns[-1], *keys[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any(keys[:, order[1:]] != keys[:, order[:-1]], axis=0)
    begin = np.flatnonzero(new)
    place = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return [found[i] for i in order[place < k].tolist()]


def _first(found: DataFrame, keys: list[str], order: list[Column], k: int, out: str) -> DataFrame:
    return found.withColumn(out, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(out) <= k)


def hard_negatives(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label", every: int = 100,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``low`` and ``high`` in hundredths, at most 100."""
    rows = materialise(prepared(vectors, vec_id, vector, label))
    count = rows.count()
    angled = with_angles(rows, references_of(rows))
    blocks = materialise(blocks_of(angled, max(1, -(-count // (PACKED_TOGETHER * BLOCK))), BLOCK))
    anchors = materialise(anchors_of(blocks, every, positives))
    groups = max(1, -(-anchors.count() // ANCHORS))
    anchors = materialise(anchors.repartitionByRange(groups, "dim", "cell", "angle", "row").withColumn("group", F.spark_partition_id())
                          .withColumn("low", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf")))).withColumn("high", F.lit(float("inf"))))

    def same_label(here: list[dict], block: Block) -> list[tuple]:
        out = []
        for a in here:
            take = (block.labels == a["label"]) & (block.rows != a["row"])
            at, score = scored(a, a["low"], a["high"], block, take)
            for i in best(at, score, block.ids, positives).tolist():
                out.append((a["row"], int(block.ids[at[i]]), int(block.rows[at[i]]), int(score[i])))
        return out

    names = ["row", "positive_id", "positive_row", "positive_score"]
    found = meet(blocks, anchors.drop("least"), groups, same_label, names, positives)
    found = materialise(_first(found, ["row"], [F.col("positive_score").desc(), F.col("positive_id"), F.col("positive_row")], positives, "_place"))
    # Scores s with low * p <= 100 * s <= high * p, in decimals of any size; none if p is negative.
    wide = F.col("positive_score").cast("decimal(20,0)")
    sought = found.filter("positive_score >= 0").withColumn("from", F.ceil(wide * low / 100).cast("bigint")).withColumn(
        "to", F.floor(wide * high / 100).cast("bigint")).filter(F.col("from") <= F.col("to"))
    wanted = sought.groupBy("row").agg(F.collect_list(F.struct("positive_row", "from", "to")).alias("windows"),
                                       F.min("from").cast("double").alias("low"), F.max("to").cast("double").alias("high"))
    seekers = materialise(anchors.drop("low", "high", "least").join(repeated(wanted), "row"))

    def other_label(here: list[dict], block: Block) -> list[tuple]:
        out = []
        for a in here:
            at, score = scored(a, a["low"], a["high"], block, block.labels != a["label"])
            for w in a["windows"]:
                inside = np.flatnonzero((score >= w["from"]) & (score <= w["to"]))
                for i in inside[best(at[inside], score[inside], block.ids, negatives)].tolist():
                    out.append((a["row"], w["positive_row"], int(block.ids[at[i]]), int(block.rows[at[i]]), int(score[i])))
        return out

    mined = meet(blocks, seekers, groups, other_label, ["row", "positive_row", "negative_id", "negative_row", "negative_score"], negatives)
    mined = _first(mined, ["row", "positive_row"], [F.col("negative_score").desc(), F.col("negative_id"), F.col("negative_row")], negatives, "rank")
    named = found.join(anchors.select("row", F.col("id").alias("anchor_id")), "row").select("row", "anchor_id", "positive_row", "positive_id", "positive_score")
    return materialise(mined).join(repeated(named), ["row", "positive_row"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

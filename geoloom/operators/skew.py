"""Joins and running totals that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise

ROWS_PER_SALT = 100_000
ROWS_PER_RANGE = 500_000


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by ``keys`` into a fixed number of parts before per-row work that is heavy for its bytes.

    Adaptive execution merges partitions by size only, and would leave such work to one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def repeated(df: DataFrame) -> DataFrame:
    """Mark a table whose rows were repeated by ``explode``, or are to be by a join, for the next join on it.

    Spark takes its size for that of the rows before, and would send many times its limit for broadcasts through the driver. Such joins
    are sort-merge joins.
    """
    return df.hint("merge")


def hot_keys(sides: Sequence[DataFrame], keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT) -> list[DataFrame | None]:
    """For each table of counts (keys + ``n``) the keys too large for one task and how many salts they need, by the key's own size
    only; None where there are none. One job looks at all sides.

    There are at most rows / ``rows_per_salt`` of them. They are written as a table, so that Spark sees
    their true size and broadcasts or joins them by its own threshold.
    """
    hot = [c.filter(F.col("n") > rows_per_salt).select(*keys, F.ceil(F.col("n") / rows_per_salt).cast("int").alias("_salts")) for c in sides]
    some = reduce(DataFrame.unionByName, [h.select(F.lit(i).alias("side")) for i, h in enumerate(hot)])
    found = {r["side"] for r in some.groupBy("side").agg(F.count(F.lit(1))).collect()}
    return [materialise(h) if i in found else None for i, h in enumerate(hot)]


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner",
                counts: DataFrame | None = None, rows_per_salt: int = ROWS_PER_SALT,
                condition: Column | None = None, small_counts: DataFrame | None = None, heavy: bool = False) -> DataFrame:
    """Equi-join where keys may be hot: rows of a hot key are spread over salts and the
    matching rows of the other side repeated per salt. Results equal a plain join.

    ``counts`` (keys + ``n``) saves a pass over ``big`` when already known. Given ``small_counts``,
    an inner join splits hot keys of ``small`` in the same way. ``condition`` may refer to columns of
    both sides (names must then be distinct). ``heavy`` marks joins whose pairs cost far more than
    their bytes; their rows are spread over all tasks. Only the counts of keys decide what is salted.
    """
    keys = list(keys)
    if counts is None:
        counts = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    on, left, right = list(keys), big, small
    both = [counts, small_counts] if small_counts is not None and how == "inner" else [counts]
    hot, *other = hot_keys(both, keys, rows_per_salt)
    if hot is not None:  # a join with no hot keys would change nothing
        left, right = salted(left, right, keys, hot, "_salt")
        on.append("_salt")
    if other and other[0] is not None:
        right, left = salted(right, left, keys, other[0], "_salt2")
        on.append("_salt2")
    extra = on[len(keys):]
    left = spread(left, *on) if heavy else left
    if condition is None:
        return left.join(right, on, how).drop(*extra)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    match = condition
    for k in on:
        match = match & (F.col(k) == F.col(f"_r_{k}"))
    return left.join(renamed, match, how).drop(*extra, *[f"_r_{k}" for k in on])


def salted(big: DataFrame, small: DataFrame, keys: list[str], hot: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """``big`` with a salt per row, ``small`` repeated for every salt of its key."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.col("_salts"))
    left = big.join(hot, keys, "left").withColumn(salt, F.coalesce(part, F.lit(0)).cast("int")).drop("_salts")
    right = repeated(small.join(hot, keys, "left").withColumn(
        salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts") - 1, F.lit(0))))).drop("_salts"))
    return left, right


def running_totals(df: DataFrame, order: str, totals: dict[str, Column], by: Sequence[str] = (),
                   bucket: Column | None = None, descending: bool = False) -> DataFrame:
    """Add inclusive running sums in ``order`` (unique per group) without a global sort task.

    Rows are cut into order ranges; sums per range are accumulated over the small
    table of ranges; the within-range part is a window over (group, range). No
    task ever holds a whole group, however large.

    ``bucket`` gives the range index directly (it must grow with ``order``); otherwise Spark's
    range partitioner cuts the rows into as many ranges as their count asks for, and the rows are
    written with their range. Window order among the ranges is reversed for ``descending``.
    """
    by = list(by)
    if bucket is None:
        ranges = -(-df.count() // ROWS_PER_RANGE) or 1
        df = materialise(df.repartitionByRange(ranges, order).withColumn("_bucket", F.spark_partition_id()))
        bucket = F.col("_bucket")
    shown = [c for c in df.columns if c != "_bucket"]
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    rows = df.withColumn("_bucket", bucket)
    sums = rows.groupBy(*by, "_bucket").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in totals.items()])
    # One row per (group, range): bounded by groups x ranges.
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_bucket")).rowsBetween(
        W.unboundedPreceding, -1)
    offsets = sums.select(*by, "_bucket", *[
        F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in totals])
    inside = W.partitionBy(*by, "_bucket").orderBy(direction(order)).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    summed = rows.withColumns({f"_w_{k}": F.sum(v).over(inside) for k, v in totals.items()})
    return (summed.join(offsets, [*by, "_bucket"])
            .withColumns({k: F.col(f"_w_{k}") + F.col(f"_o_{k}") for k in totals})
            .select(*shown, *totals))


def ranked(df: DataFrame, order: str, out: str = "rank", **kw) -> DataFrame:
    """1-based position in ``order`` (unique), computed range by range."""
    return running_totals(df, order, {out: F.lit(1)}, **kw).withColumn(out, F.col(out).cast("bigint"))


def hash_bucket(hash_column: Column, rows: int) -> Column:
    """Range index of a 64-bit hash: as many of its top bits, shifted to be non-negative, as ``rows`` ask for."""
    bits = max(1, (max(rows, 1) // ROWS_PER_RANGE).bit_length())
    return F.shiftright(hash_column, 64 - bits) + F.lit(1 << (bits - 1))


def exact_quantiles(df: DataFrame, column: str, shares: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles (linear interpolation) per group by rank selection: ``by...`` and one column per entry of ``shares``.

    Equal values are counted once per group. The values are cut into ranges by Spark's range partitioner, counts per range
    tell which range holds a rank, and only those ranges are numbered. NULLs do not count; a group without values has no row
    (without groups: one row of NULLs).
    """
    by = list(by)
    values = df.filter(F.col(column).isNotNull()).groupBy(*by, F.col(column).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    values = materialise(values.repartitionByRange("_v").withColumn("_range", F.spark_partition_id()))
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # One row per (group, range).
    ranges = values.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows")).withColumns({
        "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_all": F.sum("_rows").over(W.partitionBy(*(by or [F.lit(0)])))})
    places = {k: F.lit(float(p)) * (F.col("_all") - 1) for k, p in shares.items()}
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), f(at).cast("bigint").alias("rank")) for k, at in places.items() for f in (F.floor, F.ceil)])
    held = ranges.withColumn("_wanted", F.filter(wanted, lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_rows"))))
    held = held.filter(F.size("_wanted") > 0).drop("_rows")
    inside = W.partitionBy(*by, "_range").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = values.join(held, [*by, "_range"]).withColumn("_to", F.col("_before") + F.sum("_n").over(inside))
    hit = F.filter("_wanted", lambda w: (w["rank"] >= F.col("_to") - F.col("_n")) & (w["rank"] < F.col("_to")))
    found = rows.withColumn("_w", F.explode(hit)).groupBy(*by).agg(F.max("_all").alias("_all"), *[
        f(F.when(F.col("_w.name") == k, F.col("_v"))).alias(f"_{side}_{k}") for k in shares for side, f in (("low", F.min), ("high", F.max))])

    def between(k: str) -> Column:
        at, low, high = places[k], F.col(f"_low_{k}"), F.col(f"_high_{k}")
        return F.when(low == high, low).otherwise(low * (F.ceil(at) - at) + high * (at - F.floor(at)))

    return found.select(*by, *[between(k).alias(k) for k in shares])

"""Gapless positions within groups of any size, without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def gapless(rows: DataFrame, group: str, order: Sequence[str | Column], out: str) -> DataFrame:
    """Add ``out``: 0, 1, 2, ... within ``group``, ordered by ``_block`` and then ``order``.

    ``group`` is never NULL. ``rows`` must be a written table with a column ``_block`` that cuts it into parts of bounded
    size (such as the partition that wrote the row). Rows are numbered inside (group, block); the
    numbers of earlier blocks come from a count per (group, block). A hot group is spread over all
    blocks, and the window over counts holds one row per block.
    """
    inside = W.partitionBy(group, "_block").orderBy(*order)
    before = W.partitionBy(group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select(F.col(group).alias("_g"), F.col("_block").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    match = (F.col(group) == F.col("_g")) & (F.col("_block") == F.col("_b"))
    return (numbered.join(bases, match)
            .withColumn(out, (F.col("_base") + F.col("_inside")).cast("bigint"))
            .drop("_g", "_b", "_base", "_inside"))

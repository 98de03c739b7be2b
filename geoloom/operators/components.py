"""Connected components and the run-length graph of positive raster pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import ROWS_PER_SALT, salted_join

COLUMN_BLOCK = 64


def _stars(edges: DataFrame, by: list[str]) -> DataFrame:
    """One large-star and one small-star step (Kiveris et al., SoCC 2014) on edges ``a > b``."""
    both = edges.unionByName(edges.select(*by, F.col("b").alias("a"), F.col("a").alias("b")))
    low = materialise(both.groupBy(*by, "a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("n")))
    large = salted_join(both, low.drop("n"), [*by, "a"], counts=low.drop("m"), rows_per_salt=ROWS_PER_SALT).filter("b > a").select(
        *by, F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    large = materialise(large)
    low = materialise(large.groupBy(*by, "a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")))
    linked = salted_join(large, low.drop("n"), [*by, "a"], counts=low.drop("m"), rows_per_salt=ROWS_PER_SALT).filter("b <> m").select(
        *by, F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(low.select(*by, "a", F.col("m").alias("b"))).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame, node_id: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``component`` (smallest node id of the component) to ``nodes``.

    ``edges``: ``by..., a, b`` in either direction. Rounds stop when the star forest
    no longer changes; the number of rounds grows with the logarithm of the size.
    """
    by = list(by)
    state = edges.filter("a <> b").select(
        *by, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = materialise(state)
    mark = (state.count(),)
    while True:
        state = materialise(_stars(state, by))
        seen = tuple(state.agg(F.count(F.lit(1)), F.sum(F.hash(*by, "a", "b").cast("bigint")),
                               F.bit_xor(F.xxhash64(*by, "a", "b"))).first())
        if seen == mark or seen[0] == 0:
            break
        mark = seen
    found = state.select(*by, F.col("a").alias(node_id), F.col("b").alias("component"))
    return nodes.join(found, [*by, node_id], "left").withColumn(
        "component", F.coalesce("component", node_id))


def runs(pixels: DataFrame, raster: str) -> DataFrame:
    """Horizontal runs of positive pixels ``(raster, row, c0, c1, prob_sum, prob_max)``.

    ``pixels``: ``raster, row, col, prob``. Lines are cut into column blocks so that a window
    holds at most one block; a run crossing a block border stays in pieces that touch.
    """
    block = F.floor(F.col("col") / COLUMN_BLOCK)
    line = W.partitionBy(raster, "row", "_block").orderBy("col")
    cut = pixels.select(raster, "row", "col", "prob").withColumn("_block", block)
    island = F.col("col") - F.row_number().over(line)
    return cut.withColumn("_island", island).groupBy(raster, "row", "_block", "_island").agg(
        F.min("col").alias("c0"), F.max("col").alias("c1"),
        F.sum(F.col("prob").cast("double")).alias("prob_sum"), F.max(F.col("prob").cast("double")).alias("prob_max"),
    ).drop("_island")


ROW_STEP = 1 << 31


def label_runs(run_table: DataFrame, raster: str) -> DataFrame:
    """4-connected components of runs: adds ``component``, the first pixel of the component as ``row * ROW_STEP + column``.

    Rasters may be of any width, and of different ones.

    Runs touch when they overlap in neighbouring rows, or are pieces of one run across a
    block border. The join keys include the block, so a long line of short runs never
    meets the whole of the next line.
    """
    nodes = run_table.withColumn("run_id", F.col("row").cast("bigint") * ROW_STEP + F.col("c0"))
    below = nodes.select(raster, (F.col("row") - 1).alias("row"), "_block", F.col("c0").alias("d0"),
                         F.col("c1").alias("d1"), F.col("run_id").alias("b"))
    touching = nodes.join(below, [raster, "row", "_block"]).filter("c0 <= d1 AND d0 <= c1")
    pieces = nodes.select(raster, "row", (F.col("c1") + 1).alias("c0"), F.col("run_id").alias("a"))
    beside = pieces.join(nodes.select(raster, "row", "c0", F.col("run_id").alias("b")), [raster, "row", "c0"])
    edges = touching.select(raster, F.col("run_id").alias("a"), "b").unionByName(beside.select(raster, "a", "b"))
    return connected_components(nodes, edges, "run_id", [raster]).drop("_block")

"""Nearest item by a pyramid of bins.

Items (points or segments) are put into square bins. A bin with at most ``LEAF_ITEMS`` items holds them; a denser one
is cut into 4 x 4 smaller ones, level after level, so a crowded spot is a small tree of its own. Above the
base level only which bins are occupied is kept.

Most rows find their item in the 3 x 3 bins around them, in one join. The others (nothing there, nothing near enough, or a dense bin) start at
the finest level whose 3 x 3 bins are occupied and walk down: on every level a row keeps the bins that may hold something
nearer than the farthest corner of its best bin, so it never meets the items of a crowd it is far from. The number of
levels grows with the logarithm of the extent.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import repeated

#: A bin with more items is cut, at most so many times (a millionth of the base bin's side).
LEAF_ITEMS, DEEPEST = 32, 10
BIN = ["_bx", "_by"]


@dataclass
class Items:
    """What is searched: rows ``_bx, _by, _item`` (an item in every bin it touches) for bins of side ``size`` and ``count`` items.

    ``meets(item, x0, y0, side)``: whether it touches a square; ``hit(item, x, y)``: a struct whose first field is the distance
    and whose order decides ties.
    """

    touched: DataFrame
    size: float
    meets: Callable[[Column, Column, Column, float], Column]
    hit: Callable[[Column, Column, Column], Column]


def _around(df: DataFrame, reach: int = 1) -> DataFrame:
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    return repeated(df.withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
                    .withColumns({"_bx": F.col("_bx") + F.col("_dx"), "_by": F.col("_by") + F.col("_dy")}).drop("_dx", "_dy"))


def _own_bin(df: DataFrame, size: float) -> DataFrame:
    return df.withColumns({"_bx": F.floor(F.col("x") / F.lit(size)).cast("bigint"), "_by": F.floor(F.col("y") / F.lit(size)).cast("bigint")})


def _nodes(items: Items) -> list[tuple[float, DataFrame, bool]]:
    """Bins of the base level and below: side, ``_bx, _by, _items`` (NULL in a bin that is cut further) and whether any is."""
    out, touched, side = [], materialise(items.touched), items.size
    for depth in range(DEEPEST + 1):
        dense = touched.groupBy(*BIN).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > LEAF_ITEMS).drop("_n")
        cut = depth < DEEPEST and not dense.isEmpty()
        if not cut:
            out.append((side, touched.groupBy(*BIN).agg(F.collect_list("_item").alias("_items")), False))
            return out
        dense = materialise(dense)
        leaves = touched.join(dense, BIN, "left_anti").groupBy(*BIN).agg(F.collect_list("_item").alias("_items"))
        out.append((side, leaves.unionByName(dense.withColumn("_items", F.lit(None)), allowMissingColumns=False), True))
        side /= 4
        quarter = F.sequence(F.lit(0), F.lit(3))
        inner = (touched.join(dense, BIN, "left_semi").withColumn("_dx", F.explode(quarter)).withColumn("_dy", F.explode(quarter))
                 .withColumns({"_bx": F.col("_bx") * 4 + F.col("_dx"), "_by": F.col("_by") * 4 + F.col("_dy")}))
        touched = materialise(inner.filter(items.meets(F.col("_item"), F.col("_bx") * side, F.col("_by") * side, side)).select(*BIN, "_item"))
    return out


def _gap(low: Column, side: float, at: Column) -> tuple[Column, Column]:
    """Smallest and largest distance along one axis from ``at`` to the interval that begins at ``low``."""
    high = low + side
    return F.greatest(low - at, at - high, F.lit(0.0)), F.greatest(at - low, high - at)


def _to_square(side: float) -> tuple[Column, Column]:
    """Squared smallest and largest distance from ``x, y`` to the bin."""
    (nx, fx), (ny, fy) = _gap(F.col("_bx") * side, side, F.col("x")), _gap(F.col("_by") * side, side, F.col("y"))
    return nx * nx + ny * ny, fx * fx + fy * fy


#: Squared distances are compared with this much room for rounding.
ROOM = 1 + 1e-8


def nearest(rows: DataFrame, row_id: str, items: Items, extent: float) -> DataFrame:
    """``rows`` (``x, y``) with ``_hit``, the smallest hit over all items. There is at least one item; ``row_id`` is unique; ``extent`` is the side of a
    square around rows and items."""
    nodes = [(side, materialise(df), cut) for side, df, cut in _nodes(items)]
    size, base, any_cut = nodes[0]
    smallest = lambda found, x, y: F.array_min(F.transform(found, lambda i: items.hit(i, x, y)))
    near = _around(base).groupBy(*BIN).agg(F.flatten(F.collect_list("_items")).alias("_near"), F.max(F.col("_items").isNull()).alias("_cut"))
    tried = _own_bin(rows, size).join(near, BIN, "left").withColumn("_hit", smallest(F.col("_near"), F.col("x"), F.col("y")))
    # Whatever lies outside the 3 x 3 bins is farther away than one side.
    done = ~F.coalesce("_cut", F.lit(False)) & F.coalesce(F.col("_hit").getField("dist_m") <= size, F.lit(False))
    tried = materialise(tried.withColumn("_done", done).drop(*BIN, "_near", "_cut"))
    pending = tried.filter("NOT _done").select(row_id, "x", "y")
    if pending.isEmpty():
        return tried.drop("_done")
    found = _walk(materialise(pending), row_id, nodes, items, extent, smallest)
    late = tried.filter("NOT _done").drop("_done", "_hit").join(found, row_id)
    return tried.filter("_done").drop("_done").unionByName(late)


def _walk(pending: DataFrame, row_id: str, nodes: list, items: Items, extent: float, smallest) -> DataFrame:
    """``row_id, _hit`` for rows that need more than the bins around them."""
    size = nodes[0][0]
    above = max(0, math.ceil(math.log(max(extent / size, 1), 4))) + 1
    occupied = nodes[0][1].select(*BIN).withColumn("_up", F.explode(F.sequence(F.lit(0), F.lit(above))))
    shifted = lambda df: df.withColumns({b: F.expr(f"shiftright({b}, 2 * _up)") for b in BIN})
    occupied = materialise(shifted(occupied).distinct())
    # The finest level whose 3 x 3 bins are occupied; a level whose bins hold everything always is.
    levels = shifted(_own_bin(pending, size).withColumn("_up", F.explode(F.sequence(F.lit(0), F.lit(above)))))
    hits = levels.join(_around(occupied).distinct(), [*BIN, "_up"], "left_semi").groupBy(row_id, "x", "y").agg(F.min("_up").alias("_up"))
    # From there every item within 3 bins may be the nearest: something lies within two sides along each axis.
    waiting = materialise(_around(shifted(_own_bin(hits, size)), 3))
    above = waiting.agg(F.max("_up")).first()[0]
    found: DataFrame | None = None
    here: DataFrame | None = None  # row, x, y, _bound (squared, of what is known so far), bin of the level
    for level in range(above, -len(nodes), -1):
        side = size * 4.0 ** level
        start = waiting.filter(F.col("_up") == level).drop("_up").withColumn("_bound", F.lit(float("inf"))) if level >= 0 else None
        if here is None:
            here = start
        elif start is not None:
            here = here.unionByName(start)
        known = occupied.filter(F.col("_up") == level).drop("_up").withColumn("_items", F.lit(None)) if level > 0 else nodes[-level][1]
        least, most = _to_square(side)
        met = here.join(known, BIN).withColumns({"_least": least, "_most": most})
        if level <= 0:
            met = met.withColumn("_hit", F.when(F.col("_items").isNotNull(), smallest(F.col("_items"), F.col("x"), F.col("y"))))
            reached = F.pow(F.col("_hit").getField("dist_m"), F.lit(2.0))
            met = met.withColumn("_most", F.coalesce(reached, F.col("_most"))).drop("_items")
        else:
            met = met.drop("_items")
        bound = F.least(F.col("_bound"), F.min("_most").over(W.partitionBy(row_id)))
        met = materialise(met.withColumn("_bound", bound).filter(F.col("_least") <= F.col("_bound") * ROOM))
        if level <= 0:
            hit = met.filter("_hit IS NOT NULL").select(row_id, "_hit")
            found = hit if found is None else found.unionByName(hit)
            if not nodes[-level][2]:
                break
            met = met.filter("_hit IS NULL").drop("_hit")
        quarter = F.sequence(F.lit(0), F.lit(3))
        here = (met.select(row_id, "x", "y", "_bound", (F.col("_bx") * 4).alias("_bx"), (F.col("_by") * 4).alias("_by"))
                .withColumn("_dx", F.explode(quarter)).withColumn("_dy", F.explode(quarter))
                .withColumns({"_bx": F.col("_bx") + F.col("_dx"), "_by": F.col("_by") + F.col("_dy")}).drop("_dx", "_dy"))
        here = repeated(here.filter(_to_square(side / 4)[0] <= F.col("_bound") * ROOM))
    return found.groupBy(row_id).agg(F.min("_hit").alias("_hit"))

"""Budget allocation, per-source sampling, negatives, splits and folds.

Random choices are orders by a hash of the row key and a seed: reproducible for
any partitioning, and the top bits of the hash cut a large group into even
ranges, so ranking a source that holds most of the data is not one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions import scalars as S
from geoloom.operators import spatial
from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import hash_bucket, ranked


def _window(by: Sequence[str]):
    # Rows here are one per source: the window never sees data rows.
    return W.partitionBy(*(list(by) or [F.lit(0)]))


def available(rows: DataFrame, source: str, by: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*by, source).agg(F.count(F.lit(1)).alias("available"))


def _total(total: int | Column) -> Column:
    return total if isinstance(total, Column) else F.lit(total)


def allocate_balanced(counts: DataFrame, total: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """Equal budgets; sources under the equal share give all, the rest split what is left once.

    ``counts``: ``by..., source, available`` → adds ``budget``.
    """
    w = _window(by)
    goal = _total(total) / F.count(F.lit(1)).over(w)
    c = counts.withColumn("_goal", goal).withColumn("_small", F.col("available") <= F.col("_goal"))
    used = F.coalesce(F.sum(F.when(F.col("_small"), F.col("available"))).over(w), F.lit(0))
    rest = F.count(F.when(~F.col("_small"), 1)).over(w)
    share = F.floor(F.try_divide((_total(total) - used).cast("double"), rest))
    return c.withColumn("budget", F.when(F.col("_small"), F.col("available")).otherwise(
        F.least(share, F.col("available"))).cast("bigint")).drop("_goal", "_small")


def allocate_proportional(counts: DataFrame, total: int | Column, by: Sequence[str] = ()) -> DataFrame:
    """``floor(available / all * total)`` per source."""
    grand = F.sum("available").over(_window(by))
    share = F.floor(F.try_divide(F.col("available").cast("double"), grand) * _total(total))
    return counts.withColumn("budget", F.coalesce(share, F.lit(0)).cast("bigint"))


def allocate_typed(counts: DataFrame, type_budgets: DataFrame, type_column: str, balanced: bool = True) -> DataFrame:
    """Either rule inside each type; types without a budget get nothing.

    ``type_budgets``: ``type_column, type_budget``.
    """
    joined = counts.join(type_budgets, type_column)
    rule = allocate_balanced if balanced else allocate_proportional
    return rule(joined, F.col("type_budget"), [type_column])


def allocate_negatives(counts: DataFrame, total_negative: int | Column | None = None, ratio: float | None = None) -> DataFrame:
    """Negatives per source in proportion to its positives, at least one. ``ratio`` sets the total from the positives."""
    positives = F.sum("available").over(_window(()))
    total = F.floor(positives * F.lit(float(ratio))) if ratio is not None else _total(total_negative)
    share = F.floor(F.col("available").cast("double") / positives * total)
    return counts.filter("available > 0").withColumn("budget", F.greatest(F.lit(1), share).cast("bigint"))


COUNT_BLOCK = 1024


def spread_counts(rows: DataFrame, n: Column, out: str) -> DataFrame:
    """Every row ``n`` times, numbered 1 to ``n`` in ``out``: blocks first, dealt over all tasks, then their numbers."""
    blocks = rows.withColumn("_n", n.cast("bigint")).withColumn(
        "_b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COUNT_BLOCK))))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = F.col("_b") * COUNT_BLOCK + 1
    last = F.least(F.col("_n"), (F.col("_b") + 1) * COUNT_BLOCK)
    return blocks.repartition(tasks).withColumn(out, F.explode(F.sequence(first, last))).drop("_n", "_b")


def sample_per_source(rows: DataFrame, budgets: DataFrame, by: Sequence[str], order: Column,
                      bucket: Column | None = None) -> DataFrame:
    """``budget`` rows per group in hash order; groups smaller than their budget repeat rows.

    Adds ``draw``. Without replacement draws are ranks 1..budget; with it, draw ``d`` takes
    the row at rank ``1 + (d - 1) mod size``. ``order`` must be unique per group and
    ``bucket`` an index that grows with it (default: the top bits of a 64-bit hash).
    """
    by = list(by)
    keyed = rows.join(budgets.select(*by, "budget"), by).withColumn("_order", order)
    keyed = keyed.withColumn("_slice", hash_bucket(F.col("_order"), rows.count()) if bucket is None else bucket)
    out = ranked(keyed, "_order", "_rank", by=by, bucket=F.col("_slice"))
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_size"))
    out = out.join(sizes, by).filter(F.col("_rank") <= F.col("budget"))
    # Repeats of one row are made in blocks, so that no row holds a list as long as the budget.
    laps = F.floor((F.col("budget") - F.col("_rank")) / F.col("_size")) + 1
    out = spread_counts(out, laps, "_lap").withColumn("draw", (F.col("_rank") + (F.col("_lap") - 1) * F.col("_size")).cast("bigint"))
    return out.drop("_lap", "_order", "_rank", "_size", "_slice", "budget")


def jitter_positions(rows: DataFrame, key: Sequence[str], jitter_m: float = 50.0, seed: int = 42,
                     lon: str = "center_lon", lat: str = "center_lat",
                     uniform: tuple[Column, Column] | None = None) -> DataFrame:
    """Uniform shift of up to ``jitter_m`` in both directions, in degrees of 111 km.

    ``uniform`` replaces the hash of the key by two given columns in [0, 1).
    """
    if jitter_m == 0:
        return rows
    span = jitter_m / 111000.0
    keys = [F.col(k) for k in key]
    u = uniform or (S.hash_uniform(*keys, seed=seed), S.hash_uniform(*keys, seed=seed + 1))
    return rows.withColumns({lon: F.col(lon) + (2 * u[0] - 1) * span, lat: F.col(lat) + (2 * u[1] - 1) * span})


def negative_candidates(budgets: DataFrame, source: str, attempts: int = 20, seed: int = 42,
                        uniform: tuple[Column, Column] | None = None) -> DataFrame:
    """``budget * attempts`` uniform points per source bounds row (``west, south, east, north``).

    ``uniform`` replaces the hash of source and ``attempt`` by two given columns in [0, 1).
    """
    draws = spread_counts(budgets.filter("budget > 0"), F.col("budget") * attempts, "attempt")
    u = uniform or tuple(S.hash_uniform(F.col(source), F.col("attempt"), seed=seed + salt) for salt in (0, 1))
    return draws.withColumns({"center_lon": F.col("west") + u[0] * (F.col("east") - F.col("west")),
                              "center_lat": F.col("south") + u[1] * (F.col("north") - F.col("south"))})


def sample_negative_points(draws: DataFrame, stations: DataFrame, source: str, min_distance_m: float = 500.0) -> DataFrame:
    """First ``budget`` draws per source at least the distance from any station.

    ``draws``: ``source, attempt, x, y, budget`` in metres. Draws do not depend on each other,
    so filtering all of them equals drawing until enough are accepted. Adds ``draw``.
    """
    free = spatial.anti_join_within(draws, stations, min_distance_m, inclusive=False)
    limit = F.floor(F.col("attempt") / 4096)
    out = ranked(free, "attempt", "draw", by=[source], bucket=limit)
    return out.filter(F.col("draw") <= F.col("budget"))


def split_assignment(groups: DataFrame, group: str, order: Column, test: Sequence[str] = (), val: Sequence[str] = (),
                     test_fraction: float = 0.15, val_fraction: float = 0.15) -> DataFrame:
    """``group → split`` for a geographic split. ``groups`` has one row per group.

    Explicit groups come first; the rest are shuffled by ``order`` and fill test, then
    validation, up to ``max(1, floor(n * fraction))`` of all groups.
    """
    fixed = F.when(F.col(group).isin(*val) if val else F.lit(False), "val").when(
        F.col(group).isin(*test) if test else F.lit(False), "test")
    g = groups.withColumn("_fixed", fixed).withColumn("_order", order)
    size = g.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_fixed") == "test").alias("t"),
                          F.count_if(F.col("_fixed") == "val").alias("v"))).scalar()
    # One row per county or region; the row data is never in this window.
    place = F.row_number().over(W.partitionBy(F.col("_fixed").isNull()).orderBy("_order", group))
    g = g.withColumns({"_place": place, "_s": size})
    need = lambda fraction, have: F.greatest(
        F.lit(0), F.greatest(F.lit(1), F.floor(F.col("_s.n") * fraction)) - F.col(f"_s.{have}"))
    n_test, n_val = need(test_fraction, "t"), need(val_fraction, "v")
    auto = F.when(F.col("_place") <= n_test, "test").when(F.col("_place") <= n_test + n_val, "val").otherwise("train")
    return g.select(group, F.coalesce("_fixed", auto).alias("split"))


def join_split_assignment(rows: DataFrame, assignment: DataFrame, group: str) -> DataFrame:
    return rows.join(assignment, group, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def assign_splits_geographic(rows: DataFrame, group: str, order: Column | None = None, seed: int = 42, **kw) -> DataFrame:
    """All rows of a county or region go to one split."""
    groups = rows.select(group).distinct()
    order = S.hash_order(F.col(group), seed=seed) if order is None else order
    return join_split_assignment(rows, split_assignment(groups, group, order, **kw), group)


def assign_splits_random(rows: DataFrame, order: str, bucket: Column | None = None, test_fraction: float = 0.15,
                         val_fraction: float = 0.15) -> DataFrame:
    """Rows in ``order`` (unique): first the test share, then validation, then train."""
    n = rows.agg(F.count(F.lit(1))).scalar()
    out = ranked(rows, order, "_rank", bucket=bucket).withColumn("_n", n)
    share = lambda f: F.greatest(F.lit(1), F.floor(F.col("_n") * f))
    split = F.when(F.col("_rank") <= share(test_fraction), "test").when(
        F.col("_rank") <= share(test_fraction) + share(val_fraction), "val").otherwise("train")
    return out.withColumn("split", split).drop("_rank", "_n")


def renumber(rows: DataFrame, order: str, out: str, **kw) -> DataFrame:
    """0-based ids in ``order`` (unique)."""
    return ranked(rows, order, out, **kw).withColumn(out, F.col(out) - 1)


def validation_sample(rows: DataFrame, order: Column, target: int = 200) -> DataFrame:
    """Rows to check: ``target`` rows in hash order, or all of them when there are fewer."""
    return rows.withColumn("_order", order).orderBy("_order").limit(target).drop("_order")


def assign_group_folds(rows: DataFrame, group: str, n_folds: int = 5, positive: str = "target") -> DataFrame:
    """Fold per group so that no group is on both sides; groups are dealt out by their positive share.

    Groups are sorted by positive share and dealt back and forth over the folds.
    """
    stats = rows.groupBy(group).agg(F.avg(positive).alias("_share"), F.count(F.lit(1)).alias("_n"))
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("_share"), F.desc("_n"), group)) - 1
    lap, seat = F.floor(place / n_folds), place % n_folds
    folds = stats.withColumn("fold", F.when(lap % 2 == 0, seat).otherwise(n_folds - 1 - seat).cast("int"))
    return rows.join(folds.select(group, "fold"), group)


def newest_item_per_point(points: DataFrame, items: DataFrame, point_id: str, bin_size: float,
                          first_year: int, last_year: int) -> DataFrame:
    """Newest catalogue item covering each point. ``items``: ``item_id, x0, y0, x1, y1, taken``.

    Items are numbered from the oldest to the newest first, so that the largest number per point is kept by hash; by date and id, every pair of
    point and item would be sorted, in as few tasks as the files ask for. Points are spread over all tasks by bin.
    """
    dated = items.filter(F.year("taken").between(first_year, last_year)).withColumn("_order", F.struct("taken", "item_id"))
    placed = materialise(ranked(dated, "_order", "_place").drop("_order"))
    covering = spatial.point_box_join(points, placed.drop("item_id", "taken"), bin_size, heavy=True)
    newest = covering.groupBy(point_id).agg(F.max("_place").alias("_place"))
    return newest.join(placed.select("_place", "item_id", "taken"), "_place").select(point_id, "item_id", "taken")


def first_tile_wins(patches: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One patch per ground cell, from the first tile in ``order`` (smallest struct).

    An aggregate with map-side combine, so a cell covered by very many tiles is no problem.
    Unreadable patches must be filtered out before.
    """
    first = F.min_by(F.struct(*[c for c in patches.columns if c not in key]), F.struct(*order))
    return patches.groupBy(*key).agg(first.alias("_p")).select(*key, "_p.*")


def distinct_patches(patches: DataFrame, patch_id: str, order: Sequence[Column]) -> DataFrame:
    """First row per patch id."""
    return first_tile_wins(patches, [patch_id], order)


def catalog_search(items: DataFrame, bbox: tuple[float, float, float, float], first_year: int, last_year: int,
                   limit: int = 300) -> DataFrame:
    """Items meeting the box and the years, newest first. ``items``: ``item_id, x0, y0, x1, y1, taken``."""
    x0, y0, x1, y1 = bbox
    hit = ((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))
    return items.filter(hit & F.year("taken").between(first_year, last_year)).orderBy(
        F.desc("taken"), "item_id").limit(limit)


def require_items(items: DataFrame) -> DataFrame:
    if items.isEmpty():
        raise ValueError("no catalogue items match the search")
    return items

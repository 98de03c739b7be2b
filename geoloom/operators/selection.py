"""Order-dependent selection: spaced subsets, duplicate removal, clustering.

Rows without a position are near nothing and always kept. Everything else runs in rounds over
the still undecided rows. Rows are binned so that
bin mates are always within the radius of each other: only one row per bin can
be chosen in a round, so a round compares bins with neighbouring bins and each
row with the few chosen rows around it. No pair list is ever built, and a spot
that holds a large share of the data costs one comparison per row. A round ends with a local step:
square tiles of bounded row count are scanned serially, which decides all but what hangs on rows
beyond the tile's border. Tiles grow from round to round while their rows allow, so that chains of
neighbouring rows take a handful of rounds and not one round per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import geometry as G
from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import ROWS_PER_SALT, salted_join
from geoloom.operators.spatial import BIN, _sure_side, around, polyline_distance_join, nearest_join, with_bin


TILE_ROWS = 200_000
FIRST_TILE, TILE_STEP, MOST_BINS = 64, 8, 1 << 40
#: Bins between the groups of ``by``: a multiple of every tile's, so that no tile and no neighbourhood has two groups.
GROUP_BINS = 1 << 42


def _with_groups(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add ``_g``, a number per group (at most two million); NULLs are a group of their own."""
    if not by:
        return rows
    key = F.to_json(F.struct(*by))
    numbers = rows.select(key.alias("_group")).distinct().withColumn("_g", F.row_number().over(W.orderBy("_group")).cast("bigint"))
    return rows.withColumn("_group", key).join(materialise(numbers), "_group").drop("_group")


def _binned(rows: DataFrame, side: float) -> DataFrame:
    """Rows with their bin; those of one group lie far from those of another, whatever their places."""
    out = with_bin(rows, side)
    return out.withColumn("_bx", F.col("_bx") + F.col("_g") * GROUP_BINS) if "_g" in rows.columns else out


def _placed(rows: DataFrame) -> Column:
    """Whether a row has a position."""
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)


class _Tiles:
    """The local step: serial scans of tiles that grow from round to round."""

    def __init__(self, side: float, reach: float, scan):
        self.bins, self.side, self.reach, self.scan = FIRST_TILE, side, reach, scan

    def settle(self, undecided: DataFrame, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
        """``undecided`` (a written table) with ``_state``: 1 kept, 0 dropped, NULL still open; ``order`` is the scan's order.

        Tiles with too many rows for one task are left open.
        """
        def tile(bins: int) -> list[Column]:
            # Off the axes, and at another place for every size, so that no row lies at a border in every round.
            return [F.floor((F.col(b) + bins // 3) / bins) for b in BIN]

        wider = self.bins * TILE_STEP
        if wider < MOST_BINS and undecided.groupBy(*tile(wider)).count().agg(F.max("count")).first()[0] <= TILE_ROWS:
            self.bins = wider
        bins, side, reach, scan = self.bins, self.side, self.reach, self.scan
        size = bins * side
        names = ["_tx", "_ty"]
        tiled = undecided.withColumns(dict(zip(names, tile(bins))))
        counts = tiled.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
        fit = salted_join(tiled, counts.filter(F.col("n") <= TILE_ROWS).drop("n"), names, "left_semi", counts=counts)
        together = fit.repartition(int(undecided.sparkSession.conf.get("spark.sql.shuffle.partitions")), *names).sortWithinPartitions(*names, *order)
        sent = together.select(*names, "x", "y", *columns, F.struct("_id").alias("_key"))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            now = None
            for b in batches:
                tx, ty = b.column(0).to_pylist(), b.column(1).to_pylist()
                cuts = [i for i in range(1, len(tx)) if (tx[i], ty[i]) != (tx[i - 1], ty[i - 1])]
                for first, end in zip([0, *cuts], [*cuts, len(tx)]):
                    if end == first:
                        continue
                    if held and now != (tx[first], ty[first]):
                        yield decided(held, now)
                        held = []
                    now = (tx[first], ty[first])
                    held.append(b.slice(first, end - first))
            if held:
                yield decided(held, now)

        def decided(parts: list[pa.RecordBatch], at: tuple[int, int]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            x, y = rows.column("x").to_pylist(), rows.column("y").to_pylist()
            column = at[0] - round(at[0] * bins / GROUP_BINS) * (GROUP_BINS // bins)  # in the group's own plane
            low_x, low_y = column * size - bins // 3 * side, at[1] * size - bins // 3 * side
            inner = [min(a - low_x, low_x + size - a, b - low_y, low_y + size - b) > reach for a, b in zip(x, y)]
            state = scan(x, y, inner, *[rows.column(c).to_pylist() for c in columns])
            return pa.RecordBatch.from_arrays([rows.column("_key").combine_chunks() if rows.num_rows else pa.nulls(0), pa.array(state, pa.int32())],
                                              names=["_key", "_state"])

        found = sent.mapInArrow(each, T.StructType([sent.schema["_key"], T.StructField("_state", T.IntegerType())]))
        settled = found.filter("_state IS NOT NULL").select(F.col("_key._id").alias("_id"), "_state")
        return materialise(undecided.join(settled, "_id", "left"))


def _around(cells: dict, x: float, y: float, side: float) -> Iterator[int]:
    """Row numbers held in the 3x3 cells around a point."""
    cx, cy = math.floor(x / side), math.floor(y / side)
    for i in (cx - 1, cx, cx + 1):
        for j in (cy - 1, cy, cy + 1):
            yield from cells.get((i, j), ())


def _scan_spaced(radius: float, inclusive: bool):
    """Rows best first: a row in range of a kept one goes; one that may hang on an open row stays open."""
    def scan(x, y, inner):
        kept: dict = {}
        waiting: dict = {}
        out = []
        for k, (a, b) in enumerate(zip(x, y)):
            def near(cells, a=a, b=b):
                return any((d <= radius if inclusive else d < radius) for d in (
                    math.sqrt((x[j] - a) * (x[j] - a) + (y[j] - b) * (y[j] - b)) for j in _around(cells, a, b, radius)))
            at = (math.floor(a / radius), math.floor(b / radius))
            if near(kept):
                out.append(0)
            elif not inner[k] or near(waiting):
                waiting.setdefault(at, []).append(k)
                out.append(None)
            else:
                kept.setdefault(at, []).append(k)
                out.append(1)
        return out
    return scan


def _scan_detections(radius: float):
    """Rows by id: one takes its turn once no open row lies within twice the distance."""
    def scan(x, y, inner, conf):
        cells: dict = {}
        for k, (a, b) in enumerate(zip(x, y)):
            cells.setdefault((math.floor(a / radius), math.floor(b / radius)), []).append(k)
        waiting: dict = {}
        state: list = [None] * len(x)
        for k, (a, b) in enumerate(zip(x, y)):
            if state[k] == 0:
                continue
            blocked = any(math.hypot(x[j] - a, y[j] - b) <= 2 * radius * (1 + 1e-9) for j in _around(waiting, a, b, 2 * radius))
            if blocked or not inner[k]:
                waiting.setdefault((math.floor(a / (2 * radius)), math.floor(b / (2 * radius))), []).append(k)
                continue
            later = sorted(j for j in _around(cells, a, b, radius) if j > k and state[j] is None
                           and math.sqrt((x[j] - a) * (x[j] - a) + (y[j] - b) * (y[j] - b)) <= radius)
            # The first more confident row ends the turn; what comes before it goes.
            stop = next((j for j in later if conf[j] > conf[k]), None)
            state[k] = 1 if stop is None else 0
            for j in later if stop is None else later[:later.index(stop)]:
                state[j] = 0
        return state
    return scan


def _near(radius: float, inclusive: bool):
    def test(centre: Column) -> Column:
        d = G.distance(F.col("x"), F.col("y"), centre["x"], centre["y"])
        return d <= radius if inclusive else d < radius
    return test


def _with_centres(rows: DataFrame, centres: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Add ``_near``: the centres in the 5x5 bins around each binned row.

    Centres are farther apart than the radius, so the list has a small fixed bound.
    """
    fields = [c for c in centres.columns if c not in BIN]
    reach = around(centres, 2).groupBy(*BIN).agg(F.collect_list(F.struct(*fields)).alias("_near"))
    return salted_join(rows, reach, BIN, "left", counts=counts, rows_per_salt=ROWS_PER_SALT)


def _fewer(before: int, rows: int) -> int:
    if rows >= before:
        raise RuntimeError("a round decided nothing: ids must be unique and positions finite")
    return rows


def spaced_ids(points: DataFrame, point_id: str, radius: float, priority: Sequence[Column] = (),
               inclusive: bool = True) -> DataFrame:
    """Ids (with x, y, and ``_g`` where given) kept by "take the best remaining row, drop everything in range, repeat".

    ``priority`` columns: larger goes first, ties by smaller id. Taking a row that
    beats every undecided row around it gives the same set as the serial scan, so
    all such rows are taken at once (Blelloch, Fineman and Shun, SPAA 2012).
    """
    rank = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(priority)], (-F.col(point_id)).alias("o"))
    group = [c for c in ("_g",) if c in points.columns]
    every = points.select(F.col(point_id).alias("_id"), "x", "y", rank.alias("_rank"), *group)
    side = _sure_side(radius)
    undecided = materialise(_binned(every.filter(_placed(every)), side))
    near, tiles = _near(radius, inclusive), _Tiles(side, radius, _scan_spaced(radius, inclusive))
    kept = [every.filter(~_placed(every)).select(F.col("_id").alias(point_id), "x", "y", *group)]
    rows = undecided.count()
    while rows:
        best = undecided.groupBy(*BIN).agg(
            F.max(F.struct("_rank", "_id", "x", "y")).alias("c"), F.count(F.lit(1)).alias("n"))
        top = around(best.select(*BIN, F.col("c._rank").alias("r")), 2).groupBy(*BIN).agg(F.max("r").alias("top"))
        chosen = best.join(top, BIN).filter("c._rank = top").select(*BIN, "c._id", "c.x", "c.y")
        seen = _with_centres(undecided, chosen, best.select(*BIN, "n"))
        took = F.coalesce(F.exists("_near", lambda c: c["_id"] == F.col("_id")), F.lit(False))
        lost = F.coalesce(F.exists("_near", near), F.lit(False))
        left = materialise(seen.withColumn("_kept", took).filter(took | ~lost).drop("_near"))
        kept.append(left.filter("_kept").select(F.col("_id").alias(point_id), "x", "y", *group))
        undecided = left.filter("NOT _kept").drop("_kept")
        if undecided.isEmpty():
            break
        settled = tiles.settle(undecided, [F.desc("_rank")], [])
        kept.append(settled.filter("_state = 1").select(F.col("_id").alias(point_id), "x", "y", *group))
        undecided = settled.filter("_state IS NULL").drop("_state")
        rows = _fewer(rows, undecided.count())
    return reduce(DataFrame.unionByName, kept)


def greedy_spaced_select(points: DataFrame, point_id: str, radius: float,
                         priority: Sequence[Column] = (), inclusive: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``points`` kept by :func:`spaced_ids`, each group of ``by`` on its own."""
    kept = spaced_ids(_with_groups(points, by), point_id, radius, priority, inclusive).select(point_id)
    return points.join(kept, point_id, "left_semi")


def dedup_features(features: DataFrame, point_id: str, tolerance_m: float = 100.0, by: Sequence[str] = ()) -> DataFrame:
    """Drop near-duplicate features scanning in id order; a polygon beats an earlier point. With ``by`` (a county, before a
    union of counties) every group is scanned on its own, and a pair across a border keeps both.

    Rows have ``x, y`` (centroid) and ``is_polygon``. The scan takes each row not yet
    dropped: a later row in range is dropped, except that a point meeting a later
    polygon drops itself instead (and still goes on dropping later rows). So:

    * polygons that take their turn are the spaced subset of the polygons, by id;
    * points that take their turn are the spaced subset, by id, of the points no
      earlier such polygon drops;
    * of those points, one is dropped by a later polygon in range that has not yet
      been dropped itself when the point's turn comes.
    """
    side, near = _sure_side(tolerance_m), _near(tolerance_m, False)
    grouped = _with_groups(features, by)
    rows = grouped.select(F.col(point_id).alias("_id"), "x", "y", "is_polygon", *[c for c in ("_g",) if by])
    polygons, points = rows.filter("is_polygon"), rows.filter("NOT is_polygon")
    active_polygons = _binned(spaced_ids(polygons, "_id", tolerance_m, inclusive=False), side)
    seen = _with_centres(_binned(points, side), active_polygons.withColumnRenamed("_id", "k"))
    earlier = F.coalesce(F.exists("_near", lambda c: near(c) & (c["k"] < F.col("_id"))), F.lit(False))
    active_points = spaced_ids(seen.filter(~earlier).drop("_near", *BIN), "_id", tolerance_m, inclusive=False)
    active_points = _binned(active_points, side)
    judged = _with_centres(_binned(polygons, side), active_polygons.withColumnRenamed("_id", "k"))
    killer = F.array_min(F.transform(
        F.filter("_near", lambda c: near(c) & (c["k"] < F.col("_id"))), lambda c: c["k"]))
    judged = judged.withColumn("_dropped_at", killer).drop("_near")
    meets = _with_centres(judged, active_points.withColumnRenamed("_id", "i"))
    victims = meets.select(F.explode(F.filter("_near", lambda c: (
        near(c) & (c["i"] < F.col("_id"))
        & F.coalesce(F.col("_dropped_at") > c["i"], F.lit(True))))).alias("v")).select(
            F.col("v.i").alias("_id")).distinct()
    kept = active_polygons.select("_id").unionByName(
        active_points.select("_id").join(victims, "_id", "left_anti"))
    return features.join(kept.withColumnRenamed("_id", point_id), point_id, "left_semi")


def dedup_features_priority(features: DataFrame, point_id: str, tolerance_m: float = 100.0) -> DataFrame:
    """Simpler rule: polygons first, then smaller ids."""
    return greedy_spaced_select(features, point_id, tolerance_m,
                                [F.col("is_polygon").cast("int")], inclusive=False)


def dedup_detections_priority(detections: DataFrame, point_id: str, min_dist_m: float = 100.0) -> DataFrame:
    """Keep the most confident detection of every neighbourhood (ties: smaller id)."""
    return greedy_spaced_select(detections, point_id, min_dist_m, [F.col("mean_confidence")])


def dedup_detections(detections: DataFrame, point_id: str, min_dist_m: float = 100.0, by: Sequence[str] = ()) -> DataFrame:
    """Drop near-duplicate detections scanning in id order, each group of ``by`` on its own.

    Each row not yet dropped drops the later rows in range, in id order, until it
    meets a more confident one; then it drops itself and stops.

    A round lets every row take its turn that has the smallest id within twice the
    distance: nothing still undecided can change what it sees. A row is in range of
    at most one of them. Rounds go on until no row is left, so the result is exact;
    the count depends on how long the chains of overlapping rows are.
    """
    side, near = _sure_side(min_dist_m), _near(min_dist_m, True)
    every = _with_groups(detections, by)
    every = every.select(F.col(point_id).alias("_id"), "x", "y", F.col("mean_confidence").alias("_conf"), *[c for c in ("_g",) if by])
    undecided = materialise(_binned(every.filter(_placed(every)), side))
    kept, rows = [every.filter(~_placed(every)).select(F.col("_id").alias(point_id))], undecided.count()
    tiles = _Tiles(side, 2 * min_dist_m, _scan_detections(min_dist_m))
    while rows:
        first = undecided.groupBy(*BIN).agg(
            F.min(F.struct("_id", "x", "y", "_conf")).alias("c"), F.count(F.lit(1)).alias("n"))
        least = around(first.select(*BIN, F.col("c._id").alias("i")), 3).groupBy(*BIN).agg(F.min("i").alias("low"))
        heads = first.join(least, BIN).filter("c._id = low").select(*BIN, "c._id", "c.x", "c.y", "c._conf")
        seen = _with_centres(undecided, heads, first.select(*BIN, "n"))
        seen = seen.withColumn("_head", F.try_element_at(F.filter("_near", near), F.lit(1))).drop("_near")
        stop = seen.filter("_head IS NOT NULL").groupBy(F.col("_head._id").alias("_hid")).agg(
            F.min(F.when(F.col("_conf") > F.col("_head._conf"), F.col("_id"))).alias("_stop"),
            F.count(F.lit(1)).alias("n"))
        turn = salted_join(seen.withColumn("_hid", F.col("_head._id")), stop.drop("n"), ["_hid"], "left",
                           counts=stop.select("_hid", "n"), rows_per_salt=ROWS_PER_SALT)
        is_head = F.col("_id") == F.col("_hid")
        dropped = F.when(is_head, F.col("_stop").isNotNull()).otherwise(
            (F.col("_conf") <= F.col("_head._conf")) & (F.col("_stop").isNull() | (F.col("_id") < F.col("_stop"))))
        left = materialise(turn.filter(~F.coalesce(dropped, F.lit(False)))
                           .withColumn("_kept", F.coalesce(is_head, F.lit(False)))
                           .select("_id", "x", "y", "_conf", *BIN, "_kept"))
        kept.append(left.filter("_kept").select(F.col("_id").alias(point_id)))
        undecided = left.filter("NOT _kept").drop("_kept")
        if undecided.isEmpty():
            break
        settled = tiles.settle(undecided, [F.col("_id")], ["_conf"])
        kept.append(settled.filter("_state = 1").select(F.col("_id").alias(point_id)))
        undecided = settled.filter("_state IS NULL").drop("_state")
        rows = _fewer(rows, undecided.count())
    return detections.join(reduce(DataFrame.unionByName, kept), point_id, "left_semi")


def assign_to_seeds(cells: DataFrame, cell_id: str, seeds: DataFrame, radius: float,
                    priority: Sequence[str]) -> DataFrame:
    """Cells with the ``seed`` they join: the best-ranked seed in range (larger priority, then smaller id)."""
    side, near = _sure_side(radius), _near(radius, True)
    centres = with_bin(seeds.select(F.col(cell_id).alias("_sid"), "x", "y", *priority), side)
    seen = _with_centres(with_bin(cells, side), centres)
    order = F.array_max(F.transform(F.filter("_near", near), lambda c: F.struct(
        *[c[p].alias(p) for p in priority], (-c["_sid"]).alias("o"))))
    return seen.withColumn("seed", -order["o"]).drop("_near", *BIN)


def cluster_constrained(cells: DataFrame, stations: DataFrame, segments: DataFrame | None,
                        cluster_radius_m: float = 15000.0) -> DataFrame:
    """Group out-of-reach cells around the largest remaining demand.

    ``cells``: ``cell_id, x, y, demand_kw``. Each seed is the largest remaining cell and
    takes every remaining cell in range, which is the same as every cell joining its
    best-ranked seed in range.
    """
    seeds = cells.join(spaced_ids(cells, "cell_id", cluster_radius_m, [F.col("demand_kw")]).select("cell_id"),
                       "cell_id", "left_semi")
    joined = assign_to_seeds(cells, "cell_id", seeds, cluster_radius_m, ["demand_kw"])
    weight, total = F.col("demand_kw"), F.sum("demand_kw")
    clusters = joined.groupBy("seed").agg(
        F.count(F.lit(1)).alias("n_cells"), total.alias("total"),
        F.coalesce(F.try_divide(F.sum(F.col("x") * weight), total), F.avg("x")).alias("x"),
        F.coalesce(F.try_divide(F.sum(F.col("y") * weight), total), F.avg("y")).alias("y"))
    measured = nearest_join(clusters, stations, "seed", "sub_id").withColumnRenamed("dist_m", "sub_m").drop("sub_id")
    if segments is None:
        measured = measured.withColumn("tx_m", F.col("sub_m"))
    else:
        measured = polyline_distance_join(measured, segments, "seed").withColumnRenamed("dist_m", "tx_m")
    km = F.greatest(F.col("tx_m") / 1000, F.lit(1.0))
    return measured.select(
        "seed", "x", "y", "n_cells", F.bround("total", 0).alias("cluster_demand_kw"),
        F.bround(F.col("tx_m") / 1000, 1).alias("dist_to_tx_km"),
        F.bround(F.col("sub_m") / 1000, 1).alias("dist_to_sub_km"),
        F.bround(F.col("total") / km, 1).alias("score"))


def rank_expansion_clusters(clusters: DataFrame, min_demand_kw: float = 300.0, top_n: int = 10) -> DataFrame:
    return clusters.filter(F.col("cluster_demand_kw") >= min_demand_kw).orderBy(
        F.desc("score"), F.asc("seed")).limit(top_n)


def random_regions(draws: DataFrame, draw_id: str, n_regions: int, half_width: float, half_height: float,
                   min_distance: float) -> DataFrame:
    """First ``n_regions`` draws that keep their distance from every region accepted before.

    ``draws``: candidate centres ``x, y`` numbered in draw order. Units follow the draws
    (degrees for longitude/latitude centres).
    """
    accepted = spaced_ids(draws, draw_id, min_distance, inclusive=False)
    chosen = accepted.orderBy(draw_id).limit(n_regions)
    return chosen.select(draw_id, (F.col("x") - half_width).alias("west"), (F.col("y") - half_height).alias("south"),
                         (F.col("x") + half_width).alias("east"), (F.col("y") + half_height).alias("north"))

"""Queries on sampling, splits, evaluation, quality, scalar rules, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import scalars as S
from geoloom.operators import evaluate, grids, quality, sampling
from geoloom.operators.skew import spread
from geoloom.plans.fixtures import fixture, patch_arrays, table
from geoloom.plans.jobs import eval_set_job, patch_index_job
from geoloom.plans.registry import query, rounded, scratch
from geoloom.plans.spatial_queries import building_table, dist, rect_table
from geoloom.sources import ranges, readers, sinks

KEYS_PER_LAP = 100003


def patches(spark, sf):
    return fixture(spark, sf, "patches")


def order():
    """Injectable order: unique, and reproducible in SQL."""
    return F.col("order_lap") * KEYS_PER_LAP + F.col("order_key")


def slices():
    return F.floor(F.col("order_lap") * 64 + F.col("order_key") * 64 / KEYS_PER_LAP)


ORDER = f"(order_lap * {KEYS_PER_LAP} + order_key)"

# --- budgets and sampling ---------------------------------------------------------------

AVAILABLE = "SELECT county_id, count(*) AS available FROM fx_scores GROUP BY county_id"


def county_counts(spark, sf):
    return sampling.available(fixture(spark, sf, "scores"), "county_id")


@query("allocate_balanced", "scores", f"""SELECT county_id, available, CAST(CASE WHEN available <= goal THEN available ELSE
    least(floor((8000 - used) / rest), available) END AS BIGINT) AS budget FROM (SELECT *, coalesce(sum(CASE WHEN available <= goal
    THEN available END) OVER (), 0) AS used, count(CASE WHEN available > goal THEN 1 END) OVER () AS rest FROM (SELECT *,
    8000 / count(*) OVER () AS goal FROM ({AVAILABLE}) a) b) c""")
def allocate_balanced(spark, sf):
    return sampling.allocate_balanced(county_counts(spark, sf), 8000)


@query("allocate_proportional", "scores", f"""SELECT county_id, available, CAST(floor(CAST(available AS DOUBLE) / sum(available) OVER () * 8000) AS BIGINT) AS budget
    FROM ({AVAILABLE}) a""")
def allocate_proportional(spark, sf):
    return sampling.allocate_proportional(county_counts(spark, sf), 8000)


TYPED = """SELECT a.*, t.type_budget FROM (SELECT substation_type, county_geoid, count(*) AS available FROM fx_patches
    GROUP BY substation_type, county_geoid) a JOIN (SELECT lang AS substation_type, CAST(floor(count(*) / 2) AS BIGINT) AS type_budget
    FROM documents GROUP BY lang) t ON a.substation_type = t.substation_type"""


@query("allocate_typed", "patches", f"""SELECT substation_type, county_geoid, available, type_budget, CAST(CASE WHEN available <= goal THEN available ELSE
    least(floor((type_budget - used) / rest), available) END AS BIGINT) AS budget FROM (SELECT *, coalesce(sum(CASE WHEN available <= goal
    THEN available END) OVER (PARTITION BY substation_type), 0) AS used, count(CASE WHEN available > goal THEN 1 END) OVER
    (PARTITION BY substation_type) AS rest FROM (SELECT *, type_budget / count(*) OVER (PARTITION BY substation_type) AS goal FROM ({TYPED}) a) b) c""")
def allocate_typed(spark, sf):
    budgets = table(spark, sf, "documents").groupBy(F.col("lang").alias("substation_type")).agg(
        F.floor(F.count(F.lit(1)) / 2).alias("type_budget"))
    counts = sampling.available(patches(spark, sf), "county_geoid", ["substation_type"])
    return sampling.allocate_typed(counts, budgets, "substation_type")


POS = "SELECT county_geoid, count(*) AS available FROM fx_patches WHERE label = 'positive' GROUP BY county_geoid"


@query("allocate_negatives", "patches", f"""SELECT county_geoid, available, CAST(greatest(1, floor(CAST(available AS DOUBLE) / sum(available) OVER ()
    * floor(sum(available) OVER () * 1.25))) AS BIGINT) AS budget FROM ({POS}) p""")
def allocate_negatives(spark, sf):
    counts = sampling.available(patches(spark, sf).filter("label = 'positive'"), "county_geoid")
    return sampling.allocate_negatives(counts, ratio=1.25)


@query("sample_per_source", "patches", f"""SELECT patch_id, county_geoid, CAST(d AS BIGINT) AS draw FROM (SELECT patch_id, county_geoid, count(*) OVER (PARTITION BY county_geoid) AS n,
    row_number() OVER (PARTITION BY county_geoid ORDER BY {ORDER}) AS rn FROM fx_patches) r,
    unnest(range(60)) AS t(i), (SELECT r.rn + i * r.n AS d) q WHERE d <= 60""")
def sample_per_source(spark, sf):
    """Sixty rows per source: more than a source holds at small scale, fewer at large."""
    p = patches(spark, sf)
    budgets = p.select("county_geoid").distinct().withColumn("budget", F.lit(60).cast("bigint"))
    return sampling.sample_per_source(p, budgets, ["county_geoid"], order(), slices()).select("patch_id", "county_geoid", "draw")


def noise(k):
    return f"(CAST((cell_id * {k}) % 100003 AS DOUBLE) / 100003)"


@query("jitter_positions", "cells", f"""SELECT cell_id, round(x / 85000 + (2 * {noise(7919)} - 1) * 50.0 / 111000, 7) AS center_lon,
    round(y / 111000 + (2 * {noise(104729)} - 1) * 50.0 / 111000, 7) AS center_lat FROM fx_cells""")
def jitter_positions(spark, sf):
    c = fixture(spark, sf, "cells").selectExpr("cell_id", "x / 85000 AS center_lon", "y / 111000 AS center_lat")
    out = sampling.jitter_positions(c, ["cell_id"], 50.0, uniform=(F.expr(noise(7919)), F.expr(noise(104729))))
    return rounded(out, "center_lon", "center_lat", digits=7)


DRAWS = """SELECT area_id, attempt, 20 AS budget, CAST((area_id * 7919 + attempt * 15485863) % 100003 AS DOUBLE) / 100003 * 60000 AS x,
    CAST((area_id * 104729 + attempt * 32452843) % 100019 AS DOUBLE) / 100019 * 60000 AS y FROM (SELECT c_nationkey AS area_id,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS attempt FROM customer) a"""


@query("sample_negative_points", "stations", f"""SELECT area_id, attempt, CAST(rn AS BIGINT) AS draw FROM (SELECT area_id, attempt, row_number() OVER (PARTITION BY area_id
    ORDER BY attempt) AS rn FROM ({DRAWS}) d WHERE NOT EXISTS (SELECT 1 FROM fx_stations s WHERE {dist('d', 's')} < 2000)) r WHERE rn <= 20""")
def sample_negative_points(spark, sf):
    """One draw per customer, numbered inside its nation."""
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("area_id"), "c_custkey")
    numbered = sampling.ranked(c, "c_custkey", "attempt", by=["area_id"], bucket=F.floor(F.col("c_custkey") / 4096))
    draws = numbered.selectExpr(
        "area_id", "attempt", "20 AS budget", "CAST((area_id * 7919 + attempt * 15485863) % 100003 AS DOUBLE) / 100003 * 60000 AS x",
        "CAST((area_id * 104729 + attempt * 32452843) % 100019 AS DOUBLE) / 100019 * 60000 AS y")
    return sampling.sample_negative_points(draws, fixture(spark, sf, "stations"), "area_id", 2000.0).select("area_id", "attempt", "draw")


UNIFORM = ("CAST((geoid * 7919 + attempt * 15485863) % 100003 AS DOUBLE) / 100003", "CAST((geoid * 104729 + attempt * 32452843) % 100019 AS DOUBLE) / 100019")


@query("negative_candidates", "block_groups", f"""SELECT geoid, attempt, round(x0 + {UNIFORM[0]} * w, 4) AS center_lon, round(y0 + {UNIFORM[1]} * h, 4) AS center_lat
    FROM fx_block_groups CROSS JOIN range(1, 21) AS t(attempt)""")
def negative_candidates(spark, sf):
    b = fixture(spark, sf, "block_groups").selectExpr("geoid", "x0 AS west", "y0 AS south", "x0 + w AS east", "y0 + h AS north", "1 AS budget")
    out = sampling.negative_candidates(b, "geoid", uniform=tuple(F.expr(u) for u in UNIFORM))
    return rounded(out.select("geoid", "attempt", "center_lon", "center_lat"), "center_lon", "center_lat")


GROUP_ORDER = "(CAST(substr(county_geoid, 4) AS BIGINT) * 7919) % 101"
SPLIT = f"""SELECT county_geoid, CASE WHEN fixed IS NOT NULL THEN fixed WHEN place <= n_test THEN 'test' WHEN place <= n_test + n_val THEN 'val' ELSE 'train' END AS split
    FROM (SELECT *, greatest(0, greatest(1, floor(n * 0.15)) - t) AS n_test, greatest(0, greatest(1, floor(n * 0.15)) - v) AS n_val FROM (
    SELECT *, count(*) OVER () AS n, count(CASE WHEN fixed = 'test' THEN 1 END) OVER () AS t, count(CASE WHEN fixed = 'val' THEN 1 END) OVER () AS v,
    row_number() OVER (PARTITION BY fixed IS NULL ORDER BY ord, county_geoid) AS place FROM (SELECT DISTINCT county_geoid, {GROUP_ORDER} AS ord,
    CASE county_geoid WHEN 'src3' THEN 'test' WHEN 'src5' THEN 'val' END AS fixed FROM fx_patches) a) b) c"""


def split_patches(spark, sf):
    return sampling.assign_splits_geographic(patches(spark, sf), "county_geoid", F.expr(GROUP_ORDER), test=["src3"], val=["src5"])


@query("assign_splits_geographic", "patches", f"SELECT p.patch_id, s.split FROM fx_patches p JOIN ({SPLIT}) s ON p.county_geoid = s.county_geoid")
def assign_splits_geographic(spark, sf):
    return split_patches(spark, sf).select("patch_id", "split")


@query("join_split_assignment", "patches", f"""SELECT p.patch_id, coalesce(s.split, 'train') AS split FROM fx_patches p LEFT JOIN
    (SELECT * FROM ({SPLIT}) q WHERE split <> 'train') s ON p.county_geoid = s.county_geoid""")
def join_split_assignment(spark, sf):
    p = patches(spark, sf)
    groups = sampling.split_assignment(p.select("county_geoid").distinct(), "county_geoid", F.expr(GROUP_ORDER), ["src3"], ["src5"])
    return sampling.join_split_assignment(p, groups.filter("split <> 'train'"), "county_geoid").select("patch_id", "split")


@query("assign_splits_random", "patches", f"""SELECT patch_id, CASE WHEN rn <= k THEN 'test' WHEN rn <= 2 * k THEN 'val' ELSE 'train' END AS split FROM (
    SELECT patch_id, row_number() OVER (ORDER BY {ORDER}) AS rn, greatest(1, floor(count(*) OVER () * 0.15)) AS k FROM fx_patches) r""")
def assign_splits_random(spark, sf):
    p = patches(spark, sf).withColumn("ord", order())
    return sampling.assign_splits_random(p, "ord", slices()).select("patch_id", "split")


@query("renumber", "patches", f"SELECT patch_id, row_number() OVER (ORDER BY {ORDER}) - 1 AS new_id FROM fx_patches WHERE label = 'positive'")
def renumber(spark, sf):
    p = patches(spark, sf).filter("label = 'positive'").withColumn("ord", order())
    return sampling.renumber(p, "ord", "new_id").select("patch_id", "new_id")


@query("validation_sample", "patches", f"SELECT patch_id FROM fx_patches ORDER BY {ORDER} LIMIT 200")
def validation_sample(spark, sf):
    return sampling.validation_sample(patches(spark, sf), order()).select("patch_id")


@query("assign_group_folds", "scores", """SELECT s.patch_id, f.fold FROM fx_scores s JOIN (SELECT county_id, CAST(CASE WHEN floor(place / 5) % 2 = 0 THEN place % 5
    ELSE 4 - place % 5 END AS INTEGER) AS fold FROM (SELECT county_id, row_number() OVER (ORDER BY avg(target) DESC, count(*) DESC, county_id) - 1 AS place
    FROM fx_scores GROUP BY county_id) p) f ON s.county_id = f.county_id""")
def assign_group_folds(spark, sf):
    return sampling.assign_group_folds(fixture(spark, sf, "scores"), "county_id").select("patch_id", "fold")


@query("first_tile_wins", "detections", """SELECT key_x, key_y, det_id FROM (SELECT *, row_number() OVER (PARTITION BY key_x, key_y ORDER BY ts DESC, det_id) AS rn FROM (
    SELECT d.det_id, CAST(round(x / 93) AS BIGINT) AS key_x, CAST(round(y / 111) AS BIGINT) AS key_y, e.ts FROM fx_detections d JOIN events e
    ON d.det_id = e.event_id WHERE e.value > 1) k) r WHERE rn = 1""")
def first_tile_wins(spark, sf):
    """Readable patches only, newest tile first."""
    e = table(spark, sf, "events").filter("value > 1").select(F.col("event_id").alias("det_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"))
    d = fixture(spark, sf, "detections").join(e, "det_id").selectExpr(
        "det_id", "CAST(round(x / 93) AS BIGINT) AS key_x", "CAST(round(y / 111) AS BIGINT) AS key_y", "ts")
    return sampling.first_tile_wins(d, ["key_x", "key_y"], [-F.col("ts"), F.col("det_id")]).select("key_x", "key_y", "det_id")


@query("distinct_patches", "detections", """SELECT ground_id, min(det_id) AS det_id FROM (SELECT det_id, CAST(floor(x / 50) AS BIGINT) AS ground_id FROM fx_detections) d
    GROUP BY ground_id""")
def distinct_patches(spark, sf):
    d = fixture(spark, sf, "detections").selectExpr("det_id", "CAST(floor(x / 50) AS BIGINT) AS ground_id", "mean_confidence")
    return sampling.distinct_patches(d, "ground_id", [F.col("det_id")]).select("ground_id", "det_id")


# --- evaluation ---------------------------------------------------------------------------

SCORE_COLUMNS = """count(*) AS n, round(avg(iou), 4) AS mean_iou, round(stddev_samp(iou), 4) AS std_iou, round(avg(dice), 4) AS mean_dice,
    round(avg(pixel_precision), 4) AS mean_precision, round(avg(pixel_recall), 4) AS mean_recall"""
SCORE_NAMES = ("mean_iou", "std_iou", "mean_dice", "mean_precision", "mean_recall")


def scores(spark, sf):
    return fixture(spark, sf, "scores")


@query("grouped_metrics", "scores", f"""SELECT CAST(county_id AS VARCHAR) AS county_id, {SCORE_COLUMNS}, round(median(gt_positive_px), 4) AS median_gt_px FROM fx_scores
    WHERE target = 1 GROUP BY county_id HAVING count(*) >= 3""")
def grouped_metrics(spark, sf):
    return rounded(evaluate.grouped_metrics(scores(spark, sf), "county_id"), *SCORE_NAMES, "median_gt_px")


@query("group_breakdown", "scores", f"""SELECT county_id, substation_type, {SCORE_COLUMNS} FROM fx_scores WHERE target = 1 GROUP BY county_id, substation_type""")
def group_breakdown(spark, sf):
    return rounded(evaluate.group_breakdown(scores(spark, sf), "county_id", "substation_type"), *SCORE_NAMES)


@query("size_binned_metrics", "scores", f"""SELECT bin, size_bin, {SCORE_COLUMNS} FROM fx_scores JOIN (VALUES (0, '0-200 px', 0, 200), (1, '200-1000 px', 200, 1000),
    (2, '1000-5000 px', 1000, 5000), (3, '5000-20000 px', 5000, 20000), (4, '20000-200000 px', 20000, 200000)) b(bin, size_bin, lo, hi)
    ON gt_positive_px > lo AND gt_positive_px <= hi WHERE target = 1 GROUP BY bin, size_bin""")
def size_binned_metrics(spark, sf):
    return rounded(evaluate.size_binned_metrics(scores(spark, sf)), *SCORE_NAMES)


@query("overall_summary", "scores", f"SELECT {SCORE_COLUMNS}, round(median(iou), 4) AS median_iou FROM fx_scores WHERE target = 1")
def overall_summary(spark, sf):
    return rounded(evaluate.overall_summary(scores(spark, sf)), *SCORE_NAMES, "median_iou")


@query("macro_average", "scores", """SELECT round(avg(m), 4) AS macro_mean_iou, count(*) AS n_datasets FROM (SELECT avg(iou) AS m FROM fx_scores
    WHERE target = 1 GROUP BY county_id) g""")
def macro_average(spark, sf):
    return rounded(evaluate.macro_average(evaluate.overall_summary(scores(spark, sf), ["county_id"])), "macro_mean_iou")


@query("confusion_counts", "scores", """SELECT tp, fp, fn, tn, round(2.0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM (SELECT
    count(*) FILTER (WHERE patch_score >= 0.5 AND target = 1) AS tp, count(*) FILTER (WHERE patch_score >= 0.5 AND target = 0) AS fp,
    count(*) FILTER (WHERE patch_score < 0.5 AND target = 1) AS fn, count(*) FILTER (WHERE patch_score < 0.5 AND target = 0) AS tn FROM fx_scores) c""")
def confusion_counts(spark, sf):
    return rounded(evaluate.confusion_counts(scores(spark, sf)), "f1")


CURVE = """SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS p,
    sum(neg) OVER () AS n FROM (SELECT patch_score AS score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
    FROM fx_scores GROUP BY patch_score) g"""


@query("roc_auc", "scores", f"SELECT round(sum(pos * (n - fp + neg / 2.0)) / (max(p) * CAST(max(n) AS DOUBLE)), 8) AS roc_auc FROM ({CURVE}) c")
def roc_auc(spark, sf):
    return rounded(evaluate.roc_auc(evaluate.score_table(scores(spark, sf))), "roc_auc", digits=8)


@query("average_precision", "scores", f"SELECT round(sum(CAST(pos AS DOUBLE) / p * tp / (tp + fp)), 8) AS average_precision FROM ({CURVE}) c")
def average_precision(spark, sf):
    return rounded(evaluate.average_precision(evaluate.score_table(scores(spark, sf))), "average_precision", digits=8)


@query("tune_threshold", "scores", f"""SELECT round(score, 8) AS threshold, round(f1, 8) AS f1 FROM (SELECT score, round(2.0 * tp / (tp + fp + p), 12) AS f1
    FROM ({CURVE}) c) d ORDER BY f1 DESC, score DESC LIMIT 1""")
def tune_threshold(spark, sf):
    return rounded(evaluate.tune_threshold(evaluate.score_table(scores(spark, sf))), "threshold", "f1", digits=8)


@query("worst_false_negatives", "scores", "SELECT patch_id, round(iou, 6) AS iou FROM (SELECT * FROM fx_scores WHERE target = 1 ORDER BY iou, patch_id LIMIT 20) w")
def worst_false_negatives(spark, sf):
    return rounded(evaluate.worst_false_negatives(scores(spark, sf)).select("patch_id", "iou"), "iou", digits=6)


@query("worst_false_positives", "scores", """SELECT patch_id, round(patch_score, 6) AS patch_score FROM (SELECT * FROM fx_scores WHERE target = 0
    ORDER BY patch_score DESC, patch_id LIMIT 20) w""")
def worst_false_positives(spark, sf):
    return rounded(evaluate.worst_false_positives(scores(spark, sf)).select("patch_id", "patch_score"), "patch_score", digits=6)


@query("join_results_metadata", "scores temporal", """SELECT s.patch_id, round(s.iou, 4) AS iou, t.acquired FROM fx_scores s LEFT JOIN fx_temporal t ON s.patch_id = t.patch_id""")
def join_results_metadata(spark, sf):
    out = evaluate.join_results_metadata(scores(spark, sf).select("patch_id", "iou"), fixture(spark, sf, "temporal"), ["acquired"])
    return rounded(out, "iou")


@query("normalise_eval_metadata", "patches", """SELECT patch_id, coalesce(substation_type, '') AS substation_type, '' AS voltage,
    coalesce(positive_pixels, 0) AS positive_pixels, CAST(label = 'positive' AS INTEGER) AS target FROM (SELECT patch_id, label,
    nullif(substation_type, '') AS substation_type, positive_pixels FROM fx_patches) p""")
def normalise_eval_metadata(spark, sf):
    p = patches(spark, sf).withColumn("substation_type", F.nullif("substation_type", F.lit("")))
    out = evaluate.normalise_eval_metadata(p, ["substation_type", "voltage"])
    return out.select("patch_id", "substation_type", "voltage", "positive_pixels", "target")


@query("type_distribution", "stations", "SELECT voltage, count(*) AS n FROM fx_stations GROUP BY voltage ORDER BY n DESC, voltage LIMIT 10")
def type_distribution(spark, sf):
    return evaluate.type_distribution(fixture(spark, sf, "stations"), "voltage", 10)


@query("dataset_statistics", "patches", """SELECT count(*) AS total_patches, count(*) FILTER (WHERE label = 'positive') AS positive_patches,
    count(*) FILTER (WHERE label = 'negative') AS negative_patches, round(avg(CAST(label = 'positive' AS INTEGER)), 4) AS balance_ratio,
    round(avg(px), 4) AS px_mean, round(median(px), 4) AS px_median, round(stddev_samp(px), 4) AS px_std, min(px) AS px_min, max(px) AS px_max
    FROM (SELECT label, CASE WHEN label = 'positive' THEN positive_pixels END AS px FROM fx_patches) p""")
def dataset_statistics(spark, sf):
    return rounded(evaluate.dataset_statistics(patches(spark, sf)), "balance_ratio", "px_mean", "px_median", "px_std")


@query("label_pivot_region", "patches", """SELECT region, count(*) FILTER (WHERE label = 'negative') AS negative, count(*) FILTER (WHERE label = 'positive') AS positive
    FROM fx_patches GROUP BY region""")
def label_pivot_region(spark, sf):
    return evaluate.label_pivot(patches(spark, sf), "region")


@query("label_pivot_county", "patches", """SELECT county_geoid, count(*) FILTER (WHERE label = 'negative') AS negative, count(*) FILTER (WHERE label = 'positive') AS positive
    FROM fx_patches GROUP BY county_geoid""")
def label_pivot_county(spark, sf):
    return evaluate.label_pivot(patches(spark, sf), "county_geoid")


def joined_counties(df):
    return df.withColumn("counties", F.array_join("counties", ","))


SUMMARY_SQL = """count(*) AS n_patches, count(*) FILTER (WHERE label = 'positive') AS n_positive, count(*) FILTER (WHERE label = 'negative') AS n_negative,
    count(*) FILTER (WHERE label = 'positive_no_imagery') AS n_no_imagery, string_agg(DISTINCT county_geoid, ',' ORDER BY county_geoid) AS counties"""


@query("split_summary", "patches", f"SELECT split, {SUMMARY_SQL} FROM (SELECT p.*, s.split FROM fx_patches p JOIN ({SPLIT}) s ON p.county_geoid = s.county_geoid) q GROUP BY split")
def split_summary(spark, sf):
    return joined_counties(evaluate.split_summary(split_patches(spark, sf)))


@query("extraction_summary", "patches", f"""SELECT region, {SUMMARY_SQL} FROM (SELECT region, county_geoid, CASE WHEN substation_type = '' THEN
    'positive_no_imagery' ELSE label END AS label FROM fx_patches) p GROUP BY region""")
def extraction_summary(spark, sf):
    p = patches(spark, sf).withColumn("label", F.expr("CASE WHEN substation_type = '' THEN 'positive_no_imagery' ELSE label END"))
    return joined_counties(evaluate.split_summary(p, ["region"]))


@query("detection_summary", "detections", """SELECT count(*) AS n, round(min(area_m2), 4) AS area_min, round(median(area_m2), 4) AS area_median, round(max(area_m2), 4) AS area_max,
    round(min(mean_confidence), 4) AS conf_min, round(avg(mean_confidence), 4) AS conf_mean, round(max(mean_confidence), 4) AS conf_max,
    count(*) FILTER (WHERE area_m2 < 1000) AS n_small, count(*) FILTER (WHERE area_m2 >= 1000 AND area_m2 < 10000) AS n_medium,
    count(*) FILTER (WHERE area_m2 >= 10000) AS n_large FROM fx_detections""")
def detection_summary(spark, sf):
    return rounded(evaluate.detection_summary(fixture(spark, sf, "detections")), "area_min", "area_median", "area_max", "conf_min", "conf_mean", "conf_max")


# --- quality ------------------------------------------------------------------------------

GAP = """abs(floor((epoch_us(acquired) - epoch_us(edited)) / 86400000000.0)) / 365.25"""


def dated(spark, sf):
    return quality.check_temporal_alignment(fixture(spark, sf, "temporal"))


@query("temporal_gap", "temporal", f"""SELECT patch_id, round({GAP}, 4) AS temporal_gap_years, coalesce({GAP} > 3.0, false) AS temporal_mismatch FROM fx_temporal""")
def temporal_gap(spark, sf):
    return rounded(dated(spark, sf).select("patch_id", "temporal_gap_years", "temporal_mismatch"), "temporal_gap_years")


@query("exclude_flagged", "temporal", f"SELECT patch_id FROM fx_temporal WHERE NOT coalesce({GAP} > 3.0, false)")
def exclude_flagged(spark, sf):
    return quality.exclude_flagged(dated(spark, sf)).select("patch_id")


@query("join_timestamps", "temporal", """SELECT s.event_id, t.edited FROM (SELECT event_id, CASE WHEN event_type = 'view' THEN -1 ELSE event_id END AS osm_id FROM events) s
    LEFT JOIN fx_temporal t ON s.osm_id > 0 AND s.osm_id = t.patch_id""")
def join_timestamps(spark, sf):
    rows = table(spark, sf, "events").selectExpr("event_id", "CASE WHEN event_type = 'view' THEN -1 ELSE event_id END AS osm_id")
    edits = fixture(spark, sf, "temporal").withColumnRenamed("patch_id", "osm_id")
    return quality.join_timestamps(rows, edits).select("event_id", "edited")


@query("resolution_consistency", "scores", """SELECT round(min(iou), 6) AS res_min, round(max(iou), 6) AS res_max, min(iou) = max(iou) AS res_consistent, min(target) AS bands_min,
    max(target) AS bands_max, min(target) = max(target) AS bands_consistent FROM fx_scores""")
def resolution_consistency(spark, sf):
    return rounded(quality.resolution_consistency(scores(spark, sf), "iou", "target"), "res_min", "res_max", digits=6)


@query("qa_issue_summary", "scores", """SELECT *, concat_ws('; ', CASE WHEN n_invalid > 0 THEN n_invalid || ' invalid patches' END, CASE WHEN n_temporal > 0 THEN
    n_temporal || ' temporal mismatches' END, CASE WHEN n_suspect > 0 THEN n_suspect || ' suspect labels (NDVI/water)' END, CASE WHEN n_corrupt > 0 THEN
    'Possibly corrupt tiles detected' END) AS issues FROM (SELECT count(*) FILTER (WHERE iou < 0.1) AS n_invalid, count(*) FILTER (WHERE dice > 0.9)
    AS n_temporal, count(*) FILTER (WHERE patch_score < 0) AS n_suspect, count(*) FILTER (WHERE gt_positive_px = 100) AS n_corrupt FROM fx_scores) c""")
def qa_issue_summary(spark, sf):
    return quality.qa_issue_summary(scores(spark, sf).selectExpr(
        "iou >= 0.1 AS is_valid", "dice > 0.9 AS temporal_mismatch", "patch_score < 0 AS suspect_label", "gt_positive_px = 100 AS possibly_corrupt"))


@query("contamination_check", "patches", """SELECT DISTINCT county_geoid FROM fx_patches WHERE label = 'positive' AND county_geoid IN
    (SELECT county_geoid FROM fx_patches WHERE substation_type = '')""")
def contamination_check(spark, sf):
    p = patches(spark, sf)
    return quality.contamination_check(p.filter("label = 'positive'"), p.filter("substation_type = ''"))


@query("keep_valid_or_unsampled", "patches", "SELECT patch_id FROM fx_patches WHERE NOT (label = 'positive' AND positive_pixels < 2000)")
def keep_valid_or_unsampled(spark, sf):
    p = patches(spark, sf)
    checked = p.filter("label = 'positive'").selectExpr("patch_id", "positive_pixels >= 2000 AS is_valid")
    return quality.keep_valid_or_unsampled(p, checked).select("patch_id")


@query("resume_skip_existing", "patches", "SELECT patch_id FROM fx_patches WHERE patch_id NOT IN (SELECT doc_id FROM labels)")
def resume_skip_existing(spark, sf):
    return quality.resume_skip_existing(patches(spark, sf), table(spark, sf, "labels").withColumnRenamed("doc_id", "patch_id")).select("patch_id")


@query("keep_on_disk", "patches", "SELECT patch_id FROM fx_patches WHERE patch_id IN (SELECT doc_id FROM labels)")
def keep_on_disk(spark, sf):
    return quality.keep_on_disk(patches(spark, sf), table(spark, sf, "labels").withColumnRenamed("doc_id", "patch_id")).select("patch_id")


@query("lookup_counties", None, """SELECT n_nationkey AS geoid, n_name FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9000)""")
def lookup_counties(spark, sf):
    wanted = table(spark, sf, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("geoid"))
    return quality.lookup_counties(wanted, table(spark, sf, "nation").select(F.col("n_nationkey").alias("geoid"), "n_name"))


@query("source_bounds", "block_groups cells", """SELECT s.source_id, round(coalesce(r.x0, c.x - 1000), 4) AS west, round(coalesce(r.y0, c.y - 1000), 4) AS south,
    round(coalesce(r.x0 + r.w, c.x + 1000), 4) AS east, round(coalesce(r.y0 + r.h, c.y + 1000), 4) AS north FROM (SELECT o_orderkey AS source_id FROM orders) s
    LEFT JOIN fx_block_groups r ON s.source_id = r.geoid AND r.w > 1500 LEFT JOIN fx_cells c ON s.source_id = c.cell_id
    WHERE r.geoid IS NOT NULL OR c.cell_id IS NOT NULL""")
def source_bounds(spark, sf):
    regions = fixture(spark, sf, "block_groups").filter("w > 1500").selectExpr("geoid AS source_id", "x0 AS west", "y0 AS south", "x0 + w AS east", "y0 + h AS north")
    counties = fixture(spark, sf, "cells").selectExpr("cell_id AS source_id", "x - 1000 AS west", "y - 1000 AS south", "x + 1000 AS east", "y + 1000 AS north")
    out = quality.source_bounds(table(spark, sf, "orders").selectExpr("o_orderkey AS source_id"), regions, counties)
    return rounded(out, "west", "south", "east", "north")


@query("inventory_left_join", "stations scores", """SELECT s.sub_id AS osm_id, coalesce(CAST(p.patch_id AS VARCHAR), 'inv_' || s.sub_id) AS patch_id,
    CASE WHEN p.patch_id IS NULL THEN 'positive_no_imagery' ELSE 'positive' END AS label, coalesce(p.gt_positive_px, 0) AS positive_pixels,
    CASE WHEN p.patch_id IS NULL THEN 'no_coverage' ELSE 'catalogue' END AS source FROM fx_stations s LEFT JOIN fx_scores p ON s.sub_id = p.patch_id AND p.target = 1""")
def inventory_left_join(spark, sf):
    st = fixture(spark, sf, "stations").select(F.col("sub_id").alias("osm_id"))
    p = scores(spark, sf).filter("target = 1").selectExpr(
        "patch_id AS osm_id", "CAST(patch_id AS STRING) AS patch_id", "gt_positive_px AS positive_pixels", "'catalogue' AS source",
        "CAST(NULL AS DOUBLE) AS mask_bbox_width_m", "CAST(NULL AS DOUBLE) AS mask_bbox_height_m")
    return quality.inventory_left_join(st, p).select("osm_id", "patch_id", "label", "positive_pixels", "source")


@query("inventory_table", "stations scores", """SELECT coalesce(CAST(p.patch_id AS VARCHAR), 'inv_' || s.sub_id) AS patch_id, s.sub_id AS osm_id, NULL::VARCHAR AS center_lon,
    NULL::VARCHAR AS center_lat, NULL::VARCHAR AS substation_type, NULL::VARCHAR AS substation_name, NULL::VARCHAR AS operator, s.voltage, NULL::VARCHAR AS geom_source,
    coalesce(p.gt_positive_px, 0) AS positive_pixels, NULL::DOUBLE AS mask_bbox_width_m, NULL::DOUBLE AS mask_bbox_height_m,
    CASE WHEN p.patch_id IS NULL THEN 'positive_no_imagery' ELSE 'positive' END AS label FROM fx_stations s LEFT JOIN fx_scores p ON s.sub_id = p.patch_id AND p.target = 1""")
def inventory_table(spark, sf):
    st = fixture(spark, sf, "stations").select(F.col("sub_id").alias("osm_id"), "voltage")
    p = scores(spark, sf).filter("target = 1").selectExpr(
        "patch_id AS osm_id", "CAST(patch_id AS STRING) AS patch_id", "gt_positive_px AS positive_pixels", "'catalogue' AS source",
        "CAST(NULL AS DOUBLE) AS mask_bbox_width_m", "CAST(NULL AS DOUBLE) AS mask_bbox_height_m")
    return quality.inventory_table(st, p)


@query("union_sources", "stations cells", "SELECT sub_id AS id, voltage, CAST(NULL AS DOUBLE) AS demand_kw FROM fx_stations UNION ALL SELECT cell_id, NULL, demand_kw FROM fx_cells")
def union_sources(spark, sf):
    return quality.union_sources([fixture(spark, sf, "stations").selectExpr("sub_id AS id", "voltage"),
                                  fixture(spark, sf, "cells").selectExpr("cell_id AS id", "demand_kw")])


# --- scalar rules -------------------------------------------------------------------------

@query("geoid_parts", "stations", """SELECT sub_id, substr(lpad(CAST(sub_id * 37 AS VARCHAR), 5, '0'), 1, 2) AS state, substr(lpad(CAST(sub_id * 37 AS VARCHAR), 5, '0'), 3, 3) AS county
    FROM fx_stations""")
def geoid_parts(spark, sf):
    g = quality.unsigned_county(F.col("sub_id") * 37)
    return fixture(spark, sf, "stations").select("sub_id", S.geoid_state(g).alias("state"), S.geoid_county(g).alias("county"))


@query("ids_and_labels", "patches", """SELECT patch_id, 'pos_' || county_geoid || '_' || region || '_' || patch_id || '_' || lpad(CAST(positive_pixels % 10000 AS VARCHAR), 4, '0') AS pos_id,
    'rand_' || lpad(CAST(patch_id AS VARCHAR), CAST(greatest(4, length(CAST(patch_id AS VARCHAR))) AS INTEGER), '0') AS rand_id,
    'det_' || lpad(CAST(patch_id AS VARCHAR), CAST(greatest(5, length(CAST(patch_id AS VARCHAR))) AS INTEGER), '0') AS det_id FROM fx_patches""")
def ids_and_labels(spark, sf):
    return patches(spark, sf).select(
        "patch_id", S.positive_patch_id(F.col("county_geoid"), F.col("region"), F.col("patch_id"), F.col("positive_pixels") % 10000).alias("pos_id"),
        S.random_patch_id(F.col("patch_id")).alias("rand_id"), S.detection_id(F.col("patch_id")).alias("det_id"))


@query("confidence_band", "detections", """SELECT det_id, CASE WHEN mean_confidence > 0.8 THEN 'high' WHEN mean_confidence > 0.6 THEN 'medium' ELSE 'low' END AS band,
    CASE WHEN mean_confidence > 0.7 THEN 'high' WHEN mean_confidence > 0.5 THEN 'medium' ELSE 'low' END AS band_alt FROM fx_detections""")
def confidence_band(spark, sf):
    c = F.col("mean_confidence")
    return fixture(spark, sf, "detections").select("det_id", S.confidence_band(c).alias("band"), S.confidence_band(c, 0.7, 0.5).alias("band_alt"))


@query("sha256_fingerprint", None, "SELECT page_id, sha256(html) AS sha FROM pages")
def sha256_fingerprint(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.sha256_fingerprint(F.encode("html", "UTF-8")).alias("sha"))


@query("parse_type_budgets", None, """SELECT p_partkey, p_size AS transmission, p_partkey AS distribution FROM part""")
def parse_type_budgets(spark, sf):
    text = F.concat(F.lit('"transmission='), F.col("p_size"), F.lit(", distribution="), F.col("p_partkey"), F.lit('"'))
    b = table(spark, sf, "part").withColumn("b", S.parse_type_budgets(text))
    return b.select("p_partkey", F.col("b")["transmission"].alias("transmission"), F.col("b")["distribution"].alias("distribution"))


@query("affine_to_world", "detections", """SELECT det_id, round(500000.0 + floor(x) * 0.6, 4) AS wx, round(3700000.0 + floor(y) * -0.6, 4) AS wy FROM fx_detections""")
def affine_to_world(spark, sf):
    p = G.affine_to_world(F.lit(0.6), F.lit(500000.0), F.lit(-0.6), F.lit(3700000.0), F.floor("x"), F.floor("y"))
    out = fixture(spark, sf, "detections").withColumn("p", p)
    return rounded(out.select("det_id", F.col("p.x").alias("wx"), F.col("p.y").alias("wy")), "wx", "wy")


# --- row generators -----------------------------------------------------------------------

@query("tile_windows", None, """SELECT p_partkey AS raster, r * 448 AS row_off, c * 448 AS col_off FROM (SELECT *, p_size * 40 AS height, p_size * 30 AS width FROM part) p,
    unnest(range(50)) AS tr(r), unnest(range(50)) AS tc(c) WHERE r * 448 <= height - 512 AND c * 448 <= width - 512""")
def tile_windows(spark, sf):
    r = table(spark, sf, "part").selectExpr("p_partkey AS raster", "p_size * 40 AS height", "p_size * 30 AS width")
    return grids.tile_windows(r).select("raster", "row_off", "col_off")


@query("extraction_estimate", "block_groups", """SELECT geoid, n_patches, round(n_patches * 0.4E0, 4) AS megabytes FROM (SELECT geoid, CAST(floor((x0 + w) / 85000 * 85.0 / 0.3072 - 0)
    AS BIGINT) * CAST(floor((y0 + h) / 111000 * 111.0 / 0.3072) AS BIGINT) AS n_patches FROM fx_block_groups) e""")
def extraction_estimate(spark, sf):
    """Boxes from the origin to each corner, in degrees."""
    b = fixture(spark, sf, "block_groups").selectExpr("geoid", "0.0E0 AS west", "0.0E0 AS south", "(x0 + w) / 85000 AS east", "(y0 + h) / 111000 AS north")
    return rounded(grids.extraction_estimate(b).select("geoid", "n_patches", "megabytes"), "megabytes")


# Tiles of 4000 x 4000 pixels of 0.00001 degrees around each station.
TILE = "sub_id AS tile_id, 4000 AS height, 4000 AS width, 0.00001E0 AS a, -112.0E0 + x / 85000 AS c, -0.00001E0 AS e, 33.0E0 + y / 111000 AS f"


# The box -111.9, 33.1, -111.4, 33.4 in tiles of 1e-5 degrees a pixel, cut every 300 pixels (0.003 degrees).
@query("patch_windows", "stations", f"""WITH t AS (SELECT *, greatest(0, trunc((-111.9E0 - c) / a)::INT) AS c0, least(width, trunc((-111.4E0 - c) / a)::INT) AS c1,
    greatest(0, trunc((33.4E0 - f) / e)::INT) AS r0, least(height, trunc((33.1E0 - f) / e)::INT) AS r1 FROM (SELECT {TILE} FROM fx_stations) s),
    w AS (SELECT *, c + (col_off + 150) * a AS lon, f + (row_off + 150) * e AS lat FROM (SELECT *, unnest(range(c0, c1 - 299, 300)) AS col_off
      FROM (SELECT *, unnest(range(r0, r1 - 299, 300)) AS row_off FROM t WHERE c1 - c0 >= 300 AND r1 - r0 >= 300) x) y)
    SELECT tile_id, row_off::INT AS row_off, col_off::INT AS col_off, 300::INT AS "window", printf('patch_%07d_%07d', round_even(lat * 10000, 0)::BIGINT,
      round_even(abs(lon) * 10000, 0)::BIGINT) AS patch_id, round(lon, 7) AS center_lon, round(lat, 7) AS center_lat,
      round_even(lon * 1000, 0)::BIGINT AS key_lon, round_even(lat * 1000, 0)::BIGINT AS key_lat
    FROM w WHERE lon BETWEEN -111.9E0 AND -111.4E0 AND lat BETWEEN 33.1E0 AND 33.4E0""")
def patch_windows(spark, sf):
    tiles = fixture(spark, sf, "stations").selectExpr(*TILE.split(", "))
    out = grids.patch_windows(tiles, (-111.9, 33.1, -111.4, 33.4), ground_span_m=0.003)
    return rounded(out.select("tile_id", "row_off", "col_off", "window", "patch_id", "center_lon", "center_lat", "key_lon", "key_lat"),
                   "center_lon", "center_lat", digits=7)


# --- sources and sinks --------------------------------------------------------------------

def documents_of(spark, sf):
    """One census document per customer: header plus two rows."""
    return table(spark, sf, "customer").selectExpr("""concat('[["P1_001N","state","county","tract","block group"],["', c_custkey % 900,
        '","04","013","', lpad(c_custkey, 6, '0'), '","1"],["', c_nationkey, '","04","013","', lpad(c_custkey, 6, '0'), '","2"]]') AS value""")


@query("read_census_population", None, """SELECT '04013' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '1' AS "GEOID", CAST(c_custkey % 900 AS INTEGER) AS population FROM customer
    UNION ALL SELECT '04013' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '2', c_nationkey FROM customer""")
def read_census_population(spark, sf):
    """Documents go through landed text files, one JSON document per line."""
    folder = scratch(spark)
    documents_of(spark, sf).write.text(folder)
    return readers.read_census_population(spark, folder, lines=True)


def rectangle_features(spark, sf, name):
    """One GeoJSON document per polygon."""
    if name == "block_groups":
        b = fixture(spark, sf, name).selectExpr("geoid AS id", "x0", "y0", "x0 + w AS x1", "y0 + h AS y1", "population % 3 AS k")
    else:
        b = fixture(spark, sf, name).selectExpr("bld_id AS id", "x AS x0", "y AS y0", "x + side AS x1", "y + side AS y1", "bld_id % 3 AS k")
    pair = lambda x, y: F.array(F.col(x), F.col(y))
    ring = F.array(F.array(pair("x0", "y0"), pair("x0", "y1"), pair("x1", "y1"), pair("x1", "y0"), pair("x0", "y0")))
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lpad(F.col("id").cast("string"), 12, "0").alias("GEOID"), F.lit("04").alias("STATEFP"),
                 F.when(F.col("k") == 0, "013").otherwise("019").alias("COUNTYFP")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), ring.alias("coordinates")).alias("geometry"))
    folder = scratch(spark)
    b.select(F.array(feature).alias("features")).write.json(folder)
    return folder


@query("read_block_groups", "block_groups", """SELECT lpad(CAST(geoid AS VARCHAR), 12, '0') AS "GEOID", round(w * h, 2) AS area_m2 FROM fx_block_groups WHERE population % 3 = 0""")
def read_block_groups(spark, sf):
    out = readers.read_block_groups(spark, rectangle_features(spark, sf, "block_groups"), "04", "013", lines=True)
    return rounded(out.select("GEOID", G.polygon_area(G.edges(F.col("rings"))).alias("area_m2")), "area_m2", digits=2)


@query("read_building_footprints", "buildings", "SELECT round(sum(side * side), 2) AS area_m2, count(*) AS n FROM fx_buildings")
def read_building_footprints(spark, sf):
    folder = rectangle_features(spark, sf, "buildings")
    out = readers.read_building_footprints(spark, folder + "/no-such.parquet", folder, lines=True)
    return rounded(out.agg(F.sum(G.polygon_area(G.edges(F.col("rings")))).alias("area_m2"), F.count(F.lit(1)).alias("n")), "area_m2", digits=2)


@query("read_feature_ranges", "buildings", "SELECT bld_id % 3 AS k, round(sum(side * side), 2) AS area_m2, count(*) AS n FROM fx_buildings GROUP BY bld_id % 3")
def read_feature_ranges(spark, sf):
    """The buildings landed as collections and read back by byte ranges of 256 KB."""
    b = fixture(spark, sf, "buildings")
    feature = F.concat(F.lit('{"type": "Feature", "properties": {"k": "'), (F.col("bld_id") % 3).cast("string"), F.lit('", "note": "a \\"quoted } brace\\" {"}, '
                       '"geometry": {"type": "Polygon", "coordinates": [[['), F.concat_ws("],[", *[F.concat_ws(",", x, y) for x, y in (
                           (F.col("x"), F.col("y")), (F.col("x"), F.col("y") + F.col("side")), (F.col("x") + F.col("side"), F.col("y") + F.col("side")),
                           (F.col("x") + F.col("side"), F.col("y")), (F.col("x"), F.col("y")))]), F.lit("]]]}}"))
    lots = b.select(F.floor(F.col("bld_id") / 20000).alias("lot"), feature.alias("f")).groupBy("lot").agg(F.array_join(F.collect_list("f"), ",\n").alias("f"))
    folder = scratch(spark)
    lots.select(F.concat(F.lit('{"type": "FeatureCollection", "features": ['), "f", F.lit("]}")).alias("value")).write.text(folder)
    found = readers.polygons_from_features(ranges.read_feature_ranges(spark, folder, 256 << 10))
    area = G.polygon_area(G.edges(F.col("rings")))
    out = found.groupBy(F.element_at("properties", F.lit("k")).cast("bigint").alias("k")).agg(F.sum(area).alias("area_m2"), F.count(F.lit(1)).alias("n"))
    return rounded(out, "area_m2", digits=2)


WINDOW, DIGITS = 48, 3


def decode_digits(path, row, col, height, width):
    """Pixels of a raster landed as one line of fixed-width numbers per row."""
    system, inner = ranges.opened(path)
    with system.open_input_file(inner) as file:
        line = 64 * DIGITS + 1
        file.seek(row * line)
        rows = [file.read(line)[col * DIGITS:(col + width) * DIGITS] for _ in range(height)]
    return {"red": [int(r[i:i + DIGITS]) for r in rows for i in range(0, len(r), DIGITS)]}


@query("read_windows", None, f"""SELECT label AS raster, CAST(r // {WINDOW} * {WINDOW} AS INTEGER) AS row_off, CAST(i // {WINDOW} * {WINDOW} AS INTEGER) AS col_off,
    count(*) AS n_pixels, CAST(sum(red) AS BIGINT) AS red FROM (SELECT label, dense_rank() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r, i,
    CAST(floor(abs(CAST(embedding[i + 1] AS DOUBLE)) * 997) AS BIGINT) % 256 AS red FROM embeddings, unnest(range(64)) AS t(i)) p GROUP BY ALL""")
def read_windows(spark, sf):
    """One raster per class, a vector per row, landed as files and read by windows of 48 pixels."""
    line = F.array_join(F.transform("red", lambda v: F.lpad(v.cast("string"), DIGITS, "0")), "")
    rows = patch_arrays(spark, sf).select("class", "patch_id", line.alias("value"))
    folder = scratch(spark)
    rows.repartition("class").sortWithinPartitions("class", "patch_id").select("class", "value").write.partitionBy("class").text(folder)
    rasters = [(path, size // (64 * DIGITS + 1), 64) for path, size in ranges.files_of(folder)]
    windows = ranges.read_windows(spark, rasters, decode_digits, {"red": "int"}, WINDOW)
    total = F.aggregate("red", F.lit(0).cast("bigint"), lambda t, v: t + v)
    return windows.select(F.regexp_extract("path", "class=(-?\\d+)/", 1).cast("int").alias("raster"), "row_off", "col_off",
                          F.size("red").cast("bigint").alias("n_pixels"), total.alias("red"))


@query("read_transmission_lines", "segments", """SELECT line_id, 1 AS n_segments, round(sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)), 3) AS length_m FROM fx_segments""")
def read_transmission_lines(spark, sf):
    s = fixture(spark, sf, "segments")
    pair = lambda x, y: F.array(F.col(x), F.col(y))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.col("line_id").cast("string").alias("line_id")).alias("properties"),
                       F.struct(F.lit("LineString").alias("type"), F.array(pair("x1", "y1"), pair("x2", "y2")).alias("coordinates")).alias("geometry"))
    folder = scratch(spark)
    s.select(F.array(feature).alias("features")).write.json(folder)
    lines = readers.read_transmission_lines(spark, folder, folder + "/no-such-minor-lines", lines=True)
    segments = readers.line_segments(lines.select(F.element_at("properties", F.lit("line_id")).cast("bigint").alias("line_id"), "path"))
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return rounded(segments.groupBy("line_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(length).alias("length_m")), "length_m", digits=3)


@query("read_data_centers", "data_centers", "SELECT round(x, 3) AS lon, round(y, 3) AS lat, sqft FROM fx_data_centers WHERE sqft IS NOT NULL AND floor(y / 10000) = 3")
def read_data_centers(spark, sf):
    folder = scratch(spark)
    fixture(spark, sf, "data_centers").selectExpr("4 AS state_id", "10 + CAST(floor(y / 10000) AS INT) AS county_id", "x AS lon", "y AS lat", "sqft").write.csv(folder, header=True)
    return rounded(readers.read_data_centers(spark, folder, "04", "013").select("lon", "lat", "sqft"), "lon", "lat", digits=3)


@query("read_detections", "detections", """SELECT det_id AS osm_id, round(mean_confidence, 6) AS mean_confidence FROM fx_detections WHERE is_polygon AND floor(area_m2 / 100) = 4
    AND x > 1000 AND x < 6000 AND y > 2000 AND y < 7000""")
def read_detections(spark, sf):
    """CSV with county codes that lost their leading zero."""
    folder = scratch(spark)
    fixture(spark, sf, "detections").selectExpr(
        "concat('det_', det_id) AS patch_id", "CASE WHEN is_polygon THEN 'positive' ELSE 'negative' END AS label", "x AS center_lon", "y AS center_lat",
        "4013 + CAST(floor(area_m2 / 100) AS INT) - 4 AS county_geoid", "mean_confidence", "det_id AS osm_id").write.csv(folder, header=True)
    out = readers.read_detections(spark, folder, "04013", (1000.0, 2000.0, 6000.0, 7000.0))
    return rounded(out.select("osm_id", "mean_confidence"), "mean_confidence", digits=6)


def overpass_documents(spark, sf):
    """Per station: four nodes, a closed way, an open way, a station node, and a way with a missing node."""
    node = lambda i, x, y, tag: (f"named_struct('type', 'node', 'id', 10 * sub_id + {i}, 'lon', {x}, 'lat', {y}, 'nodes', CAST(NULL AS ARRAY<BIGINT>), "
                                 f"'geometry', CAST(NULL AS ARRAY<STRUCT<lon:DOUBLE,lat:DOUBLE>>), 'tags', {tag})")
    way = lambda i, nodes, tag: (f"named_struct('type', 'way', 'id', 10 * sub_id + {i}, 'lon', CAST(NULL AS DOUBLE), 'lat', CAST(NULL AS DOUBLE), 'nodes', {nodes}, "
                                 f"'geometry', array(named_struct('lon', x, 'lat', y), named_struct('lon', x + {i}, 'lat', y + 1)), 'tags', {tag})")
    none, sub = "CAST(NULL AS MAP<STRING,STRING>)", "map('power', 'substation', 'voltage', voltage)"
    ids = lambda *k: "array(" + ", ".join(f"10 * sub_id + {i}" for i in k) + ")"
    items = [node(1, "x", "y", none), node(2, "x + 40", "y", none), node(3, "x + 40", "y + 20", none), node(4, "x", "y + 20", sub),
             way(5, ids(1, 2, 3, 4, 1), sub), way(6, ids(1, 2, 3), sub), way(7, ids(1, 99), sub), way(8, ids(1, 2), "map('power', 'line')")]
    return fixture(spark, sf, "stations").selectExpr("sub_id AS doc_id", f"array({', '.join(items)}) AS elements")


@query("overpass_elements_to_features", "stations", """SELECT sub_id * 10 + 4 AS osm_id, 'point' AS geom_source, round(x, 3) AS x, round(y + 20, 3) AS y, voltage FROM fx_stations UNION ALL
    SELECT sub_id * 10 + 5, 'polygon', round(x + 20, 3), round(y + 10, 3), voltage FROM fx_stations UNION ALL
    SELECT sub_id * 10 + 6, 'point', round((3 * x + 80) / 3, 3), round((3 * y + 20) / 3, 3), voltage FROM fx_stations""")
def overpass_elements_to_features(spark, sf):
    out = readers.overpass_elements_to_features(overpass_documents(spark, sf))
    return rounded(out.select("osm_id", "geom_source", "x", "y", "voltage"), "x", "y", digits=3)


@query("overpass_ways_to_lines", "stations", """SELECT sub_id * 10 + k AS osm_id, 2 AS n_points, round(x + k, 3) AS x_end FROM fx_stations, (VALUES (5), (6), (7), (8)) t(k)""")
def overpass_ways_to_lines(spark, sf):
    out = readers.overpass_ways_to_lines(overpass_documents(spark, sf))
    return rounded(out.select("osm_id", F.size("path").alias("n_points"), F.element_at("path", -1)["x"].alias("x_end")), "x_end", digits=3)


@query("clip_on_ingest", "buildings", """SELECT bld_id, round(x, 3) AS xmin, round(y + side, 3) AS ymax FROM fx_buildings WHERE x <= 40000 AND x + side >= 10000
    AND y <= 50000 AND y + side >= 20000""")
def clip_on_ingest(spark, sf):
    out = readers.clip_on_ingest(spread(building_table(spark, sf), "bld_id"), (10000.0, 20000.0, 40000.0, 50000.0), scratch(spark), "inner_edges")
    return rounded(out.select("bld_id", "xmin", "ymax"), "xmin", "ymax", digits=3)


@query("discover_datasets", "patches", "SELECT county_geoid AS dataset, count(*) AS n FROM fx_patches GROUP BY county_geoid")
def discover_datasets(spark, sf):
    """Dataset folders as a run leaves them: the name is read back from the file paths."""
    p = patches(spark, sf).withColumn("path", F.concat(F.lit("/data/"), F.col("county_geoid"), F.expr(
        "CASE WHEN region = 'en' THEN '/raw/metadata.csv' ELSE '/metadata.csv' END")))
    return p.groupBy(readers.dataset_of(F.col("path")).alias("dataset")).agg(F.count(F.lit(1)).alias("n"))


@query("patch_source", None, """SELECT o_orderkey AS point_id, patch_ref, source_rank FROM (SELECT o_orderkey FROM orders) o LEFT JOIN (SELECT user_id, event_id AS patch_ref, source_rank
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY source_rank, event_id) AS rn FROM (SELECT user_id, event_id, length(event_type) AS source_rank FROM events) e) r
    WHERE rn = 1) s ON o.o_orderkey = s.user_id""")
def patch_source(spark, sf):
    ranked = table(spark, sf, "events").selectExpr("user_id AS point_id", "event_id AS patch_ref", "CAST(length(event_type) AS BIGINT) AS source_rank")
    return readers.choose_source(table(spark, sf, "orders").selectExpr("o_orderkey AS point_id"), ranked, "point_id")


@query("write_tables_csv", "stations", "SELECT sub_id, round(x, 3) AS x, nullif(voltage, '') AS voltage FROM fx_stations")
def write_tables_csv(spark, sf):
    folder = scratch(spark)
    sinks.write_tables_csv({"stations": fixture(spark, sf, "stations").select("sub_id", "x", "voltage")}, folder)
    back = spark.read.csv(folder + "/stations", header=True, enforceSchema=False, schema="sub_id BIGINT, x DOUBLE, voltage STRING")
    return rounded(back, "x", digits=3)


@query("write_geojson", "detections", """SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(floor(x) AS BIGINT) || ',' || CAST(floor(y) AS BIGINT) ||
    ']},"properties":{"det_id":' || det_id || '}}' AS value FROM fx_detections""")
def write_geojson(spark, sf):
    folder = scratch(spark)
    d = fixture(spark, sf, "detections").selectExpr("det_id", "CAST(floor(x) AS BIGINT) AS center_lon", "CAST(floor(y) AS BIGINT) AS center_lat")
    sinks.write_geojson(d, folder)
    return spark.read.text(folder)


@query("write_by_split", "patches", f"SELECT split, count(*) AS n FROM (SELECT s.split FROM fx_patches p JOIN ({SPLIT}) s ON p.county_geoid = s.county_geoid) q GROUP BY split")
def write_by_split(spark, sf):
    folder = scratch(spark)
    sinks.write_by_split(split_patches(spark, sf), folder)
    return spark.read.parquet(folder).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("write_summary_json", "patches", "SELECT count(*) AS total_patches, count(*) FILTER (WHERE label = 'positive') AS positive_patches FROM fx_patches")
def write_summary_json(spark, sf):
    folder = scratch(spark)
    sinks.write_summary_json(evaluate.dataset_statistics(patches(spark, sf)), folder)
    return spark.read.schema("total_patches BIGINT, positive_patches BIGINT").json(folder)


@query("optimizer_metadata_contract", "detections", """SELECT 'det_' || lpad(CAST(det_id AS VARCHAR), CAST(greatest(5, length(CAST(det_id AS VARCHAR))) AS INTEGER), '0') AS patch_id, 'positive' AS label,
    '' AS voltage, 'detected' AS substation_type, -1 AS osm_id, 'model' AS geom_source, 'prediction' AS split FROM fx_detections""")
def optimizer_metadata_contract(spark, sf):
    out = sinks.optimizer_metadata_contract(fixture(spark, sf, "detections"), "det_id")
    return out.select("patch_id", "label", "voltage", "substation_type", "osm_id", "geom_source", "split")


# --- jobs ---------------------------------------------------------------------------------

@query("patch_index_job", "patches temporal", f"""WITH pool AS (SELECT p.*, t.acquired, t.edited FROM fx_patches p JOIN fx_temporal t ON p.patch_id = t.patch_id),
    a AS (SELECT county_geoid, count(*) AS available FROM pool WHERE label = 'positive' GROUP BY county_geoid),
    b AS (SELECT *, 200 / count(*) OVER () AS goal FROM a),
    c AS (SELECT county_geoid, CASE WHEN available <= goal THEN available ELSE least(floor((200 - coalesce(sum(CASE WHEN available <= goal THEN available END) OVER (), 0))
        / count(CASE WHEN available > goal THEN 1 END) OVER ()), available) END AS budget FROM b),
    pos AS (SELECT * FROM (SELECT p.*, row_number() OVER (PARTITION BY p.county_geoid ORDER BY {ORDER}) AS rn, c.budget FROM pool p JOIN c
        ON p.county_geoid = c.county_geoid WHERE label = 'positive') r WHERE rn <= budget),
    n AS (SELECT county_geoid, greatest(1, floor(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () * 200)) AS budget FROM pos GROUP BY county_geoid),
    neg AS (SELECT r.* FROM (SELECT p.*, row_number() OVER (PARTITION BY p.county_geoid ORDER BY {ORDER}) AS rn, count(*) OVER (PARTITION BY p.county_geoid) AS sz,
        n.budget FROM pool p JOIN n ON p.county_geoid = n.county_geoid WHERE label = 'negative') r, unnest(range(200)) AS t(i) WHERE rn + i * sz <= budget),
    chosen AS (SELECT patch_id, label, county_geoid, acquired, edited FROM pos UNION ALL SELECT patch_id, label, county_geoid, acquired, edited FROM neg)
    SELECT patch_id, label, CASE WHEN label = 'positive' THEN round({GAP}, 4) END AS temporal_gap_years, label = 'positive' AND coalesce({GAP} > 3.0, false) AS temporal_mismatch FROM chosen""")
def patch_index_query(spark, sf):
    pool = patches(spark, sf).join(fixture(spark, sf, "temporal"), "patch_id")
    out = patch_index_job(pool, "county_geoid", 200, order(), bucket=slices(), split_order=F.expr(GROUP_ORDER))["metadata"]
    return rounded(out.select("patch_id", "label", "temporal_gap_years", "temporal_mismatch"), "temporal_gap_years")


@query("eval_set_job", "patches", f"""SELECT patch_id, label FROM fx_patches WHERE label = 'positive' UNION ALL SELECT patch_id, label FROM (
    SELECT p.patch_id, p.label, row_number() OVER (PARTITION BY p.county_geoid ORDER BY {ORDER}) AS rn, count(*) OVER (PARTITION BY p.county_geoid) AS sz, b.budget
    FROM fx_patches p JOIN (SELECT county_geoid, greatest(1, floor(CAST(available AS DOUBLE) / sum(available) OVER () * floor(sum(available) OVER () * 1.25))) AS budget
    FROM ({POS}) q) b ON p.county_geoid = b.county_geoid WHERE p.label = 'negative') r, unnest(range(1000)) AS t(i) WHERE rn + i * sz <= budget""")
def eval_set_query(spark, sf):
    p = patches(spark, sf)
    training = table(spark, sf, "nation").select(F.col("n_name").alias("county_geoid"))
    return eval_set_job(p.filter("label = 'positive'"), p.filter("label = 'negative'"), training, "county_geoid", order(), bucket=slices()).select("patch_id", "label")

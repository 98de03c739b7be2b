"""Queries on rasters held as array columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.operators import quality, raster, sampling
from geoloom.operators.components import ROW_STEP
from geoloom.plans.fixtures import fixture, patch_arrays, table
from geoloom.plans.jobs import detection_job, evaluation_job, qa_job
from geoloom.plans.registry import query, rounded
from geoloom.plans.selection_sql import detection_turns

BANDS = ["red", "green", "nir"]


def nd(a, b):
    return f"CASE WHEN {a} + {b} > 0 THEN CAST({a} - {b} AS DOUBLE) / ({a} + {b}) ELSE 0.0 END"


def per_pixel(patches, column, out):
    return rounded(raster.pixel_view(patches.withColumn(out, column), "patch_id", [out]), out, digits=6)


@query("pixel_view", "pixels", "SELECT patch_id, row, col, red, nir, mask FROM fx_pixels")
def pixel_view(spark, sf):
    return raster.pixel_view(patch_arrays(spark, sf), "patch_id", ["red", "nir", "mask"])


@query("ndvi", "pixels", f"SELECT patch_id, row, col, round({nd('nir', 'red')}, 6) AS ndvi FROM fx_pixels")
def ndvi(spark, sf):
    return per_pixel(patch_arrays(spark, sf), raster.ndvi(F.col("red"), F.col("nir")), "ndvi")


@query("ndwi", "pixels", f"SELECT patch_id, row, col, round({nd('green', 'nir')}, 6) AS ndwi FROM fx_pixels")
def ndwi(spark, sf):
    return per_pixel(patch_arrays(spark, sf), raster.ndwi(F.col("green"), F.col("nir")), "ndwi")


AUDIT = f"""SELECT patch_id, count(v) AS n_labeled_pixels, coalesce(100.0 * count(*) FILTER (WHERE v > 0.4) / nullif(count(v), 0), 0.0) AS pv,
    coalesce(100.0 * count(*) FILTER (WHERE w > 0.3) / nullif(count(v), 0), 0.0) AS pw, coalesce(avg(v), 0.0) AS mv, coalesce(avg(w), 0.0) AS mw FROM (
    SELECT patch_id, CASE WHEN mask > 0 THEN {nd('nir', 'red')} END AS v, CASE WHEN mask > 0 THEN {nd('green', 'nir')} END AS w FROM fx_pixels) q GROUP BY patch_id"""


@query("label_audit", "pixels", f"""SELECT patch_id, n_labeled_pixels, round_even(pv, 2) AS pct_high_ndvi, round_even(pw, 2) AS pct_water, round_even(mv, 4) AS mean_ndvi_in_label,
    round_even(mw, 4) AS mean_ndwi_in_label, pv > 50 OR pw > 50 AS suspect_label FROM ({AUDIT}) a""")
def label_audit(spark, sf):
    return raster.label_audit(patch_arrays(spark, sf)).select("patch_id", "n_labeled_pixels", "pct_high_ndvi", "pct_water", "mean_ndvi_in_label",
                                                              "mean_ndwi_in_label", "suspect_label")


@query("audit_summary", "pixels", f"""SELECT count(*) AS n_audited, count(*) FILTER (WHERE pv > 50 OR pw > 50) AS n_suspect,
    round(100.0 * count(*) FILTER (WHERE pv > 50 OR pw > 50) / count(*), 4) AS pct_suspect, round(avg(round_even(mv, 4)), 4) AS mean_ndvi,
    round(avg(round_even(pv, 2)), 4) AS mean_pct_high_ndvi, round(avg(round_even(pw, 2)), 4) AS mean_pct_water FROM ({AUDIT}) a""")
def audit_summary(spark, sf):
    return rounded(quality.audit_summary(raster.label_audit(patch_arrays(spark, sf))), "pct_suspect", "mean_ndvi", "mean_pct_high_ndvi", "mean_pct_water")


@query("drop_suspect_labels", "pixels", f"SELECT patch_id FROM ({AUDIT}) a WHERE NOT (pv > 50 OR pw > 50)")
def drop_suspect_labels(spark, sf):
    p = patch_arrays(spark, sf)
    return quality.drop_suspect_labels(p, raster.label_audit(p)).select("patch_id")


@query("validate_patches", "pixels", """SELECT patch_id, NOT bad AS is_valid, CASE WHEN bad THEN 'Image is constant' ELSE '' END AS errors FROM (
    SELECT patch_id, greatest(max(red), max(green), max(nir)) = least(min(red), min(green), min(nir)) AS bad FROM fx_pixels GROUP BY patch_id) p""")
def validate_patches(spark, sf):
    return raster.validate_patches(patch_arrays(spark, sf), BANDS, expected_bands=3, expected_size=8)


@query("mask_bbox", "pixels", """SELECT patch_id, count(m) AS positive_pixels, round_even(count(m) / 64.0E0, 6) AS positive_fraction, min(CASE WHEN m IS NOT NULL THEN row END) AS mask_bbox_row_min,
    max(CASE WHEN m IS NOT NULL THEN row END) AS mask_bbox_row_max, min(CASE WHEN m IS NOT NULL THEN col END) AS mask_bbox_col_min,
    max(CASE WHEN m IS NOT NULL THEN col END) AS mask_bbox_col_max, round_even((max(CASE WHEN m IS NOT NULL THEN col END) - min(CASE WHEN m IS NOT NULL THEN col END) + 1) * 0.6E0, 1)
    AS mask_bbox_width_m FROM (SELECT *, nullif(mask, 0) AS m FROM fx_pixels) p GROUP BY patch_id""")
def mask_bbox(spark, sf):
    return raster.mask_bbox(patch_arrays(spark, sf)).select("patch_id", "positive_pixels", "positive_fraction", "mask_bbox_row_min", "mask_bbox_row_max",
                                                            "mask_bbox_col_min", "mask_bbox_col_max", "mask_bbox_width_m")


@query("filter_min_mask_pixels", "pixels", "SELECT patch_id, sum(mask) AS positive_pixels FROM fx_pixels GROUP BY patch_id HAVING sum(mask) >= 20")
def filter_min_mask_pixels(spark, sf):
    return raster.filter_min_mask_pixels(raster.mask_bbox(patch_arrays(spark, sf)), 20).select("patch_id", "positive_pixels")


@query("distance_raster", "pixels", """SELECT p.patch_id, p.row, p.col, round(coalesce(min(sqrt((p.row - m.row) * (p.row - m.row) + (p.col - m.col) * (p.col - m.col))), sqrt(128.0)) * 0.6, 6) AS distance
    FROM fx_pixels p LEFT JOIN fx_pixels m ON p.patch_id = m.patch_id AND m.mask = 1 GROUP BY p.patch_id, p.row, p.col""")
def distance_raster(spark, sf):
    d = raster.distance_raster(patch_arrays(spark, sf))
    return rounded(raster.pixel_view(d, "patch_id", ["distance"]), "distance", digits=6)


MEAN, STD = (0.485, 0.456, 0.456), (0.229, 0.224, 0.224)


@query("normalize_bands", "pixels", """SELECT patch_id, row, col, round((red / s - 0.485) / 0.229, 6) AS red, round((green / s - 0.456) / 0.224, 6) AS green,
    round((nir / s - 0.456) / 0.224, 6) AS nir FROM (SELECT *, CASE WHEN max(greatest(red, green, nir)) OVER (PARTITION BY patch_id) > 1 THEN 255.0 ELSE 1.0 END AS s
    FROM fx_pixels) p""")
def normalize_bands(spark, sf):
    n = raster.normalize_bands(patch_arrays(spark, sf), BANDS, MEAN, STD, size=8)
    return rounded(raster.pixel_view(n, "patch_id", BANDS), *BANDS, digits=6)


@query("channel_statistics", "pixels", """SELECT class, band, round(avg(v), 4) AS mean, round(stddev_pop(v), 4) AS std FROM (SELECT label AS class, 'red' AS band, red AS v FROM fx_pixels
    UNION ALL SELECT label, 'green', green FROM fx_pixels UNION ALL SELECT label, 'nir', nir FROM fx_pixels) p GROUP BY class, band""")
def channel_statistics(spark, sf):
    return rounded(raster.channel_statistics(patch_arrays(spark, sf), BANDS, ["class"]), "mean", "std")


@query("read_channel_stats", "pixels", """SELECT round(avg(red), 4) AS red_mean, round(avg(green), 4) AS green_mean, round(stddev_pop(red), 4) AS red_std FROM fx_pixels""")
def read_channel_stats(spark, sf):
    """Statistics written as one JSON document and read back by the reader."""
    from geoloom.plans.registry import scratch
    from geoloom.sources.readers import read_channel_stats as read_back
    stats = raster.channel_statistics(patch_arrays(spark, sf), BANDS)
    one = stats.agg(F.array_sort(F.collect_list(F.struct(F.array_position(F.array(*[F.lit(b) for b in BANDS]), F.col("band")).alias("i"), "mean", "std"))).alias("s"))
    folder = scratch(spark)
    one.select(F.to_json(F.struct(F.col("s.mean").alias("mean"), F.col("s.std").alias("std"))).alias("value")).coalesce(1).write.text(folder)
    mean, std = read_back(spark, folder)
    return rounded(spark.createDataFrame([(mean[0], mean[1], std[0])], "red_mean double, green_mean double, red_std double"), "red_mean", "green_mean", "red_std")


def tilted(batch):
    """A stand-in model: logits from the first band."""
    return 8.0 * batch[:, 0, :]


def flat(batch):
    return 2.0 * batch[:, 0, :] + 0.5


@query("score_patches", "pixels", """SELECT patch_id, row, col, round((1 / (1 + exp(-8 * e)) + 1 / (1 + exp(-(2 * e + 0.5)))) / 2, 6) AS prob FROM fx_pixels""")
def score_patches(spark, sf):
    scored = raster.score_patches(patch_arrays(spark, sf).drop("prob"), ["e"], [tilted, flat])
    return rounded(raster.pixel_view(scored, "patch_id", ["prob"]), "prob", digits=6)


@query("threshold_mask", "pixels", "SELECT patch_id, row, col, CAST(prob >= 0.5 AS INTEGER) AS pred FROM fx_pixels")
def threshold_mask(spark, sf):
    p = patch_arrays(spark, sf).withColumn("pred", raster.threshold_mask(F.col("prob")))
    return raster.pixel_view(p, "patch_id", ["pred"])


SEG = """SELECT patch_id, sum(pred * mask) AS i, sum(pred) AS ps, sum(mask) AS ms, avg(prob) AS mean_prob, max(prob) AS max_prob FROM (
    SELECT *, CAST(prob >= 0.55 AS INTEGER) AS pred FROM fx_pixels) p GROUP BY patch_id"""


@query("segmentation_metrics", "pixels", f"""SELECT patch_id, round((i + 1e-6) / (ps + ms - i + 1e-6), 4) AS iou, round((2 * i + 1e-6) / (ps + ms + 1e-6), 4) AS dice,
    round(i / (ps + 1e-6), 4) AS pixel_precision, round(i / (ms + 1e-6), 4) AS pixel_recall, CAST(ps AS BIGINT) AS pred_positive_px, CAST(ms AS BIGINT) AS gt_positive_px,
    round(mean_prob, 4) AS mean_prob, round(max_prob, 4) AS max_prob, round(max_prob, 4) AS patch_score FROM ({SEG}) s""")
def segmentation_metrics(spark, sf):
    out = raster.segmentation_metrics(patch_arrays(spark, sf), 0.55)
    names = ["iou", "dice", "pixel_precision", "pixel_recall", "mean_prob", "max_prob", "patch_score"]
    return rounded(out.select("patch_id", "pred_positive_px", "gt_positive_px", *names), *names)


@query("patch_score_top1pct", None, """SELECT user_id, round(avg(v), 6) AS patch_score FROM (SELECT user_id, value AS v, row_number() OVER (PARTITION BY user_id ORDER BY value DESC) AS rn,
    greatest(1, floor(count(*) OVER (PARTITION BY user_id) * 0.01)) AS k FROM events) r WHERE rn <= k GROUP BY user_id""")
def patch_score_top1pct(spark, sf):
    """Per user, their values standing in for a patch's pixels."""
    arrays = table(spark, sf, "events").groupBy("user_id").agg(F.collect_list("value").alias("prob"))
    return rounded(arrays.select("user_id", raster.patch_score_top1pct(F.col("prob")).alias("patch_score")), "patch_score", digits=6)


def tiles(spark, sf):
    """Patches as overlapping 8x8 tiles of one raster per class: columns of six pixels' step."""
    return patch_arrays(spark, sf).withColumnRenamed("class", "raster").withColumns({
        "row_off": F.expr("CAST(floor(patch_id / 40) * 6 AS INT)"), "col_off": F.expr("CAST(patch_id % 40 * 6 AS INT)")})


MERGED = """SELECT label AS raster, CAST(floor(patch_id / 40) * 6 + row AS INTEGER) AS row, CAST(patch_id % 40 * 6 + col AS INTEGER) AS col, avg(prob) AS prob FROM fx_pixels
    GROUP BY label, floor(patch_id / 40) * 6 + row, patch_id % 40 * 6 + col"""


@query("merge_overlaps", "pixels", f"SELECT raster, row, col, round(prob, 6) AS prob FROM ({MERGED}) m")
def merge_overlaps(spark, sf):
    return rounded(raster.merge_overlaps(tiles(spark, sf), "raster", block=64), "prob", digits=6)


@query("downsample_bands", "pixels", """SELECT patch_id, CAST(floor(row / 2) AS INTEGER) AS row, CAST(floor(col / 2) AS INTEGER) AS col, round(avg(red), 4) AS red, round(avg(nir), 4) AS nir
    FROM fx_pixels GROUP BY patch_id, floor(row / 2), floor(col / 2)""")
def downsample_bands(spark, sf):
    small = raster.downsample_bands(patch_arrays(spark, sf), 2, ["red", "nir"])
    return rounded(raster.pixel_view(small, "patch_id", ["red", "nir"]), "red", "nir")


# Number of a component's first pixel in a patch of eight columns.
FIRST_PIXEL = f"component div {ROW_STEP} * 8 + component % {ROW_STEP}"

COMPONENTS = """WITH RECURSIVE px AS (SELECT patch_id, row, col, row * 8 + col AS id, prob FROM fx_pixels WHERE prob >= 0.55),
    reach AS (SELECT patch_id, id, id AS seed FROM px UNION SELECT b.patch_id, b.id, r.seed FROM reach r JOIN px a ON r.patch_id = a.patch_id AND r.id = a.id
    JOIN px b ON b.patch_id = a.patch_id AND abs(a.row - b.row) + abs(a.col - b.col) = 1),
    comp AS (SELECT patch_id, id, min(seed) AS component FROM reach GROUP BY patch_id, id)"""


@query("connected_components", "pixels", COMPONENTS + " SELECT c.patch_id, p.row, p.col, c.component FROM comp c JOIN px p ON c.patch_id = p.patch_id AND c.id = p.id")
def connected_components(spark, sf):
    labelled = raster.label_patches(patch_arrays(spark, sf), 0.55)
    return raster.pixel_view(labelled, "patch_id", ["labels"]).filter("labels >= 0").withColumnRenamed("labels", "component")


DETECTED = COMPONENTS + """ SELECT c.patch_id, c.component, count(*) AS positive_pixels, round(avg(prob), 6) AS mean_confidence, round(max(prob), 6) AS max_confidence,
    round(1000.0 + (min(col) + max(col)) / 2 * 0.6E0, 4) AS center_lon, round(2000.0 - (min(row) + max(row)) / 2 * 0.6E0, 4) AS center_lat, round(count(*) * 0.36E0, 4) AS area_m2,
    round((max(col) - min(col) + 1) * 0.6E0, 4) AS bbox_width_m, round((max(row) - min(row) + 1) * 0.6E0, 4) AS bbox_height_m
    FROM comp c JOIN px p ON c.patch_id = p.patch_id AND c.id = p.id GROUP BY c.patch_id, c.component HAVING count(*) >= 2"""


def detections(spark, sf, minimum):
    whole = patch_arrays(spark, sf).withColumns({"row0": F.lit(0), "col0": F.lit(0)})
    boxes = raster.block_components(whole, "patch_id", 0.55).withColumn("component", F.expr(FIRST_PIXEL))
    affine = patch_arrays(spark, sf).select("patch_id", F.lit(0.6).alias("a"), F.lit(1000.0).alias("c"), F.lit(-0.6).alias("e"), F.lit(2000.0).alias("f"))
    out = raster.extract_detections(boxes, affine, "patch_id", 0.6, minimum * 0.36)
    return rounded(rounded(out, "center_lon", "center_lat", "area_m2", "bbox_width_m", "bbox_height_m"), "mean_confidence", "max_confidence", digits=6)


@query("extract_detections", "pixels", DETECTED)
def extract_detections(spark, sf):
    return detections(spark, sf, 2)


@query("filter_min_area", "pixels", DETECTED.replace("count(*) >= 2", "count(*) >= 4"))
def filter_min_area(spark, sf):
    return detections(spark, sf, 4)


FOUND = f"""WITH RECURSIVE px AS (SELECT raster, row, col, row * {ROW_STEP}::BIGINT + col AS id, prob FROM ({MERGED}) m WHERE prob >= 0.6),
    reach AS (SELECT raster, id, id AS seed FROM px UNION SELECT b.raster, b.id, r.seed FROM reach r JOIN px a ON r.raster = a.raster AND r.id = a.id
      JOIN px b ON b.raster = a.raster AND abs(a.row - b.row) + abs(a.col - b.col) = 1),
    comp AS (SELECT raster, id, min(seed) AS component FROM reach GROUP BY raster, id),
    boxes AS (SELECT c.raster, c.component, count(*) AS positive_pixels, avg(prob) AS mean_confidence, max(prob) AS max_confidence,
      c.raster * 0.5E0 - 112.0E0 + (min(col) + max(col)) / 2 * 1E-5 AS center_lon, 33.5E0 + (min(row) + max(row)) / 2 * -1E-5 AS center_lat
      FROM comp c JOIN px p ON c.raster = p.raster AND c.id = p.id GROUP BY c.raster, c.component HAVING count(*) >= 2),
    found AS MATERIALIZED (SELECT *, raster * 1125899906842624 + component AS det_id, center_lon * 85000.0E0 AS x, center_lat * 111000.0E0 AS y FROM boxes),
    {detection_turns('found', 10)}
    SELECT raster, component, positive_pixels, round(center_lon, 6) AS center_lon, round(center_lat, 6) AS center_lat, round(mean_confidence, 6) AS mean_confidence,
      round(max_confidence, 6) AS max_confidence FROM found WHERE NOT list_contains(coalesce((SELECT gone FROM walk ORDER BY n DESC LIMIT 1), []), det_id)"""


@query("detection_job", "pixels", FOUND)
def detection_job_query(spark, sf):
    affine = table(spark, sf, "embeddings").select(F.col("label").alias("raster")).distinct().select(
        "raster", F.lit(1e-5).alias("a"), F.col("raster") * 0.5 - 112.0, F.lit(-1e-5).alias("e"), F.lit(33.5).alias("f")).toDF("raster", "a", "c", "e", "f")
    out = detection_job(tiles(spark, sf).drop("prob"), ["e"], [tilted], affine, "raster", threshold=0.6, min_area_m2=2 * 0.36, dedup_m=10.0, block=64)
    return rounded(out.select("raster", "component", "positive_pixels", "center_lon", "center_lat", "mean_confidence", "max_confidence"),
                   "center_lon", "center_lat", "mean_confidence", "max_confidence", digits=6)


@query("evaluation_job", "pixels", f"""SELECT CAST(class AS VARCHAR) AS class, count(*) AS n, round(avg(iou), 4) AS mean_iou, round(avg(dice), 4) AS mean_dice FROM (SELECT s.patch_id, k.label AS class,
    (i + 1e-6) / (ps + ms - i + 1e-6) AS iou, (2 * i + 1e-6) / (ps + ms + 1e-6) AS dice FROM ({SEG}) s JOIN embeddings k ON s.patch_id = k.vec_id WHERE ms > 0) m
    GROUP BY class HAVING count(*) >= 3""")
def evaluation_job_query(spark, sf):
    p = patch_arrays(spark, sf)
    meta = p.select("patch_id", F.exists("mask", lambda v: v > 0).cast("int").alias("target"), F.col("class"))
    out = evaluation_job(p.drop("class"), meta, ["class"], threshold=0.55)["by_class"]
    return rounded(out.select("class", "n", "mean_iou", "mean_dice"), "mean_iou", "mean_dice")


@query("qa_job", "pixels temporal", f"""WITH q AS (SELECT (SELECT count(*) FROM (SELECT patch_id, greatest(max(red), max(green), max(nir)) = least(min(red), min(green), min(nir)) AS bad
    FROM fx_pixels GROUP BY patch_id) p WHERE bad) AS n_invalid, (SELECT count(*) FROM fx_temporal t JOIN embeddings e ON t.patch_id = e.vec_id
    WHERE abs(floor((epoch_us(acquired) - epoch_us(edited)) / 86400000000.0)) / 365.25 > 3.0) AS n_temporal,
    (SELECT count(*) FROM ({AUDIT}) a WHERE pv > 50 OR pw > 50) AS n_suspect, (SELECT count(*) FROM (SELECT patch_id FROM fx_pixels GROUP BY patch_id
    HAVING greatest(max(red), max(green), max(nir)) = least(min(red), min(green), min(nir))) c) AS n_corrupt) SELECT *, concat_ws('; ', CASE WHEN n_invalid > 0 THEN n_invalid || ' invalid patches' END, CASE WHEN n_temporal > 0 THEN
    n_temporal || ' temporal mismatches' END, CASE WHEN n_suspect > 0 THEN n_suspect || ' suspect labels (NDVI/water)' END, CASE WHEN n_corrupt > 0 THEN
    'Possibly corrupt tiles detected' END) AS issues FROM q""")
def qa_job_query(spark, sf):
    return qa_job(patch_arrays(spark, sf), fixture(spark, sf, "temporal"), BANDS, expected_bands=3, expected_size=8)

"""Dataset checks: temporal alignment, label audit summary, consistency, leakage, set rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import scalars as S


def join_timestamps(rows: DataFrame, edits: DataFrame, key: str = "osm_id", out: str = "edited") -> DataFrame:
    """Last edit per feature; ids that are missing or not positive have none."""
    valid = F.when(F.col(key) > 0, F.col(key))
    joined = rows.withColumn("_k", valid).join(edits.select(F.col(key).alias("_k"), out), "_k", "left")
    return joined.drop("_k")


def check_temporal_alignment(rows: DataFrame, max_gap_years: float = 3.0, acquired: str = "acquired",
                             edited: str = "edited") -> DataFrame:
    """Adds ``temporal_gap_years`` and ``temporal_mismatch`` (positives only; unknown dates never mismatch)."""
    positive = F.col("label") == "positive" if "label" in rows.columns else F.lit(True)
    gap = F.when(positive, S.temporal_gap_years(F.col(acquired), F.col(edited)))
    return rows.withColumn("temporal_gap_years", gap).withColumn(
        "temporal_mismatch", F.coalesce(F.col("temporal_gap_years") > max_gap_years, F.lit(False)))


def exclude_flagged(rows: DataFrame, flag: str = "temporal_mismatch") -> DataFrame:
    return rows.filter(~F.col(flag))


def drop_suspect_labels(rows: DataFrame, audit: DataFrame, key: str = "patch_id") -> DataFrame:
    return rows.join(audit.filter("suspect_label").select(key).distinct(), key, "left_anti")


def audit_summary(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.count(F.lit(1)).alias("n_audited"), F.count_if("suspect_label").alias("n_suspect"),
        (100.0 * F.try_divide(F.count_if("suspect_label"), F.count(F.lit(1)))).alias("pct_suspect"),
        F.avg("mean_ndvi_in_label").alias("mean_ndvi"), F.avg("pct_high_ndvi").alias("mean_pct_high_ndvi"),
        F.avg("pct_water").alias("mean_pct_water"))


def resolution_consistency(metadata: DataFrame, resolution: str = "resolution_x", bands: str = "actual_band_count") -> DataFrame:
    return metadata.agg(
        F.min(resolution).alias("res_min"), F.max(resolution).alias("res_max"),
        (F.min(resolution) == F.max(resolution)).alias("res_consistent"), F.min(bands).alias("bands_min"),
        F.max(bands).alias("bands_max"), (F.min(bands) == F.max(bands)).alias("bands_consistent"))


def qa_issue_summary(rows: DataFrame) -> DataFrame:
    """Counts of invalid, misdated, suspect and corrupt patches, and the list of non-zero issues."""
    flags = {"n_invalid": ~F.col("is_valid"), "n_temporal": F.col("temporal_mismatch"),
             "n_suspect": F.col("suspect_label"), "n_corrupt": F.col("possibly_corrupt")}
    # The wording of the issues.
    words = {"n_invalid": "invalid patches", "n_temporal": "temporal mismatches", "n_suspect": "suspect labels (NDVI/water)"}
    counts = rows.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in flags.items()])
    issues = F.array_compact(F.array(*[F.when(F.col(k) > 0, F.concat_ws(" ", F.col(k), F.lit(w)))
                                       for k, w in words.items()],
                                     F.when(F.col("n_corrupt") > 0, "Possibly corrupt tiles detected")))
    return counts.withColumn("issues", F.array_join(issues, "; "))


def contamination_check(evaluation: DataFrame, training: DataFrame, key: str = "county_geoid") -> DataFrame:
    """Keys present on both sides; :func:`require_disjoint` raises on any."""
    return evaluation.select(key).intersect(training.select(key))


def require_disjoint(evaluation: DataFrame, training: DataFrame, key: str = "county_geoid") -> None:
    shared = contamination_check(evaluation, training, key).limit(5).collect()
    if shared:
        raise ValueError(f"evaluation groups also in training: {[r[0] for r in shared]}")


def keep_valid_or_unsampled(rows: DataFrame, checked: DataFrame, key: str = "patch_id") -> DataFrame:
    """Drop only the rows a check found invalid."""
    return rows.join(checked.filter("NOT is_valid").select(key).distinct(), key, "left_anti")


def lookup_counties(wanted: DataFrame, registry: DataFrame, key: str = "geoid") -> DataFrame:
    """Registry rows of the wanted codes; unknown codes raise."""
    unknown = wanted.join(registry, key, "left_anti").select(key).limit(5).collect()
    if unknown:
        raise ValueError(f"unknown county codes: {[r[0] for r in unknown]}")
    return registry.join(wanted.select(key).distinct(), key, "left_semi")


def source_bounds(sources: DataFrame, regions: DataFrame, counties: DataFrame, key: str = "source_id") -> DataFrame:
    """Bounds of a source: its random region, else its county; sources with neither are skipped."""
    sides = ["west", "south", "east", "north"]
    r = regions.select(key, F.struct(*sides).alias("_r"))
    c = counties.select(key, F.struct(*sides).alias("_c"))
    both = sources.join(r, key, "left").join(c, key, "left").withColumn("_b", F.coalesce("_r", "_c"))
    return both.filter("_b IS NOT NULL").select(*sources.columns, "_b.*")


def resume_skip_existing(rows: DataFrame, done: DataFrame, key: str = "patch_id") -> DataFrame:
    return rows.join(done.select(key).distinct(), key, "left_anti")


def keep_on_disk(rows: DataFrame, present: DataFrame, key: str = "patch_id") -> DataFrame:
    return rows.join(present.select(key).distinct(), key, "left_semi")


def inventory_left_join(stations: DataFrame, patches: DataFrame, key: str = "osm_id") -> DataFrame:
    """Every station once; without imagery it stays with zero pixels and its own label and source."""
    found = F.col("_p").isNotNull()
    fields = [c for c in patches.columns if c != key]
    joined = stations.join(patches.select(key, F.struct(*fields).alias("_p")), key, "left")
    return joined.select(
        *stations.columns, F.coalesce("_p.patch_id", F.concat_ws("_", F.lit("inv"), F.col(key))).alias("patch_id"),
        F.when(found, "positive").otherwise("positive_no_imagery").alias("label"),
        F.coalesce("_p.positive_pixels", F.lit(0)).cast("bigint").alias("positive_pixels"),
        F.when(found, F.col("_p.source")).otherwise("no_coverage").alias("source"),
        F.col("_p.mask_bbox_width_m").alias("mask_bbox_width_m"), F.col("_p.mask_bbox_height_m").alias("mask_bbox_height_m"))


# The columns of the published inventory, in order.
INVENTORY_COLUMNS = ("patch_id", "osm_id", "center_lon", "center_lat", "substation_type", "substation_name", "operator",
                     "voltage", "geom_source", "positive_pixels", "mask_bbox_width_m", "mask_bbox_height_m", "label")


def inventory_table(stations: DataFrame, patches: DataFrame, key: str = "osm_id") -> DataFrame:
    """The inventory in its published columns; those no input has are NULL."""
    rows = inventory_left_join(stations, patches, key)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in INVENTORY_COLUMNS])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Rows of all sources; a source without any column of another gets NULL there."""
    if not frames:
        raise ValueError("every source failed")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def unsigned_county(geoid: Column) -> Column:
    """County code stored as a number → five characters with its leading zero."""
    return S.padded(geoid.cast("bigint"), 5)

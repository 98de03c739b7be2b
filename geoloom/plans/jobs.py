"""End-to-end jobs as compositions of the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import scalars as S
from geoloom.operators import demand, evaluate, quality, raster, sampling, selection, service, siting
from geoloom.operators.checkpoints import materialise


def siting_job(cells: DataFrame, stations: DataFrame, segments: DataFrame | None, data_centers: DataFrame | None, *,
               budget: int = 50, radius_m: float = service.SERVICE_RADIUS_M, coverage_m: float = service.COVERAGE_M,
               build_cost: float = service.BUILD_COST, min_demand_kw: float = 200.0, line_distance_m: float = 20000.0,
               dc_radius_m: float = 10000.0, tolerance: float = 0.01, gap_m: float = service.GAP_M) -> dict[str, DataFrame]:
    """Cells and stations → candidates, picks, assignment, tables and summary.

    ``cells`` may be block groups (``rings, population, building_area_m2``): the demand grid is then built here. A run whose cover phase is over
    budget has ``status`` INFEASIBLE, and its summary keeps only what does not depend on the picks; areas are feasible or not together.
    """
    if "rings" in cells.columns:
        cells = materialise(demand.build_demand_grid(cells).withColumnsRenamed({"cx": "x", "cy": "y"}))
    sites = demand.generate_candidates(cells, stations, segments, data_centers, min_demand_kw, line_distance_m, dc_radius_m)
    # Data-centre ids follow the cell ids: twice the id, odd for data centres, keeps both unique.
    candidates = materialise(sites.withColumn("candidate_id", F.col("source_id") * 2 + (F.col("source") == "data_center").cast("int")))
    # The nearest server of each cell says what is in reach; of the pairs only those that can decide anything are written.
    near = materialise(service.nearest_servers(cells, stations, candidates, radius_m))
    kept = service.unreachable_check(cells, near, tolerance)
    eligible = materialise(service.deciding_in_range(cells, stations, candidates, radius_m, coverage_m))
    area = kept if "area_id" in kept.columns else kept.withColumn("area_id", F.lit(0))
    all_picks = siting.greedy_siting(area, eligible, None, build_cost)
    status = siting.siting_status(area, all_picks, [budget])
    picks = all_picks.filter(F.col("step") <= budget)
    built = candidates.join(picks.select("candidate_id").distinct(), "candidate_id", "left_semi").select("candidate_id", "x", "y")
    assignment = materialise(service.assign_nearest_open(eligible, built))
    far = service.constrained_cells(kept, near, coverage_m)
    summary = service.results_summary(kept, stations, near, assignment, built, build_cost, coverage_m, gap_m)
    feasible = status.agg(F.coalesce(F.every(F.col("status") == "FEASIBLE"), F.lit(True))).scalar()
    chosen = ["n_new_substations", "total_new_load_served_kw", "new_coverage_area_km2", "avg_service_dist_after_m", "max_service_dist_after_m",
              "coverage_gap_after_pct", "assignment_cost", "build_cost", "total_objective"]
    summary = summary.withColumn("status", F.when(feasible, "FEASIBLE").otherwise("INFEASIBLE"))
    summary = summary.withColumns({c: F.when(F.col("status") == "FEASIBLE", F.col(c)) for c in chosen})
    return {
        "candidates": candidates, "pairs": service.service_pairs(cells, stations, candidates, radius_m), "picks": picks, "all_picks": all_picks, "status": status,
        "assignment": assignment, "sites": service.per_substation_table(built, kept, assignment),
        "summary": summary,
        "expansion": selection.rank_expansion_clusters(
            selection.cluster_constrained(far, stations, segments, coverage_m)),
    }


def patch_index_job(pool: DataFrame, source: str, total_positive: int, order: Column, *, bucket: Column | None = None,
                    split_order: Column | None = None, max_gap_years: float = 3.0) -> dict[str, DataFrame]:
    """Pool of labelled patches → balanced sample with temporal check and geographic split.

    ``pool``: ``patch_id, label, positive_pixels, acquired, edited`` and the source column.
    """
    positives = pool.filter("label = 'positive'")
    budgets = sampling.allocate_balanced(sampling.available(positives, source), total_positive)
    sampled = sampling.sample_per_source(positives, budgets, [source], order, bucket).drop("draw")
    negatives = pool.filter("label = 'negative'")
    n_neg = sampling.allocate_negatives(sampling.available(sampled, source), total_positive)
    chosen = sampled.unionByName(sampling.sample_per_source(negatives, n_neg, [source], order, bucket).drop("draw"))
    dated = quality.check_temporal_alignment(chosen, max_gap_years)
    split = sampling.assign_splits_geographic(dated, source, split_order)
    return {"metadata": split, "statistics": evaluate.dataset_statistics(split),
            "splits": evaluate.split_summary(split, counties=source)}


def eval_set_job(features: DataFrame, negatives: DataFrame, training: DataFrame, source: str, order: Column, *,
                 ratio: float = 1.25, bucket: Column | None = None) -> DataFrame:
    """Every positive of the held-out sources plus ``ratio`` times as many negatives; raises on shared sources."""
    quality.require_disjoint(features, training, source)
    budgets = sampling.allocate_negatives(sampling.available(features, source), ratio=ratio)
    picked = sampling.sample_per_source(negatives, budgets, [source], order, bucket).drop("draw")
    return features.unionByName(picked, allowMissingColumns=True)


def detection_job(windows: DataFrame, bands: Sequence[str], models: Sequence, affine: DataFrame, raster_id: str, *, combine: str = "mean",
                  threshold: float = 0.5, min_area_m2: float = 200.0, resolution: float = 0.6, dedup_m: float | None = 100.0,
                  to_lonlat=None, block: int = raster.BLOCK) -> DataFrame:
    """Windows of rasters → scores → merged blocks → components → detections → duplicates removed.

    ``windows``: ``raster_id, row_off, col_off, height, width`` and band arrays, as :func:`grids.tile_windows` lays them out.
    """
    scored = raster.score_patches(windows, bands, models, combine)
    blocks = raster.merge_tiles(scored, raster_id, block)
    # A pixel that no window covers is no detection, whatever the threshold.
    certain = F.zip_with("prob", "covered", lambda p, n: F.when(n > 0, p).otherwise(F.lit(float("-inf"))))
    boxes = raster.block_components(blocks.withColumn("prob", certain), raster_id, threshold)
    found = raster.extract_detections(boxes, affine, raster_id, resolution, min_area_m2, to_lonlat)
    if dedup_m is None:
        return found
    placed = materialise(found.withColumns({
        "det_id": F.struct(raster_id, "component"),
        "x": F.col("center_lon") * 85000.0, "y": F.col("center_lat") * 111000.0}))
    return selection.dedup_detections(placed, "det_id", dedup_m).drop("x", "y")


def evaluation_job(patches: DataFrame, metadata: DataFrame, groups: Sequence[str], *, threshold: float = 0.5) -> dict[str, DataFrame]:
    """Patches with ``prob`` and ``mask`` → per-patch results and every breakdown table."""
    results = raster.segmentation_metrics(patches, threshold).drop("prob", "mask", "red", "green", "nir", "e")
    joined = evaluate.join_results_metadata(results, metadata, ["target", *groups])
    table = evaluate.score_table(joined)
    out = {"results": joined, "overall": evaluate.overall_summary(joined), "confusion": evaluate.confusion_counts(joined),
           "roc_auc": evaluate.roc_auc(table), "average_precision": evaluate.average_precision(table),
           "by_size": evaluate.size_binned_metrics(joined), "false_negatives": evaluate.worst_false_negatives(joined),
           "false_positives": evaluate.worst_false_positives(joined)}
    return out | {f"by_{g}": evaluate.grouped_metrics(joined, g) for g in groups}


def qa_job(patches: DataFrame, dates: DataFrame, bands: Sequence[str], *, expected_bands: int, expected_size: int,
           max_gap_years: float = 3.0) -> DataFrame:
    """Validation, temporal alignment, label audit and constant-patch check → one issue summary."""
    valid = raster.validate_patches(patches, bands, expected_bands, expected_size)
    audit = raster.label_audit(patches).select("patch_id", "suspect_label")
    corrupt = patches.select("patch_id", S.is_constant(*[F.col(b) for b in bands]).alias("possibly_corrupt"))
    gaps = quality.check_temporal_alignment(dates, max_gap_years).select("patch_id", "temporal_mismatch")
    rows = valid.join(audit, "patch_id", "left").join(corrupt, "patch_id", "left").join(gaps, "patch_id", "left")
    return quality.qa_issue_summary(rows)

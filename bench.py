"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``: one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from geoloom.plans.catalog import QUERIES

HEADLINE = (
    "baseline_service_metrics", "radius_join", "nearest_join", "polyline_distance_join", "anti_join_uncovered",
    "spatial_join_within", "overlay_intersection", "areal_interpolate", "generate_candidates", "eligible_pairs",
    "assigned_service_metrics", "per_substation_table", "site_restrictions_join", "self_join_dedup_pairs",
    "dedup_detections_priority", "greedy_siting", "cluster_constrained", "sample_per_source", "assign_splits_geographic",
    "grouped_metrics", "roc_auc", "average_precision", "dataset_statistics", "temporal_gap", "label_audit",
    "segmentation_metrics", "distance_raster", "merge_overlaps", "extract_detections", "rasterize_mask",
    "budget_sweep", "siting_job", "dedup_features", "dedup_detections", "detection_job", "connected_components", "positive_patch_rows",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query, so that starting the JVM is not charged to the first one.
    QUERIES["filter_min_demand"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()

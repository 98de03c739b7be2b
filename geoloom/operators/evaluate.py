"""Evaluation tables: grouped and binned metrics, ranking curves, worst cases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.scalars import blank_to_null
from geoloom.operators.skew import exact_quantiles, running_totals

# Right-closed size bins in positive pixels.
SIZE_EDGES = (0, 200, 1000, 5000, 20000, 200000)


def normalise_eval_metadata(metadata: DataFrame, text_columns: Sequence[str]) -> DataFrame:
    """Missing columns are created, blanks filled, and ``target`` derived from the label."""
    out = metadata.withColumns({c: F.coalesce(F.col(c), F.lit("")) if c in metadata.columns else F.lit("")
                                for c in text_columns})
    pixels = F.coalesce(F.col("positive_pixels"), F.lit(0)) if "positive_pixels" in metadata.columns else F.lit(0)
    return out.withColumns({"positive_pixels": pixels.cast("bigint"), "target": F.coalesce(
        (F.col("label") == "positive").cast("int"), F.lit(0))})


def _scores() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.avg("iou").alias("mean_iou"), F.stddev_samp("iou").alias("std_iou"),
            F.avg("dice").alias("mean_dice"), F.avg("pixel_precision").alias("mean_precision"),
            F.avg("pixel_recall").alias("mean_recall")]


def grouped_metrics(results: DataFrame, column: str, min_n: int = 3) -> DataFrame:
    """Positives by group, blank groups as ``(untagged)``, small groups left out, largest first."""
    group = F.coalesce(blank_to_null(F.col(column).cast("string")), F.lit("(untagged)"))
    rows = results.filter("target = 1").withColumn(column, group)
    medians = exact_quantiles(rows, "gt_positive_px", {"median_gt_px": 0.5}, [column])
    return rows.groupBy(column).agg(*_scores()).filter(F.col("n") >= min_n).join(medians, column, "left").orderBy(F.desc("n"), column)


def group_breakdown(results: DataFrame, dataset: str, column: str) -> DataFrame:
    """Positives by dataset and group; blank groups are dropped."""
    return results.filter("target = 1").filter(blank_to_null(F.col(column).cast("string")).isNotNull()).groupBy(
        dataset, column).agg(*_scores())


def size_bin(pixels: Column, edges: Sequence[int] = SIZE_EDGES) -> Column:
    """Index of the right-closed bin, NULL outside the edges."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 1, 0, -1):
        out = F.when((pixels > edges[i - 1]) & (pixels <= edges[i]), i - 1).otherwise(out)
    return out


def size_binned_metrics(results: DataFrame, edges: Sequence[int] = SIZE_EDGES) -> DataFrame:
    names = F.array(*[F.lit(f"{a}-{b} px") for a, b in zip(edges, edges[1:])])
    return results.filter("target = 1").withColumn("bin", size_bin(F.col("gt_positive_px"), edges)).filter(
        "bin IS NOT NULL").groupBy("bin").agg(*_scores()).withColumn(
        "size_bin", F.element_at(names, F.col("bin") + 1)).orderBy("bin")


def overall_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    rows = results.filter("target = 1")
    found = rows.groupBy(*by).agg(*_scores())
    medians = exact_quantiles(rows, "iou", {"median_iou": 0.5}, by)
    return found.join(medians, list(by), "left") if by else found.withColumn("median_iou", medians.select("median_iou").scalar())


def macro_average(per_dataset: DataFrame, column: str = "mean_iou") -> DataFrame:
    """Unweighted mean over datasets."""
    return per_dataset.agg(F.avg(column).alias("macro_" + column), F.count(F.lit(1)).alias("n_datasets"))


def confusion_counts(scores: DataFrame, threshold: float = 0.5, score: str = "patch_score") -> DataFrame:
    hit, true = F.col(score) >= threshold, F.col("target") == 1
    c = scores.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"),
                   F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))
    return c.withColumn("f1", F.coalesce(F.try_divide(2.0 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
                                         F.lit(0.0)))


def score_table(scores: DataFrame, score: str = "patch_score") -> DataFrame:
    """One row per distinct score, highest first: counts at the score and cumulative ``tp``, ``fp``.

    Rows are combined per score before anything is ordered, then accumulated range by range.
    """
    per = scores.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col("target") == 1).alias("pos"), F.count_if(F.col("target") != 1).alias("neg"))
    return running_totals(per, "score", {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True)


def _totals(table: DataFrame) -> DataFrame:
    total = table.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    return table.withColumn("_all", total)


def roc_auc(table: DataFrame) -> DataFrame:
    """Area under the ROC curve from a :func:`score_table`; equal scores count half."""
    t = _totals(table)
    won = F.col("pos") * (F.col("_all.n") - F.col("fp") + F.col("neg") / 2.0)
    return t.agg(F.try_divide(F.sum(won), F.max(F.col("_all.p").cast("double") * F.col("_all.n"))).alias("roc_auc"))


def average_precision(table: DataFrame) -> DataFrame:
    """Sum over descending distinct scores of recall gained times precision."""
    t = _totals(table)
    step = F.try_divide(F.col("pos").cast("double"), F.col("_all.p")) * F.col("tp") / (F.col("tp") + F.col("fp"))
    return t.agg(F.sum(step).alias("average_precision"))


def tune_threshold(table: DataFrame) -> DataFrame:
    """Score threshold with the best F1 (ties: the higher threshold)."""
    t = _totals(table)
    f1 = F.try_divide(2.0 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("_all.p"))
    best = t.withColumn("f1", F.round(f1, 12)).agg(F.max(F.struct("f1", "score")).alias("b"))
    return best.select(F.col("b.score").alias("threshold"), F.col("b.f1").alias("f1"))


def worst_false_negatives(results: DataFrame, n: int = 20) -> DataFrame:
    return results.filter("target = 1").orderBy("iou", "patch_id").limit(n)


def worst_false_positives(results: DataFrame, n: int = 20) -> DataFrame:
    return results.filter("target = 0").orderBy(F.desc("patch_score"), "patch_id").limit(n)


def join_results_metadata(results: DataFrame, metadata: DataFrame, columns: Sequence[str],
                          key: str = "patch_id") -> DataFrame:
    return results.join(metadata.select(key, *columns), key, "left")


def type_distribution(rows: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return counts.limit(top) if top else counts


def dataset_statistics(metadata: DataFrame) -> DataFrame:
    pos = F.when(F.col("label") == "positive", F.col("positive_pixels"))
    median = exact_quantiles(metadata.filter("label = 'positive'"), "positive_pixels", {"median": 0.5}).scalar()
    return metadata.agg(
        F.count(F.lit(1)).alias("total_patches"), F.count_if(F.col("label") == "positive").alias("positive_patches"),
        F.count_if(F.col("label") == "negative").alias("negative_patches"),
        F.avg((F.col("label") == "positive").cast("int")).alias("balance_ratio"), F.avg(pos).alias("px_mean"),
        F.stddev_samp(pos).alias("px_std"), F.min(pos).alias("px_min"), F.max(pos).alias("px_max")).withColumn("px_median", median)


def label_pivot(metadata: DataFrame, column: str, labels: Sequence[str] = ("negative", "positive")) -> DataFrame:
    """Patches per group and label, 0 where a pair does not occur."""
    return metadata.groupBy(column).pivot("label", list(labels)).count().na.fill(0)


def split_summary(metadata: DataFrame, by: Sequence[str] = ("split",), counties: str = "county_geoid") -> DataFrame:
    return metadata.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_patches"), F.count_if(F.col("label") == "positive").alias("n_positive"),
        F.count_if(F.col("label") == "negative").alias("n_negative"),
        F.count_if(F.col("label") == "positive_no_imagery").alias("n_no_imagery"),
        F.sort_array(F.collect_set(counties)).alias("counties"))


def detection_summary(detections: DataFrame) -> DataFrame:
    a = F.col("area_m2")
    median = exact_quantiles(detections, "area_m2", {"median": 0.5}).scalar()
    return detections.agg(
        F.count(F.lit(1)).alias("n"), F.min(a).alias("area_min"),
        F.max(a).alias("area_max"), F.min("mean_confidence").alias("conf_min"), F.avg("mean_confidence").alias("conf_mean"),
        F.max("mean_confidence").alias("conf_max"), F.count_if(a < 1000).alias("n_small"),
        F.count_if((a >= 1000) & (a < 10000)).alias("n_medium"), F.count_if(a >= 10000).alias("n_large")).withColumn("area_median", median)


def suitability_counts(sites: DataFrame) -> DataFrame:
    return sites.agg(*[F.count_if(F.col("suitability") == s).alias(f"n_{s}") for s in ("suitable", "restricted", "caution")])

"""Writers: partitioned tables, GeoJSON lines, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import scalars as S
from geoloom.operators.skew import ranked


def optimizer_metadata_contract(detections: DataFrame, order: str) -> DataFrame:
    """Detections → the metadata columns the siting job reads; ids follow ``order`` (unique)."""
    numbered = ranked(detections, order, "_n")
    return numbered.withColumns({
        "patch_id": S.detection_id(F.col("_n") - 1), "label": F.lit("positive"), "voltage": F.lit(""),
        "substation_type": F.lit("detected"), "osm_id": F.lit(-1).cast("bigint"), "geom_source": F.lit("model"),
        "split": F.lit("prediction")}).drop("_n")


def write_tables_csv(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").csv(f"{folder}/{name}", header=True)


def geojson_lines(points: DataFrame, lon: str = "center_lon", lat: str = "center_lat") -> DataFrame:
    """One GeoJSON feature per row as text; other columns become properties."""
    rest = [c for c in points.columns if c not in (lon, lat)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(*rest).alias("properties"))
    return points.select(F.to_json(feature).alias("value"))


def write_geojson(points: DataFrame, path: str, **kw) -> None:
    """Newline-delimited features: writes in parallel, any size."""
    geojson_lines(points, **kw).write.mode("overwrite").text(path)


def write_by_split(rows: DataFrame, path: str) -> None:
    """One folder per split, written by all tasks: no shuffle to one task per split."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def write_summary_json(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)

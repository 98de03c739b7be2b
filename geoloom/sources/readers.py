"""Landed CSV, JSON, GeoJSON and Parquet files → tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from geoloom.functions import geometry as G
from geoloom.functions import scalars as S
from geoloom.sources import schemas
from geoloom.sources.ranges import read_feature_ranges

# Channel statistics used when a file gives none (red, green, blue, near infrared).
DEFAULT_MEAN = (0.485, 0.456, 0.406, 0.456)
DEFAULT_STD = (0.229, 0.224, 0.225, 0.224)


def _exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def filter_bbox_points(df: DataFrame, bbox: tuple[float, float, float, float], x: str = "center_lon",
                       y: str = "center_lat", inclusive: bool = False) -> DataFrame:
    x0, y0, x1, y1 = bbox
    cx, cy = F.col(x), F.col(y)
    if inclusive:
        return df.filter(cx.between(x0, x1) & cy.between(y0, y1))
    return df.filter((cx > x0) & (cx < x1) & (cy > y0) & (cy < y1))


def filter_bbox_polygons(df: DataFrame, bbox: tuple[float, float, float, float], edges: str = "edges") -> DataFrame:
    """Polygons that meet the closed box."""
    return df.filter(G.polygon_intersects_box(F.col(edges), *[F.lit(float(v)) for v in bbox]))


def select_detections(df: DataFrame, county_geoid: str, bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Positive rows of one county; county codes may have lost their leading zero."""
    same = S.padded(F.col("county_geoid"), 5) == county_geoid.zfill(5)
    out = df.filter((F.col("label") == "positive") & same)
    return filter_bbox_points(out, bbox) if bbox else out


def read_detections(spark: SparkSession, path: str, county_geoid: str,
                    bbox: tuple[float, float, float, float] | None = None) -> DataFrame:
    raw = spark.read.csv(path, header=True, enforceSchema=False, schema=None)
    want = [f.strip().split(" ") for f in schemas.DETECTIONS.split(",")]
    typed = raw.select(*[F.col(n).try_cast(t).alias(n) if n in raw.columns else F.lit(None).cast(t).alias(n)
                         for n, t in want])
    out = select_detections(typed, county_geoid, bbox)
    if out.isEmpty():
        raise ValueError(f"no positive detections for county {county_geoid}")
    return out


def parse_census_population(documents: DataFrame, value: str = "value") -> DataFrame:
    """Array-of-arrays with a header row → ``GEOID, population``."""
    rows = documents.select(F.from_json(value, schemas.CENSUS).alias("r"))
    header = F.col("r")[0]
    body = F.slice("r", F.lit(2), F.greatest(F.size("r") - 1, F.lit(0)))
    cells = rows.select(header.alias("h"), F.explode(body).alias("v")).select(F.map_from_arrays("h", "v").alias("m"))
    part = lambda k: F.element_at("m", F.lit(k))
    return cells.select(F.concat(part("state"), part("county"), part("tract"), part("block group")).alias("GEOID"),
                        part("P1_001N").cast("int").alias("population"))


def read_census_population(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One document per file, or per line."""
    return parse_census_population(spark.read.text(path, wholetext=not lines))


def _rings(geometry: Column) -> Column:
    """GeoJSON Polygon or MultiPolygon coordinates → oriented rings."""
    multi = F.from_json(geometry["coordinates"], "array<array<array<array<double>>>>")
    single = F.array(F.from_json(geometry["coordinates"], "array<array<array<double>>>"))
    parts = F.when(geometry["type"] == "MultiPolygon", multi).when(geometry["type"] == "Polygon", single)
    points = lambda ring: F.transform(ring, lambda p: G.point(p[0], p[1]))
    return F.flatten(F.transform(parts, lambda part: G.orient_rings(F.transform(part, points))))


def _path(coordinates: Column) -> Column:
    return F.transform(F.from_json(coordinates, "array<array<double>>"), lambda p: G.point(p[0], p[1]))


def geojson_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row per feature: ``properties MAP, geometry``.

    ``lines`` reads one document per line (a collection or a bare feature), which Spark can
    split over tasks; otherwise every file is one document and one task.
    """
    docs = spark.read.schema(schemas.GEOJSON).json(path, multiLine=not lines)
    bare = F.array(F.struct("properties", "geometry"))
    return docs.select(F.explode(F.coalesce("features", bare)).alias("f")).select("f.properties", "f.geometry").filter(
        "geometry IS NOT NULL")


def polygons_from_features(features: DataFrame) -> DataFrame:
    return features.withColumn("rings", _rings(F.col("geometry"))).filter("rings IS NOT NULL").select("properties", "rings")


def read_block_groups(spark: SparkSession, path: str, state_fips: str, county_fips: str, lines: bool = False, ranges: bool = False) -> DataFrame:
    """``ranges`` reads a large collection in one task per byte range."""
    p = F.col("properties")
    rows = polygons_from_features(read_feature_ranges(spark, path) if ranges else geojson_features(spark, path, lines))
    wanted = (F.element_at(p, F.lit("STATEFP")) == state_fips) & (F.element_at(p, F.lit("COUNTYFP")) == county_fips)
    return rows.filter(wanted).select(*[F.element_at(p, F.lit(k)).alias(k) for k in ("GEOID", "STATEFP", "COUNTYFP")], "rings")


def read_building_footprints(spark: SparkSession, parquet_path: str, geojson_path: str,
                             lines: bool = False, range_bytes: int | None = None) -> DataFrame | None:
    """``rings`` from the first file that exists; None when neither does. With ``range_bytes`` a large collection is read in one task per range."""
    table = _exists(lambda: spark.read.parquet(parquet_path))
    if table is not None:
        return table.select("rings")
    whole = lambda: geojson_features(spark, geojson_path, lines)
    features = _exists(whole if range_bytes is None else lambda: read_feature_ranges(spark, geojson_path, range_bytes))
    return None if features is None else polygons_from_features(features).select("rings")


def read_transmission_lines(spark: SparkSession, *paths: str, lines: bool = False) -> DataFrame | None:
    """``line_id`` properties and ``path`` per line; None when no file exists or none holds a line."""
    found = [f for f in (_exists(lambda p=p: geojson_features(spark, p, lines)) for p in paths) if f is not None]
    if not found:
        return None
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    g = F.col("geometry")
    multi = F.transform(F.from_json(g["coordinates"], "array<array<array<double>>>"),
                        lambda line: F.transform(line, lambda p: G.point(p[0], p[1])))
    paths_found = every.withColumn("path", F.explode(F.when(g["type"] == "MultiLineString", multi).when(
        g["type"] == "LineString", F.array(_path(g["coordinates"]))))).filter(F.size("path") >= 2).select("properties", "path")
    return None if paths_found.isEmpty() else paths_found


def line_segments(lines: DataFrame, path: str = "path") -> DataFrame:
    return lines.select(*[c for c in lines.columns if c != path], F.explode(G.path_segments(F.col(path))).alias("_s")).select(
        *[c for c in lines.columns if c != path], "_s.*")


def select_data_centers(df: DataFrame, state_fips: str, county_fips: str) -> DataFrame:
    return df.filter((F.col("state_id") == int(state_fips))
                     & (S.padded(F.col("county_id"), 3) == county_fips) & F.col("sqft").isNotNull())


def read_data_centers(spark: SparkSession, path: str, state_fips: str, county_fips: str) -> DataFrame | None:
    table = _exists(lambda: spark.read.csv(path, header=True, enforceSchema=False, schema=schemas.DATA_CENTERS))
    if table is None:
        return None
    out = select_data_centers(table, state_fips, county_fips)
    return None if out.isEmpty() else out


def overpass_elements_to_features(documents: DataFrame) -> DataFrame:
    """Tagged stations of Overpass documents ``doc_id, elements``.

    Node → point. Way with at least four resolved nodes that closes → polygon; else with
    at least two → point at the mean of its nodes. Nodes a document does not list are skipped.
    """
    e = documents.select("doc_id", F.explode("elements").alias("e")).select("doc_id", "e.*")
    nodes = e.filter("type = 'node'")
    is_station = F.try_element_at("tags", F.lit("power")) == "substation"
    text = lambda k: F.coalesce(F.try_element_at("tags", F.lit(k)), F.lit(""))
    tags = [text("name").alias("name"), text("operator").alias("operator"), text("voltage").alias("voltage"),
            text("substation").alias("substation_type")]
    points = nodes.filter(is_station).select(
        "doc_id", F.col("id").alias("osm_id"), F.lit("node").alias("osm_type"), F.lit("point").alias("geom_source"),
        F.col("lon").alias("x"), F.col("lat").alias("y"), F.lit(None).cast("array<array<struct<x:double,y:double>>>").alias("rings"),
        *tags)
    ways = e.filter((F.col("type") == "way") & is_station)
    refs = ways.select("doc_id", F.col("id").alias("way_id"), F.posexplode("nodes").alias("pos", "id"))
    # A way lists at most a few thousand nodes, so its vertex list is bounded.
    shapes = refs.join(nodes.select("doc_id", "id", "lon", "lat"), ["doc_id", "id"]).groupBy("doc_id", "way_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("v"))
    ring = F.transform("v", lambda p: G.point(p["lon"], p["lat"]))
    w = ways.withColumnRenamed("id", "way_id").join(shapes.withColumn("ring", ring), ["doc_id", "way_id"]).filter(
        F.size("ring") >= 2)
    closed = (F.size("ring") >= 4) & (F.col("ring")[0] == F.try_element_at("ring", F.lit(-1)))
    mean = lambda k: F.aggregate("ring", F.lit(0.0), lambda a, p: a + p[k]) / F.size("ring")
    w = w.withColumn("_closed", closed)
    centre = F.when(F.col("_closed"), G.polygon_centroid(G.ring_edges(F.col("ring")))).otherwise(G.point(mean("x"), mean("y")))
    shaped = w.withColumn("_c", centre).select(
        "doc_id", F.col("way_id").alias("osm_id"), F.lit("way").alias("osm_type"),
        F.when(F.col("_closed"), "polygon").otherwise("point").alias("geom_source"), F.col("_c.x").alias("x"),
        F.col("_c.y").alias("y"), F.when(F.col("_closed"), G.orient_rings(F.array("ring"))).alias("rings"), *tags)
    return points.unionByName(shaped)


def overpass_ways_to_lines(documents: DataFrame) -> DataFrame:
    """Ways with inline geometry of at least two points → ``doc_id, osm_id, path, tags``."""
    e = documents.select("doc_id", F.explode("elements").alias("e")).select("doc_id", "e.*")
    path = F.transform("geometry", lambda p: G.point(p["lon"], p["lat"]))
    return e.filter("type = 'way' AND size(geometry) >= 2").select("doc_id", F.col("id").alias("osm_id"), path.alias("path"), "tags")


def read_overpass(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.OVERPASS).json(path, multiLine=True).withColumn("doc_id", F.col("_metadata.file_path"))


def clip_on_ingest(features: DataFrame, bbox: tuple[float, float, float, float], path: str | None = None,
                   edges: str = "edges") -> DataFrame:
    """Features that meet the box, with envelope columns; written to Parquet when ``path`` is given,
    so later reads prune row groups by the envelope."""
    from geoloom.operators.spatial import _edge_box
    boxed = features.withColumn("_b", _edge_box(F.col(edges))).select(*features.columns, "_b.*")
    x0, y0, x1, y1 = bbox
    near = (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    out = filter_bbox_polygons(boxed.filter(near), bbox, edges)
    if path is not None:
        out.write.mode("overwrite").parquet(path)
        return out.sparkSession.read.parquet(path)
    return out


def parse_channel_stats(documents: DataFrame, value: str = "value") -> DataFrame:
    return documents.select(F.from_json(value, schemas.CHANNEL_STATS).alias("s")).select("s.mean", "s.std")


def read_channel_stats(spark: SparkSession, path: str) -> tuple[list[float], list[float]]:
    """Per band mean and deviation: one small record, or the defaults when there is no file."""
    table = _exists(lambda: spark.read.text(path, wholetext=True))
    row = None if table is None else parse_channel_stats(table).first()
    return (list(DEFAULT_MEAN), list(DEFAULT_STD)) if row is None else (row["mean"], row["std"])


def dataset_of(path: Column) -> Column:
    """Dataset name of a metadata file path."""
    return F.regexp_extract(path, "([^/]+)/(?:raw/)?metadata\\.csv$", 1)


def discover_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Rows of ``*/metadata.csv`` and ``*/raw/metadata.csv`` with their ``dataset``, else of a flat folder.

    A dataset with both files is read from the direct one.
    """
    read = lambda p: _exists(lambda: spark.read.csv(p, header=True).withColumn("_file", F.col("_metadata.file_path")))
    nested = [f for f in (read(f"{root}/*/metadata.csv"), read(f"{root}/*/raw/metadata.csv")) if f is not None]
    if not nested:
        flat = read(f"{root}/metadata.csv")
        if flat is None:
            raise ValueError(f"no metadata.csv under {root}")
        return flat.withColumn("dataset", dataset_of(F.col("_file"))).drop("_file")
    name = dataset_of(F.col("_file"))
    first = nested[0].withColumn("dataset", name)
    for more in nested[1:]:
        extra = more.withColumn("dataset", name).join(first.select("dataset").distinct(), "dataset", "left_anti")
        first = first.unionByName(extra, allowMissingColumns=True)
    return first.drop("_file")


def read_patches(spark: SparkSession, glob: str, decode: Callable[[bytes], dict], schema: str) -> DataFrame:
    """Rasters as patch rows through a caller's decoder (file bytes → a dict of ``schema`` fields).

    Adds ``patch_id`` from the file name, ``sha256`` and ``possibly_corrupt``: all arrays of the patch hold one value.
    """
    files = spark.read.format("binaryFile").load(glob).select("path", "content")

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([{**decode(bytes(c)), "_path": p, "_sha": s}
                                for p, c, s in zip(batch["path"], batch["content"], batch["_sha"])])

    hashed = files.withColumn("_sha", F.sha2("content", 256))
    out = hashed.mapInPandas(rows, f"{schema}, _path STRING, _sha STRING")
    bands = [F.col(f.name) for f in out.schema.fields if isinstance(f.dataType, ArrayType)]
    if bands:
        out = out.withColumn("possibly_corrupt", S.is_constant(*bands))
    return out.withColumn("patch_id", F.regexp_extract("_path", "([^/]+)\\.[^.]+$", 1)).withColumnRenamed("_sha", "sha256").drop("_path")


def choose_source(points: DataFrame, ranked_patches: DataFrame, point_id: str) -> DataFrame:
    """First source that has a patch for the point, in ``source_rank`` order; points without any keep NULL."""
    best = ranked_patches.groupBy(point_id).agg(F.min_by("patch_ref", F.struct("source_rank", "patch_ref")).alias("patch_ref"),
                                                F.min("source_rank").alias("source_rank"))
    return points.join(best, point_id, "left")

"""Place names and land restrictions around recommended sites, joined from tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions import scalars as S
from geoloom.operators import spatial

# Tag values that mark restricted or sensitive land.
RESTRICTED_TAGS = {
    "leisure": ("nature_reserve", "park", "national_park"),
    "boundary": ("protected_area", "national_park"),
    "natural": ("water", "wetland", "glacier", "beach"),
    "landuse": ("cemetery", "military", "reservoir"),
}
METRES_PER_DEGREE_LAT = 111000.0
METRES_PER_DEGREE_LON = 85000.0
SHOWN = 3


def restricted_features(features: DataFrame) -> DataFrame:
    """Features ``feature_id, lon, lat, tags`` with a restricted tag → adds ``name`` and ``type``."""
    tags = F.col("tags")
    listed = F.array_compact(F.array(*[
        F.when(F.try_element_at(tags, F.lit(k)).isin(*values), F.concat(F.lit(f"{k}="), F.try_element_at(tags, F.lit(k))))
        for k, values in RESTRICTED_TAGS.items()]))
    return features.withColumn("type", F.try_element_at(listed, F.lit(1))).filter("type IS NOT NULL").withColumn(
        "name", F.coalesce(F.try_element_at(tags, F.lit("name")), F.lit("unnamed")))


def site_restrictions(sites: DataFrame, features: DataFrame, site_id: str, radius_m: float = 500.0) -> DataFrame:
    """Restricted features in the box around each site: the first few by feature id.

    ``sites``: ``lon, lat``; ``features``: ``feature_id, lon, lat, name, type``. The rank limit is
    applied inside every map task before the shuffle, so a site amid very many features
    sends only a few rows per task.
    """
    dlon, dlat = radius_m / METRES_PER_DEGREE_LON, radius_m / METRES_PER_DEGREE_LAT
    boxes = sites.select(site_id, (F.col("lon") - dlon).alias("x0"), (F.col("lon") + dlon).alias("x1"),
                         (F.col("lat") - dlat).alias("y0"), (F.col("lat") + dlat).alias("y1"))
    points = features.select("feature_id", "name", "type", F.col("lon").alias("x"), F.col("lat").alias("y"))
    hits = spatial.point_box_join(points, boxes, 2 * max(dlon, dlat)).select(site_id, "feature_id", "name", "type")
    place = F.row_number().over(W.partitionBy(site_id).orderBy("feature_id"))
    first = hits.withColumn("_place", place).filter(F.col("_place") <= SHOWN)
    return first.groupBy(site_id).agg(
        F.array_sort(F.collect_list(F.struct("feature_id", "name", "type"))).alias("_found")).select(
        site_id, F.transform("_found", lambda f: f["name"]).alias("restriction_names"),
        F.transform("_found", lambda f: f["type"]).alias("restriction_types"))


def site_restrictions_join(sites: DataFrame, features: DataFrame, site_id: str, radius_m: float = 500.0) -> DataFrame:
    found = site_restrictions(sites, features, site_id, radius_m)
    return sites.join(found, site_id, "left").withColumns({
        "suitability": S.suitability_label(F.col("restriction_names")),
        "suitability_reason": S.suitability_reason(F.col("restriction_names")),
        "nearby_restrictions": F.coalesce(F.array_join("restriction_types", "; "), F.lit(""))}).drop(
        "restriction_names", "restriction_types")


def nearest_place_join(sites: DataFrame, places: DataFrame, site_id: str) -> DataFrame:
    """Name parts of the nearest place. Both have ``x, y`` in metres; places add
    ``place_id, road, neighbourhood, city, display_name``."""
    near = spatial.nearest_join(sites, places.select("place_id", "x", "y"), site_id, "place_id").drop("dist_m")
    named = places.select("place_id", "road", "neighbourhood", "city", "display_name")
    return near.join(named, "place_id", "left").withColumn("location_name", S.location_name(
        F.col("road"), F.col("neighbourhood"), F.col("city"), F.col("display_name"))).drop("place_id")


def enrich_sites(sites: DataFrame, places: DataFrame, features: DataFrame, site_id: str,
                 radius_m: float = 500.0) -> DataFrame:
    """Every site once, with place names, suitability and the reason."""
    named = nearest_place_join(sites, places, site_id).drop("neighbourhood", "display_name")
    return site_restrictions_join(named, features, site_id, radius_m)

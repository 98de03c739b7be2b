"""Declared schemas; nothing is inferred from data."""

from __future__ import annotations

DETECTIONS = ("patch_id STRING, label STRING, center_lon DOUBLE, center_lat DOUBLE, county_geoid STRING, "
              "positive_pixels BIGINT, area_m2 DOUBLE, mean_confidence DOUBLE, max_confidence DOUBLE, "
              "bbox_width_m DOUBLE, bbox_height_m DOUBLE, voltage STRING, substation_type STRING, "
              "osm_id BIGINT, geom_source STRING, split STRING")

DATA_CENTERS = "state_id INT, county_id INT, lon DOUBLE, lat DOUBLE, sqft DOUBLE"

OVERPASS = ("elements ARRAY<STRUCT<type STRING, id BIGINT, lon DOUBLE, lat DOUBLE, nodes ARRAY<BIGINT>, "
            "geometry ARRAY<STRUCT<lon DOUBLE, lat DOUBLE>>, tags MAP<STRING,STRING>, timestamp STRING>>")

# Geometry coordinates stay text until the geometry type is known. A document is a feature
# collection or, in line files, may be one bare feature.
GEOJSON = ("features ARRAY<STRUCT<properties MAP<STRING,STRING>, geometry STRUCT<type STRING, coordinates STRING>>>, "
           "properties MAP<STRING,STRING>, geometry STRUCT<type STRING, coordinates STRING>")

CENSUS = "ARRAY<ARRAY<STRING>>"

CHANNEL_STATS = "mean ARRAY<DOUBLE>, std ARRAY<DOUBLE>"

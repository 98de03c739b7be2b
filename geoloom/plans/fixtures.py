"""Stand-in geometry derived from the driver tables, as SQL both engines run.

Coordinates are integer hashes of the key inside a 60 km square. Keys beyond one
square's worth go to the next square, 100 km further east, so density stays the
same and the work grows in step with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

PIXELS_PER_PATCH = 64


def _square(key: str, keys_per_square: int, scale: float, xm: int, ym: int, xo: int = 0, yo: int = 0,
            gap: int = 100000) -> str:
    return (f"CAST(({key} * {xm} + {xo}) % 100003 AS DOUBLE) / 100003 * {scale}"
            f" + floor({key} / {keys_per_square}) * {gap} AS x, "
            f"CAST(({key} * {ym} + {yo}) % 100019 AS DOUBLE) / 100019 * {scale} AS y")


FIXTURES = {
    "stations": f"""SELECT s_suppkey AS sub_id, {_square('s_suppkey', 1000, 60000, 7919, 104729, 0, 17)},
        CASE s_nationkey % 6 WHEN 0 THEN '230000;69000' WHEN 1 THEN '69000' WHEN 2 THEN '' WHEN 3 THEN 'abc'
             WHEN 4 THEN '500000' ELSE '46000' END AS voltage, s_nationkey AS area_id FROM {{supplier}}""",
    "cells": f"""SELECT c_custkey AS cell_id, {_square('c_custkey', 15000, 60000, 15485863, 32452843, 0, 5)},
        (1 + CAST(floor(abs(c_acctbal) / 10) AS BIGINT)) * 2.0E0 AS demand_kw, c_nationkey AS area_id FROM {{customer}}""",
    "block_groups": f"""SELECT geoid, x AS x0, y AS y0, w, h, population, building_area_m2 FROM (
        SELECT p_partkey AS geoid, {_square('p_partkey', 20000, 55000, 49979687, 67867967, 0, 3)},
        200.0E0 + p_size * 60 AS w, 200.0E0 + ((p_partkey * 31) % 50) * 60 AS h, p_size * 40 AS population,
        p_retailprice AS building_area_m2 FROM {{part}}) b""",
    "buildings": f"""SELECT o_orderkey AS bld_id, {_square('o_orderkey', 150000, 60000, 86028121, 122949823, 0, 11)},
        8.0E0 + o_orderkey % 20 AS side FROM {{orders}}""",
    "segments": """SELECT sub_id AS line_id, x AS x1, y AS y1, x + ((sub_id * 6007 + 2) % 101 - 50) * 200.0E0 AS x2,
        y + ((sub_id * 5003 + 3) % 107 - 53) * 200.0E0 AS y2 FROM fx_stations""",
    "data_centers": f"""SELECT p_partkey AS dc_id, {_square('p_partkey', 20000, 60000, 7919, 104729, 29, 31)},
        CASE WHEN p_size < 5 THEN NULL ELSE p_retailprice * 10 END AS sqft FROM {{part}}""",
    "patches": """SELECT d.doc_id AS patch_id, CASE WHEN l.quality = 1 THEN 'positive' ELSE 'negative' END AS label,
        d.source AS county_geoid, d.lang AS region, CASE WHEN l.toxic = 1 THEN '' ELSE d.lang END AS substation_type,
        d.n_chars AS positive_pixels, (d.doc_id * 7919) % 100003 AS order_key,
        floor(d.doc_id / 100003) AS order_lap
        FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "scores": """SELECT event_id AS patch_id, CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END AS target,
        value / (value + 10) AS patch_score, event_type AS substation_type, user_id AS county_id,
        value / (value + 15) AS iou, value / (value + 12) AS dice, value / (value + 8) AS pixel_precision,
        value / (value + 20) AS pixel_recall, CAST(floor(value * 100) AS BIGINT) AS gt_positive_px FROM {events}""",
    "detections": f"""SELECT event_id AS det_id, {_square('event_id', 100000, 8000, 7919, 104729, 0, 17)},
        value / (value + 10) AS mean_confidence, value * 20 AS area_m2,
        event_type IN ('view', 'click') AS is_polygon FROM {{events}}""",
    "temporal": """SELECT o.o_orderkey AS patch_id, o.o_orderdate AS acquired, max(l.l_shipdate) AS edited
        FROM {orders} o LEFT JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_orderdate""",
}

# Pixel rows, for the SQL oracle only; Spark keeps the arrays.
PIXELS_SQL = """SELECT patch_id, i // 8 AS row, i % 8 AS col, CAST(floor(abs(e) * 997) AS BIGINT) % 256 AS red,
    CAST(floor(abs(e) * 1499) AS BIGINT) % 256 AS green, CAST(floor(abs(e) * 2003) AS BIGINT) % 256 AS nir,
    CASE WHEN e > 0.05 THEN 1 ELSE 0 END AS mask, 1 / (1 + exp(-8 * e)) AS prob, e, label FROM (
    SELECT vec_id AS patch_id, label, i, CAST(embedding[i + 1] AS DOUBLE) AS e
    FROM embeddings, unnest(range(64)) AS t(i)) u"""

NEEDS = {"segments": ["stations"]}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixture(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Spark side: the same text over the Parquet files."""
    paths = {t: f"parquet.`{folder}/{t}.parquet`" for t in TABLES}
    text = FIXTURES[name].format(**paths)
    for other in NEEDS.get(name, []):
        text = text.replace(f"fx_{other}", "(" + FIXTURES[other].format(**paths) + ")")
    return spark.sql(text)


def oracle(names: str, body: str) -> str:
    """DuckDB side: ``body`` after the fixtures it reads."""
    parts, seen = [], set()

    def add(name):
        if name in seen:
            return
        for other in NEEDS.get(name, []):
            add(other)
        seen.add(name)
        text = PIXELS_SQL if name == "pixels" else FIXTURES[name].format(**{t: t for t in TABLES})
        parts.append(f"fx_{name} AS ({text})")

    for name in names.split():
        add(name)
    if not parts:
        return body
    more = body.lstrip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if more.startswith(start):
            return f"{start}{', '.join(parts)}, {more[len(start):]}"
    return f"WITH {', '.join(parts)} {body}"


def patch_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """``embeddings`` as 8x8 rasters in array columns."""
    e = "transform(embedding, v -> CAST(v AS DOUBLE))"
    band = lambda k: f"transform(e, v -> CAST(floor(abs(v) * {k}) AS BIGINT) % 256)"
    return table(spark, folder, "embeddings").selectExpr("vec_id AS patch_id", "label AS class", f"{e} AS e").selectExpr(
        "patch_id", "class", "8 AS height", "8 AS width", f"{band(997)} AS red", f"{band(1499)} AS green",
        f"{band(2003)} AS nir", "transform(e, v -> CASE WHEN v > 0.05 THEN 1 ELSE 0 END) AS mask",
        "transform(e, v -> 1 / (1 + exp(-8 * v))) AS prob", "e")

import math
import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import projection as P
from geoloom.functions import scalars as S


def ring(*points):
    return "array(" + ", ".join(f"named_struct('x', {float(x)}D, 'y', {float(y)}D)" for x, y in points) + ")"


CONCAVE = f"array({ring((0, 0), (10, 0), (10, 10), (5, 2), (0, 10))})"
HOLED = f"array({ring((0, 0), (10, 0), (10, 10), (0, 10))}, {ring((4, 4), (4, 6), (6, 6), (6, 4))})"


def one(spark, rings, *columns):
    df = spark.range(1).select(F.expr(rings).alias("rings")).withColumn("edges", G.edges(F.col("rings")))
    return list(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def lit(*values):
    return [F.lit(float(v)) for v in values]


def test_area_of_concave_and_holed(spark):
    e = F.col("edges")
    assert one(spark, CONCAVE, G.polygon_area(e)) == [60.0]
    assert one(spark, HOLED, G.polygon_area(e)) == [96.0]


@pytest.mark.parametrize("rings", [CONCAVE, HOLED])
def test_box_overlaps_add_up(spark, rings):
    e = F.col("edges")
    parts = [G.box_overlap_area(e, *lit(x, y, x + 2.5, y + 2.5)) for x in (0, 2.5, 5, 7.5) for y in (0, 2.5, 5, 7.5)]
    *cells, whole = one(spark, rings, *parts, G.polygon_area(e))
    assert sum(cells) == pytest.approx(whole, abs=1e-9)
    assert one(spark, HOLED, G.box_overlap_area(e, *lit(3, 3, 5, 5)))[0] == pytest.approx(3.0)


def test_point_tests_respect_notch_and_hole(spark):
    e = F.col("edges")
    assert one(spark, CONCAVE, G.point_in_polygon(e, *lit(5, 1)), G.point_in_polygon(e, *lit(5, 5))) == [True, False]
    assert one(spark, HOLED, G.contains_point(e, *lit(5, 5)), G.contains_point(e, *lit(1, 1))) == [False, True]
    assert one(spark, HOLED, G.covers_point(e, *lit(0, 5)), G.contains_point(e, *lit(0, 5))) == [True, False]


def test_within(spark):
    outer = G.edges(F.expr(HOLED))
    inside = lambda *p: G.polygon_within(G.edges(F.expr(f"array({ring(*p)})")), outer)
    over_hole = inside((3, 3), (7, 3), (7, 7), (3, 7))
    beside = inside((1, 1), (3, 1), (3, 3), (1, 3))
    touching = inside((0, 0), (2, 0), (2, 2), (0, 2))
    crossing = inside((-1, 1), (3, 1), (3, 3), (-1, 3))
    assert one(spark, HOLED, over_hole, beside, touching, crossing) == [False, True, True, False]


def test_orientation_makes_holes_negative(spark):
    wrong = f"array({ring((0, 0), (0, 10), (10, 10), (10, 0))}, {ring((4, 4), (6, 4), (6, 6), (4, 6))})"
    area = G.polygon_area(G.edges(G.orient_rings(F.col("rings"))))
    assert one(spark, wrong, area) == [96.0]


def test_segment_distance_of_degenerate_segment(spark):
    assert one(spark, CONCAVE, G.segment_distance(*lit(3, 4, 0, 0, 0, 0)), G.segment_distance(*lit(5, 3, 0, 0, 10, 0))) == [5.0, 3.0]


def test_utm_known_value_and_round_trip(spark):
    # Central meridian at the equator, and a published example (Toronto tower, zone 17).
    p = spark.range(1).select(P.project_utm(*lit(-111, 0), 32612).alias("a"), P.project_utm(*lit(-79.387139, 43.642567), 32617).alias("b")).first()
    assert (p.a.x, p.a.y) == pytest.approx((500000.0, 0.0), abs=1e-6)
    assert (p.b.x, p.b.y) == pytest.approx((630084, 4833438), abs=1.5)
    rng = random.Random(1)
    points = [(rng.uniform(-114, -108), rng.uniform(-60, 60)) for _ in range(200)]
    df = spark.createDataFrame(points, "lon double, lat double").withColumn("p", P.project_utm(F.col("lon"), F.col("lat"), 32612))
    df = df.withColumn("q", P.unproject_utm(F.col("p.x"), F.col("p.y"), 32612))
    worst = df.agg(F.max(F.greatest(F.abs(F.col("q.lon") - F.col("lon")), F.abs(F.col("q.lat") - F.col("lat"))))).first()[0]
    assert worst < 1e-9


def test_utm_code_is_checked():
    with pytest.raises(ValueError):
        P.utm_zone(4326)


def test_voltage_rules(spark):
    rows = [("230000;69000",), ("",), ("abc",), ("230000;abc",), (None,), ("345000",), ("10",), ("69000; ",)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(S.voltage_to_capacity(F.col("v"))).collect()]
    assert got == [200000.0, 200000.0, 200000.0, 200000.0, 200000.0, 300000.0, 20000.0, 100000.0]


def test_temporal_gap_floors_negative_part_days(spark):
    rows = [("2023-07-15 00:00:00", "2015-06-01 00:00:00"), ("2020-01-01 00:00:00", "2020-01-01 12:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(F.to_timestamp("a").alias("a"), F.to_timestamp("b").alias("b"))
    first, second = [r[0] for r in df.select(S.temporal_gap_years(F.col("a"), F.col("b"))).collect()]
    assert first == pytest.approx(8.1, abs=0.05) and second == pytest.approx(1 / 365.25)


def test_buffer_area(spark):
    area = G.polygon_area(G.edges(G.buffer_point(*lit(100, 100), 75.0)))
    assert one(spark, CONCAVE, area)[0] == pytest.approx(math.pi * 75**2, rel=2e-3)


def test_polygons_within_send_no_bins(spark, monkeypatch):
    """What is written and shuffled grows with polygons and tiles, not with bins; odd shapes, tile borders and hot tiles give the rows of a full comparison."""
    import random

    from geoloom.operators import skew, spatial
    draw = random.Random(3)
    spots = [(i, draw.uniform(-300, 300), draw.uniform(-300, 300), draw.uniform(60, 260), draw.uniform(20, 200), draw.uniform(-60, 60)) for i in range(40)]
    ring = lambda x, y, w, h, t: [(x, y), (x + w, y + t), (x + w + t, y + h + t), (x + w / 2, y + h / 2 + t), (x, y + h)]
    outer = spark.createDataFrame([(i, [[{"x": a, "y": b} for a, b in ring(*rest)]]) for i, *rest in spots], "oid int, rings array<array<struct<x:double,y:double>>>")
    outer = outer.select("oid", G.edges(F.col("rings")).alias("outer_edges")).unionByName(spark.createDataFrame([(99, None)], "oid int, outer_edges array<struct<x1:double,y1:double,x2:double,y2:double>>"))
    boxes = [(i, draw.uniform(-310, 500), draw.uniform(-310, 500), draw.choice([0.5, 3.0, 9.0, 40.0])) for i in range(1200)]
    inner = spark.createDataFrame(boxes, "iid int, x double, y double, s double").select(
        "iid", "s", G.edges(G.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("s"), F.col("y") + F.col("s"))).alias("inner_edges"))
    want = sorted(map(tuple, inner.crossJoin(outer).filter(G.polygon_within(F.col("inner_edges"), F.col("outer_edges"))).select("iid", "s", "oid").collect()))
    written, write = [], spatial.cover.materialise

    def kept(df):
        written.append(write(df))
        return written[-1]
    for module in (spatial, spatial.cover):
        monkeypatch.setattr(module, "materialise", kept)
    got = spatial.polygon_within_join(inner, outer, 4.0)
    assert sorted(map(tuple, got.select("iid", "s", "oid").collect())) == want and len(want) > 300
    # Bins of side 4 would be about 1,000 a polygon; tiles have a side of 64.
    assert sum(d.count() for d in written) < 40 * 60 + 1200
    assert got.columns == ["iid", "s", "oid"]
    monkeypatch.setattr(spatial.hot_keys, "__defaults__", (15,))
    assert sorted(map(tuple, spatial.polygon_within_join(inner, outer, 4.0).collect())) == want
    assert skew.hot_keys is spatial.hot_keys

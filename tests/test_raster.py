import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators import arrays, quality, raster, sampling
from geoloom.operators.components import label_runs, runs

SIZE = 64


def demo(kind, seed):
    """Synthetic known-answer patch: a disc mask over one land cover."""
    rng = random.Random(seed)
    inside = {"clean": ((140, 179), (140, 174), (150, 189)), "vegetation": ((30, 59), (60, 99), (180, 239)),
              "water": ((20, 49), (40, 79), (10, 39))}[kind]
    mask = [int((r - 32) ** 2 + (c - 32) ** 2 <= 400) for r in range(SIZE) for c in range(SIZE)]
    bands = [[rng.randint(*limits) for _ in mask] for limits in inside]
    return (f"{kind}{seed}", "positive", SIZE, SIZE, *bands, mask)


SCHEMA = "patch_id string, label string, height int, width int, red array<int>, green array<int>, nir array<int>, mask array<int>"


def test_label_audit_on_known_patches(spark):
    rows = [demo("clean", 0), demo("clean", 1), demo("vegetation", 2), demo("water", 3)]
    empty = ("none", "positive", 2, 2, [1] * 4, [2] * 4, [3] * 4, [0] * 4)
    negative = ("neg", "negative", 2, 2, [1] * 4, [2] * 4, [3] * 4, [0] * 4)
    df = spark.createDataFrame([*rows, empty, negative], SCHEMA)
    got = {r.patch_id: r for r in raster.label_audit(df).collect()}
    assert not got["clean0"].suspect_label and not got["clean1"].suspect_label
    assert got["vegetation2"].suspect_label and got["vegetation2"].pct_high_ndvi == 100
    assert got["water3"].suspect_label and got["water3"].pct_water == pytest.approx(74, abs=8)
    assert tuple(got["none"][c] for c in ("n_labeled_pixels", "pct_water", "mean_ndvi_in_label", "suspect_label")) == (0, 0.0, 0.0, False)
    assert "neg" not in got
    assert quality.audit_summary(raster.label_audit(df)).first().n_suspect == 2


def test_diagonal_pixels_are_two_components(spark):
    on = [(1, 0, 0), (1, 0, 1), (1, 1, 2), (1, 2, 2)]
    px = spark.createDataFrame([(*p, 0.9) for p in on], "patch int, row int, col int, prob double")
    out = label_runs(runs(px, "patch"), "patch")
    assert out.select("component").distinct().count() == 2


def test_components_cross_column_blocks(spark):
    """A spiral-free long run and a comb: wide rasters are cut into blocks of columns."""
    wide = [(1, 0, c) for c in range(200)] + [(1, r, c) for r in range(1, 4) for c in range(0, 200, 2)] + [(1, 9, 5)]
    px = spark.createDataFrame([(*p, 0.5) for p in wide], "patch int, row int, col int, prob double")
    boxes = {r.positive_pixels: r for r in raster.component_boxes(px, "patch").collect()}
    assert set(boxes) == {500, 1} and (boxes[500].col_min, boxes[500].col_max, boxes[500].row_max) == (0, 199, 3)


def test_distance_raster_against_brute_force(spark):
    rng = random.Random(4)
    mask = [int(rng.random() < 0.06) for _ in range(9 * 13)]
    df = spark.createDataFrame([(1, 9, 13, mask), (2, 3, 4, [0] * 12)], "patch_id int, height int, width int, mask array<int>")
    got = {r.patch_id: r.distance for r in raster.distance_raster(df, 2.0).collect()}
    on = [(i // 13, i % 13) for i, v in enumerate(mask) if v]
    want = [2.0 * min(math.hypot(i // 13 - r, i % 13 - c) for r, c in on) for i in range(9 * 13)]
    assert got[1] == pytest.approx(want)
    assert got[2] == pytest.approx([10.0] * 12)


def test_validate_patches_lists_every_problem(spark):
    rows = [("ok", 2, 2, [1, 2, 3, 4], [0, 1, 0, 1], 1, 1), ("flat", 2, 2, [5] * 4, [0, 2, 0, 0], 1, 2),
            ("lost", 2, 2, None, [0] * 4, 1, 1), ("nomask", 2, 2, [1, 2, 3, 4], None, 1, 1)]
    df = spark.createDataFrame(rows, "patch_id string, height int, width int, red array<int>, mask array<int>, image_srid int, mask_srid int")
    got = {r.patch_id: (r.is_valid, r.errors) for r in raster.validate_patches(df, ["red"], 1, 2).collect()}
    assert got == {"ok": (True, ""), "flat": (False, "Image is constant; Mask non-binary; CRS mismatch"),
                   "lost": (False, "Image not found"), "nomask": (False, "Mask not found")}


def test_normalise_pads_crops_and_fills_missing_bands(spark):
    df = spark.createDataFrame([(1, 3, 1, [51, 102, 153], None)], "patch_id int, height int, width int, red array<int>, nir array<int>")
    r = raster.normalize_bands(df, ["red", "nir"], [0.2, 0.0], [1.0, 0.5], size=2).first()
    assert r.red == pytest.approx([0.0, -0.2, 0.2, -0.2]) and r.nir == pytest.approx([0.0] * 4)


def test_uncovered_pixels_get_zero(spark):
    tiles = spark.createDataFrame([(1, 0, 0, 1, 2, [0.4, 0.6]), (1, 0, 1, 1, 1, [0.8])],
                                  "raster int, row_off int, col_off int, height int, width int, prob array<double>")
    whole = spark.createDataFrame([(1, 1, 3), (2, 2, 1)], "raster int, height int, width int")
    got = {(r.raster, r.row, r.col): r.prob for r in raster.merge_overlaps(tiles, "raster", whole, block=2).collect()}
    assert got == pytest.approx({(1, 0, 0): 0.4, (1, 0, 1): 0.7, (1, 0, 2): 0.0, (2, 0, 0): 0.0, (2, 1, 0): 0.0})


def test_sampling_repeats_only_short_groups(spark):
    df = spark.range(10).select("id", F.when(F.col("id") < 8, "a").otherwise("b").alias("g"))
    budgets = spark.createDataFrame([("a", 5), ("b", 5)], "g string, budget long")
    got = sampling.sample_per_source(df, budgets, ["g"], F.xxhash64("id", F.lit(42))).collect()
    a, b = [r for r in got if r.g == "a"], [r for r in got if r.g == "b"]
    assert len({r.id for r in a}) == len(a) == 5 and len(b) == 5 and {r.id for r in b} == {8, 9}


def test_negative_points_keep_their_distance(spark):
    bounds = spark.createDataFrame([("s", 0.0, 0.0, 3000.0, 3000.0, 30)], "source string, west double, south double, east double, north double, budget int")
    draws = sampling.negative_candidates(bounds, "source").selectExpr("source", "attempt", "center_lon AS x", "center_lat AS y", "budget")
    stations = spark.createDataFrame([(1500.0, 1500.0)], "x double, y double")
    got = sampling.sample_negative_points(draws, stations, "source").collect()
    assert len(got) == 30 and all(math.hypot(r.x - 1500, r.y - 1500) >= 500 for r in got)


# ---- kernels and blocks


def flood(mask):
    """Components by flooding, numbered by their first pixel."""
    h, w = mask.shape
    out = np.full((h, w), -1)
    for i in range(h):
        for j in range(w):
            if mask[i, j] and out[i, j] < 0:
                out[i, j], waiting = i * w + j, [(i, j)]
                while waiting:
                    y, x = waiting.pop()
                    for v, u in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                        if 0 <= v < h and 0 <= u < w and mask[v, u] and out[v, u] < 0:
                            out[v, u] = i * w + j
                            waiting.append((v, u))
    return out


def nearest(mask):
    on, (r, c) = np.argwhere(mask), np.indices(mask.shape)
    return ((r[..., None] - on[:, 0]) ** 2 + (c[..., None] - on[:, 1]) ** 2).min(axis=-1)


def test_kernels_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(150):
        mask = rng.random(rng.integers(1, 14, 2)) < rng.choice([0.02, 0.1, 0.5, 0.9])
        assert (arrays.components(mask) == flood(mask)).all()
        d = arrays.squared_distances(mask)
        assert (d == nearest(mask)).all() if mask.any() else (d >= arrays._FAR).all()


def as_blocks(values, size, raster=1):
    h, w = values.shape
    return [(raster, r, c, *values[r:r + size, c:c + size].shape, values[r:r + size, c:c + size].ravel().tolist())
            for r in range(0, h, size) for c in range(0, w, size)]


@pytest.mark.parametrize("size", [4, 7, 40])
def test_components_across_blocks(spark, size):
    rng = np.random.default_rng(6)
    prob = rng.random((23, 31))
    prob[3, :] = 0.9  # one line through every block
    df = spark.createDataFrame(as_blocks(prob, size) + as_blocks(prob[:5, :5], size, 2),
                               "raster int, row0 int, col0 int, height int, width int, prob array<double>")
    got = {(r.raster, r.component // (1 << 31), r.component % (1 << 31)): r for r in raster.block_components(df, "raster", 0.55).collect()}
    want = {}
    for k, values in ((1, prob), (2, prob[:5, :5])):
        labels = flood(values >= 0.55)
        for first in np.unique(labels[labels >= 0]).tolist():
            want[k, first // values.shape[1], first % values.shape[1]] = (values[labels == first], np.argwhere(labels == first))
    assert set(got) == set(want)
    for k, (p, at) in want.items():
        r = got[k]
        assert (r.positive_pixels, r.row_min, r.row_max, r.col_min, r.col_max) == (len(p), *at[:, 0][[0, -1]], at[:, 1].min(), at[:, 1].max())
        assert (r.mean_confidence, r.max_confidence) == pytest.approx((p.mean(), p.max()))


def test_distances_across_blocks(spark):
    rng = np.random.default_rng(7)
    mask = rng.random((33, 47)) < 0.01
    mask[16, 16] = True
    df = spark.createDataFrame(as_blocks(mask.astype(int), 16), "raster int, row0 int, col0 int, height int, width int, mask array<int>")
    want = np.minimum(np.sqrt(nearest(mask)), 9)
    for r in raster.distance_blocks(df, "raster", 9, 1.0).collect():
        assert np.allclose(np.reshape(r.distance, (r.height, r.width)), want[r.row0:r.row0 + r.height, r.col0:r.col0 + r.width])


def test_a_large_patch_has_its_distances_quickly(spark):
    df = spark.range(4).select("id", F.lit(512).alias("height"), F.lit(512).alias("width"),
                               F.expr("transform(sequence(0, 262143), i -> int(pmod(xxhash64(i, id), 4000) = 0))").alias("mask"))
    row = raster.distance_raster(df, 1.0).filter("id = 2").first()
    assert np.allclose(np.square(row.distance[::1009]), nearest_few(np.reshape(row.mask, (512, 512)) > 0, range(0, 512 * 512, 1009)))


def nearest_few(mask, places):
    on = np.argwhere(mask)
    return [((on - divmod(p, 512)) ** 2).sum(axis=1).min() for p in places]


def test_masks_of_concave_polygons_with_holes(spark):
    rng = random.Random(8)
    star = [(50 + (45 if k % 2 else 18) * math.cos(k * math.pi / 9) + rng.random(), 50 + (45 if k % 2 else 18) * math.sin(k * math.pi / 9)) for k in range(18)]
    hole = [(46.0, 46.0), (46.0, 54.0), (54.0, 54.0), (54.0, 46.0)]
    square = [(0.0, 0.0), (20.0, 0.0), (20.0, 20.0), (0.0, 20.0)]
    rings = [[star, hole], [square], [[(70.0, 70.0), (400.0, 75.0), (400.0, 300.0)]]]
    shapes = spark.createDataFrame([([[{"x": x, "y": y} for x, y in r] for r in s],) for s in rings], "rings array<array<struct<x:double,y:double>>>")
    features = shapes.select(G.edges(F.col("rings")).alias("edges"))
    patches = spark.createDataFrame([(1, 40, 40, 2.5, 0.0, -2.5, 100.0), (2, 30, 20, 1.0, 40.0, -1.0, 70.0), (3, 4, 4, 1.0, -50.0, -1.0, 0.0),
                                     (4, 25, 25, 10.0, 60.0, -10.0, 310.0)],
                                    "patch_id int, height int, width int, a double, c double, e double, f double")
    for size in (7.0, 40.0, 1000.0):
        got = {r.patch_id: np.reshape(r.mask, shape) for r in raster.positive_masks(patches, features, "patch_id", size).collect()
               for shape in [{1: (40, 40), 2: (30, 20), 4: (25, 25)}[r.patch_id]]}
        assert set(got) == {1, 2, 4}
        pixel = patches.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("height") - 1))).withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))
        ends = (F.col("c") + F.col("col") * F.col("a"), F.col("f") + (F.col("row") + 1) * F.col("e"),
                F.col("c") + (F.col("col") + 1) * F.col("a"), F.col("f") + F.col("row") * F.col("e"))
        near = pixel.crossJoin(features).filter(G.polygon_intersects_box(F.col("edges"), *ends)).select("patch_id", "row", "col").distinct().collect()
        want = {k: np.zeros(m.shape, int) for k, m in got.items()}
        for r in near:
            want[r.patch_id][r.row, r.col] = 1
        assert all((got[k] == want[k]).all() for k in want)


def test_masks_take_whole_bins_first(spark):
    """A patch under one large feature is full after its first bins; the features after it change nothing."""
    patches = spark.sql("SELECT 1 AS p, 8 AS height, 8 AS width, 1.0D AS a, 20.0D AS c, -1.0D AS e, 30.0D AS f")
    boxes = spark.createDataFrame([(22.0, 24.0, 3.0), (0.0, 0.0, 90.0), (23.0, 25.0, 2.0)], "x double, y double, w double")
    shapes = boxes.select(G.edges(G.rectangle(F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("w"))).alias("edges"))
    out = raster.positive_masks(patches, shapes, "p", 50.0)
    assert [sum(r.mask) for r in out.collect()] == [64]
    assert "isnotnull(_local" in out._jdf.queryExecution().optimizedPlan().toString()
    few = raster.positive_masks(patches, shapes.filter("edges[0].x1 > 1"), "p", 50.0)
    assert [0 < sum(r.mask) < 64 for r in few.collect()] == [True]

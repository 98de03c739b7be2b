"""Rasters as array columns.

A patch is one row: ``height, width`` and row-major arrays per band. Per-patch
results are array expressions on that row, or numpy in Arrow batches where a pixel depends on its
neighbours (no shuffle, no pixel rows). A large raster is a table of blocks; work that crosses
blocks moves the arrays of overlapping tiles, halo strips or the components on block borders, never pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import geometry as G
from geoloom.operators import arrays, components, cover, spatial
from geoloom.operators.checkpoints import materialise
from geoloom.operators.skew import spread

EPS = 1e-6
BLOCK = 512


def pixel_view(patches: DataFrame, patch_id: str, bands: Sequence[str]) -> DataFrame:
    """``(patch, row, col, band...)``, one row per pixel."""
    zipped = F.arrays_zip(*[F.col(b) for b in bands])
    return patches.select(patch_id, "width", F.posexplode(zipped).alias("pos", "px")).select(
        patch_id, F.floor(F.col("pos") / F.col("width")).cast("int").alias("row"),
        (F.col("pos") % F.col("width")).cast("int").alias("col"), *[F.col(f"px.{b}").alias(b) for b in bands])


def normalised_difference(a: Column, b: Column) -> Column:
    """``(a - b) / (a + b)``, 0 where the sum is not positive."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(a + b > 0, F.try_divide(a - b, a + b)).otherwise(0.0)


def ndvi(red: Column, nir: Column) -> Column:
    return F.zip_with(nir, red, normalised_difference)


def ndwi(green: Column, nir: Column) -> Column:
    return F.zip_with(green, nir, normalised_difference)


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def array_count(values: Column, test: Callable[[Column], Column]) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: acc + F.when(test(v), 1).otherwise(0))


def label_audit(patches: DataFrame, ndvi_threshold: float = 0.4, ndwi_threshold: float = 0.3,
                suspect_pct: float = 50.0) -> DataFrame:
    """Share of vegetation and water inside the labelled mask of each positive patch.

    Adds ``n_labeled_pixels, pct_high_ndvi, pct_water, mean_ndvi_in_label,
    mean_ndwi_in_label, suspect_label``; an empty mask gives zeros.
    """
    if "label" in patches.columns:
        patches = patches.filter("label = 'positive'")
    inside = F.filter(F.arrays_zip("red", "green", "nir", "mask"), lambda p: p["mask"] > 0)
    p = patches.withColumn("_in", inside)
    p = p.withColumns({"_v": F.transform("_in", lambda q: normalised_difference(q["nir"], q["red"])),
                       "_w": F.transform("_in", lambda q: normalised_difference(q["green"], q["nir"])),
                       "n_labeled_pixels": F.size("_in").cast("bigint")})
    n = F.col("n_labeled_pixels")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    p = p.withColumns({"_pv": zero(F.try_divide(100.0 * array_count(F.col("_v"), lambda v: v > ndvi_threshold), n)),
                       "_pw": zero(F.try_divide(100.0 * array_count(F.col("_w"), lambda v: v > ndwi_threshold), n))})
    return p.withColumns({
        "pct_high_ndvi": F.bround("_pv", 2), "pct_water": F.bround("_pw", 2),
        "mean_ndvi_in_label": F.bround(zero(F.try_divide(array_sum(F.col("_v")), n)), 4),
        "mean_ndwi_in_label": F.bround(zero(F.try_divide(array_sum(F.col("_w")), n)), 4),
        "suspect_label": (F.col("_pv") > suspect_pct) | (F.col("_pw") > suspect_pct),
    }).drop("_in", "_v", "_w", "_pv", "_pw")


def validate_patches(patches: DataFrame, bands: Sequence[str], expected_bands: int = 4, expected_size: int = 512,
                     mask: str = "mask") -> DataFrame:
    """``patch_id, is_valid, errors``. Optional columns ``image_srid/mask_srid`` and
    ``image_transform/mask_transform`` are compared when present; a NULL array is a missing file."""
    image_missing, mask_missing = F.col(bands[0]).isNull(), F.col(mask).isNull()
    n_bands = sum((F.col(b).isNotNull().cast("int") for b in bands[1:]), F.col(bands[0]).isNotNull().cast("int"))
    top = F.greatest(*[F.array_max(b) for b in bands]) if len(bands) > 1 else F.array_max(bands[0])
    low = F.least(*[F.array_min(b) for b in bands]) if len(bands) > 1 else F.array_min(bands[0])
    checks = [
        F.when(n_bands != expected_bands, F.concat(F.lit("Image bands="), n_bands.cast("string"))),
        F.when((F.col("width") != expected_size) | (F.col("height") != expected_size),
               F.concat(F.lit("Image size "), F.concat_ws("x", "width", "height"))),
        F.when(top == low, "Image is constant"),
        F.when(F.size(mask) != F.col("width") * F.col("height"), "Mask size"),
        F.when(F.exists(mask, lambda v: ~v.isin(0, 1)), "Mask non-binary"),
    ]
    for name, text in (("transform", "Transform mismatch"), ("srid", "CRS mismatch")):
        if f"image_{name}" in patches.columns and f"mask_{name}" in patches.columns:
            checks.append(F.when(F.col(f"image_{name}") != F.col(f"mask_{name}"), text))
    found = F.array_compact(F.array(*checks))
    missing = F.when(image_missing, F.array(F.lit("Image not found"))).when(mask_missing, F.array(F.lit("Mask not found")))
    errors = F.coalesce(missing, found)
    return patches.select("patch_id", (F.size(errors) == 0).alias("is_valid"), F.array_join(errors, "; ").alias("errors"))


def mask_bbox(patches: DataFrame, resolution: float = 0.6, mask: str = "mask") -> DataFrame:
    """Pixel count, fraction and bounding box of the mask, in pixels, metres and map units.

    An affine (``a, c, e, f``) adds the box centre; an empty mask has NULL box columns.
    """
    where = F.filter(F.transform(mask, lambda v, i: F.when(v > 0, i)), lambda i: i.isNotNull())
    p = patches.withColumn("_at", where)
    p = p.withColumns({"_rows": F.transform("_at", lambda i: F.floor(i / F.col("width")).cast("int")),
                       "_cols": F.transform("_at", lambda i: (i % F.col("width")).cast("int"))})
    p = p.withColumns({
        "positive_pixels": F.size("_at").cast("bigint"),
        "positive_fraction": F.bround(F.try_divide(F.size("_at").cast("double"), F.size(mask)), 6),
        "mask_bbox_row_min": F.array_min("_rows"), "mask_bbox_row_max": F.array_max("_rows"),
        "mask_bbox_col_min": F.array_min("_cols"), "mask_bbox_col_max": F.array_max("_cols")})
    p = p.withColumns({
        "mask_bbox_width_px": F.expr("mask_bbox_col_max - mask_bbox_col_min + 1"),
        "mask_bbox_height_px": F.expr("mask_bbox_row_max - mask_bbox_row_min + 1")})
    p = p.withColumns({"mask_bbox_width_m": F.bround(F.col("mask_bbox_width_px") * resolution, 1),
                       "mask_bbox_height_m": F.bround(F.col("mask_bbox_height_px") * resolution, 1)})
    if {"a", "c", "e", "f"} <= set(p.columns):
        centre = G.affine_to_world(*[F.col(k) for k in "acef"], F.expr("(mask_bbox_col_min + mask_bbox_col_max) / 2"),
                                   F.expr("(mask_bbox_row_min + mask_bbox_row_max) / 2"))
        p = p.withColumn("_mid", centre).withColumns({"mask_centroid_x": F.bround("_mid.x", 2),
                                                      "mask_centroid_y": F.bround("_mid.y", 2)}).drop("_mid")
    return p.drop("_at", "_rows", "_cols")


def filter_min_mask_pixels(patches: DataFrame, minimum: int = 50) -> DataFrame:
    return patches.filter(F.col("positive_pixels") >= minimum)


def patch_boxes(patches: DataFrame) -> DataFrame:
    """Envelope ``x0, y0, x1, y1`` from the affine and the size."""
    xs = (F.col("c"), F.col("c") + F.col("a") * F.col("width"))
    ys = (F.col("f"), F.col("f") + F.col("e") * F.col("height"))
    return patches.withColumns({"x0": F.least(*xs), "x1": F.greatest(*xs), "y0": F.least(*ys), "y1": F.greatest(*ys)})


def patch_feature_join(patches: DataFrame, features: DataFrame, patch_id: str, bin_size: float) -> DataFrame:
    """(patch, feature) pairs whose geometry meets the patch extent; features have ``edges``."""
    return spatial.box_polygon_join(patch_boxes(patches), features, bin_size, patch_id)


def positive_masks(patches: DataFrame, features: DataFrame, patch_id: str, bin_size: float) -> DataFrame:
    """``patch_id, mask``: 1 where a pixel and a feature share a point; patches without any have no row.

    Features become bins with their own edges (see :mod:`cover`), and a patch reads the bins it lies on. A pixel is positive when an edge there
    meets its closed square, when its bin is wholly inside, or when its centre is inside by parity from the bin's anchor. A patch is
    put together in one task, feature by feature, in the memory of one mask: bins wholly inside come first, and a mask that is full takes no more.
    """
    shapes = materialise(features.select("edges").withColumn("_pid", F.monotonically_increasing_id()))
    bins = cover.cover(shapes, "_pid", "edges", bin_size, spatial.walk_bins)
    grid = ["height", "width", "a", "c", "e", "f"]
    placed = patch_boxes(patches.select(patch_id, *grid))
    reached = spatial.over_box(placed, bin_size, *[F.col(k) for k in ("x0", "y0", "x1", "y1")]).join(bins, spatial.BIN).select(
        patch_id, *grid, "_pid", *spatial.BIN, "_local", "_inside")
    kind = patches.schema[patch_id].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, mask, full = None, None, False
        for b in batches:
            names = [n for n in b.schema.names if n != "_local"]
            local = b.column("_local")
            for i, row in enumerate(b.select(names).to_pylist()):
                if current is None or row[patch_id] != current:
                    if mask is not None and mask.any():
                        yield _mask_row(patch_id, key, mask)
                    current, key, mask = row[patch_id], b.column(patch_id)[i:i + 1], np.zeros((row["height"], row["width"]), bool)
                    full = False
                if not full:
                    _add_bin(mask, row, local[i], bin_size)
                    full = mask.all()
        if mask is not None and mask.any():
            yield _mask_row(patch_id, key, mask)

    return spread(reached, patch_id).sortWithinPartitions(patch_id, F.col("_local").isNotNull()).mapInArrow(each, f"`{patch_id}` {kind}, mask array<int>")


def _mask_row(patch_id: str, key: pa.Array, mask: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([key, pa.array([mask.astype(np.int32).ravel()], pa.list_(pa.int32()))], names=[patch_id, "mask"])


def _add_bin(mask: np.ndarray, row: dict, local: pa.Scalar, size: float) -> None:
    """Pixels of one feature in one bin."""
    height, width, a, c, e, f = (row[k] for k in ("height", "width", "a", "c", "e", "f"))
    if local.is_valid:
        flat = local.values.flatten()
        edges = np.stack([x.to_numpy() for x in flat], axis=1)
        mask |= arrays.touched_pixels(edges, height, width, a, c, e, f)
    xs, ys = c + (np.arange(width) + 0.5) * a, f + (np.arange(height) + 0.5) * e
    cols, rows = np.flatnonzero(np.floor(xs / size) == row["_bx"]), np.flatnonzero(np.floor(ys / size) == row["_by"])
    if not len(cols) or not len(rows):
        return
    if not local.is_valid:
        mask[np.ix_(rows, cols)] = True
        return
    cols = cols[np.argsort(xs[cols])]
    anchor = (row["_bx"] + cover.ANCHOR_X) * size, (row["_by"] + cover.ANCHOR_Y) * size
    mask[np.ix_(rows, cols)] |= arrays.inside_pixels(xs[cols], ys[rows], edges, row["_inside"], *anchor)


def rasterize_mask(patches: DataFrame, features: DataFrame, patch_id: str, bin_size: float) -> DataFrame:
    """Pixels ``(patch, row, col)`` touched by any feature: the rows of :func:`positive_masks`."""
    masks = positive_masks(patches, features, patch_id, bin_size).join(patches.select(patch_id, "width"), patch_id)
    return masks.select(patch_id, "width", F.posexplode("mask").alias("_at", "_on")).filter("_on > 0").select(
        patch_id, F.floor(F.col("_at") / F.col("width")).cast("int").alias("row"), (F.col("_at") % F.col("width")).alias("col"))


def positive_patch_rows(patches: DataFrame, features: DataFrame, patch_id: str, bin_size: float,
                        resolution: float = 0.6, min_mask_pixels: int = 50) -> DataFrame:
    """Positive patches with mask and box columns; patches under the pixel minimum are dropped."""
    masked = patches.join(positive_masks(patches, features, patch_id, bin_size), patch_id)
    return filter_min_mask_pixels(mask_bbox(masked, resolution), min_mask_pixels).withColumn("label", F.lit("positive"))


def negative_patch_rows(patches: DataFrame, distance: bool = False, resolution_m: float = 0.6) -> DataFrame:
    """Negative patches: an all-zero mask, no minimum, no box columns; with ``distance`` also its distance raster (the diagonal everywhere)."""
    rows = patches.withColumns({
        "mask": F.array_repeat(F.lit(0), (F.col("height") * F.col("width")).cast("int")),
        "positive_pixels": F.lit(0).cast("bigint"), "positive_fraction": F.lit(0.0), "label": F.lit("negative")})
    return distance_raster(rows, resolution_m) if distance else rows


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _distances(mask: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Pixel distances of each patch; its diagonal where the mask is empty."""
    def one(m, h, w):
        if m is None:
            return None
        on = np.asarray(m).reshape(h, w) > 0
        return np.sqrt(arrays.squared_distances(on)).ravel() if on.any() else np.full(h * w, float(h * h + w * w) ** 0.5)
    return pd.Series([one(*x) for x in zip(mask, height, width)], index=mask.index, dtype=object)


def distance_raster(patches: DataFrame, resolution_m: float = 0.6, mask: str = "mask") -> DataFrame:
    """Adds ``distance``: metres to the nearest mask pixel; the patch diagonal for an empty mask.

    Exact, in time linear in the pixels: vertical distances, then the lower envelope of parabolas along rows.
    """
    return patches.withColumn("distance", F.transform(_distances(F.col(mask), F.col("height"), F.col("width")), lambda v: v * resolution_m))


def distance_blocks(blocks: DataFrame, raster: str, limit: int, resolution_m: float = 0.6) -> DataFrame:
    """``raster, row0, col0, height, width, distance`` of a large raster in blocks (``mask`` arrays), exact up to ``limit`` pixels and ``limit`` beyond.

    A block sends the strips within ``limit`` of its neighbours to them, so only halos are copied; blocks are at least ``limit`` high and wide,
    but for the last ones of a raster.
    """
    kind = blocks.schema[raster].dataType.simpleString()
    place = ["row0", "col0", "height", "width"]
    homes = blocks.select(raster, *place)
    # Every block in the 3 x 3 around a block, as seen from that one.
    size = blocks.groupBy(raster).agg(F.max("height").alias("_h"), F.max("width").alias("_w"))
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    sent = (blocks.join(size, raster).withColumn("_dr", F.explode(steps)).withColumn("_dc", F.explode(steps))
            .withColumns({"_hr": F.col("row0") + F.col("_dr") * F.col("_h"), "_hc": F.col("col0") + F.col("_dc") * F.col("_w")}))

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = []
            for r in b.to_pylist():
                m = np.asarray(r["mask"]).reshape(r["height"], r["width"]) > 0
                rows = slice(max(0, r["height"] - limit), None) if r["_dr"] > 0 else slice(0, limit) if r["_dr"] < 0 else slice(None)
                cols = slice(max(0, r["width"] - limit), None) if r["_dc"] > 0 else slice(0, limit) if r["_dc"] < 0 else slice(None)
                top, left = r["row0"] + (rows.start or 0), r["col0"] + (cols.start or 0)
                at = np.argwhere(m[rows, cols]) + (top, left)
                cut.append(at.astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(raster), b.column("_hr"), b.column("_hc"), pa.array(cut, pa.binary())], names=[raster, "row0", "col0", "_on"])

    around = sent.select(raster, *place, "mask", "_dr", "_dc", "_hr", "_hc").mapInArrow(strips, f"`{raster}` {kind}, row0 int, col0 int, _on binary")
    together = around.groupBy(raster, "row0", "col0").agg(F.collect_list("_on").alias("_on")).join(homes, [raster, "row0", "col0"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.select([*place, "_on"]).to_pylist():
                m = np.zeros((r["height"] + 2 * limit, r["width"] + 2 * limit), bool)
                at = np.frombuffer(b"".join(r["_on"]), np.int64).reshape(-1, 2) - (r["row0"] - limit, r["col0"] - limit)
                m[at[:, 0], at[:, 1]] = True
                d = np.sqrt(arrays.squared_distances(m))[limit:limit + r["height"], limit:limit + r["width"]]
                out.append(np.minimum(d, limit).ravel() * resolution_m)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (raster, *place)], pa.array(out, pa.list_(pa.float64()))], names=[raster, *place, "distance"])

    return together.mapInArrow(fill, f"`{raster}` {kind}, row0 int, col0 int, height int, width int, distance array<double>")


def normalize_bands(patches: DataFrame, bands: Sequence[str], mean: Sequence[float], std: Sequence[float],
                    size: int = 512) -> DataFrame:
    """Scale to 0..1 when any value exceeds 1, pad or crop to ``size``, standardise per band.

    Missing bands (NULL) become zeros before standardising.
    """
    blank = F.array_repeat(F.lit(0.0), (F.col("height") * F.col("width")).cast("int"))
    p = patches.withColumns({f"_{b}": F.coalesce(F.transform(b, lambda v: v.cast("double")), blank) for b in bands})
    top = F.array_max(F.array(*[F.array_max(f"_{b}") for b in bands]))
    p = p.withColumn("_scale", F.when(top > 1, 255.0).otherwise(1.0))

    def fitted(b, m, s):
        row = lambda r: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda c: F.when(
            (r < F.col("height")) & (c < F.col("width")),
            F.try_element_at(F.col(f"_{b}"), (r * F.col("width") + c + 1).cast("int"))).otherwise(0.0))
        return F.transform(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), row)),
                           lambda v: (v / F.col("_scale") - m) / s)
    out = p.withColumns({b: fitted(b, m, s) for b, m, s in zip(bands, mean, std)})
    return out.withColumns({"height": F.lit(size), "width": F.lit(size)}).drop(*[f"_{b}" for b in bands], "_scale")


def channel_statistics(patches: DataFrame, bands: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation per group and band.

    Each patch is reduced to its sums on its own row first; no pixel is shuffled.
    """
    square = lambda b: F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double"))
    parts = patches.select(*by, *[F.struct(F.size(b).alias("n"), array_sum(F.col(b)).alias("s"), square(b).alias("q")).alias(b)
                                  for b in bands])
    rows = parts.select(*by, F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(b).alias("p")) for b in bands])).alias("r"))
    n, s, q = F.sum("r.p.n"), F.sum("r.p.s"), F.sum("r.p.q")
    return rows.groupBy(*by, F.col("r.band").alias("band")).agg(
        (s / n).alias("mean"), F.sqrt(F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))).alias("std"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


COMBINE = {"mean": np.mean, "median": np.median, "max": np.max}


def score_patches(patches: DataFrame, bands: Sequence[str], models: Sequence[Callable[[np.ndarray], np.ndarray]],
                  combine: str = "mean") -> DataFrame:
    """Adds ``prob``: the combined sigmoid of every model's logits.

    A model maps an array (patches, bands, pixels) of one Arrow batch to logits (patches, pixels);
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` bounds the batch.
    """
    reduce_models = COMBINE[combine]

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def score(*columns: pd.Series) -> pd.Series:
        sizes = columns[0].map(len)
        out = pd.Series([None] * len(sizes), index=sizes.index, dtype=object)
        for n, index in sizes.groupby(sizes).groups.items():
            batch = np.stack([np.stack([np.asarray(v, dtype=float) for v in c.loc[index]]) for c in columns], axis=1)
            prob = reduce_models(np.stack([_sigmoid(m(batch)) for m in models]), axis=0)
            for i, p in zip(index, prob):
                out.at[i] = p
        return out

    return patches.withColumn("prob", score(*[F.col(b) for b in bands]))


def threshold_mask(prob: Column, threshold: float = 0.5) -> Column:
    return F.transform(prob, lambda v: (v >= threshold).cast("int"))


def segmentation_metrics(patches: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per patch overlap metrics of ``prob`` against ``mask``; nothing is shuffled."""
    sums = F.aggregate(
        F.arrays_zip("prob", "mask"),
        F.struct(*[F.lit(0).cast("bigint").alias(k) for k in ("i", "p", "m")], F.lit(0.0).alias("s")),
        lambda acc, v: F.struct(
            (acc["i"] + F.when((v["prob"] >= threshold) & (v["mask"] > 0), 1).otherwise(0)).alias("i"),
            (acc["p"] + F.when(v["prob"] >= threshold, 1).otherwise(0)).alias("p"),
            (acc["m"] + F.when(v["mask"] > 0, 1).otherwise(0)).alias("m"),
            (acc["s"] + v["prob"].cast("double")).alias("s")))
    p = patches.withColumn("_s", sums)
    i, ps, ms = F.col("_s.i"), F.col("_s.p"), F.col("_s.m")
    return p.withColumns({
        "iou": (i + EPS) / (ps + ms - i + EPS), "dice": (2 * i + EPS) / (ps + ms + EPS),
        "pixel_precision": i / (ps + EPS), "pixel_recall": i / (ms + EPS),
        "pred_positive_px": ps, "gt_positive_px": ms, "mean_prob": F.col("_s.s") / F.size("prob"),
        "max_prob": F.array_max("prob").cast("double"), "patch_score": patch_score_top1pct(F.col("prob"))}).drop("_s")


def patch_score_top1pct(prob: Column) -> Column:
    """Mean of the top 1 % of probabilities, at least one."""
    k = F.greatest(F.lit(1), F.floor(F.size(prob) * 0.01)).cast("int")
    return array_sum(F.slice(F.sort_array(prob, asc=False), F.lit(1), k)) / k


def merge_tiles(tiles: DataFrame, raster: str, block: int = BLOCK) -> DataFrame:
    """Mean probability over overlapping tiles, as blocks ``raster, row0, col0, height, width, prob, covered``.

    ``tiles``: ``raster, row_off, col_off, height, width, prob`` (arrays). A tile is cut at block borders and its pieces are added up in the task
    of their block, one at a time; pixels no tile covers have ``prob`` 0 and ``covered`` 0.
    """
    kind = tiles.schema[raster].dataType.simpleString()
    schema = f"`{raster}` {kind}, row0 int, col0 int, r int, c int, h int, w int, part binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i in range(b.num_rows):
                top, left, h, w = (b.column(k)[i].as_py() for k in ("row_off", "col_off", "height", "width"))
                p = b.column("prob")[i].values.to_numpy(zero_copy_only=False).reshape(h, w)
                for br in range(top // block, (top + h - 1) // block + 1):
                    for bc in range(left // block, (left + w - 1) // block + 1):
                        r0, c0 = max(top, br * block), max(left, bc * block)
                        part = p[r0 - top:(br + 1) * block - top, c0 - left:(bc + 1) * block - left]
                        out.append((i, br * block, bc * block, r0 - br * block, c0 - bc * block, *part.shape, np.ascontiguousarray(part, "<f8").tobytes()))
            if out:
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column(raster).take(pa.array(columns[0])), *[pa.array(c, pa.int32()) for c in columns[1:-1]], pa.array(columns[-1], pa.binary())],
                    names=[raster, "row0", "col0", "r", "c", "h", "w", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total, count, key = None, None, None, None

        def done():
            with np.errstate(invalid="ignore"):
                mean = np.where(count > 0, total / np.maximum(count, 1), 0.0)
            return pa.RecordBatch.from_arrays(
                [key, *[pa.array([v], pa.int32()) for v in (*place[1:], block, block)], pa.array([mean.ravel()], pa.list_(pa.float64())),
                 pa.array([count.ravel()], pa.list_(pa.int32()))], names=[raster, "row0", "col0", "height", "width", "prob", "covered"])

        for b in batches:
            for i in range(b.num_rows):
                r = {k: b.column(k)[i].as_py() for k in b.schema.names}
                now = (r[raster], r["row0"], r["col0"])
                if now != place:
                    if place is not None:
                        yield done()
                    place, key, total, count = now, b.column(raster)[i:i + 1], np.zeros((block, block)), np.zeros((block, block), np.int32)
                here = np.s_[r["r"]:r["r"] + r["h"], r["c"]:r["c"] + r["w"]]
                total[here] += np.frombuffer(r["part"], "<f8").reshape(r["h"], r["w"])
                count[here] += 1
        if place is not None:
            yield done()

    cut_up = tiles.select(raster, "row_off", "col_off", "height", "width", "prob").mapInArrow(cut, schema)
    ordered = cut_up.repartition(raster, "row0", "col0").sortWithinPartitions(raster, "row0", "col0")
    return ordered.mapInArrow(add, f"`{raster}` {kind}, row0 int, col0 int, height int, width int, prob array<double>, covered array<int>")


def block_pixels(blocks: DataFrame, raster: str, rasters: DataFrame | None = None) -> DataFrame:
    """``raster, row, col, prob`` of covered pixels; with ``rasters`` (``raster, height, width``) all pixels, uncovered ones with 0."""
    zipped = blocks.select(raster, "row0", "col0", "width", F.posexplode(F.arrays_zip("prob", "covered")).alias("_at", "_p"))
    pixels = zipped.select(raster, (F.col("row0") + F.floor(F.col("_at") / F.col("width"))).cast("int").alias("row"),
                           (F.col("col0") + F.col("_at") % F.col("width")).cast("int").alias("col"), F.col("_p.prob").alias("prob"), "_p.covered")
    if rasters is None:
        return pixels.filter("covered > 0").drop("covered")
    inside = pixels.drop("covered").join(rasters.select(raster, F.col("height").alias("_h"), F.col("width").alias("_w")), raster)
    return inside.filter("row < _h AND col < _w").drop("_h", "_w")


def merge_overlaps(tiles: DataFrame, raster: str, rasters: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Mean probability per raster pixel over the tiles covering it, as pixel rows; :func:`merge_tiles` keeps blocks.

    With ``rasters`` (``raster, height, width``) uncovered pixels appear with 0, also in rasters and blocks without any tile.
    """
    merged = merge_tiles(tiles, raster, block)
    if rasters is None:
        return block_pixels(merged, raster)
    n = lambda c: F.sequence(F.lit(0), F.ceil(F.col(c) / block).cast("int") - 1)
    every = rasters.filter("height > 0 AND width > 0").withColumn("row0", F.explode(n("height"))).withColumn("col0", F.explode(n("width"))).select(
        raster, (F.col("row0") * block).alias("row0"), (F.col("col0") * block).alias("col0"))
    none = F.array_repeat(F.lit(0), block * block)
    whole = every.join(merged, [raster, "row0", "col0"], "left").select(
        raster, "row0", "col0", F.lit(block).alias("height"), F.lit(block).alias("width"),
        F.coalesce("prob", none.cast("array<double>")).alias("prob"), F.coalesce("covered", none).alias("covered"))
    return block_pixels(whole, raster, rasters)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _labels(prob: pd.Series, height: pd.Series, width: pd.Series, threshold: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else arrays.components(np.asarray(p, float).reshape(h, w) >= t).ravel()
                      for p, h, w, t in zip(prob, height, width, threshold)], index=prob.index, dtype=object)


def label_patches(patches: DataFrame, threshold: float = 0.5, prob: str = "prob") -> DataFrame:
    """Adds ``labels``: per pixel the number (row-major place) of the first pixel of its 4-connected component, -1 under the threshold."""
    return patches.withColumn("labels", _labels(F.col(prob), F.col("height"), F.col("width"), F.lit(float(threshold))))


def block_components(blocks: DataFrame, raster: str, threshold: float = 0.5) -> DataFrame:
    """4-connected components of pixels from ``threshold`` on, over a raster in blocks (``raster, row0, col0, height, width, prob``).

    Every block labels its own pixels by union-find. Only components on a block border take part in the rounds that
    join them, through the pixels that face each other across it; a patch is a raster of one block and needs no round. Columns as in :func:`component_boxes`.
    """
    kind = blocks.schema[raster].dataType.simpleString()
    names = ["component", "positive_pixels", "prob_sum", "max_confidence", "row_min", "row_max", "col_min", "col_max"]
    step = components.ROW_STEP

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, columns, border = [], [[] for _ in names], []
            for i in range(b.num_rows):
                row0, col0, h, w = (b.column(k)[i].as_py() for k in ("row0", "col0", "height", "width"))
                if not b.column("prob")[i].is_valid:
                    continue
                p = b.column("prob")[i].values.to_numpy(zero_copy_only=False).astype(float).reshape(h, w)
                labels = arrays.components(p >= threshold)
                row, col = np.nonzero(labels >= 0)
                if not len(row):
                    continue
                first, at = np.unique(labels[row, col], return_inverse=True)
                value, m = p[row, col], len(first)
                part = (row0 + first // w) * step + col0 + first % w
                low = lambda v, f=np.minimum, start=1 << 60: (out := np.full(m, start), f.at(out, at, v))[0]  # noqa: E731, B023
                top = np.full(m, -np.inf)
                np.maximum.at(top, at, value)
                found = [part, np.bincount(at, minlength=m), np.bincount(at, weights=value, minlength=m), top, low(row) + row0,
                         low(row, np.maximum, -1) + row0, low(col) + col0, low(col, np.maximum, -1) + col0]
                keys += [i] * m
                for column, v in zip(columns, found, strict=True):
                    column.append(v)
                # Pixels on the border, by side: 0 top, 1 bottom, 2 left, 3 right.
                sides: list[list] = [[] for _ in range(m)]
                on = {0: row == 0, 1: row == h - 1, 2: col == 0, 3: col == w - 1}
                for side, here in on.items():
                    for k in np.flatnonzero(here).tolist():
                        sides[at[k]].append({"side": side, "row": int(row[k]) + row0, "col": int(col[k]) + col0})
                border += sides
            if keys:
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(raster).take(pa.array(keys)), *[pa.array(np.concatenate(c)).cast(k) for c, k in zip(columns, kinds, strict=True)],
                     pa.array(border, pa.list_(pa.struct([("side", pa.int32()), ("row", pa.int32()), ("col", pa.int32())])))],
                    names=[raster, *names, "border"])

    parts = materialise(blocks.select(raster, "row0", "col0", "height", "width", "prob").mapInArrow(label, (
        f"`{raster}` {kind}, component bigint, positive_pixels bigint, prob_sum double, max_confidence double, row_min int, row_max int, col_min int, "
        "col_max int, border array<struct<side:int,row:int,col:int>>")))
    pixel = parts.select(raster, "component", F.explode("border").alias("_p")).select(raster, "component", "_p.*")
    one = lambda side, dr, dc: pixel.filter(F.col("side") == side).select(
        raster, (F.col("row") + dr).alias("row"), (F.col("col") + dc).alias("col"), F.col("component"))
    faces = [(one(1, 1, 0), one(0, 0, 0)), (one(3, 0, 1), one(2, 0, 0))]
    edges = [a.withColumnRenamed("component", "a").join(b.withColumnRenamed("component", "b"), [raster, "row", "col"]).select(raster, "a", "b") for a, b in faces]
    edges = materialise(edges[0].unionByName(edges[1]).distinct())
    if edges.isEmpty():
        joined = parts.withColumn("_whole", F.col("component"))
    else:
        ends = edges.select(raster, F.col("a").alias("component")).unionByName(edges.select(raster, F.col("b").alias("component"))).distinct()
        of = components.connected_components(ends.withColumnRenamed("component", "node"), edges, "node", [raster])
        joined = parts.join(of.select(raster, F.col("node").alias("component"), F.col("component").alias("_whole")), [raster, "component"], "left")
        joined = joined.withColumn("_whole", F.coalesce("_whole", "component"))
    n = F.sum("positive_pixels")
    return joined.groupBy(raster, F.col("_whole").alias("component")).agg(
        n.alias("positive_pixels"), (F.sum("prob_sum") / n).alias("mean_confidence"), F.max("max_confidence").alias("max_confidence"),
        F.min("row_min").alias("row_min"), F.max("row_max").alias("row_max"), F.min("col_min").alias("col_min"), F.max("col_max").alias("col_max"))


def component_boxes(pixels: DataFrame, raster: str) -> DataFrame:
    """Components of sparse positive pixels ``(raster, row, col, prob)`` with size, confidence and box."""
    labelled = components.label_runs(components.runs(pixels, raster), raster)
    n = F.sum(F.col("c1") - F.col("c0") + 1)
    return labelled.groupBy(raster, "component").agg(
        n.alias("positive_pixels"), (F.sum("prob_sum") / n).alias("mean_confidence"),
        F.max("prob_max").alias("max_confidence"), F.min("row").alias("row_min"), F.max("row").alias("row_max"),
        F.min("c0").alias("col_min"), F.max("c1").alias("col_max"))


def extract_detections(boxes: DataFrame, affine: DataFrame, raster: str, resolution: float = 0.6,
                       min_area_m2: float = 200.0, to_lonlat=None) -> DataFrame:
    """Detections from component boxes; the centre is the middle of the box.

    ``affine``: ``raster, a, c, e, f``. ``to_lonlat(x, y)`` converts map units to degrees.
    """
    kept = boxes.filter(F.col("positive_pixels") >= min_area_m2 / resolution**2).join(affine, raster)
    p = G.affine_to_world(*[F.col(k) for k in "acef"], F.expr("(col_min + col_max) / 2"), F.expr("(row_min + row_max) / 2"))
    out = kept.withColumn("_p", p)
    place = to_lonlat(F.col("_p.x"), F.col("_p.y")) if to_lonlat else F.struct(
        F.col("_p.x").alias("lon"), F.col("_p.y").alias("lat"))
    return out.withColumn("_q", place).select(
        raster, "component", F.col("_q.lon").alias("center_lon"), F.col("_q.lat").alias("center_lat"), "positive_pixels",
        (F.col("positive_pixels") * resolution * resolution).alias("area_m2"), "mean_confidence", "max_confidence",
        ((F.col("col_max") - F.col("col_min") + 1) * resolution).alias("bbox_width_m"),
        ((F.col("row_max") - F.col("row_min") + 1) * resolution).alias("bbox_height_m"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _block_means(band: pd.Series, height: pd.Series, width: pd.Series, factor: pd.Series) -> pd.Series:
    def one(v, h, w, k):
        if v is None:
            return None
        rows, cols = np.arange(0, h, k), np.arange(0, w, k)
        sums = np.add.reduceat(np.add.reduceat(np.asarray(v, float).reshape(h, w), rows, axis=0), cols, axis=1)
        counts = np.diff(np.append(rows, h))[:, None] * np.diff(np.append(cols, w))
        return (sums / counts).ravel()
    return pd.Series([one(*x) for x in zip(band, height, width, factor)], index=band.index, dtype=object)


def downsample_bands(patches: DataFrame, factor: int, bands: Sequence[str]) -> DataFrame:
    """Bands as means over ``factor`` x ``factor`` pixels (fewer at the far edges), with the new size; no pixel leaves its row."""
    small = {b: _block_means(F.col(b), F.col("height"), F.col("width"), F.lit(factor)) for b in bands}
    size = {k: F.ceil(F.col(k) / factor).cast("int") for k in ("height", "width")}
    return patches.withColumns(small).withColumns(size)

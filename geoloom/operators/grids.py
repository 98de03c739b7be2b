"""Row generators: demand grids, tile windows, patch windows, extraction estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.functions import scalars as S

PATCH_GROUND_SPAN_M = 307.2
PATCH_MEGABYTES = 0.4


def total_bounds(polygons: DataFrame, by: tuple[str, ...] = (), rings: str = "rings") -> DataFrame:
    """``xmin, ymin, xmax, ymax`` over all vertices, without exploding them."""
    box = polygons.select(*by, G.envelope(F.col(rings)).alias("b"))
    return box.groupBy(*by).agg(F.min("b.xmin").alias("xmin"), F.min("b.ymin").alias("ymin"),
                                F.max("b.xmax").alias("xmax"), F.max("b.ymax").alias("ymax"))


def _steps(span: Column, size: float) -> Column:
    """Indices of a half-open range of ``size`` steps: empty when the span is."""
    n = F.ceil(span / size).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def make_regular_grid(bounds: DataFrame, cell_size_m: float = 3000.0) -> DataFrame:
    """Square cells from the lower-left corner of each bounds row; the last cells overhang.

    ``cell_id`` numbers cells column by column (x-major) and needs no sort. Columns are dealt to tasks before they become cells.
    """
    rows = F.ceil((F.col("ymax") - F.col("ymin")) / cell_size_m).cast("bigint")
    return (bounds.withColumn("ix", F.explode(_steps(F.col("xmax") - F.col("xmin"), cell_size_m))).repartition("ix")
            .withColumn("iy", F.explode(_steps(F.col("ymax") - F.col("ymin"), cell_size_m)))
            .withColumns({
                "cell_id": F.col("ix") * rows + F.col("iy"),
                "x0": F.col("xmin") + F.col("ix") * cell_size_m,
                "y0": F.col("ymin") + F.col("iy") * cell_size_m})
            .withColumns({"cx": F.col("x0") + cell_size_m / 2, "cy": F.col("y0") + cell_size_m / 2})
            .drop("xmin", "ymin", "xmax", "ymax"))


def tile_windows(rasters: DataFrame, size: int = 512, overlap: int = 64) -> DataFrame:
    """Window offsets per raster (``height, width``); partial edge windows are left out."""
    def offsets(length):
        last = F.col(length) - size
        return F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(size - overlap))).otherwise(
            F.array().cast("array<int>"))
    return (rasters.withColumn("row_off", F.explode(offsets("height")))
            .withColumn("col_off", F.explode(offsets("width"))))


def patch_windows(tiles: DataFrame, bbox: tuple[float, float, float, float], to_lonlat=None,
                  corners=None, ground_span_m: float = PATCH_GROUND_SPAN_M) -> DataFrame:
    """Windows of one ground patch per tile, with centre, name and ground-cell key.

    ``tiles``: ``tile_id, height, width, a, c, e, f`` (affine). ``corners(lon, lat)`` and
    ``to_lonlat(x, y)`` convert to and from the tile's coordinates; without them the tile
    is in degrees. A window is kept when its centre lies in ``bbox``, edges included.
    """
    west, south, east, north = (F.lit(float(v)) for v in bbox)
    lower = corners(west, south) if corners else G.point(west, south)
    upper = corners(east, north) if corners else G.point(east, north)
    a, c, e, f = (F.col(k) for k in "acef")
    step = F.greatest(F.bround(F.lit(ground_span_m) / F.abs(a), 0).cast("int"), F.lit(1))
    t = tiles.withColumns({"_lo": lower, "_hi": upper, "_step": step})
    xs = (F.least(F.col("_lo.x"), F.col("_hi.x")), F.greatest(F.col("_lo.x"), F.col("_hi.x")))
    ys = (F.least(F.col("_lo.y"), F.col("_hi.y")), F.greatest(F.col("_lo.y"), F.col("_hi.y")))
    t = t.withColumns({
        "_c0": F.greatest(F.lit(0), ((xs[0] - c) / a).cast("int")),
        "_c1": F.least(F.col("width"), ((xs[1] - c) / a).cast("int")),
        "_r0": F.greatest(F.lit(0), ((ys[1] - f) / e).cast("int")),
        "_r1": F.least(F.col("height"), ((ys[0] - f) / e).cast("int"))})
    t = t.filter((F.col("_c1") - F.col("_c0") >= F.col("_step")) & (F.col("_r1") - F.col("_r0") >= F.col("_step")))
    t = (t.withColumn("row_off", F.explode(F.sequence(F.col("_r0"), F.col("_r1") - F.col("_step"), F.col("_step"))))
         .withColumn("col_off", F.explode(F.sequence(F.col("_c0"), F.col("_c1") - F.col("_step"), F.col("_step")))))
    centre = G.affine_to_world(a, c, e, f, F.col("col_off") + F.col("_step") / 2, F.col("row_off") + F.col("_step") / 2)
    t = t.withColumn("_p", centre)
    place = to_lonlat(F.col("_p.x"), F.col("_p.y")) if to_lonlat else F.struct(
        F.col("_p.x").alias("lon"), F.col("_p.y").alias("lat"))
    t = t.withColumn("_p", place).withColumns({"center_lon": F.col("_p.lon"), "center_lat": F.col("_p.lat")})
    inside = F.col("center_lon").between(west, east) & F.col("center_lat").between(south, north)
    return t.filter(inside).withColumns({
        "patch_id": S.ground_patch_id(F.col("center_lon"), F.col("center_lat")),
        "window": F.col("_step"),
        "key_lon": F.bround(F.col("center_lon") * 1000, 0).cast("bigint"),
        "key_lat": F.bround(F.col("center_lat") * 1000, 0).cast("bigint"),
    }).drop("_lo", "_hi", "_step", "_c0", "_c1", "_r0", "_r1", "_p")


def extraction_estimate(boxes: DataFrame) -> DataFrame:
    """Rough size of an extraction for boxes ``west, south, east, north`` in degrees."""
    width, height = (F.col("east") - F.col("west")) * 85.0, (F.col("north") - F.col("south")) * 111.0
    span = PATCH_GROUND_SPAN_M / 1000
    return boxes.withColumns({"width_km": width, "height_km": height}).withColumn(
        "n_patches", F.floor(F.col("width_km") / span) * F.floor(F.col("height_km") / span)).withColumn(
        "megabytes", F.col("n_patches") * PATCH_MEGABYTES)

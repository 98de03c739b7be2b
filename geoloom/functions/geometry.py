"""Planar geometry as Column expressions over nested arrays.

A polygon is ``rings ARRAY<ARRAY<STRUCT<x,y>>>``: outer rings counter-clockwise,
holes clockwise, parts of a multi-polygon simply listed one after another.
Most functions take the polygon's *edge list* (see :func:`edges`) so that a plan
builds it once per row with ``withColumn`` and uses it many times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """One counter-clockwise ring from box corners."""
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)))


def ring_edges(ring: Column) -> Column:
    """Edges of one ring, the closing edge included (a repeated first vertex is harmless)."""
    rest = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
    following = F.concat(rest, F.slice(ring, 1, 1))
    return F.zip_with(ring, following, lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, ring_edges))


def path_segments(path: Column) -> Column:
    """Consecutive segments of an open polyline."""
    n = F.greatest(F.size(path) - 1, F.lit(0))
    return F.zip_with(F.slice(path, F.lit(1), n), F.slice(path, F.lit(2), n), lambda a, b: F.struct(
        a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def _sum(items: Column, term) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + term(e))


def _relative_cross(e: Column, ox: Column, oy: Column) -> Column:
    return (e["x1"] - ox) * (e["y2"] - oy) - (e["x2"] - ox) * (e["y1"] - oy)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where ``body`` uses it inside lambdas, which would compute it again per element."""
    return F.transform(F.array(value), body)[0]


def signed_area(edge_list: Column) -> Column:
    # Shifting to the first vertex keeps projected (1e6-sized) coordinates accurate.
    return once(edge_list, lambda es: _sum(es, lambda e: _relative_cross(e, es[0]["x1"], es[0]["y1"])) / 2)


def polygon_area(edge_list: Column) -> Column:
    return F.abs(signed_area(edge_list))


def polygon_centroid(edge_list: Column) -> Column:
    """Area-weighted centroid as ``STRUCT<x,y>``; a zero-area polygon gives its first vertex."""
    ox, oy = edge_list[0]["x1"], edge_list[0]["y1"]
    sums = F.aggregate(
        edge_list,
        F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
        lambda s, e: F.struct(
            (s["a"] + _relative_cross(e, ox, oy)).alias("a"),
            (s["mx"] + (e["x1"] + e["x2"] - 2 * ox) * _relative_cross(e, ox, oy)).alias("mx"),
            (s["my"] + (e["y1"] + e["y2"] - 2 * oy) * _relative_cross(e, ox, oy)).alias("my")),
        lambda s: F.struct(F.coalesce(F.try_divide(s["mx"], 3 * s["a"]), F.lit(0.0)).alias("dx"),
                           F.coalesce(F.try_divide(s["my"], 3 * s["a"]), F.lit(0.0)).alias("dy")))
    return F.transform(F.array(sums), lambda d: point(ox + d["dx"], oy + d["dy"]))[0]


def envelope(rings: Column) -> Column:
    """Bounding box as ``STRUCT<xmin,ymin,xmax,ymax>``."""
    xs = F.transform(F.flatten(rings), lambda p: p["x"])
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def box_overlap_area(edge_list: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area of polygon ∩ box, for any simple polygon, concave or with holes.

    For a vertical line the part of the polygon inside ``[y0, y1]`` is a signed
    sum of the clamped edge heights, so the area is a signed sum over edges of
    the integral of the clamped height across the box's x range. Each integral
    is closed form: with ``H`` the antiderivative of ``clamp(t, 0, h)`` it is
    ``dx * (H(yb) - H(ya)) / (yb - ya)``. No clipped polygon is built.
    """
    h = y1 - y0

    def antiderivative(t):
        inside = F.greatest(F.lit(0.0), F.least(t, h))
        return inside * inside / 2 + F.greatest(t - h, F.lit(0.0)) * h

    def contribution(e):
        ex = e["x2"] - e["x1"]
        xa = F.greatest(x0, F.least(e["x1"], x1))
        xb = F.greatest(x0, F.least(e["x2"], x1))
        slope = F.coalesce(F.try_divide(e["y2"] - e["y1"], ex), F.lit(0.0))
        ya = e["y1"] + (xa - e["x1"]) * slope - y0
        yb = e["y1"] + (xb - e["x1"]) * slope - y0
        flat = F.abs(yb - ya) < 1e-6
        middle = F.greatest(F.lit(0.0), F.least((ya + yb) / 2, h))
        mean_height = F.when(flat, middle).otherwise(
            F.try_divide(antiderivative(yb) - antiderivative(ya), yb - ya))
        return F.when(xa == xb, F.lit(0.0)).otherwise((xb - xa) * mean_height)

    return F.abs(_sum(edge_list, contribution))


def _cross(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def on_boundary(edge_list: Column, x: Column, y: Column) -> Column:
    return F.exists(edge_list, lambda e: (
        (_cross(e["x1"], e["y1"], e["x2"], e["y2"], x, y) == 0)
        & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
        & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))))


def point_in_polygon(edge_list: Column, x: Column, y: Column) -> Column:
    """Even-odd ray cast. Points on the boundary may fall either way; see :func:`on_boundary`."""
    def crossing(e):
        spans = (e["y1"] > y) != (e["y2"] > y)
        rising = e["y2"] > e["y1"]
        left_of = _cross(e["x1"], e["y1"], e["x2"], e["y2"], x, y) > 0
        return F.when(spans & (rising == left_of), 1).otherwise(0)

    hits = F.aggregate(edge_list, F.lit(0), lambda acc, e: acc + crossing(e))
    return hits % 2 == 1


def covers_point(edge_list: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return point_in_polygon(edge_list, x, y) | on_boundary(edge_list, x, y)


def contains_point(edge_list: Column, x: Column, y: Column) -> Column:
    """Strictly inside."""
    return point_in_polygon(edge_list, x, y) & ~on_boundary(edge_list, x, y)


def _proper_crossing(a: Column, b: Column) -> Column:
    d1 = _cross(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    d2 = _cross(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])
    d3 = _cross(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    d4 = _cross(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    return (F.signum(d1) * F.signum(d2) < 0) & (F.signum(d3) * F.signum(d4) < 0)


def polygon_within(inner: Column, outer: Column) -> Column:
    """No point of ``inner`` lies outside ``outer`` (touching the boundary is allowed).

    Edge midpoints are tested as well as vertices, so an inner edge that leaves a
    concave polygon between two touching vertices is caught.
    """
    corners = F.forall(inner, lambda e: covers_point(outer, e["x1"], e["y1"]))
    middles = F.forall(inner, lambda e: covers_point(
        outer, (e["x1"] + e["x2"]) / 2, (e["y1"] + e["y2"]) / 2))
    crossing = F.exists(inner, lambda a: F.exists(outer, lambda b: _proper_crossing(a, b)))
    swallowed = F.exists(outer, lambda e: contains_point(inner, e["x1"], e["y1"]))
    return corners & middles & ~crossing & ~swallowed


def segment_meets_box(e: Column, x0, y0, x1, y1) -> Column:
    """Segment touches the closed box (separating-axis test)."""
    apart = ((F.greatest(e["x1"], e["x2"]) < x0) | (F.least(e["x1"], e["x2"]) > x1)
             | (F.greatest(e["y1"], e["y2"]) < y0) | (F.least(e["y1"], e["y2"]) > y1))
    sides = [_cross(e["x1"], e["y1"], e["x2"], e["y2"], cx, cy)
             for cx, cy in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]
    return ~apart & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def polygon_intersects_box(edge_list: Column, x0, y0, x1, y1) -> Column:
    """Polygon and closed box share at least one point."""
    return (F.exists(edge_list, lambda e: segment_meets_box(e, x0, y0, x1, y1))
            | point_in_polygon(edge_list, x0, y0))


def distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def segment_distance(px, py, x1, y1, x2, y2) -> Column:
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((px - x1) * dx + (py - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return distance(px, py, x1 + t * dx, y1 + t * dy)


def buffer_point(x: Column, y: Column, radius: float, vertices: int = 64) -> Column:
    """Circle polygon around a point."""
    step = 2 * 3.141592653589793 / vertices
    return F.array(F.transform(F.sequence(F.lit(0), F.lit(vertices - 1)), lambda i: point(
        x + F.lit(radius) * F.cos(i * step), y + F.lit(radius) * F.sin(i * step))))


def orient_rings(rings: Column) -> Column:
    """Outer ring counter-clockwise, holes clockwise (first ring of a polygon is the outer one)."""
    return F.transform(rings, lambda r, i: F.when(
        (signed_area(ring_edges(r)) > 0) == (i == 0), r).otherwise(F.reverse(r)))


def affine_to_world(a: Column, c: Column, e: Column, f: Column, col: Column, row: Column) -> Column:
    return point(c + col * a, f + row * e)

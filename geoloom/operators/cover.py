"""Polygons as bins: edges only where they run, interiors by scan-line parity.

Every edge goes to the bins it crosses. In each row of bins, the places where a polygon's edges cross one horizontal line are
sorted once; the parity of crossings to the right of a bin's anchor says whether the anchor is inside. A bin
without an edge is then wholly inside or outside, and a point in a bin with edges is inside if the way from the anchor
to it crosses that bin's edges an odd number of times (or an even number, if the anchor is outside). So no ring is copied:
what is shuffled grows with edges plus bins, and each test reads only the edges of one bin.

Anchors lie at odd fractions of a bin, so that edges on round coordinates do not pass through them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geometry as G
from geoloom.operators.checkpoints import materialise

ANCHOR_X, ANCHOR_Y = 0.41421356237, 0.31830988618
EDGE = ("x1", "y1", "x2", "y2")
BIN = ["_bx", "_by"]


def anchor(size: float) -> tuple[Column, Column]:
    return (F.col("_bx") + ANCHOR_X) * F.lit(float(size)), (F.col("_by") + ANCHOR_Y) * F.lit(float(size))


def crossing_x(e: Column, y: Column) -> Column:
    """Where an edge crosses a height."""
    return e["x1"] + (y - e["y1"]) * F.try_divide(e["x2"] - e["x1"], e["y2"] - e["y1"])


def cover(polygons: DataFrame, polygon_id: str, edges: str, size: float, walk) -> DataFrame:
    """``polygon_id, _bx, _by, _local, _inside``: bins with the edges in them and whether their anchor is inside, and bins wholly inside
    (``_local`` NULL). ``walk`` repeats edges for the bins they cross."""
    flat = polygons.select(polygon_id, F.explode(edges).alias("_e")).select(polygon_id, *[F.col(f"_e.{k}").alias(k) for k in EDGE])
    walked = materialise(walk(flat, size, 0.0, *[F.col(k) for k in EDGE]))
    ax, ay = anchor(size)
    line = F.struct(*EDGE)
    x = F.when((F.col("y1") > ay) != (F.col("y2") > ay), crossing_x(line, ay))
    # An edge is in several bins of a row; its crossing counts in the bin where it lies.
    rows = walked.withColumn("_x", x).filter(F.floor(F.col("_x") / F.lit(float(size))) == F.col("_bx")).groupBy(polygon_id, "_by").agg(
        F.array_sort(F.collect_list("_x")).alias("_xs"))
    rows = materialise(rows)
    outline = walked.groupBy(polygon_id, *BIN).agg(F.collect_list(line).alias("_local")).join(rows, [polygon_id, "_by"], "left")
    right = F.size(F.filter(F.coalesce("_xs", F.array().cast("array<double>")), lambda v: v > ax))
    outline = materialise(outline.select(polygon_id, *BIN, "_local", (right % 2 == 1).alias("_inside")))
    pairs = F.transform(F.sequence(F.lit(0), F.size("_xs") - 2, F.lit(2)), lambda i: F.struct(
        F.ceil(F.get("_xs", i) / size - ANCHOR_X).cast("bigint").alias("a"), F.floor(F.get("_xs", i + 1) / size - ANCHOR_X).cast("bigint").alias("b")))
    spans = F.transform(F.filter(pairs, lambda p: p["a"] <= p["b"]), lambda p: F.sequence(p["a"], p["b"]))
    inside = rows.filter(F.size("_xs") >= 2).select(polygon_id, "_by", F.explode(F.flatten(spans)).alias("_bx"))
    inside = inside.join(outline.select(polygon_id, *BIN), [polygon_id, *BIN], "left_anti")
    return outline.unionByName(inside.select(polygon_id, *BIN, F.lit(None).alias("_local"), F.lit(True).alias("_inside")))


def _faces(edges: np.ndarray, begin: np.ndarray, anchored: np.ndarray, bx: np.ndarray, by: np.ndarray, size: float) -> list[np.ndarray]:
    """Box around the edges inside each bin (x0, y0, x1, y1) and whether three corners of the bin (left and right below, left above) are in the
    polygon; bins with the edges ``begin[i]`` to ``begin[i + 1]`` each (one at least)."""
    own, pad = np.repeat(np.arange(len(bx)), np.diff(begin)), size * 1e-6
    x1, y1, x2, y2 = edges.T
    left, bottom = bx[own], by[own]

    def clip(a1, b1, a2, b2, low, high):
        """Range of the second coordinate where the first is in the bin; a steep edge is bounded by its ends alone."""
        steep = np.abs(a2 - a1) <= pad
        slope = (b2 - b1) / np.where(steep, 1.0, a2 - a1)
        ends = [b1 + (np.clip(v, np.minimum(a1, a2), np.maximum(a1, a2)) - a1) * slope for v in (low - pad, high + pad)]
        least, most = np.minimum(b1, b2), np.maximum(b1, b2)
        return (np.where(steep, least, np.maximum(np.minimum(*ends), least)) - pad, np.where(steep, most, np.minimum(np.maximum(*ends), most)) + pad)

    x, y = clip(y1, x1, y2, x2, bottom, bottom + size), clip(x1, y1, x2, y2, left, left + size)
    box = [np.minimum.reduceat(np.maximum(x[0], left - pad), begin[:-1]), np.minimum.reduceat(np.maximum(y[0], bottom - pad), begin[:-1]),
           np.maximum.reduceat(np.minimum(x[1], left + size + pad), begin[:-1]), np.maximum.reduceat(np.minimum(y[1], bottom + size + pad), begin[:-1])]
    ax, ay = left + ANCHOR_X * size, bottom + ANCHOR_Y * size

    def corner(px, py):
        """As :func:`inside`."""
        with np.errstate(divide="ignore", invalid="ignore"):
            across, up = x1 + (py - y1) * ((x2 - x1) / (y2 - y1)), y1 + (ax - x1) * ((y2 - y1) / (x2 - x1))
        level = ((y1 > py) != (y2 > py)) & (across > np.minimum(ax, px)) & (across <= np.maximum(ax, px))
        upright = ((x1 > ax) != (x2 > ax)) & (up > np.minimum(ay, py)) & (up <= np.maximum(ay, py))
        return anchored != (np.add.reduceat(level.astype(np.int64) + upright, begin[:-1]) % 2 == 1)

    return [*box, corner(left, bottom), corner(left + size, bottom), corner(left, bottom + size)]


def inside(x: Column, y: Column, size: float) -> Column:
    """Point of the bin inside the polygon, by the way from the anchor: level first, then upright. Points on an edge may fall either way."""
    ax, ay = anchor(size)

    def crosses(e):
        across, up = crossing_x(e, y), e["y1"] + (ax - e["x1"]) * F.try_divide(e["y2"] - e["y1"], e["x2"] - e["x1"])
        level = ((e["y1"] > y) != (e["y2"] > y)) & (across > F.least(ax, x)) & (across <= F.greatest(ax, x))
        upright = ((e["x1"] > ax) != (e["x2"] > ax)) & (up > F.least(ay, y)) & (up <= F.greatest(ay, y))
        return F.when(level, 1).otherwise(0) + F.when(upright, 1).otherwise(0)

    odd = F.aggregate("_local", F.lit(0), lambda n, e: n + crosses(e)) % 2 == 1
    return F.col("_inside") != odd


def tally(pairs: DataFrame, inner: str, size: float, kept: Sequence[str], summed: bool = False) -> DataFrame:
    """``kept`` columns of the pairs that hold, from rows of an inner edge list and a bin with edges (``near`` rows of :func:`meet`).

    Counts the corners and edge middles of ``inner`` in the bin that lie in the polygon or on its outline, and asks whether an outline in the bin crosses
    ``inner`` or has a corner inside it. The rows of a pair follow one another; it holds if their counts sum to ``_need`` and no outline cuts in. With
    ``summed`` the sums are returned as ``_counted`` and ``_cut`` instead."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the rows of a pair that may go on in the next batch
        for b in itertools.chain(batches, [None]):
            if b is not None:
                table = pa.Table.from_batches([held, b] if held is not None else [b]).combine_chunks()
                rows = table.to_batches()[0] if table.num_rows else b
                pair = rows.column("_pair").to_numpy()
                end = int(np.flatnonzero(pair != pair[-1])[-1]) + 1 if len(pair) and (pair != pair[-1]).any() else 0
                held, rows = rows.slice(end) if len(pair) else held, rows.slice(0, end)
            else:
                rows, held = held, None
            if rows is None or not rows.num_rows:
                continue
            pair = rows.column("_pair").to_numpy()
            first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            flat = [rows.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, 4) for k in (inner, "_local")]
            sizes = [pc.list_value_length(rows.column(k)).to_numpy().astype(np.int64) // 4 for k in (inner, "_local")]
            counted, cut = _tally(*flat, *sizes, rows.column("_inside").to_numpy(zero_copy_only=False), *(rows.column(k).to_numpy() for k in BIN), size)
            counted, cut = np.add.reduceat(counted, first), np.logical_or.reduceat(cut, first)
            if summed:
                yield pa.RecordBatch.from_arrays([*[rows.column(k).take(pa.array(first)) for k in kept], pa.array(counted), pa.array(cut)],
                                                 names=[*kept, "_counted", "_cut"])
                continue
            holds = pa.array(first[(counted == rows.column("_need").to_numpy()[first]) & ~cut])
            yield pa.RecordBatch.from_arrays([rows.column(k).take(holds) for k in kept], names=list(kept))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields if f.name in kept)
    return pairs.mapInArrow(each, schema + (", _counted bigint, _cut boolean" if summed else ""))


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _side_of(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _on_edge(ax, ay, bx, by, px, py):
    return ((_side_of(ax, ay, bx, by, px, py) == 0) & (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx))
            & (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by)))


def _tally(inner, local, m, n, anchored, bx, by, size) -> tuple[np.ndarray, np.ndarray]:
    """Row ``i`` has ``m[i]`` inner and ``n[i]`` local edges, one of each at least; all are paired in the order of the inner ones."""
    row = np.repeat(np.arange(len(m)), m)
    each = n[row]
    a = np.repeat(np.arange(len(row)), each)
    first = _starts(each)
    b = np.arange(len(a)) - np.repeat(first - _starts(n)[row], each)
    x1, y1, x2, y2 = local[b].T
    p1, q1, p2, q2 = inner[a].T
    left, low = bx * float(size), by * float(size)
    ax, ay = (left + ANCHOR_X * size)[row][a], (low + ANCHOR_Y * size)[row][a]
    counted = np.zeros(len(m), np.int64)
    with np.errstate(divide="ignore", invalid="ignore"):
        up = y1 + (ax - x1) * ((y2 - y1) / (x2 - x1))
        for px, py in ((p1, q1), ((p1 + p2) / 2, (q1 + q2) / 2)):
            across = x1 + (py - y1) * ((x2 - x1) / (y2 - y1))
            level = ((y1 > py) != (y2 > py)) & (across > np.minimum(ax, px)) & (across <= np.maximum(ax, px))
            upright = ((x1 > ax) != (x2 > ax)) & (up > np.minimum(ay, py)) & (up <= np.maximum(ay, py))
            odd = np.add.reduceat(level.astype(np.int64) + upright, first) % 2 == 1
            held = (anchored[row] != odd) | np.logical_or.reduceat(_on_edge(x1, y1, x2, y2, px, py), first)
            here = (np.floor(px[first] / size) == bx[row]) & (np.floor(py[first] / size) == by[row])
            counted += np.add.reduceat((held & here).astype(np.int64), _starts(m))
        # The corner of a local edge strictly inside the inner polygon, by even-odd over all inner edges.
        rising = q2 > q1
        ray = ((q1 > y1) != (q2 > y1)) & (rising == (_side_of(p1, q1, p2, q2, x1, y1) > 0))
    crossed = ((np.sign(_side_of(x1, y1, x2, y2, p1, q1)) * np.sign(_side_of(x1, y1, x2, y2, p2, q2)) < 0)
               & (np.sign(_side_of(p1, q1, p2, q2, x1, y1)) * np.sign(_side_of(p1, q1, p2, q2, x2, y2)) < 0))
    hits = np.bincount(b, ray, len(local)) % 2 == 1
    edge = np.bincount(b, _on_edge(p1, q1, p2, q2, x1, y1), len(local)) > 0
    cut = np.logical_or.reduceat(crossed, first[_starts(m)]) | np.logical_or.reduceat(hits & ~edge, _starts(n))
    return counted, cut


#: Bins along the side of a tile; a power of two, so that a row's tile is that of its bin.
TILE = 16
#: Tests of edges and bins at once, in a task.
AT_ONCE = 1_000_000


def _runs(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places ``starts[i]`` to ``starts[i] + n[i] - 1``."""
    return np.repeat(starts - _starts(n), n) + np.arange(n.sum())


def _flat(rows: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Edges ``(n, 4)`` of a column of flat coordinates and how many each row has."""
    column = rows.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, 4), n


def _squares(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and height of all bins of each row's range of bins (``(n, 2)`` each)."""
    wide, tall = (high - low + 1).T
    row = np.repeat(np.arange(len(low)), wide * tall)
    k = np.arange(len(row)) - np.repeat(_starts(wide * tall), wide * tall)
    return row, low[row, 0] + k % wide[row], low[row, 1] + k // wide[row]


class Tile:
    """The polygons of one tile as bins: those with edges, and those wholly inside."""

    def __init__(self, outer: pa.Table, at: tuple[int, int], size: float) -> None:
        self.outer, self.size, self.low = outer, size, np.array(at, np.int64) * TILE
        edges, n = _flat(outer, "_edges")
        owner = np.repeat(np.arange(len(n)), n)
        inside = self._anchors(edges, n, at, outer.column("_inside").to_numpy(zero_copy_only=False).astype(bool))
        reach = np.array([np.fmin(edges[:, :2], edges[:, 2:]) / size - 1e-6, np.fmax(edges[:, :2], edges[:, 2:]) / size + 1e-6])
        low, high = np.clip(np.floor(reach) - self.low, 0, TILE - 1).astype(np.int64)
        e, x, y = _squares(low, high)
        x1, y1, x2, y2 = edges[e].T
        middle = [(self.low[k] + v + 0.5) * size for k, v in ((0, x), (1, y))]
        near = np.abs(_side_of(x1, y1, x2, y2, *middle)) <= np.hypot(x2 - x1, y2 - y1) * size * 0.7072
        e, x, y = e[near], x[near], y[near]
        key = owner[e] * TILE * TILE + y * TILE + x
        order = np.argsort(key, kind="stable")
        self.local, key = edges[e[order]], key[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        self.begin = np.append(begin, len(key))
        p, cell = np.divmod(key[begin], TILE * TILE)
        flags = inside.reshape(len(n), TILE * TILE)
        anchored = flags[p, cell]
        flags[p, cell] = False
        whole = np.nonzero(flags)
        found = _faces(self.local, self.begin, anchored, *((self.low[k] + v) * float(size) for k, v in ((0, cell % TILE), (1, cell // TILE))), size) if len(p) else [
            np.zeros(0)] * 4 + [np.zeros(0, bool)] * 3
        # A bin that is wholly inside has an empty box on its far right.
        rest = [np.full(len(whole[0]), v) for v in (np.inf, np.nan, np.nan, np.nan, True, True, True)]
        cells = np.append(cell, whole[1])
        order = np.argsort(cells, kind="stable")
        self.entries = np.searchsorted(cells[order], np.arange(TILE * TILE + 1))
        self.polygon, self.edged = np.append(p, whole[0])[order], np.append(np.arange(len(p)), np.full(len(whole[0]), -1))[order]
        self.anchored = np.append(anchored, np.ones(len(whole[0]), bool))[order]
        self.faces = [np.append(f, r)[order] for f, r in zip(found, rest, strict=True)]

    def _anchors(self, edges: np.ndarray, n: np.ndarray, at: tuple[int, int], known: np.ndarray) -> np.ndarray:
        """Whether the anchors of all bins are in each polygon, by the way from the tile's anchor as in :func:`inside`: ``(polygons, TILE, TILE)``."""
        out = np.repeat(known, TILE * TILE).reshape(-1, TILE, TILE)
        ax, ay = ((at[k] + a) * (self.size * TILE) for k, a in ((0, ANCHOR_X), (1, ANCHOR_Y)))
        xs, ys = ((self.low[k] + np.arange(TILE) + a) * self.size for k, a in ((0, ANCHOR_X), (1, ANCHOR_Y)))
        some, begin = np.flatnonzero(n), _starts(n)
        cuts = np.searchsorted(np.cumsum(n[some]), np.arange(AT_ONCE // (TILE * TILE), n.sum(), AT_ONCE // (TILE * TILE)))
        for part in np.split(some, np.unique(cuts)):
            if not len(part):
                continue
            x1, y1, x2, y2 = edges[begin[part[0]]:begin[part[-1]] + n[part[-1]]].T[..., None]
            with np.errstate(divide="ignore", invalid="ignore"):
                across, up = x1 + (ys - y1) * ((x2 - x1) / (y2 - y1)), y1 + (ax - x1) * ((y2 - y1) / (x2 - x1))
            level = ((y1 > ys) != (y2 > ys))[..., None] & (across[..., None] > np.minimum(ax, xs)) & (across[..., None] <= np.maximum(ax, xs))
            upright = ((x1 > ax) != (x2 > ax)) & (up > np.minimum(ay, ys)) & (up <= np.maximum(ay, ys))
            out[part] ^= np.logical_xor.reduceat(level ^ upright[..., None], begin[part] - begin[part[0]], axis=0)
        return out

    def met(self, rows: pa.RecordBatch) -> Iterator[tuple]:
        """For inner polygons, in runs of bounded size: row, polygon, bin, place of the bin's edges, whether its anchor is inside, points of the row in the bin, and
        whether the bin is decided: 1 inside, 0 outside, 2 not. Rows of a pair follow one another."""
        edges, n = _flat(rows, "_edges")
        begin = _starts(n)
        box = [f.reduceat(f(edges[:, :2], edges[:, 2:]), begin, axis=0) for f in (np.fmin, np.fmax)]
        low, high = (np.clip(np.floor(v / self.size).astype(np.int64) - self.low, 0, TILE - 1) for v in box)
        row, x, y = _squares(low, high)
        cell = y * TILE + x
        met = self.entries[cell + 1] - self.entries[cell]
        points = np.concatenate([edges[:, :2], (edges[:, :2] + edges[:, 2:]) / 2])
        places = np.floor(points / self.size).astype(np.int64) - self.low
        owner = np.tile(np.repeat(np.arange(len(n)), n), 2)
        inner = ((places >= 0) & (places < TILE)).all(axis=1)
        at = owner[inner] * TILE * TILE + places[inner, 1] * TILE + places[inner, 0]
        at, counts = np.unique(at, return_counts=True)
        own = row * TILE * TILE + cell
        here = np.zeros(len(row), np.int64)
        if len(at):
            k = np.minimum(np.searchsorted(at, own), len(at) - 1)
            here = np.where(at[k] == own, counts[k], 0)
        first = np.searchsorted(row, np.arange(len(n) + 1))
        total = np.append(0, np.cumsum(met))
        step, to = 0, 0
        while step < len(n):  # whole rows, at least one
            to = max(step + 1, int(np.searchsorted(total[first], total[first[step]] + AT_ONCE, side="right")) - 1)
            s, e = first[step], first[to]
            i = np.repeat(np.arange(s, e), met[s:e])
            j = _runs(self.entries[cell[s:e]], met[s:e])
            step = to
            if not len(i):
                continue
            bx, by = ((self.low[k] + v[i]) * float(self.size) for k, v in ((0, x), (1, y)))
            x0, y0 = np.maximum(box[0][row[i], 0], bx), np.maximum(box[0][row[i], 1], by)
            x1, y1 = np.minimum(box[1][row[i], 0], bx + self.size), np.minimum(box[1][row[i], 1], by + self.size)
            ex0, ey0, ex1, ey1, below, right, above = (f[j] for f in self.faces)
            # No edge is between the box and that corner of the bin.
            state = np.where((x1 < ex0) | (y1 < ey0), below, np.where(x0 > ex1, right, np.where(y0 > ey1, above, 2)))
            order = np.lexsort((self.polygon[j], row[i]))
            i, j, state = i[order], j[order], state[order]
            yield row[i], self.polygon[j], x[i] + self.low[0], y[i] + self.low[1], self.edged[j], self.anchored[j], here[i], state

    def pairs(self, rows: pa.RecordBatch, own: Sequence[str], theirs: Sequence[str], near: bool, across: bool, number: int) -> Iterator[pa.RecordBatch]:
        """Batches of :func:`meet`."""
        edges, n = _flat(rows, "_edges")
        begin, names = _starts(n), [*own, *theirs]

        def kept(i: np.ndarray, p: np.ndarray) -> list[pa.Array]:
            return [*[rows.column(k).take(pa.array(i)) for k in own], *[self.outer.column(k).combine_chunks().take(pa.array(p)) for k in theirs]]

        for row, polygon, bx, by, edged, anchored, here, state in self.met(rows):
            new = np.append(True, (row[1:] != row[:-1]) | (polygon[1:] != polygon[:-1]))
            first, pair = np.flatnonzero(new), np.cumsum(new) - 1
            sure = np.add.reduceat(np.where(state == 1, here, 0), first)
            open_ = np.add.reduceat((state == 2).astype(np.int64), first)
            least = 2 * n[row[first]]
            if across:
                if not near:
                    at = first[sure > 0]
                    yield pa.RecordBatch.from_arrays([*kept(row[at], polygon[at]), pa.array(sure[sure > 0]), pa.array(np.zeros(len(at), bool))], names=[*names, "_counted", "_cut"])
                    continue
                ask = open_ > 0
            elif not near:
                at = first[(open_ == 0) & (sure == least)]
                yield pa.RecordBatch.from_arrays(kept(row[at], polygon[at]), names=names)
                continue
            else:  # those that may yet reach their number of points
                ask = (open_ > 0) & (sure + np.add.reduceat(np.where(state == 2, here, 0), first) >= least)
            at = np.flatnonzero(ask[pair] & (state == 2))
            work = np.cumsum(n[row[at]] * (self.begin[edged[at] + 1] - self.begin[edged[at]]))
            for some in np.split(at, np.unique(np.searchsorted(work, np.arange(AT_ONCE, work[-1], AT_ONCE)))) if len(at) else []:
                i, b, m = row[some], self.begin[edged[some]], self.begin[edged[some] + 1] - self.begin[edged[some]]
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, 4 * np.cumsum(c)), pa.int32()), pa.array(v.ravel()))
                         for c, v in ((n[i], edges[_runs(begin[i], n[i])]), (m, self.local[_runs(b, m)]))]
                yield pa.RecordBatch.from_arrays(
                    [*kept(i, polygon[some]), pa.array(number + pair[some]), pa.array((least - sure)[pair[some]]), pa.array(bx[some]), pa.array(by[some]), *lists, pa.array(anchored[some])],
                    names=[*names, *NEAR])
            number += len(first)


#: Columns of the ``near`` rows of :func:`meet`.
NEAR = ("_pair", "_need", *BIN, "_edges", "_local", "_inside")


def meet(rows: DataFrame, keys: Sequence[str], own: Sequence[str], theirs: Sequence[str], size: float, near: bool, across: bool) -> DataFrame:
    """Pairs of inner and outer polygons of the same tile, with columns ``own`` of the inner and ``theirs`` of the outer one. ``rows`` has both, sorted by
    ``keys`` (the tile first), the outer ones (``_outer``) of each first.

    Without ``near``: pairs that hold without looking at edges; with it: those that :func:`tally` must decide, one row per bin with edges
    near. ``across``: inner polygons reach into other tiles, and the points counted in this one are returned (``_counted, _cut``)."""
    names = [*own, *theirs]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in names)
    if near:
        schema += ", _pair bigint, _need bigint, _bx bigint, _by bigint, _edges array<double>, _local array<double>, _inside boolean"
    elif across:
        schema += ", _counted bigint, _cut boolean"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, tile, number = None, [], None, 0
        for b in batches:
            if not b.num_rows:
                continue
            codes = np.stack([b.column(k).to_numpy() for k in keys])
            outer = b.column("_outer").to_numpy(zero_copy_only=False).astype(bool)
            new = np.flatnonzero(np.append(True, (codes[:, 1:] != codes[:, :-1]).any(axis=0) | (outer[1:] != outer[:-1])))
            for s, e in itertools.pairwise([*new.tolist(), b.num_rows]):
                if (code := tuple(codes[:, s].tolist())) != here:
                    here, held, tile = code, [], None
                part = b.slice(s, e - s)
                if outer[s]:
                    held.append(part)
                elif held:
                    tile = tile or Tile(pa.Table.from_batches(held).combine_chunks(), code[:2], size)
                    yield from tile.pairs(part, own, theirs, near, across, number)
                    number += 1 << 32
    return rows.mapInArrow(each, schema)

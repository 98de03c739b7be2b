"""Numpy work on one patch or raster block inside a task: outlines and interiors of polygons, distances, components."""

from __future__ import annotations

import numpy as np

# ---- polygons in pixels -----------------------------------------------------------------------------------------


def _cross(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def touched_pixels(edges: np.ndarray, height: int, width: int, a: float, c: float, e: float, f: float) -> np.ndarray:
    """Pixels whose closed square an edge (``x1, y1, x2, y2``) meets; every edge looks only at the pixels along it."""
    mask = np.zeros((height, width), bool)
    for x1, y1, x2, y2 in edges:
        u1, u2, v1, v2 = (x1 - c) / a, (x2 - c) / a, (y1 - f) / e, (y2 - f) / e
        low, high = max(int(np.floor(min(u1, u2))) - 1, 0), min(int(np.floor(max(u1, u2))) + 1, width - 1)
        if low > high or max(v1, v2) < -1 or min(v1, v2) > height + 1:
            continue
        col = np.arange(low, high + 1)
        if abs(u2 - u1) < 1e-9:
            top, bottom = np.full(len(col), min(v1, v2)), np.full(len(col), max(v1, v2))
        else:
            slope = (v2 - v1) / (u2 - u1)
            ends = [v1 + (np.clip(k, min(u1, u2), max(u1, u2)) - u1) * slope for k in (col - 1e-6, col + 1 + 1e-6)]
            top, bottom = np.minimum(*ends), np.maximum(*ends)
        first = np.clip(np.floor(top).astype(np.int64) - 1, 0, height - 1)
        n = np.clip(np.floor(bottom).astype(np.int64) + 1, 0, height - 1) - first + 1
        cols = np.repeat(col, n)
        rows = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        xa, xb, ya, yb = c + cols * a, c + (cols + 1) * a, f + rows * e, f + (rows + 1) * e
        x0, x3, y0, y3 = np.minimum(xa, xb), np.maximum(xa, xb), np.minimum(ya, yb), np.maximum(ya, yb)
        sides = np.stack([_cross(x1, y1, x2, y2, x, y) for x, y in ((x0, y0), (x3, y0), (x3, y3), (x0, y3))])
        apart = (max(x1, x2) < x0) | (min(x1, x2) > x3) | (max(y1, y2) < y0) | (min(y1, y2) > y3)
        hit = ~apart & (sides.min(axis=0) <= 0) & (sides.max(axis=0) >= 0)
        mask[rows[hit], cols[hit]] = True
    return mask


def inside_pixels(xs: np.ndarray, ys: np.ndarray, edges: np.ndarray, inside: bool, ax: float, ay: float) -> np.ndarray:
    """Which of the points ``xs`` by ``ys`` (ascending) lie inside: parity of the edges crossed from the anchor ``ax, ay``, upright along the
    anchor's column and then level. ``inside`` is the anchor's own side."""
    x1, y1, x2, y2 = edges.T
    with np.errstate(divide="ignore", invalid="ignore"):
        up = (y1 + (ax - x1) * ((y2 - y1) / (x2 - x1)))[(x1 > ax) != (x2 > ax)]
        cross = x1 + (ys[:, None] - y1) * ((x2 - x1) / (y2 - y1))
    up = np.sort(up)
    upright = np.searchsorted(up, ys, side="right") - np.searchsorted(up, ay, side="right")
    row, edge = np.nonzero((y1 > ys[:, None]) != (y2 > ys[:, None]))
    at = cross[row, edge]
    toggles = np.zeros((len(ys), len(xs) + 1), np.int64)
    np.add.at(toggles, (row, np.searchsorted(xs, at, side="left")), 1)
    level = np.cumsum(toggles[:, :-1], axis=1) - np.bincount(row, weights=at <= ax, minlength=len(ys)).astype(np.int64)[:, None]
    return ((level + upright[:, None]) % 2 == 1) != inside


# ---- distances --------------------------------------------------------------------------------------------------

_FAR = 1 << 30


def squared_distances(mask: np.ndarray) -> np.ndarray:
    """Squared pixel distance to the nearest true pixel, exact: vertical distances first, then the lower envelope of one parabola per
    column, along all rows at once. ``_FAR`` or more without any true pixel."""
    height, width = mask.shape
    line = np.arange(height)[:, None]
    above = np.maximum.accumulate(np.where(mask, line, -_FAR), axis=0)
    below = np.minimum.accumulate(np.where(mask, line, _FAR)[::-1], axis=0)[::-1]
    near = np.minimum(line - above, below - line)
    f = np.where(near >= height, float(_FAR), near.astype(np.float64) ** 2)
    rows = np.arange(height)
    hull, top = np.zeros((height, width), np.int64), np.zeros(height, np.int64)
    start = np.full((height, width + 1), np.inf)
    start[:, 0] = -np.inf
    for q in range(1, width):
        active = rows
        while len(active):
            v = hull[active, top[active]]
            s = ((f[active, q] + q * q) - (f[active, v] + v * v)) / (2 * (q - v))
            pop = s <= start[active, top[active]]
            done, at = active[~pop], s[~pop]
            top[done] += 1
            hull[done, top[done]] = q
            start[done, top[done]] = at
            start[done, top[done] + 1] = np.inf
            active = active[pop]
            top[active] -= 1
    # Pixel q belongs to the last parabola that starts at or before it.
    place = np.minimum(np.ceil(np.where(np.arange(width) <= top[:, None], start[:, :width], np.inf)), width)
    place = np.maximum(place, 0).astype(np.int64)
    marks = np.zeros((height, width + 1), np.int64)
    np.add.at(marks, (np.repeat(rows, width), place.ravel()), 1)
    owner = hull[rows[:, None], np.cumsum(marks[:, :width], axis=1) - 1]
    return (np.arange(width) - owner) ** 2 + np.where(f >= _FAR, _FAR, f).astype(np.int64)[rows[:, None], owner]


# ---- components -------------------------------------------------------------------------------------------------


def components(mask: np.ndarray) -> np.ndarray:
    """Number of each pixel's 4-connected component: its first pixel in row order; -1 off the mask. Runs of pixels are joined by union-find."""
    height, width = mask.shape
    edge = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    end = np.nonzero(edge == -1)[1]
    out = np.full(height * width, -1, np.int64)
    if not len(row):
        return out.reshape(height, width)
    # Runs of a row and the next one overlap: for each run the first and last run below that it meets.
    key = row * (width + 1)
    first = np.searchsorted(key + end, key + width + 1 + begin, side="right")
    last = np.searchsorted(key + begin, key + width + 1 + end, side="left")
    n = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    root = np.arange(len(row))
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    size = end - begin
    pixel = np.repeat(row * width + begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    out[pixel] = np.repeat((row * width + begin)[root], size)
    return out.reshape(height, width)

"""Distance, overlap and union of many pairs of small polygons at once, for use inside Arrow functions.

Pairs with equal numbers of edges are rows of one array, so a pair costs some microseconds.
Where a question hangs on slivers thinner than a few grid steps, no answer is given here
and the exact arrangement decides.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from . import arrangement as plane

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers that the largest array of a block may hold.
BLOCK = 1 << 18
#: Pairs with more edges than this go one by one: their arrays have the square of it.
MOST_EDGES = 64
#: Grid steps below which a sliver is left to the exact arrangement.
SLIVER = 8


class Polygons:
    """Rings of an Arrow column as flat arrays: the points, and where rings and polygons begin among them."""

    def __init__(self, column: pa.Array):
        lists = column.values
        points = lists.values
        self.x, self.y = (points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
        self.rings = lists.offsets.to_numpy().astype(np.int64)
        self.polygons = column.offsets.to_numpy().astype(np.int64)
        self.null = column.is_null().to_numpy(zero_copy_only=False) if column.null_count else np.zeros(len(column), bool)
        first, last = self.rings[:-1], self.rings[1:] - 1
        some = last >= first
        closed = np.ones(len(first), bool)
        closed[some] = (self.x[first[some]] == self.x[last[some]]) & (self.y[first[some]] == self.y[last[some]])
        bad = np.append(0, np.cumsum(~closed))
        self.open = bad[self.polygons[1:]] > bad[self.polygons[:-1]]  # some ring does not end where it begins
        begins = np.ones(len(self.x), bool)  # points at which an edge begins
        begins[last[some]] = False
        self.edge = np.flatnonzero(begins)
        self.start = np.searchsorted(self.edge, self.rings[self.polygons])
        self.count = np.diff(self.start)
        ring_of = np.repeat(np.arange(len(first)), np.diff(self.rings))
        self.ring_of_edge = ring_of[self.edge - self.rings[0]] if len(first) else self.edge

    def edges(self, rows: np.ndarray, count: int) -> np.ndarray:
        """Edges (rows, count, 4) of polygons that have `count` at most; in the place of missing ones, their last point."""
        k = np.arange(count)
        last = self.count[rows][:, None] - 1
        at = self.edge[self.start[rows][:, None] + np.minimum(k, last)]
        begin = at + (k > last)
        return np.stack([self.x[begin], self.y[begin], self.x[at + 1], self.y[at + 1]], 2)

    def grid_edges(self, rows: np.ndarray, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges on the grid, in steps from an origin per row, with the inside on their left, and the place of their row in `rows`."""
        counts = self.count[rows]
        of = np.repeat(np.arange(len(rows)), counts)
        at = self.edge[np.repeat(self.start[rows] - (np.cumsum(counts) - counts), counts) + np.arange(len(of))]
        grid = lambda k: np.rint(np.stack([self.x[k], self.y[k]], 1) * plane.STEPS).astype(np.int64) - origin[of]
        e = np.hstack([grid(at), grid(at + 1)])
        # One closed ring each: turned by its area. Others one by one.
        one = (np.diff(self.polygons)[rows] == 1) & ~self.open[rows]
        local = e - e[np.searchsorted(of, of)][:, [0, 1, 0, 1]] if len(e) else e
        area = np.zeros(len(rows), np.int64)
        np.add.at(area, of, local[:, 0] * local[:, 3] - local[:, 2] * local[:, 1])
        e = np.where((area[of] < 0)[:, None], e[:, [2, 3, 0, 1]], e)
        kept = (one & (area != 0))[of] & ((e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3]))
        found, owners = [e[kept]], [of[kept]]
        for k in np.flatnonzero(~one & ~self.null[rows]).tolist():
            rings = self.one(int(rows[k]))
            if rings:
                x, y = (np.concatenate([r[i] for r in rings]) for i in (0, 1))
                more = plane.edges(plane.oriented(plane.on_grid(x, y, [len(r[0]) for r in rings], origin=tuple(origin[k]))))
                found.append(more)
                owners.append(np.full(len(more), k))
        return np.vstack(found), np.concatenate(owners)

    def one(self, row: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Coordinates of each ring."""
        return [(self.x[self.rings[r]:self.rings[r + 1]], self.y[self.rings[r]:self.rings[r + 1]])
                for r in range(self.polygons[row], self.polygons[row + 1])]


def groups(*counts: np.ndarray, size):
    """Row numbers with equal counts, in blocks whose arrays have `size(*counts)` numbers a row."""
    order = np.lexsort(counts)
    keys = np.stack([c[order] for c in counts], 1)
    new = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
    for rows in np.split(order, new) if len(order) else []:
        key = tuple(int(c[rows[0]]) for c in counts)
        step = max(1, BLOCK // max(1, size(*key)))
        for k in range(0, len(rows), step):
            yield key, rows[k:k + step]


def rounded(counts: np.ndarray) -> np.ndarray:
    """Numbers of edges that polygons of like size share."""
    step = 2 ** np.maximum(0, np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) - 2)
    return -(-counts // step) * step


def _sides(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The side of every edge of `p` on which the ends of every edge of `q` lie."""
    ax, ay, bx, by = (p[:, :, None, i] for i in range(4))
    cx, cy, dx, dy = (q[:, None, :, i] for i in range(4))
    wx, wy = bx - ax, by - ay
    return wx * (cy - ay) - (cx - ax) * wy, wx * (dy - ay) - (dx - ax) * wy


def to_edges(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Least distance of points (n, k) to edges (n, m, 4), over both; exactly 0 on an edge."""
    ax, ay, bx, by = (e[:, None, :, i] for i in range(4))
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    px, py = x[:, :, None] - ax, y[:, :, None] - ay
    along = px * dx + py * dy
    t = np.clip(along / np.where(length2 > 0, length2, 1.0), 0.0, 1.0)
    ex, ey = px - t * dx, py - t * dy
    on = (px * dy == py * dx) & (along >= 0) & (along <= length2) & (length2 > 0)
    return np.sqrt(np.where(on, 0.0, ex * ex + ey * ey).min((1, 2)))


def inside(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which points (n, k) lie inside the edges (n, m, 4): a line to the right meets an odd number."""
    ax, ay, bx, by = (e[:, None, :, i] for i in range(4))
    x, y = x[:, :, None], y[:, :, None]
    side = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
    hits = ((ay <= y) & (by > y) & (side > 0)) | ((by <= y) & (ay > y) & (side < 0))
    return hits.sum(2) % 2 == 1


def _begins(e: np.ndarray) -> np.ndarray:
    """Edges (n, m) that do not begin at the end of the one before."""
    first = np.ones(e.shape[:2], bool)
    first[:, 1:] = (e[:, 1:, :2] != e[:, :-1, 2:]).any(2)
    return first


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of polygons of edges (n, m, 4); 0 where they share a point."""
    (c, d), (a, b) = _sides(p, q), _sides(q, p)
    apart = ~((c * d < 0) & (a * b < 0).transpose(0, 2, 1)).any((1, 2))
    for one, other in ((p, q), (q, p)):
        begins = _begins(one)
        some = slice(None) if begins[:, 1:].any() else slice(1)  # one corner of every ring
        apart &= ~(inside(one[:, some, 0], one[:, some, 1], other) & begins[:, some]).any(1)
    found = np.minimum(to_edges(p[:, :, 0], p[:, :, 1], q), to_edges(q[:, :, 0], q[:, :, 1], p))
    return np.where(apart, found, 0.0)


def point_distances(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distance of a point (n) to the polygon of its row; 0 inside and on the edge."""
    x, y = x[:, None], y[:, None]
    return np.where(inside(x, y, e)[:, 0], 0.0, to_edges(x, y, e))


def slabs(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends (n, s) of the slabs between all corners and crossings of edges (n, m, 4), and which edges cross (n, m, m).

    Within a slab no edges cross. Rows with fewer slabs have some of width 0.
    """
    c, d = _sides(e, e)
    cross = (np.sign(c) * np.sign(d) < 0)
    cross &= cross.transpose(0, 2, 1)
    xs = e[:, :, 0].astype(np.float64)
    if cross.any():
        row, i, j = np.nonzero(np.triu(cross))
        t = c[row, i, j] / (c[row, i, j] - d[row, i, j]).astype(np.float64)
        at = e[row, j, 0] + t * (e[row, j, 2] - e[row, j, 0])
        place = np.arange(len(row)) - np.searchsorted(row, row)
        more = np.repeat(xs[:, :1], place.max() + 1, 1)
        more[row, place] = at
        xs = np.hstack([xs, more])
    xs = np.sort(xs, 1)
    wide = xs[:, 1:] > xs[:, :-1]
    kept = np.argsort(~wide, axis=1, kind="stable")[:, :max(1, int(wide.sum(1).max()))]
    return np.take_along_axis(xs[:, :-1], kept, 1), np.take_along_axis(xs[:, 1:], kept, 1), cross


def sections(e: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges in the order of their height in the middle of each slab (n, s, m): which, whether there, and heights at both ends."""
    mid = (lo + hi) / 2
    x0, y0, x1, y1 = (e[:, None, :, i].astype(np.float64) for i in range(4))
    there = (np.minimum(x0, x1) < mid[:, :, None]) & (np.maximum(x0, x1) > mid[:, :, None])
    slope = (y1 - y0) / np.where(x1 != x0, x1 - x0, 1.0)
    left, right = (np.where(there, y0 + (x[:, :, None] - x0) * slope, np.inf) for x in (lo, hi))
    middle = np.where(there, y0 + (mid[:, :, None] - x0) * slope, np.inf)
    order = np.argsort(middle, axis=2, kind="stable")
    take = lambda a: np.take_along_axis(a, order, 2)
    return order, take(there), take(left), take(right), take(middle)


def overlap_verdicts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 or 0 for shapes of whole-number edges (n, m, 4) that overlap or do not, -1 where slivers decide."""
    e = np.concatenate([a, b], 1)
    lo, hi, cross = slabs(e)
    first = np.arange(e.shape[1]) < a.shape[1]
    own = (cross & (first[:, None] == first[None, :])).any((1, 2))
    order, there, _, _, middle = sections(e, lo, hi)
    of_a = first[order]
    in_a, in_b = (np.cumsum(there & of, 2)[:, :, :-1] % 2 == 1 for of in (of_a, ~of_a))
    with np.errstate(invalid="ignore"):
        thick = np.where(there[:, :, 1:], middle[:, :, 1:] - middle[:, :, :-1], 0.0)
    width = (hi - lo)[:, :, None]
    clear, some = (thick > SLIVER) & (width > SLIVER), (thick > 0) & (width > 0)
    yes, no = np.ones(len(e), bool), np.zeros(len(e), bool)
    for kind in (in_a & in_b, in_a & ~in_b, in_b & ~in_a):
        yes &= (kind & clear).any((1, 2))
        no |= ~(kind & some).any((1, 2))
    return np.where(own, -1, np.where(yes, 1, np.where(no, 0, -1)))


def union_measures(e: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Area and centroid (n, 3) of the union of simple rings; `owner` names the ring of each edge."""
    origin = e[:, 0, :2]
    e = e - np.tile(origin, 2)[:, None, :]
    lo, hi, _ = slabs(e)
    order, there, left, right, _ = sections(e, lo, hi)
    covered = np.zeros(there.shape, bool)
    for ring in np.unique(owner):
        covered |= np.cumsum(there & (owner[order] == ring), 2) % 2 == 1
    before = np.zeros_like(covered)
    before[:, :, 1:] = covered[:, :, :-1]
    sign = np.where(there, before.astype(np.int8) - covered.astype(np.int8), 0)  # 1 at the upper end of a piece, -1 at its lower
    y0, y1 = np.where(there, left, 0.0), np.where(there, right, 0.0)
    w, low = (hi - lo), lo
    h0, h1 = (sign * y0).sum(2), (sign * y1).sum(2)
    area = (w * (h0 + h1) / 2).sum(1)
    mx = (w * (low * (h0 + h1) / 2 + w * (h0 + 2 * h1) / 6)).sum(1)
    my = (w * (sign * (y0 * y0 + y0 * y1 + y1 * y1)).sum(2) / 6).sum(1)
    some = np.where(area > 0, area, 1.0)
    out = np.stack([area, origin[:, 0] + mx / some, origin[:, 1] + my / some], 1)
    out[area <= 0, 0] = 0.0
    out[area <= 0, 1:] = origin[area <= 0]
    return out

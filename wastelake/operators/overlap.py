"""Distance and overlap of polygons on candidate pairs, as Arrow functions.

A pair costs corners times corners, too much for interpreted SQL lambdas.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from ..functions import arrangement as plane, pairs
from ..functions.geo import RINGS

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _steps(*extents: float) -> int:
    """Grid steps per metre: as many as usual, fewer for shapes too wide for exact side tests."""
    steps = plane.STEPS
    while max(extents) * steps > plane.WIDEST:
        steps //= 2
    return max(1, steps)


def _overlaps(*columns) -> bool | None:
    if any(c is None for c in columns):
        return None
    ax, ay, a_sizes, bx, by, b_sizes = [np.asarray(c, dtype="float64") for c in columns]
    if not len(ax) or not len(bx):
        return False
    if ax.max() <= bx.min() or bx.max() <= ax.min() or ay.max() <= by.min() or by.max() <= ay.min():
        return False
    x0, y0 = min(ax.min(), bx.min()), min(ay.min(), by.min())
    steps = _steps(max(ax.max(), bx.max()) - x0, max(ay.max(), by.max()) - y0)
    origin = (round(x0 * steps), round(y0 * steps))
    shapes = [plane.on_grid(x, y, n.astype(np.int64), steps, origin) for x, y, n in ((ax, ay, a_sizes), (bx, by, b_sizes))]
    return all(plane.regions(*shapes))


def _small(p: pairs.Polygons, q: pairs.Polygons) -> np.ndarray:
    """Rows whose polygons have edges, but few enough to go with others."""
    return ~(p.null | q.null) & (p.count > 0) & (q.count > 0) & (p.count + q.count <= pairs.MOST_EDGES)


def _overlap_batch(p: pairs.Polygons, q: pairs.Polygons) -> list:
    found: list = [None] * len(p.null)
    alone = ~(p.null | q.null)
    small = np.flatnonzero(_small(p, q) & ~p.open & ~q.open)
    for (m, n), at in pairs.groups(p.count[small], q.count[small], size=lambda m, n: (m + n) ** 2):
        rows = small[at]
        both = np.concatenate([p.edges(rows, m), q.edges(rows, n)], 1)
        corner = both[:, :, :2].min(1)
        fit = (both[:, :, :2].max(1) - corner).max(1) * plane.STEPS <= plane.WIDEST
        rows, corner = rows[fit], corner[fit]
        e = (np.rint(both[fit] * plane.STEPS) - np.tile(np.rint(corner * plane.STEPS), 2)[:, None, :]).astype(np.int64)
        if not len(rows):
            continue
        verdicts = pairs.overlap_verdicts(e[:, :m], e[:, m:])
        clear = verdicts >= 0
        alone[rows[clear]] = False
        for row, v in zip(rows[clear].tolist(), verdicts[clear].tolist()):
            found[row] = v == 1
    _overlap_exactly(p, q, np.flatnonzero(alone), found)
    return found


def _overlap_exactly(p: pairs.Polygons, q: pairs.Polygons, rows: np.ndarray, found: list) -> None:
    """By the arrangement of the edges, of many pairs at once; shapes too wide for the grid go one by one."""
    low, high = np.full((2, len(rows), 2), np.inf), np.full((2, len(rows), 2), -np.inf)
    for k, shape in enumerate((p, q)):
        counts = shape.count[rows]
        some = np.flatnonzero(counts > 0)
        for (m,), at in pairs.groups(pairs.rounded(counts[some]), size=lambda m: m):
            e = shape.edges(rows[some[at]], m)
            low[k, some[at]] = np.minimum(e[:, :, :2], e[:, :, 2:]).min(1)
            high[k, some[at]] = np.maximum(e[:, :, :2], e[:, :, 2:]).max(1)
    apart = (high[0] <= low[1]).any(1) | (high[1] <= low[0]).any(1)  # shapes without edges among them
    extent = np.where(apart[:, None], 0.0, np.maximum(high[0], high[1]) - np.minimum(low[0], low[1])).max(1)
    odd = p.open[rows] | q.open[rows] | (extent * plane.STEPS > plane.WIDEST)
    for row in rows[apart & ~odd].tolist():
        found[row] = False
    for row in rows[odd].tolist():
        flat = []
        for shape in (p, q):
            rings = shape.one(row)
            flat += [np.concatenate([r[i] for r in rings]) if rings else np.zeros(0) for i in (0, 1)] + [[len(r[0]) for r in rings]]
        found[row] = _overlaps(*flat)
    together = np.flatnonzero(~apart & ~odd)
    total = np.cumsum(p.count[rows[together]] + q.count[rows[together]])
    start = 0
    while start < len(together):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + plane.EDGES, side="right")))
        some = together[start:stop]
        origin = np.rint(np.minimum(low[0, some], low[1, some]) * plane.STEPS).astype(np.int64)
        (a, of_a), (b, of_b) = (shape.grid_edges(rows[some], origin) for shape in (p, q))
        verdicts = plane.regions_of(np.vstack([a, b]), np.concatenate([2 * of_a, 2 * of_b + 1]), len(some)).all(1)
        for row, verdict in zip(rows[some].tolist(), verdicts.tolist()):
            found[row] = verdict
        start = stop


@F.arrow_udf(BooleanType())
def _overlap_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(_overlap_batch(pairs.Polygons(a), pairs.Polygons(b)), pa.bool_())


def overlaps(a: str, b: str) -> Column:
    """Interiors meet and neither shape holds the other, for polygons of any form: concave,
    with holes or of several parts (rings read even-odd). NULL for a NULL polygon."""
    return _overlap_udf(F.expr(a).cast(RINGS), F.expr(b).cast(RINGS))


def _to_edges(x, y, ax, ay, bx, by):
    """Least distance of points to edges."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    px, py = x[:, None] - ax, y[:, None] - ay
    t = np.clip((px * dx + py * dy) / np.where(length2 > 0, length2, 1.0), 0.0, 1.0)
    ex, ey = px - t * dx, py - t * dy
    return float(np.sqrt((ex * ex + ey * ey).min()))


def _inside(x: float, y: float, ax, ay, bx, by) -> bool:
    side = (bx - ax) * (y - ay) - (x - ax) * (by - ay)
    hits = ((ay <= y) & (by > y) & (side > 0)) | ((by <= y) & (ay > y) & (side < 0))
    return bool(hits.sum() % 2)


def _begins(ax, ay, bx, by) -> list[tuple[float, float]]:
    """One corner of every ring: where an edge does not begin at the end of the one before."""
    first = np.append(True, (ax[1:] != bx[:-1]) | (ay[1:] != by[:-1]))
    return list(zip(ax[first], ay[first]))


def _crossing(p, q) -> bool:
    """Some edges share a point that is an end of neither; shared ends have distance 0 anyway."""
    def sides(a, b):
        ax, ay, bx, by = (c[:, None] for c in a)
        at = (bx - ax) * (b[1] - ay) - (b[0] - ax) * (by - ay)
        to = (bx - ax) * (b[3] - ay) - (b[2] - ax) * (by - ay)
        return at * to < 0
    return bool((sides(p, q) & sides(q, p).T).any())


def _distance(*columns) -> float | None:
    if any(c is None for c in columns):
        return None
    p, q = [[np.asarray(c, dtype="float64") for c in columns[i:i + 4]] for i in (0, 4)]
    if _crossing(p, q) or any(_inside(x, y, *b) for a, b in ((p, q), (q, p)) for x, y in _begins(*a)):
        return 0.0
    return min(_to_edges(p[0], p[1], *q), _to_edges(q[0], q[1], *p))


def _distance_batch(p: pairs.Polygons, q: pairs.Polygons) -> list:
    found = np.full(len(p.null), np.nan)
    known = ~(p.null | q.null)
    rows = np.flatnonzero(known & (p.count > 0) & (q.count > 0))
    found[rows] = distances_of(p, rows, q, rows)
    return [v if k else None for v, k in zip(found.tolist(), known.tolist())]


def distances_of(p: pairs.Polygons, rows: np.ndarray, q: pairs.Polygons, others: np.ndarray) -> np.ndarray:
    """Distances of polygons `rows` of `p` to polygons `others` of `q`; NaN without edges."""
    found = np.full(len(rows), np.nan)
    m, n = p.count[rows], q.count[others]
    some = (m > 0) & (n > 0)
    small = np.flatnonzero(some & (m * n <= pairs.BLOCK))
    for (i, j), at in pairs.groups(pairs.rounded(m[small]), pairs.rounded(n[small]), size=lambda i, j: i * j):
        found[small[at]] = pairs.distances(p.edges(rows[small[at]], i), q.edges(others[small[at]], j))
    for k in np.flatnonzero(some & (m * n > pairs.BLOCK)).tolist():
        found[k] = _distance(*p.edges(rows[k:k + 1], int(m[k]))[0].T, *q.edges(others[k:k + 1], int(n[k]))[0].T)
    return found


def point_distances_of(x: np.ndarray, y: np.ndarray, p: pairs.Polygons, rows: np.ndarray) -> np.ndarray:
    """Distances of points to polygons `rows` of `p`; NaN without edges."""
    found = np.full(len(rows), np.nan)
    some = np.flatnonzero(p.count[rows] > 0)
    for (m,), at in pairs.groups(pairs.rounded(p.count[rows[some]]), size=lambda m: m):
        k = some[at]
        found[k] = pairs.point_distances(x[k], y[k], p.edges(rows[k], m))
    return found


@F.arrow_udf(DoubleType())
def _distance_udf(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(_distance_batch(pairs.Polygons(a), pairs.Polygons(b)), pa.float64())


def polygon_distance(p: str, q: str) -> Column:
    """0 for polygons that share a point, else the least distance of a corner to an edge;
    NULL for a NULL polygon. Not for use in a join condition."""
    return _distance_udf(F.expr(p).cast(RINGS), F.expr(q).cast(RINGS))


def _point_distance_batch(x: np.ndarray, y: np.ndarray, p: pairs.Polygons) -> np.ndarray:
    """NaN without a point or edges. A row of many corners is a block of its own."""
    found = np.full(len(x), np.nan)
    some = np.flatnonzero(~p.null & (p.count > 0) & ~np.isnan(x) & ~np.isnan(y))
    for (m,), at in pairs.groups(pairs.rounded(p.count[some]), size=lambda m: m):
        rows = some[at]
        found[rows] = pairs.point_distances(x[rows], y[rows], p.edges(rows, m))
    return found


@F.arrow_udf(DoubleType())
def _point_distance_udf(x: pa.Array, y: pa.Array, rings: pa.Array) -> pa.Array:
    found = _point_distance_batch(*(c.to_numpy(zero_copy_only=False).astype(np.float64) for c in (x, y)), pairs.Polygons(rings))
    return pa.array(found, pa.float64(), from_pandas=True)


def point_distance(x: str, y: str, rings: str) -> Column:
    """`geo.point_polygon_distance` for many pairs: 0 inside and on the edge, NULL without a
    point or a polygon. Not for use in a join condition."""
    return _point_distance_udf(F.expr(x).cast("double"), F.expr(y).cast("double"), F.expr(rings).cast(RINGS))


def _measured_union(parts) -> tuple[float, float, float]:
    """Area and centroid of the union of simple rings, by slabs between all corners and crossings.

    Within a slab no edges cross, so the union's pieces are trapezoids between two edges.
    """
    x0, y0 = parts[0][0]["x"], parts[0][0]["y"]
    rings = [np.array([(p["x"] - x0, p["y"] - y0) for p in ring]) for ring in parts]
    rings = [np.vstack([r, r[:1]]) if (r[0] != r[-1]).any() else r for r in rings]
    a, b = np.vstack([r[:-1] for r in rings]), np.vstack([r[1:] for r in rings])
    owner = np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])
    d = b - a
    cross = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    gap = a[None, :] - a[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (gap[..., 0] * d[None, :, 1] - gap[..., 1] * d[None, :, 0]) / cross
        u = (gap[..., 0] * d[:, None, 1] - gap[..., 1] * d[:, None, 0]) / cross
    met = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
    first = np.nonzero(met)[0]
    crossings = a[first, 0] + t[met] * d[first, 0]
    xs = np.unique(np.concatenate([a[:, 0], crossings]))
    area = mx = my = 0.0
    for lo, hi in zip(xs[:-1], xs[1:]):
        mid = (lo + hi) / 2
        here = np.flatnonzero((np.minimum(a[:, 0], b[:, 0]) < mid) & (np.maximum(a[:, 0], b[:, 0]) > mid))
        slope = d[here, 1] / d[here, 0]
        at = lambda x: a[here, 1] + (x - a[here, 0]) * slope
        left, right, middle = at(lo), at(hi), at(mid)
        depth, inside = 0, {}
        for i in np.argsort(middle, kind="stable"):
            before = depth
            inside[owner[here[i]]] = not inside.get(owner[here[i]], False)
            depth = sum(inside.values())
            if before == 0 and depth:
                low = i
            elif before and depth == 0:
                w, p0, p1, q0, q1 = hi - lo, left[low], right[low], left[i], right[i]
                h0, h1 = q0 - p0, q1 - p1
                area += w * (h0 + h1) / 2
                mx += w * (lo * (h0 + h1) / 2 + w * (h0 + 2 * h1) / 6)
                my += w * (q0 * q0 + q0 * q1 + q1 * q1 - p0 * p0 - p0 * p1 - p1 * p1) / 6
    return (area, x0 + mx / area, y0 + my / area) if area > 0 else (0.0, x0, y0)


def _union_batch(p: pairs.Polygons) -> list:
    found: list = [(None, None, None)] * len(p.null)
    alone = ~p.null & (np.diff(p.polygons) > 0)
    small = np.flatnonzero(alone & ~p.open & (p.count > 0) & (p.count <= pairs.MOST_EDGES))
    layout: dict[bytes, int] = {}  # rows with the same edges per ring
    kinds = np.zeros(len(small), np.int64)
    for k, row in enumerate(small.tolist()):
        sizes = np.diff(p.rings[p.polygons[row]:p.polygons[row + 1] + 1]).tobytes()
        kinds[k] = layout.setdefault(sizes, len(layout))
    for (m, _), at in pairs.groups(p.count[small], kinds, size=lambda m, _: m * m):
        rows = small[at]
        owner = p.ring_of_edge[p.start[rows[0]]:p.start[rows[0]] + m]
        measured = pairs.union_measures(p.edges(rows, m), owner)
        for row, values in zip(rows.tolist(), measured.tolist()):
            found[row] = tuple(values)
    alone[small] = False
    for row in np.flatnonzero(alone).tolist():
        found[row] = _measured_union([[{"x": x, "y": y} for x, y in zip(*ring)] for ring in p.one(row)])
    return found


@F.arrow_udf(StructType([StructField(n, DoubleType()) for n in ("area", "cx", "cy")]))
def _union_udf(parts: pa.Array) -> pa.Array:
    columns = zip(*_union_batch(pairs.Polygons(parts))) if len(parts) else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(c, pa.float64()) for c in columns], ["area", "cx", "cy"])


def union_measure(parts: Column | str) -> Column:
    """`(area, cx, cy)` of the dissolved union of parts, one simple ring each; NULLs for no parts."""
    return _union_udf(F.col(parts).cast(RINGS) if isinstance(parts, str) else parts.cast(RINGS))

"""Planar arrangements of polygon edges on a whole-number grid, for use inside Arrow functions.

Coordinates are whole multiples of a power of two of a metre, taken from a near origin, so
every side test is exact in 64-bit integers. Edges run with the inside of their shape on
the left. Splitting them where they meet gives pieces that share nothing but ends; what
lies on both sides of a piece then follows from the pieces beside it.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Grid steps per metre. Where a crossing falls between grid points it moves to the nearest.
STEPS = 1 << 17
#: Largest extent, in steps, whose side tests fit 64 bits.
WIDEST = 1 << 28
BLOCK = 1 << 20
#: Parts that are united at once, and edges of several such unions in one array.
FAN, EDGES = 4, 1 << 14


def on_grid(xs, ys, sizes, steps: int = STEPS, origin: tuple[int, int] = (0, 0)) -> list[np.ndarray]:
    """Open rings on the grid from the coordinates of closed ones in a row and their sizes."""
    points = np.rint(np.stack([xs, ys], 1).astype(np.float64) * steps).astype(np.int64) - origin
    ends = np.cumsum(np.asarray(sizes, np.int64))
    rings = [points[e - n:e] for e, n in zip(ends, sizes)]
    return [r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r for r in rings]


def signed_area(ring: np.ndarray) -> int:
    """Twice the area of an open ring (n, 2), positive when it turns left."""
    x, y = (ring - ring[0]).T
    return int((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())


def oriented(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Open rings of an even-odd shape, turned so that its inside is on their left.

    A ring inside an odd number of others is the edge of a hole.
    """
    rings = [r for r in rings if len(r) > 2 and signed_area(r)]
    out = []
    for i, ring in enumerate(rings):
        depth = sum(_holds(other, ring) for j, other in enumerate(rings) if j != i) if len(rings) > 1 else 0
        out.append(ring if (signed_area(ring) > 0) == (depth % 2 == 0) else ring[::-1])
    return out


def _holds(ring: np.ndarray, other: np.ndarray) -> bool:
    """The other ring's first corner that is not on the ring is inside it."""
    a, b = ring, np.roll(ring, -1, axis=0)
    for x, y in other.tolist():
        side = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (x - a[:, 0]) * (b[:, 1] - a[:, 1])
        low, high = np.minimum(a, b), np.maximum(a, b)
        if ((side == 0) & (low[:, 0] <= x) & (x <= high[:, 0]) & (low[:, 1] <= y) & (y <= high[:, 1])).any():
            continue
        hits = ((a[:, 1] <= y) & (b[:, 1] > y) & (side > 0)) | ((b[:, 1] <= y) & (a[:, 1] > y) & (side < 0))
        return bool(hits.sum() % 2)
    return False


def edges(rings: list[np.ndarray]) -> np.ndarray:
    """Edges (n, 4) of open rings."""
    found = [np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings]
    e = np.vstack(found) if found else np.zeros((0, 4), np.int64)
    return e[(e[:, 0] != e[:, 2]) | (e[:, 1] != e[:, 3])]


def _near_pairs(e: np.ndarray, apart: np.ndarray | None = None):
    """Blocks of index pairs of edges whose boxes touch; of one number in `apart`, if given."""
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    shift = 0 if apart is None or not len(e) else apart * (int(high[:, 0].max()) - int(low[:, 0].min()) + 1)
    first, final = low[:, 0] + shift, high[:, 0] + shift
    order = np.argsort(first, kind="stable")
    low, high = low[order], high[order]
    last = np.searchsorted(first[order], final[order], side="right")
    counts = last - np.arange(len(e)) - 1
    start = 0
    total = np.cumsum(counts)
    while start < len(e):
        stop = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + BLOCK)))
        n = counts[start:stop]
        i = np.repeat(np.arange(start, stop), n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + i + 1
        near = (low[i, 1] <= high[j, 1]) & (low[j, 1] <= high[i, 1])
        if near.any():
            yield order[i[near]], order[j[near]]
        start = stop


def _side(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (x - a[:, 0]) * (b[:, 1] - a[:, 1])


def _meetings(e: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, bool]:
    """Edges to split and the points to split them at, and whether all of these lie on their edges exactly.

    An end within another edge splits it, also one whose square of a step the edge passes through: such edges
    are bent to it before they are cut at crossings. Else edges almost alike would go on crossing, a step further each round.
    """
    at, points, bent, crossings = [], [], np.zeros(len(e), bool), []
    for i, j in _near_pairs(e, apart):
        a, b, c, d = e[i, :2], e[i, 2:], e[j, :2], e[j, 2:]
        c_side, d_side, a_side, b_side = _side(a, b, *c.T), _side(a, b, *d.T), _side(c, d, *a.T), _side(c, d, *b.T)
        for owner, side, p, q, r in ((i, c_side, c, a, b), (i, d_side, d, a, b), (j, a_side, a, c, d), (j, b_side, b, c, d)):
            way = np.abs(r - q)
            on = np.flatnonzero(2 * np.abs(side) <= way.sum(1))
            p, q, r, flat = p[on], q[on], r[on], (way[on, 0] >= way[on, 1])
            p_, q_, r_ = (np.where(flat, v[:, 0], v[:, 1]) for v in (p, q, r))  # along the longer way
            within = (p_ > np.minimum(q_, r_)) & (p_ < np.maximum(q_, r_))
            at.append(owner[on[within]])
            points.append(p[within])
            bent[owner[on[within & (side[on] != 0)]]] = True
        cross = (np.sign(c_side) * np.sign(d_side) < 0) & (np.sign(a_side) * np.sign(b_side) < 0)
        if cross.any():
            crossings.append((i[cross], j[cross], c_side[cross] / (c_side[cross] - d_side[cross]).astype(np.float64)))
    exact = not bent.any()
    for i, j, t in crossings:
        free = ~(bent[i] | bent[j])
        i, j, t = i[free], j[free], t[free]
        p = np.rint(e[j, :2] + t[:, None] * (e[j, 2:] - e[j, :2])).astype(np.int64)
        exact = exact and not (_side(e[i, :2], e[i, 2:], *p.T).any() or _side(e[j, :2], e[j, 2:], *p.T).any())
        for owner in (i, j):
            ends = e[owner]
            new = (p != ends[:, :2]).any(1) & (p != ends[:, 2:]).any(1)
            at.append(owner[new])
            points.append(p[new])
    if not at:
        return np.zeros(0, np.int64), np.zeros((0, 2), np.int64), True
    return np.concatenate(at), np.vstack(points), exact


def split(e: np.ndarray, owner: np.ndarray, apart: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges cut wherever two of them meet, with the owner of each piece. With `apart`, only those of as many owners in a row meet."""
    while True:
        at, points, exact = _meetings(e, owner // apart if apart else None)
        if not len(at):
            return e, owner
        cut = np.unique(at)
        start, way = e[at, :2], e[at, 2:] - e[at, :2]
        along = ((points - start) * way).sum(1)
        length = (e[cut, 2:] - e[cut, :2])
        far = (length * length).sum(1)
        of = np.concatenate([cut, at, cut])
        corners = np.vstack([e[cut, :2], points, e[cut, 2:]])
        order = np.lexsort((np.concatenate([np.zeros(len(cut), np.int64) - 1, along, far + 1]), of))
        of, corners = of[order], corners[order]
        piece = (of[1:] == of[:-1]) & (corners[1:] != corners[:-1]).any(1)
        whole = np.ones(len(e), bool)
        whole[cut] = False
        parts = np.hstack([corners[:-1], corners[1:]])[piece]
        e, owner = np.vstack([e[whole], parts]), np.concatenate([owner[whole], owner[of[:-1][piece]]])
        if exact:  # pieces of the same lines meet nowhere else
            return e, owner


def sided(e: np.ndarray, owner: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pieces, and how often each owner covers their left and their right side.

    Pieces run from the lower end to the higher one, by x and then y.
    """
    flip = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    up = np.where(flip[:, None], e[:, [2, 3, 0, 1]], e)
    pieces, of = np.unique(up, axis=0, return_inverse=True)
    of = of.reshape(-1)
    net = np.zeros((len(pieces), owners), np.int64)  # left side less right side
    np.add.at(net, (of, owner), np.where(flip, -1, 1))
    upright = pieces[:, 0] == pieces[:, 2]
    right = np.zeros((len(pieces), owners), np.int64)
    # A ray from the middle of a piece leaves it on its right and meets the left sides of the pieces beyond;
    # what covers the right side is the sum of their changes, since nothing is covered far away.
    for vertical in (False, True):
        asked = np.flatnonzero(upright == vertical)
        x, y = (1, 0) if vertical else (0, 1)  # rays go to the right from upright pieces, down from the others
        start, end = 2 * pieces[:, [x, y]], 2 * pieces[:, [x + 2, y + 2]]
        turned = start[:, 0] > end[:, 0]
        start, end = np.where(turned[:, None], end, start), np.where(turned[:, None], start, end)
        weight = np.where(turned[:, None], -net, net)
        step = max(1, BLOCK // max(1, len(pieces)))
        for k in range(0, len(asked), step):
            some = asked[k:k + step]
            mx, my = (pieces[some, x] + pieces[some, x + 2])[:, None], (pieces[some, y] + pieces[some, y + 2])[:, None]
            side = (end[:, 0] - start[:, 0]) * (my - start[:, 1]) - (mx - start[:, 0]) * (end[:, 1] - start[:, 1])
            spans = (start[:, 0] <= mx) & (mx < end[:, 0])
            met = spans & ((side < 0) if vertical else (side > 0))
            right[some] = met.astype(np.int64) @ weight
    return pieces, right + net, right


def _depths(asked: np.ndarray, others: np.ndarray, net: np.ndarray, axis: int) -> np.ndarray:
    """How often the right side of pieces (g, n, 4) is covered, by rays across an axis over other pieces (g, m, 4)."""
    x, y = axis, 1 - axis
    turned = others[:, :, x] > others[:, :, x + 2]
    start, end = (np.where(turned[:, :, None], 2 * others[:, :, a:a + 2], 2 * others[:, :, b:b + 2]) for a, b in ((2, 0), (0, 2)))
    weight = np.where(turned, -net, net)[:, None, :]
    mx, my = ((asked[:, :, c] + asked[:, :, c + 2])[:, :, None] for c in (x, y))
    sx, sy, ex, ey = (a[:, None, :, c] for a in (start, end) for c in (x, y))
    side = (ex - sx) * (my - sy) - (mx - sx) * (ey - sy)
    met = (sx <= mx) & (mx < ex) & ((side < 0) if axis else (side > 0))
    return np.where(met, weight, 0).sum(2)


def _padded(rows: np.ndarray, group: np.ndarray, first: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (groups, most) of rows that are sorted by group, and which of them are rows."""
    counts = np.bincount(group[rows] - first, minlength=groups)
    begin = np.cumsum(counts) - counts
    at = np.arange(max(1, int(counts.max(initial=0))))
    there = at < counts[:, None]
    return rows[np.minimum(begin[:, None] + at, max(0, len(rows) - 1))] if len(rows) else np.zeros(there.shape, np.int64), there


def _covered(up: np.ndarray, net: np.ndarray, group: np.ndarray) -> np.ndarray:
    """How often the right sides of pieces are covered by the owners of their group; `net` (n, owners) is what their left sides have more.

    Pieces run up and are sorted by group.
    """
    right = np.zeros(net.shape, np.int64)
    counts = np.bincount(group - group[0])
    sizes = counts[counts > 0]
    code = np.repeat(np.arange(len(sizes)), sizes)
    upright, flat = up[:, 0] == up[:, 2], up[:, 1] == up[:, 3]
    by_size = np.argsort(sizes, kind="stable")
    rank = np.empty(len(sizes), np.int64)
    rank[by_size] = np.arange(len(sizes))
    place = np.argsort(rank[code], kind="stable")  # pieces by the size of their group
    bounds = np.append(0, np.cumsum(sizes[by_size]))
    group_of = rank[code]
    k = 0
    while k < len(sizes):
        # Groups of like size, so that arrays of equal length waste little.
        most = int(np.searchsorted(sizes[by_size], max(8, 2 * int(sizes[by_size[k]])), side="right"))
        stop = min(most, k + max(1, BLOCK // int(sizes[by_size[most - 1]]) ** 2))
        rows = place[bounds[k]:bounds[stop]]
        for axis, asks, meets in ((0, ~upright, ~upright), (1, upright, ~flat)):
            asked = rows[asks[rows]]
            if not len(asked):
                continue
            at, there = _padded(asked, group_of, k, stop - k)
            others, known = _padded(rows[meets[rows]], group_of, k, stop - k)
            step = max(1, BLOCK // (at.shape[0] * others.shape[1]))  # all at once, but of a large group
            for i in range(0, at.shape[1], step):
                some, here = at[:, i:i + step], there[:, i:i + step]
                for o in range(net.shape[1]):
                    weight = np.where(known, net[others, o], 0)
                    right[some[here], o] = _depths(up[some], up[others], weight, axis)[here]
        k = stop
    return right


def boundaries(e: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`boundary` of many groups of edges at once: edges of the unions, and their groups in rising order."""
    if not len(e):
        return e, group
    e, group = split(e, group, 1)
    flip = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    up = np.where(flip[:, None], e[:, [2, 3, 0, 1]], e)
    order = np.lexsort((up[:, 3], up[:, 2], up[:, 1], up[:, 0], group))
    up, group = up[order], group[order]
    new = np.append(True, (group[1:] != group[:-1]) | (up[1:] != up[:-1]).any(1))
    net = np.add.reduceat(np.where(flip[order], -1, 1), np.flatnonzero(new))  # left side less right side
    up, group = up[new][net != 0], group[new][net != 0]  # others have the same on both sides
    net = net[net != 0]
    if not len(up):
        return up, group
    right = _covered(up, net[:, None], group)[:, 0]
    left = right + net
    keep = (left > 0) != (right > 0)
    return np.where((left > 0)[keep][:, None], up[keep], up[keep][:, [2, 3, 0, 1]]), group[keep]


def unions(e: np.ndarray, part: np.ndarray, group: np.ndarray, order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Boundaries of the unions of the parts of each group: few neighbours at a time, then few of their unions.

    `part` numbers the parts of all edges, with the parts of a group next to each other, and `group` has the group of each part.
    What is covered is gone after the first rounds, so the work does not grow with the square of the parts.
    """
    first = np.append(True, group[1:] != group[:-1]) if len(group) else np.zeros(0, bool)
    begin = np.flatnonzero(first)
    code = np.cumsum(first) - 1
    rank = np.arange(len(group)) - begin[code]
    owner, rank = code[part], rank[part]
    while True:
        rank = rank // FAN
        width = int(rank.max(initial=0)) + 1
        bucket = owner * width + rank
        rows = np.argsort(bucket, kind="stable")
        e, bucket = e[rows], bucket[rows]
        found, of = [], []
        start = 0
        while start < len(e):
            stop = min(len(e), start + EDGES)
            stop = int(np.searchsorted(bucket, bucket[stop - 1], side="right"))
            some, named = boundaries(e[start:stop], bucket[start:stop] - bucket[start])
            found.append(some)
            of.append(named + bucket[start])
            start = stop
        e = np.vstack(found) if found else e
        bucket = np.concatenate(of) if of else bucket
        owner, rank = bucket // width, bucket % width
        if width == 1:
            return e, group[begin[owner]] if len(owner) else owner


def boundary(e: np.ndarray) -> np.ndarray:
    """Edges of the union of all shapes whose edges are given, its inside on their left."""
    if not len(e):
        return e
    e, owner = split(e, np.zeros(len(e), np.int64))
    pieces, left, right = sided(e, owner, 1)
    inside_left, inside_right = left[:, 0] > 0, right[:, 0] > 0
    keep = inside_left != inside_right
    return np.where(inside_left[keep][:, None], pieces[keep], pieces[keep][:, [2, 3, 0, 1]])


def chains(e: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Closed rings and open chains that directed edges form, straight corners left out.

    Where several edges leave a point, the one furthest to the left is taken, which keeps
    to the inside.
    """
    points, ids = np.unique(np.vstack([e[:, :2], e[:, 2:]]), axis=0, return_inverse=True)
    ids = ids.reshape(-1)
    leaving: dict[int, list[int]] = {}
    arriving = np.bincount(ids[len(e):], minlength=len(points))
    starts, ends = ids[:len(e)].tolist(), ids[len(e):].tolist()
    for k, s in enumerate(starts):
        leaving.setdefault(s, []).append(k)
    angle = np.arctan2((e[:, 3] - e[:, 1]).astype(float), (e[:, 2] - e[:, 0]).astype(float)).tolist()
    used = [False] * len(e)

    def walk(k: int) -> list[int]:
        path = [starts[k]]
        while True:
            used[k] = True
            path.append(ends[k])
            if ends[k] == path[0]:
                return path
            open_ = [n for n in leaving.get(ends[k], ()) if not used[n]]
            if not open_:
                return path
            k = open_[0] if len(open_) == 1 else max(open_, key=lambda n: (angle[n] - angle[k] + np.pi) % (2 * np.pi))

    rings, lines = [], []
    surplus = [s for s, out in leaving.items() if len(out) > arriving[s]]
    for s in surplus:  # open chains begin where more edges leave than arrive
        for k in leaving[s][:len(leaving[s]) - int(arriving[s])]:
            if not used[k]:
                path = walk(k)
                (rings if path[0] == path[-1] and len(path) > 3 else lines).append(points[path])
    for k in range(len(e)):
        if not used[k]:
            path = walk(k)
            (rings if path[0] == path[-1] else lines).append(points[path])
    return [straightened(r[:-1], True) for r in rings], [straightened(c, False) for c in lines]


def straightened(corners: np.ndarray, closed: bool) -> np.ndarray:
    """Corners without those that lie on the line between their neighbours."""
    before, after = np.roll(corners, 1, axis=0), np.roll(corners, -1, axis=0)
    turn = (corners[:, 0] - before[:, 0]) * (after[:, 1] - corners[:, 1]) - (corners[:, 1] - before[:, 1]) * (after[:, 0] - corners[:, 0])
    keep = turn != 0
    if not closed:
        keep[0] = keep[-1] = True
    return corners[keep]


def stitched(lines: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Closed rings and longer chains that open chains form end to end; as `chains`, by their first and last edges."""
    heads = np.array([np.append(c[0], c[1]) for c in lines])
    tails = np.array([np.append(c[-2], c[-1]) for c in lines])
    angle = lambda e: np.arctan2((e[:, 3] - e[:, 1]).astype(float), (e[:, 2] - e[:, 0]).astype(float)).tolist()
    out_angle, in_angle = angle(heads), angle(tails)
    starts, ends = [tuple(c) for c in heads[:, :2].tolist()], [tuple(c) for c in tails[:, 2:].tolist()]
    leaving: dict[tuple, list[int]] = {}
    arriving: dict[tuple, int] = {}
    for k, (s, e) in enumerate(zip(starts, ends)):
        leaving.setdefault(s, []).append(k)
        arriving[e] = arriving.get(e, 0) + 1
    used = [False] * len(lines)
    rings, open_lines = [], []

    def walk(k: int) -> None:
        first, path = starts[k], [lines[k]]
        while True:
            used[k] = True
            if ends[k] == first:
                rings.append(straightened(np.vstack([c[:-1] for c in path]), True))
                return
            after = [n for n in leaving.get(ends[k], ()) if not used[n]]
            if not after:
                open_lines.append(straightened(np.vstack([*(c[:-1] for c in path), path[-1][-1:]]), False))
                return
            k = max(after, key=lambda n: (out_angle[n] - in_angle[k] + np.pi) % (2 * np.pi))
            path.append(lines[k])

    for s, out in leaving.items():
        for k in out[:max(0, len(out) - arriving.get(s, 0))]:
            if not used[k]:
                walk(k)
    for k in range(len(lines)):
        if not used[k]:
            walk(k)
    return rings, open_lines


def left_over(spans: np.ndarray) -> np.ndarray:
    """What is left of directed spans (from, to) of one line when those of opposite direction cancel."""
    marks = np.unique(spans)
    net = np.zeros(len(marks), np.int64)
    low, high = np.searchsorted(marks, spans.min(1)), np.searchsorted(marks, spans.max(1))
    sign = np.where(spans[:, 1] > spans[:, 0], 1, -1)
    np.add.at(net, low, sign)
    np.add.at(net, high, -sign)
    depth = np.cumsum(net)[:-1]
    found = [(marks[k], marks[k + 1]) if depth[k] > 0 else (marks[k + 1], marks[k]) for k in np.flatnonzero(depth)]
    return np.array(found, np.int64).reshape(-1, 2)


def regions(first: list[np.ndarray], second: list[np.ndarray]) -> tuple[bool, bool, bool]:
    """Whether two even-odd shapes have area in common, only in the first, and only in the second."""
    a, b = edges(oriented(first)), edges(oriented(second))
    if not len(a) or not len(b):
        return False, bool(len(a)), bool(len(b))
    e, owner = split(np.vstack([a, b]), np.repeat([0, 1], [len(a), len(b)]))
    _, left, right = sided(e, owner, 2)
    inside = np.vstack([left, right]) > 0  # every region lies beside some piece
    one, two = inside[:, 0], inside[:, 1]
    return bool((one & two).any()), bool((one & ~two).any()), bool((~one & two).any())


def regions_of(e: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """`regions` of many pairs at once (count, 3), of oriented edges; `owner` is twice the pair, and one more for the second shape."""
    out = np.zeros((count, 3), bool)
    has = np.bincount(owner, minlength=2 * count).reshape(count, 2) > 0
    out[:, 1:] = has & ~has.all(1)[:, None]
    met = has.all(1)[owner // 2]
    e, owner = split(e[met], owner[met], 2)
    if not len(e):
        return out
    pair = owner // 2
    flip = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    up = np.where(flip[:, None], e[:, [2, 3, 0, 1]], e)
    order = np.lexsort((up[:, 3], up[:, 2], up[:, 1], up[:, 0], pair))
    up, pair, sign, which = up[order], pair[order], np.where(flip[order], -1, 1), owner[order] % 2
    first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (up[1:] != up[:-1]).any(1)))
    net = np.stack([np.add.reduceat(np.where(which == o, sign, 0), first) for o in (0, 1)], 1)
    up, pair = up[first], pair[first]
    right = _covered(up, net, pair)
    for inside in (right + net > 0, right > 0):  # every region lies beside some piece
        one, two = inside.T
        for column, kind in enumerate((one & two, one & ~two, two & ~one)):
            out[pair[kind], column] = True
    return out


def clipped(ring: np.ndarray, axis: int, low: int, high: int) -> np.ndarray:
    """The part of an open ring between two lines across an axis; corners on the lines stay."""
    for line, sign in ((low, 1), (high, -1)):
        if not len(ring):
            break
        depth = sign * (ring[:, axis] - line)
        if (depth >= 0).all():
            continue
        out = []
        points, depths = ring.tolist(), depth.tolist()
        for k, (p, d) in enumerate(zip(points, depths)):
            q, f = points[k - 1], depths[k - 1]
            if (d > 0 and f < 0) or (d < 0 and f > 0):
                lower, upper = sorted((p, q))  # the same point whichever way the edge runs
                way = upper[axis] - lower[axis]
                crossing = lower[1 - axis] + round((line - lower[axis]) * (upper[1 - axis] - lower[1 - axis]) / way)
                out.append([line, crossing] if axis == 0 else [crossing, line])
            if d >= 0:
                out.append(p)
        ring = np.array(out, np.int64).reshape(-1, 2)
    return ring


def on_lines(ring: np.ndarray, size: int) -> np.ndarray:
    """The open ring with a corner wherever it crosses a line of the grid of that cell size."""
    out = []
    points = ring.tolist()
    for p, q in zip(points, points[1:] + points[:1]):
        lower, upper = sorted((p, q))
        found = set()
        for axis in (0, 1):
            way = upper[axis] - lower[axis]
            if not way:
                continue
            lo, hi = sorted((lower[axis], upper[axis]))
            for line in range((lo // size + 1) * size, hi, size):
                crossing = lower[1 - axis] + round((line - lower[axis]) * (upper[1 - axis] - lower[1 - axis]) / way)
                found.add((line, crossing) if axis == 0 else (crossing, line))
        along = sorted(found, key=lambda c: (c[0] - p[0]) * (q[0] - p[0]) + (c[1] - p[1]) * (q[1] - p[1]))
        out.append(p)
        out += [list(c) for c in along if list(c) != p and list(c) != q]
    return np.array(out, np.int64).reshape(-1, 2)


def in_cells(ring: np.ndarray, size: int):
    """The parts of an open ring in the cells of a grid, as (cell x, cell y, ring)."""
    low, high = ring.min(0), ring.max(0)
    if (low // size == (high - 1) // size).all():
        yield int(low[0] // size), int(low[1] // size), ring
        return
    ring = on_lines(ring, size)
    for cx in range(int(low[0] // size), int(-(-high[0] // size))):
        column = clipped(ring, 0, cx * size, (cx + 1) * size)
        if len(column) < 3:
            continue
        bottom, top = column[:, 1].min(), column[:, 1].max()
        for cy in range(int(bottom // size), int(-(-top // size))):
            part = clipped(column, 1, cy * size, (cy + 1) * size)
            if len(part) > 2 and signed_area(part):
                yield cx, cy, part

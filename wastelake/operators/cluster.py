"""Clusters of points that lie within a reach of each other, and their hulls.

Points are put in cells whose diagonal is the reach, so all points of a cell belong
together and no pair within a cell is ever built. Whether two cells up to two steps apart
have points within the reach follows from boxes: of the cells' places first, then of 4 × 4
parts of the cells that leave it open, and so on. The components are those of the cells.
"""

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import cut
from .groups import parts_of
from .skew import salted_join

#: Corners of one key that a task may list, and corners of all keys that a task may hold before it passes them on.
LISTED, HELD = 20_000, 200_000
_WAYS = np.stack([np.cos(np.arange(16) * math.pi / 8), np.sin(np.arange(16) * math.pi / 8)])

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _cell_id(cx: Column, cy: Column) -> Column:
    return F.shiftleft(cx, 32) + cy + F.lit(2 ** 31)


#: Neighbours of a cell, one of each two opposite ones.
AHEAD = [(1, dy) for dy in (-2, -1, 0, 1, 2)] + [(2, dy) for dy in (-1, 0, 1)] + [(0, 1), (0, 2)]
#: A part's side is that of its cell over 2 ** FINER.
FINER = 2
BOX = ["minx", "miny", "maxx", "maxy"]


def _boxes(spots: DataFrame, side: float) -> DataFrame:
    """The box of the places in each cell of a side."""
    placed = spots.withColumns({"cx": F.floor(F.col("x") / side).cast("bigint"), "cy": F.floor(F.col("y") / side).cast("bigint")})
    return placed.groupBy("cx", "cy").agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))


def _as(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns})


def _undecided(pairs: DataFrame, reach: float) -> DataFrame:
    """Pairs of parts whose boxes may hold points within `reach`; `sure` where all of their points are."""
    square = lambda dx, dy: f"({dx}) * ({dx}) + ({dy}) * ({dy})"
    least = square("greatest(a_minx - b_maxx, b_minx - a_maxx, 0D)", "greatest(a_miny - b_maxy, b_miny - a_maxy, 0D)")
    most = square("greatest(a_maxx - b_minx, b_maxx - a_minx)", "greatest(a_maxy - b_miny, b_maxy - a_miny)")
    limit = F.lit(reach * reach)
    return pairs.filter(F.expr(least) <= limit).withColumn("sure", F.expr(most) <= limit)


def _linked_cells(spots: DataFrame, reach: float) -> DataFrame:
    """Pairs (u > v) of neighbouring cells with points within `reach`.

    A round tests the boxes of two parts: too far apart, all within reach, or open. A pair of cells
    is settled by any two parts within reach; else its open parts are split. Parts of one place each leave
    nothing open, and only parts on the sides that face each other stay open, so the pairs of a
    round grow with the points and not with their square.
    """
    side = reach / math.sqrt(2.0)
    cells = _boxes(spots, side)
    ahead = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in AHEAD])
    asked = _as(cells, "a_").withColumn("o", F.explode(ahead))
    beside = (F.col("b_cx") == F.col("a_cx") + F.col("o.dx")) & (F.col("b_cy") == F.col("a_cy") + F.col("o.dy"))
    pairs = asked.join(_as(cells, "b_"), beside).withColumns({
        "u": _cell_id(F.col("b_cx"), F.col("b_cy")), "v": _cell_id(F.col("a_cx"), F.col("a_cy"))})
    linked, at = None, ["a_cx", "a_cy", "b_cx", "b_cy"]
    while True:
        pairs = cut(_undecided(pairs, reach).select("u", "v", *at, "sure"))
        settled = pairs.filter("sure").select("u", "v").distinct()
        linked = settled if linked is None else linked.unionByName(settled)
        open_ = cut(pairs.filter("not sure").join(settled, ["u", "v"], "left_anti").drop("sure"))
        if open_.isEmpty():
            return linked.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        parts = open_.select(F.col("a_cx").alias("cx"), F.col("a_cy").alias("cy")).union(open_.select("b_cx", "b_cy")).distinct()
        placed = spots.withColumns({"cx": F.floor(F.col("x") / side).cast("bigint"), "cy": F.floor(F.col("y") / side).cast("bigint")})
        spots = cut(salted_join(placed, parts, ["cx", "cy"], "left_semi").select("x", "y"))
        side = side / 2 ** FINER
        finer = _boxes(spots, side)
        of = lambda prefix: _as(finer, "n_").withColumnsRenamed({f"n_{c}": f"{prefix}{c}" for c in BOX}).withColumns({
            f"{prefix}cx": F.shiftright("n_cx", FINER), f"{prefix}cy": F.shiftright("n_cy", FINER)}).withColumnsRenamed(
            {"n_cx": f"{prefix}ncx", "n_cy": f"{prefix}ncy"})
        split = open_.join(of("a_"), ["a_cx", "a_cy"]).join(of("b_"), ["b_cx", "b_cy"])
        pairs = split.drop(*at).withColumnsRenamed({f"{p}n{c}": f"{p}{c}" for p in ("a_", "b_") for c in ("cx", "cy")})


def components(pairs: DataFrame) -> DataFrame:
    """`(node, root)` of the nodes in `pairs` (u, v); the root is the lowest node.

    Alternating large-star and small-star steps: every round hangs nodes under lower
    neighbours until each hangs under its root. A round is materialised, and the driver
    sees two numbers of it.
    """
    links = cut(pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:  # every round but the last brings some node nearer to its root
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = lower.select("u", F.col("m").alias("v"))
        links = cut(small.unionByName(own).filter("u <> v").distinct())


def clusters(points: DataFrame, reach: float) -> DataFrame:
    """Points (id, x, y) with the lowest point id of their cluster as `cluster`.

    Two points belong together when they are at most `reach` apart, or linked by a chain
    of such points.
    """
    side = reach / math.sqrt(2.0)
    placed = cut(points.filter("x is not null and y is not null").select(
        "id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).withColumns({
            "cx": F.floor(F.col("x") / side).cast("bigint"), "cy": F.floor(F.col("y") / side).cast("bigint")}))
    roots = components(_linked_cells(placed.select("x", "y"), reach))
    lows = placed.groupBy(_cell_id(F.col("cx"), F.col("cy")).alias("node")).agg(F.min("id").alias("low"))
    rooted = lows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("low").alias("cluster"))
    per_cell = rooted.select("node", "root").join(names, "root").select("node", "cluster")
    return (
        placed.withColumn("node", _cell_id(F.col("cx"), F.col("cy"))).join(per_cell, "node")
        .select("id", "x", "y", "cluster")
    )


def _hull(points: np.ndarray) -> np.ndarray:
    """Convex hull (n, 2), anticlockwise from the lowest x, without the closing point."""
    points = np.unique(points, axis=0)
    if len(points) < 3:
        return points
    # Nothing inside the polygon of the outermost points in some directions is a corner.
    far = points[np.unique(np.argmax(points @ _WAYS, axis=0))]
    if len(points) > 64 and len(far) > 2:
        centre = far.mean(axis=0)
        far = far[np.argsort(np.arctan2(*(far - centre).T[::-1]))]
        after = np.roll(far, -1, axis=0)
        side = np.stack([(b[0] - a[0]) * (points[:, 1] - a[1]) - (points[:, 0] - a[0]) * (b[1] - a[1]) for a, b in zip(far, after)])
        points = points[(side <= 0).any(axis=0)]

    def half(run) -> list[tuple[float, float]]:
        out: list[tuple[float, float]] = []
        for p in run:
            while len(out) > 1 and ((out[-1][0] - out[-2][0]) * (p[1] - out[-2][1])
                                    - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0])) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]
    ordered = [tuple(p) for p in points.tolist()]
    return np.array(half(ordered) + half(ordered[::-1]))


def _corners(points: DataFrame, key: str) -> DataFrame:
    """The corners of the hulls of what each task reads, key by key: the map side of the aggregate."""
    def run(batches):
        held: dict[object, list[np.ndarray]] = {}
        since = 0

        def reduced() -> None:
            for k, parts in held.items():
                if len(parts) > 1:
                    held[k] = [_hull(np.vstack(parts))]

        def out() -> pa.RecordBatch:
            reduced()
            hulls_ = [p[0] for p in held.values()]
            owner = np.repeat(np.arange(len(hulls_)), [len(h) for h in hulls_])
            flat = np.vstack(hulls_) if hulls_ else np.zeros((0, 2))
            made = pa.RecordBatch.from_arrays([pa.array(list(held), kind).take(pa.array(owner)), pa.array(flat[:, 0]), pa.array(flat[:, 1])], [key, "x", "y"])
            held.clear()
            return made

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            keys = batch.column(0).dictionary_encode()
            codes = keys.indices.fill_null(len(keys.dictionary)).to_numpy(zero_copy_only=False)
            xy = np.stack([batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)], 1)
            order = np.argsort(codes, kind="stable")
            names = [*keys.dictionary.to_pylist(), None]
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            for rows in np.split(order, cuts):
                if len(rows):
                    held.setdefault(names[codes[rows[0]]], []).append(_hull(xy[rows]))
            since += len(order)
            if since >= HELD:
                since = 0
                reduced()
                if sum(len(p[0]) for p in held.values()) >= HELD:
                    yield out()
        if held:
            yield out()

    kind = points.schema[key].dataType.simpleString()
    return points.select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).filter(
        "x is not null and y is not null").mapInArrow(run, f"`{key}` {kind}, x double, y double")


def hulls(points: DataFrame, key: str, radius: float | None = None) -> DataFrame:
    """`(key, rings)`: convex hull of the points (x, y) of each key, of circles around
    them when `radius` is given.

    A key may own any number of points. Tasks reduce what they read to the corners of hulls before the
    shuffle; while a key has more than LISTED corners they are dealt to groups that are reduced again,
    as the hull of hulls is that of all points. No task lists more than LISTED places but for the spread
    of a hash.
    """
    corners = cut(_corners(points, key))
    kind = corners.schema[key].dataType.simpleString()
    while True:
        crowds = cut(corners.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > LISTED))
        if crowds.isEmpty():
            break
        named = crowds.select(F.col(key).alias("_key"), "_n")
        dealt = corners.join(named, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
            "_salt", F.when(F.col("_n").isNotNull(), F.pmod(F.xxhash64("x", "y"), F.ceil(F.col("_n") * 2 / LISTED))))

        def reduce(table: pa.Table) -> pa.Table:
            hull = _hull(np.stack([table["x"].to_numpy(), table["y"].to_numpy()], 1))
            owner = table[key].take(pa.array(np.zeros(len(hull), np.int64)))
            return pa.table([owner, pa.array(hull[:, 0]), pa.array(hull[:, 1])], names=[key, "x", "y"])

        fewer = dealt.filter("_salt is not null").select(key, "x", "y", "_salt").groupBy(key, "_salt").applyInArrow(
            reduce, f"`{key}` {kind}, x double, y double")
        before = corners.count()
        corners = cut(fewer.unionByName(dealt.filter("_salt is null").select(key, "x", "y")))
        if corners.count() == before:  # all of them are corners of one hull, which is the result
            break
    turn = np.arange(32) * 2 * math.pi / 32

    def finish(batches):
        for batch in batches:
            rings = []
            for xs, ys in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                hull = _hull(np.stack([xs, ys], 1))
                if radius is not None:
                    hull = _hull((hull[:, None] + (np.stack([np.cos(turn), np.sin(turn)], 1) * radius)[None]).reshape(-1, 2))
                rings.append(np.vstack([hull, hull[:1]]))
            flat = np.vstack(rings) if rings else np.zeros((0, 2))
            points_ = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["x", "y"])
            each = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rings)]), pa.int32()), points_)
            whole = pa.ListArray.from_arrays(pa.array(np.arange(len(rings) + 1), pa.int32()), each)
            yield pa.RecordBatch.from_arrays([batch.column(0), whole], [key, "rings"])

    # Slow for their bytes, so not left to few tasks.
    listed = corners.repartition(parts_of(corners), key).groupBy(key).agg(F.collect_list(F.struct("x", "y")).alias("p"))  # LISTED places at most
    return listed.select(key, "p.x", "p.y").mapInArrow(finish, f"`{key}` {kind}, rings {geo.RINGS}")

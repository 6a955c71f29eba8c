"""Nearest neighbour over an adaptive pyramid of grid cells.

Targets are put in cells of their box centre. A cell with more than CROWD targets is split
into 4 × 4, and again until each leaf holds few; above the leaves the cells grow by a factor
4 a level. Every occupied cell knows the box of all its targets, one target as a sample and its lowest key.

Queries that lie together are asked as one group of at most CROWD. A group first gets an upper
bound from the samples of its own cells, then starts at the level where 3 × 3 cells reach that
far, and goes down level by level to the leaves, keeping only the cells that may hold something
nearer than the best sample seen. Groups that meet in one cell are salted there.

The queries of a group are measured against the leaf nearest to it, in arrays, and then against those targets of the
other leaves that may still be nearer than what the worst of them found. Of a group whose queries all have
a target at distance 0, only lower keys are of interest, so a query never meets all targets it covers.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, pairs
from ..session import cut
from .groups import in_groups
from .overlap import distances_of, point_distances_of, polygon_distance
from .skew import salted_join

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTOR = 4
BOX = ["minx", "miny", "maxx", "maxy"]
SLACK = 1e-6
#: Targets that a leaf may hold, and queries of a group.
CROWD = 256
#: Crowded cells of queries that are broadcast, some 50 bytes each.
FEW_CELLS = 50_000
#: Numbers in an array of a group's queries and targets.
MATRIX = 1 << 19
#: Cells below this side are not split: their targets are on one spot.
LEAST = 2.0 ** -20


def _lower(p: str) -> Column:
    """Least distance between the query box and the box with prefix `p`."""
    dx = f"greatest(minx - {p}maxx, {p}minx - maxx, 0D)"
    dy = f"greatest(miny - {p}maxy, {p}miny - maxy, 0D)"
    return F.expr(f"sqrt({dx} * {dx} + {dy} * {dy})")


def _upper(p: str) -> Column:
    """Greatest distance between points of both boxes."""
    dx = f"greatest({p}maxx - minx, maxx - {p}minx)"
    dy = f"greatest({p}maxy - miny, maxy - {p}miny)"
    return F.expr(f"sqrt({dx} * {dx} + {dy} * {dy})")


def point_items(df: DataFrame, key: str, x: str = "x", y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """Points in the form `nearest` takes: key, box and geometry."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.col(key).alias("key"), *by,
        F.col(x).cast("double").alias("minx"), F.col(y).cast("double").alias("miny"),
        F.col(x).cast("double").alias("maxx"), F.col(y).cast("double").alias("maxy"),
        geo.point(x, y).alias("geom"))


def polygon_items(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    return df.filter("rings is not null").select(
        F.col(key).alias("key"), *by, *[c.alias(n) for n, c in geo.bounds("rings").items()], F.col("rings").alias("geom"))


def shape_items(df: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Shapes of several parts, one item per part; the parts' key is `(id, part)`."""
    parts = df.filter("rings is not null").select(F.col(key).alias("_id"), *by, F.posexplode("rings").alias("_part", "_ring"))
    return polygon_items(parts.select(F.struct(F.col("_id").alias("id"), F.col("_part").alias("part")).alias("_key"), *by,
                                      F.array("_ring").alias("rings")), "_key", by)


def of_shapes(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """What `nearest` found for the items of shapes, per shape: the target nearest to any part."""
    best = found.groupBy(F.col("key.id").alias("key"), *by).agg(F.min(F.struct("distance", "target")).alias("_best"))
    return best.select("key", *by, "_best.target", "_best.distance")


def point_to_point(q: str, t: str) -> Column:
    return geo.distance(f"{q}.x", f"{q}.y", f"{t}.x", f"{t}.y")


def polygon_to_point(q: str, t: str) -> Column:
    return geo.point_polygon_distance(f"{t}.x", f"{t}.y", q)


def point_to_polygon(q: str, t: str) -> Column:
    return geo.point_polygon_distance(f"{q}.x", f"{q}.y", t)


def polygon_to_polygon(q: str, t: str) -> Column:
    return polygon_distance(q, t)


def nearest(
    queries: DataFrame, targets: DataFrame, exact: Callable[[str, str], Column],
    by: Sequence[str] = (), cell: float = 32.0, max_distance: float | None = None,
) -> DataFrame:
    """`(key, *by, target, distance)` of the nearest target per query; the lowest target
    key on a tie.

    With `by`, only targets of equal values count. Queries without any target (or none
    within `max_distance`) are left out. `exact` is one of the four functions above. `cell` is the
    side of a cell where places are too few to tell.
    """
    by = list(by)
    queries, targets = (df.filter("minx is not null and miny is not null") for df in (queries, targets))
    targets = cut(targets.groupBy(*by, *BOX, "geom").agg(F.min("key").alias("target")))
    ends = [F.count("*"), F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy"),
            F.max(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))) / 2]
    kinds = [F.approx_count_distinct(F.struct(*by))] if by else []
    asked, known = (df.agg(*ends, *kinds).first() for df in (queries, targets))  # seven numbers each
    if not asked[0] or not known[0]:
        kind = dict(targets.dtypes)["target"]
        return queries.select("key", *by).limit(0).withColumns(
            {"target": F.lit(None).cast(kind), "distance": F.lit(None).cast("double")})
    placed = _grouped(queries, by, _cell_for(asked, CROWD / 2, cell))
    groups = cut(placed.groupBy(F.col("group").alias("key"), *by).agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        F.count("*").alias("n")))
    widest = groups.agg(ends[5]).first()[0]
    half = float(known[5])
    span = max(max(asked[i + 2], known[i + 2]) - min(asked[i], known[i]) for i in (1, 2))
    if max_distance is not None:
        span = min(span, max_distance + half + float(widest))
    cell = _cell_for(known, CROWD / 4, cell)
    members, depth = _leaves(targets, by, cell)
    cell = cell / FACTOR ** depth  # side of level 0; leaves are at level `depth` or lower
    levels = depth
    while cell * FACTOR ** levels <= span:
        levels += 1

    cells = _pyramid(members, by, cell, levels)
    far = F.lit(float("inf") if max_distance is None else float(max_distance))
    arrived = _arrived(groups, cells, by, cell, depth, levels, half, far, max_distance is not None)

    at = [*by, "level", "cx", "cy"]
    group = ["key", *by]
    held = members.select(*at, "target", F.col("geom").alias("t_geom"), *[F.col(c).alias(f"t_{c}") for c in BOX])
    place = F.struct("level", "cx", "cy")
    nearest_leaf = arrived.groupBy(*group).agg(F.min_by(place, F.struct("near", place)).alias("_first"))
    first = nearest_leaf.select(*group, "_first.level", "_first.cx", "_first.cy")
    found = cut(_measured(placed, salted_join(first, held, at, spread=F.xxhash64("key")), None, exact, by, max_distance))

    worst = found.groupBy(F.col("group").alias("key"), *by).agg(
        F.count("*").alias("_found"), F.max("distance").alias("_worst"), F.max("target").alias("_last"))
    left = arrived
    for right in (worst, nearest_leaf):
        same = F.lit(True)
        for c in group:
            same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        left = left.join(right.withColumnsRenamed({c: f"_r_{c}" for c in group}), same, "left").drop(*[f"_r_{c}" for c in group])
    known_all = F.coalesce(F.col("_found") >= F.col("n"), F.lit(False))
    left = left.filter(place != F.col("_first")).withColumn("bound", F.when(known_all, F.col("_worst")).otherwise(F.col("bound")))
    left = left.withColumn("zero", known_all & (F.col("_worst") == 0))
    more = F.when(F.col("zero"), (F.col("low") <= 0) & (F.col("least") < F.col("_last"))).otherwise(F.col("low") <= F.col("bound") + SLACK)
    left = cut(left.filter(more).select(*group, *BOX, "bound", "zero", "_last", "level", "cx", "cy"))
    low = _lower("t_")
    rest = salted_join(left, held, at, spread=F.xxhash64("key"), condition=F.when(
        F.col("zero"), (low <= 0) & (F.col("target") < F.col("_last"))).otherwise(low <= F.col("bound") + SLACK))
    better = _measured(placed, rest, found, exact, by, max_distance)
    columns = ["key", *by, "distance", "target"]
    return (
        found.select(*columns).unionByName(better.select(*columns))
        .groupBy("key", *by).agg(F.min(F.struct("distance", "target")).alias("_best"))
        .select("key", *by, F.col("_best.target").alias("target"), F.col("_best.distance").alias("distance"))
    )


def _cell_for(ends, most: float, cell: float) -> float:
    """Side of cells that hold `most` of a table of places spread evenly, a power of two."""
    kinds = ends[6] if len(ends) > 6 else 1
    wide, high = ends[3] - ends[1], ends[4] - ends[2]
    area = max(wide, high * 2.0 ** -10, LEAST) * max(high, wide * 2.0 ** -10, LEAST)
    if area <= LEAST ** 2 or not math.isfinite(area):
        return cell
    return 2.0 ** max(-16, round(math.log2(math.sqrt(area * most * max(1, kinds) / ends[0]))))


def _grouped(queries: DataFrame, by: list[str], cell: float) -> DataFrame:
    """Queries with a `tag` and the `group` they are asked in: those of like size in one cell.

    Cells with more than CROWD are divided evenly, and what is still crowded is dealt by the tag.
    """
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"), F.lit(2.0 ** -10))
    placed = queries.withColumns({
        "tag": F.xxhash64("key", "geom"), "_size": F.floor(F.log2(extent) / 2).cast("int"), **_centred(cell)})
    at = [*by, "_size", "cx", "cy"]
    counted = _with_count(placed, at)
    if counted is None:
        return placed.withColumn("group", F.xxhash64(*at)).select("key", *by, *BOX, "geom", "tag", "group")
    placed = counted.withColumn("_parts", F.ceil(F.sqrt(F.col("_n") * 4 / CROWD)))
    part = lambda low, high, c: F.floor(((F.col(low) + F.col(high)) / 2 / cell - F.col(c)) * F.coalesce("_parts", F.lit(1)))
    placed = placed.withColumns({"_sx": part("minx", "maxx", "cx"), "_sy": part("miny", "maxy", "cy")}).drop("_n", "_parts")
    counted = _with_count(placed, [*at, "_sx", "_sy"])
    placed = placed.withColumn("_n", F.lit(None).cast("bigint")) if counted is None else counted
    dealt = F.coalesce(F.pmod("tag", F.ceil(F.col("_n") * 2 / CROWD)), F.lit(0))
    return placed.withColumn("group", F.xxhash64(*at, "_sx", "_sy", dealt)).select("key", *by, *BOX, "geom", "tag", "group")


def _with_count(rows: DataFrame, at: list[str]) -> DataFrame | None:
    """Rows with `_n`, how many there are in their cell where that is more than CROWD; None if no cell has so many."""
    crowded = cut(rows.groupBy(*at).agg(F.count("*").alias("_n")).filter(F.col("_n") > CROWD))
    cells = crowded.count()
    if not cells:
        return None
    same = F.lit(True)
    for c in at:
        same = same & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    crowded = crowded.withColumnsRenamed({c: f"_c_{c}" for c in at})
    if cells <= FEW_CELLS:  # counted, not estimated; so the queries are not shuffled
        crowded = F.broadcast(crowded)
    return rows.join(crowded, same, "left").drop(*[f"_c_{c}" for c in at])


def _arrived(
    groups: DataFrame, cells: DataFrame, by: list[str], cell: float, depth: int, levels: int, half: float, far: Column, limited: bool,
) -> DataFrame:
    """The leaves that may hold the nearest target of some query of a group, with `low`, the least distance from the
    group, `near`, that of the middles, and `least`, the lowest key."""
    started = _upper_bounds(groups, cells, by, cell, levels, far, limited)
    room = F.col("bound") + half + F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) / 2
    level = F.lit(depth)
    for k in range(depth, levels):
        level = level + F.when(room > cell * FACTOR ** k, F.lit(1)).otherwise(F.lit(0))
    side = _side(cell)
    middle_x, middle_y = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    around = F.sequence(F.lit(-1), F.lit(1))
    frontier = (
        started.withColumn("level", level)
        .withColumn("cx", F.explode(F.transform(around, lambda d: F.floor(middle_x / side).cast("bigint") + d)))
        .withColumn("cy", F.explode(F.transform(around, lambda d: F.floor(middle_y / side).cast("bigint") + d)))
    )
    at = by + ["level", "cx", "cy"]
    row = ["key", *by, *BOX, "n", "bound"]
    seen = [_lower("c_").alias("low"), F.hypot(middle_x - (F.col("c_minx") + F.col("c_maxx")) / 2, middle_y - (F.col("c_miny") + F.col("c_maxy")) / 2).alias("near"),
            F.col("c_target").alias("least")]
    occupied = cells.select(*at, "leaf", *[c for c in cells.columns if c.startswith("c_")])
    frontier = salted_join(cut(frontier), occupied, at, spread=F.xxhash64("key")).filter(_lower("c_") <= F.col("bound") + SLACK)
    frontier = cut(frontier.select(*row, "level", "cx", "cy", "leaf", *seen))

    children = _children(cells, by, levels)
    per_group = Window.partitionBy("key", *by)
    arrived = frontier.filter("leaf")
    while True:  # a round goes down one level
        inner = frontier.filter("not leaf").drop("leaf", "low", "near", "least")
        if inner.isEmpty():
            return arrived
        opened = salted_join(inner, children, at, spread=F.xxhash64("key"))
        best = F.least(F.col("bound"), F.min(_upper("s_")).over(per_group))
        frontier = cut(
            opened.withColumn("bound", best).filter(_lower("c_") <= F.col("bound") + SLACK)
            .select(*row, F.col("child_level").alias("level"), F.col("child_cx").alias("cx"),
                    F.col("child_cy").alias("cy"), "leaf", *seen))
        arrived = arrived.unionByName(frontier.filter("leaf"))


def _measured(
    placed: DataFrame, targets: DataFrame, found: DataFrame | None, exact: Callable[[str, str], Column], by: list[str], limit: float | None,
) -> DataFrame:
    """`(group, *by, key, tag, distance, target)` of the nearest of a group's targets for each of its queries.

    With `found`, what the queries have already, only what is nearer or has a lower key.
    """
    shaped_q, shaped_t = exact in (polygon_to_point, polygon_to_polygon), exact in (point_to_polygon, polygon_to_polygon)
    group = ["group", *by]
    types = {"key": placed.schema["key"].dataType, "target": targets.schema["target"].dataType, "tag": "bigint", "distance": "double",
             **{c: "double" for c in BOX}, "q_geom": geo.RINGS, "t_geom": geo.RINGS}
    wanted = [c for c in types if c not in ("q_geom", "t_geom") or (shaped_q if c == "q_geom" else shaped_t)]

    def rows(df: DataFrame, kind: int, columns: dict[str, str]) -> DataFrame:
        return df.select(*group, F.lit(kind).alias("kind"), *[
            (F.col(columns[c]) if c in columns else F.lit(None)).cast(types[c]).alias(c) for c in wanted])

    boxes = {c: c for c in BOX}
    asked = rows(placed, 0, {"key": "key", "tag": "tag", **boxes, **({"q_geom": "geom"} if shaped_q else {})})
    offered = rows(targets.withColumnRenamed("key", "group"), 2, {
        "target": "target", **{c: f"t_{c}" for c in BOX}, **({"t_geom": "t_geom"} if shaped_t else {})})
    if found is None:
        both = asked.unionByName(offered)
    else:  # groups that have other targets left
        both = asked.unionByName(rows(found, 1, {"tag": "tag", "distance": "distance", "target": "target"})).unionByName(offered)
    ordered = targets.schema["target"].dataType.typeName() in ("byte", "short", "integer", "long", "string", "date")

    def run(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        number = lambda c: table[c].combine_chunks().to_numpy(zero_copy_only=False)
        array = lambda c: table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c]
        kind, tag, distance = number("kind"), table["tag"].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False), number("distance")
        box = np.stack([number(c).astype(np.float64) for c in BOX], 1)
        name = table["target"].combine_chunks().to_numpy(zero_copy_only=False) if ordered else None
        p = pairs.Polygons(array("q_geom")) if shaped_q else None
        t = pairs.Polygons(array("t_geom")) if shaped_t else None

        def measure(q_rows: np.ndarray, t_rows: np.ndarray) -> np.ndarray:
            if shaped_q and shaped_t:
                return distances_of(p, q_rows, t, t_rows)
            if shaped_q:
                return point_distances_of(box[t_rows, 0], box[t_rows, 1], p, q_rows)
            return point_distances_of(box[q_rows, 0], box[q_rows, 1], t, t_rows)

        ends = np.append(starts[1:], table.num_rows)
        out_q, out_t, out_d = [], [], []
        for start, end in zip(starts.tolist(), ends.tolist()):
            ones, twos = start + np.searchsorted(kind[start:end], [1, 2])
            q_rows, b_rows, t_rows = np.arange(start, ones), np.arange(ones, twos), np.arange(twos, end)
            if not len(q_rows) or not len(t_rows):
                continue
            best, rank = np.full(len(q_rows), np.inf), np.full(len(q_rows), np.inf)
            if len(b_rows):
                order = b_rows[np.argsort(tag[b_rows], kind="stable")]
                place = np.minimum(np.searchsorted(tag[order], tag[q_rows]), len(order) - 1)
                same = tag[order[place]] == tag[q_rows]
                best[same] = distance[order[place[same]]]
                if ordered:
                    rank[same] = np.searchsorted(name[t_rows], name[order[place[same]]]) - 0.5
            step = max(1, MATRIX // len(t_rows))
            for k in range(0, len(q_rows), step):
                some = q_rows[k:k + step]
                got, d = _search(box[some], box[t_rows], best[k:k + step], rank[k:k + step], math.inf if limit is None else limit,
                                 (lambda i, j, some=some: measure(some[i], t_rows[j])) if shaped_q or shaped_t else None)
                new = np.flatnonzero(got >= 0)
                out_q.append(some[new])
                out_t.append(t_rows[got[new]])
                out_d.append(d[new])
        q, t_, d = (np.concatenate(c) if c else np.zeros(0, kind_) for c, kind_ in ((out_q, np.int64), (out_t, np.int64), (out_d, np.float64)))
        at = pa.array(q)
        return pa.RecordBatch.from_arrays(
            [*(array(c).take(at) for c in [*group, "key", "tag"]), pa.array(d), array("target").take(pa.array(t_))],
            [*group, "key", "tag", "distance", "target"])

    kinds = ", ".join(f"`{c}` {both.schema[c].dataType.simpleString()}" for c in [*group, "key", "tag", "distance", "target"])
    return in_groups(both, group, ["kind", "target"], run, kinds)


def _search(q: np.ndarray, t: np.ndarray, best: np.ndarray, rank: np.ndarray, limit: float, measure) -> tuple[np.ndarray, np.ndarray]:
    """Target (-1: none better) and distance per query, of boxes (n, 4) and (m, 4); targets are sorted by key.

    Targets whose boxes are nearest are measured first, and no others than may still be nearer than the best (or as near,
    with a lower key); without `measure` the distance is that of the boxes.
    """
    dx = np.maximum(np.maximum(q[:, 0, None] - t[:, 2], t[:, 0] - q[:, 2, None]), 0.0)
    dy = np.maximum(np.maximum(q[:, 1, None] - t[:, 3], t[:, 1] - q[:, 3, None]), 0.0)
    low = np.sqrt(dx * dx + dy * dy)
    got = np.full(len(q), -1)
    best, rank = best.copy(), rank.copy()
    ranks = np.arange(len(t))
    if measure is None:
        found = low.argmin(1)
        d = low[np.arange(len(q)), found]
        new = (d <= limit) & ((d < best) | ((d == best) & (found < rank)))
        got[new], best[new] = found[new], d[new]
        return got, best
    low[low > np.minimum(best, limit)[:, None] + SLACK] = np.inf

    def narrowed(rows: np.ndarray) -> None:
        part = low[rows]
        part[part > best[rows][:, None] + SLACK] = np.inf
        zero = best[rows] == 0
        part[zero] = np.where((part[zero] > 0) | (ranks > rank[rows][zero][:, None]), np.inf, part[zero])
        low[rows] = part

    narrowed(np.flatnonzero(np.isfinite(best)))
    rows, many = np.flatnonzero(np.isfinite(low).any(1)), 1
    while len(rows):
        part = low[rows]
        if many == 1:
            j = part.argmin(1)[:, None]
        elif many < len(t):
            j = np.argpartition(part + ranks * 1e-9, many - 1, axis=1)[:, :many]
        else:
            j = np.broadcast_to(ranks, part.shape)
        i = np.repeat(rows, j.shape[1])
        j = j.reshape(-1)
        asked = np.isfinite(low[i, j])
        i, j = i[asked], j[asked]
        d = measure(i, j)
        low[i, j] = np.inf
        order = np.lexsort((j, np.where(np.isnan(d), np.inf, d), i))
        i, j, d = i[order], j[order], d[order]
        lead = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
        i, j, d = i[lead], j[lead], d[lead]
        new = (d <= limit) & ((d < best[i]) | ((d == best[i]) & (j < rank[i])))
        i, j, d = i[new], j[new], d[new]
        got[i], best[i], rank[i] = j, d, j
        narrowed(rows)
        rows, many = rows[np.isfinite(low[rows]).any(1)], many * 4
    return got, best


def _side(cell: float) -> Column:
    """Side of a cell of the row's level."""
    return F.lit(float(cell)) * F.pow(F.lit(float(FACTOR)), F.col("level"))


def _centred(side: Column | float) -> dict[str, Column]:
    return {"cx": F.floor((F.col("minx") + F.col("maxx")) / 2 / side).cast("bigint"),
            "cy": F.floor((F.col("miny") + F.col("maxy")) / 2 / side).cast("bigint")}


def _leaves(targets: DataFrame, by: list[str], cell: float) -> tuple[DataFrame, int]:
    """Targets with the leaf they are in, and how often `cell` was split: the leaf's level counts from the finest side.

    Each round counts the targets of the cells split in the round before, and splits the crowded ones.
    """
    at = [*by, "cx", "cy"]
    found, rest, depth = [], targets, 0
    while True:
        rest = rest.withColumns(_centred(cell / FACTOR ** depth))
        crowded = cut(rest.groupBy(*at).agg(F.count("*").alias("_n")).filter(F.col("_n") > CROWD).select(*at))
        if crowded.isEmpty() or cell / FACTOR ** depth < LEAST:
            found.append(rest)
            break
        found.append(salted_join(rest, crowded, at, "left_anti", spread=F.xxhash64("target")).select(*rest.columns))
        rest = cut(salted_join(rest, crowded, at, "left_semi", spread=F.xxhash64("target")).select(*rest.columns))
        depth += 1
    leaves = None
    for k, part in enumerate(found):
        part = part.withColumn("level", F.lit(depth - k))
        leaves = part if leaves is None else leaves.unionByName(part)
    return leaves, depth


def _pyramid(members: DataFrame, by: list[str], cell: float, levels: int) -> DataFrame:
    """Occupied cells from the leaves up with their box and sample box."""
    placed = (
        members.select(*by, *BOX, "target", F.col("level").alias("own"))
        .withColumn("level", F.explode(F.sequence(F.col("own"), F.lit(levels)))).withColumns(_centred(_side(cell)))
    )
    cells = placed.groupBy(*by, "level", "cx", "cy").agg(
        F.max(F.col("own") == F.col("level")).alias("leaf"), F.min("minx").alias("c_minx"), F.min("miny").alias("c_miny"),
        F.max("maxx").alias("c_maxx"), F.max("maxy").alias("c_maxy"), F.min("target").alias("c_target"), F.min(F.struct(*BOX)).alias("s"))
    return cut(cells.select(*by, "level", "cx", "cy", "leaf", "c_minx", "c_miny", "c_maxx", "c_maxy", "c_target",
                            *[F.col(f"s.{c}").alias(f"s_{c}") for c in BOX]))


def _children(cells: DataFrame, by: list[str], levels: int) -> DataFrame:
    """Cells under the key of their parent."""
    child = [F.col("level").alias("child_level"), F.col("cx").alias("child_cx"), F.col("cy").alias("child_cy")]
    boxes = [c for c in cells.columns if c[:2] in ("c_", "s_")]
    return cells.filter(F.col("level") < levels).select(
        *by, (F.col("level") + 1).alias("level"), F.floor(F.col("cx") / FACTOR).cast("bigint").alias("cx"),
        F.floor(F.col("cy") / FACTOR).cast("bigint").alias("cy"), *child, "leaf", *boxes)


def _upper_bounds(
    queries: DataFrame, cells: DataFrame, by: list[str], cell: float, levels: int, far: Column, limited: bool,
) -> DataFrame:
    """Per group the distance to the best sample in its own cells, at most `far`."""
    narrow = queries.select("key", *by, *BOX, "n")
    own = narrow.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(levels)))).withColumns(_centred(_side(cell)))
    samples = cells.select(*by, "level", "cx", "cy", *[c for c in cells.columns if c.startswith("s_")])
    seen = salted_join(own, samples, by + ["level", "cx", "cy"], "left", spread=F.xxhash64("key"))
    bound = F.coalesce(F.min(_upper("s_")), far)
    if limited:
        bound = F.least(bound, far)
    return seen.groupBy("key", *by, *BOX, "n").agg(bound.alias("bound"))

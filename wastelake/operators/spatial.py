"""Spatial joins on grid cells.

A polygon is put in cells whose side is a power of two, at least its own extent and twice
the reach, so it has four cells at most, however large it is. A polygon of many corners is
first cut into a quadtree: cells with few of its corners hold its piece, cells wholly inside
it are marked and need no test. A point has one cell per side in use. The join is an
equality on the cell; the exact predicate comes after a bounding-box test. Rows of a hot
cell are salted.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..session import cut
from .skew import salted_join

# Workers need not have the package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Corners that a piece of a polygon may have.
CORNERS = 64
#: The least side of a cell is 2 ** LEAST metres, where corners lie on one spot.
LEAST = -10
CELL = ["level", "cx", "cy"]


def cell_of(c: Column, size: Column | float) -> Column:
    return F.floor(c / size).cast("bigint")


def with_bounds(polygons: DataFrame) -> DataFrame:
    if "minx" in polygons.columns:
        return polygons
    return polygons.withColumns(geo.bounds("rings"))


def _side(level: Column | str) -> Column:
    return F.pow(F.lit(2.0), level)


def _levelled(polygons: DataFrame, grow: Column, size: float) -> DataFrame:
    """Polygons with `level`: a cell of side 2 ** level is as wide as the grown box, and `size` at least."""
    extent = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) + 2 * grow
    return polygons.withColumn("level", F.greatest(
        F.lit(math.ceil(math.log2(size))), F.ceil(F.log2(F.greatest(extent, F.lit(2.0 ** LEAST))))).cast("int"))


def _in_own_cells(polygons: DataFrame, grow: Column) -> DataFrame:
    """Each polygon in the cells of its level that its grown box touches, four at most."""
    side = _side("level")
    return (
        polygons
        .withColumn("cx", F.explode(F.sequence(cell_of(F.col("minx") - grow, side), cell_of(F.col("maxx") + grow, side))))
        .withColumn("cy", F.explode(F.sequence(cell_of(F.col("miny") - grow, side), cell_of(F.col("maxy") + grow, side))))
    )


def _half(e: np.ndarray, axis: int, line: float, sign: int) -> np.ndarray:
    """The part of closed edges (n, 4) on one side of a line, closed along it."""
    a, b = sign * (e[:, axis] - line), sign * (e[:, 2 + axis] - line)
    keep, meets = (a >= 0) & (b >= 0), (a >= 0) != (b >= 0)
    if not meets.any():
        return e[keep]
    cut_edges, inner = e[meets], a[meets] >= 0
    other = 1 - axis
    along = (line - cut_edges[:, axis]) / (cut_edges[:, 2 + axis] - cut_edges[:, axis])
    at = cut_edges[:, other] + along * (cut_edges[:, 2 + other] - cut_edges[:, other])
    point = np.empty((len(at), 2))
    point[:, axis], point[:, other] = line, at
    parts = np.where(inner[:, None], np.hstack([cut_edges[:, :2], point]), np.hstack([point, cut_edges[:, 2:]]))
    parts = parts[(parts[:, 0] != parts[:, 2]) | (parts[:, 1] != parts[:, 3])]
    order = np.sort(at)
    closing = np.empty((len(order) // 2, 4))
    closing[:, axis] = closing[:, 2 + axis] = line
    closing[:, other], closing[:, 2 + other] = order[::2], order[1::2]
    return np.vstack([e[keep], parts, closing[closing[:, other] != closing[:, 2 + other]]])


def _touching(e: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    """Edges that come into a closed box."""
    x0, y0, x1, y1 = box
    near = ((np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0)
            & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0))
    e = e[near]
    corners = np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])
    side = ((e[:, 2] - e[:, 0])[:, None] * (corners[:, 1] - e[:, 1:2]) - (corners[:, 0] - e[:, 0:1]) * (e[:, 3] - e[:, 1])[:, None])
    slack = 1e-9 * (np.abs(e).max(1) + 1) * (np.abs(e[:, 2:] - e[:, :2]).max(1) + 1) if len(e) else np.zeros(0)
    return e[(side.min(1) <= slack) & (side.max(1) >= -slack)]


def quadtree(e: np.ndarray, reach: float, level: int, corners: int = CORNERS):
    """Pieces `(level, cx, cy, full, edges, sides)` of a polygon with many edges (n, 4).

    `sides` are its edges within `reach` of the cell, `edges` the closed outline of what it
    has there, both enough to test any point of the cell. A piece has more sides only where the cell is
    as small as the reach or 2 ** LEAST.
    """
    low, high = np.minimum(e[:, :2], e[:, 2:]).min(0) - reach, np.maximum(e[:, :2], e[:, 2:]).max(0) + reach
    side = 2.0 ** level
    open_ = [(level, cx, cy, e, e) for cx in range(math.floor(low[0] / side), math.floor(high[0] / side) + 1)
             for cy in range(math.floor(low[1] / side), math.floor(high[1] / side) + 1)]
    while open_:
        level, cx, cy, outline, sides = open_.pop()
        side = 2.0 ** level
        box = (cx * side - reach, cy * side - reach, (cx + 1) * side + reach, (cy + 1) * side + reach)
        sides = _touching(sides, box)
        for axis in (0, 1):
            outline = _half(_half(outline, axis, box[axis], 1), axis, box[axis + 2], -1)
        if not len(sides):
            if len(outline):
                yield level, cx, cy, True, outline[:0], sides
            continue
        if len(sides) <= corners or side <= max(reach, 2.0 ** LEAST):
            yield level, cx, cy, False, outline, sides
            continue
        open_ += [(level - 1, 2 * cx + i, 2 * cy + j, outline, sides) for i in (0, 1) for j in (0, 1)]


def _edge_lists(found: list[np.ndarray]) -> pa.Array:
    flat = np.vstack(found) if found else np.zeros((0, 4))
    end = lambda i: pa.StructArray.from_arrays([pa.array(flat[:, i]), pa.array(flat[:, i + 1])], ["x", "y"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()),
                                    pa.StructArray.from_arrays([end(0), end(2)], ["a", "b"]))


def pieces(polygons: DataFrame, grow: Column | float = 0.0, size: float = 32.0) -> DataFrame:
    """Polygons by cell (level, cx, cy): their other columns, bounds, and what a point of the cell is tested with.

    Rows per polygon: four at most if it has CORNERS corners or fewer, else in
    proportion to its corners, whatever the area. No row holds a whole large polygon.
    """
    return _pieces(polygons, grow, size)[0]


def _pieces(polygons: DataFrame, grow: Column | float, size: float) -> tuple[DataFrame, list[int]]:
    """The pieces and the levels they have; only polygons of many corners are cut up, and written."""
    grow = F.lit(float(grow)) if isinstance(grow, (int, float)) else grow
    polygons = polygons.filter("rings is not null")
    carried = [c for c in polygons.columns if c not in ("rings", "minx", "miny", "maxx", "maxy")]
    boxed = _levelled(with_bounds(polygons).withColumn("grow", grow.cast("double")), F.col("grow"), size)
    many = F.expr(f"size(flatten(rings)) - size(rings) > {CORNERS}")
    names = [*carried, "minx", "miny", "maxx", "maxy", "grow"]
    found = boxed.groupBy("level").agg(F.count_if(~many).alias("few"), F.count_if(many).alias("many")).collect()  # one row per side in use
    levels = sorted(r.level for r in found if r.few)
    few = _in_own_cells(boxed.filter(~many), F.col("grow")).select(
        *names, *CELL, F.lit(False).alias("full"), F.expr(geo.edges_sql("rings")).alias("edges"))
    few = few.withColumn("sides", F.lit(None).cast(few.schema["edges"].dataType))
    if not any(r.many for r in found):
        return few, levels
    ends = [F.expr(f"transform({geo.edges_sql('rings')}, _e -> _e.{p}.{c})").alias(f"{p}{c}") for p in "ab" for c in "xy"]
    large = boxed.filter(many).select(*names, F.col("level").alias("top"), *ends)

    def run(batches):
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            taken, out = [], []
            for row, (top, reach, *e) in enumerate(zip(*(columns[c].to_pylist() for c in ("top", "grow", "ax", "ay", "bx", "by")))):
                for piece in quadtree(np.array(e, np.float64).T, reach, top):
                    taken.append(row)
                    out.append(piece)
            at = pa.array(taken, pa.int64())
            level, cx, cy, full, edges, sides = zip(*out) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [*(columns[c].take(at) for c in names), pa.array(level, pa.int32()), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()),
                 pa.array(full, pa.bool_()), _edge_lists(list(edges)), _edge_lists(list(sides))], [*names, *CELL, "full", "edges", "sides"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in boxed.select(*names).schema)
    cut_up = cut(large.mapInArrow(run, f"{kinds}, level int, cx bigint, cy bigint, {geo.PIECE}"))
    own = {r.level for r in cut_up.select("level").distinct().collect()}  # one row per side in use
    return few.unionByName(cut_up), sorted({*levels, *own})


def point_cells(points: DataFrame, levels: list[int]) -> DataFrame:
    """Points with a place in their cell of each level."""
    return (
        points.filter("x is not null and y is not null")
        .withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
        .withColumns({"cx": cell_of(F.col("x"), _side("level")), "cy": cell_of(F.col("y"), _side("level"))})
    )


def _near_box(grow: Column) -> Column:
    return F.col("x").between(F.col("minx") - grow, F.col("maxx") + grow) & F.col("y").between(
        F.col("miny") - grow, F.col("maxy") + grow)


def _with_pieces(points: DataFrame, polygons: DataFrame, grow: Column | float, size: float, how: str, condition: Column) -> DataFrame:
    """Join of points and polygon pieces on their cells."""
    placed, levels = _pieces(polygons, grow, size)
    if how != "inner" and len(levels) != 1:
        # A point is in one cell per side, and kept or dropped by all of them together.
        keyed = points.withColumn("_place", F.struct("x", "y"))
        spots = keyed.filter("x is not null and y is not null").select("x", "y", "_place").distinct()
        met = salted_join(point_cells(spots, levels), placed, CELL, "left_semi", condition).select("_place").distinct()
        kept = keyed.filter("x is not null and y is not null").join(met, "_place", how)
        return kept.select(*points.columns)
    joined = salted_join(point_cells(points, levels), placed, CELL, how, condition)
    return joined.drop(*CELL)


def points_near_polygons(
    points: DataFrame, polygons: DataFrame, reach: Column | float, size: float = 32.0, how: str = "inner",
) -> DataFrame:
    """Pairs of a point (x, y) and a polygon (rings) within `reach`, with their `distance`; without the rings.

    `how` may be `left_semi` or `left_anti` to only test for a polygon; no pair is built then.
    """
    distance = geo.piece_distance("x", "y")
    if how != "inner":
        return _with_pieces(points, polygons, reach, size, how, _near_box(F.col("grow")) & (distance <= F.col("grow")))
    pairs = _with_pieces(points, polygons, reach, size, how, _near_box(F.col("grow")))
    # A generated row is not put back into its expression, so the distance is worked out once.
    measured = pairs.withColumn("distance", F.explode(F.array(distance))).filter(F.col("distance") <= F.col("grow"))
    return measured.drop("full", "edges", "sides", "grow")


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, strict: bool = True, size: float = 32.0, how: str = "inner",
) -> DataFrame:
    """Pairs of a point and a polygon around it, without the rings; `strict` leaves the edge out."""
    inside = _near_box(F.lit(0.0)) & geo.in_piece("x", "y", strict)
    return _with_pieces(points, polygons, 0.0, size, how, inside).drop("full", "edges", "sides", "grow")


def has_polygon(points: DataFrame, polygons: DataFrame, how: str = "left_semi", size: float = 32.0) -> DataFrame:
    """Points strictly inside some polygon (`left_semi`) or inside none (`left_anti`)."""
    shapes = polygons.select("rings").distinct()
    return points_in_polygons(points, shapes, True, size, how)


def points_near_points(points: DataFrame, others: DataFrame, reach: float, how: str = "inner") -> DataFrame:
    """Pairs within `reach` of a point (x, y) and another one (ox, oy), with `distance`.

    The others, repeated in 3 × 3 cells, should be the smaller table.
    """
    size = float(reach)
    around = F.sequence(F.lit(-1), F.lit(1))
    spread = (
        others.withColumn("cx", F.explode(F.transform(around, lambda d: cell_of(F.col("ox"), size) + d)))
        .withColumn("cy", F.explode(F.transform(around, lambda d: cell_of(F.col("oy"), size) + d)))
    )
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    placed = points.filter("x is not null and y is not null").withColumns(
        {"cx": cell_of(F.col("x"), size), "cy": cell_of(F.col("y"), size)})
    joined = salted_join(placed, spread, ["cx", "cy"], how, dx * dx + dy * dy <= reach * reach)
    if how != "inner":
        return joined.drop("cx", "cy")
    return joined.withColumn("distance", geo.distance("x", "y", "ox", "oy")).drop("cx", "cy")


def has_point(points: DataFrame, others: DataFrame, reach: float, how: str = "left_semi") -> DataFrame:
    """Points with some other point within `reach`, or with none (`left_anti`)."""
    return points_near_points(points, others.select("ox", "oy").distinct(), reach, how)


def polygon_pairs(
    left: DataFrame, right: DataFrame, reach: float, predicate: Column | None, size: float = 64.0,
) -> DataFrame:
    """Pairs of polygons whose boxes come within `reach` and that meet `predicate`.

    Right columns get the prefix `b_`. A polygon is in four cells at most of every side in use from its
    own on; a pair meets in those of the larger one, and is kept only in the cell of the
    lower-left corner their boxes share, so it appears once.
    """
    sides = {}
    for name, table in (("a", left), ("b", right)):
        boxed = _levelled(with_bounds(table), F.lit(float(reach)), size)
        sides[name] = boxed.withColumn("own", F.col("level"))
    levels = sorted({r.own for s in sides.values() for r in s.select("own").distinct().collect()})  # one row per side in use
    wider = F.filter(F.array(*[F.lit(k) for k in levels]).cast("array<int>"), lambda k: k >= F.col("own"))
    a = _in_own_cells(sides["a"].withColumn("level", F.explode(wider)), F.lit(float(reach)))
    b = _in_own_cells(sides["b"].withColumn("level", F.explode(wider)), F.lit(0.0))
    b = b.select(*CELL, *[F.col(c).alias(f"b_{c}") for c in b.columns if c not in CELL])
    boxes = (
        (F.col("minx") - reach <= F.col("b_maxx")) & (F.col("maxx") + reach >= F.col("b_minx"))
        & (F.col("miny") - reach <= F.col("b_maxy")) & (F.col("maxy") + reach >= F.col("b_miny"))
    )
    home = (
        (F.col("level") == F.greatest("own", "b_own"))
        & (F.col("cx") == cell_of(F.greatest(F.col("minx") - reach, F.col("b_minx")), _side("level")))
        & (F.col("cy") == cell_of(F.greatest(F.col("miny") - reach, F.col("b_miny")), _side("level")))
    )
    on = boxes & home if predicate is None else boxes & home & predicate
    return salted_join(a, b, CELL, "inner", on).drop(*CELL, "own", "b_own")


def area_code(points: DataFrame, areas: DataFrame, code: str, name: str, size: float = 1000.0) -> DataFrame:
    """Code of the area around each point, edge included; the lowest code on a shared edge.

    Areas are found once per distinct place, by joining on grid cells, and the answers are
    joined back on the place.
    """
    spots = points.filter("x is not null and y is not null").select("x", "y").distinct()
    inside = points_in_polygons(spots, areas.select(F.col(code).alias("_code"), "rings"), False, size)
    answers = inside.groupBy("x", "y").agg(F.min("_code").alias(name))
    return points.drop(name).join(answers, ["x", "y"], "left")


def fill_area_code(points: DataFrame, areas: DataFrame, code: str, name: str, **options) -> DataFrame:
    """`area_code`, but a code that is already there stays."""
    found = area_code(points, areas, code, "_found", **options)
    return found.withColumn(name, F.coalesce(name, "_found")).drop("_found")


def match_layers(wells: DataFrame, layers: dict[str, tuple[DataFrame, float]], size: float = 32.0) -> DataFrame:
    """Wells within the reach of the objects of each map layer, sorted per well on request.

    Layers hold `(object_id, rings)`, or `(object_id, x, y)` for point layers.
    """
    shapes, dots = None, None
    for name, (layer, reach) in layers.items():
        labelled = layer.withColumn("layer", F.lit(name)).withColumn("reach", F.lit(float(reach)))
        if "rings" in layer.columns:
            part = labelled.select("object_id", "layer", "reach", "rings")
            shapes = part if shapes is None else shapes.unionByName(part)
        else:
            part = labelled.select("object_id", "layer", "reach", F.col("x").alias("ox"), F.col("y").alias("oy"))
            dots = part if dots is None else dots.unionByName(part)
    placed = wells.select(F.col("id").alias("well_id"), "x", "y")
    kept = ["well_id", "object_id", "layer", "distance"]
    out = None
    if shapes is not None:
        pairs = points_near_polygons(placed, shapes, F.col("reach"), size)
        out = pairs.select(*kept, F.lit("POLYGON").alias("kind"))
    if dots is not None:
        widest = max(reach for layer, reach in layers.values() if "rings" not in layer.columns)
        pairs = points_near_points(placed, dots, widest).filter("distance <= reach")
        pairs = pairs.select(*kept, F.lit("POINT").alias("kind"))
        out = pairs if out is None else out.unionByName(pairs)
    return out


def well_objects(matches: DataFrame) -> DataFrame:
    """Match table with points and polygons in columns of their own; running it fails
    when either kind is missing altogether. `matches` is read twice, so it should be
    materialised."""
    rows = matches.select(
        "well_id", "layer",
        F.when(F.col("kind") == "POLYGON", F.col("object_id")).alias("polygon_id"),
        F.when(F.col("kind") == "POINT", F.col("object_id")).alias("point_id"))
    totals = matches.agg(F.count_if(F.col("kind") == "POINT").alias("_points"),
                         F.count_if(F.col("kind") == "POLYGON").alias("_polygons"))
    both = (F.col("_points") > 0) & (F.col("_polygons") > 0)
    failure = F.raise_error(F.lit("no map objects matched")).cast("boolean")
    guard = totals.filter(F.when(both, F.lit(False)).otherwise(failure))  # raises or gives no row
    return rows.unionByName(guard.select(*[F.lit(None).cast(kind).alias(name) for name, kind in rows.dtypes]))

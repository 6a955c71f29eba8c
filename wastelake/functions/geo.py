"""Planar geometry as Column expressions.

A point is a pair of DOUBLE columns. A polygon is `rings`, an
ARRAY<ARRAY<STRUCT<x,y>>> of closed rings read by the even-odd rule (outer ring,
then holes). A geometry of several parts is several rows.

Arguments of the polygon functions are SQL expressions, such as a column name. They are
written as SQL text, because a nested expression of this size is far quicker to parse
than to put together call by call. Functions ending in `_sql` return the text, for use
inside another expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .clean import col, safe_float

RINGS = "array<array<struct<x:double,y:double>>>"

# The published polynomial between WGS84 and the Dutch RD grid,
# as (power of u, power of v): coefficient.
RD_ORIGIN = {"lat": 52.15517440, "lon": 5.38720621, "x": 155000.0, "y": 463000.0}
TO_RD_X = {
    (0, 1): 190094.945, (1, 1): -11832.228, (2, 1): -114.221, (0, 3): -32.391, (1, 0): -0.705,
    (3, 1): -2.340, (1, 3): -0.608, (0, 2): -0.008, (2, 3): 0.148,
}
TO_RD_Y = {
    (1, 0): 309056.544, (0, 2): 3638.893, (2, 0): 73.077, (1, 2): -157.984, (3, 0): 59.788,
    (0, 1): 0.433, (2, 2): -6.439, (1, 1): -0.032, (0, 4): 0.092, (1, 4): -0.054,
}
TO_LAT = {
    (0, 1): 3235.65389, (2, 0): -32.58297, (0, 2): -0.24750, (2, 1): -0.84978, (0, 3): -0.06550,
    (2, 2): -0.01709, (1, 0): -0.00738, (4, 0): 0.00530, (2, 3): -0.00039, (4, 1): 0.00033, (1, 1): -0.00012,
}
TO_LON = {
    (1, 0): 5260.52916, (1, 1): 105.94684, (1, 2): 2.45656, (3, 0): -0.81885, (1, 3): 0.05594,
    (3, 1): -0.05607, (0, 1): 0.01199, (3, 2): -0.00256, (1, 4): 0.00128, (0, 2): 0.00022,
    (2, 0): -0.00022, (5, 0): 0.00026,
}


def point(x: Column | str, y: Column | str) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def point_from_text(lon: Column | str, lat: Column | str) -> Column:
    """Point of two texts; NULL when either is no number or is 0."""
    x, y = safe_float(lon), safe_float(lat)
    return F.when((x != 0) & (y != 0), F.struct(x.alias("lon"), y.alias("lat")))


def _polynomial(terms: dict, u: str, v: str) -> str:
    return " + ".join(
        " * ".join([f"{coefficient!r}D"] + [u] * p + [v] * q) for (p, q), coefficient in terms.items())


def wgs84_to_rd_sql(lon: str, lat: str) -> dict[str, str]:
    u = f"(({lat} - {RD_ORIGIN['lat']}D) * 0.36D)"
    v = f"(({lon} - {RD_ORIGIN['lon']}D) * 0.36D)"
    return {
        "x_rd": f"({RD_ORIGIN['x']}D + {_polynomial(TO_RD_X, u, v)})",
        "y_rd": f"({RD_ORIGIN['y']}D + {_polynomial(TO_RD_Y, u, v)})",
    }


def rd_to_wgs84_sql(x: str, y: str) -> dict[str, str]:
    u = f"(({x} - {RD_ORIGIN['x']}D) * 1e-5D)"
    v = f"(({y} - {RD_ORIGIN['y']}D) * 1e-5D)"
    return {
        "lon": f"({RD_ORIGIN['lon']}D + ({_polynomial(TO_LON, u, v)}) / 3600D)",
        "lat": f"({RD_ORIGIN['lat']}D + ({_polynomial(TO_LAT, u, v)}) / 3600D)",
    }


def wgs84_to_rd(lon: str, lat: str) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in wgs84_to_rd_sql(lon, lat).items()}


def rd_to_wgs84(x: str, y: str) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in rd_to_wgs84_sql(x, y).items()}


def distance(ax: Column | str, ay: Column | str, bx: Column | str, by: Column | str) -> Column:
    dx, dy = col(ax) - col(bx), col(ay) - col(by)
    return F.sqrt(dx * dx + dy * dy)


def square(x: Column | str, y: Column | str, side: Column | str) -> Column:
    """Axis-parallel square with its lower-left corner at (x, y)."""
    x, y, s = col(x), col(y), col(side)
    return F.array(F.array(point(x, y), point(x + s, y), point(x + s, y + s), point(x, y + s), point(x, y)))


def box(minx: Column | str, miny: Column | str, maxx: Column | str, maxy: Column | str) -> Column:
    """Axis-parallel rectangle."""
    return F.array(F.array(point(minx, miny), point(maxx, miny), point(maxx, maxy), point(minx, maxy), point(minx, miny)))


def bounds(rings: str) -> dict[str, Column]:
    ends = {"minx": ("min", "x"), "miny": ("min", "y"), "maxx": ("max", "x"), "maxy": ("max", "y")}
    return {name: F.expr(f"array_{end}(flatten({rings}).{axis})") for name, (end, axis) in ends.items()}


def edges_sql(rings: str) -> str:
    """All edges of all rings as STRUCT<a, b>."""
    return (f"flatten(transform({rings}, _r -> zip_with(slice(_r, 1, size(_r) - 1), slice(_r, 2, size(_r) - 1), "
            "(_a, _b) -> named_struct('a', _a, 'b', _b))))")


def _cross(e: str, x: str, y: str) -> str:
    """Side of the edge the point is on: 0 on its line."""
    return f"(({e}.b.x - {e}.a.x) * ({y} - {e}.a.y) - ({x} - {e}.a.x) * ({e}.b.y - {e}.a.y))"


def _on_edges(edge_list: str, x: str, y: str) -> str:
    return (f"exists({edge_list}, _e -> {_cross('_e', x, y)} = 0"
            f" AND {x} BETWEEN least(_e.a.x, _e.b.x) AND greatest(_e.a.x, _e.b.x)"
            f" AND {y} BETWEEN least(_e.a.y, _e.b.y) AND greatest(_e.a.y, _e.b.y))")


def _in_edges(edge_list: str, x: str, y: str) -> str:
    """A line from the point to the right meets an odd number of edges."""
    side = _cross("_e", x, y)
    return (f"(size(filter({edge_list}, _e -> (_e.a.y <= {y} AND _e.b.y > {y} AND {side} > 0)"
            f" OR (_e.b.y <= {y} AND _e.a.y > {y} AND {side} < 0))) % 2 = 1)")


def covers_sql(rings: str, x: str, y: str) -> str:
    edge_list = edges_sql(rings)
    return f"({_in_edges(edge_list, x, y)} OR {_on_edges(edge_list, x, y)})"


def covers(rings: str, x: str, y: str) -> Column:
    """Point inside the polygon or on its edge."""
    return F.expr(covers_sql(rings, x, y))


def contains(rings: str, x: str, y: str) -> Column:
    """Point strictly inside the polygon."""
    edge_list = edges_sql(rings)
    return F.expr(f"({_in_edges(edge_list, x, y)} AND NOT {_on_edges(edge_list, x, y)})")


def _edge_distance(edge_list: str, x: str, y: str) -> str:
    """Least distance of a point to the edges."""
    dx, dy = "(_e.b.x - _e.a.x)", "(_e.b.y - _e.a.y)"
    length2 = f"({dx} * {dx} + {dy} * {dy})"
    along = f"(({x} - _e.a.x) * {dx} + ({y} - _e.a.y) * {dy})"
    t = f"(CASE WHEN {length2} > 0 THEN greatest(0D, least(1D, {along} / {length2})) ELSE 0D END)"
    ex, ey = f"({x} - _e.a.x - {t} * {dx})", f"({y} - _e.a.y - {t} * {dy})"
    return f"array_min(transform({edge_list}, _e -> sqrt({ex} * {ex} + {ey} * {ey})))"


def point_polygon_distance(x: str, y: str, rings: str) -> Column:
    """0 inside the polygon and on its edge."""
    return F.expr(f"CASE WHEN {covers_sql(rings, x, y)} THEN 0D ELSE {_edge_distance(edges_sql(rings), x, y)} END")


PIECE = "full boolean, edges array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>, sides array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"


def in_piece(x: str, y: str, strict: bool) -> Column:
    """Point of a cell inside the polygon whose piece (full, edges, sides) the cell has."""
    inside, edge = _in_edges("edges", x, y), _on_edges("coalesce(sides, edges)", x, y)
    return F.expr(f"(full OR ({inside} AND NOT {edge}))" if strict else f"(full OR {inside} OR {edge})")


def piece_distance(x: str, y: str) -> Column:
    """Distance of a point of a cell to the polygon whose piece the cell has; NULL if it is beyond the reach."""
    sides = "coalesce(sides, edges)"
    return F.expr(f"CASE WHEN full OR {_in_edges('edges', x, y)} THEN 0D ELSE {_edge_distance(sides, x, y)} END")


def centroid(rings: str) -> dict[str, Column]:
    """Area centroid; holes count against the area by their direction."""
    ax, ay = f"(_e.a.x - {rings}[0][0].x)", f"(_e.a.y - {rings}[0][0].y)"
    bx, by = f"(_e.b.x - {rings}[0][0].x)", f"(_e.b.y - {rings}[0][0].y)"
    turn = f"({ax} * {by} - {bx} * {ay})"
    total = (f"aggregate({edges_sql(rings)}, named_struct('a', 0D, 'x', 0D, 'y', 0D), (_t, _e) -> named_struct("
             f"'a', _t.a + {turn}, 'x', _t.x + ({ax} + {bx}) * {turn}, 'y', _t.y + ({ay} + {by}) * {turn}))")
    return {
        f"c{axis}": F.expr(f"{rings}[0][0].{axis} + transform(array({total}), "
                           f"_t -> CASE WHEN _t.a <> 0 THEN _t.{axis} / (_t.a * 3) ELSE 0D END)[0]")
        for axis in "xy"
    }


def buffer(x: str, y: str, radius: float, quarter_segments: int = 8) -> Column:
    """Polygon of a circle around a point."""
    n = 4 * quarter_segments
    turn = f"(_i % {n}) * {2 * math.pi / n!r}D"
    return F.expr(f"array(transform(sequence(0, {n}), _i -> named_struct('x', CAST({x} AS DOUBLE) + {float(radius)!r}D * cos({turn}), "
                  f"'y', CAST({y} AS DOUBLE) + {float(radius)!r}D * sin({turn}))))")


def parts(rings_of_parts: Column | str) -> Column:
    """Generator: one row per part of a many-part geometry."""
    return F.explode(col(rings_of_parts))


def geometry_type(wkt: Column | str) -> Column:
    return F.upper(F.trim(F.substring_index(F.regexp_replace(col(wkt), r"^SRID=\d+;", ""), "(", 1)))


def _numbers(text: Column) -> Column:
    pair = F.split(F.trim(text), r"\s+")
    return F.struct(F.try_element_at(pair, F.lit(1)).try_cast("double").alias("x"),
                    F.try_element_at(pair, F.lit(2)).try_cast("double").alias("y"))


def point_from_wkt(wkt: Column | str) -> Column:
    return _numbers(F.regexp_extract(col(wkt), r"\(\s*([^()]*?)\s*\)", 1))


def points_from_wkt(wkt: Column | str) -> Column:
    """Points of a MULTIPOINT text, written with or without inner brackets."""
    inner = F.regexp_replace(F.regexp_extract(col(wkt), r"^[^(]*\((.*)\)\s*$", 1), r"[()]", "")
    return F.transform(F.split(inner, ","), _numbers)


def rings_from_wkt(wkt: Column | str) -> Column:
    """Rings of a POLYGON text."""
    texts = F.regexp_extract_all(col(wkt), F.lit(r"\(([^()]+)\)"), 1)
    return F.transform(texts, lambda ring: F.transform(F.split(ring, ","), _numbers))


def parts_from_wkt(wkt: Column | str) -> Column:
    """Polygons of a MULTIPOLYGON text."""
    texts = F.regexp_extract_all(col(wkt), F.lit(r"\(((?:\s*\([^()]+\)\s*,?)+)\)"), 1)
    return F.transform(texts, rings_from_wkt)


def polygon_rows(df: DataFrame, wkt: str) -> DataFrame:
    """A row per polygon of a WKT column, with its `rings`; geometries of other types have none."""
    kind = geometry_type(wkt)
    polygons = F.when(kind == "POLYGON", F.array(rings_from_wkt(wkt))).when(kind == "MULTIPOLYGON", parts_from_wkt(wkt))
    return df.withColumn("rings", parts(polygons))


def point_to_wkt(x: Column | str, y: Column | str) -> Column:
    return F.concat(F.lit("POINT("), _text(col(x)), F.lit(" "), _text(col(y)), F.lit(")"))


def rings_to_wkt(rings: Column | str) -> Column:
    def ring_text(ring: Column) -> Column:
        pairs = F.transform(ring, lambda p: F.concat(_text(p["x"]), F.lit(" "), _text(p["y"])))
        return F.concat(F.lit("("), F.array_join(pairs, ","), F.lit(")"))
    return F.concat(F.lit("POLYGON("), F.array_join(F.transform(col(rings), ring_text), ","), F.lit(")"))


def _text(number: Column) -> Column:
    """Shortest text of a coordinate: whole numbers without a fraction."""
    return F.when(number == F.rint(number), number.cast("bigint").cast("string")).otherwise(number.cast("string"))

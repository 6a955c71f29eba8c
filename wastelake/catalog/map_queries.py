"""Geometry, spatial joins, nearest objects, clusters and sites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean, geo
from ..operators import cluster, links, nearest as nn, overlap, service, shortid, sites as st, spatial
from ..operators.dissolve import dissolve
from ..plans import feeds
from ..session import cut
from . import landed
from .registry import Tables, query

POINT_BOX = """sqrt(greatest(b.minx - p.x, p.x - b.maxx, 0) * greatest(b.minx - p.x, p.x - b.maxx, 0)
    + greatest(b.miny - p.y, p.y - b.maxy, 0) * greatest(b.miny - p.y, p.y - b.maxy, 0))"""
BOX_BOX = """sqrt(greatest(a.minx - b.maxx, b.minx - a.maxx, 0) * greatest(a.minx - b.maxx, b.minx - a.maxx, 0)
    + greatest(a.miny - b.maxy, b.miny - a.maxy, 0) * greatest(a.miny - b.maxy, b.miny - a.maxy, 0))"""
STRICT = "p.x > b.minx AND p.x < b.maxx AND p.y > b.miny AND p.y < b.maxy"
COVERED = "p.x BETWEEN b.minx AND b.maxx AND p.y BETWEEN b.miny AND b.maxy"


# Geometry expressions.

@query("geo_01_point_polygon_distance", f"""SELECT p.id, b.id AS building, {POINT_BOX} AS distance
    FROM {{moorings}} b JOIN {{addresses}} p ON p.street = b.street""")
def _(t: Tables) -> DataFrame:
    places = t.addresses.select("id", "street", "x", "y")
    rows = places.join(t.moorings.select("street", F.col("id").alias("building"), "rings"), "street")
    return rows.select("id", "building", overlap.point_distance("x", "y", "rings").alias("distance"))


@query("geo_01_polygon_distance", f"""SELECT a.id, b.id AS other, {BOX_BOX} AS distance
    FROM {{moorings}} a JOIN {{site_boxes}} b ON a.street = b.straatnaam""")
def _(t: Tables) -> DataFrame:
    others = t.site_boxes.select(F.col("straatnaam").alias("street"), F.col("id").alias("other"), F.col("rings").alias("o"))
    return t.moorings.join(others, "street").select("id", "other", overlap.polygon_distance("rings", "o").alias("distance"))


@query("geo_02_within_and_covered", f"""SELECT p.id, b.vollcode, {STRICT} AS strict, {COVERED} AS touching
    FROM {{wells}} p JOIN {{areas}} b ON b.vollcode = p.buurt_code""")
def _(t: Tables) -> DataFrame:
    rows = t.wells.join(t.areas.select(F.col("vollcode").alias("buurt_code"), "rings"), "buurt_code")
    return rows.select("id", F.col("buurt_code").alias("vollcode"), geo.contains("rings", "x", "y").alias("strict"),
                       geo.covers("rings", "x", "y").alias("touching"))


@query("geo_03_within_distance", """SELECT p.id, q.id AS other FROM {wells} p JOIN {bins} q
    ON q.x BETWEEN p.x - 10 AND p.x + 10 AND q.y BETWEEN p.y - 10 AND p.y + 10
    WHERE (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 100""")
def _(t: Tables) -> DataFrame:
    near = t.bins.select(F.col("id").alias("other"), F.col("x").alias("ox"), F.col("y").alias("oy"))
    return spatial.points_near_points(t.wells.select("id", "x", "y"), near, 10.0).select("id", "other")


@query("geo_04_overlaps", """SELECT a.id, b.id AS b_id FROM {buildings} a JOIN {buildings} b ON a.id < b.id
    AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy
    WHERE NOT (a.minx <= b.minx AND a.maxx >= b.maxx AND a.miny <= b.miny AND a.maxy >= b.maxy)
      AND NOT (b.minx <= a.minx AND b.maxx >= a.maxx AND b.miny <= a.miny AND b.maxy >= a.maxy)""")
def _(t: Tables) -> DataFrame:
    shapes = t.buildings.select("id", "minx", "miny", "maxx", "maxy", "rings")
    pairs = spatial.polygon_pairs(shapes, shapes, 0.0, F.col("id") < F.col("b_id"))
    return pairs.filter(overlap.overlaps("rings", "b_rings")).select("id", "b_id")


# Buildings as an L (upper right quarter left out), a frame (middle left out) or a box, by id; each a set of quarter boxes.
CORNERED = """SELECT id, id % 3 AS form, minx AS x0, miny AS y0, minx + 2 * (p - 1) + 8 AS x1, miny + 2 * (p - 1) + 8 AS y1
    FROM (SELECT *, 1 + id % 5 AS p FROM {buildings})"""
IN_FORM = """(x > {s}_x0 AND x < {s}_x1 AND y > {s}_y0 AND y < {s}_y1 AND NOT ({s}_form = 0 AND x > {s}_x0 + 4 AND y > {s}_y0 + 4)
    AND NOT ({s}_form = 1 AND x > {s}_x0 + 2 AND x < {s}_x1 - 2 AND y > {s}_y0 + 2 AND y < {s}_y1 - 2))"""


@query("geo_04_overlaps_of_any_form", f"""WITH c AS ({CORNERED}),
    q AS (SELECT a.id, b.id AS b_id, a.form AS a_form, a.x0 AS a_x0, a.y0 AS a_y0, a.x1 AS a_x1, a.y1 AS a_y1,
                 b.form AS b_form, b.x0 AS b_x0, b.y0 AS b_y0, b.x1 AS b_x1, b.y1 AS b_y1,
                 unnest(range(CAST(least(a.x0, b.x0) AS BIGINT), CAST(greatest(a.x1, b.x1) AS BIGINT))) + 0.5 AS x
          FROM c a JOIN c b ON a.id < b.id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
    r AS (SELECT *, unnest(range(CAST(least(a_y0, b_y0) AS BIGINT), CAST(greatest(a_y1, b_y1) AS BIGINT))) + 0.5 AS y FROM q),
    f AS (SELECT id, b_id, {IN_FORM.format(s='a')} AS in_a, {IN_FORM.format(s='b')} AS in_b FROM r)
    SELECT id, b_id FROM f GROUP BY 1, 2 HAVING bool_or(in_a AND in_b) AND bool_or(in_a AND NOT in_b) AND bool_or(in_b AND NOT in_a)""")
def _(t: Tables) -> DataFrame:
    """Concave shapes and shapes with holes; one inside another's hole or notch does not overlap it."""
    at = lambda x, y: f"named_struct('x', x0 + {x}D, 'y', y0 + {y}D)"
    placed = t.buildings.selectExpr("id", "id % 3 AS form", "minx AS x0", "miny AS y0", "8D + 2D * (id % 5) AS side")
    whole = "array(array({}))"
    ring = lambda points: ", ".join(points)
    box = [at(0, 0), "named_struct('x', x0 + side, 'y', y0)", "named_struct('x', x0 + side, 'y', y0 + side)", "named_struct('x', x0, 'y', y0 + side)", at(0, 0)]
    ell = [at(0, 0), "named_struct('x', x0 + side, 'y', y0)", "named_struct('x', x0 + side, 'y', y0 + 4D)", at(4, 4),
           "named_struct('x', x0 + 4D, 'y', y0 + side)", "named_struct('x', x0, 'y', y0 + side)", at(0, 0)]
    hole = [at(2, 2), "named_struct('x', x0 + side - 2D, 'y', y0 + 2D)", "named_struct('x', x0 + side - 2D, 'y', y0 + side - 2D)",
            "named_struct('x', x0 + 2D, 'y', y0 + side - 2D)", at(2, 2)]
    frame = f"array(array({ring(box)}), array({ring(hole)}))"
    rings = F.expr(f"CASE form WHEN 0 THEN {whole.format(ring(ell))} WHEN 1 THEN {frame} ELSE {whole.format(ring(box))} END")
    shapes = spatial.with_bounds(placed.select("id", rings.alias("rings")))
    pairs = spatial.polygon_pairs(shapes, shapes, 0.0, F.col("id") < F.col("b_id"))
    return pairs.filter(overlap.overlaps("rings", "b_rings")).select("id", "b_id")


@query("geo_05_centroid", "SELECT id, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM {buildings}")
def _(t: Tables) -> DataFrame:
    return t.buildings.select("id", *[F.round(c, 6).alias(n) for n, c in geo.centroid("rings").items()])


@query("geo_06_hull_bounds", """SELECT site_id, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy
    FROM {wells} WHERE site_id IS NOT NULL GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    shapes = cluster.hulls(t.wells.filter("site_id is not null").select("site_id", "x", "y"), "site_id")
    return shapes.select("site_id", *[c.alias(n) for n, c in geo.bounds("rings").items()])


# Edges of convex hulls: pairs of places of a key with no place to the right of them, and those on their line between them.
HULL_EDGES = """he AS (SELECT a.k, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS by_ FROM pt a JOIN pt b ON b.k = a.k AND (a.x <> b.x OR a.y <> b.y)
        JOIN pt c ON c.k = a.k GROUP BY 1, 2, 3, 4, 5
        HAVING min((b.x - a.x) * (c.y - a.y) - (c.x - a.x) * (b.y - a.y)) >= 0
           AND bool_and((b.x - a.x) * (c.y - a.y) - (c.x - a.x) * (b.y - a.y) <> 0
                        OR ((c.x - a.x) * (c.x - b.x) + (c.y - a.y) * (c.y - b.y)) <= 0)),
    ho AS (SELECT k, min(x) AS x0, min(y) AS y0 FROM pt GROUP BY 1),
    ht AS (SELECT he.k, (ax - x0) * (by_ - y0) - (bx - x0) * (ay - y0) AS turn, ax + bx - 2 * x0 AS sx, ay + by_ - 2 * y0 AS sy, x0, y0,
                 sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS length, atan2(-(bx - ax), by_ - ay) / (pi() / 16) AS heading FROM he JOIN ho ON ho.k = he.k)"""


@query("geo_06_hulls", f"""WITH pt AS (SELECT DISTINCT site_id AS k, x, y FROM {{wells}} WHERE site_id IS NOT NULL), {HULL_EDGES}
    SELECT ho.k AS site_id, CAST(greatest(count(ht.k), 1) AS BIGINT) AS corners, round(coalesce(sum(turn) / 2, 0), 3) AS area,
           CASE WHEN sum(turn) > 0 THEN round(ho.x0 + sum(sx * turn) / (3 * sum(turn)), 3) END AS cx,
           CASE WHEN sum(turn) > 0 THEN round(ho.y0 + sum(sy * turn) / (3 * sum(turn)), 3) END AS cy
    FROM ho LEFT JOIN ht ON ht.k = ho.k GROUP BY ho.k, ho.x0, ho.y0""")
def _(t: Tables) -> DataFrame:
    """Corners, area and centroid of the hulls themselves."""
    shapes = cluster.hulls(t.wells.filter("site_id is not null").select("site_id", "x", "y"), "site_id")
    measured = shapes.select("site_id", (F.size(F.col("rings")[0]) - 1).cast("bigint").alias("corners"), _outline("rings")["area"].alias("area"),
                             *[c.alias(n) for n, c in geo.centroid("rings").items()])
    return measured.withColumns({c: F.when(F.col("area") > 0, F.round(c, 3)) for c in ("cx", "cy")})


@query("geo_07_buffer_bounds", "SELECT id, x - 6 AS minx, y - 6 AS miny, x + 6 AS maxx, y + 6 AS maxy FROM {wells}")
def _(t: Tables) -> DataFrame:
    rings = t.wells.select("id", geo.buffer("x", "y", 6.0).alias("rings"))
    return rings.select("id", *[F.round(c, 6).alias(n) for n, c in geo.bounds("rings").items()])


@query("geo_08_union_parts", """SELECT w.owner_id, count(DISTINCT w.id) AS parts FROM {wells} w GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    """A union is the list of its parts: here of the circles around an owner's wells."""
    circles = t.wells.select("owner_id", geo.buffer("x", "y", 6.0)[0].alias("ring"))
    return circles.groupBy("owner_id").agg(F.count("ring").alias("parts"))


@query("geo_08_union_area", """SELECT a.id, b.id AS b_id, (a.maxx - a.minx) * (a.maxy - a.miny) + (b.maxx - b.minx) * (b.maxy - b.miny)
      - (least(a.maxx, b.maxx) - greatest(a.minx, b.minx)) * (least(a.maxy, b.maxy) - greatest(a.miny, b.miny)) AS area
    FROM {buildings} a JOIN {buildings} b ON a.id < b.id AND a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy""")
def _(t: Tables) -> DataFrame:
    """Area of the dissolved union of two buildings that overlap, or of which one holds the other."""
    shapes = t.buildings.select("id", "minx", "miny", "maxx", "maxy", "rings")
    pairs = spatial.polygon_pairs(shapes, shapes, 0.0, F.col("id") < F.col("b_id"))
    meet = (F.col("minx") < F.col("b_maxx")) & (F.col("b_minx") < F.col("maxx")) & (F.col("miny") < F.col("b_maxy")) & (F.col("b_miny") < F.col("maxy"))
    measured = pairs.filter(meet).withColumn("u", overlap.union_measure(F.concat("rings", "b_rings")))
    return measured.select("id", "b_id", F.round("u.area", 6).alias("area"))


def _outline(rings: str) -> dict:
    """Area, length and corners of closed rings, and outer rings less holes."""
    edge = geo.edges_sql(rings)
    doubled = "aggregate(zip_with(slice({r}, 1, size({r}) - 1), slice({r}, 2, size({r}) - 1), (_a, _b) -> _a.x * _b.y - _b.x * _a.y), 0D, (_t, _v) -> _t + _v)"
    return {
        "area": F.round(F.expr(f"aggregate(transform({rings}, _r -> {doubled.format(r='_r')}), 0D, (_t, _v) -> _t + _v) / 2"), 3),
        "length": F.round(F.expr(f"aggregate({edge}, 0D, (_t, _e) -> _t + abs(_e.a.x - _e.b.x) + abs(_e.a.y - _e.b.y))"), 3),
        "corners": F.expr(f"CAST(size(flatten({rings})) - size({rings}) AS BIGINT)"),
        "outer_less_holes": F.expr(f"CAST(aggregate(transform({rings}, _r -> sign({doubled.format(r='_r')})), 0D, (_t, _v) -> _t + _v) AS BIGINT)"),
    }


# Boxes have whole coordinates, so a union is a set of unit squares. Its corners follow from the four squares around each
# point; turning left less turning right is four times the outer rings less the holes.
OUTLINE = """u AS (SELECT DISTINCT k, x, unnest(range(CAST(miny AS BIGINT), CAST(maxy AS BIGINT))) AS y
        FROM (SELECT k, miny, maxy, unnest(range(CAST(minx AS BIGINT), CAST(maxx AS BIGINT))) AS x FROM box)),
    nb AS (SELECT a.k, a.x, a.y, r.k IS NOT NULL AS has_r, t.k IS NOT NULL AS has_t FROM u a
        LEFT JOIN u r ON r.k = a.k AND r.x = a.x + 1 AND r.y = a.y LEFT JOIN u t ON t.k = a.k AND t.x = a.x AND t.y = a.y + 1),
    measured AS (SELECT k, count(*) AS area, 4 * count(*) - 2 * count_if(has_r) - 2 * count_if(has_t) AS length FROM nb GROUP BY 1),
    quad AS (SELECT k, x + dx AS x, y + dy AS y, count(*) AS n, sum(CASE WHEN dx = dy THEN 1 ELSE 0 END) AS d
        FROM u CROSS JOIN (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(dx, dy)) GROUP BY 1, 2, 3),
    turned AS (SELECT k, sum(CASE WHEN n IN (1, 3) THEN 1 WHEN n = 2 AND d <> 1 THEN 2 ELSE 0 END) AS corners,
        sum(CASE WHEN n = 1 THEN 1 WHEN n = 3 THEN -1 WHEN n = 2 AND d <> 1 THEN 2 ELSE 0 END) / 4 AS outer_less_holes FROM quad GROUP BY 1)
    SELECT k AS {name}, CAST(area AS DOUBLE) AS area, CAST(length AS DOUBLE) AS length, CAST(corners AS BIGINT) AS corners,
           CAST(outer_less_holes AS BIGINT) AS outer_less_holes FROM measured JOIN turned USING (k)"""


def _outline_sql(name: str) -> str:
    return OUTLINE.replace("{name}", name)


@query("geo_08_dissolved", f"WITH box AS (SELECT brand AS k, minx, miny, maxx, maxy FROM {{buildings}}), {_outline_sql('brand')}")
def _(t: Tables) -> DataFrame:
    """The buildings of a brand dissolved: their boundary with holes."""
    shapes = dissolve(t.buildings.select("brand", "rings"), ["brand"])
    return shapes.select("brand", *[c.alias(n) for n, c in _outline("rings").items()])


@query("geo_09_parts", """SELECT id, 1 AS part, minx, maxy FROM {buildings} UNION ALL SELECT id, 2, minx + 100, maxy FROM {buildings}""")
def _(t: Tables) -> DataFrame:
    """Two polygons of each building, as one geometry and as rows again; the second lies further east."""
    second = geo.box(F.col("minx") + 100, F.col("miny"), F.col("maxx") + 100, F.col("maxy"))
    many = t.buildings.select("id", F.col("minx").alias("at"), F.array("rings", second).alias("many"))
    rows = many.select("id", "at", geo.parts("many").alias("rings")).select("id", "at", *[c.alias(n) for n, c in geo.bounds("rings").items()])
    return rows.select("id", F.when(F.col("minx") > F.col("at"), 2).otherwise(1).alias("part"), "minx", "maxy")


@query("geo_09_polygons_only", """SELECT id, minx + 100 * part AS minx, maxy FROM {buildings},
    (SELECT unnest([0, 1]) AS part) WHERE id % 3 <> 0""")
def _(t: Tables) -> DataFrame:
    """Texts of many polygons, and points among them, which are no polygons and have no parts."""
    second = geo.box(F.col("minx") + 100, F.col("miny"), F.col("maxx") + 100, F.col("maxy"))
    ring = lambda rings: F.regexp_replace(geo.rings_to_wkt(rings), "^POLYGON", "")
    many = F.concat(F.lit("MULTIPOLYGON("), ring(F.col("rings")), F.lit(","), ring(second), F.lit(")"))
    texts = t.buildings.select("id", F.when(F.col("id") % 3 == 0, geo.point_to_wkt("minx", "miny")).otherwise(many).alias("wkt"))
    parts = geo.polygon_rows(texts, "wkt")
    return parts.select("id", *[geo.bounds("rings")[n].alias(n) for n in ("minx", "maxy")])


@query("geo_10_wkt", """SELECT id, 'POLYGON((' || CAST(minx AS BIGINT) || ' ' || CAST(miny AS BIGINT) || ',' || CAST(maxx AS BIGINT) || ' ' ||
    CAST(miny AS BIGINT) || ',' || CAST(maxx AS BIGINT) || ' ' || CAST(maxy AS BIGINT) || ',' || CAST(minx AS BIGINT) || ' ' ||
    CAST(maxy AS BIGINT) || ',' || CAST(minx AS BIGINT) || ' ' || CAST(miny AS BIGINT) || '))' AS wkt, 'POLYGON' AS kind FROM {buildings}""")
def _(t: Tables) -> DataFrame:
    """To text, back to rings and to text again."""
    text = t.buildings.select("id", geo.rings_to_wkt("rings").alias("wkt"))
    back = text.select("id", geo.rings_from_wkt("wkt").alias("rings"), geo.geometry_type("wkt").alias("kind"))
    return back.select("id", geo.rings_to_wkt("rings").alias("wkt"), "kind")


# Joins with areas and polygons.

AREA_OF = f"""SELECT p.id, min(b.vollcode) AS found FROM {{wells}} p LEFT JOIN {{areas}} b ON {COVERED} GROUP BY 1"""


@query("jn_03_area_code", AREA_OF)
def _(t: Tables) -> DataFrame:
    return spatial.area_code(t.wells.select("id", "x", "y"), t.areas, "vollcode", "found").select("id", "found")


@query("jn_03_area_code_large_layer", AREA_OF)
def _(t: Tables) -> DataFrame:
    """The same over cells much smaller than the areas."""
    return spatial.area_code(t.wells.select("id", "x", "y"), t.areas, "vollcode", "found", size=100.0).select("id", "found")


@query("jn_04_fill_area_code", f"""SELECT p.seq_id, p.site_id, coalesce(CASE WHEN p.valid THEN p.stadsdeel END, min(b.code)) AS stadsdeel
    FROM (SELECT *, row_number() OVER () AS rn FROM {{measurements}}) p LEFT JOIN {{districts}} b ON {COVERED}
    GROUP BY p.rn, p.seq_id, p.site_id, p.valid, p.stadsdeel""")
def _(t: Tables) -> DataFrame:
    rows = t.measurements.withColumn("stadsdeel", F.when(F.col("valid"), F.col("stadsdeel")))
    return spatial.fill_area_code(rows, t.districts, "code", "stadsdeel").select("seq_id", "site_id", "stadsdeel")


def _layers(t: Tables) -> dict:
    layers = {"bins": (t.bins.select(F.col("id").alias("object_id"), "x", "y"), 1.0)}
    for kind, reach in (("SMALL", 1.0), ("ECONOMY", 4.0), ("LARGE", 4.0), ("MEDIUM", 4.0), ("PROMO", 4.0), ("STANDARD", 4.0)):
        layers[kind] = (t.buildings.filter(F.col("kind") == kind).select(F.col("id").alias("object_id"), "rings"), reach)
    layers["mooring"] = (t.moorings.select(F.col("id").alias("object_id"), "rings"), 4.0)
    layers["street"] = (t.streets.select(F.col("id").alias("object_id"), "rings"), 4.0)
    return layers


MATCHED = f"""
    SELECT p.id AS well_id, q.id AS object_id, 'bins' AS layer,
           sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS distance
    FROM {{wells}} p JOIN {{bins}} q ON q.x BETWEEN p.x - 1 AND p.x + 1 AND q.y BETWEEN p.y - 1 AND p.y + 1
    WHERE (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) <= 1
    UNION ALL SELECT p.id, b.id, b.kind, {POINT_BOX} FROM {{wells}} p JOIN {{buildings}} b
    ON p.x BETWEEN b.minx - 4 AND b.maxx + 4 AND p.y BETWEEN b.miny - 4 AND b.maxy + 4
    WHERE {POINT_BOX} <= CASE b.kind WHEN 'SMALL' THEN 1 ELSE 4 END
    UNION ALL SELECT p.id, b.id, 'mooring', {POINT_BOX} FROM {{wells}} p JOIN {{moorings}} b
    ON p.x BETWEEN b.minx - 4 AND b.maxx + 4 AND p.y BETWEEN b.miny - 4 AND b.maxy + 4 WHERE {POINT_BOX} <= 4
    UNION ALL SELECT p.id, b.id, 'street', {POINT_BOX} FROM {{wells}} p JOIN {{streets}} b
    ON p.x BETWEEN b.minx - 4 AND b.maxx + 4 AND p.y BETWEEN b.miny - 4 AND b.maxy + 4 WHERE {POINT_BOX} <= 4"""


@query("jn_05_match_layers", MATCHED)
def _(t: Tables) -> DataFrame:
    return spatial.match_layers(t.wells, _layers(t)).select("well_id", "object_id", "layer", "distance")


@query("jn_06_well_objects", f"""WITH m AS ({MATCHED}) SELECT well_id, layer,
    CASE WHEN layer <> 'bins' THEN object_id END AS polygon_id,
    CASE WHEN layer = 'bins' THEN object_id END AS point_id FROM m""")
def _(t: Tables) -> DataFrame:
    return spatial.well_objects(cut(spatial.match_layers(t.wells, _layers(t))))


@query("set_01_union_sorted", f"WITH m AS ({MATCHED}) SELECT well_id, layer, object_id FROM m")
def _(t: Tables) -> DataFrame:
    return spatial.match_layers(t.wells, _layers(t)).orderBy("well_id", "layer", "object_id").select(
        "well_id", "layer", "object_id")


@query("jn_07_building_wells", f"""SELECT id, well_id, distance FROM (
    SELECT b.id, p.id AS well_id, {POINT_BOX} AS distance,
           row_number() OVER (PARTITION BY b.id ORDER BY {POINT_BOX}, p.id) AS rn
    FROM {{buildings}} b CROSS JOIN {{wells}} p) WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    return service.buildings_to_wells(t.buildings, t.wells)


@query("jn_08_building_fractions", f"""SELECT id, fractie, well_id, distance FROM (
    SELECT b.id, p.fractie, p.id AS well_id, {POINT_BOX} AS distance,
           row_number() OVER (PARTITION BY b.id, p.fractie ORDER BY {POINT_BOX}, p.id) AS rn
    FROM {{buildings}} b CROSS JOIN (
        SELECT DISTINCT c.waste_name AS fractie, w.id, w.x, w.y FROM {{wells}} w JOIN {{containers}} c ON c.well_id = w.id
        WHERE c.active = 1 AND c.waste_name IN ('Rest', 'Glas', 'Papier', 'Textiel', 'Wormen', 'Plastic', 'KCA')) p) WHERE rn = 1""")
def _(t: Tables) -> DataFrame:
    return service.buildings_to_fractions(t.buildings, t.wells, t.containers)


def _shapes(t: Tables) -> DataFrame:
    """Site boxes in the form of cluster shapes."""
    return t.site_boxes.select("id", "rings", F.col("x").alias("cx"), F.col("y").alias("cy"),
                               F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"))


@query("jn_09_cluster_areas", f"""SELECT p.id, min(d.code) AS stadsdeel, min(b.code) AS buurt_code FROM {{sites}} p
    LEFT JOIN {{areas}} b ON {COVERED}
    LEFT JOIN {{districts}} d ON p.x BETWEEN d.minx AND d.maxx AND p.y BETWEEN d.miny AND d.maxy GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return st.cluster_areas(_shapes(t), t.districts, t.areas).select("id", "stadsdeel", "buurt_code")


def _address_sql(only_used: str) -> str:
    return f"""WITH s AS (SELECT * FROM (
        SELECT a.id, a.x, a.y, a.minx, a.miny, a.maxx, a.maxy, b.display AS straatnaam,
               row_number() OVER (PARTITION BY a.id ORDER BY {BOX_BOX}, b.id) AS rn
        FROM {{site_boxes}} a CROSS JOIN {{streets}} b WHERE b.opr_type = 'Weg' {only_used}) WHERE rn = 1)
    SELECT id, straatnaam, huisnummer, distance FROM (
        SELECT b.id, b.straatnaam, p.huisnummer,
               CAST(round_even(sqrt((b.x - p.x) * (b.x - p.x) + (b.y - p.y) * (b.y - p.y)), 0) AS BIGINT) AS distance,
               row_number() OVER (PARTITION BY b.id ORDER BY {POINT_BOX}, p.id) AS rn
        FROM s b JOIN {{addresses}} p ON p.street = b.straatnaam) WHERE rn = 1"""


@query("jn_10_street_addresses", _address_sql(""))
def _(t: Tables) -> DataFrame:
    return st.street_addresses(_shapes(t), t.streets, t.addresses, key="id").select(
        "id", "straatnaam", "huisnummer", "distance")


@query("jn_11_used_street_addresses", _address_sql("AND b.display IN (SELECT street FROM {addresses})"))
def _(t: Tables) -> DataFrame:
    return st.street_addresses(_shapes(t), t.streets, t.addresses, True, "id").select(
        "id", "straatnaam", "huisnummer", "distance")


IN_SITE = f"""SELECT p.id, min(b.id) AS site_id FROM {{wells}} p LEFT JOIN {{site_boxes}} b ON {STRICT} GROUP BY 1"""


@query("jn_12_wells_in_sites", IN_SITE)
def _(t: Tables) -> DataFrame:
    return st.wells_in_sites(t.wells, t.site_boxes).select("id", "site_id")


@query("jn_13_wells_in_sites_keep", f"""WITH f AS ({IN_SITE}) SELECT w.id, coalesce(w.site_id, f.site_id) AS site_id
    FROM {{wells}} w JOIN f ON f.id = w.id""")
def _(t: Tables) -> DataFrame:
    return st.wells_in_sites(t.wells, t.site_boxes, keep=True).select("id", "site_id")


def _flag_sql(hit: str) -> str:
    return f"SELECT p.id, EXISTS (SELECT 1 FROM {hit}) AS flagged FROM {{wells}} p"


def _attributes(t: Tables) -> DataFrame:
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return t.wells.withColumn("extra_attributes", empty)


def _flagged(df: DataFrame, key: str) -> DataFrame:
    return df.select("id", F.coalesce(F.try_element_at("extra_attributes", F.lit(key)) == "true", F.lit(False)).alias("flagged"))


@query("jn_15_wells_in_buildings", _flag_sql(f"{{buildings}} b WHERE {STRICT}"))
def _(t: Tables) -> DataFrame:
    return _flagged(service.wells_in_buildings(_attributes(t), t.buildings), "in_pand")


@query("jn_16_wells_in_roads", _flag_sql(f"{{streets}} b WHERE {STRICT}"))
def _(t: Tables) -> DataFrame:
    return _flagged(service.wells_in_roads(_attributes(t), t.streets), "in_wegdeel")


@query("jn_17_wells_without_bin", """SELECT p.id, NOT EXISTS (SELECT 1 FROM {bins} b
    WHERE (p.x - b.x) * (p.x - b.x) + (p.y - b.y) * (p.y - b.y) <= 1) AS flagged FROM {wells} p""")
def _(t: Tables) -> DataFrame:
    return _flagged(service.wells_without_bin(_attributes(t), t.bins), "missing_bgt_afval")


BOXES_MEET = "a.minx < b.maxx AND b.minx < a.maxx AND a.miny < b.maxy AND b.miny < a.maxy AND (a.minx <> b.minx OR a.miny <> b.miny)"


def _built(t: Tables) -> DataFrame:
    return t.site_boxes.select(
        "id", "bgt_based", F.lit(None).cast("int").alias("active"), "straatnaam", "huisnummer", "distance", "x", "y", "rings")


@query("jn_18_merge_overlapping", f"""WITH o AS (SELECT a.id, b.id AS b_id, b.bgt_based FROM {{site_boxes}} a JOIN {{site_boxes}} b
        ON a.id <> b.id AND {BOXES_MEET} WHERE a.bgt_based)
    SELECT s.id, CASE WHEN s.id IN (SELECT id FROM o) THEN 4 END AS active,
           1 + (SELECT count(*) FROM o WHERE o.id = s.id) AS parts
    FROM {{site_boxes}} s WHERE s.id NOT IN (SELECT b_id FROM o WHERE NOT bgt_based)""")
def _(t: Tables) -> DataFrame:
    return st.merge_overlapping(_built(t)).select("id", "active", "parts")


MERGED = f"""o AS (SELECT a.id, b.id AS b_id, b.bgt_based, b.minx, b.miny, b.maxx, b.maxy FROM {{site_boxes}} a JOIN {{site_boxes}} b
        ON a.id <> b.id AND {BOXES_MEET} WHERE a.bgt_based),
    stay AS (SELECT * FROM {{site_boxes}} WHERE id NOT IN (SELECT b_id FROM o WHERE NOT bgt_based)),
    box AS (SELECT id, minx, miny, maxx, maxy FROM stay UNION ALL SELECT id, minx, miny, maxx, maxy FROM o WHERE id IN (SELECT id FROM stay))"""


@query("jn_18_merged_centroids", f"""WITH {MERGED}, two AS (SELECT id FROM box GROUP BY id HAVING count(*) = 2),
    p AS (SELECT s.*, greatest(s.minx, o.minx) AS ix0, least(s.maxx, o.maxx) AS ix1, greatest(s.miny, o.miny) AS iy0,
                 least(s.maxy, o.maxy) AS iy1, (o.minx + o.maxx) / 2 AS ox, (o.miny + o.maxy) / 2 AS oy
          FROM stay s JOIN two USING (id) JOIN o ON o.id = s.id),
    q AS (SELECT *, (ix1 - ix0) * (iy1 - iy0) AS shared FROM p)
    SELECT id, round((3600 * x + 3600 * ox - shared * (ix0 + ix1) / 2) / (7200 - shared), 4) AS x,
           round((3600 * y + 3600 * oy - shared * (iy0 + iy1) / 2) / (7200 - shared), 4) AS y FROM q""")
def _(t: Tables) -> DataFrame:
    """Centroids of sites that took in one other: those of the dissolved union."""
    merged = st.merge_overlapping(_built(t)).filter("parts = 2")
    return merged.select("id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("jn_18_merged_outlines", f"WITH {MERGED}, box2 AS (SELECT id AS k, minx, miny, maxx, maxy FROM box), {_outline_sql('id').replace('FROM box)', 'FROM box2)')}")
def _(t: Tables) -> DataFrame:
    """The shapes of all sites after merging: boundaries of dissolved unions, or their own box."""
    return st.merge_overlapping(_built(t)).select("id", *[c.alias(n) for n, c in _outline("rings").items()])


@query("jn_20_merged_moorings", f"""WITH {MERGED}, d AS (SELECT a.id, b.id AS mooring, b.street, min({BOX_BOX}) AS near
        FROM box a CROSS JOIN {{moorings}} b WHERE a.id IN (SELECT site_id FROM {{wells}}) GROUP BY 1, 2, 3),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY near, mooring) AS rn FROM d) WHERE rn = 1)
    SELECT s.id, CASE WHEN round_even(n.near, 0) - s.distance < -10 THEN n.street ELSE s.straatnaam END AS straatnaam,
           CASE WHEN round_even(n.near, 0) - s.distance < -10 THEN CAST(round_even(n.near, 0) AS BIGINT) ELSE s.distance END AS distance
    FROM stay s LEFT JOIN n ON n.id = s.id""")
def _(t: Tables) -> DataFrame:
    """Distances to merged shapes are those to the nearest of their parts."""
    merged = st.merge_overlapping(_built(t))
    return st.readdress(merged, t.wells, t.moorings, 10).select("id", "straatnaam", "distance")


@query("jn_21_merged_addresses", f"""WITH {MERGED}, d AS (SELECT a.id, p.id AS address, p.street, min({POINT_BOX.replace("b.", "a.")}) AS near
        FROM box a CROSS JOIN {{addresses}} p WHERE a.id IN (SELECT site_id FROM {{wells}}) GROUP BY 1, 2, 3),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY near, address) AS rn FROM d) WHERE rn = 1)
    SELECT s.id, CASE WHEN round_even(n.near, 0) - s.distance < -10 THEN n.street ELSE s.straatnaam END AS straatnaam,
           CASE WHEN round_even(n.near, 0) - s.distance < -10 THEN CAST(round_even(n.near, 0) AS BIGINT) ELSE s.distance END AS distance
    FROM stay s LEFT JOIN n ON n.id = s.id""")
def _(t: Tables) -> DataFrame:
    merged = st.merge_overlapping(_built(t))
    return st.readdress(merged, t.wells, t.addresses, 10).select("id", "straatnaam", "distance")


@query("jn_28_merged_supplier_sites", f"""WITH {MERGED}, d AS (SELECT p.id, b.id AS site, min({POINT_BOX}) AS near
        FROM {{supplier_points}} p CROSS JOIN box b GROUP BY 1, 2),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY near, site) AS rn FROM d) WHERE rn = 1)
    SELECT p.id, CASE WHEN round_even(n.near, 0) < 30 THEN s.num END AS site_id
    FROM {{supplier_points}} p LEFT JOIN n ON n.id = p.id LEFT JOIN {{site_boxes}} s ON s.id = n.site""")
def _(t: Tables) -> DataFrame:
    merged = st.merge_overlapping(_built(t)).join(t.site_boxes.select("id", F.col("num").alias("short_id")), "id")
    return st.supplier_sites(t.supplier_points, merged).select("id", "site_id")


@query("jn_19_merge_close", f"""WITH RECURSIVE a AS (SELECT p.*, b.vollcode FROM {{site_boxes}} p JOIN {{areas}} b
        ON p.x BETWEEN b.minx AND b.maxx AND p.y BETWEEN b.miny AND b.maxy),
    e AS (SELECT a.id, b.id AS other FROM a JOIN a b ON a.vollcode = b.vollcode AND a.id <> b.id WHERE {BOX_BOX} <= 5),
    r(id, other) AS (SELECT id, other FROM e UNION SELECT r.id, e.other FROM r JOIN e ON e.id = r.other),
    g AS (SELECT id, max(other) AS top FROM r GROUP BY 1)
    SELECT s.id, CASE WHEN g.id IS NOT NULL THEN 5 END AS active FROM {{site_boxes}} s LEFT JOIN g ON g.id = s.id
    WHERE g.id IS NULL OR g.top <= s.id""")
def _(t: Tables) -> DataFrame:
    layer = t.areas.select(F.col("vollcode").alias("object_id"), "rings")
    return st.merge_close(_built(t), layer).select("id", "active")


def _readdress_sql(places: str, measure: str, rule: str) -> str:
    return f"""WITH n AS (SELECT * FROM (
        SELECT a.id, {places}.street, {places}.huisnummer, CAST(round_even({measure}, 0) AS BIGINT) AS near,
               row_number() OVER (PARTITION BY a.id ORDER BY {measure}, {places}.id) AS rn
        FROM {{{{site_boxes}}}} a CROSS JOIN {{{{{'moorings' if places == 'b' else 'addresses'}}}}} {places}
        WHERE a.id IN (SELECT site_id FROM {{{{wells}}}})) WHERE rn = 1)
    SELECT s.id, CASE WHEN {rule} THEN n.street ELSE s.straatnaam END AS straatnaam,
           CASE WHEN {rule} THEN n.huisnummer ELSE s.huisnummer END AS huisnummer,
           CASE WHEN {rule} THEN n.near ELSE s.distance END AS distance
    FROM {{{{site_boxes}}}} s LEFT JOIN n ON n.id = s.id""".replace("{{", "{").replace("}}", "}")


@query("jn_20_mooring_addresses", _readdress_sql("b", BOX_BOX, "n.near - s.distance < -10"))
def _(t: Tables) -> DataFrame:
    return st.readdress(_built(t), t.wells, t.moorings, 10).select("id", "straatnaam", "huisnummer", "distance")


@query("jn_21_near_addresses", _readdress_sql("p", POINT_BOX.replace("b.", "a."), "(n.near - s.distance < -60 AND n.near < 20)"))
def _(t: Tables) -> DataFrame:
    return st.readdress(_built(t), t.wells, t.addresses, 60, 20).select("id", "straatnaam", "huisnummer", "distance")


SUPPLIER = f"""SELECT p.id, p.name, x.short_id AS site_id FROM {{supplier_points}} p LEFT JOIN (
    SELECT * FROM (SELECT p.id, b.short_id, {POINT_BOX} AS d, row_number() OVER (PARTITION BY p.id ORDER BY {POINT_BOX}, b.id) AS rn
    FROM {{supplier_points}} p CROSS JOIN {{site_boxes}} b) WHERE rn = 1 AND round_even(d, 0) < 30) x ON x.id = p.id"""


@query("jn_28_supplier_sites", SUPPLIER)
def _(t: Tables) -> DataFrame:
    return st.supplier_sites(t.supplier_points, t.site_boxes).select("id", "name", "site_id")


@query("jn_29_weighings_at_sites", """SELECT m.seq_id, m.net_weight, s.short_id FROM {measurements} m JOIN {sites} s
    ON m.x BETWEEN s.x - 17 AND s.x + 17 AND m.y BETWEEN s.y - 17 AND s.y + 17
    WHERE (m.x - s.x) * (m.x - s.x) + (m.y - s.y) * (m.y - s.y) <= 289""")
def _(t: Tables) -> DataFrame:
    return service.weighings_at_sites(t.sites, t.measurements).select("seq_id", "net_weight", "short_id")


@query("jn_30_fill_level_sites", f"""WITH s AS ({SUPPLIER}) SELECT event_id, CASE WHEN value > 400 THEN 7 ELSE s.site_id END AS site_id
    FROM {{events}} JOIN s ON s.id = event_id % (SELECT count(*) FROM {{part}})""")
def _(t: Tables) -> DataFrame:
    parts = t.part.count()
    names = t.supplier_points.select(F.col("id").alias("k"), F.col("name").alias("e_site_name"))
    levels = t.events.withColumn("k", F.col("event_id") % parts).join(names, "k").select(
        "event_id", "e_site_name", F.when(F.col("value") > 400, F.lit(7)).cast("bigint").alias("site_id"))
    return st.fill_level_sites(levels, t.supplier_points, t.site_boxes).select("event_id", "site_id")


@query("jn_35_wells_with_buildings", f"SELECT p.id, b.id AS building_id FROM {{wells}} p JOIN {{buildings}} b ON {STRICT}")
def _(t: Tables) -> DataFrame:
    return service.wells_with_buildings(t.wells.select("id", "x", "y"), t.buildings).select("id", "building_id")


@query("jn_36_unserved_bins", f"""WITH lone AS (SELECT p.id, p.x, p.y FROM {{bins}} p WHERE NOT EXISTS (SELECT 1 FROM {{wells}} w
        WHERE w.x BETWEEN p.x - 60 AND p.x + 60 AND w.y BETWEEN p.y - 60 AND p.y + 60
          AND (p.x - w.x) * (p.x - w.x) + (p.y - w.y) * (p.y - w.y) <= 3600)),
    placed AS (SELECT p.id, p.x, p.y, min(b.code) AS stadsdeel FROM lone p JOIN {{districts}} b ON {COVERED} GROUP BY 1, 2, 3),
    near AS (SELECT * FROM (SELECT p.id, a.street || ' ' || a.huisnummer AS adres,
        row_number() OVER (PARTITION BY p.id ORDER BY (p.x - a.x) * (p.x - a.x) + (p.y - a.y) * (p.y - a.y), a.id) AS rn
        FROM placed p CROSS JOIN {{addresses}} a) WHERE rn = 1)
    SELECT p.id, p.stadsdeel, b.display, near.adres FROM placed p JOIN near ON near.id = p.id
    LEFT JOIN {{streets}} b ON {STRICT}""")
def _(t: Tables) -> DataFrame:
    return service.unserved_bins(t.bins, t.wells, t.districts, t.streets, t.addresses, 60.0).select(
        "id", "stadsdeel", "display", "adres")


# Clusters.

def _cluster_sql(points: str, reach: int) -> str:
    return f"""WITH RECURSIVE p AS ({points}),
    e AS (SELECT a.id, b.id AS other FROM p a JOIN p b ON b.x BETWEEN a.x - {reach} AND a.x + {reach}
          AND b.y BETWEEN a.y - {reach} AND a.y + {reach}
          WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {reach * reach}),
    r(id, other) AS (SELECT id, other FROM e UNION SELECT r.id, e.other FROM r JOIN e ON e.id = r.other)
    SELECT id, min(other) AS cluster FROM r GROUP BY 1"""


@query("ag_07_bin_clusters", _cluster_sql(f"""SELECT p.id, p.x, p.y FROM {{bins}} p WHERE EXISTS (
    SELECT 1 FROM {{districts}} b WHERE {STRICT})""", 7))
def _(t: Tables) -> DataFrame:
    return st.bin_clusters(t.bins, t.districts).select("id", "cluster")


@query("ag_08_well_clusters", _cluster_sql("""SELECT id, x, y FROM {wells} w WHERE site_id IS NULL AND active = 1
    AND id IN (SELECT well_id FROM {containers})""", 12))
def _(t: Tables) -> DataFrame:
    return st.well_clusters(t.wells, t.containers).select("id", "cluster")


@query("ag_08_cluster_shapes", _cluster_sql("""SELECT id, x, y FROM {wells} w WHERE site_id IS NULL AND active = 1
    AND id IN (SELECT well_id FROM {containers})""", 12).replace("SELECT id, min(other) AS cluster FROM r GROUP BY 1", """,
    c AS (SELECT id, min(other) AS cluster FROM r GROUP BY 1)
    SELECT cluster, min(x) - 6 AS minx, min(y) - 6 AS miny, max(x) + 6 AS maxx, max(y) + 6 AS maxy FROM c JOIN p USING (id) GROUP BY 1"""))
def _(t: Tables) -> DataFrame:
    """The hull of circles around a cluster's wells ends that far beyond the outermost wells."""
    shapes = st.cluster_hulls(st.well_clusters(t.wells, t.containers), st.WELL_REACH / 2)
    return shapes.select("cluster", *[F.round(c, 6).alias(n) for n, c in geo.bounds("rings").items()])


def _grown_hulls_sql(clusters: str, radius: float) -> str:
    """Area of the hull of 32-cornered circles: that of the hull, of a strip along each edge, and of one circle."""
    return clusters.replace("SELECT id, min(other) AS cluster FROM r GROUP BY 1", f""",
    c AS (SELECT id, min(other) AS cluster FROM r GROUP BY 1), pt AS (SELECT DISTINCT cluster AS k, x, y FROM c JOIN p USING (id)), {HULL_EDGES}
    SELECT ho.k AS cluster, round(coalesce(sum(turn) / 2 + sum(length * {radius} * cos((heading - round(heading)) * pi() / 16)), 0)
        + 16 * {radius * radius} * sin(pi() / 16), 3) AS area FROM ho LEFT JOIN ht ON ht.k = ho.k GROUP BY ho.k""")


@query("ag_07_cluster_hulls", _grown_hulls_sql(_cluster_sql(f"""SELECT p.id, p.x, p.y FROM {{bins}} p WHERE EXISTS (
    SELECT 1 FROM {{districts}} b WHERE {STRICT})""", 7), 3.5))
def _(t: Tables) -> DataFrame:
    shapes = cluster.hulls(st.bin_clusters(t.bins, t.districts), "cluster", 3.5)
    return shapes.select("cluster", _outline("rings")["area"].alias("area"))


@query("ag_08_cluster_hulls", _grown_hulls_sql(_cluster_sql("""SELECT id, x, y FROM {wells} w WHERE site_id IS NULL AND active = 1
    AND id IN (SELECT well_id FROM {containers})""", 12), 6.0))
def _(t: Tables) -> DataFrame:
    shapes = cluster.hulls(st.well_clusters(t.wells, t.containers), "cluster", st.WELL_REACH / 2)
    return shapes.select("cluster", _outline("rings")["area"].alias("area"))


@query("components_of_orders", """WITH RECURSIVE e AS (SELECT DISTINCT c_nationkey AS u, 100 + floor(c_acctbal / 500) AS v FROM {customer}
        WHERE c_mktsegment = 'BUILDING'),
    b AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
    r(u, v) AS (SELECT u, v FROM b UNION SELECT r.u, b.v FROM r JOIN b ON b.u = r.v)
    SELECT u AS node, min(v) AS root FROM r GROUP BY 1 HAVING min(v) < u""")
def _(t: Tables) -> DataFrame:
    pairs = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_nationkey").cast("bigint").alias("u"), (F.floor(F.col("c_acctbal") / 500) + 100).cast("bigint").alias("v"))
    return cluster.components(pairs)


# Sites and short ids.

def _numbered(t: Tables) -> DataFrame:
    return t.site_boxes.select("id", "straatnaam", "huisnummer", "rings",
                               F.lit(None).cast("bigint").alias("short_id"),
                               F.lit(None).cast("map<string,string>").alias("extra_attributes"))


ROADS = "SELECT id AS street_id, display FROM {streets} WHERE opr_type = 'Weg'"
ONE_WELL = "SELECT site_id, min_by(summary, id) AS summary FROM {wells} WHERE site_id IS NOT NULL GROUP BY 1"
PASSES = f"""roads AS ({ROADS}), lw AS ({ONE_WELL}),
    one AS (SELECT s.id, s.straatnaam, s.huisnummer, lw.summary, r.street_id,
                   row_number() OVER (PARTITION BY s.straatnaam, s.huisnummer ORDER BY s.id, r.street_id) AS rn
            FROM {{site_boxes}} s JOIN roads r ON r.display = s.straatnaam JOIN lw ON lw.site_id = s.id),
    p1 AS (SELECT s.id, s.straatnaam, s.huisnummer, CASE WHEN o.id IS NOT NULL THEN
                  TRY_CAST(right(CAST(o.street_id AS VARCHAR), 5) || o.huisnummer AS BIGINT) END AS short_id, o.summary AS chauffeur
           FROM {{site_boxes}} s LEFT JOIN (SELECT * FROM one WHERE rn = 1) o ON o.id = s.id),
    two AS (SELECT s.id, s.huisnummer, lw.summary, r.street_id,
                   row_number() OVER (PARTITION BY s.straatnaam, s.huisnummer ORDER BY s.id, r.street_id) AS rn
            FROM p1 s JOIN roads r ON r.display = s.straatnaam JOIN lw ON lw.site_id = s.id WHERE s.short_id IS NULL),
    p2 AS (SELECT s.id, s.straatnaam, s.huisnummer, CASE WHEN o.id IS NOT NULL THEN
                  TRY_CAST(o.rn || right(CAST(o.street_id AS VARCHAR), 4) || o.huisnummer AS BIGINT) ELSE s.short_id END AS short_id,
                  coalesce(o.summary, s.chauffeur) AS chauffeur
           FROM p1 s LEFT JOIN (SELECT * FROM two WHERE rn > 1) o ON o.id = s.id),
    three AS (SELECT s.id, s.huisnummer, r.street_id,
                     row_number() OVER (PARTITION BY s.straatnaam, s.huisnummer ORDER BY s.id, r.street_id) AS rn
              FROM p2 s JOIN roads r ON r.display = s.straatnaam WHERE s.short_id IS NULL),
    p3 AS (SELECT s.id, s.straatnaam, s.huisnummer, CASE WHEN o.id IS NOT NULL THEN
                  TRY_CAST(o.rn || right(CAST(o.street_id AS VARCHAR), 5) || o.huisnummer AS BIGINT) ELSE s.short_id END AS short_id,
                  s.chauffeur FROM p2 s LEFT JOIN three o ON o.id = s.id),
    near AS (SELECT * FROM (SELECT a.id, b.id AS street_id, b.display, row_number() OVER (PARTITION BY a.id ORDER BY {BOX_BOX}, b.id) AS rn
             FROM {{site_boxes}} a CROSS JOIN {{streets}} b WHERE b.opr_type = 'Weg') WHERE rn = 1),
    four AS (SELECT s.id, s.huisnummer, lw.summary, n.street_id,
                    row_number() OVER (PARTITION BY n.display, s.huisnummer ORDER BY s.id) AS rn
             FROM p3 s JOIN near n ON n.id = s.id JOIN lw ON lw.site_id = s.id),
    p4 AS (SELECT s.id, CASE WHEN s.short_id IS NULL AND o.id IS NOT NULL THEN
                  TRY_CAST(o.rn || right(CAST(o.street_id AS VARCHAR), 5) || o.huisnummer AS BIGINT) ELSE s.short_id END AS short_id,
                  CASE WHEN s.short_id IS NULL AND o.id IS NOT NULL THEN o.summary ELSE s.chauffeur END AS chauffeur
           FROM p3 s LEFT JOIN four o ON o.id = s.id)"""


def _named(df: DataFrame) -> DataFrame:
    return df.select("id", "short_id", F.try_element_at("extra_attributes", F.lit("chauffeur")).alias("chauffeur"))


@query("wn_01_first_at_address", f"WITH {PASSES} SELECT id, short_id, chauffeur FROM p1")
def _(t: Tables) -> DataFrame:
    return _named(shortid.first_at_address(_numbered(t), t.streets, t.wells))


@query("wn_02_others_at_address", f"WITH {PASSES} SELECT id, short_id, chauffeur FROM p2")
def _(t: Tables) -> DataFrame:
    one = shortid.first_at_address(_numbered(t), t.streets, t.wells)
    return _named(shortid.others_at_address(one, t.streets, t.wells))


@query("wn_03_without_well", f"WITH {PASSES} SELECT id, short_id, chauffeur FROM p3")
def _(t: Tables) -> DataFrame:
    one = shortid.first_at_address(_numbered(t), t.streets, t.wells)
    two = shortid.others_at_address(one, t.streets, t.wells)
    return _named(shortid.without_well(two, t.streets))


@query("wn_04_by_nearest_street", f"WITH {PASSES} SELECT id, short_id, chauffeur FROM p4")
def _(t: Tables) -> DataFrame:
    return _named(shortid.short_ids(_numbered(t), t.streets, t.wells))


@query("jn_22_site_streets", f"""SELECT s.id, r.street_id FROM {{sites}} s JOIN ({ROADS}) r ON r.display = s.straatnaam""")
def _(t: Tables) -> DataFrame:
    return links.site_streets(t.sites, t.streets).select("id", "street_id")


@query("jn_23_representative_wells", ONE_WELL)
def _(t: Tables) -> DataFrame:
    return links.representative_wells(t.wells, ["summary"]).select("site_id", "summary")


@query("set_02_union_of_sites", """SELECT id, bgt_based FROM {sites} WHERE bgt_based
    UNION ALL SELECT id, bgt_based FROM {sites} WHERE NOT bgt_based""")
def _(t: Tables) -> DataFrame:
    """The second table holds all sites: a contested id stays map-based."""
    from_map = t.sites.filter("bgt_based").select("id", "bgt_based")
    from_wells = t.sites.select("id", "bgt_based")
    return st.all_sites(from_map, from_wells)


@query("site_key_clashes", "SELECT id FROM {sites} WHERE bgt_based")
def _(t: Tables) -> DataFrame:
    return st.key_clashes(t.sites.filter("bgt_based"), t.sites)


def _map_layers(t: Tables) -> feeds.MapLayers:
    merge = [t.areas.select(F.col("vollcode").alias("object_id"), "rings"),
             t.districts.select(F.col("code").alias("object_id"), "rings"),
             t.streets.select(F.col("id").alias("object_id"), "rings")]
    return feeds.MapLayers(t.districts, t.areas, t.part_bins, t.streets, t.addresses, t.moorings, t.buildings, t.streets,
                           merge, _layers(t))


@query("pl_03_site_clusters")
def _(t: Tables) -> DataFrame:
    built, _wells = feeds.site_clusters(t.wells, t.containers, _map_layers(t))
    return built.select("id", "bgt_based", "active", "stadsdeel", "straatnaam", "huisnummer", "distance", "short_id")


@query("pl_02_site_build")
def _(t: Tables) -> DataFrame:
    tables = feeds.site_build(_attributes(t), t.containers, t.container_types, _map_layers(t),
                              landed.population_pages(t), 2000)
    return tables["report"]


SECOND_SUPPLIER = ("content_types", "container_types", "site_content_types", "sites", "container_slots", "containers")


def _second_supplier(t: Tables) -> dict[str, DataFrame]:
    return feeds.second_supplier({n: landed.collection_pages(t, n) for n in SECOND_SUPPLIER}, t.site_boxes, t.containers)


@query("pl_05_second_supplier", f"""WITH s AS ({SUPPLIER}) SELECT id, site_id FROM s""")
def _(t: Tables) -> DataFrame:
    return _second_supplier(t)["sites"].select("id", "site_id")


@query("pl_05_second_supplier_containers", """SELECT w.id, CASE WHEN w.active = 2 THEN NULL
    ELSE 'RE' || w.id * 5 IN (SELECT id_number FROM {containers}) END AS valid FROM {wells} w""")
def _(t: Tables) -> DataFrame:
    return _second_supplier(t)["containers"].select("id", "valid")


@query("pl_05_second_supplier_tables", """SELECT 'content_types' AS name, p_partkey AS id, concat_ws('/', p_size, p_name) AS fields FROM {part}
    UNION ALL SELECT 'container_types', p_partkey, concat_ws('/', p_size, p_type) FROM {part}
    UNION ALL SELECT 'site_content_types', o_orderkey, concat_ws('/', o_custkey, o_orderpriority) FROM {orders}
    UNION ALL SELECT 'container_slots', o_orderkey, concat_ws('/',
        CASE WHEN o_custkey * 2 IN (SELECT id FROM {supplier_points}) THEN o_custkey * 2 END,
        CASE WHEN o_orderkey * 2 IN (SELECT o_orderkey FROM {orders}) THEN o_orderkey * 2 END) FROM {orders}""")
def _(t: Tables) -> DataFrame:
    """The other four tables of one load."""
    tables = _second_supplier(t)
    fields = {"content_types": ("category", "name"), "container_types": ("volume", "shape"),
              "site_content_types": ("content_type_id", "content_type_name"), "container_slots": ("site_id", "site_content_type_id")}
    rows = [tables[name].select(F.lit(name).alias("name"), "id", F.concat_ws("/", *[F.col(c).cast("string") for c in columns]).alias("fields"))
            for name, columns in fields.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])

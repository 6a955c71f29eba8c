"""Polygons cut into a quadtree give the same joins as whole ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wastelake.functions import geo
from wastelake.operators import spatial


def wavy(cx, cy, radius, n, seed):
    """A closed ring with many corners."""
    rnd = random.Random(seed)
    corners = [(cx + r * math.cos(t), cy + r * math.sin(t)) for i in range(n) for t in [2 * math.pi * i / n] for r in [radius * rnd.uniform(0.8, 1.0)]]
    return corners + corners[:1]


def frame(spark, shapes):
    return spark.createDataFrame([(i, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in enumerate(shapes)],
                                 f"o int, rings {geo.RINGS}")


SHAPES = [
    [wavy(300, 300, 250, 900, 1), wavy(300, 300, 100, 300, 2)],  # a large one with a hole
    [wavy(320, 310, 60, 400, 3)],
    [[(0, 0), (640, 0), (640, 512), (0, 512), (0, 0)]],  # few corners, large, edges on cell lines
    [[(x, y) for x, y in zip([*range(0, 301), *range(300, -1, -1), 0], [*[100] * 301, *[140] * 301, 100])]],  # many corners on straight edges
    [[(500, 500), (503, 500), (503, 503), (500, 503), (500, 500)]],
]


def places():
    rnd = random.Random(7)
    spots = [(rnd.uniform(-20, 660), rnd.uniform(-20, 600)) for _ in range(400)]
    spots += [(float(rnd.randint(-1, 660)), float(rnd.randint(-1, 600))) for _ in range(300)]
    spots += [(x, y) for x in (0.0, 128.0, 256.0, 300.0, 512.0, 640.0) for y in (0.0, 100.0, 120.0, 128.0, 140.0, 256.0, 512.0)]
    return spots + [ring[k] for rings in SHAPES[:2] for ring in rings for k in range(0, len(ring), 60)]


@pytest.fixture(scope="module")
def both(spark):
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places())], "id int, x double, y double")
    return points.cache(), frame(spark, SHAPES).cache()


def pairs(df):
    rows = [tuple(r) for r in df.select("id", "o").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("strict", [True, False])
def test_points_in_pieces(both, strict):
    points, polygons = both
    inside = (geo.contains if strict else geo.covers)("rings", "x", "y")
    want = pairs(points.crossJoin(polygons).filter(inside))
    assert pairs(spatial.points_in_polygons(points, polygons, strict)) == want and len(want) > 500
    ids = {i for i, _ in want}
    semi = spatial.points_in_polygons(points, polygons, strict, 32.0, "left_semi")
    anti = spatial.points_in_polygons(points, polygons, strict, 32.0, "left_anti")
    assert semi.columns == points.columns == anti.columns
    assert sorted(r.id for r in semi.collect()) == sorted(ids)
    assert sorted(r.id for r in anti.collect()) == sorted(set(range(len(places()))) - ids)


@pytest.mark.parametrize("reach", [0.0, 4.0, 30.0])
def test_points_near_pieces(both, reach):
    points, polygons = both
    exact = points.crossJoin(polygons).withColumn("d", geo.point_polygon_distance("x", "y", "rings")).filter(F.col("d") <= reach)
    want = {(r.id, r.o): r.d for r in exact.collect()}
    got = {(r.id, r.o): r.distance for r in spatial.points_near_polygons(points, polygons, reach).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_rows_grow_with_the_boundary_and_not_with_the_area(spark):
    rows = {}
    for radius in (100.0, 1000.0, 100_000.0):
        cut_up = spatial.pieces(frame(spark, [[wavy(0, 0, radius, 6400, 9)]])).cache()
        assert cut_up.agg(F.max(F.size("sides"))).first()[0] <= spatial.CORNERS
        rows[radius] = cut_up.count()
    assert max(rows.values()) < 2 * min(rows.values()) and max(rows.values()) < 6400 / 8
    twice = spatial.pieces(frame(spark, [[wavy(0, 0, 1000.0, 12800, 9)]])).count()
    assert 1.5 < twice / rows[1000.0] < 2.6
    few = spatial.pieces(frame(spark, [[[(0, 0), (1e6, 0), (1e6, 9e5), (0, 9e5), (0, 0)]]]))
    assert few.count() <= 4


def test_pieces_of_one_spot_end(spark):
    """More edges than a piece may have meet in one corner."""
    star = [p for i in range(200) for p in [(0.0, 0.0), (math.cos(i / 40), math.sin(i / 40)), (math.cos((i + 0.4) / 40), math.sin((i + 0.4) / 40))]]
    assert 0 < spatial.pieces(frame(spark, [[star + star[:1]]])).count() < 2000


def test_distance_is_worked_out_once(both):
    points, polygons = both
    plan = spatial.points_near_polygons(points, polygons, 4.0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("SQRT(") == 1


def test_polygon_pairs_of_all_sizes(spark):
    rnd = random.Random(11)
    boxes = []
    for side in (2, 30, 200, 3000):
        boxes += [(x, y, x + rnd.randint(1, side), y + rnd.randint(1, side)) for _ in range(25) for x, y in [(rnd.randint(-500, 500), rnd.randint(-500, 500))]]
    df = spark.createDataFrame([(i, *map(float, b)) for i, b in enumerate(boxes)], "id int, minx double, miny double, maxx double, maxy double")
    for reach in (0.0, 7.0):
        b = np.array(boxes, float)
        near = ((b[:, None, 0] - reach <= b[None, :, 2]) & (b[:, None, 2] + reach >= b[None, :, 0])
                & (b[:, None, 1] - reach <= b[None, :, 3]) & (b[:, None, 3] + reach >= b[None, :, 1]))
        got = [tuple(r) for r in spatial.polygon_pairs(df, df, reach, F.col("id") < F.col("b_id")).select("id", "b_id").collect()]
        assert len(got) == len(set(got))
        assert set(got) == {(int(i), int(j)) for i, j in zip(*np.where(near)) if i < j}

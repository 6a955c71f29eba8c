"""Arrangements, overlap and dissolved unions against pixels, whose unions are plain sets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wastelake.functions import arrangement as plane, geo
from wastelake.operators import dissolve as ds, overlap


def pixels(boxes, side=140):
    grid = np.zeros((side, side), int)
    for x0, y0, x1, y1 in boxes:
        grid[x0:x1, y0:y1] = 1
    return grid


def measured_pixels(grid):
    """Area, boundary length, corners, and outer rings less holes."""
    p = np.pad(grid, 1)
    length = np.abs(np.diff(p, axis=0)).sum() + np.abs(np.diff(p, axis=1)).sum()
    quads = p[:-1, :-1] + p[1:, :-1] + p[:-1, 1:] + p[1:, 1:]
    crossed = ((p[:-1, :-1] == p[1:, 1:]) & (p[1:, :-1] == p[:-1, 1:]) & (quads == 2)).sum()
    one, three = (quads == 1).sum(), (quads == 3).sum()
    return grid.sum(), length, one + three + 2 * crossed, (one - three + 2 * crossed) / 4


def measured_rings(rings):
    """The same of closed rings in metres."""
    rings = [np.array([(p["x"], p["y"]) for p in r]) for r in rings]
    areas = [float((r[:-1, 0] * r[1:, 1] - r[1:, 0] * r[:-1, 1]).sum()) / 2 for r in rings]
    return sum(areas), sum(np.abs(np.diff(r, axis=0)).sum() for r in rings), sum(len(r) - 1 for r in rings), sum(np.sign(areas))


def some_boxes(rnd, n, reach=100, size=30):
    corners = [(rnd.randrange(reach), rnd.randrange(reach)) for _ in range(n)]
    return [(x, y, x + rnd.randint(1, size), y + rnd.randint(1, size)) for x, y in corners]


def shapes(spark, rows):
    return spark.createDataFrame([(k, *map(float, b)) for k, b in rows], "k int, a double, b double, c double, d double").select(
        "k", geo.box("a", "b", "c", "d").alias("rings"))


@pytest.mark.parametrize("cell,at_once", [(16.0, 256), (64.0, 8), (1024.0, 256)])
def test_unions_of_boxes(spark, monkeypatch, cell, at_once):
    monkeypatch.setattr(ds, "AT_ONCE", at_once)
    rnd = random.Random(3)
    boxes = {1: some_boxes(rnd, 70), 2: some_boxes(rnd, 25), None: some_boxes(rnd, 3), 4: [(10, 10, 20, 20)] * 40}
    # Corners that touch, an edge on a cell's line, a frame with an island in its hole.
    boxes[5] = [(0, 0, 16, 16), (16, 16, 32, 32), (16, 0, 20, 16)]
    boxes[6] = [(0, 0, 90, 10), (0, 80, 90, 90), (0, 0, 10, 90), (80, 0, 90, 90), (40, 40, 50, 50)]
    rows = [(k, b) for k, bs in boxes.items() for b in bs]
    got = {r["k"]: r["rings"] for r in ds.dissolve(shapes(spark, rows), ["k"], cell).collect()}
    assert {k: measured_rings(r) for k, r in got.items()} == {k: measured_pixels(pixels(bs)) for k, bs in boxes.items()}
    assert len(got[4]) == 1 and len(got[6]) == 3
    inside = spark.createDataFrame([(45.5, 45.5, True), (30.5, 30.5, False), (5.5, 45.5, True)], "x double, y double, want boolean")
    frame = ds.dissolve(shapes(spark, [(6, b) for b in boxes[6]]), ["k"], cell)
    assert frame.crossJoin(inside).filter(geo.covers("rings", "x", "y") != F.col("want")).count() == 0


def test_slanted_unions_cover_what_their_parts_cover(spark):
    rnd = random.Random(4)
    parts = []
    for _ in range(25):
        cx, cy, n = rnd.uniform(0, 150), rnd.uniform(-40, 100), rnd.randint(5, 12)
        turns = [2 * np.pi * (i + rnd.uniform(0, 0.9)) / n for i in range(n)]
        ring = [(cx + np.cos(t) * r, cy + np.sin(t) * r) for t in turns for r in [rnd.uniform(8, 40)]]
        parts.append([[(float(x), float(y)) for x, y in ring + ring[:1]]])
    parts.append([[(0., 0.), (40., 0.), (40., 40.), (0., 40.), (0., 0.)], [(10., 10.), (30., 10.), (30., 30.), (10., 30.), (10., 10.)]])
    df = spark.createDataFrame([(1, p) for p in parts], f"k int, rings {geo.RINGS}")
    union = ds.dissolve(df, ["k"], 32.0)
    points = spark.createDataFrame([(rnd.uniform(-60, 220), rnd.uniform(-90, 150)) for _ in range(300)], "x double, y double")
    covered = df.crossJoin(points).groupBy("x", "y").agg(F.bool_or(geo.covers("rings", "x", "y")).alias("want"))
    both = covered.crossJoin(union).withColumn("got", geo.covers("rings", "x", "y"))
    assert both.filter("got <> want").count() == 0 and 50 < both.filter("got").count() < 300


def test_nothing_to_dissolve(spark):
    flat = spark.createDataFrame([(1, [[(0., 0.), (5., 5.), (0., 0.)]]), (2, None), (3, [])], f"k int, rings {geo.RINGS}")
    assert ds.dissolve(flat, ["k"]).count() == 0
    assert ds.dissolve(flat.filter("k > 9"), ["k"]).count() == 0


def test_a_crowd_of_one_key_is_split_among_tasks(spark, monkeypatch):
    """No task gets more polygons of a cell than are united at once, but for the spread of a hash."""
    monkeypatch.setattr(ds, "AT_ONCE", 64)
    united = ds._united

    def counted(parts, keys, salted):
        most = parts.groupBy(*keys, "cx", "cy", *(["salt"] if salted else [])).count().agg(F.max("count")).first()[0] or 0
        sizes.append(most)
        return united(parts, keys, salted)

    sizes: list[int] = []
    monkeypatch.setattr(ds, "_united", counted)
    rnd = random.Random(5)
    boxes = some_boxes(rnd, 3000, 55, 8)
    got = ds.dissolve(shapes(spark, [(1, b) for b in boxes]), ["k"]).first()["rings"]
    assert measured_rings(got) == measured_pixels(pixels(boxes))
    assert len(sizes) >= 2 and max(sizes) <= 2 * 64


L_SHAPE = [[(0., 0.), (4., 0.), (4., 1.), (1., 1.), (1., 4.), (0., 4.), (0., 0.)]]
RING = [[(0., 0.), (9., 0.), (9., 9.), (0., 9.), (0., 0.)], [(3., 3.), (3., 6.), (6., 6.), (6., 3.), (3., 3.)]]
TWO = [[(0., 0.), (2., 0.), (2., 2.), (0., 2.), (0., 0.)], [(5., 0.), (7., 0.), (7., 2.), (5., 2.), (5., 0.)]]


def square(x, y, s):
    return [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]


@pytest.mark.parametrize("a,b,want", [
    (L_SHAPE, square(2., 2., 1.), False),  # in the notch
    (L_SHAPE, square(0., 0., 1.), False),  # held
    (L_SHAPE, square(3., 0.5, 1.), True),
    (RING, square(4., 4., 1.), False),  # in the hole
    (RING, square(2., 2., 5.), True),  # over the hole's edge
    (RING, square(0.5, 0.5, 1.), False),
    (TWO, square(1., 1., 5.), True),
    (TWO, square(3., 0., 1.), False),  # between the parts
    (TWO, square(-1., -1., 9.), False),  # holds both
    (TWO, [[(0., 0.), (7., 0.), (7., 2.), (0., 2.), (0., 0.)]], False),  # the union of touching parts holds both
    (square(0., 0., 2.), square(2., 0., 2.), False),  # a shared edge only
    (square(600000., 6e6, 30000.), square(620000., 6e6, 30000.), True),  # too wide for the fine grid
])
def test_overlap_of_any_form(spark, a, b, want):
    df = spark.createDataFrame([(a, b), (b, a)], f"a {geo.RINGS}, b {geo.RINGS}")
    assert [r[0] for r in df.select(overlap.overlaps("a", "b")).collect()] == [want, want]


def test_distance_of_shapes_of_several_rings(spark):
    """A second part inside the other polygon makes the distance 0."""
    df = spark.createDataFrame([(TWO, square(4., -1., 5.)), (TWO, square(3., 0., 1.))], f"a {geo.RINGS}, b {geo.RINGS}")
    assert [r[0] for r in df.select(overlap.polygon_distance("a", "b")).collect()] == [0.0, 1.0]


def test_pieces_and_sides():
    cross = np.array([[0, 5, 10, 5], [5, 0, 5, 10]], np.int64)
    pieces, owner = plane.split(cross, np.array([0, 1]))
    assert len(pieces) == 4 and sorted(owner.tolist()) == [0, 0, 1, 1]
    assert plane.left_over(np.array([[0, 10], [7, 3], [12, 10]])).tolist() == [[0, 3], [7, 10], [12, 10]]
    rings, rest = plane.stitched([np.array([[0, 0], [4, 0], [4, 4]]), np.array([[4, 4], [0, 4], [0, 0]]), np.array([[9, 9], [8, 8]])])
    assert len(rings) == 1 and len(rings[0]) == 4 and len(rest) == 1


def test_groups_of_a_task_are_walked_over_in_one_pass(spark):
    """Groups within, across and over whole Arrow batches, NULL keys among them."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from wastelake.operators import dissolve as d

    rows = spark.range(3000).select(
        F.expr("CASE WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 7 * (id % 3)) END").alias("k"), (F.col("id") % 2).alias("n"), "id")

    def total(table):
        first = table.slice(0, 1)
        return pa.table([first["k"], first["n"], pa.array([sum(table["id"].to_pylist())], pa.int64())], names=["k", "n", "s"])

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = sorted(map(tuple, d._by_group(rows, ["k", "n"], total, "k string, n bigint, s bigint").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == sorted(map(tuple, rows.groupBy("k", "n").agg(F.sum("id")).collect()), key=str)

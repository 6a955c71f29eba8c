"""Queries asked in groups, and unions of many keys at once."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from wastelake.functions import arrangement as plane, geo, pairs
from wastelake.operators import dissolve as ds, nearest as nn, overlap


def test_targets_that_cover_a_query_are_not_all_met(spark, monkeypatch):
    """300 points in 400 polygons each: the lowest key counts, and few pairs are looked at."""
    joined, rows = nn.salted_join, []

    def watched(left, right, keys, *args, **options):
        out = joined(left, right, keys, *args, **options)
        if "level" in keys and "target" in right.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(nn, "salted_join", watched)
    points = spark.range(300).selectExpr("id", "500D + id % 20 AS x", "500D + id % 17 AS y")
    polygons = spark.range(400).select("id", geo.square(F.expr("440D + id % 13"), F.expr("441D + id % 7"), F.lit(200.0)).alias("rings"))
    found = nn.nearest(nn.point_items(points, "id"), nn.polygon_items(polygons, "id"), nn.point_to_polygon).collect()
    assert {r["key"]: (r["target"], r["distance"]) for r in found} == {i: (0, 0.0) for i in range(300)}
    assert sum(rows) < 2_000


def test_points_on_an_edge_have_distance_0():
    x, y = np.full(45, 46.0), np.arange(1.0, 46.0)
    edges = np.array([[[0, 0, 46, 0], [46, 0, 46, 46], [46, 46, 0, 46], [0, 46, 0, 0]]] * 45, np.float64)
    assert (pairs.point_distances(x, y, edges) == 0).all()


def test_few_polygons_of_a_key_are_not_cut_into_cells(spark, monkeypatch):
    """Boxes, rings with holes, rings that are not closed, NULLs and flat ones; places far from the origin."""
    monkeypatch.setattr(ds, "_in_cells", None)
    at = lambda *points: [(480_000.0 + x, 115_000.0 + y) for x, y in points]
    frame = [at((0, 0), (9, 0), (9, 9), (0, 9), (0, 0)), at((3, 3), (6, 3), (6, 6), (3, 6), (3, 3))]
    rows = [(1, frame), (1, [at((4, 4), (5, 4), (5, 5), (4, 5))]), (2, [at((0, 0), (2, 0), (2, 2), (0, 2), (0, 0))]),
            (2, [at((1, 1), (1, 3), (3, 3), (3, 1), (1, 1))]), (2, None), (3, [at((0, 0), (5, 5), (0, 0))]), (None, [at((0, 0), (4, 0), (0, 4), (0, 0))])]
    shapes = spark.createDataFrame(rows, f"k int, rings {geo.RINGS}")
    got = {r["k"]: [[(p["x"] - 480_000, p["y"] - 115_000) for p in ring] for ring in r["rings"]] for r in ds.dissolve(shapes, ["k"]).collect()}
    assert got[2] == [[(0, 0), (2, 0), (2, 1), (3, 1), (3, 3), (1, 3), (1, 2), (0, 2), (0, 0)]]
    assert got[None] == [[(0, 0), (4, 0), (0, 4), (0, 0)]] and 3 not in got
    assert [len(r) for r in got[1]] == [5, 5, 5] and got[1][0][0] == (0, 0) and got[1][1] == [(3, 3), (3, 6), (6, 6), (6, 3), (3, 3)]


def test_unions_in_rounds_equal_the_union_at_once():
    rnd = random.Random(6)
    shapes = []
    for g in range(12):
        for _ in range(rnd.randint(1, 40)):
            cx, cy, n = rnd.uniform(0, 300), rnd.uniform(0, 300), rnd.randint(5, 9)
            turns = [2 * np.pi * (i + rnd.uniform(0, 0.9)) / n for i in range(n)]
            ring = np.array([(cx + r * np.cos(t), cy + r * np.sin(t)) for t in turns for r in [rnd.uniform(10, 60)]])
            shapes.append((g, np.rint(ring * 2 ** 17).astype(np.int64)))
    edges = [plane.edges([r]) for _, r in shapes]
    part = np.repeat(np.arange(len(edges)), [len(e) for e in edges])
    e, group = plane.unions(np.vstack(edges), part, np.array([g for g, _ in shapes]))
    area = lambda rings: sum(plane.signed_area(r) / 2 ** 35 for r in rings)
    for g in range(12):
        want = plane.chains(plane.boundary(plane.edges([r for k, r in shapes if k == g])))[0]
        got, rest = plane.chains(e[group == g])
        assert not rest and len(got) == len(want) and abs(area(got) - area(want)) < 1e-3


def test_edges_almost_alike_are_split_in_few_rounds():
    """Two edges from one place and a third beside them once went on crossing a step further each round."""
    e = np.array([[0, 0, 131072, 1179648], [115567, 984342, 105790, 952111], [105790, 952111, 131072, 1179648]], np.int64)
    met, rounds = plane._meetings, []

    def counted(*args):
        rounds.append(len(args[0]))
        assert len(rounds) < 20
        return met(*args)

    plane._meetings = counted
    try:
        pieces, owner = plane.split(e, np.arange(3))
    finally:
        plane._meetings = met
    assert len(pieces) < 12 and set(owner.tolist()) == {0, 1, 2}


def test_many_overlaps_at_once_equal_those_one_by_one():
    rnd = random.Random(8)

    def ring(x, y, r):
        turns = [2 * np.pi * (i + rnd.uniform(0, 0.9)) / 50 for i in range(50)]
        points = [{"x": x + float(np.cos(t)) * d, "y": y + float(np.sin(t)) * d} for t in turns for d in [rnd.uniform(r / 2, r)]]
        return points + points[:1]

    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    one = [[ring(rnd.uniform(0, 30), rnd.uniform(0, 30), 12.0)] for _ in range(60)] + [None, [], [ring(0, 0, 9.0), ring(40, 0, 9.0)]]
    two = [[ring(rnd.uniform(0, 30), rnd.uniform(0, 30), 12.0)] for _ in range(60)] + [one[0], one[1], [ring(20, 0, 30.0)]]
    p, q = (pairs.Polygons(pa.array(rows, kind)) for rows in (one, two))
    got = overlap._overlap_batch(p, q)
    flat = lambda s, k: [np.concatenate([r[i] for r in s.one(k)]) for i in (0, 1)] + [[len(r[0]) for r in s.one(k)]]
    assert got[:60] == [overlap._overlaps(*flat(p, k), *flat(q, k)) for k in range(60)] and 5 < sum(got[:60]) < 55
    assert got[60:] == [None, False, True]


def test_polygons_of_one_file_are_cut_by_many_tasks(spark):
    shapes = spark.range(400).coalesce(1).select(F.lit(1).alias("k"), geo.square(F.col("id") * 3.0, F.col("id") * 5.0, F.lit(90.0)).alias("rings"))
    cells = ds._in_cells(shapes, ["k"], int(ds.CELL * plane.STEPS))
    assert cells.select(F.spark_partition_id().alias("p")).distinct().count() > 1

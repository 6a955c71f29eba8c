"""Grid joins, nearest neighbours and clusters against brute force, with crowded places."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from wastelake.functions import geo
from wastelake.operators import cluster, nearest as nn, overlap, sites as st, spatial


def crowd(n, seed, spread=8.0):
    """Points, a third in one spot, a third around it, the rest anywhere."""
    r = np.random.default_rng(seed)
    third = n // 3
    spot = np.tile([[500.0, 500.0]], (third, 1))
    near = r.normal(500, spread, (third, 2)).round(2)
    far = r.uniform(0, 1000, (n - 2 * third, 2)).round(2)
    return np.vstack([spot, near, far])


def frame(spark, xy, names=("id", "x", "y")):
    return spark.createDataFrame(pd.DataFrame({names[0]: range(len(xy)), names[1]: xy[:, 0], names[2]: xy[:, 1]}))


def test_points_near_points(spark):
    a, b = crowd(90, 1), crowd(120, 2)
    got = spatial.points_near_points(frame(spark, a), frame(spark, b, ("o", "ox", "oy")), 12.0).select("id", "o").collect()
    d = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1])
    want = {(int(i), int(j)) for i, j in zip(*np.where((d * d) <= 144.0))}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_points_in_and_near_polygons(spark):
    a, b = crowd(90, 3), crowd(60, 4)
    points, squares = frame(spark, a), frame(spark, b, ("o", "sx", "sy")).withColumn("rings", geo.square("sx", "sy", F.lit(25.0)))
    dx = np.maximum(0, np.maximum(b[None, :, 0] - a[:, None, 0], a[:, None, 0] - b[None, :, 0] - 25))
    dy = np.maximum(0, np.maximum(b[None, :, 1] - a[:, None, 1], a[:, None, 1] - b[None, :, 1] - 25))
    near = spatial.points_near_polygons(points, squares, 4.0).select("id", "o").collect()
    assert {tuple(r) for r in near} == {(int(i), int(j)) for i, j in zip(*np.where(np.hypot(dx, dy) <= 4.0))}
    touching = spatial.points_in_polygons(points, squares, False).select("id", "o").collect()
    assert {tuple(r) for r in touching} == {(int(i), int(j)) for i, j in zip(*np.where(np.hypot(dx, dy) == 0))}
    strict = spatial.points_in_polygons(points, squares, True).select("id", "o").collect()
    inside = ((a[:, None] > b[None]) & (a[:, None] < b[None] + 25)).all(2)
    assert {tuple(r) for r in strict} == {(int(i), int(j)) for i, j in zip(*np.where(inside))}
    some = spatial.has_polygon(points, squares).select("id").collect()
    assert sorted(r[0] for r in some) == [int(i) for i in np.where(inside.any(1))[0]]


def test_area_code_is_the_same_for_any_cell(spark):
    points = frame(spark, np.vstack([crowd(60, 5), [[100.0, 50.0], [100.0, 100.0], [2000.0, 2000.0]]]))
    areas = spark.createDataFrame([(f"a{i}{j}", i * 100.0, j * 100.0) for i in range(10) for j in range(10)],
                                  "code string, ax double, ay double").withColumn("rings", geo.square("ax", "ay", F.lit(100.0)))
    small = spatial.area_code(points, areas, "code", "found", size=70.0)
    large = spatial.area_code(points, areas, "code", "found", size=500.0)
    one = {r["id"]: r["found"] for r in small.collect()}
    assert one == {r["id"]: r["found"] for r in large.collect()}
    assert one[60] == "a00" and one[61] == "a00" and one[62] is None


def test_nearest_in_a_crowd(spark):
    a, b = crowd(300, 6), crowd(360, 7)
    got = nn.nearest(nn.point_items(frame(spark, a), "id"), nn.point_items(frame(spark, b), "id"), nn.point_to_point).collect()
    d = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1])
    assert {r["key"]: r["target"] for r in got} == {i: int(j) for i, j in enumerate(d.argmin(1))}


def crowded_frames(spark, n):
    """`n` targets within a millimetre or so of one spot, a few elsewhere, and `n` queries in one far cell."""
    spread = lambda seed, scale: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(100_003)) / 100_003.0 * scale
    targets = spark.range(n).select("id", (5000 + spread(1, 0.002)).alias("x"), (5000 + spread(2, 0.002)).alias("y"))
    targets = targets.unionByName(spark.createDataFrame([(n, 4000.0, 5000.0), (n + 1, 40.0, 9000.0)], "id long, x double, y double"))
    return spark.range(n).select("id", (1 + spread(3, 30.0)).alias("x"), (1 + spread(4, 30.0)).alias("y")), targets


def test_nearest_to_a_spot_from_a_far_cell(spark, monkeypatch):
    """No cell of a join has more rows than a task is given, and leaves hold few targets."""
    n, sizes, joined = 100_000, [], nn.salted_join

    def watched(left, right, keys, *args, **options):
        if "level" in keys and "target" in right.columns:
            sizes.append(("leaf", right.groupBy(*keys).count().agg(F.max("count")).first()[0]))
        if "level" in keys and "child_level" in right.columns:
            sizes.append(("children", right.groupBy(*keys).count().agg(F.max("count")).first()[0]))
        return joined(left, right, keys, *args, **options)

    monkeypatch.setattr(nn, "salted_join", watched)
    queries, targets = crowded_frames(spark, n)
    found = nn.nearest(nn.point_items(queries, "id"), nn.point_items(targets, "id"), nn.point_to_point)
    both = found.join(queries.withColumnRenamed("id", "key"), "key").toPandas()
    assert len(both) == n
    spots = targets.toPandas()
    pick = both.sample(200, random_state=1)
    d = np.hypot(pick.x.to_numpy()[:, None] - spots.x.to_numpy(), pick.y.to_numpy()[:, None] - spots.y.to_numpy())
    assert np.allclose(d.min(1), pick.distance) and (spots.id.to_numpy()[d.argmin(1)] == pick.target).all()
    assert dict(sizes)["children"] <= nn.FACTOR ** 2
    assert all(most <= nn.CROWD for kind, most in sizes if kind == "leaf")


def test_nearest_by_key_and_limit(spark):
    a = spark.createDataFrame([(1, "p", 0.0, 0.0), (2, "q", 0.0, 0.0), (3, "r", 0.0, 0.0)], "id int, k string, x double, y double")
    b = spark.createDataFrame([(7, "p", 30.0, 0.0), (6, "p", 0.0, 30.0), (5, "q", 900.0, 0.0)], "id int, k string, x double, y double")
    find = lambda **kw: {r["key"]: (r["target"], r["distance"]) for r in nn.nearest(
        nn.point_items(a, "id", by=["k"]), nn.point_items(b, "id", by=["k"]), nn.point_to_point, by=["k"], **kw).collect()}
    assert find() == {1: (6, 30.0), 2: (5, 900.0)}
    assert find(max_distance=30.0) == {1: (6, 30.0)}


def test_nearest_polygons(spark):
    a, b = crowd(30, 8, 60.0), crowd(36, 9, 60.0)
    boxes = lambda xy, side: frame(spark, xy, ("id", "sx", "sy")).withColumn("rings", geo.square("sx", "sy", F.lit(side)))
    got = nn.nearest(nn.polygon_items(boxes(a, 10.0), "id"), nn.polygon_items(boxes(b, 15.0), "id"), nn.polygon_to_polygon).collect()
    dx = np.maximum(0, np.maximum(b[None, :, 0] - a[:, None, 0] - 10, a[:, None, 0] - b[None, :, 0] - 15))
    dy = np.maximum(0, np.maximum(b[None, :, 1] - a[:, None, 1] - 10, a[:, None, 1] - b[None, :, 1] - 15))
    best = np.hypot(dx, dy).min(1)
    assert len(got) == 30 and all(abs(r["distance"] - best[r["key"]]) < 1e-9 for r in got)


def union_find(xy, reach):
    label = list(range(len(xy)))
    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(xy)):
        for j in range(i):
            if ((xy[i] - xy[j]) ** 2).sum() <= reach * reach:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(xy))]


def test_clusters_are_the_components(spark):
    xy = crowd(300, 10, 40.0)
    got = {r["id"]: r["cluster"] for r in cluster.clusters(frame(spark, xy), 7.0).collect()}
    assert got == dict(enumerate(union_find(xy, 7.0)))


def facing_crowds(spark, n, gap, seed):
    """Two crowds of real-valued places on the sides of neighbouring cells that face each other."""
    r = np.random.default_rng(seed)
    left = np.stack([5.0 - r.uniform(0, 4.9, n) ** 2 / 4.9, r.uniform(0.0, 4.9, n)], 1)
    right = np.stack([5.0 + gap + r.uniform(0, 0.4, n), r.uniform(0.0, 4.9, n)], 1)
    return np.vstack([left, right])


def test_pairs_of_crowded_cells_grow_with_the_points(spark, monkeypatch):
    tested = {}
    undecided = cluster._undecided

    def counted(pairs, reach):
        tested[n] = tested.get(n, 0) + pairs.count()
        return undecided(pairs, reach)

    monkeypatch.setattr(cluster, "_undecided", counted)
    for n in (1000, 8000):
        xy = facing_crowds(spark, n, 6.9995, 12)
        got = cluster.clusters(frame(spark, xy), 7.0).select("id", "cluster").toPandas().sort_values("id")
        assert len(set(got.cluster[:n])) == 1 and len(set(got.cluster[n:])) == 1
        a, b = xy[:n][np.argsort(-xy[:n, 0])[:400]], xy[n:][np.argsort(xy[n:, 0])[:400]]
        linked = (((a[:, None] - b[None]) ** 2).sum(2) <= 49.0).any()
        assert (len(set(got.cluster)) == 1) == bool(linked)
    assert all(pairs < points for points, pairs in tested.items())  # of 64 million that there are


def test_clusters_of_real_valued_places(spark):
    r = np.random.default_rng(13)
    xy = np.vstack([r.uniform(0, 60, (250, 2)), r.normal(-30, 4, (150, 2))])
    for reach in (1.5, 3.0):
        got = {r["id"]: r["cluster"] for r in cluster.clusters(frame(spark, xy), reach).collect()}
        assert got == dict(enumerate(union_find(xy, reach)))


def test_chain_and_gap(spark):
    chain = np.array([[i * 6.9, 0.0] for i in range(40)] + [[39 * 6.9 + 7.1, 0.0]])
    got = [r["cluster"] for r in cluster.clusters(frame(spark, chain), 7.0).orderBy("id").collect()]
    assert got == [0] * 40 + [40]


def test_hull_of_a_wide_cluster(spark):
    r = np.random.default_rng(11)
    xy = np.vstack([r.uniform(0, 900, (400, 2)), [[-1, -1], [901, -1], [901, 901], [-1, 901]]])
    df = frame(spark, xy).withColumn("k", F.lit(1))
    ring = cluster.hulls(df, "k").first()["rings"][0]
    assert [(p["x"], p["y"]) for p in ring] == [(-1, -1), (901, -1), (901, 901), (-1, 901), (-1, -1)]
    grown = cluster.hulls(df, "k", 5.0).first()["rings"][0]
    assert math.isclose(min(p["x"] for p in grown), -6.0) and math.isclose(max(p["y"] for p in grown), 906.0)


def test_hull_of_a_million_real_valued_points_of_one_key(spark, monkeypatch):
    """No list over the bound, and the hull of all points."""
    monkeypatch.setattr(cluster, "LISTED", 500)
    hull = cluster._hull
    u = lambda seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    points = spark.range(0, 1_000_000, 1, 16).select(F.lit(None).cast("string").alias("k"), (F.cos(u(1) * 6.3) * F.sqrt(u(2)) * 500).alias("x"),
                                                     (F.sin(u(1) * 6.3) * F.sqrt(u(2)) * 500).alias("y"))
    counted = cluster._corners(points, "k")
    assert counted.count() < 16 * 1000  # of a million, before any shuffle
    ring = cluster.hulls(points, "k").first()["rings"][0]
    xy = points.toPandas()[["x", "y"]].to_numpy()
    corners = np.array([(p["x"], p["y"]) for p in ring])
    assert (corners[:-1] == hull(xy)).all() and len(corners) > 100
    side = [((b - a)[0] * (xy[:, 1] - a[1]) - (xy[:, 0] - a[0]) * (b - a)[1]).min() for a, b in zip(corners, corners[1:])]
    assert min(side) > -1e-7


def test_hulls_of_few_points(spark):
    rows = [("a", 1.0, 2.0), ("a", 1.0, 2.0), ("b", 0.0, 0.0), ("b", 4.0, 4.0), ("b", 2.0, 2.0), (None, 0.0, 0.0), (None, 2.0, 0.0), (None, 0.0, 2.0),
            (None, None, 5.0)]
    got = {r["k"]: [(p["x"], p["y"]) for p in r["rings"][0]] for r in cluster.hulls(spark.createDataFrame(rows, "k string, x double, y double"), "k").collect()}
    assert got == {"a": [(1, 2), (1, 2)], "b": [(0, 0), (4, 4), (0, 0)], None: [(0, 0), (2, 0), (0, 2), (0, 0)]}


def test_overlap(spark):
    ring = lambda x, y, s: [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]
    rows = [(ring(0., 0., 2.), ring(1., 1., 2.)), (ring(0., 0., 4.), ring(1., 1., 2.)), (ring(0., 0., 1.), ring(1., 0., 1.)),
            (ring(0., 0., 2.), ring(1., 0., 2.)), (ring(0., 0., 2.), ring(0., 0., 2.)), (ring(0., 0., 1.), ring(5., 5., 1.))]
    df = spark.createDataFrame(rows, f"a {geo.RINGS}, b {geo.RINGS}")
    assert [r[0] for r in df.select(overlap.overlaps("a", "b")).collect()] == [True, False, False, True, False, False]


def test_merge_overlapping_takes_pairs_from_one_state(spark):
    square = lambda x, y: [[(x, y), (x + 4, y), (x + 4, y + 4), (x, y + 4), (x, y)]]
    rows = [("m1", True, square(0., 0.)), ("m2", True, square(3., 3.)), ("w1", False, square(6., 6.)), ("w2", False, square(20., 20.))]
    sites = spark.createDataFrame([(i, b, None, r) for i, b, r in rows], f"id string, bgt_based boolean, active int, rings {geo.RINGS}")
    sites = sites.withColumns(dict(zip(("x", "y"), geo.centroid("rings").values())))
    centre = next(r for r in st.merge_overlapping(sites).collect() if r["id"] == "m1")
    assert abs(centre["x"] - (16 * 2 + 16 * 5 - 3.5) / 31) < 1e-9 and centre["x"] == centre["y"]
    got = {r["id"]: (r["active"], r["parts"], len(r["rings"]), len(r["rings"][0])) for r in st.merge_overlapping(sites).collect()}
    assert got == {"m1": (4, 2, 1, 9), "m2": (4, 3, 1, 13), "w2": (None, 1, 1, 5)}


def test_shapes_of_several_parts(spark):
    """A point in the overlap of two parts lies in the shape; its centroid is that of the union."""
    box = lambda x, y, w, h: [[{"x": float(a), "y": float(b)} for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))]][0]
    shape = "array<array<struct<x:double,y:double>>>"
    sites = spark.createDataFrame([(7, [box(0, 0, 10, 10), box(5, 0, 10, 10)]), (8, [box(100, 0, 4, 4)])], f"id int, rings {shape}")
    measured = {r["id"]: r["u"] for r in sites.select("id", overlap.union_measure("rings").alias("u")).collect()}
    assert (round(measured[7]["area"], 9), round(measured[7]["cx"], 9), round(measured[7]["cy"], 9)) == (150.0, 7.5, 5.0)
    turned = spark.createDataFrame([([[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 4.0}, {"x": -2.0, "y": 2.0}, {"x": 0.0, "y": 0.0}],
                                      box(-1, 1, 2, 2)],)], f"rings {shape}")
    assert round(turned.select(overlap.union_measure("rings").alias("u")).first()["u"]["area"], 9) == 8.0
    points = spark.createDataFrame([(1, 7.0, 5.0), (2, 99.0, 2.0)], "id int, x double, y double")
    found = nn.of_shapes(nn.nearest(nn.shape_items(sites, "id"), nn.point_items(points, "id"), nn.polygon_to_point))
    assert {r["key"]: (r["target"], r["distance"]) for r in found.collect()} == {7: (1, 0.0), 8: (2, 1.0)}


def test_pieces_are_not_broadcast_by_estimate(spark):
    """20,000 polygons are some 30 MB as pieces, however small the estimate of their table."""
    squares = spark.range(20_000).selectExpr("id AS o", "id * 3.0D AS sx", "id * 7.0D % 1000 AS sy").select(
        "o", geo.square("sx", "sy", F.lit(25.0)).alias("rings"))
    points = spark.range(30_000).selectExpr("id", "id * 2.0D AS x", "id * 5.0D % 1000 AS y")
    for joined in (spatial.points_in_polygons(points, squares), spatial.has_polygon(points, squares)):
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan

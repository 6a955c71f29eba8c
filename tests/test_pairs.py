"""Many pairs of polygons at once against one pair at a time."""

import math
import time

import numpy as np
import pyarrow as pa

from wastelake.functions import pairs
from wastelake.functions.geo import RINGS
from wastelake.operators import overlap

KIND = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))


def shape(r, kind):
    x, y = r.integers(0, 20, 2).astype(float)
    s = float(r.integers(6, 20))
    box = [(0, 0), (s, 0), (s, s), (0, s)]
    turn = np.sort(r.uniform(0, 2 * np.pi, 7))
    rings = [[box], [box, [(2, 2), (s - 2, 2), (s - 2, s - 2), (2, s - 2)]], [[(0, 0), (s, 0), (s, 4), (4, 4), (4, s), (0, s)]],
             [[(d * math.cos(a), d * math.sin(a)) for a, d in zip(turn, r.uniform(3, s, 7))]], [[(0, 0), (s, 0), (s / 2, s)]]][kind]
    return [[{"x": x + p, "y": y + q} for p, q in ring + ring[:1]] for ring in rings]


def corners(rings):
    return [[p[c] for ring in rings for p in ring] for c in "xy"] + [[len(ring) for ring in rings]]


def ends(rings):
    return [np.array([ring[i + j][c] for ring in rings for i in range(len(ring) - 1)]) for j in (0, 1) for c in "xy"]


def test_pairs_of_any_form_have_the_answers_of_single_pairs():
    r = np.random.default_rng(5)
    a, b = ([shape(r, int(k)) for k in r.integers(0, 5, 1500)] for _ in range(2))
    b[7] = [[{"x": p["x"], "y": p["y"]} for p in ring] for ring in a[7]]  # the same shape
    a[3] = b[4] = None
    p, q = pairs.Polygons(pa.array(a, KIND)), pairs.Polygons(pa.array(b, KIND))
    met, far = overlap._overlap_batch(p, q), overlap._distance_batch(p, q)
    points = r.uniform(0, 40, (2, len(a)))
    near = overlap._point_distance_batch(*points, p)
    for i, (one, two) in enumerate(zip(a, b)):
        if one is None or two is None:
            assert met[i] is None and far[i] is None
            continue
        assert met[i] == overlap._overlaps(*corners(one), *corners(two))
        assert abs(far[i] - overlap._distance(*ends(one), *ends(two))) < 1e-12
        x, y = points[:, i]
        want = 0.0 if overlap._inside(x, y, *ends(one)) else overlap._to_edges(np.array([x]), np.array([y]), *ends(one))
        assert abs(near[i] - want) < 1e-12
    both = [one + two if one and two and len(one) == len(two) == 1 else None for one, two in zip(a, b)]
    for parts, found in zip(both, overlap._union_batch(pairs.Polygons(pa.array(both, KIND)))):
        if parts is None:
            assert found == (None, None, None)
        else:
            assert np.allclose(found, overlap._measured_union(parts), rtol=0, atol=1e-9)


def test_a_pair_costs_microseconds():
    r = np.random.default_rng(6)
    a, b = ([shape(r, 0) for _ in range(10_000)] for _ in range(2))
    p, q = pairs.Polygons(pa.array(a, KIND)), pairs.Polygons(pa.array(b, KIND))
    both = pairs.Polygons(pa.array([one + two for one, two in zip(a, b)], KIND))
    begun = time.process_time()
    overlap._overlap_batch(p, q)
    overlap._distance_batch(p, q)
    overlap._union_batch(both)
    assert time.process_time() - begun < 3.0  # some 15 s one by one


def test_distances_in_spark(spark):
    rows = [(1, 2.0, 2.0, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]), (2, 7.0, 8.0, None), (3, None, 1.0, []),
            (4, 7.0, 8.0, [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]])]
    df = spark.createDataFrame(rows, f"id int, x double, y double, rings {RINGS}")
    got = df.select("id", overlap.point_distance("x", "y", "rings"), overlap.overlaps("rings", "rings"), overlap.union_measure("rings").alias("u")).collect()
    assert [(r[1], r[2]) for r in got] == [(0.0, False), (None, None), (None, False), (5.0, False)]
    assert [r["u"]["area"] for r in got] == [16.0, None, None, 16.0]

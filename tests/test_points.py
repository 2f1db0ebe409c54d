import math
import random

import pytest

from tramline.operators import point_reduce, spatial
from tramline.operators.components import components


def frame(spark, points):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "id long, lat double, lon double")


def far(p, q):
    a, b, c, d = map(math.radians, (*p, *q))
    return 2 * 6371009 * math.asin(min(1, math.sqrt(math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2)))


def edges(spark, points, r):
    return sorted(tuple(x) for x in spatial.proximity_graph(frame(spark, points), r).collect())


@pytest.mark.parametrize(
    ("points", "n"),
    [
        ([], 0), ([(45, -122)], 0), ([(45, -122), (45.00027, -122)], 1), ([(45, -122), (45.0009, -122)], 0),
        ([(45, -122), (45.0002, -122), (45.0001, -122.0001)], 3), ([(60, 10), (60, 10.00054)], 1), ([(89.999, 0), (89.999, 1)], 1),
    ],
)
def test_proximity(spark, points, n):
    assert len(edges(spark, points, 50)) == n


@pytest.mark.parametrize("centre", [(45.0, -122.0), (-33.0, 151.0), (78.0, 15.0), (0.0, 0.0)])
def test_proximity_fuzz(spark, centre):
    rng = random.Random(42)
    pts = [(centre[0] + rng.uniform(-0.002, 0.002), centre[1] + rng.uniform(-0.002, 0.002)) for _ in range(400)]
    naive = sorted((i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if far(pts[i], pts[j]) < 50)
    assert edges(spark, pts, 50) == naive


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (7, 7), *((i, i + 1) for i in range(100, 140))]
    got = {r.id: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, **{i: 100 for i in range(100, 141)}}


def reduced(spark, points, r=25.0):
    return {x.id: (x.rep, x.rep_lat, x.rep_lon) for x in point_reduce.reduce_points(frame(spark, points), r).collect()}


def test_reduce_small(spark):
    assert reduced(spark, []) == {}
    assert reduced(spark, [(45, -122)])[0] == (0, 45.0, -122.0)
    got = reduced(spark, [(45, -122), (45.00018, -122)])
    assert {v[0] for v in got.values()} == {0} and abs(got[0][1] - 45.00009) < 1e-9
    assert len({v[0] for v in reduced(spark, [(45, -122), (45.0009, -122)]).values()}) == 2


def one_by_one(pts, r):
    """The definition, as a loop over the points."""
    links = {i: [j for j in range(len(pts)) if j != i and far(pts[i], pts[j]) < 2 * r] for i in range(len(pts))}
    out = {}
    for c in sorted(links, key=lambda i: (-len(links[i]), i)):
        if c in out:
            continue
        members = [c, *(j for j in links[c] if j not in out and far(pts[c], pts[j]) <= r)]
        while True:
            lat, lon = (sum(pts[j][k] for j in members) / len(members) for k in (0, 1))
            left = [j for j in members if far(pts[j], (lat, lon)) <= r]
            if left == members:
                break
            members = left
        out |= {j: (c, lat, lon) for j in members}
    return out


@pytest.mark.parametrize(("n", "spread"), [(200, 0.001), (150, 0.0004), (120, 0.004)])
def test_reduce_fuzz(spark, n, spread):
    rng = random.Random(n)
    pts = [(52 + rng.uniform(-spread, spread), 13 + rng.uniform(-spread, spread)) for _ in range(n)]
    got, expected = reduced(spark, pts), one_by_one(pts, 25.0)
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in expected.items()}
    assert all(abs(got[i][k] - expected[i][k]) < 1e-9 for i in got for k in (1, 2))
    assert all(far(pts[i], v[1:]) <= 25 + 1e-6 for i, v in got.items())
    reps, mapping = point_reduce.representatives(point_reduce.reduce_points(frame(spark, pts), 25.0))
    assert sorted(r.idx for r in reps.collect()) == list(range(len({v[0] for v in got.values()}))) and mapping.count() == n


def test_cells(spark):
    stops = frame(spark, [(45.99, -122.5), (45.5, -122.5)]).withColumnRenamed("id", "stop_id")
    got = sorted(tuple(r) for r in spatial.cell_seeds(stops, 6.0).collect())
    assert got == [(45, -123, 0), (45, -123, 1), (46, -123, 0)]


def copied(n, places, seed):
    """Points with many copies of a place, ids in no order."""
    rng = random.Random(seed)
    spots = [(52 + rng.uniform(-0.001, 0.001), 13 + rng.uniform(-0.001, 0.001)) for _ in range(places)] + [(53.0, 13.0)]
    return [rng.choice(spots) for _ in range(n)]


def test_pairs_of_copies(spark, monkeypatch):
    """Copies become pairs chunk by chunk, each pair once."""
    monkeypatch.setattr(spatial, "CHUNK", 4)
    pts = copied(150, 12, 1)
    assert edges(spark, pts, 50) == sorted((i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if far(pts[i], pts[j]) < 50)


def test_pairs_of_chunks_are_not_held_together(spark):
    """Generated code holds all rows that come of one input row; the two sides of a pair of chunks are unfolded in different pieces of it."""
    pts = frame(spark, copied(40, 4, 5))
    for pairs in (spatial.proximity_graph(pts, 50.0), spatial.ellipse_pairs(pts, 0.05)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        between, found, _ = plan.partition("explode(b_ids")[2].partition("explode(a_ids")
        assert found and "Coalesce" in between


def test_ellipses_of_copies(spark, monkeypatch):
    monkeypatch.setattr(spatial, "CHUNK", 4)
    pts = copied(120, 10, 2)
    inside = lambda p, q: ((p[0] - q[0]) * 111.32 / 0.05) ** 2 + ((p[1] - q[1]) * 111.32 * math.cos(math.radians(max(p[0], q[0]))) / 0.05) ** 2 < 1
    got = sorted(tuple(x) for x in spatial.ellipse_pairs(frame(spark, pts), 0.05).collect())
    assert got == [(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if inside(pts[i], pts[j])]


def test_components_of_copies(spark):
    """A billion links between copies are not made: only places are linked."""
    pts = copied(150, 12, 3)
    plain = {r.id: r.root for r in components(spatial.proximity_graph(frame(spark, pts), 50.0).selectExpr("i a", "j b")).collect()}
    assert {r.id: r.root for r in spatial.proximity_components(frame(spark, pts), 50.0).collect()} == plain
    many = spark.range(100_000).selectExpr("id", "45 + 0.0002 * (id % 2) as lat", "cast(id = 7 as double) as lon")
    assert spatial.proximity_components(many, 50.0).groupBy("root").count().collect() == [(0, 99_999)]


def test_reduce_copies(spark):
    pts = copied(150, 30, 4)
    got, expected = reduced(spark, pts), one_by_one(pts, 25.0)
    assert {i: v[0] for i, v in got.items()} == {i: v[0] for i, v in expected.items()}
    assert all(abs(got[i][k] - expected[i][k]) < 1e-9 for i in got for k in (1, 2))
    many = spark.range(100_000).selectExpr("id", "45 + 0.0002 * (id % 2) as lat", "cast(id = 7 as double) as lon")
    assert sorted(tuple(r) for r in point_reduce.reduce_points(many, 25.0).groupBy("rep").count().collect()) == [(0, 99_999), (7, 1)]

"""Proximity clusters and polygon joins against plain loops."""

import math
import random

import pytest

from caudal.operators import spatial


def metres(a, b):
    (y, x), (v, u) = ([math.radians(c) for c in p] for p in (a, b))
    return 2 * 6371000 * math.asin(math.sqrt(math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2))


def clusters(points, reach):
    up = {k: k for k, *_ in points}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, (a, *p) in enumerate(points):
        for b, *q in points[:i]:
            if metres(p, q) <= reach:
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: root(k) for k in up}


@pytest.mark.parametrize(("lat", "lon"), [(3.4, -76.5), (0.0, 0.0), (-71.3, 179.2)])
def test_proximity_clusters(spark, lat, lon):
    rng = random.Random(lat)
    stretch = math.cos(math.radians(lat))
    points = [(i, lat + rng.gauss(0, 0.0009), lon + rng.gauss(0, 0.0009) / stretch) for i in range(250)]
    points += [(1000 + i, lat + 0.01 + rng.random() * 0.0002, lon + rng.random() * 0.0002) for i in range(150)]  # a dense cell
    points += [(2000 + i, lat + 0.01 + 0.00055 + rng.random() * 0.0002, lon + rng.random() * 0.0002) for i in range(150)]  # and one just about the distance away
    points += [(3000, *points[0][1:])]
    df = spark.createDataFrame([*points, (4000, None, lon)], "k long, lat double, lon double")
    got = {r.k: r.cluster_geo for r in spatial.proximity_clusters(df, "k", "lat", "lon", 40.0).collect()}
    assert got.pop(4000) is None and got == clusters(points, 40.0)


def test_dense_cells_make_no_pairs(spark):
    """Two cells of 200,000 points each, side by side."""
    dense = spark.range(400_000).selectExpr("id as k", "3.4 + (id % 2) * 0.0002 + rand(1) * 0.0001 as lat", "-76.5 + rand(2) * 0.0001 as lon")
    assert [r.cluster_geo for r in spatial.proximity_clusters(dense, "k", "lat", "lon", 40.0).select("cluster_geo").distinct().collect()] == [0]


def star(rng, n, x, y, far):
    """A ring of n vertices around a point, of uneven distance."""
    out = [(x + far * rng.uniform(0.2, 1) * math.cos(2 * math.pi * k / n), y + far * rng.uniform(0.2, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [list(p) for p in [*out, out[0]]]


def inside(rings, x, y):
    odd = False
    for r in rings:
        for (a, b), (c, d) in zip(r, r[1:]):
            if (b > y) != (d > y) and x < (c - a) * (y - b) / (d - b) + a:
                odd = not odd
    return odd


@pytest.fixture(scope="module")
def polygons():
    rng = random.Random(6)
    out = {f"p{k}": [star(rng, rng.choice((3, 5, 40, 200)), rng.uniform(-77, -75), rng.uniform(2.5, 4.5), rng.choice((0.004, 0.05, 0.8)))] for k in range(25)}
    out["with a hole"] = [star(rng, 60, -76.2, 3.6, 0.6), star(rng, 30, -76.2, 3.6, 0.1)]
    box = lambda a, b, c, d: [[a, b], [c, b], [c, d], [a, d], [a, b]]
    out |= {"round": [box(-76.5, 3.4, -76.45, 3.45)], "next": [box(-76.45, 3.4, -76.4, 3.45)], "wide": [box(-77.5, 2.0, -74.5, 5.0)], "none": [], "flat": [[[0.0, 0.0], [1.0, 1.0], [0.0, 0.0]]]}
    return out


def test_points_in_polygons(spark, polygons):
    rng = random.Random(7)
    points = [(i, rng.uniform(-77.6, -74.4), rng.uniform(1.9, 5.1)) for i in range(1500)] + [(2000 + i, -76.5 + i * 0.005, 3.4 + j * 0.005) for i in range(20) for j in (0, 3, 10)]
    points += [(5000 + k, *rng.choice(r)) for k, rings in enumerate(polygons.values()) for r in rings]  # vertices
    df = spark.createDataFrame(points, "k long, lon double, lat double")
    areas = spark.createDataFrame([*polygons.items(), ("null", None)], "name string, rings array<array<array<double>>>")
    hits = spatial.points_in_polygons(spark.createDataFrame([(str(p), *p[1:]) for p in points], "k string, lon double, lat double").distinct(), areas, "lon", "lat", "k", first_only=False)
    got = {(r.k, r.in_name) for r in hits.where("in_name is not null").collect()}
    assert got == {(str(p), n) for p in points for n, rings in polygons.items() if inside(rings, *p[1:])}
    first = {r.k: r.in_name for r in spatial.points_in_polygons(df.where("k < 1500"), areas, "lon", "lat", "k").collect()}
    assert first == {k: min((n for n, rings in polygons.items() if inside(rings, x, y)), default=None) for k, x, y in points if k < 1500}


def test_cells_hold_only_their_edges(polygons):
    for rings in polygons.values():
        for level, *_, edges in spatial.Cover(rings).cells:
            assert len(edges) <= spatial.EDGES or level == spatial.LEVELS - 1
    square = spatial.Cover([[[-77.0, 3.0], [-76.0, 3.0], [-76.0, 4.0], [-77.0, 4.0], [-77.0, 3.0]]])
    assert len(square.cells) < 50


def test_lines_in_polygons(spark, polygons):
    rng = random.Random(9)
    lines = []
    for k in range(200):
        x, y = rng.uniform(-77.6, -74.4), rng.uniform(1.9, 5.1)
        far = rng.choice((0.001, 0.02, 1.5))
        lines.append((k, [[x + rng.uniform(-far, far), y + rng.uniform(-far, far)] for _ in range(rng.randint(1, 4))]))
    lines += [(300, [[-78.0, 3.42], [-74.0, 3.42]]), (301, [[-76.47, 1.0], [-76.47, 6.0]]), (302, [])]

    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def meets(line, rings):
        if any(inside(rings, *p) for p in line):
            return True
        return any(side(p, q, a) * side(p, q, b) <= 0 and side(a, b, p) * side(a, b, q) <= 0 for r in rings for a, b in zip(r, r[1:]) for p, q in zip(line, line[1:]))

    df = spark.createDataFrame(lines, "k long, line array<array<double>>")
    areas = spark.createDataFrame(list(polygons.items()), "name string, rings array<array<array<double>>>")
    got = sorted((r.k, r.in_name) for r in spatial.lines_in_polygons(df, areas, "line", "k").collect())
    assert got == sorted((k, n) for k, line in lines for n, rings in polygons.items() if line and meets(line, rings))

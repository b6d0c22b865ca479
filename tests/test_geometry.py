import itertools
import random

import numpy as np
import pytest

from demandspark.operators.geometry import delaunay_triangles, ring_vertices, triangulate


def brute(points):
    """All triples with nothing strictly inside their circle, fans of cocircular points."""

    def turn(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def circle(p, q, r, d):
        m = [[v[0] - d[0], v[1] - d[1], (v[0] - d[0]) ** 2 + (v[1] - d[1]) ** 2] for v in (p, q, r)]
        (a, b, c), (e, f, g), (h, i, j) = m
        return a * (f * j - g * i) - b * (e * j - g * h) + c * (e * i - f * h)

    out = []
    for a, b, c in itertools.combinations(range(len(points)), 3):
        p, q, r = points[a], points[b], points[c]
        t = turn(p, q, r)
        if t == 0:
            continue
        sign = 1 if t > 0 else -1
        good = True
        for i, d in enumerate(points):
            if i in (a, b, c):
                continue
            v = circle(p, q, r, d) * sign
            if v > 0 or (v == 0 and (i < a or turn(q, r, d) * t < 0)):
                good = False
                break
        if good:
            out.append((a, b, c))
    return out


def run(points):
    lon, lat = zip(*points)
    return triangulate(np.arange(len(points)), np.array(lon), np.array(lat))


def octagon():
    return [(5, 0), (4, 3), (3, 4), (0, 5), (-3, 4), (-4, 3), (-5, 0), (0, -5)]


@pytest.mark.parametrize("points", [
    [(0, 0), (1, 0), (1, 1), (0, 1)],
    octagon(),
    [(x, y) for x in range(4) for y in range(4)],
    [(0, 0), (2, 0), (1, 1)],
])
def test_exact_cases(points):
    for seed in range(3):
        shuffled = random.Random(seed).sample(points, len(points))
        assert run(shuffled) == sorted(brute(shuffled))


def test_random_rings_equal_brute_force():
    rng = random.Random(7)
    for _ in range(40):
        points = list({(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(rng.randint(3, 14))})
        assert run(points) == sorted(brute(points))


def test_no_triangles_on_a_line_or_for_too_few_points():
    assert run([(0, 0), (1, 1), (2, 2), (5, 5)]) == []
    assert run([(0, 0), (1, 1)]) == []


def test_known_ring_through_spark(spark):
    # A ring whose triangles are known.
    ring = [
        (13.363376884873674, 52.52487384662575),
        (13.366370231681032, 52.52244551129306),
        (13.371166021399262, 52.5232680273848),
        (13.371037275366263, 52.52510231335614),
        (13.370393545203285, 52.527608829404016),
    ]
    table = spark.createDataFrame([(1, [*ring, ring[0]])], "polygon_id int, ring array<struct<lon:double,lat:double>>")
    vertices = ring_vertices(table)
    assert vertices.count() == 5
    got = sorted((r["a"], r["b"], r["c"]) for r in delaunay_triangles(vertices).collect())
    assert got == [(0, 1, 4), (1, 2, 3), (1, 3, 4)]
    rows = [(1, i, *p) for i, p in enumerate([*ring, ring[0]])]
    flat = spark.createDataFrame(rows, "polygon_id int, vertex_idx int, lon double, lat double")
    assert ring_vertices(flat).count() == 5


def test_large_ring_has_no_cap(spark):
    rng = random.Random(2)
    points = [(rng.random(), rng.random()) for _ in range(400)]
    rows = [(1, i, *p) for i, p in enumerate(points)]
    flat = spark.createDataFrame(rows, "polygon_id int, vertex_idx int, lon double, lat double")
    triangles = delaunay_triangles(flat).collect()
    area = sum(
        abs((points[b][0] - points[a][0]) * (points[c][1] - points[a][1])
            - (points[b][1] - points[a][1]) * (points[c][0] - points[a][0])) / 2
        for _, a, b, c in triangles)
    hull = hull_area(points)
    assert area == pytest.approx(hull)


def hull_area(points):
    pts = sorted(points)

    def half(seq):
        out = []
        for p in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    h = half(pts) + half(pts[::-1])
    return sum(h[i - 1][0] * h[i][1] - h[i][0] * h[i - 1][1] for i in range(len(h))) / 2


def test_many_corners_in_n_log_n():
    rng = np.random.default_rng(5)
    n = 20_000
    lon, lat = rng.random(n), rng.random(n)
    got = np.array(triangulate(np.arange(n), lon, lat))
    edges = np.sort(np.vstack([got[:, [0, 1]], got[:, [1, 2]], got[:, [0, 2]]]), axis=1)
    _, uses = np.unique(edges, axis=0, return_counts=True)
    assert uses.max() == 2 and len(got) == 2 * n - 2 - (uses == 1).sum()
    a, b, c = (np.column_stack([lon, lat])[got[:, k]] for k in range(3))
    area = np.abs((b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])).sum() / 2
    assert area == pytest.approx(hull_area(list(zip(lon, lat))))

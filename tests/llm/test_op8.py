"""Links and components against the full comparison."""

import math

import numpy as np
import pytest

from demandspark.llm import op8_embeddings as op
from demandspark.llm.registry import QUERIES


def brute(rows):
    def sound(r):
        return r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.float32(a[1]).astype(float), np.float32(b[1]).astype(float)
                if x @ y / (math.sqrt(x @ x) * math.sqrt(y @ y)) >= 0.98:
                    n[i] += 1
                    n[j] += 1
                    root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted((r[0], n[i], low[find(i)], r[0] == low[find(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("tile", [2048, 16])
def test_groups_ties_and_odd_vectors(spark, monkeypatch, tile):
    monkeypatch.setattr(op, "TILE", tile)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(12, 8))
    rows = [
        (k, (centers[k % 12] * (1 + k % 3) + rng.normal(scale=(k % 5) * 0.07, size=8)).tolist(), [0, 0, 1][k % 3]) for k in range(150)
    ]
    rows += [(150 + k, rows[3][1], 0) for k in range(30)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [math.nan] * 8, 0), (303, [1.0, None] * 4, 0), (304, [math.inf] * 8, 0)]
    rows += [(305, rows[3][1], None), (306, [1.0, 2.0], 0), (307, [2.0, 4.0], 0), (308, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 as node", "2 as n", "3 as tile")
    got = sorted(tuple(r) for r in op.near_duplicates(frame).collect())
    assert got == brute(rows)
    assert op.near_duplicates(frame.where("false")).count() == 0


def test_tree_covers_and_finds_all_pairs():
    rng = np.random.default_rng(4)
    points = rng.normal(size=(400, 3))
    points /= np.linalg.norm(points, axis=1)[:, None]
    points[50:90] = points[0]
    tree = op.CoverTree(points)
    found = {(int(i), int(j)) for a, b in op.pairs_within(tree, tree, 0.2) for i, j in zip(a, b)}
    apart = np.linalg.norm(points[:, None] - points[None], axis=2)
    assert {(int(i), int(j)) for i, j in zip(*np.nonzero(apart <= 0.2))} <= found
    assert len(found) < 0.5 * len(points) ** 2


def test_query_against_sql(spark, duck, folder):
    query, sql = QUERIES["op8_embeddings"]
    assert sorted(tuple(r) for r in query(spark, folder).collect()) == sorted(duck.execute(sql).fetchall())

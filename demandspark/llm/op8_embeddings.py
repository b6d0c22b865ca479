"""Exact near-duplicate embeddings by dual traversal of cover trees.

Equal vectors of a label are one row, with a count. A label's different vectors are dealt into tiles
of bounded size; every two tiles of a label meet in one task. A task builds a cover tree per tile
(nested levels of halving radius) and descends both trees at once: node pairs whose centres are further
apart than the link distance plus both covering radii are pruned, the rest is compared in double
precision. A task returns, per vector, its number of links in these tiles and one link that spans its
component, so large groups of copies never become all their pairs.

Pruning follows the data: where vectors cluster, few node pairs survive; where they are spread evenly
in many dimensions, no exact method prunes much and the work grows with the square of a label.

Defined cases: vectors that are null, of norm zero or with null or non-finite parts, and rows without
label or id, link with nothing and are their own component; vectors of different length don't link;
repeated rows link with each other; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import components, table
from demandspark.sources import scratch

COSINE = 0.98
TILE = 2048
#: Points of a leaf.
LEAF = 16
_LINKS = "a long, b long, n long"


class CoverTree:
    """Unit vectors in nested balls; level k has radius 2 / 2^k, and each node knows its covering radius."""

    def __init__(self, points: np.ndarray):
        self.points, self.center, self.radius, self.children, self.members = points, [], [], [], []
        if len(points):
            self._node(0, np.arange(len(points)), 2.0)

    def _node(self, center: int, members: np.ndarray, scale: float) -> int:
        node, todo = len(self.center), [(len(self.center), members, scale)]
        self._add(center, members)
        while todo:
            parent, members, scale = todo.pop()
            if len(members) <= LEAF or scale < 1e-3:
                self.members[parent] = members
                continue
            scale /= 2
            rest, first = members, self.center[parent]
            while len(rest):
                inside = self._distance(first, rest) <= scale
                if not inside.any():  # rounding: a centre always holds itself
                    inside[0] = True
                child = len(self.center)
                self._add(first, rest[inside])
                self.children[parent].append(child)
                todo.append((child, rest[inside], scale))
                rest = rest[~inside]
                first = int(rest[0]) if len(rest) else first
        return node

    def _distance(self, center: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * (self.points[members] @ self.points[center])))

    def _add(self, center: int, members: np.ndarray) -> None:
        self.center.append(center)
        self.radius.append(float(self._distance(center, members).max()) + 1e-7)
        self.children.append([])
        self.members.append(None)


def pairs_within(one: CoverTree, two: CoverTree, reach: float):
    """Candidate pairs of points, in blocks: all that are at most ``reach`` apart, and few others."""
    todo = [(0, 0)] if one.center and two.center else []
    while todo:
        i, j = todo.pop()
        left, right = one.children[i], two.children[j]
        if not left and not right:
            a, b = np.meshgrid(one.members[i], two.members[j], indexing="ij")
            yield a.ravel(), b.ravel()
            continue
        left, right = np.array(left or [i]), np.array(right or [j])
        for at in range(0, len(left), 512):
            part = left[at : at + 512]
            p = one.points[[one.center[k] for k in part]]
            q = two.points[[two.center[k] for k in right]]
            apart = np.sqrt(np.maximum(0, 2 - 2 * (p @ q.T)))
            near = apart <= reach + np.array([one.radius[k] for k in part])[:, None] + np.array([two.radius[k] for k in right])
            todo += [(int(part[x]), int(right[y])) for x, y in zip(*np.nonzero(near))]


def _tile_links(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links between two tiles, or inside one: per vector their number and a spanning link."""
    side = pdf["side"].to_numpy()
    same = not (side == 1).any()
    raw = np.stack([np.asarray(v, float) for v in pdf["embedding"]])
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    unit = raw / norm[:, None]
    where = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if same else 1))
    trees = [CoverTree(unit[x]) for x in (where[:1] if same else where)]
    node, copies = pdf["node"].to_numpy(), pdf["copies"].to_numpy()
    links, label = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
    held, size = [], 0

    def settle():
        nonlocal label, links, held, size
        if held:
            i, j = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            on = np.einsum("ij,ij->i", raw[i], raw[j]) / (norm[i] * norm[j]) >= cosine
            i, j = i[on], j[on]
            links += np.bincount(i, copies[j], len(pdf)).astype(np.int64)
            if not same:
                links += np.bincount(j, copies[i], len(pdf)).astype(np.int64)
            label = _joined(label, i, j)
            held, size = [], 0

    for a, b in pairs_within(trees[0], trees[-1], np.sqrt(2 - 2 * cosine) + 1e-6):
        i, j = where[0][a], where[1][b]
        if same:
            i, j = i[i != j], j[i != j]
        held.append((i, j))
        size += len(i)
        if size > 100_000:
            settle()
    settle()
    on = np.flatnonzero(links)
    return pd.DataFrame({"a": node[on], "b": node[label[on]], "n": links[on]})


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable position, with the pairs (i, j) added."""
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of (vec_id, embedding, label)."""
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"), "label")
    sound = F.expr(
        "vec_id is not null and label is not null and embedding is not null"
        " and forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
        " and exists(embedding, v -> v <> 0)"
    )
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    keys = ["label", "embedding"]
    same = rows.where("sound").groupBy(*keys).agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    same = scratch.materialize(same, "vectors")
    group = ["label", "dimensions"]
    parts = same.withColumn("dimensions", F.size("embedding"))
    tiles = parts.groupBy(*group).agg(F.expr(f"int(ceil(count(*) / {TILE}))").alias("tiles"))
    tiles = scratch.materialize(tiles, "vector-tiles")
    dealt = parts.join(tiles, group).withColumn("tile", F.expr("int(pmod(xxhash64(node), tiles))"))
    # A tile meets itself and every other one: as the first of a pair, and as the second.
    meets = F.explode(F.expr("sequence(0, tiles - 1)"))
    dealt = dealt.withColumn("other", meets).select(
        *group, F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        F.expr("int(tile > other)").alias("side"), "node", "copies", "embedding",
    )
    found = dealt.groupBy(*group, "low", "high").applyInPandas(lambda pdf: _tile_links(pdf, cosine), _LINKS)
    found = scratch.materialize(found, "vector-links")
    roots = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    named = same.join(counts, same.node == counts.a, "left").join(roots, "node", "left").select(
        *keys, (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("component_id")
    )
    linked = rows.where("sound").join(named, keys).select("vec_id", "n_links", "component_id")
    alone = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.expr("coalesce(vec_id = component_id, true)"))


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors of a label at cosine 0.98."""
    return near_duplicates(table(spark, folder, "embeddings", "vec_id", "embedding", "label"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(embedding, lambda x: abs(x::DOUBLE))) > 0 AS sound
  FROM embeddings
), p AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.sound AND b.sound AND len(a.e) = len(b.e)
    AND list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98
), r(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a
), c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

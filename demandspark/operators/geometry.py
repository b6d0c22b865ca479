"""Delaunay triangles of tables of polygon rings.

A ring is one geometry value, as a row of a spatial table holds it. Spark spreads the rings;
each is triangulated inside a task from its own corners.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIANGLES = T.ArrayType(T.StructType([T.StructField(n, T.IntegerType()) for n in "abc"]))
_NOISE = 1e-14


def ring_vertices(polygons: DataFrame) -> DataFrame:
    """Vertex rows (polygon_id, vertex_idx, lon, lat) of closed rings, closing corner dropped.

    ``polygons`` holds either one array ``ring`` of (lon, lat) per polygon or vertex rows.
    """
    if "ring" in polygons.columns:
        size = F.size("ring")
        closed = (size > 1) & (F.get("ring", F.lit(0)) == F.get("ring", size - 1))
        opened = F.when(closed, F.slice("ring", 1, size - 1)).otherwise(F.col("ring"))
        return polygons.select("polygon_id", F.posexplode(opened).alias("vertex_idx", "_p")).select(
            "polygon_id", "vertex_idx", "_p.lon", "_p.lat"
        )
    ends = polygons.groupBy("polygon_id").agg(
        F.max("vertex_idx").alias("_last"),
        F.min("vertex_idx").alias("_first"),
        F.min_by(F.struct("lon", "lat"), "vertex_idx").alias("_from"),
        F.max_by(F.struct("lon", "lat"), "vertex_idx").alias("_to"),
    )
    closing = (
        (F.col("vertex_idx") == F.col("_last"))
        & (F.col("_last") > F.col("_first"))
        & (F.col("_from") == F.col("_to"))
    )
    return polygons.join(ends, "polygon_id").filter(~closing).select(*polygons.columns)


def _turn(p, q, r) -> float | Fraction:
    """Positive when p, q, r turn left; exact where floats cannot tell."""
    left, right = (q[0] - p[0]) * (r[1] - p[1]), (q[1] - p[1]) * (r[0] - p[0])
    if abs(left - right) > _NOISE * (abs(left) + abs(right)):
        return left - right
    (px, py), (qx, qy), (rx, ry) = [map(Fraction, map(float, v)) for v in (p, q, r)]
    return (qx - px) * (ry - py) - (qy - py) * (rx - px)


def _in_circle(p, q, r, d) -> Fraction:
    """Positive when d lies inside the circle through p, q, r (in left turn); exact."""
    rows = []
    for v in (p, q, r):
        x = Fraction(float(v[0])) - Fraction(float(d[0]))
        y = Fraction(float(v[1])) - Fraction(float(d[1]))
        rows.append((x, y, x * x + y * y))
    (a, b, c), (e, f, g), (h, i, j) = rows
    return a * (f * j - g * i) - b * (e * j - g * h) + c * (e * i - f * h)


class _Mesh:
    """Delaunay edges of different points in order of x and y, by divide and conquer (Guibas, Stolfi 1985).

    Edge ``e`` runs back as ``e ^ 1``. ``onext`` and ``oprev`` are the next edges around its origin, to the left
    and to the right. Halves are joined from their lower common tangent upwards.
    """

    def __init__(self, pts: np.ndarray):
        self.pts = list(map(tuple, pts.tolist()))
        self.org: list[int] = []
        self.onext: list[int] = []
        self.oprev: list[int] = []
        self.gone: set[int] = set()
        if len(self.pts) > 1:
            self._build(0, len(self.pts))

    def turn(self, a: int, b: int, c: int) -> float | Fraction:
        return _turn(self.pts[a], self.pts[b], self.pts[c])

    def inside(self, a: int, b: int, c: int, d: int) -> float | Fraction:
        """Sign tells whether d lies in the circle of a, b, c; exact where floats cannot tell."""
        p, q, r, (x, y) = self.pts[a], self.pts[b], self.pts[c], self.pts[d]
        px, py, qx, qy, rx, ry = p[0] - x, p[1] - y, q[0] - x, q[1] - y, r[0] - x, r[1] - y
        pp, qq, rr = px * px + py * py, qx * qx + qy * qy, rx * rx + ry * ry
        u, v, w = qx * ry, rx * py, px * qy
        k, m, n = qy * rx, ry * px, py * qx
        value = pp * (u - k) + qq * (v - m) + rr * (w - n)
        size = pp * (abs(u) + abs(k)) + qq * (abs(v) + abs(m)) + rr * (abs(w) + abs(n))
        return value if abs(value) > _NOISE * size else _in_circle(p, q, r, (x, y))

    def _edge(self, a: int, b: int) -> int:
        e = len(self.org)
        self.org += (a, b)
        self.onext += (e, e + 1)
        self.oprev += (e, e + 1)
        return e

    def _splice(self, a: int, b: int) -> None:
        onext, oprev = self.onext, self.oprev
        after_a, after_b = onext[a], onext[b]
        onext[a], onext[b] = after_b, after_a
        oprev[after_b], oprev[after_a] = a, b

    def _connect(self, a: int, b: int) -> int:
        """New edge from the end of a to the origin of b, along their common left face."""
        e = self._edge(self.org[a ^ 1], self.org[b])
        self._splice(e, self.oprev[a ^ 1])
        self._splice(e ^ 1, b)
        return e

    def _remove(self, e: int) -> None:
        self._splice(e, self.oprev[e])
        self._splice(e ^ 1, self.oprev[e ^ 1])
        self.gone.add(e >> 1)

    def _build(self, low: int, high: int) -> tuple[int, int]:
        """Edges of the hull: left turn out of the leftmost point, right turn out of the rightmost."""
        if high - low == 2:
            e = self._edge(low, low + 1)
            return e, e ^ 1
        if high - low == 3:
            a, b = self._edge(low, low + 1), self._edge(low + 1, low + 2)
            self._splice(a ^ 1, b)
            side = self.turn(low, low + 1, low + 2)
            if side == 0:
                return a, b ^ 1
            c = self._connect(b, a)
            return (a, b ^ 1) if side > 0 else (c ^ 1, c)
        middle = (low + high) // 2
        left, left_in = self._build(low, middle)
        right_in, right = self._build(middle, high)
        org, onext, oprev = self.org, self.onext, self.oprev
        while True:
            if self.turn(org[left_in], org[left_in ^ 1], org[right_in]) > 0:
                left_in = oprev[left_in ^ 1]
            elif self.turn(org[right_in], org[right_in ^ 1], org[left_in]) < 0:
                right_in = onext[right_in ^ 1]
            else:
                break
        base = self._connect(right_in ^ 1, left_in)
        if org[left_in] == org[left]:
            left = base ^ 1
        if org[right_in] == org[right]:
            right = base
        self._join(base)
        return left, right

    def _join(self, base: int) -> None:
        """Close the gap above the tangent, edge by edge; edges that lose their empty circle go."""
        org, onext, oprev = self.org, self.onext, self.oprev
        while True:
            start, end = org[base], org[base ^ 1]
            ups = []
            for edge, ring in ((onext[base ^ 1], onext), (oprev[base], oprev)):
                up = self.turn(start, end, org[edge ^ 1]) < 0
                while up and (after := org[ring[edge] ^ 1]) not in (start, end):
                    if self.turn(start, end, after) >= 0 or self.inside(end, start, org[edge ^ 1], after) <= 0:
                        break
                    edge, old = ring[edge], edge
                    self._remove(old)
                ups.append(edge if up else None)
            on_left, on_right = ups
            if on_left is None and on_right is None:
                return
            if on_left is None or on_right is not None and self.inside(end, start, org[on_left ^ 1], org[on_right ^ 1]) > 0:
                base = self._connect(on_right, base ^ 1)
            else:
                base = self._connect(base ^ 1, on_left ^ 1)

    def cells(self) -> list[list[int]]:
        """Corners in left turn of the faces; triangles on one circle are one face."""
        org, oprev = self.org, self.oprev
        face, corners = {}, []
        for e in range(len(org)):
            if e in face or e >> 1 in self.gone:
                continue
            f = oprev[e ^ 1]
            g = oprev[f ^ 1]
            if oprev[g ^ 1] == e and self.turn(org[e], org[f], org[g]) > 0:
                face.update(dict.fromkeys((e, f, g), len(corners)))
                corners.append((org[e], org[f], org[g]))
        root = list(range(len(corners)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for e, k in face.items():
            if e & 1 and e ^ 1 in face and self.inside(*corners[k], org[oprev[e] ^ 1]) == 0:
                root[find(k)] = find(face[e ^ 1])
        follows: dict[int, dict[int, int]] = {}
        for e, k in face.items():
            if e ^ 1 not in face or find(face[e ^ 1]) != find(k):
                follows.setdefault(find(k), {})[org[e]] = org[e ^ 1]
        out = []
        for ring in follows.values():
            cell = [next(iter(ring))]
            while (at := ring[cell[-1]]) != cell[0]:
                cell.append(at)
            out.append(cell)
        return out


def triangulate(ids: np.ndarray, lon: np.ndarray, lat: np.ndarray) -> list[tuple[int, int, int]]:
    """Delaunay triangles as sorted id triples, in n log n steps.

    Corners on one circle form one cell, cut as a fan from its lowest id. Repeated corners count
    once.
    """
    order = np.argsort(ids, kind="stable")
    ids, pts = ids[order], np.column_stack([lon, lat])[order].astype(float)
    _, first = np.unique(pts, axis=0, return_index=True)
    first.sort()
    ids, pts = ids[first], pts[first] - pts[0]
    if len(ids) < 3:
        return []
    # Points that differ may be equal once moved to the first one; the first of them stays.
    _, place = np.unique(pts, axis=0, return_index=True)
    out = []
    for cell in _Mesh(pts[place]).cells():
        cell = [int(place[k]) for k in cell]
        low = cell.index(min(cell))
        fan = cell[low:] + cell[:low]
        out += [(fan[0], p, q) for p, q in zip(fan[1:], fan[2:])]
    return sorted(tuple(sorted(int(ids[i]) for i in t)) for t in out)


@F.pandas_udf(TRIANGLES)
def _triangles(rings: pd.Series) -> pd.Series:
    def one(ring) -> list[dict]:
        corners = [(v["vertex_idx"], v["lon"], v["lat"]) for v in ring]
        ids, lon, lat = map(np.array, zip(*corners))
        return [dict(zip("abc", t)) for t in triangulate(ids, lon, lat)]

    return rings.map(one)


def delaunay_triangles(vertices: DataFrame) -> DataFrame:
    """Triangles (polygon_id, a, b, c with a < b < c) of each polygon's vertex set.

    They cover the convex hull; edges of the ring are not enforced.
    """
    known = vertices.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
    rings = known.groupBy("polygon_id").agg(
        F.collect_list(F.struct("vertex_idx", "lon", "lat")).alias("_ring")
    )
    return rings.select("polygon_id", F.explode(_triangles("_ring")).alias("_t")).select(
        "polygon_id", "_t.a", "_t.b", "_t.c"
    )

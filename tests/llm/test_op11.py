"""The trie against plain Python."""

import hashlib
import math
import zlib

import numpy as np
import pytest

from demandspark.llm import op11_trie as op
from demandspark.llm.registry import QUERIES

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    full = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - int(math.fmod(c, 100)), [])[:h] + mine[h:])
    members = {}
    for c, seq in full.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(full[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), parent, len(members[node]), len(below), leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_against_plain_python(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    assert found(QUERIES["op11_trie"][0](spark, folder)) == brute(rows)


@pytest.mark.parametrize(("base", "chunk"), [(50_000, 8192), (3, 2)])
def test_many_shapes(spark, monkeypatch, base, chunk):
    monkeypatch.setattr(op, "BASE", base)
    monkeypatch.setattr(op, "CHUNK", chunk)
    rng = np.random.default_rng(3)
    rows = []
    for conv in range(260):
        if conv == 100:  # a hundred without its first conversation
            continue
        for turn in range(int(rng.integers(1, 7))):
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", f"text {int(rng.integers(0, 2))} of {turn}"))
    rows += [(200, 100 + t, "user", f"long {t}") for t in range(300)]
    rows += [(300, None, "user", "no turn"), (300, 0, None, None), (301, None, "a", ""), (305, 1, "", "a"), (306, 1, "a", "")]
    rows += [(307, 1, "user", "x"), (307, 1, "user", "x"), (308, 5, "user", "y" * 300_000), (None, 1, "user", "lost"), (-7, 1, "user", "x")]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    docs = docs.selectExpr("*", "1 as place", "2 as slice", "3 as node", "4 as arc", "5 as DEPTH")
    assert found(op.trie(docs)) == brute(rows)


def test_no_rows(spark):
    assert op.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_ranks_of_lists(spark):
    order = np.random.default_rng(1).permutation(500).tolist()
    following = dict(zip(order, order[1:]))
    arcs = [(a, following.get(a), 1, a % 3, a) for a in order] + [(1000, None, 1, 1, 1)]
    frame = spark.createDataFrame(arcs, "arc long, next long, position long, leaves long, saved long")
    got = {r.arc: (r.position, r.leaves, r.saved) for r in op.ranked(frame, 20)[0].collect()}
    seen = [0, 0, 0]
    for k, a in enumerate(order):
        assert got[a] == tuple(seen)
        seen = [seen[0] + 1, seen[1] + a % 3, seen[2] + a]
    assert got[1000] == (0, 0, 0)

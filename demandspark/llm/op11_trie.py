"""Prefix trie of conversations by the Euler-tour technique.

1. Turns are put in order by a range sort and counted across slices, so a long conversation is spread over tasks.
   A prefix is known by the exclusive-or of two 64-bit hashes of (depth, role, text) of its turns: a running
   exclusive-or per slice, with one carried value per slice of a conversation that crosses slices.
2. Equal prefixes are one node, by an aggregation that is combined before the shuffle.
3. Every node has an enter and an exit arc. Enter goes to the first child or, without one, to the node's exit; exit
   goes to the next sibling's enter or to the parent's exit. Siblings are chained in the order of their node
   numbers, inside each slice of the written nodes and then from slice to slice, so a node with any number of children
   is not gathered.
4. The list of arcs is ranked: in each round the arcs whose coin is heads take over their successor if its coin is
   tails, which removes about a quarter of the list and leaves weights to carry. When ``BASE`` arcs or fewer are
   left (a constant bound) one task walks along them; then the rounds are undone in reverse.
5. The ranking carries three prefix sums: arcs (the position in the tour), leaves, and savings. The difference
   between a node's exit and its enter are its subtree's sums.

Each round is written to the shared folder. Digests of the conversations that end in a node are streamed over rows
of up to ``CHUNK`` joined numbers, in order, so a node in which any number of conversations end is not held in memory.

Defined cases: a null role or text is empty; a null turn comes first; turns of equal number are ordered by role and then
by a hash of the text; repeated rows are turns of their own; rows without conv_id are left out; no conversations give no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import placed, table
from demandspark.sources import scratch

#: Arcs that one task ranks by itself, and numbers joined in one row of a digest's input.
BASE, CHUNK = 50_000, 8192
#: Conversations share the first turns of the one that begins their hundred; at most so many turns.
GROUP, HEADS = 100, 6
_WEIGHTS = ("position", "leaves", "saved")


def turns(conversations: DataFrame) -> tuple[DataFrame, str]:
    """(conv_id, c1, c2, chars, slice, place) of every turn, in the conversation's order, and the written path."""
    empty = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")}
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), "turn", empty["role"].alias("role"), F.length(empty["text"]).cast("long").alias("chars"),
        F.xxhash64(empty["role"], empty["text"]).alias("c1"), F.xxhash64(F.lit(1), empty["role"], empty["text"]).alias("c2"),
    )
    return placed(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("c1"), F.col("c2")], "turns")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, c1, c2, chars, slice, shared) of all rebuilt turns; (conv_id, length) of all conversations.

    A conversation begins with the first ``h`` turns of the one that begins its hundred (``shared``: at most five
    rows of at most a hundred conversations per key) and goes on with its own turns after its first ``h``.
    """
    own = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = own.select(
        "conv_id", "n", F.expr(f"conv_id - conv_id % {GROUP}").alias("base"),
        F.expr(f"crc32(cast(cast(conv_id as string) as binary)) % {HEADS}").alias("h"),
    )
    bases = own.where(f"conv_id % {GROUP} = 0").select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    heads = numbered.where(f"conv_id % {GROUP} = 0 and place < {HEADS - 1}")
    heads = heads.select(F.col("conv_id").alias("base"), F.col("place"), "c1", "c2", "chars")
    shared = convs.where("taken > 0").join(heads, "base").where("place < h").select(
        "conv_id", F.expr("place + 1").alias("depth"), "c1", "c2", "chars", F.lit(-1).cast("long").alias("slice")
    )
    length = convs.select("conv_id", "taken", "h", F.expr("taken + greatest(n - h, 0)").alias("length"))
    rest = numbered.join(length.select("conv_id", "taken", "h"), "conv_id").where("place >= h").select(
        "conv_id", F.expr("place - h + taken + 1").alias("depth"), "c1", "c2", "chars", "slice"
    )
    return shared.unionByName(rest), length.select("conv_id", "length")


def prefixes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, p1, p2, q1, q2, chars, ends): key of each prefix and of the one before it; the root's keys are 0."""
    terms = rows.select(
        "conv_id", "slice", "depth", "chars", F.xxhash64("depth", "c1", "c2").alias("t1"), F.xxhash64(F.lit(1), "depth", "c2", "c1").alias("t2")
    )
    runs = terms.groupBy("conv_id", "slice").agg(F.expr("bit_xor(t1)").alias("x1"), F.expr("bit_xor(t2)").alias("x2"))
    # One row per slice that a conversation reaches; slice -1 has the shared turns, which come first.
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select(
        "conv_id", "slice", *(F.coalesce(F.expr(f"bit_xor(x{i})").over(earlier), F.lit(0).cast("long")).alias(f"x{i}") for i in (1, 2))
    )
    within = Window.partitionBy("conv_id", "slice").orderBy("depth")
    ran = terms.withColumns({f"r{i}": F.expr(f"bit_xor(t{i})").over(within) for i in (1, 2)})
    found = ran.join(carry, ["conv_id", "slice"]).join(lengths, "conv_id").select(
        "conv_id", "depth", *(F.expr(f"r{i} ^ x{i}").alias(f"p{i}") for i in (1, 2)),
        *(F.expr(f"r{i} ^ x{i} ^ t{i}").alias(f"q{i}") for i in (1, 2)), "chars", F.expr("depth = length").alias("ends"),
    )
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "p1", "p2", "q1", "q2", "chars")]
    return lengths.select("conv_id", *zero, F.expr("length = 0").alias("ends")).unionByName(found)


def digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of the conversations (conv_id) that end in each node."""

    def chunks(batches):
        last, ids = None, []
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for *key, conv in zip(rows["depth"], rows["p1"], rows["p2"], rows["conv_id"]):
                if key != last or len(ids) == CHUNK:
                    if ids:
                        out.append((*last, ids[0], ",".join(map(str, ids))))
                    last, ids = key, []
                ids.append(conv)
            yield _batch(out, ["depth", "p1", "p2", "first", "ids"])
        yield _batch([(*last, ids[0], ",".join(map(str, ids)))] if ids else [], ["depth", "p1", "p2", "first", "ids"])

    def hashed(batches):
        last, digest = None, None
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for *key, ids in zip(rows["depth"], rows["p1"], rows["p2"], rows["ids"]):
                if key == last:
                    digest.update(b",")
                else:
                    if last:
                        out.append((*last, digest.hexdigest()))
                    last, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield _batch(out, ["depth", "p1", "p2", "ends_sha256"])
        yield _batch([(*last, digest.hexdigest())] if last else [], ["depth", "p1", "p2", "ends_sha256"])

    ordered = ends.select("depth", "p1", "p2", "conv_id").orderBy("depth", "p1", "p2", "conv_id")
    joined = ordered.mapInArrow(chunks, "depth long, p1 long, p2 long, first long, ids string")
    joined = joined.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "first")
    return joined.mapInArrow(hashed, "depth long, p1 long, p2 long, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    types = [pa.string() if n in ("ids", "ends_sha256") else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def tour(tree: DataFrame) -> DataFrame:
    """(arc, next, and three weights) of the Euler tour of (node, parent, saved); arc = 2 node, and 1 more for exit."""
    slice_of = F.shiftright("node", 33)
    inside = Window.partitionBy("parent", "slice").orderBy("node")
    firsts = tree.where("parent is not null").withColumn("slice", slice_of)
    # One row per slice of a parent's children.
    runs = firsts.groupBy("parent", "slice").agg(F.min("node").alias("first"))
    runs = runs.withColumn("after", F.lead("first").over(Window.partitionBy("parent").orderBy("slice")))
    first_child = runs.groupBy(F.col("parent").alias("node")).agg(F.min("first").alias("child"))
    chained = firsts.select("node", "parent", "slice", F.lead("node").over(inside).alias("beside"))
    chained = chained.join(runs.select("parent", "slice", "after"), ["parent", "slice"]).select(
        "node", F.coalesce("beside", "after").alias("sibling")
    )
    rows = tree.join(first_child, "node", "left").join(chained, "node", "left")
    zero = F.lit(0).cast("long")
    enter = F.struct(
        F.expr("2 * node").alias("arc"), F.expr("coalesce(2 * child, 2 * node + 1)").alias("next"),
        F.lit(1).cast("long").alias("position"), F.expr("bigint(if(child is null, 1, 0))").alias("leaves"), F.col("saved").alias("saved"),
    )
    leave = F.struct(
        F.expr("2 * node + 1").alias("arc"), F.expr("coalesce(2 * sibling, 2 * parent + 1)").alias("next"),
        F.lit(1).cast("long").alias("position"), zero.alias("leaves"), zero.alias("saved"),
    )
    return rows.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")


def ranked(arcs: DataFrame, base: int | None = None) -> tuple[DataFrame, list[str]]:
    """(arc, and the sums of the weights of all arcs before it) of linked lists, and the paths that it reads.

    ``arcs``: (arc, next, weights); an arc that nobody's ``next`` names begins a list.
    """
    base = base or BASE
    now, path = scratch.stored(arcs, "tour")
    gone, paths, size, turn = [], [], now.count(), 0
    while size > base:
        coin = F.pmod(F.xxhash64(F.lit(turn), "arc"), F.lit(2))
        live = now.withColumn("heads", coin == 1)
        taken = live.where("not heads").select(
            F.col("arc").alias("other"), F.col("next").alias("beyond"), *(F.col(w).alias(f"{w}2") for w in _WEIGHTS)
        )
        # An arc whose coin is tails can be taken by the one before it, and nothing else happens to it in this round.
        met = live.where("heads").join(taken, F.col("next") == F.col("other"), "left")
        merged, merged_path = scratch.stored(met.drop("heads"), "tour-merged")
        removed = merged.where("other is not null").select(F.col("other").alias("arc"), F.col("arc").alias("by"), *_WEIGHTS)
        left = live.where("not heads").drop("heads").join(removed.select("arc"), "arc", "left_anti")
        kept = merged.select(
            "arc", F.expr("if(other is null, next, beyond)").alias("next"), *(F.expr(f"{w} + coalesce({w}2, 0)").alias(w) for w in _WEIGHTS)
        )
        new, new_path = scratch.stored(kept.unionByName(left.select(*kept.columns)), "tour")
        scratch.delete(arcs.sparkSession, path)
        gone.append((removed, merged_path))
        now, path, size, turn = new, new_path, new.count(), turn + 1

    def walk(frames):
        rows = pd.concat([pd.DataFrame(), *frames], ignore_index=True)
        if not len(rows):
            return
        at = pd.Series(np.arange(len(rows)), rows["arc"]).reindex(rows["next"]).fillna(-1).astype(int).to_numpy()
        begins = np.ones(len(rows), bool)
        begins[at[at >= 0]] = False
        weights, sums = rows[list(_WEIGHTS)].to_numpy(np.int64), np.zeros((len(rows), 3), np.int64)
        for k in np.flatnonzero(begins):
            before = np.zeros(3, np.int64)
            while k >= 0:
                sums[k] = before
                before = before + weights[k]
                k = at[k]
        yield pd.DataFrame({"arc": rows["arc"], **dict(zip(_WEIGHTS, sums.T))})

    # At most `base` rows: the bound holds for a table of any size.
    sums = now.coalesce(1).mapInPandas(walk, "arc long, position long, leaves long, saved long")
    sums, paths = scratch.stored(sums, "tour-sums"), [path]
    for removed, merged_path in reversed(gone):
        by = sums[0].select(F.col("arc").alias("by"), *(F.col(w).alias(f"{w}0") for w in _WEIGHTS))
        back = removed.join(by, "by").select("arc", *(F.expr(f"{w} + {w}0").alias(w) for w in _WEIGHTS))
        new = scratch.stored(sums[0].unionByName(back), "tour-sums")
        scratch.delete(arcs.sparkSession, sums[1], merged_path)
        sums = new
    scratch.delete(arcs.sparkSession, *paths)
    return sums[0], [sums[1]]


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    numbered, path = turns(conversations)
    rows, lengths = rebuilt(numbered)
    every, every_path = scratch.stored(prefixes(rows, lengths), "prefixes")
    scratch.delete(conversations.sparkSession, path)
    nodes = every.groupBy("depth", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        F.min("chars").alias("chars"),
    )
    nodes, _ = scratch.stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    hashes, _ = scratch.stored(digests(every.where("ends")), "ends")
    scratch.delete(conversations.sparkSession, every_path)
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("node").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    tree = nodes.join(above, ["depth", "q1", "q2"], "left").select(
        "node", "parent", "parent_conv_id", "conv_id", "depth", "p1", "p2", "n_convs", F.expr("(n_convs - 1) * chars").alias("saved")
    )
    tree, _ = scratch.stored(tree, "tree")
    sums, _ = ranked(tour(tree.select("node", "parent", "saved")))
    signed = {w: F.sum(F.when(F.col("arc") % 2 == 1, F.col(w)).otherwise(-F.col(w))) for w in ("leaves", "saved")}
    below = sums.groupBy(F.expr("arc div 2").alias("node")).agg(
        signed["leaves"].alias("n_leaves"), signed["saved"].alias("saved_tokens")
    )
    children = tree.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    none = hashlib.sha256(b"").hexdigest()
    found = tree.join(below, "node").join(children, "node", "left").join(hashes, ["depth", "p1", "p2"], "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return trie(table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))

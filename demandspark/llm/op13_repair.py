"""Cheapest repair of the order of roles in conversations, by auction on a lattice of edits.

A conversation's rows and the four states of ``(s?(ua)+)?`` (nothing yet, after s, after u, after a) are a lattice: Keep,
Rerole and Delete lead to the next row, Insert stays at the row. Costs are small integers.

Auction (after Bertsekas 1991). Every node has a price, at first a lower bound of what the faults behind it cost. A path
grows from the origin: if its last node's price is less than the best of arc + price, the price rises to it and the
path is contracted by one node; else the path is extended along that arc. At the end no price exceeds arc + price, and
the origin's price is the least cost. So the cheapest paths are those of tight arcs that lead to the goal, and the
smallest letter at each node gives the ASCII-least audit.

Long conversations. Rows are numbered by a range sort and cut into blocks of ``BLOCK`` rows, whose codes are one short
text. Auctions run per block: for blocks of longer conversations first the costs from each state to each, then one sweep over
a conversation's blocks (16 numbers for 64 rows) gives the price behind each block, then a second auction per block
against these prices gives the edits from each state; what is chosen is chained. The audit of a conversation is one value of
the result. Texts are shuffled once, to be hashed in order as they stream by; a digest is a chain, so a conversation's
texts pass one task, but are never held together.

Defined cases: nulls count as one space (also in the text that decides on the damage); a null turn comes first; rows of equal turn
are ordered by role and then by a hash of role and text; a null conv_id is a conversation of its own; repeated rows are
damaged alike and stay; other columns are ignored; no conversations give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import placed, table
from demandspark.sources import scratch

BLOCK = 64
SPACE = " \t\n\x0b\f\r"
#: States: nothing yet, after s, after u, after a. An edited or inserted row is a user, after a user an assistant.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
INITIALS = "sua"
#: Faults of a row, in the order in which they count.
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
_LEGAL = {(0, 1), (1, 2), (2, 1)}
NEVER = 1 << 40
_PLAN = "array<struct<exit:int,cost:long,edits:string>>"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows dropped, emptied, cut, repeated or made the user's by a checksum of id and turn."""
    space = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
    )
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("what", F.crc32(name.cast("binary")) % 20).where("what <> 0")
    return rows.select(
        "conv_id", "turn", F.expr("if(what = 4, 'user', role)").alias("role"),
        F.expr("case what when 1 then '' when 2 then regexp_replace(text, '[.!?]', '') else text end").alias("text"),
        F.explode(F.expr("if(what = 3, array(0, 1), array(0))")).alias("copy"),
    ).drop("copy")


def _hashes() -> list[Column]:
    return [F.xxhash64("role", "text").alias("c1"), F.xxhash64(F.lit(1), "role", "text").alias("c2")]


def order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("c1"), F.col("c2")]


def blocks(rows: DataFrame) -> tuple[DataFrame, str, DataFrame]:
    """(conv_id, block, codes), written, its path, and (conv_id, gaps). A code is a letter of a row's initial and fault."""
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    narrow = rows.select("conv_id", "turn", "role", *_hashes(), initial.alias("initial"), fault.alias("fault"))
    numbered, path = placed(narrow, "conv_id", order(), "rows")
    gaps = numbered.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    gaps, _ = scratch.stored(gaps, "gaps")
    # A row is new if it is the first of its role and text; the places of those are marks among the rows of the block.
    marks = numbered.groupBy("conv_id", "c1", "c2").agg(F.min("place").alias("place")).select("conv_id", "place", F.lit(-1).alias("code"))
    marked = numbered.select("conv_id", "place", F.expr("int(initial * 4 + fault)").alias("code")).unionByName(marks)
    lists = marked.groupBy("conv_id", F.expr(f"place div {BLOCK}").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("place", "code"))).alias("list")  # at most two entries per row of a block
    )
    repeated = f"list[i].code % 4 <> {BLANK} and (i = 0 or list[i - 1].code >= 0 or list[i - 1].place <> list[i].place)"
    code = f"if({repeated}, list[i].code - list[i].code % 4 + {DUPLICATE}, list[i].code)"
    real = "filter(sequence(0, size(list) - 1), i -> list[i].code >= 0)"
    text = F.expr(f"array_join(transform({real}, i -> char(65 + {code})), '')").alias("codes")
    done, done_path = scratch.stored(lists.select("conv_id", "block", text), "blocks")
    scratch.delete(rows.sparkSession, path)
    return done, done_path, gaps


def arcs(codes: str, row: int, state: int, exits: tuple[int, ...], last: bool) -> list[tuple[int, int, str]]:
    """(cost, node, letter) of the edits at a row in a state; node = 4 row + state, and one beyond all is the goal."""
    goal, here, target = 4 * len(codes) + 4, 4 * row, AFTER_A if state == AFTER_U else AFTER_U
    if row == len(codes):
        out = [(exits[state], goal, "")] if exits[state] < NEVER else []
        return [*out, (2, here + target, "I")] if last else out
    initial, fault = divmod(ord(codes[row]) - 65, 4)
    out = [(3, here + 4 + state, "D"), (2, here + target, "I")]
    if fault in (FINE, TRUNCATED):
        keeps = AFTER_S if initial == 0 and state == NOTHING else target if initial == target - 1 else None
        if keeps is not None:
            out.append((fault, here + 4 + keeps, "K"))
        out.append((2 + fault, here + 4 + target, "R"))
    return out


def leading(graph: list[list[tuple[int, int, str]]]) -> list[bool]:
    """Nodes from which arcs lead to the goal, the node behind all."""
    leads = [False] * len(graph) + [True]
    for row in range(len(graph) // 4 - 1, -1, -1):
        for k in [*range(4 * row, 4 * row + 4)] * 3:  # inserts stay in the row; two lead to any state they can reach
            leads[k] = leads[k] or any(leads[to] for _, to, _ in graph[k])
    return leads


def auction(codes: str, states: Sequence[int], exits: tuple[int, ...], last: bool) -> tuple[list[list], list[int]]:
    """Arcs and converged prices of all nodes, for paths from some states before the first row to the goal.

    One state after the other is the origin; each goes on from the prices that the ones before it left.
    ``exits``: price of leaving the block in each state. ``last``: rows can be inserted behind the last one.
    """
    least = [0] * (len(codes) + 1)
    least[-1] = min(exits)
    for row in range(len(codes) - 1, -1, -1):  # no arc costs less than this difference
        least[row] = least[row + 1] + (0, 1, 3, 3)[(ord(codes[row]) - 65) % 4]
    graph = [arcs(codes, k // 4, k % 4, exits, last) for k in range(4 * len(codes) + 4)]
    goal, leads = len(graph), leading(graph)
    graph = [[a for a in out if leads[a[1]]] for out in graph]  # where no path leads on, prices would rise for ever
    price = [least[k // 4] if leads[k] else NEVER for k in range(goal)] + [0]
    for origin in states:
        path = [origin]
        while path[-1] != goal and leads[origin]:
            node = path[-1]
            best, after = min((cost + price[to], to) for cost, to, _ in graph[node])
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(after)
    return graph, price


@lru_cache(1 << 16)
def repaired(codes: str, state: int, exits: tuple[int, ...], last: bool) -> tuple[int, int, str]:
    """(state at the end, own cost, edits) of the cheapest way through a block, ASCII-least among equals."""
    graph, price = auction(codes, (state,), exits, last)
    if price[state] >= NEVER:
        return -1, NEVER, ""
    goal = len(graph)
    tight = [[a for a in graph[k] if a[0] + price[a[1]] == price[k]] for k in range(goal)]
    leads = leading(tight)
    node, cost, edits = state, 0, []
    while True:
        spent, to, letter = min((a for a in tight[node] if leads[a[1]]), key=lambda a: a[2])
        if to == goal:
            return node % 4, cost, "".join(edits)
        node, cost = to, cost + spent
        edits.append(letter)


@lru_cache(1 << 14)
def costs(codes: str, last: bool) -> tuple[int, ...]:
    """Least cost of a block from each state to each (16), or of the last block from each state to the end (4)."""
    if last:
        return tuple(auction(codes, range(4), (0, NEVER, NEVER, 0), True)[1][:4])
    only = [tuple(0 if t == e else NEVER for t in range(4)) for e in range(4)]
    ends = [auction(codes, range(4), exits, False)[1] for exits in only]
    return tuple(min(NEVER, ends[e][s]) for s in range(4) for e in range(4))


def _block_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        found = [costs(c, b == n) for c, b, n in zip(rows["codes"], rows["block"], rows["n"])]
        kept = [batch.column(c) for c in ("conv_id", "block")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(pa.int64()))], ["conv_id", "block", "costs"])


def _sweep(pdf: pd.DataFrame) -> pd.DataFrame:
    """Prices behind each block of one conversation, from its last block to its first."""
    pdf = pdf.sort_values("block")
    behind, out = (0, NEVER, NEVER, 0), []
    for k, found in enumerate(reversed(list(pdf["costs"]))):
        out.append(list(behind))
        if k == 0:
            behind = tuple(int(x) for x in found)
        else:
            behind = tuple(min(int(found[4 * s + e]) + behind[e] for e in range(4)) for s in range(4))
    return pd.DataFrame({"conv_id": pdf["conv_id"], "block": pdf["block"], "exits": out[::-1]})


def _block_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits from each state at which a block can be entered, and what its rows count."""
    names = ["conv_id", "block", "plans", "counts"]
    for batch in batches:
        rows = batch.to_pydict()
        plans, counts = [], []
        for codes, block, last, exits in zip(rows["codes"], rows["block"], rows["n"], rows["exits"]):
            exits = tuple(exits) if exits is not None else (0, NEVER, NEVER, 0)
            begins = range(4) if block else range(1)
            made = (repaired(codes, s, exits, block == last) for s in begins)
            plans.append([dict(zip(("exit", "cost", "edits"), p)) for p in made])
            numbers = [ord(c) - 65 for c in codes]
            faults = [sum(x % 4 == f for x in numbers) for f in (BLANK, DUPLICATE, TRUNCATED)]
            wrong = sum((a // 4, b // 4) not in _LEGAL for a, b in zip(numbers, numbers[1:]))
            counts.append([*faults, wrong, numbers[0] // 4, numbers[-1] // 4])
        types = pa.list_(pa.struct([("exit", pa.int32()), ("cost", pa.int64()), ("edits", pa.string())]))
        columns = [batch.column("conv_id"), batch.column("block"), pa.array(plans, types), pa.array(counts, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names)


_REPORT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plans of a conversation's blocks, each entered where the one before it ends."""
    for batch in batches:
        out = []
        for conv, chain in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "chain"))):
            state, cost, edits, sums, before = NOTHING, 0, [], [0] * 4, None
            for block in chain:
                plan, counts = block["plans"][state], block["counts"]
                state, cost = plan["exit"], cost + plan["cost"]
                edits.append(plan["edits"])
                sums = [a + b for a, b in zip(sums, counts)]
                sums[3] += before is not None and (before, counts[4]) not in _LEGAL
                before = counts[5]
            out.append((conv, *sums, cost, "".join(edits)))
        names = [f.split()[0] for f in _REPORT.split(", ")]
        types = [pa.int64()] * 6 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)], names)


def plans(cut: DataFrame) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of each conversation that has rows."""
    last = cut.groupBy("conv_id").agg(F.max("block").alias("n")).withColumnRenamed("conv_id", "_conv")
    rows = cut.join(last, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    long = rows.where("n > 0").mapInArrow(_block_costs, "conv_id long, block long, costs array<long>")
    prices = long.groupBy("conv_id").applyInPandas(_sweep, "conv_id long, block long, exits array<long>")
    prices = prices.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "exits")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))
    priced = rows.join(prices, same, "left").drop("_conv", "_block")
    made = priced.mapInArrow(_block_edits, f"conv_id long, block long, plans {_PLAN}, counts array<long>")
    # One row of a few letters per row of the conversation, as its audit has.
    chains = made.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "plans", "counts"))).alias("chain"))
    return chains.mapInArrow(_chained, _REPORT)


class Digest:
    """SHA-256 of a conversation's repaired lines, from its edits and its rows in order."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state, self.sha, self.lines = edits, 0, NOTHING, hashlib.sha256(), 0

    def line(self, role: str, text: str) -> None:
        self.sha.update(b"\n" * (self.lines > 0) + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1

    def placed(self) -> str:
        """The role of an inserted or changed row, after which it is the other's turn."""
        role, self.state = ("assistant", AFTER_A) if self.state == AFTER_U else ("user", AFTER_U)
        return role

    def inserts(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.line(self.placed(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.edits[self.at]
        self.at += 1
        if letter == "R":
            self.line(self.placed(), text)
        elif letter == "K":
            self.line(role, text)
            self.state = AFTER_S if role[:1] == "s" else AFTER_U if role[:1] == "u" else AFTER_A

    def hexdigest(self) -> str:
        self.inserts()
        return self.sha.hexdigest()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, its audit first."""
    conv, now = None, None
    for batch in batches:
        out = []
        for of, edits, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
            if edits is not None:
                if now:
                    out.append((conv, now.hexdigest()))
                conv, now = of, Digest(edits)
            else:
                now.row(role, text)
        yield _found(out)
    yield _found([(conv, now.hexdigest())] if now else [])


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string()))], ["conv_id", "repaired_sha256"])


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the conversations that have an audit."""
    heads = audits.select("conv_id", "audit").withColumns(
        {"turn": F.lit(None).cast("long"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"),
         "c1": F.lit(0).cast("long"), "c2": F.lit(0).cast("long")}
    )
    every = rows.select("conv_id", F.lit(None).cast("string").alias("audit"), "turn", "role", "text", *_hashes()).unionByName(heads)
    every = every.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), *order())
    return every.select("conv_id", "audit", "role", "text").mapInArrow(_digested, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """One row per conversation: what is wrong with its rows, the cheapest edits, and the digest of the repaired rows.

    ``rows`` are those of ``conversations`` as they are found; by default these are damaged first.
    """
    rows = damaged(conversations) if rows is None else rows
    cut, path, gaps = blocks(rows)
    found, _ = scratch.stored(plans(cut), "audits")
    scratch.delete(conversations.sparkSession, path)
    parts = [gaps, found, digests(rows, found)]
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    for k, part in enumerate(parts):
        part = part.withColumnRenamed("conv_id", f"_conv{k}")
        every = every.join(part, F.col("conv_id").eqNullSafe(F.col(f"_conv{k}")), "left").drop(f"_conv{k}")
    zeros = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return every.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256")
    )


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and cheapest repair of every conversation."""
    return repair(table(spark, folder, "conversations", "conv_id", "turn", "role", "text"))

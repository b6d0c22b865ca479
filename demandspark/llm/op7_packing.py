"""Pattern packing of tokenised documents into fixed-length sequences (Krell et al. 2021).

1. Tasks tokenise whole texts, cut what is longer than a sequence, and number the pieces of each
   length within their partition. The pieces are written once, so the numbers stay what they are.
2. Only the histogram of lengths (at most ``length`` rows) reaches the driver. Patterns of up to
   three lengths that fill a sequence exactly are enumerated, their repeat counts fitted to the
   histogram by non-negative least squares, rounded, and what is left is packed best fit, all on
   counts: the driver's work depends on the sequence length and not on the number of documents.
3. Counts per partition and length, summed over partitions, turn the places into ranks; a piece
   finds its sequence and offset by binary search for (length, rank) in the plan.

Token ids are those of the ``tokenizers`` library for the given file. They are computed by an
encoder made from the file's own vocabulary and cached per stretch between single spaces, at
which the file's splitting rule always cuts; a test compares both libraries.

Defined cases: a null or empty text is one piece that holds the end id alone; repeated rows are
packed as often as they come; a null doc_id is carried through; other columns are ignored; no
documents give no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import table
from demandspark.sources import scratch

LENGTH = 1024
END_ID = 2
#: Entries of a worker's cache; a stretch longer than CACHED characters is encoded anew each time.
CACHE, CACHED = 500_000, 40
#: Rounds of the least-squares fit.
ROUNDS = 300
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        vocabulary = described["model"]["vocab"]
        added = {t["content"]: t["id"] for t in described.get("added_tokens", [])}
        # Byte-level files write byte b as its own character if that is printable, else as 256 + its place among the rest.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in own]
        letters = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if all(c in letters for c in t)}
        for token in added:
            ranks.pop(token.encode(), None)
        self.encode = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_ordinary
        self.known: dict[str, bytes] = {}
        # Added tokens are cut out of a text before anything else, the longest first where several begin.
        longest = sorted(added, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, longest))})") if longest else None
        self.added_ids = {token: np.array([i], "<u4").tobytes() for token, i in added.items()}

    def plain(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()

    def __getitem__(self, stretch: str) -> bytes:
        found = self.known.get(stretch)
        if found is None:
            found = self.plain(" " + stretch)
            if len(stretch) <= CACHED:
                if len(self.known) >= CACHE:
                    self.known.clear()
                self.known[stretch] = found
        return found

    def ids(self, text: str) -> bytes:
        if self.added and self.added.search(text):
            return b"".join(self.added_ids.get(part) or self.between(part) for part in self.added.split(text) if part)
        return self.between(text)

    def between(self, text: str) -> bytes:
        if _RUN_OF_SPACE.search(text):  # the rule looks at runs of white space as a whole
            return self.plain(text)
        first, *rest = text.split(" ")
        known = self.known
        try:
            return self.plain(first) + b"".join([known[x] for x in rest])
        except KeyError:
            return self.plain(first) + b"".join([self[x] for x in rest])


_RUN_OF_SPACE = re.compile(r"\s\s")


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, kept from task to task."""
    return Encoder(path)


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``length`` ids with their place among those of equal length in the partition."""

    def run(batches):
        encode, part = encoder(path).ids, TaskContext.get().partitionId()
        end, places = np.array([end_id], "<u4").tobytes(), np.zeros(length + 1, np.int64).tolist()
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                total = len(ids) // 4
                start = 0
                stop = total if total <= length else total % length or length
                number = 0
                while start < total:
                    size = stop - start
                    row = (doc, number, start, size, zlib.crc32(ids[4 * start : 4 * stop]), places[size])
                    for column, value in zip(out, row):
                        column.append(value)
                    places[size] += 1
                    start, stop, number = stop, stop + length, number + 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(out, types)]
            columns.insert(5, pa.array([part] * len(out[0]), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PIECES.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _PIECES)


def patterns(length: int, present: np.ndarray) -> np.ndarray:
    """All a >= b >= c with a + b + c = length, zeros for absent documents; only lengths that occur."""
    found = []
    for c in range(0, length // 3 + 1):
        b = np.arange(max(c, 1), (length - c) // 2 + 1)
        found.append(np.stack([length - c - b, b, np.full_like(b, c)], 1))
    found = np.concatenate(found)
    return found[present[found].all(1)]


def fit(found: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 with small |Ax - h|: multiplicative updates keep them non-negative."""
    size, (a, b, c) = len(histogram), found.T

    def back(r):
        return r[a] + r[b] + r[c] * (c > 0)

    def forth(x):
        made = sum(np.bincount(k, x, size) for k in (a, b, c))
        made[0] = 0
        return made

    target, x = back(histogram), np.full(len(found), 1.0)
    for _ in range(ROUNDS):
        x *= target / np.maximum(back(forth(x)), 1e-9)
    return x


def plan(histogram: np.ndarray, length: int = LENGTH) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that together use each length as often as the histogram says."""
    left, made = histogram.astype(np.int64).copy(), []

    def take(pattern: tuple[int, ...], times: int) -> None:
        np.subtract.at(left, list(pattern), times)
        made.append((pattern, times))

    if left[length]:
        take((length,), int(left[length]))
    found = patterns(length, np.concatenate([[True], left[1:] > 0]))
    if len(found):
        repeats = fit(found, left.astype(float))
        for k in np.argsort(-repeats, kind="stable"):
            pattern = tuple(int(v) for v in found[k] if v)
            need = {v: pattern.count(v) for v in pattern}
            times = min(int(repeats[k]), *(int(left[v]) // n for v, n in need.items()))
            if times > 0:
                take(pattern, times)
    return made + best_fit(left, length)


def best_fit(left: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for many equal documents and sequences at a time."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for size in range(length, 0, -1):
        n = int(left[size])
        while n:
            room = min((r for r in free if r >= size), default=None)
            if room is None:
                room, pattern, times = length, (), n
            else:
                pattern, times = free[room].pop()
                if not free[room]:
                    del free[room]
            each = min(room // size, n)
            used = min(times, n // each)
            free.setdefault(room - each * size, []).append((pattern + (size,) * each, used))
            if times > used and pattern:
                free.setdefault(room, []).append((pattern, times - used))
            n -= used * each
    return [group for groups in free.values() for group in groups]


def _slots(planned: list[tuple[tuple[int, ...], int]], length: int) -> tuple[np.ndarray, ...]:
    """Per stretch of ranks of a length: sorted (length, rank) keys, first sequence and offset."""
    used, base, rows = np.zeros(length + 1, np.int64), 0, []
    for pattern, times in planned:
        offset = 0
        for size in pattern:
            rows.append(((size << 48) + int(used[size]), base, offset))
            used[size] += times
            offset += size
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its sequence_id and its offset there."""
    cut = scratch.materialize(pieces(docs, path, length, end_id), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = scratch.materialize(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    histogram = np.zeros(length + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `length` rows
        histogram[row["length"]] = row["n"]
    keys, first, offsets = _slots(plan(histogram, length), length)

    def place(frames):
        for frame in frames:
            key = (frame["length"].to_numpy() << 48) + frame.pop("rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            yield frame.assign(sequence_id=first[at] + key - keys[at], offset=offsets[at])

    ranked = cut.join(counts.select("part", "length", "before"), ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("before")).alias("rank")
    )
    return ranked.mapInPandas(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return pack(table(spark, folder, "documents", "doc_id", "text"), tokenizer_path())

"""Benchmark decontamination: n-gram seeds counted per diagonal, then Smith-Waterman alignment of words.

1. Benchmark items are taken in blocks of bounded size and sent to the tasks. Every n-gram of an item is a seed.
2. One pass over the documents finds the seeds. A copy of an item of length L that reaches the least score S
   differs in at most L - S edits, so it keeps at least 2 S - L - (N - 1) of the item's n-grams, on diagonals at
   most L - S apart. For N = 3 that is one n-gram or more at any length, so a copy always has a seed. Where fewer
   seeds lie together no copy can be; that is the only reason not to align, and no n-gram is left out.
3. The item is aligned with the words around the other seeds (match 1, mismatch -1, gap -1). An item is in a
   document if the best score reaches ``SCORE`` of the item's length and at least ``min(8, length)`` words agree.

Words are runs of letters, digits and underscores in lower case. No text is shuffled.

Defined cases: a null or empty text or item matches nothing; items shorter than an n-gram are one
seed as a whole; repeated rows are reported each; a null doc_id is carried; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import slices, table

N = 3
SCORE = 0.6
LEAST = 8
#: Bounds of a block of items that is sent to every task.
BLOCK_ITEMS, BLOCK_CHARS = 2000, 4_000_000
_WORD = re.compile(r"\w+")
_FOUND = "doc_id long, item_id long, score double, start long, end long"


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


@dataclass
class Block:
    """Items of a block: word ids; sorted n-gram codes, where those at ``first[c]:first[c + 1]`` have code c's (item, offset).

    A copy of item k has at least ``need[k]`` of its n-grams on diagonals at most ``drift[k]`` apart.
    """

    items: list[tuple[int, str]]
    words: dict[str, int] = field(default_factory=dict)
    ids: list[np.ndarray] = field(default_factory=list)
    codes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    offset: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    need: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    drift: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def __post_init__(self):
        for k, (_, text) in enumerate(self.items):
            words = _WORD.findall(lowered(text))
            self.ids.append(np.array([self.words.setdefault(w, len(self.words) + 1) for w in words], np.int64))
        grams = [self.grams(ids) for ids in self.ids]
        if grams:
            codes = np.concatenate([c for _, c in grams])
            order = np.argsort(codes, kind="stable")
            self.item = np.repeat(np.arange(len(grams)), [len(c) for _, c in grams])[order]
            self.offset = np.concatenate([at for at, _ in grams])[order]
            self.codes, counts = np.unique(codes, return_counts=True)
            self.first = np.concatenate([[0], np.cumsum(counts)])
        sizes = [len(ids) for ids in self.ids]
        least = [math.ceil(needed(n) - 1e-9) for n in sizes]
        self.need = np.array([max(1, 2 * s - n - (N - 1)) for s, n in zip(least, sizes)], np.int64)
        self.drift = np.array([n - s for s, n in zip(least, sizes)], np.int64)

    def grams(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, code) of the n-grams without unknown words (id 0)."""
        if len(ids) < N:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = ids > 0
        at = np.flatnonzero(np.logical_and.reduce([known[k : len(ids) - N + 1 + k] for k in range(N)]))
        code = np.zeros(len(at), np.int64)
        for k in range(N):
            code = code * (len(self.words) + 1) + ids[at + k]
        return at, code

    def short(self) -> list[int]:
        return [k for k, ids in enumerate(self.ids) if 0 < len(ids) < N]

    def hits(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(document number, its word ids, positions of seeds, numbers of their codes) for documents that hold any."""
        lists = [_WORD.findall(lowered(t)) if t else [] for t in texts]
        sizes = np.array([len(x) + 1 for x in lists])
        starts = np.cumsum(sizes) - sizes
        ids = np.zeros(int(sizes.sum()), np.int64)
        for start, words in zip(starts, lists):  # a zero stays between documents
            ids[start : start + len(words)] = np.fromiter(map(self.words.get, words, repeat(0)), np.int64, len(words))
        at, code = self.grams(ids)
        if len(self.codes):
            near = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            on = self.codes[near] == code
            at, code = at[on], near[on]
        else:
            at, code = at[:0], code[:0]
        of = np.searchsorted(starts, at, "right") - 1
        for number in np.unique(of) if not self.short() else range(len(texts)):
            low, high = np.searchsorted(of, [number, number + 1])
            start = starts[number]
            yield int(number), ids[start : start + sizes[number] - 1], at[low:high] - start, code[low:high]

    def spots(self, at: np.ndarray, codes: np.ndarray) -> list[tuple[int, int]]:
        """(item number, diagonal), in order, of the seeds that lie with as many others as a copy has."""
        counts = self.first[codes + 1] - self.first[codes]
        place = np.repeat(self.first[codes] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        item, start = self.item[place], np.repeat(at, counts) - self.offset[place]
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        last = np.arange(len(item)) + self.need[item] - 1
        begin = np.flatnonzero(last < len(item))
        last = last[begin]
        on = (item[last] == item[begin]) & (start[last] - start[begin] <= self.drift[item[begin]])
        steps = np.zeros(len(item) + 1, np.int64)
        np.add.at(steps, begin[on], 1)
        np.add.at(steps, last[on] + 1, -1)
        near = np.cumsum(steps[:-1]) > 0
        return list(zip(item[near].tolist(), start[near].tolist()))


def needed(size: int) -> float:
    """Least score of an item of ``size`` words."""
    return max(SCORE * size, min(LEAST, size))


def align(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman: (best score, position after its last word)."""
    column = np.arange(len(words) + 1)
    above, best, end = np.zeros(len(words) + 1, np.int64), 0, 0
    for word in item:
        row = np.maximum(np.maximum(above - 1, 0), 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(words == word, 1, -1))
        row = np.maximum.accumulate(row + column) - column
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def located(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """(score, first word, position after the last word) of the best local alignment."""
    score, end = align(item, words)
    _, back = align(item[::-1], words[:end][::-1])
    return score, end - back, end


def matches(block: Block, ids: np.ndarray, at: np.ndarray, codes: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
    """(item number, score, first word, position after the last word) for the items found in a document."""
    regions: dict[int, list[list[int]]] = {}
    for k, start in block.spots(at, codes):
        slack = len(block.ids[k]) // 2 + 2
        low, high = max(0, start - slack), min(len(ids), start + len(block.ids[k]) + slack)
        mine = regions.setdefault(k, [])
        if mine and low <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], high)
        else:
            mine.append([low, high])
    for k in block.short():
        own = block.ids[k]
        spread = [low for low in range(len(ids) - len(own) + 1) if (ids[low : low + len(own)] == own).all()]
        if spread:
            yield k, 1.0, spread[0], spread[0] + len(own)
    for k, spans in regions.items():
        item, best = block.ids[k], None
        for low, high in spans:
            score, first, last = located(item, ids[low:high])
            if score >= needed(len(item)) and (best is None or score > best[0]):
                best = (score, low + first, low + last)
        if best:
            yield k, best[0] / len(item), best[1], best[2]


def blocks(benchmark: DataFrame) -> Iterator[Block]:
    """Items in blocks of bounded number and size (an item too long for a block is one by itself)."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null and item_id is not null").distinct()
    count, chars = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    number = max(1, -(-count // BLOCK_ITEMS), -(-(chars or 0) // BLOCK_CHARS))
    for k in range(number if count else 0):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == k)
        yield Block([tuple(r) for r in part.orderBy("item_id", "text").collect()])


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, start, end): items found in documents, with the passage in code points."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    out = docs.sparkSession.createDataFrame([], _FOUND)
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            block = sent.value
            for batch in batches:
                found, done = [], 0
                for part in slices(batch.column(1)):
                    texts = part.to_pylist()
                    for number, *hit in block.hits(texts):
                        for k, score, first, last in matches(block, *hit):
                            spans = [m.span() for m in _WORD.finditer(lowered(texts[number]))]
                            doc = batch.column(0)[done + number].as_py()
                            found.append((doc, block.items[k][0], score, spans[first][0], spans[last - 1][1]))
                    done += len(texts)
                columns = list(zip(*found)) or [[]] * 5
                types = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64())
                names = ["doc_id", "item_id", "score", "start", "end"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        out = out.unionByName(rows.mapInArrow(run, _FOUND))
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds none of the items."""
    at = docs.columns.index("text")
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, sent=sent):
            block = sent.value
            for batch in batches:
                keep, done = np.ones(batch.num_rows, bool), 0
                for part in slices(batch.column(at)):
                    texts = part.to_pylist()
                    for number, *hit in block.hits(texts):
                        keep[done + number] = next(matches(block, *hit), None) is None
                    done += len(texts)
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return find(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "benchmark", "item_id", "text"))

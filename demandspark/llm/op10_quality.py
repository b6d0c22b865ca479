"""Quality classifier: supervised subword embeddings (after fastText), trained by numpy SGD.

Every word and every character n-gram of ``<word>`` is hashed to a learned vector, as is the event
that a word repeats the one before. A document is the mean of its vectors, a softmax over the two
labels gives the score. Training runs in one task over a bounded sample of labelled rows (``SAMPLE``,
those with the smallest hash of doc_id outside the held-out fold); the model that leaves it has one
number per bucket, since mean and output layer are linear. Scoring reads every whole text once.

Defined cases: a null text counts as empty; a text without words gets the score of the bias alone;
labels that are null or without document are not learned from; without any label every score is 0.5;
repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import fresh, slices, table

#: Bound on the labelled rows that are learned from.
SAMPLE = 3000
BUCKETS = 1 << 17
GRAMS = (3, 4)
DIMENSIONS = 12
#: Steps of training, as whole passes over the sample.
STEPS = 12_000
RATE = 0.6
THRESHOLD = 0.3
#: Words of a worker's cache.
CACHE = 300_000


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every word as a whole and of each of its character n-grams."""
    points = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    of, starts = np.repeat(np.arange(len(words)), sizes), ends - sizes
    inside = np.arange(len(points)) - starts[of]
    powers = np.cumprod(np.full(int(sizes.max()), 0x100000001B3, np.uint64))
    whole = np.add.reduceat(points * powers[inside], starts)
    numbers, buckets = [np.arange(len(words))], [_mix(whole)]
    for n in GRAMS:
        at = np.flatnonzero(inside + n <= sizes[of])
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + points[at + k]
        numbers.append(of[at])
        buckets.append(_mix(h))
    return np.concatenate(numbers), np.concatenate(buckets)


#: The bucket of "this word is the one before", beside the hashed ones.
REPEAT = BUCKETS


class Known(dict):
    """Per word the sum of its features' weights (real part) and their number (imaginary part)."""

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def learn(self, texts: list[list[str]]) -> None:
        """Look up all words that are new in these texts at once."""
        if len(self) > CACHE:
            self.clear()
        new = list(set().union(*texts) - self.keys())
        if new:
            numbers, buckets = features(new)
            sums = np.bincount(numbers, self.weights[buckets], len(new))
            self.update(zip(new, (sums + 1j * np.bincount(numbers, minlength=len(new))).tolist()))

    def odds(self, words: list[str]) -> float:
        same = sum(map(eq, words, words[1:]))
        total = sum(map(self.__getitem__, words), complex(same * self.weights[REPEAT], same))
        return total.real / max(1.0, total.imag)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = Counter(words)
    numbers, buckets = features(list(counts))
    times = np.bincount(buckets, np.fromiter(counts.values(), float)[numbers], BUCKETS + 1)
    times[REPEAT] = sum(map(eq, words, words[1:]))
    at = np.flatnonzero(times)
    return at.astype(np.int32), (times[at] / times.sum()).astype(np.float32)


def train(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """(weight per bucket, bias) of the log odds of label 1, by stochastic gradient descent."""
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS))
    out, bias = np.zeros((DIMENSIONS, 2)), np.zeros(2)
    bags = [bag(t) for t in texts]
    passes = -(-STEPS // len(bags))
    steps, step = passes * len(bags), 0
    for _ in range(passes):
        for k in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            at, share = bags[k]
            mean = share @ vectors[at]
            odds = mean @ out + bias
            p = np.exp(odds - odds.max())
            error = p / p.sum()
            error[labels[k]] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            vectors[at] -= rate * len(at) ** 0.5 * share[:, None] * back
    direction = out[:, 1] - out[:, 0]
    return vectors @ direction, float(bias[1] - bias[0])


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Model of the labelled rows outside the held-out fold; ``sample`` bounds the rows that are read."""
    chosen = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where("quality in (0, 1) and doc_id is not null")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.first("quality").alias("quality"), F.max("text").alias("text"))

    def run(frames):
        rows = pd.concat(frames, ignore_index=True).sort_values("doc_id")
        if len(rows):
            weights, bias = train(rows["text"].fillna("").tolist(), rows["quality"].to_numpy())
            yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [bias]})

    model = rows.coalesce(1).mapInPandas(run, "weights binary, bias double").collect()  # at most one row
    if not model:
        return np.zeros(BUCKETS + 1), 0.0
    return np.frombuffer(model[0]["weights"], np.float32).astype(float), model[0]["bias"]


def score(
    docs: DataFrame, weights: np.ndarray, bias: float, carry: tuple[str, ...] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """``carry`` columns of every row and, as ``name``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))  # fixed size: one float per bucket
    at = carry.index("text") if "text" in carry else len(carry)

    def run(batches):
        known = Known(shared.value.astype(float))
        for batch in batches:
            scores = []
            for part in slices(batch.column(at)):
                texts = [(text or "").split() for text in part.to_pylist()]
                known.learn(texts)
                odds = (max(-700.0, min(700.0, bias + known.odds(words))) for words in texts)
                scores += [1 / (1 + math.exp(-x)) for x in odds]
            columns = [*batch.columns[: len(carry)], pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*carry, name])

    schema = docs.select(*carry).schema.add(name, "double")
    read = docs.select(*carry) if "text" in carry else docs.select(*carry, "text")
    return read.mapInArrow(run, schema)


def accepted(docs: DataFrame, weights: np.ndarray, bias: float, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    name = fresh(docs, "score")
    return score(docs, weights, bias, tuple(docs.columns), name).where(F.col(name) >= threshold).drop(name)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Score and label of every document."""
    docs = table(spark, folder, "documents", "doc_id", "text")
    model = fit(docs, table(spark, folder, "labels", "doc_id", "quality"))
    found = score(docs, *model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

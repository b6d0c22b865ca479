"""Near-duplicates by SimHash: whole texts to fingerprints, tiles of fingerprints compared exactly.

Fingerprints of 64 bits come from word shingles. Equal fingerprints are one row from then on. Two
words at most ``radius`` bits apart agree in one of ``radius + 1`` segments, so where such a segment
has at least 12 bits a row goes to one group per segment value; this is exact and keeps the
comparison near-linear. With wider radii all rows are one group. The rows of a group are ordered by
population count and cut into tiles. Tiles are compared by exclusive-or and bit counts in numpy, and
a tile pair whose population counts differ beyond the radius is never made. Groups within ``TILE`` rows
are compared where they lie; the tile pairs of larger ones are spread over the cluster by a join.

Defined cases: a null text counts as empty; an empty text has fingerprint zero and is linked like
any other; a row without id is returned with a null component and links with nothing; repeated
rows stay; rows of one id with unlike texts are documents of their own, each in its own text's
component; other columns are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import components, fresh, table
from demandspark.sources import scratch

#: Rows of a tile that is sent over the cluster, and of those that are compared where they lie.
TILE, SIDE = 4096, 64
#: Segments shorter than this would gather too many unrelated rows.
SEGMENT_BITS = 12
#: Tile pairs compared at a time.
PAIRS = 256


def shingles(text: str | None, size: int) -> list[bytes]:
    """Shingles of ``size`` words, repeats included; the whole sequence if there are fewer words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII space only
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint(pieces: list[bytes]) -> int:
    """Signed 64-bit word; a bit is set if it is in over half of the hashes (XXH64, seed 42)."""
    h = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(42)), np.uint64, len(pieces)).astype(">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h)).view(">i8")[0])


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, own, word): a hash of the row's columns and the fingerprint of its text."""

    def run(batches):
        for batch in batches:
            words = [fingerprint(shingles(text, size)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.int64())], ["doc_id", "own", "word"])

    rows = docs.select(F.col("doc_id").cast("long"), own_hash(docs).alias("own"), "text")
    return rows.mapInArrow(run, "doc_id long, own long, word long")


def own_hash(docs: DataFrame) -> Column:
    """Hash of a row's columns (maps and variants can't be hashed and are left out)."""
    return F.xxhash64(*[f.name for f in docs.schema if not f.dataType.simpleString().startswith(("map", "variant"))])


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, own, word, root, component_id): the component's smallest fingerprint and smallest doc_id.

    Components are reached over links of at most ``radius`` differing bits.
    """
    prints = scratch.materialize(fingerprints(docs, size), "fingerprints")
    by_word = prints.where("doc_id is not null").groupBy("word").agg(F.min("doc_id").alias("least"))
    distinct = scratch.materialize(by_word, "distinct-fingerprints")
    roots = components(scratch.materialize(links(distinct, radius), "fingerprint-links"))
    linked = distinct.join(roots.withColumnRenamed("node", "word"), "word")
    smallest = linked.groupBy("root").agg(F.min("least").alias("least"))
    named = linked.select("word", "root").join(smallest, "root").select("word", "root", "least")
    single = distinct.join(roots.select(F.col("node").alias("word")), "word", "left_anti")
    named = named.unionByName(single.select("word", F.col("word").alias("root"), "least"))
    return prints.join(named, "word", "left").select(
        "doc_id", "own", "word", "root", F.expr("if(doc_id is null, null, least)").alias("component_id")
    )


def deduplicated(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs``, all columns, of each component: that of its smallest doc_id. Rows without id stay."""
    found = near_duplicates(docs, size, radius).where("doc_id is not null")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "own")).alias("first")).select("first.*")
    number, own = fresh(docs, "number"), fresh(docs, "own")
    first = first.select(F.col("doc_id").alias(number), F.col("own").alias(own))
    rows = docs.withColumns({number: F.col("doc_id").cast("long"), own: own_hash(docs)})
    kept = rows.join(first, [number, own], "left_semi").dropDuplicates([number, own])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join the same fingerprints (column ``word``) as all pairs within ``radius`` bits do."""
    rows = distinct.select("word", F.bit_count("word").alias("ones"))
    if 64 // (radius + 1) >= SEGMENT_BITS:
        rows = rows.withColumn("segment", F.explode(_segments(radius + 1))).select("word", "ones", "segment.*")
    else:
        rows = rows.select("word", "ones", F.lit(0).alias("part"), F.lit(0).cast("long").alias("value"))
    width = max(1, radius // 4)
    rows = rows.withColumn("step", F.expr(f"int(ones div {width})"))
    cells = rows.groupBy("part", "value", "step").agg(F.count("*").alias("filled"))
    groups = cells.groupBy("part", "value").agg(F.sum("filled").alias("total")).where("total > 1")
    groups = scratch.materialize(groups, "fingerprint-groups")

    near = rows.join(groups.where(f"total <= {TILE}").select("part", "value"), ["part", "value"])
    near = near.select("part", "value", "ones", "word")
    near = near.repartition("part", "value").sortWithinPartitions("part", "value", "ones")
    here = near.mapInPandas(lambda frames: _here(frames, radius), "a long, b long")

    large = groups.where(f"total > {TILE}").select("part", "value")
    tiles = cells.join(large, ["part", "value"]).withColumn("cuts", F.expr(f"int(ceil(filled / {TILE}))"))
    tiles = scratch.materialize(tiles, "fingerprint-tiles")
    one = tiles.withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)"))).drop("filled", "cuts")
    reach = F.explode(F.expr(f"sequence(step, step + {(radius + width - 1) // width})"))
    left = one.select("part", "value", "step", "cut", reach.alias("step2"))
    right = one.select("part", "value", F.col("step").alias("step2"), F.col("cut").alias("cut2"))
    pairs = left.join(right, ["part", "value", "step2"]).where("step < step2 or cut <= cut2")
    pairs = pairs.withColumn("pair", F.xxhash64("part", "value", "step", "cut", "step2", "cut2"))
    first = pairs.select("part", "value", "step", "cut", "pair", F.lit(0).alias("side"))
    second = pairs.select(
        "part", "value", F.col("step2").alias("step"), F.col("cut2").alias("cut"), "pair", F.lit(1).alias("side")
    )
    keys = ["part", "value", "step"]
    cut = rows.join(tiles.select(*keys, "cuts"), keys).withColumn("cut", F.expr("int(pmod(xxhash64(word), cuts))"))
    dealt = cut.join(first.unionByName(second), [*keys, "cut"]).select("pair", "side", "word")
    tiled = dealt.groupBy("pair").applyInPandas(lambda pdf: _tiles(pdf, radius), "a long, b long")
    return here.unionByName(tiled)


def _segments(parts: int) -> Column:
    bounds = [64 * i // parts for i in range(parts + 1)]
    made = (
        f"struct({i} as part, shiftrightunsigned(word, {low}) & {(1 << (high - low)) - 1}L as value)"
        for i, (low, high) in enumerate(zip(bounds, bounds[1:]))
    )
    return F.expr(f"array({', '.join(made)})")


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable position of each of n positions over the pairs (i, j)."""
    label = np.arange(n)
    while True:
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _links(word: np.ndarray, label: np.ndarray) -> pd.DataFrame:
    on = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": word[on], "b": word[label[on]]})


def _here(frames, radius: int):
    """Groups of up to ``TILE`` rows, sorted by group and population count; whole groups at a time."""
    rest = None
    for frame in frames:
        if not len(frame):
            continue
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        last = (frame["part"] == frame["part"].iloc[-1]) & (frame["value"] == frame["value"].iloc[-1])
        rest = frame[last]
        yield _side_by_side(frame[~last], radius)
    if rest is not None:
        yield _side_by_side(rest, radius)


def _side_by_side(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    """Tiles of ``SIDE`` consecutive rows against themselves and the tiles behind them.

    A pair of tiles is compared if the second begins in the group in which the first ends, and with
    a population count within the radius of the first one's last.
    """
    word, ones = frame["word"].to_numpy(), frame["ones"].to_numpy()
    part, value = frame["part"].to_numpy(), frame["value"].to_numpy()
    n, tiles = len(frame), -(-len(frame) // SIDE)
    if n < 2:
        return _links(word, np.arange(n))
    group = np.concatenate([[0], np.cumsum((part[1:] != part[:-1]) | (value[1:] != value[:-1]))])
    padded = np.full(tiles * SIDE, -1)
    padded[:n] = group
    bits = np.zeros(tiles * SIDE, np.uint64)
    bits[:n] = word.view(np.uint64)
    padded, bits = padded.reshape(tiles, SIDE), bits.reshape(tiles, SIDE)
    start = np.arange(tiles) * SIDE
    end = np.minimum(start + SIDE, n) - 1
    label, apart = np.arange(n), 0
    while apart < tiles:
        s = np.arange(tiles - apart)
        if apart:
            s = s[(group[end[s]] == group[start[s + apart]]) & (ones[start[s + apart]] - ones[end[s]] <= radius)]
            if not len(s):
                break  # tiles further apart differ more
        for at in range(0, len(s), PAIRS):
            a = s[at : at + PAIRS]
            on = np.bitwise_count(bits[a][:, :, None] ^ bits[a + apart][:, None, :]) <= radius
            on &= (padded[a][:, :, None] == padded[a + apart][:, None, :]) & (padded[a][:, :, None] >= 0)
            pair, i, j = np.nonzero(on)
            i, j = a[pair] * SIDE + i, (a[pair] + apart) * SIDE + j
            new = i < j
            if new.any():
                order = np.arange(n)
                label = _forest(n, np.concatenate([i[new], order]), np.concatenate([j[new], label]))
        apart += 1
    return _links(word, label)


def _tiles(pdf: pd.DataFrame, radius: int) -> pd.DataFrame:
    """One tile against another, or against itself, in blocks of rows."""
    side, word = pdf["side"].to_numpy(), pdf["word"].to_numpy()
    bits = word.view(np.uint64)
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    everyone = np.arange(len(pdf))
    same = pd.Series(everyone).groupby(word).transform("min").to_numpy()  # a tile against itself
    label = _forest(len(pdf), everyone, same)
    for at in range(0, len(a), 128):
        block = a[at : at + 128]
        i, j = np.nonzero(np.bitwise_count(bits[block, None] ^ bits[None, b]) <= radius)
        i, j = block[i], b[j]
        if len(i):
            label = _forest(len(pdf), np.concatenate([i, everyone]), np.concatenate([j, label]))
    return _links(word, label)


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint (hex) and component at up to two differing bits."""
    found = near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.expr("lower(lpad(hex(word), 16, '0'))").alias("fingerprint"), "component_id")

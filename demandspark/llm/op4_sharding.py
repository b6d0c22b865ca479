"""Sharding along a Hilbert curve, in DataFrame operations only.

Metadata dimensions are quantised at equal-depth bounds, strings by their ranks as a whole, and the
cell's index on the Hilbert curve (Skilling 2004) orders the rows. A range shuffle sorts them over
all tasks; places are written once, so a lost executor can't move a row; one count per partition
turns places into positions, and cutting the positions into equal runs gives the shards. Each run
covers a compact region, so per-file minima and maxima prune on every dimension.

Rows of equal texts share the smallest values of their dimensions, which keeps them side by side: at
most ``shards - 1`` such groups are cut, however large they are.

Defined cases: a null text counts as empty (size 1, CRC-32 of nothing); null dimensions come first;
repeated rows each get a slot of their own; a null doc_id is carried; no rows give no shards; other
columns are ignored. Law: ``rows``, shards hold equally many rows, or one more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.llm.common import table
from demandspark.sources import scratch

BITS = 5


def string_cuts(df: DataFrame, name: str, bits: int = BITS) -> list[str]:
    """The least string of every cell but the first, at most 2^bits - 1 of them, cells holding as equal counts as values allow.

    The different strings, whole, are sorted by range over the cluster with their counts, and rows before a string give its cell.
    """
    spark = df.sparkSession
    values = df.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count("*").alias("n"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = values.repartitionByRange(parts, "value").sortWithinPartitions("value")
    values, path = scratch.stored(values.withColumn("part", F.spark_partition_id()), "string-values")
    sums = values.groupBy("part").agg(F.sum("n").alias("sum")).sort("part").collect()  # one row per partition of the sort
    total, seen, before = sum(r["sum"] for r in sums), 0, {}
    for r in sums:
        before[r["part"]] = seen
        seen += r["sum"]
    if not total:
        scratch.delete(spark, path)
        return []
    starts = F.broadcast(spark.createDataFrame(list(before.items()), "part int, before long"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    rank = F.col("before") + F.col("upto") - F.col("n")
    cells = values.withColumn("upto", upto).join(starts, "part").select("value", (rank * 2**bits / F.lit(total)).cast("int").alias("cell"))
    found = cells.groupBy("cell").agg(F.min("value").alias("value")).sort("cell").collect()  # at most 2^bits rows
    scratch.delete(spark, path)
    return [r["value"] for r in found[1:]]


def quantised(df: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``cell``: per dimension the number of bounds below the value; nulls count as lowest."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    texts = [d for d in dimensions if df.schema[d].dataType.typeName() == "string"]
    numbers = [d for d in dimensions if d not in texts]
    aggregates = [F.percentile_approx(F.col(d).cast("double"), shares).alias(d) for d in numbers]
    bounds = df.agg(*aggregates).first() if numbers else {}  # 2^bits - 1 each
    cuts = {d: string_cuts(df.select(d), d, bits) for d in texts}

    def place(d: str) -> Column:
        if d in texts:
            return F.size(F.filter(F.array(*map(F.lit, cuts[d])), lambda b: b <= F.col(d))) if cuts[d] else F.lit(0)
        value = F.coalesce(F.col(d).cast("double"), F.lit(float("-inf")))
        known = F.array(*(F.lit(float(b)) for b in sorted(set(bounds[d] or [0.0]))))
        return F.size(F.filter(known, lambda b: b < value))

    return df.withColumn("cell", F.array(*(place(d) for d in dimensions)))


def hilbert_index(cell: str, n: int, bits: int = BITS) -> Column:
    """Index on the Hilbert curve of an array of ``n`` whole numbers below 2^bits."""
    turned = (
        f"aggregate(sequence({bits - 1}, 1, -1), {cell}, (x, k) -> aggregate(sequence(0, {n - 1}), x, (y, i) -> "
        "if(y[i] & shiftleft(1, k) != 0, "
        "transform(y, (v, j) -> if(j = 0, v ^ (shiftleft(1, k) - 1), v)), "
        "transform(y, (v, j) -> if(j = 0 or j = i, v ^ ((y[0] ^ y[i]) & (shiftleft(1, k) - 1)), v)))))"
    )
    gray = f"transform({turned}, y -> y)"
    summed = f"transform(sequence(1, {n}), i -> aggregate(slice(g, 1, i), 0, (s, v) -> s ^ v))"
    flip = f"aggregate(sequence(1, {bits - 1}), 0, (t, k) -> if(s[{n - 1}] & shiftleft(1, k) != 0, t ^ (shiftleft(1, k) - 1), t))"
    woven = (
        f"aggregate(sequence({bits - 1}, 0, -1), 0L, (h, k) -> aggregate(s, h, (a, v) -> "
        f"shiftleft(a, 1) | (shiftright(v ^ t, k) & 1)))"
    )
    # Each step is bound to a name by a one-element array, so that nothing is computed twice.
    step = f"transform(array({gray}), g -> {summed})[0]"
    return F.expr(f"transform(array({step}), s -> transform(array({flip}), t -> {woven})[0])[0]")


def curve_order(df: DataFrame, dimensions: Sequence[str], ties: Sequence[str], bits: int = BITS) -> DataFrame:
    """Adds ``position``: 0, 1, ... along the curve over all rows, ties ordered by ``ties``; and ``rows``, their number."""
    spark = df.sparkSession
    keys = ["hilbert", *ties]
    cells = quantised(df, dimensions, bits).withColumn("hilbert", hilbert_index("cell", len(dimensions), bits))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cells.drop("cell").repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = placed.withColumn("place", F.monotonically_increasing_id())
    placed = scratch.materialize(placed.withColumn("part", F.shiftright("place", 33)), "curve")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition of the sort
    over = Window.orderBy("part")
    counts = counts.select(
        "part",
        F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
        "n",
        F.sum("n").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("rows"),
    )
    counts = counts.select("part", (F.col("upto") - F.col("n")).alias("before"), "rows")
    position = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(counts), "part").withColumn("position", position).drop("part", "place", "before")


def shards(df: DataFrame, dimensions: Sequence[str], ties: Sequence[str], count: int, bits: int = BITS) -> DataFrame:
    """Adds ``shard`` and ``slot``: runs of the curve whose lengths differ by one row at most."""
    ordered = curve_order(df, dimensions, ties, bits)
    shard = F.expr(f"(position * {count}) div rows")
    first = F.expr(f"((position * {count}) div rows * rows + {count - 1}) div {count}")
    return (
        ordered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("position") - first)
        .drop("position", "rows")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order, for pruning by file statistics."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def document_shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """Documents along language, source and size; equal texts take their smallest language and source."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.col("lang").cast("string"),
        F.col("source").cast("string"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    )
    rows = scratch.materialize(rows, "document-sizes")
    keys = ["text_hash", "text_crc32", "size"]
    shared = rows.groupBy(*keys).agg(F.min("lang").alias("lang"), F.min("source").alias("source"))
    grouped = rows.drop("lang", "source").join(shared, keys)
    return shards(grouped, ["lang", "source", "size"], ["text_hash", "text_crc32", "doc_id"], count)


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of equally many rows."""
    docs = table(spark, folder, "documents", "doc_id", "text", "lang", "source")
    return document_shards(docs, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

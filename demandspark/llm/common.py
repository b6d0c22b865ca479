"""Helpers of the text operators: written tables and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandspark.sources import scratch


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; only these reach the scan."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of about a megabyte in all, so that few words are held at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + (1 << 20))))
        yield texts.slice(start, stop - start)
        start = stop


def placed(rows: DataFrame, key: str, order: list[Column], label: str) -> tuple[DataFrame, str]:
    """``rows``, written, with ``slice`` and the zero-based ``place`` in the order of their key (a long); and the path.

    Rows are sorted by range over the cluster and counted as they stream by, so no key is gathered in one task. Only
    the first key of a slice can go on from earlier slices: what it has there is at most one row per slice.
    """
    names = [*rows.columns, "slice", "local"]
    at = names.index(key)

    def run(batches):
        slice_id, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            null = batch.column(at).is_null().to_numpy(zero_copy_only=False)
            value = batch.column(at).fill_null(0).to_numpy(zero_copy_only=False)
            new = np.ones(n, bool)
            new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
            new[0] = (value[0], null[0]) != last
            local = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
            local[: int(new.argmax()) if new.any() else n] += seen
            last, seen = (value[-1], null[-1]), int(local[-1]) + 1
            made = [pa.array(np.full(n, slice_id), pa.int64()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names)

    schema = rows.select("*", *(F.lit(0).cast("long").alias(c) for c in names[-2:])).schema
    done, path = scratch.stored(rows.orderBy(F.col(key).asc_nulls_first(), *order).mapInArrow(run, schema), label)
    runs = done.groupBy("slice", key).agg(F.count("*").alias("n"))
    several = runs.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("slices")).where("slices > 1").select("_key")
    runs = runs.join(several, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = runs.select(F.col("slice").alias("_slice"), F.col(key).alias("_key"), F.sum("n").over(before).alias("_carry"))
    carry = F.broadcast(carry.where("_carry is not null"))  # at most one row per slice
    same = (F.col("slice") == F.col("_slice")) & F.col(key).eqNullSafe(F.col("_key"))
    place = (F.col("local") + F.coalesce("_carry", F.lit(0))).alias("place")
    return done.join(carry, same, "left").select(*rows.columns, "slice", place), path


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the links (a long, b long): one row (node, root) per linked node.

    The root is the smallest node of the component. Large-star and small-star rounds
    (Kiveris et al. 2014) rewrite the links until each node points at its root; a round keeps at
    most as many links as there were, needs no node's neighbours in one place, and is written to
    the shared folder, so that a lost executor repeats one round only. Null ends and loops are ignored.
    """
    spark = edges.sparkSession
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, path = scratch.stored(links, "links")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.withColumnRenamed("m", "v"))
            .distinct()
        )
        new, new_path = scratch.stored(small, "links")
        scratch.delete(spark, path)
        now, path, before, mark = new, new_path, mark, _mark(new)
        if mark == before:
            break
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(h)).first())

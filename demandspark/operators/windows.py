"""Ordered operators: row numbers, rolling means, running sums, previous value, best rows.

Each operator has two plans with equal results. The ``window`` plan is Spark's own window and
brings one group into one task; ask for it where the keys bound a group by construction. The
``ranged`` plan, used otherwise, cuts the order into even slices across the cluster, so
a group of any size is spread over many tasks. The data's size never chooses the plan. Both plans order ties by a hash of the rows' content, so they place every row alike.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.scalars import whole_div
from demandspark.operators import selection
from demandspark.sources.scratch import materialize

BLOCK_ROWS = 65_536
_POSITION_BITS = 33

Order = str | Column


def ascending(keys: Sequence[Order]) -> list[Column]:
    """Strings become ascending, NULL last; ready-made sort columns pass through."""
    return [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]


def tie_breaker(df: DataFrame) -> Column:
    """Hash of a row's content: rows that it leaves tied are equal (up to collisions of 64 bits)."""
    return F.xxhash64(*_hashable(df))


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if not f.dataType.simpleString().startswith(("map", "variant"))]


def total_order(df: DataFrame, order_by: Sequence[Order]) -> list[Column]:
    """The order of ``order_by``, ties by content, as in the ranged plan."""
    return [*ascending(order_by), tie_breaker(df)]


def takes_window(strategy: str) -> bool:
    """True when the plain window plan is asked for."""
    if strategy not in ("window", "ranged"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return strategy == "window"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def in_slices(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Order]
) -> DataFrame:
    """Sort by range across the cluster and store each row's slice and place in it.

    Rows with equal sort keys are told apart by a hash of their content, so a hot key cannot
    fill one slice; a random number would move rows when a lost stage is computed again. The
    result is read back from a written table, so slices and places never change.
    """
    placed = (
        df.withColumn("_tie", tie_breaker(df))
        .orderBy(*ascending(partition_by), *ascending(order_by), "_tie")
        .drop("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "ordered")
    return placed.select(
        *df.columns,
        F.shiftright("_place", _POSITION_BITS).alias("_slice"),
        F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1).alias("_pos"),
    )


def _heads(sliced: DataFrame, partition_by: Sequence[str], first_of: Sequence[str]) -> list[tuple]:
    """Per slice: (slice, first key, its rows in earlier slices, its first values). One row per slice is fetched."""
    runs = sliced.groupBy("_slice", *partition_by).agg(
        F.count("*").alias("_count"),
        F.min("_key").alias("_low"),
        *[F.min_by(c, "_key").alias(f"_first_{c}") for c in first_of],
    )
    run = F.struct("_count", *partition_by, *[f"_first_{c}" for c in first_of])
    ends = runs.groupBy("_slice").agg(F.min_by(run, "_low").alias("head"), F.max_by(run, "_low").alias("tail"))
    out, key, seen, firsts = [], None, 0, ()
    width = 1 + len(partition_by)
    for number, head, tail in sorted((r["_slice"], tuple(r["head"]), tuple(r["tail"])) for r in ends.collect()):
        if repr(head[1:width]) != key:  # by text, as NaN differs from itself
            key, seen, firsts = repr(head[1:width]), 0, head[width:]
        out.append((number, *head[1:width], seen, *firsts))
        if repr(tail[1:width]) == key:
            seen += tail[0]
        else:
            key, seen, firsts = repr(tail[1:width]), tail[0], tail[width:]
    return out


def ranged_index(
    df: DataFrame,
    order_by: Sequence[Order],
    partition_by: Sequence[str] = (),
    out: str = "seqnum",
    first_of: Sequence[str] = (),
) -> DataFrame:
    """Zero-based row number by the ranged plan; ``first_of`` adds each group's first values
    as ``_first_<column>``.

    Split points come from a bounded sample and are part of the plan; a second pass over the key
    columns counts the slices; then rows are shuffled once, by slice, and numbered in it. Only the
    first group of a slice can have begun in an earlier one, so one row per slice tells what to
    add. Nothing is written: the frame has to give the same rows whenever it is computed (else
    ``materialize`` it first).
    """
    keys = list(partition_by)
    if not selection.sorts(df, [*keys, *order_by]):
        raise ValueError("the ranged plan numbers rows by ascending columns of plain types")
    found = selection.digits(df, [*keys, *order_by], _hashable(df))
    slices = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = selection.with_slice(df, found, selection.split_points(df, found, slices))
    firsts = [f"_first_{c}" for c in first_of]
    fields = [
        T.StructField("_slice", T.IntegerType()),
        *[T.StructField(f"_h_{k}", df.schema[k].dataType) for k in keys],
        T.StructField("_shift", T.LongType()),
        *[T.StructField(f"_h{name}", df.schema[c].dataType) for name, c in zip(firsts, first_of)],
    ]
    heads = _heads(sliced, keys, first_of)
    if keys:
        heads = [h for h in heads if h[1 + len(keys)]]
    w = Window.partitionBy("_slice", *keys).orderBy(*total_order(df, order_by))
    numbered = sliced.drop("_key").withColumn(out, F.row_number().over(w).cast("bigint") - 1)
    if keys:
        numbered = numbered.withColumns({name: F.first(c).over(w) for name, c in zip(firsts, first_of)})
    # One row per slice.
    starts = F.broadcast(df.sparkSession.createDataFrame(heads, T.StructType(fields)).withColumnRenamed("_slice", "_s"))
    on = [F.col("_slice") == F.col("_s"), *[F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]]
    shifted = numbered.join(starts, on, "left")
    begun = F.col("_s").isNotNull()
    return shifted.select(
        *df.columns,
        (F.col(out) + F.coalesce("_shift", F.lit(0))).alias(out),
        *[(F.when(begun, F.col(f"_h{n}")).otherwise(F.col(n)) if keys else F.col(f"_h{n}")).alias(n) for n in firsts],
    )


def seq_num(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Order],
    out: str = "seqnum",
    strategy: str = "ranged",
) -> DataFrame:
    """Zero-based row number within each group (bigint)."""
    if partition_by and takes_window(strategy):
        w = Window.partitionBy(*partition_by).orderBy(*total_order(df, order_by))
        return df.withColumn(out, F.row_number().over(w).cast("bigint") - 1)
    return ranged_index(df, order_by, partition_by, out)


def with_halo(df: DataFrame, seq: str, preceding: int, block: int) -> DataFrame:
    """Cut a numbered series into blocks; the last rows of a block are copied into the next.

    Adds ``_block`` and ``_halo`` (true on copies). A window over one block with a frame of
    ``preceding`` rows then sees all it needs.
    """
    if block < preceding:
        raise ValueError("block must be at least as long as the frame")
    own = whole_div(seq, block)
    near_end = F.col(seq) % F.lit(block) >= F.lit(block - preceding)
    blocks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn("_block", F.explode(blocks)).withColumn("_halo", F.col("_block") != own)


def block_rolling_means(
    df: DataFrame,
    value: str,
    windows: Mapping[str, int],
    seq: str,
    partition_by: Sequence[str] = (),
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Rolling means over a series already numbered 0, 1, 2, ... in column ``seq``.

    ``windows`` maps output names to the number of preceding rows.
    """
    longest = max(windows.values())
    block = max(block, longest)
    w = Window.partitionBy(*partition_by, "_block").orderBy(seq)
    means = {out: F.avg(value).over(w.rowsBetween(-k, 0)) for out, k in windows.items()}
    return with_halo(df, seq, longest, block).withColumns(means).filter("NOT _halo").drop(
        "_block", "_halo"
    )


def rolling_means(
    df: DataFrame,
    value: str,
    windows: Mapping[str, int],
    order_by: Sequence[Order],
    partition_by: Sequence[str] = (),
    strategy: str = "ranged",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Several rolling means of one value over the same ordering."""
    if partition_by and takes_window(strategy):
        w = Window.partitionBy(*partition_by).orderBy(*total_order(df, order_by))
        return df.withColumns({o: F.avg(value).over(w.rowsBetween(-k, 0)) for o, k in windows.items()})
    numbered = ranged_index(df, order_by, partition_by, "_seq")
    return block_rolling_means(numbered, value, windows, "_seq", partition_by, block).drop("_seq")


def rolling_mean(
    df: DataFrame,
    value: str,
    order_by: Sequence[Order],
    preceding: int,
    partition_by: Sequence[str] = (),
    out: str = "rolling_mean",
    strategy: str = "ranged",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean over the current and the ``preceding`` rows before it.

    Without ``partition_by`` the series runs across all rows, as one ordered list.
    """
    return rolling_means(df, value, {out: preceding}, order_by, partition_by, strategy, block)


def running_sum(
    df: DataFrame,
    value: str,
    partition_by: Sequence[str],
    order_by: str,
    out: str = "running_sum",
    strategy: str = "ranged",
) -> DataFrame:
    """Sum from the highest ``order_by`` down to the current one; equal positions count together."""
    if takes_window(strategy):
        w = Window.partitionBy(*partition_by).orderBy(F.col(order_by).desc_nulls_last())
        return df.withColumn(out, F.sum(value).over(w.rangeBetween(Window.unboundedPreceding, 0)))
    keys = list(partition_by)
    steps = df.groupBy(*keys, order_by).agg(F.sum(value).alias("_step"))
    sliced = in_slices(steps, keys, [F.col(order_by).desc_nulls_last()])
    runs = sliced.groupBy("_slice", *keys).agg(F.sum("_step").alias("_total"))
    earlier = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = runs.withColumn("_before", F.sum("_total").over(earlier)).drop("_total")
    within = (
        Window.partitionBy("_slice", *keys)
        .orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    here, before = F.sum("_step").over(within), F.col("_before")
    # A running sum is NULL until the first non-NULL value, hence not a plain addition.
    total = F.when(before.isNull(), here).otherwise(before + F.coalesce(here, F.lit(0)))
    summed = null_safe_join(sliced, runs, ["_slice", *keys], "inner").withColumn(out, total)
    return null_safe_join(df, summed.select(*keys, order_by, out), [*keys, order_by], "inner")


def prev_edge(
    df: DataFrame,
    col: str,
    partition_by: Sequence[str],
    default: int = -1,
    out: str | None = None,
    strategy: str = "ranged",
) -> DataFrame:
    """Next lower value of ``col`` in the group, ``default`` for the lowest."""
    out = out or f"next_{col}"
    if takes_window(strategy):
        w = Window.partitionBy(*partition_by).orderBy(F.col(col).asc_nulls_last())
        return df.withColumn(out, F.coalesce(F.lag(col).over(w), F.lit(default)))
    numbered = with_halo(ranged_index(df, [col], partition_by, "_seq"), "_seq", 1, BLOCK_ROWS)
    w = Window.partitionBy(*partition_by, "_block").orderBy("_seq")
    edges = numbered.withColumn(out, F.coalesce(F.lag(col).over(w), F.lit(default)))
    return edges.filter("NOT _halo").drop("_block", "_halo", "_seq")


def top_per_group(
    df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Order], n: int = 1
) -> DataFrame:
    """First ``n`` rows of each group.

    Spark limits each group before the shuffle as well, so a hot group arrives as at most
    ``n`` rows per task.
    """
    w = Window.partitionBy(*partition_by).orderBy(*ascending(order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")

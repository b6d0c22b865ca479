"""Left lookups on computed keys, interval lookup, trailing-window expansion."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.scalars import as_column, date_lit
from demandspark.operators import selection
from demandspark.operators.windows import takes_window, tie_breaker


def left_join_on(
    df: DataFrame, other: DataFrame, pairs: Mapping[str, Column | str]
) -> DataFrame:
    """Left join where ``pairs`` maps a column of ``df`` to an expression over ``other``.

    The expression is computed on the looked-up side first, so the join is a plain equi-join.
    Columns of ``other`` whose names already occur in ``df`` are not taken over.
    """
    keyed = other.withColumns({f"_key_{i}": as_column(e) for i, e in enumerate(pairs.values())})
    on = [F.col(left) == F.col(f"_key_{i}") for i, left in enumerate(pairs)]
    extra = [c for c in other.columns if c not in df.columns]
    keyed = keyed.select(*extra, *[f"_key_{i}" for i in range(len(pairs))])
    return df.join(keyed, on, "left").drop(*[f"_key_{i}" for i in range(len(pairs))])


def interval_join(
    df: DataFrame,
    bands: DataFrame,
    on: Sequence[str],
    point: str,
    lo: str,
    hi: str,
    take: Sequence[str],
    offset: int = 0,
    strategy: str = "ranged",
) -> DataFrame:
    """Left lookup of the band with ``lo - offset < point <= hi - offset``.

    Bands of one key must not overlap, so a row finds at most one. Points and band starts become
    one list, ordered by key and place, and the last band that began is carried forward; a point is not compared
    with the bands of its key. ``ranged`` cuts the list into even slices, so a key of any size is spread over
    many tasks; both frames must give the same rows each time. ``window`` states that the keys bound a group.
    NULL keys, NULL points and empty bands match nothing.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    begin, end = F.col(lo) - offset, F.col(hi) - offset
    row, band = F.struct(*df.columns), F.struct(end.alias("_hi"), *take)
    known = [F.col(k).isNotNull() for k in on]
    # Bands that match nothing stay in the list without a band: a filter below the union can fail in Spark's optimizer.
    starts = bands.select(
        *[F.col(k).alias(name) for k, name in zip(on, keys)],
        begin.alias("_at"),
        F.lit(1).alias("_tag"),  # a point at a band's start still belongs to the band before
        F.lit(0).cast("long").alias("_tie"),
        F.when(reduce(Column.__and__, known, begin < end), band).alias("_band"),
    )
    points = df.select(
        *[F.col(k).alias(name) for k, name in zip(on, keys)],
        F.col(point).alias("_at"),
        F.lit(0).alias("_tag"),
        tie_breaker(df).alias("_tie"),
        row.alias("_row"),
    )
    events = points.unionByName(starts, allowMissingColumns=True)
    found = _band_in_groups(events, keys) if takes_window(strategy) else _band_in_slices(events, keys)
    inside = F.col("_at") <= F.col("_band._hi")
    return found.filter("_tag = 0").select("_row.*", *[F.when(inside, F.col(f"_band.{c}")).alias(c) for c in take])


def _band_in_groups(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("_at", "_tag").rowsBetween(Window.unboundedPreceding, 0)
    return events.withColumn("_band", F.last("_band", ignorenulls=True).over(w))


def _band_in_slices(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As within groups, but per slice of the whole order; one row per slice tells which band it begins in."""
    order = [*keys, "_at", "_tag"]
    if not selection.sorts(events, order):
        raise ValueError("the ranged plan orders keys and points of plain types")
    found = selection.digits(events, order, ["_tie"])
    slices = 2 * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = selection.with_slice(events, found, selection.split_points(events, found, slices))
    runs = sliced.groupBy("_slice", *keys).agg(
        F.min("_key").alias("_low"), F.max_by("_band", F.when(F.col("_band").isNotNull(), F.col("_key"))).alias("_last")
    )
    ends = runs.groupBy("_slice").agg(
        F.min_by(F.struct(*keys), "_low").alias("head"), F.max_by(F.struct(*keys, "_last"), "_low").alias("tail")
    )
    begun, key, last = [], None, None
    for number, head, tail in sorted(ends.select("_slice", "head", "tail").collect(), key=lambda r: r[0]):  # one row per slice
        if repr(tuple(head)) == key and last is not None:
            begun.append((number, *head, last))
        *own, seen = tail
        if repr(tuple(own)) != key or seen is not None:
            key, last = repr(tuple(own)), seen
    fields = [
        T.StructField("_s", T.IntegerType()),
        *[T.StructField(f"_h{k}", events.schema[k].dataType) for k in keys],
        T.StructField("_before", events.schema["_band"].dataType),
    ]
    before = F.broadcast(events.sparkSession.createDataFrame(begun, T.StructType(fields)))  # one row per slice
    same = [F.col("_slice") == F.col("_s"), *[F.col(k) == F.col(f"_h{k}") for k in keys]]
    w = Window.partitionBy("_slice", *keys).orderBy("_at", "_tag").rowsBetween(Window.unboundedPreceding, 0)
    carried = sliced.drop("_key").withColumn("_band", F.last("_band", ignorenulls=True).over(w))
    return carried.join(before, same, "left").withColumn("_band", F.coalesce("_band", "_before"))


def window_expand(
    df: DataFrame,
    date_col: str,
    lo: dt.date | str | Column,
    hi: dt.date | str | Column,
    days_back: int = 14,
    out: str = "observation_date",
) -> DataFrame:
    """Attach each row to every day of ``[lo, hi]`` whose trailing window holds its date.

    A row dated d belongs to the days d, d+1, ..., d+days_back. Only days inside the bounds
    are produced, so rows outside them cost nothing and no range join is needed.
    """
    first, last = (x if isinstance(x, Column) else date_lit(x) for x in (lo, hi))
    start = F.greatest(F.col(date_col), first)
    end = F.least(F.date_add(date_col, days_back), last)
    days = F.when(start <= end, F.sequence(start, end))
    return df.withColumn(out, F.explode(days))

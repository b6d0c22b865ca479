"""Train and test split of an exact size by a hash of the row's key."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.selection import Digits, content_digits, cut_rows, order_statistics


def hash_digits(df: DataFrame, key_cols: Sequence[str], seed: int = 42) -> Digits:
    """Order of the MD5 of key and seed; rows of equal keys by a hash of their content."""
    text = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))))
    parts = [F.conv(F.substring(text, at, size), 16, 10).cast("long") for at, size in ((1, 12), (13, 12), (25, 8))]
    return Digits((parts[0],), (*parts[1:], *content_digits(df.columns)))


def with_test_mark(
    df: DataFrame, key_cols: Sequence[str], test: float = 0.2, seed: int = 42, out: str = "is_test", rows: int | None = None
) -> DataFrame:
    """Add a flag that is true for exactly ``ceil(test * rows)`` rows, those whose hashes come first.

    The hash at that rank is found by selection, without a sort. The same row falls on the same side however the data
    is partitioned or computed again. ``rows`` is their number where it is known.
    """
    if not 0 < test < 1:
        raise ValueError("the test share must lie between 0 and 1")
    n = df.count() if rows is None else rows
    wanted = math.ceil(Decimal(str(test)) * n)
    if wanted >= n:  # no row, or none left to train on
        return df.withColumn(out, F.lit(True))
    keys = hash_digits(df, key_cols, seed)
    cuts = order_statistics(df, keys, [wanted], (n, 0, (1 << 48) - 1))
    return cut_rows(df, keys, {out: cuts}).withColumn(out, F.col(out) == 0)


def hash_split(
    df: DataFrame, key_cols: Sequence[str], test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test): exactly ``ceil(test * n)`` of n rows go to the second."""
    marked = with_test_mark(df, key_cols, test, seed, "_is_test")
    return marked.filter("NOT _is_test").drop("_is_test"), marked.filter("_is_test").drop("_is_test")

"""Exponential smoothing in closed form, for many values and factors at once.

For a factor a and a zero-based row number n, with b = 1/a:

    e_n = (sum of b^i * x_i for i <= n, plus x_0) / b^(n+1)

A NULL value adds nothing; a NULL first value makes the whole group NULL; NaN and infinities reach
all rows behind them. Only a = 0.5 is an
average: the weights sum to a/(1-a) in the long run.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandspark.functions.scalars import half_up, whole_div
from demandspark.operators.windows import (
    Order,
    null_safe_join,
    ranged_index,
    takes_window,
    total_order,
)
from demandspark.sources.scratch import materialize

_MAX_BITS = 900  # b^n stays clear of the largest double (2^1024)
_BLOCK_BITS = 256  # powers inside a block stay below 2^256, so values up to 2^700 fit as well
_MAX_BLOCK = 4096
_FAN = 256


def _bits(alpha: float) -> float:
    if not 0 < alpha < 1:
        raise ValueError("a smoothing factor lies between 0 and 1")
    return math.log2(1 / alpha)


def direct_limit(alphas: Sequence[float]) -> int:
    """Longest series whose powers stay finite for every factor."""
    return int(_MAX_BITS / max(map(_bits, alphas)))


def ema_grid(
    df: DataFrame,
    outputs: Mapping[str, tuple[str, float]],
    partition_by: Sequence[str],
    order_by: Sequence[Order],
    rounded: bool = True,
    strategy: str = "ranged",
    block: int | None = None,
) -> DataFrame:
    """Add one smoothed column per entry of ``outputs`` (name -> value column, factor).

    All columns share one sort. ``ranged`` takes series of any length, in blocks (``block``
    shortens them). ``window`` states that the keys keep series short; it fails on one whose
    powers would overflow.
    """
    finish: Callable[[Column], Column] = half_up if rounded else (lambda c: c)
    if takes_window(strategy):
        return _direct(df, outputs, partition_by, order_by, finish)
    return _blocked(df, outputs, partition_by, order_by, finish, block)


def ema(
    df: DataFrame,
    value: str,
    alpha: float,
    partition_by: Sequence[str],
    order_by: Sequence[Order],
    out: str = "exp_mov_avg",
    rounded: bool = True,
    strategy: str = "ranged",
    block: int | None = None,
) -> DataFrame:
    """Smooth one value with one factor."""
    return ema_grid(df, {out: (value, alpha)}, partition_by, order_by, rounded, strategy, block)


def _direct(df, outputs, partition_by, order_by, finish):
    w = Window.partitionBy(*partition_by).orderBy(*total_order(df, order_by))
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    factors = list(dict.fromkeys(a for _, a in outputs.values()))
    powers = {a: f"_p{i}" for i, a in enumerate(factors)}
    longest = direct_limit(factors)
    too_long = F.raise_error(F.lit(f"a series is longer than {longest} rows: use the ranged strategy"))
    numbered = df.withColumn("_n", F.row_number().over(w) - 1).withColumns(
        {
            p: F.when(F.col("_n") < longest, F.pow(F.lit(1.0 / a), F.col("_n"))).otherwise(too_long.cast("double"))
            for a, p in powers.items()
        }
    )
    smoothed = {}
    for out, (value, a) in outputs.items():
        weighted = F.sum(F.col(powers[a]) * F.col(value)).over(so_far)
        first = F.first(value).over(so_far)
        smoothed[out] = finish((weighted + first) / (F.col(powers[a]) * F.lit(1.0 / a)))
    return numbered.withColumns(smoothed).drop("_n", *powers.values())


def _blocked(df, outputs, partition_by, order_by, finish, block=None):
    """Closed form inside short blocks; what comes into a block is a scan of affine maps.

    A full block turns the value e that comes in into f * e + c, with f the factor's power and c
    the block's own end value. Maps compose, so blocks of blocks are maps too, and the scan
    goes over as many levels as the longest series needs.
    """
    keys = list(partition_by)
    bits = {a: _bits(a) for _, a in outputs.values()}
    block = max(1, min(block or _MAX_BLOCK, int(_BLOCK_BITS / max(bits.values()))))
    values = list(dict.fromkeys(v for v, _ in outputs.values()))

    # The first value counts twice: once as x_0 and once as the start of the recurrence.
    numbered = ranged_index(df, order_by, keys, "_seq", values).withColumns(
        {
            "_blk": whole_div("_seq", block),
            "_r": F.col("_seq") % F.lit(block),
            **{
                f"_x_{v}": F.col(v).cast("double")
                * F.when(F.col("_seq") == 0, F.lit(2.0)).otherwise(F.lit(1.0))
                for v in values
            },
        }
    )
    names = {out: f"_e{i}" for i, out in enumerate(outputs)}
    ends = numbered.groupBy(*keys, "_blk").agg(
        *[
            F.coalesce(F.sum(F.pow(F.lit(a), F.lit(block) - F.col("_r")) * F.col(f"_x_{v}")), F.lit(0.0)).alias(names[out])
            for out, (v, a) in outputs.items()
        ]
    )
    ends = materialize(ends, "block-ends")  # one row per block
    incoming = affine_scan(ends, keys, "_blk", {names[out]: a**block for out, (_, a) in outputs.items()})
    # What comes in joins its block as one more row, ahead of the others, so the rows are
    # shuffled once and NULL keys need no care.
    block_rows = Window.partitionBy(*keys, "_blk")
    within = block_rows.orderBy(F.col("_seq").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    local = {
        f"_local{name}": F.sum(F.pow(F.lit(1.0 / outputs[out][1]), F.col("_r")) * F.col(f"_x_{outputs[out][0]}")).over(within)
        / F.pow(F.lit(1.0 / outputs[out][1]), F.col("_r") + 1)
        for out, name in names.items()
    }
    came = {name: F.max(name).over(within) for name in names.values()}
    joined = (
        numbered.unionByName(incoming, allowMissingColumns=True)
        .withColumns({**local, **came})
        .filter(F.col("_seq").isNotNull())
    )
    smoothed = {}
    for out, (v, a) in outputs.items():
        carry = F.col(names[out]) * F.pow(F.lit(a), F.col("_r") + 1)
        total = F.coalesce(F.col(f"_local{names[out]}"), F.lit(0.0)) + F.coalesce(carry, F.lit(0.0))
        smoothed[out] = F.when(F.col(f"_first_{v}").isNotNull(), finish(total))
    return joined.withColumns(smoothed).select(*df.columns, *outputs)


def affine_scan(ends: DataFrame, keys: Sequence[str], at: str, factors: Mapping[str, float]) -> DataFrame:
    """What comes into each step of e -> factor * e + c, starting from 0.0.

    ``ends`` holds, per key, the steps 0, 1, 2, ... in column ``at`` and their c in the columns
    that ``factors`` names; the same columns of the result hold what comes in. ``_FAN`` steps
    are folded in one array and are one step of the next level. Values that are not finite
    don't fade. The number of levels follows from the longest series, asked for once.
    """
    longest = ends.agg(F.max(at)).first()[0] or 0
    return _scan_level(ends, list(keys), at, dict(factors), longest + 1)


def _damped(value: str, factor: str) -> str:
    return f"if(isnan({value}) or abs({value}) = double('inf'), {value}, {value} * {factor})"


def _scan_level(ends, keys, at, factors, steps):
    group = f"_g{at}"
    folded = {
        name: F.expr(
            f"aggregate(_steps, named_struct('e', 0D, 'before', cast(array() as array<double>)), (s, x) -> named_struct("
            f"'e', x.`{name}` + {_damped('s.e', _double(f))}, 'before', concat(s.before, array(s.e))))"
        )
        for name, f in factors.items()
    }
    groups = (
        ends.withColumn(group, whole_div(at, _FAN))
        .groupBy(*keys, group)
        .agg(F.sort_array(F.collect_list(F.struct(at, *factors))).alias("_steps"))  # at most _FAN
        .withColumns(folded)
    )
    if steps > _FAN:
        above = groups.select(*keys, group, *[F.col(f"{name}.e").alias(name) for name in factors])
        above = _scan_level(above, keys, group, {name: f**_FAN for name, f in factors.items()}, -(-steps // _FAN))
        above = above.withColumnsRenamed({**{name: f"_up{name}" for name in factors}, group: "_group"})
        groups = null_safe_join(groups.withColumn("_group", F.col(group)), above, [*keys, "_group"], "left")
    else:
        groups = groups.withColumns({f"_up{name}": F.lit(0.0) for name in factors})
    fields = ", ".join(
        f"'{name}', `{name}`.before[i] + {_damped(f'`_up{name}`', f'pow({_double(f)}, i)')}" for name, f in factors.items()
    )
    rows = F.expr(f"transform(_steps, (x, i) -> named_struct('{at}', x.`{at}`, {fields}))")
    return groups.select(*keys, F.explode(rows).alias("_row")).select(*keys, "_row.*")


def _double(value: float) -> str:
    return f"double('{value!r}')"

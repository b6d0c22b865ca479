"""Order statistics without a sort: the rows at given ranks, found by refining histograms of the order key.

A key becomes digits, numbers whose order is the key's. Each pass counts the rows in a few thousand buckets of the digit
that is still open, only inside the intervals that hold a wanted rank, and keeps each bucket's least and greatest digits.
An interval shrinks by its number of buckets per pass, and digits that do not vary cost little. The driver sees at most
``BUCKETS`` counts per pass and nothing of the data is moved or written; rows are then told apart by comparing with the cuts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.sources.scratch import materialize

#: Buckets of all intervals of a pass together.
BUCKETS = 8192
_STRING_BYTES = 6
_NULL = 1 << 62


@dataclass(frozen=True)
class Cut:
    """The row at a rank: its digits, and how many rows equal in all of them stand before it."""

    values: tuple
    skip: int


@dataclass(frozen=True)
class Digits:
    """Digits of an order, and further ones that tell rows with equal keys apart by their content."""

    order: tuple[Column, ...]
    content: tuple[Column, ...]


def _halves(value: Column, null_high: int) -> list[Column]:
    high = F.coalesce(F.shiftright(value, 32), F.lit(null_high).cast("long"))
    return [high, F.coalesce(value.bitwiseAND(0xFFFFFFFF), F.lit(0).cast("long"))]


def content_digits(columns: Sequence[str]) -> list[Column]:
    return _halves(F.xxhash64(*columns), 0)


def digits(df: DataFrame, order_by: Sequence[str], content: Sequence[str] | None = None) -> Digits:
    """Digits of ascending columns, NULL last, NaN before it; ties by a hash of ``content`` (all columns by default)."""
    text = [c for c in order_by if isinstance(df.schema[c].dataType, T.StringType)]
    longest = df.agg(*[F.max(F.octet_length(c)).alias(c) for c in text]).first().asDict() if text else {}
    out: list[Column] = []
    for c in order_by:
        kind, col, null = df.schema[c].dataType, F.col(c), F.lit(_NULL).cast("long")
        if c in longest:
            for at in range(max(1, -(-(longest[c] or 0) // _STRING_BYTES))):
                part = F.hex(F.substring(col.cast("binary"), at * _STRING_BYTES + 1, _STRING_BYTES))
                value = F.conv(F.rpad(part, 2 * _STRING_BYTES, "0"), 16, 10).cast("long")
                out.append(F.coalesce(value, null if at == 0 else F.lit(0).cast("long")))
        elif isinstance(kind, T.LongType):
            out += _halves(col, 1 << 31)
        elif isinstance(kind, T.DateType):
            out.append(F.coalesce(F.unix_date(col).cast("long"), null))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.coalesce(F.unix_micros(col.cast("timestamp")), null))
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            value = col.cast("double")
            endless = F.abs(value) == F.lit(float("inf"))
            out.append(F.when(value.isNull(), 3).when(F.isnan(value), 2).when(endless, F.signum(value).cast("int")).otherwise(0).cast("long"))
            out.append(F.when(value.isNull() | F.isnan(value) | endless, 0.0).otherwise(value))
        elif isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType)):
            out.append(F.coalesce(col.cast("long"), null))
        elif isinstance(kind, T.DecimalType):
            whole = F.floor(col).cast("decimal(38,0)")
            out += [F.when(col.isNull(), 1).otherwise(0).cast("long"), F.coalesce(whole, F.lit(0).cast("decimal(38,0)"))]
            out.append(F.coalesce((col - F.floor(col)).cast(f"decimal({max(1, kind.scale + 1)},{kind.scale})"), F.lit(0)))
        else:
            raise ValueError(f"no order statistics over {kind.simpleString()}")
    return Digits(tuple(out), tuple(content_digits(list(content or df.columns))))


@dataclass
class _Interval:
    """Rows that agree in ``prefix`` and lie between ``low`` and ``high`` in the next digits (as far as these are known)."""

    prefix: tuple
    before: int
    rows: int
    low: list
    high: list

    def settle(self) -> _Interval:
        """Take over the digits that do not vary."""
        while self.low and self.low[0] == self.high[0]:
            self.prefix = (*self.prefix, self.low[0])
            self.low, self.high = self.low[1:], self.high[1:]
        return self

    def name(self) -> tuple:
        return (self.prefix, *self.low[:1], *self.high[:1])

    def tests(self) -> list[str]:
        """Per digit, what a row of the interval fulfils."""
        out = [f"_d{i} = {_sql(v)}" for i, v in enumerate(self.prefix)]
        if self.low:
            out.append(f"_d{len(self.prefix)} between {_sql(self.low[0])} and {_sql(self.high[0])}")
        return out or ["true"]


def _sql(value) -> str:
    """A digit as an SQL literal; plans of many literals are built as text, which is much faster than column by column."""
    if isinstance(value, Decimal):
        return f"{value}BD"
    return f"double('{value!r}')" if isinstance(value, float) else f"{value}L"


def _digit_columns(found: Sequence[Column]) -> dict[str, Column]:
    return {f"_d{i}": c for i, c in enumerate(found)}


def _bucket(intervals: Sequence[_Interval], buckets: int) -> str:
    """Bucket of a row's open digit in its interval, whose number is ``_in``; 0 where digits are only looked at."""
    out = "case"
    for level in sorted({len(x.prefix) for x in intervals if x.low}):
        mine = {i: x for i, x in enumerate(intervals) if x.low and len(x.prefix) == level}
        lows = ", ".join(f"{i}, {_sql(x.low[0])}" for i, x in mine.items())
        widths = ", ".join(f"{i}, {_sql(float(x.high[0] - x.low[0]))}" for i, x in mine.items())
        share = f"double(_d{level} - map({lows})[_in]) / map({widths})[_in]"
        out += f" when _in in ({', '.join(map(str, mine))}) then int(least(floor({share} * {float(buckets)}), {buckets - 1}))"
    return "0" if out == "case" else f"{out} else 0 end"


def _counted(df: DataFrame, keys: Digits, intervals: Sequence[_Interval], buckets: int) -> dict[int, list]:
    """Rows (bucket, count, lows, highs) of each interval in the order of its buckets.

    Digits are looked at up to the one behind the open one; the content only where keys are equal.
    """
    every, level = [*keys.order, *keys.content], max(len(x.prefix) for x in intervals)
    seen = min(level + 2, len(keys.order) if level < len(keys.order) else len(every))
    rows = df.select(*[c.alias(name) for name, c in _digit_columns(every[:seen]).items()])
    if level:
        rows = rows.where(" or ".join({x.tests()[0] for x in intervals}))  # the first digit thins out the rows
    place = " ".join(f"when {' and '.join(x.tests())} then {i}" for i, x in enumerate(intervals))
    rows = rows.withColumn("_in", F.expr(f"case {place} end")).withColumn("_bucket", F.expr(_bucket(intervals, buckets)))
    ends = [F.expr(f"{end}(_d{i})").alias(f"{end}{i}") for end in ("min", "max") for i in range(seen)]
    found = rows.groupBy("_in", "_bucket").agg(F.count("*").alias("n"), *ends)
    out: dict[int, list] = {i: [] for i in range(len(intervals))}
    for r in found.collect():  # at most BUCKETS rows and one
        if r["_in"] is not None:
            out[r["_in"]].append((r["_bucket"], r["n"], *([r[f"{end}{i}"] for i in range(seen)] for end in ("min", "max"))))
    return {i: sorted(rows, key=lambda x: x[0]) for i, rows in out.items()}


def order_statistics(
    df: DataFrame, keys: Digits, ranks: Sequence[int], known: tuple[int, int, int] | None = None
) -> list[Cut]:
    """The rows at zero-based ``ranks`` in the order of the keys. Of a row that is alone, as many digits as show that.

    ``known``: number of rows and bounds of the first digit, if they need not be found out.
    """
    total = len(keys.order) + len(keys.content)
    if known:
        n, low, high = known[0], [known[1]], [known[2]]
    else:
        found = _counted(df, keys, [_Interval((), 0, 0, [], [])], 1)[0]
        n, low, high = found[0][1:] if found else (0, [], [])
    if any(not 0 <= r < n for r in ranks):
        raise ValueError(f"ranks must be between 0 and {n - 1}")
    at = {r: _Interval((), 0, n, list(low), list(high)).settle() for r in ranks}
    while True:
        open_ones = {r: x for r, x in at.items() if x.rows > 1 and len(x.prefix) < total}
        if not open_ones:
            return [Cut(at[r].prefix, r - at[r].before) for r in ranks]
        # The content is looked at only when all keys are through.
        in_order = [x for x in open_ones.values() if len(x.prefix) < len(keys.order)]
        chosen = {x.name(): x for x in in_order or open_ones.values()}
        names = list(chosen)
        counted = _counted(df, keys, list(chosen.values()), max(2, BUCKETS // len(names)))
        for r, x in open_ones.items():
            if x.name() not in chosen:
                continue
            before = x.before
            for _, rows, low, high in counted[names.index(x.name())]:
                if r < before + rows:
                    break
                before += rows
            done = len(x.prefix)
            at[r] = _Interval(x.prefix, before, rows, low[done:], high[done:]).settle()


def _behind(cut: Cut) -> str:
    """True for rows at or behind the cut (rows equal to it are taken only if none of them stands before it)."""
    out = "true" if cut.skip == 0 else "false"
    for i, value in reversed(list(enumerate(cut.values))):
        out = f"(_d{i} > {_sql(value)} or (_d{i} = {_sql(value)} and {out}))"
    return out


def cut_rows(df: DataFrame, keys: Digits, cuts: Mapping[str, Sequence[Cut]]) -> DataFrame:
    """Add, per name, the number of cuts that a row stands at or behind (int).

    Where a cut falls between rows that are equal in everything, those rows alone are written and numbered.
    """
    needed = max((len(c.values) for found in cuts.values() for c in found), default=0)
    digit = _digit_columns([*keys.order, *keys.content][:needed])
    shown = df.withColumns(digit) if digit else df

    def numbered(rows: DataFrame, text: Mapping[str, str]) -> DataFrame:
        return rows.select(*df.columns, *[F.expr(x).cast("int").alias(name) for name, x in text.items()])

    number = {name: " + ".join(["0", *(f"int({_behind(c)})" for c in found)]) for name, found in cuts.items()}
    split = sorted({c.values for found in cuts.values() for c in found if c.skip})
    if not split:
        return numbered(shown, number)
    same = {values: " and ".join(f"_d{i} = {_sql(v)}" for i, v in enumerate(values)) for values in split}
    parts = [numbered(shown.where(f"not ({' or '.join(f'({x})' for x in same.values())})"), number)]
    for values in split:
        rows = shown.where(same[values]).select(*df.columns).withColumn("_id", F.monotonically_increasing_id())
        rows = materialize(rows, "equal-rows")
        slice_of = F.shiftright("_id", 33)
        seen, starts = 0, []
        for s, n in sorted(map(tuple, rows.groupBy(slice_of).count().collect())):  # one row per written slice
            starts.append(f"{s}L, {seen}L")
            seen += n
        place = f"(map({', '.join(starts)})[shiftright(_id, 33)] + (_id & {(1 << 33) - 1}L))"
        text = {}
        for name, found in cuts.items():
            inside = [f"int({place} >= {c.skip})" for c in found if c.values == values]
            text[name] = " + ".join([str(sum(c.values < values for c in found)), *inside])
        parts.append(numbered(rows, text))
    return reduce(DataFrame.unionByName, parts)


#: Sampled rows per split point.
SPLIT_SAMPLE = 20


def sorts(df: DataFrame, columns: Sequence[str]) -> bool:
    """True when the columns' types have digits."""
    kinds = (
        T.StringType, T.LongType, T.DateType, T.TimestampType, T.TimestampNTZType, T.FloatType, T.DoubleType,
        T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.DecimalType,
    )
    return all(isinstance(c, str) and isinstance(df.schema[c].dataType, kinds) for c in columns)


def split_points(df: DataFrame, keys: Digits, slices: int) -> list[tuple]:
    """Digits that cut the order into about ``slices`` even parts, from one row of each of ``SPLIT_SAMPLE * slices``
    buckets of a hash: a sample of that size at most, the same one whenever the rows are."""
    digit = _digit_columns([*keys.order, *keys.content])
    rows, mixed = df.select(*[c.alias(name) for name, c in digit.items()]), F.xxhash64(*digit)
    wanted = SPLIT_SAMPLE * slices
    picked = rows.groupBy(F.pmod(mixed, F.lit(wanted)).alias("_bucket")).agg(
        F.min_by(F.struct(*digit), F.xxhash64(mixed)).alias("_row")
    )
    sample = sorted(tuple(r["_row"]) for r in picked.select("_row").collect())
    return sorted({sample[len(sample) * k // slices] for k in range(1, slices)}) if sample else []


def with_slice(df: DataFrame, keys: Digits, points: Sequence[tuple], out: str = "_slice") -> DataFrame:
    """Add the number of split points that a row stands at or behind (int), found by halving, and its digits as ``_key``.

    The points are part of the plan, so a row gets the same slice however often it is computed.
    """
    digit = _digit_columns([*keys.order, *keys.content])
    shown = df.withColumn("_key", F.struct(*[c.alias(name) for name, c in digit.items()]))
    if not points:
        return shown.withColumn(out, F.lit(0))
    kinds = [(f.name, f.dataType.simpleString()) for f in shown.schema["_key"].dataType.fields]
    rows = (
        ", ".join(f"'{name}', cast({_sql(v)} as {kind})" for (name, kind), v in zip(kinds, point)) for point in points
    )
    known = f"array({', '.join(f'named_struct({r})' for r in rows)})"
    steps = ", ".join(str(1 << k) for k in reversed(range(len(points).bit_length())))
    found = f"at + step <= {len(points)} and get({known}, at + step - 1) <= _key"
    return shown.withColumn(out, F.expr(f"aggregate(array({steps}), 0, (at, step) -> if({found}, at + step, at))"))

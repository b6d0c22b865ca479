"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

1. Fixed patterns find entities in whole texts: the base spans, which are the seeds.
2. The words around an entity or around any other token that looks like an identifier form lexical
   patterns ("before _ after", "two before _"). Patterns and instances are a bipartite graph, one row
   per different edge, so a pattern seen a million times with one instance counts once.
3. Rounds score both sides (after Snowball, Agichtein & Gravano 2000), per kind: a pattern by its trusted
   instances against those that contradict it, i.e. are seeds of another kind; what isn't known yet counts
   neither way, but at least ``SHARE`` of the kind's instances must be trusted, so that a context in which
   numbers pass a check digit by chance finds nothing. An instance gets 1 - prod(1 - score) over its patterns.
4. Tokens that end above ``TRUST`` and have the kind's shape are spans too, unless they overlap base spans.

The scan's result is written once with a row number, so the texts are read once.

Defined cases: a null text counts as empty and has no spans; repeated rows are each reported; a null
doc_id is carried; other columns are ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import table
from demandspark.sources import scratch

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, least score of a trusted pattern or instance, least different seeds of a pattern.
ROUNDS, TRUST, SUPPORT = 3, 0.9, 3
#: Least share of trusted ones among a pattern's instances of a kind.
SHARE = 0.5
#: The two words before a span, read backwards from it, and the word behind it, of any length; linear, as no part gives back.
_BEFORE = r"reverse(regexp_extract(reverse({}), '^\\s*+(\\S++(?:\\s++\\S++)?+)', 1))"
_AFTER = r"regexp_extract({}, '^\\s*+(\\S++)', 1)"

# The fixed patterns, written so that long runs take linear time: repetitions are possessive where what follows
# can't begin inside them, and a match begins at the start of its run or right after the match before (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NEEDED = {"email": "instr(t, '@') > 0", "ip": "digits", "card": "digits", "phone": "digits and instr(t, '+') > 0"}
_BYTE = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (s, i) -> s + transform(array(int(substr({d}, -i, 1)) * (2 - i % 2)), "
    "x -> if(x > 9, x - 9, x))[0]) % 10 = 0"
)
_DIGITS = "regexp_replace(h, '[^0-9]', '')"
_VALID = {
    "email": "true",
    "ip": f"h rlike r'^({_BYTE}\\.){{3}}{_BYTE}$'",
    "card": f"length({_DIGITS}) between 13 and 19 and transform(array({_DIGITS}), d -> {_LUHN.format(d='d')})[0]",
    "phone": f"length({_DIGITS}) between 9 and 15",
}
_TOKEN = r"(?<![A-Za-z0-9._%+@-])(?=[A-Za-z._%+-]*+[0-9@])[A-Za-z0-9._%+@-]{6,}+(?![A-Za-z0-9._%+@-])"
#: What an unseen identifier of a kind must look like.
_SHAPE = (
    "case when h rlike r'^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+$' then 0 when h rlike r'^[0-9]+(\\.[0-9]+){2,5}$' then 1 "
    "when h rlike r'^[0-9][0-9-]{11,22}[0-9]$' then 2 when h rlike r'^\\+?[0-9][0-9.-]{5,15}[0-9]$' then 3 else -1 end"
)
_SPAN = "struct<kind:int,start:int,end:int,value:string,before:string,after:string>"


def _found(pattern: str, kind: str, valid: str) -> str:
    """Valid matches of a pattern in ``t`` with positions: gaps and matches alternate, so lengths add up."""
    return (
        f"transform(array(split(t, r'{pattern}', -1)), g -> aggregate("
        f"transform(regexp_extract_all(t, r'{pattern}', 0), (h, i) -> struct(h as h, g[i] as b, g[i + 1] as a)), "
        f"struct(0 as at, cast(array() as array<{_SPAN}>) as found), "
        "(s, m) -> struct(s.at + length(m.b) + length(m.h) as at, "
        f"transform(array(m.h), h -> if({valid}, concat(s.found, array(struct({kind} as kind, s.at + length(m.b) as start, "
        "s.at + length(m.b) + length(m.h) as end, h as value, "
        f"{_BEFORE.format('m.b')} as before, {_AFTER.format('m.a')} as after))), s.found))[0] as found), s -> s.found))[0]"
    )


def scan(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, ``row``, and two lists of spans: ``base`` and other ``tokens`` that look like identifiers."""
    empty = f"cast(array() as array<{_SPAN}>)"
    rows = docs.select(*carry, F.expr("coalesce(text, '')").alias("t")).withColumn("digits", F.expr("t rlike '[0-9]'"))
    lists = [
        f"if({_NEEDED[k]}, {_found(PATTERNS[k], str(n), _VALID[k])}, {empty})" for n, k in enumerate(KINDS)
    ]
    tokens = f"if(digits or instr(t, '@') > 0, {_found(_TOKEN, _SHAPE, f'{_SHAPE} >= 0')}, {empty})"
    rows = rows.select(*carry, F.expr(f"concat({', '.join(lists)})").alias("base"), F.expr(tokens).alias("tokens"))
    apart = F.expr("filter(tokens, x -> not exists(base, b -> x.start < b.end and b.start < x.end))")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return scratch.materialize(rows, "identifiers").withColumn("tokens", apart)


def edges(scanned: DataFrame) -> DataFrame:
    """Different (kind, value, pattern, seed) of all spans."""
    spans = scanned.select(F.expr("explode(concat(transform(base, x -> struct(x as x, true as seed)), transform(tokens, x -> struct(x as x, false as seed)))) as s"))
    words = {
        "w1": "regexp_extract(s.x.before, r'(\\S+)\\s*$', 1)",
        "w2": "regexp_extract(s.x.before, r'(\\S+\\s+\\S+)\\s*$', 1)",
        "w3": "regexp_extract(s.x.after, r'^\\s*(\\S+)', 1)",
    }
    spans = spans.select("s", *(F.lower(F.expr(e)).alias(n) for n, e in words.items()))
    pattern = F.explode(F.expr("array(concat(w1, ' _ ', w3), concat(regexp_replace(w2, r'\\s+', ' '), ' _'))"))
    return spans.select(F.col("s.x.kind").alias("kind"), F.lower("s.x.value").alias("value"), "s.seed", pattern.alias("pattern")).groupBy(
        "kind", "value", "pattern"
    ).agg(F.max("seed").alias("seed"))


def trusted(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value) that no fixed pattern matches and that trusted contexts vouch for."""
    of_value = graph.where("seed").groupBy("value").agg(F.min("kind").alias("low"), F.max("kind").alias("high"))
    graph = graph.join(of_value, "value", "left").withColumn(
        "wrong", F.expr("not seed and coalesce(low != kind or high != kind, false)").cast("int")
    ).drop("low", "high")
    graph = scratch.materialize(graph, "pattern-graph")
    score = graph.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for _ in range(rounds):
        sums = graph.join(score, ["kind", "value"]).groupBy("pattern", "kind").agg(
            F.sum("score").alias("mass"), F.sum(F.col("seed").cast("int")).alias("seeds"),
            F.sum("wrong").alias("wrong"), F.count("*").alias("size"),
        )
        good = sums.where(f"seeds >= {SUPPORT} and mass >= {SHARE} * size").withColumn("trust", F.expr("mass / (mass + wrong)"))
        good = good.where(f"trust >= {TRUST}")
        reached = graph.join(good.select("pattern", "kind", "trust"), ["pattern", "kind"])
        reached = reached.groupBy("kind", "value").agg(
            F.max("seed").alias("seed"), F.expr("1 - exp(sum(ln(greatest(1 - trust, 1e-12))))").alias("score")
        )
        score = score.select("kind", "value", F.col("score").alias("old")).join(reached, ["kind", "value"], "left")
        score = score.select("kind", "value", F.expr("if(old = 1, 1.0D, greatest(old, coalesce(score, 0.0D)))").alias("score"))
        score = scratch.materialize(score, "instance-scores")
    seeds = graph.groupBy("kind", "value").agg(F.max("seed").alias("seed")).where("not seed")
    return score.where(f"score >= {TRUST}").join(seeds, ["kind", "value"]).select("kind", "value")


def with_spans(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns of every row with ``base`` spans and ``added`` spans."""
    scanned = scan(docs, *carry)
    found = trusted(edges(scanned))
    tokens = scanned.where("size(tokens) > 0").select("row", F.explode("tokens").alias("x"))
    tokens = tokens.select("row", F.col("x.kind").alias("kind"), F.lower("x.value").alias("value"), "x.start", "x.end")
    added = tokens.join(found, ["kind", "value"]).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "end"))).alias("added")  # one document's own spans
    )
    none = F.expr("cast(array() as array<struct<kind:int,start:int,end:int>>)")
    base = F.expr("transform(base, x -> struct(x.kind as kind, x.start as start, x.end as end))").alias("base")
    some = scanned.where("size(tokens) > 0").join(added, "row", "left")
    rest = scanned.where("size(tokens) = 0").select(*carry, base, none.alias("added"))
    return rest.unionByName(some.select(*carry, base, F.coalesce("added", none).alias("added")))


def _written(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, x -> concat(array({names})[x.kind], ':', x.start, ':', x.end)), ',')"


def report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and the list of all spans, per document."""
    found = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id")
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = {n})))").alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(_written("base")), 256).alias("base_sha256"),
        F.expr(_written("array_sort(concat(base, added))")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]`` in place of spans; n_chars follows."""
    columns = docs.columns
    found = with_spans(docs.select("text", F.struct(*columns).alias("_own")), "_own")
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    ordered = "array_sort(transform(concat(base, added), x -> struct(x.start as start, x.end as end, x.kind as kind)))"
    text = (
        f"aggregate({ordered}, struct(0 as at, array('') as parts), (s, x) -> if(x.start >= s.at, "
        "struct(x.end as at, concat(s.parts, array(substr(_own.text, s.at + 1, x.start - s.at), "
        f"array({names})[x.kind])) as parts), struct(greatest(s.at, x.end) as at, s.parts as parts)), "
        "s -> concat(array_join(s.parts, ''), substr(_own.text, s.at + 1)))"
    )
    new = F.expr(f"if(size(base) + size(added) = 0, _own.text, {text})")
    rows = found.select(new.alias("_new"), "_own")
    made = {"text": F.col("_new"), "n_chars": F.expr("if(_new is null, _own.n_chars, length(_new))") if "n_chars" in columns else None}
    return rows.select(*(made[c].cast(docs.schema[c].dataType).alias(c) if made.get(c) is not None else F.col(f"_own.{c}") for c in columns))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    return report(table(spark, folder, "documents", "doc_id", "text"))

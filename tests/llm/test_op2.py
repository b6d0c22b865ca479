"""Spans against Python's regular expressions; bootstrapping on texts with planted contexts."""

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from demandspark.llm import op2_pii as op
from demandspark.llm.registry import QUERIES

# The patterns as the result is defined.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def spans(text):
    text, digits = text or "", lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [("phone", m) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in want) for k in op.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(",")) | {""}
        order = [(op.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in r.spans.split(",") if s]
        assert order == sorted(order)


def test_query(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op2_pii"][0](spark, folder).collect()
    check(rows, texts)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0


def test_edge_texts(spark):
    texts = dict(enumerate([
        None, "", "a@b.c-d@e.f a@b.c._x@d.e", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004", "4111 1111 1111 1111", "é中😀 x@y.zz 😀 +1 (790) 555-2115!",
        "+123456789 +1--2 ++12345678901234", "1" * 30_000, "a." * 30_000 + "@", "4111111111111111" * 3, "x@y", "12-34 " * 9000, "a@b.c@d.e 1.1.1.1@x.y",
        "5500-0000-0000-0004 1.2.3.4", "+4111111111111111 9" * 3,
    ]))
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").selectExpr("*", "1 as row", "2 as t", "3 as base", "4 as digits")
    check(op.report(frame).collect(), texts)
    assert op.report(frame.where("false")).count() == 0
    twice = frame.where("doc_id = 5")
    assert op.report(twice.union(twice)).count() == 2


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(st.sampled_from(list("aB1234567890.@+-() %_é\n")), max_size=60), min_size=400, max_size=400))
def test_random_texts(spark, texts):
    texts = dict(enumerate(texts))
    check(op.report(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(k, f"reach me: user{k}@mail.example.org today, said {k} people") for k in range(40)]
    rows += [(100, "reach me: someone@intranet today, said he"), (101, "the file v@2024build was old"), (102, "nothing 1234567 here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as extra", "9L as n_chars")
    got = {r.doc_id: r for r in op.report(frame).collect()}
    assert got[100].spans == "email:10:26" and got[100].n_email == 0
    assert got[101].spans == "" and got[102].spans == ""
    clean = {r.doc_id: r for r in op.redacted(frame).collect()}
    assert clean[3].text == "reach me: [EMAIL] today, said 3 people" and clean[3].n_chars == len(clean[3].text)
    assert clean[100].text == "reach me: [EMAIL] today, said he" and clean[102].text == rows[-1][1] and clean[100].extra == "x"


def test_contexts_with_many_unseen_identifiers(spark):
    rows, unseen = [], set()
    for n in (1, 5, 10, 40):
        rows += [(1000 * n + k, f"mail of{n} user{k}x{n}@site{k}.org wrote") for k in range(40)]
        rows += [(1000 * n + 100 + k, f"mail of{n} some{k}x{n}@intranet wrote") for k in range(n)]
        unseen |= {1000 * n + 100 + k for k in range(n)}
    long = "a" * 80 + "@intranet"
    rows += [(90_000, f"mail of5 {long} wrote")]
    # One number in ten passes the check digit by chance, so the context says nothing of cards.
    rows += [(91_000 + k, f"order {4000000000000000 + 7 * k} came") for k in range(60)]
    found = op.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in found}
    assert all(got[d].spans.startswith("email:") and got[d].n_email == 0 for d in unseen | {90_000})
    orders = [got[91_000 + k] for k in range(60)]
    assert sum(r.n_card for r in orders) >= 3 and all(r.n_card or not r.spans for r in orders)


def test_context_words_of_any_length(spark):
    """Words beside a span are whole however long they, the white space or the text before them are."""
    long, gap = "x" * 5000, " " * 300
    text = f"{'filler words ' * 20_000}first {long}{gap}a@b.cd{gap}{long[::-1]} end, then one@two.de"
    frame = spark.createDataFrame([(1, text), (2, "a@b.cd")], "doc_id long, text string")
    rows = {r.doc_id: r.base for r in op.scan(frame, "doc_id").collect()}
    near = [(" ".join(x.before.split()), x.after) for x in rows[1]]
    assert near == [(f"first {long}", long), ("end, then", "")]
    assert [(x.before, x.after) for x in rows[2]] == [("", "")]

"""Packing against the tokenizer library, and as an exact round trip."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from demandspark.llm import op7_packing as op
from demandspark.llm.registry import QUERIES

PATH = op.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


ODD = st.text(st.sampled_from(list("ab'stT1 2\n\t\r  é.!<|>#ñ中́\x1c\x85")), max_size=40)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(ODD, st.text(max_size=30)))
def test_ids_are_the_librarys(library, text):
    text = text.encode("utf-8", "ignore").decode()
    assert np.frombuffer(op.encoder(PATH).ids(text), "<u4").tolist() == library(text)


@pytest.mark.parametrize(
    "text", ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  y", "<|endoftext", "\n<|endoftext|>\n z", " <|ENDOFTEXT|> "]
)
def test_added_tokens_are_cut_out_first(library, text):
    assert np.frombuffer(op.encoder(PATH).ids(text), "<u4").tolist() == library(text)


def check(rows, docs, library, length=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, text in docs:
        ids, at = library(text or "") + [2], 0
        mine = sorted(by_doc[doc], key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine)))
        for r in mine:
            part = np.array(ids[at : at + r.length], "<u4")
            assert r.start == at and r.ids_crc32 == zlib.crc32(part.tobytes())
            assert r.piece == 0 or r.length == length
            at += r.length
        assert at == len(ids) and (len(mine) == 1 or len(ids) > length)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    return sum(r.length for r in rows), len(by_sequence)


def test_query_round_trip(spark, folder, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    tokens, sequences = check(QUERIES["op7_packing"][0](spark, folder).collect(), docs, library)
    assert sequences <= 1.03 * tokens / 1024 + 1


def test_edge_rows(spark, library):
    docs = [(1, None), (2, ""), (3, "word " * 6000), (4, "  two  spaces\n\n end "), (5, "x" * 5000), (6, "a b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as length", "2 as rank")
    check(op.pack(frame, PATH).collect(), docs, library)
    assert op.pack(frame.where("false"), PATH).count() == 0
    twice = frame.where("doc_id = 6")
    assert op.pack(twice.union(twice), PATH).count() == 2


def test_plans_use_every_document_once_and_pack_tightly():
    rng = np.random.default_rng(1)
    for n in (1, 10, 1000, 200_000):
        histogram = np.bincount(rng.integers(1, 1025, n), minlength=1025)
        planned, used = op.plan(histogram), np.zeros(1025, int)
        for pattern, times in planned:
            assert sum(pattern) <= 1024 and times > 0
            np.add.at(used, list(pattern), times)
        assert (used == histogram).all()
        if n >= 1000:
            assert sum(t for _, t in planned) <= 1.02 * (histogram * np.arange(1025)).sum() / 1024 + 1

"""Archives against plain Python, an exact round trip, and another reader."""

import base64
import gzip
import hashlib
import pathlib

import pytest

from demandspark.llm import op12_warc as op
from demandspark.llm.registry import QUERIES


def brute(rows, least=0):
    groups = {}
    for page, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page)
    out = []
    for body, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for k, page in enumerate(ids):
            first = k == len(ids) - 1 or len(body) < least
            out.append((page, len(body), digest, "response" if first else "revisit", None if first else ids[-1]))
    return sorted(out, key=str)


def seen(df):
    columns = ("page_id", "payload_bytes", "digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_query_against_plain_python(spark, folder):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    got = QUERIES["op12_warc"][0](spark, folder)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


ROWS = [
    (1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, "http://a/3", "same"), (3, "http://a/3", "same"), (3, None, "same"),
    (4, "http://a/ 4\r\nWARC-Type: x%25", ""), (5, None, None), (None, "u", "alone"), (None, None, "twice"), (8, "u", "twice"),
    (9, "http://b/9", "\r\n\r\nWARC/1.1\r\n\r\n" * 40), (10, "http://b/10", "ä€🙂" * 90_000), (11, "http://b/11", "x" * 700), (11, "http://b/11", "y" * 700),
]


@pytest.mark.parametrize("chunk", [7, 1 << 18])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, monkeypatch, chunk, least):
    if chunk == 7:
        monkeypatch.setattr(op, "READ", 11)
    pages = spark.createDataFrame([r for r in ROWS if chunk > 7 or r[0] != 10], "page_id long, url string, html string").repartition(3)
    pages = pages.selectExpr("*", "'k' as kind", "1 as chunk", "2 as copy", "3 as body", "4 as BYTES")
    planned = op.records(pages, least)
    archives = op.write(op.chunked(pages, planned, chunk), f"file://{tmp_path}/warc")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert seen(op.read(archives, data=False)) == brute(rows, least)

    chunks = op.read(archives).collect()
    texts = {(p, (h or "")) for p, _, h in rows}
    bodies = {}
    for r in sorted(chunks, key=lambda r: (r.record_id, r.chunk)):
        body = bodies.setdefault(r.record_id, bytearray())
        if r.record_type == "response":
            assert len(body) == r.start and len(r.data) <= op.CHUNK
            body += r.data
            assert r.digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
            assert r.last == (len(body) == r.payload_bytes)
            if r.last:
                assert (r.page_id, body.decode()) in texts
    assert len(bodies) == len(rows)
    assert {r.url for r in chunks} == {u for _, u, _ in rows}


def test_archives_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    paths = [r.path for r in op.archived(pages, f"{tmp_path}/warc").collect()]
    found, ids, refers = 0, set(), set()
    for path in paths:
        text = gzip.decompress(pathlib.Path(path).read_bytes())
        while text:
            head, text = text.split(b"\r\n\r\n", 1)
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            block, end, text = text[:size], text[size : size + 4], text[size + 4 :]
            assert head.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n"
            found += 1
            ids.add(fields[b"WARC-Record-ID"])
            refers |= {fields[b"WARC-Refers-To"]} if b"WARC-Refers-To" in fields else set()
            if fields[b"WARC-Type"] == b"response":
                body = block.split(b"\r\n\r\n", 1)[1]
                assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(body).digest())
    assert found == len(ROWS) == len(ids) and refers <= ids


def test_a_changed_payload_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "some payload")], "page_id long, url string, html string")
    path = op.archived(pages, f"{tmp_path}/warc").first().path
    text = gzip.decompress(pathlib.Path(path).read_bytes()).replace(b"some payload", b"sole payload")
    pathlib.Path(path).write_bytes(gzip.compress(text))
    with pytest.raises(Exception, match="another digest"):
        op.read(spark.createDataFrame([(path,)], "path string")).collect()


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert op.read(op.archived(pages, f"{tmp_path}/warc")).count() == 0

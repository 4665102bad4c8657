"""Operator 6: round trip, revisits, record format, edge cases."""

import base64
import gzip
import hashlib
import io
import os
import tempfile

from clickwin.llm import warc
from clickwin.llm.queries import LLM_QUERIES

SCHEMA = "page_id long, url string, html string, digest string, n int"


def b32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows):
    first = {}
    for p, _, h, *_ in rows:
        if p is not None:
            first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, _, h, *_ in rows:
        f = first.get(h or "")
        again = f is not None and p != f
        out.append((p, len((h or "").encode()), b32(h), "revisit" if again else "response",
                    f if again else None))
    return sorted(out, key=repr)


ROWS = [(1, "http://a/", "<p>x</p>", "d", 1), (5, "http://b/ c\r\nX: y", "<p>x</p>", "d", 1),
        (5, "http://b/ c\r\nX: y", "<p>x</p>", "d", 1), (7, None, None, None, None), (8, "", "", "d", 1),
        (None, "http://n/", "<p>x</p>", "d", 1), (None, "http://n/", "only", "d", 1),
        (None, "http://m/", "only", "d", 1), (9, "http://l/", "Ä\r\n\r\nWARC/1.1\r\n" * 50_000, "d", 1),
        (10, "http://l/", "a\r\n\r\nb", "d", 1), (3, "http://z/", "a\r\n\r\nb", "d", 1)]


def test_query_columns_on_edge_cases(spark):
    got = warc.captures_digest(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS)


def test_min_bytes_leaves_small_payloads_alone(spark):
    got = warc.captures_digest(spark.createDataFrame(ROWS[:5], SCHEMA), min_bytes=100).collect()
    assert {r.record_type for r in got} == {"response"} and len(got) == 5


def test_payloads_survive_the_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    path = os.path.join(tempfile.mkdtemp(prefix="clickwin-test-"), "w")
    warc.write_archives(pages, path, file_bytes=50_000)
    records = warc.read_archives(spark, path)
    nested = warc.assemble(records).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert len(nested) == len(html)
    for r in nested:
        assert r.request.uri == r.response.uri and r.copies == 1
        if r.response.type == "response":
            assert bytes(r.response.payload).decode() == html[int(r.metadata.page_id)]
        else:
            assert r.response.payload is None and r.response.refers_to
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 1
    raw = gzip.open(os.path.join(path, files[0])).read()
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    kinds = [h["warc-type"] for h, _ in warc.parse_records(io.BytesIO(raw))]
    assert kinds.count("request") == kinds.count("metadata") == len(kinds) // 3


def test_missing_kind_is_a_null_struct(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="clickwin-test-"), "w")
    warc.write_archives(spark.createDataFrame(ROWS[:1], SCHEMA), path)
    rows = warc.assemble(warc.read_archives(spark, path).where("type <> 'request'")).collect()
    assert rows[0].request is None and rows[0].metadata.page_id == "1"


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.captures_digest(empty).count() == 0


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in LLM_QUERIES["op6_warc"](spark, sf).collect()), key=repr) == brute(rows)

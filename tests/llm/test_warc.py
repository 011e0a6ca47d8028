from __future__ import annotations

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from siltworks.llm import queries, warc

SCHEMA = "page_id long, url string, html string, record_type string, payload string"


def pages():
    long = "<p>" + "ä\r\n\r\nWARC/1.1\r\n" * 30
    rows = [(5, "http://a.b/x?y#z", long), (3, "http://c.d", long), (9, "no scheme", long), (3, "http://c.d", long), (1, "http://s/", "short"), (2, "http://s/", "short")]
    rows += [(4, None, None), (6, "http://e/\r\nX: y", ""), (None, "http://n", long), (None, "http://n", "n" * 200), (None, "http://m", "n" * 200)]
    rows += [(7, "http://big", "z" * 700_000), (8, "http://hundred", "h" * 100), (10, "http://hundred", "h" * 100), (11, "u", "i" * 99), (12, "u", "i" * 99)]
    return [(*r, "r", "p") for r in rows]


def digested(spark, tmp_path, monkeypatch, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    return queries.op5_warc_transactions(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("few", [0, 1000])
def test_round_trip(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(warc, "MOST_BROADCAST", few)
    rows, expected = pages(), []
    for page_id, _, html, *_ in rows:
        body = (html or "").encode()
        ids = [r[0] for r in rows if (r[2] or "").encode() == body and r[0] is not None]
        again = len(body) >= 100 and ids and page_id != min(ids)
        expected.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", min(ids) if again else None))
    found = [tuple(r) for r in digested(spark, tmp_path, monkeypatch, rows)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_captures_hold_payloads(spark, tmp_path):
    rows = pages()
    warc.write(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/w")
    captures = warc.assemble(warc.read(spark, f"{tmp_path}/w")).withColumn("page_id", warc.noted("pageId").cast("long"))
    found = captures.select("page_id", "response.record_type", "response.target_uri", F.col("response.payload").cast("string"), "request.record_type", F.size("metadata")).collect()
    assert len(found) == len(rows) and all(r[4] == "request" and r[5] == 1 for r in found)
    stored = {r[3] for r in found if r[1] == "response"}
    assert stored == {r[2] or "" for r in rows}
    assert "http://e/%0D%0AX: y" in {r[2] for r in found}


def test_empty(spark, tmp_path, monkeypatch):
    assert digested(spark, tmp_path, monkeypatch, []) == []


def record(kind, record_id, block=b"", **fields):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + record_id]
    lines += [k.replace("_", "-").encode() + b": " + v for k, v in fields.items()]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block)]) + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Members for each record, a request named by its response, orphans, several metadata records."""
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    parts = [
        record(b"warcinfo", b"<i>", b"x: y\r\n"),
        record(b"response", b"<r1>", http, WARC_Concurrent_To=b"<q1>", Content_Type=b"application/http"),
        record(b"request", b"<q1>", b"GET /"),
        record(b"metadata", b"<m1>", b"a: 1\r\n", WARC_Concurrent_To=b"<r1>"),
        record(b"metadata", b"<m2>", b"b: 2\r\n", WARC_Concurrent_To=b"<r1>"),
        record(b"request", b"<q2>", b"GET /lost", WARC_Concurrent_To=b"<gone>"),
    ]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, parts)))
    (tmp_path / "two.warc").write_bytes(record(b"response", b"<r2>", http, Content_Type=b"application/http"))
    (tmp_path / "none.warc").write_bytes(b"")
    rows = {r["capture"]: r for r in warc.assemble(warc.read(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<i>", "<r1>", "<gone>", "<r2>"}
    assert bytes(rows["<r1>"]["response"]["payload"]) == b"abc" and rows["<r1>"]["response"]["http_length"] == 3
    assert bytes(rows["<r1>"]["request"]["payload"]) == b"GET /" and len(rows["<r1>"]["metadata"]) == 2
    assert rows["<gone>"]["response"] is None and rows["<r2>"]["request"] is None


def test_several_concurrent_records(spark, tmp_path):
    """The one field that may repeat: a response that names request and notes, and notes that name a request and a response."""
    http = b"HTTP/1.1 200 OK\r\n\r\nabc"
    twice = lambda kind, name, one, two, block: record(kind, name, block, WARC_Concurrent_To=one).replace(
        b"WARC-Concurrent-To: " + one, b"WARC-Concurrent-To: " + one + b"\r\nWARC-Concurrent-To: " + two
    )
    parts = [
        twice(b"response", b"<r1>", b"<q1>", b"<m1>", http),
        record(b"request", b"<q1>", b"GET /1"),
        record(b"metadata", b"<m1>", b"a: 1\r\n"),
        record(b"response", b"<r2>", http),
        record(b"request", b"<q2>", b"GET /2", WARC_Concurrent_To=b"<r2>"),
        twice(b"metadata", b"<m2>", b"<q2>", b"<r2>", b"b: 2\r\n"),
        twice(b"metadata", b"<m3>", b"<x1>", b"<x2>", b"c: 3\r\n"),
    ]
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    rows = {r["capture"]: r for r in warc.assemble(warc.read(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<r1>", "<r2>", "<x1>"}
    for name, n in (("<r1>", 1), ("<r2>", 2)):
        assert bytes(rows[name]["request"]["payload"]) == b"GET /%d" % n
        assert [m["record_id"] for m in rows[name]["metadata"]] == [f"<m{n}>"]


def test_cut_archive_raises():
    with pytest.raises(ValueError, match="ends within"):
        list(warc.parse(record(b"response", b"<r>", b"abcdef")[:-8]))

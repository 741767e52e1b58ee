import base64
import gzip
import hashlib

import pytest

from riskframe.llm import warc as W

URLS = ["http://www.b.example.org/x?q=1", "https://b.example.org:8080/X", "http://a.example.com", None, "", "no url", "http://[bad", "http://é.example/ü\r\nX: y",
        "http://b.example.org/x?q=1", "HTTP://B.EXAMPLE.ORG/X?Q=1"]


def make(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 5) for i, u, h in rows], "page_id long, url string, html string, key string, length long").repartition(3)


def corpus():
    rows = [(i, URLS[i % len(URLS)], ["<p>same</p>", None, "", f"<b>{i}</b>\r\n\r\né漢", "x" * 200_000, "WARC/1.1\r\n"][i % 6]) for i in range(120)]
    return rows + [(3, "http://again.example", "<p>same</p>"), (3, "http://again.example", "<p>same</p>"), (None, "http://none.example", "lone"), (None, "http://none.example", "<p>same</p>")]


def brute(rows, least):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, u, h in rows:
        body = (h or "").encode()
        copies = sum((x[2] or "") == (h or "") for x in rows) > 1 and len(body) >= least
        kind = "revisit" if copies and i != first.get(h or "") else "response"
        out.append((i, u, kind, first.get(h or "") if kind == "revisit" else None, base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body), body if kind == "response" else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,block", [(0, 7), (5, 500)])
def test_archive_and_index_round_trip(spark, least, block):
    rows = corpus()
    pages = make(spark, rows)
    captures = W.write_archive(pages, min_payload=least)
    index = W.build_index(captures, block_captures=block)
    got = W.read_records(W.lookup(index, pages), gap=1000, most=100_000).collect()
    assert sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload)) for r in got), key=str) == brute(rows, least)
    wanted = spark.createDataFrame([("https://www.b.example.org/x?q=1",), ("http://nowhere.example/",)], "url string")
    keys = {W.url_key(u) for u in ("http://b.example.org/x?q=1",)}
    found = W.lookup(index, wanted).collect()
    assert {r.key for r in found} == keys and len(found) == sum(W.url_key(u) in keys for _, u, _ in rows)


def test_one_key_over_many_shards(spark):
    pages = spark.range(500).selectExpr("id as page_id", "'http://hot.example/' as url", "concat('p', id) as html").repartition(4)
    captures = W.write_archive(pages)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = W.build_index(captures, block_captures=10)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert index.count() > 1
    assert sorted(r.page_id for r in W.lookup(index, pages).collect()) == list(range(500))


def test_members_are_plain_gzip(spark):
    r = W.write_archive(make(spark, [(1, "http://a.example/", "<p>")])).first()
    data = gzip.open(r.file.removeprefix("file:")).read()
    assert data.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and data.endswith(b"<p>\r\n\r\n")


def test_url_keys():
    assert W.url_key("https://blog.example.org:8080/A?b") == "org,example,blog:8080)/a?b"
    assert W.url_key("http://www.example.org") == "org,example)/" and W.url_key(None) == ""


def test_empty_table(spark):
    pages = make(spark, [(1, "u", "h")]).where("false")
    index = W.build_index(W.write_archive(pages))
    assert index.count() == 0 and W.read_records(W.lookup(index, pages)).count() == 0

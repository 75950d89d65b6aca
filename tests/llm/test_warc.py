import base64
import gzip
import hashlib
import re
import time
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.llm import warc
from siltstone.llm.tables import load

SF = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title>
<style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><p>One <b>two</b>&nbsp;three<br>four</p><!-- <a href="/no"> --><ul><li>x<li>y</ul>
<a class=c href="/a?x=1&amp;y=2">link</a><img alt=i src='pic.png'><a href=http://z.org/>z</a>
<a href="http://[bad">b</a></body></html>"""


def sha1(block):
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def test_records_of_one_page():
    uri, rid = "http://h.org/dir/p.html", "<urn:uuid:1>"
    meta, conv = warc.derived_records(7, rid, uri, "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nX: y", PAGE)
    (head, block), = warc.read_records(conv[-1])
    assert block.decode() == "A & B\nOne two three\nfour\nx\ny\nlinkz\nb"
    assert head["WARC-Type"] == "conversion" and head["WARC-Refers-To"] == rid
    assert head["WARC-Source-Digest"] == sha1(PAGE.encode())
    assert head["WARC-Block-Digest"] == sha1(block)
    assert head["WARC-Target-URI"] == uri and head["WARC-Date"] == "2024-01-01T00:00:00Z"
    (about, fields), = warc.read_records(meta[-1])
    assert about["WARC-Concurrent-To"] == head["WARC-Record-ID"]
    assert head["WARC-Concurrent-To"] == about["WARC-Record-ID"]
    lines = fields.decode().split("\r\n")
    assert f"derived-record: {head['WARC-Record-ID']}" in lines
    assert "source-header: HTTP/1.1 200 OK" in lines and "source-header: X: y" in lines
    assert "title: A & B" in lines
    links = [x.removeprefix("outlink: ") for x in lines if x.startswith("outlink")]
    want = [("/a?x=1&y=2", "a"), ("pic.png", "img"), ("http://z.org/", "a")]
    assert links == [f"{urljoin(uri, u)} {t}" for u, t in want] + ["http://[bad a"]


def test_files_round_trip(spark, tmp_path):
    pages = load(spark, SF, "pages")
    found = warc.derive(warc.page_responses(pages))
    rows = {r.record_id: r for r in found.collect()}
    assert len(rows) == 2 * pages.count()
    warc.write_records(found, f"{tmp_path}/out")
    seen = 0
    for path in (tmp_path / "out").glob("*.gz"):
        for head, block in warc.read_records(gzip.decompress(path.read_bytes())):
            row = rows[head["WARC-Record-ID"]]
            assert warc.record(list(head.items())[:-1], block) == bytes(row.record)
            assert sha1(block) == head["WARC-Block-Digest"] == row.block_digest
            assert head["WARC-Refers-To"] == row.refers_to
            seen += 1
    assert seen == len(rows)
    texts = {r.page_id: r.html for r in pages.collect()}
    for r in rows.values():
        assert r.source_digest == sha1(texts[r.key].encode())
        if r.record_type == "conversion":
            (_, block), = warc.read_records(bytes(r.record))
            assert block.decode() == warc.plain_text(texts[r.key])
            assert "<p>" not in block.decode() and "track(" not in block.decode()


def test_odd_rows_and_empty_table(spark):
    rows = [
        (1, None, None), (1, None, None), (None, "u", "<p>x"), (2, "http://a/\r\nX: y", ""),
        (3, "u", "<a href='//[x'>" * 3), (4, "u", "&#0;&bogus; < > <" + "p>" * 50_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("record", F.lit(1)).withColumn("key", F.lit("k"))
    found = warc.derive(warc.page_responses(pages)).collect()
    assert len(found) == 2 * len(rows)
    for r in found:
        (head, block), = warc.read_records(bytes(r.record))
        assert len(block) == r.content_length
        assert "X" not in head
    assert warc.derive(warc.page_responses(pages.limit(0))).collect() == []


@pytest.mark.parametrize(
    "opener", ["<script ", "<script>", "<!--", "<a ", "<a href='", "<title>", "<", "<p "]
)
def test_a_megabyte_of_openers(spark, opener):
    html = "<p>seen</p>" + opener * (1_000_000 // len(opener))
    pages = spark.createDataFrame([(1, "http://a.b/", html)], "page_id long, url string, html string")
    start = time.monotonic()
    found = warc.derive(warc.page_responses(pages)).collect()
    assert time.monotonic() - start < 60 and len(found) == 2


def slow_without_hidden(markup):
    pattern = r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->"
    return re.sub(pattern, " ", markup, flags=re.S | re.I)


PARTS = ["<script>", "</script >", "<STYLE x>", "</style>", "<!--", "-->", "text", "<", "<noscript"]


@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_hidden_parts_are_those_that_are_closed(markup):
    assert warc.without_hidden(markup) == slow_without_hidden(markup)

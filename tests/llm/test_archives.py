"""WARC bundles and HTML extraction."""

import base64
import hashlib

import numpy as np
import pytest
import zstandard

from tests.oracle import compare, connect
from tutelage.llm import html, warc

PAGES = [(5, "http://a/", "<p>one</p>"), (3, "http://b/\r\nX: y", "<p>one</p>"), (9, None, None), (8, "u", ""), (7, "u", "é" * 5000), (None, "u", "<p>one</p>"), (None, "u", "alone"), (7, "u", "é" * 5000)]


@pytest.fixture
def written(spark, tmp_path, monkeypatch):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, mark string").coalesce(2)
    return warc.write(pages, f"file://{tmp_path}/w")


def test_round_trip(spark, written, tmp_path):
    rows = warc.read(written).collect()
    got = sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows), key=str)
    first = {"<p>one</p>": 3, "": 8, "é" * 5000: 7, "alone": None}
    want = []
    for page, _, text in PAGES:
        data = (text or "").encode()
        head = first[text or ""]
        want.append((page, "response" if page == head or head is None else "revisit", None if page == head else head, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode()))
    assert got == sorted(want, key=str)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in rows if r["record_type"] == "response"} == {(3, "<p>one</p>"), (8, ""), (7, "é" * 5000), (None, "alone")}
    assert sorted(map(str, warc.fetch(written.filter("page_id = 5 or page_id = 7")).collect())) == sorted(str(r) for r in rows if r["page_id"] in (5, 7))


def test_any_zstandard_reader_reads_an_archive(written):
    path = written.first()["archive"].removeprefix("file://")
    data = open(path, "rb").read()
    plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    rows = [r for r in written.collect() if r["archive"].endswith(path)]
    assert plain.count(b"WARC/1.1\r\n") == len(rows)


def test_frames_and_archives_end_at_their_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    bundle = warc.Bundle(f"file://{tmp_path}")
    rng = np.random.default_rng(1)
    for i in range(50):
        name, data = warc.record(i, f"http://h/{i}", bytes(rng.integers(97, 123, 300, dtype=np.uint8)), None)
        bundle.add(name, i, data)
    rows = bundle.close()
    assert len({r[3] for r in rows}) > 5
    index = spark.createDataFrame(rows, warc.INDEX)
    assert [r["page_id"] for r in warc.read(index).collect()] == list(range(50))
    assert {r["page_id"] for r in warc.fetch(index.filter("page_id % 7 = 0")).collect()} == set(range(0, 50, 7))


def test_revisits_from_a_size_on_and_empty_table(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = warc.write(pages, f"file://{tmp_path}/a", revisit_bytes=11)
    assert {r["page_id"] for r in warc.read(index).filter("record_type = 'revisit'").collect()} == set()
    assert warc.read(warc.write(pages.limit(0), f"file://{tmp_path}/b")).count() == 0


@pytest.mark.parametrize("name", ["op5_warc_bundles", "op7_benchmark_decontamination"])
def test_query_equals_sql(spark, name):
    from tutelage.llm.queries import ORACLE, QUERIES

    sf = "/root/testdata/sf0.001"
    assert compare(spark, connect(sf), sf, QUERIES[name], ORACLE[name]) is None


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h2>Site name that is long enough to look like text, really it is</h2></header><nav><ul><li><a href=1>Menu one</a><li><a href=2>Menu two</a></ul></nav>
<div class="cookie-notice">We use cookies and would like you to accept all of them, every single one of them.</div>
<article><header><h1>Title &amp; more</h1></header><p>First   paragraph with <b>bold</b> and\n\ta <a href=x>link</a>, long enough to be content.<br><p>Yes.
<p>Second &lt;paragraph&gt; with enough words in it to be content as well, and then some.</p><form><label>Mail</label><input></form>
<aside>Read also this other article about something else entirely, it is good.</aside><section class="comments"><p>A reader's comment that is as long as any paragraph of the text.</p></section></article>
<div id="sidebar">Some sidebar text</div><footer>&copy; all rights reserved</footer></body></html>"""


def test_article_without_the_rest():
    assert html.main_text(PAGE) == "Title & more\n\nFirst paragraph with bold and a link, long enough to be content.\n\nYes.\n\nSecond <paragraph> with enough words in it to be content as well, and then some."


def test_pages_without_an_article_go_by_ratio():
    long = "A sentence of the story that goes on for a good while, so that the ratio of text to tags is high. " * 3
    links = "".join(f"<div><a href={i}><b>Link</b></a></div>" for i in range(12))
    page = f"<body><div>{links}</div><div><p>{long}</p><p>Short.</p><p>{long}</p></div><div>{links}</div></body>"
    assert html.main_text(page) == "\n\n".join([long.strip(), "Short.", long.strip()])


def test_extraction_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (3, "u", "just text &amp; more", 1), (4, "u", "<p>open <div", 1), (4, "u", "<nav>never closed<article><p>yes", 1), (5, "u", "<p>" + "w " * 200_000, 1)], "page_id long, url string, html string, text int")
    got = {(r["page_id"], r["url"]): r["text"] for r in html.extract(pages).collect()}
    assert got[(1, "u")] == "" and got[(2, None)] == "" and got[(3, "u")] == "just text & more" and got[(4, "u")] in ("yes", "open") and len(got[(5, "u")]) == 399_999
    assert html.extract(pages.limit(0)).count() == 0
    assert html.main_text("<nav>never closed<article><p>yes") == "yes"


def test_threshold_splits_two_clusters():
    assert 5 < html.threshold(np.array([1, 2, 1.5, 80, 100.0])) < 70
    assert html.threshold(np.array([50, 51.0])) == 0.0
    assert np.allclose(html.smoothed(np.ones(7)), 1)


def test_hadoop_names_of_s3_are_known(monkeypatch):
    """Only the address is looked at: the store itself would ask the network."""
    class Store:
        from_uri = staticmethod(lambda address: (None, address))

    monkeypatch.setattr(warc.pafs, "FileSystem", Store)
    for scheme in ("s3", "s3a", "s3n"):
        assert warc.store_of(f"{scheme}://bucket/folder/a.warc.zst")[1] == "s3://bucket/folder/a.warc.zst"
    assert warc.store_of("hdfs://host/s3a://x")[1] == "hdfs://host/s3a://x"


ARTICLE = "<html><body><nav><a href=x>Menu</a></nav><article>%s</article><footer>Foot</footer></body></html>"


@pytest.mark.parametrize("inside, want", [
    ('<p>One long first paragraph of text.<p class="advert">Buy now<p>Another paragraph stays here.', ["One long first paragraph of text.", "Another paragraph stays here."]),
    ('<ul><li>First item of the list<li class="share">Share it<li>Third item of the list</ul><p>After the list.', ["First item of the list", "Third item of the list", "After the list."]),
    ('<p>Before.</p><ul><li>Outer item<ul><li class="share">inner<li>Inner item</ul><li>Outer again</ul>', ["Before.", "Outer item", "Inner item", "Outer again"]),
    ('<dl><dt>Term one<dd class="ad">gone<dt>Term two<dd>Meaning two</dl>', ["Term one", "Term two", "Meaning two"]),
    ('<table><tr><td>Cell one<td class="promo">gone<tr><td>Cell two</table>', ["Cell one", "Cell two"]),
    ('<p class="advert">Gone <b>too<div>A block of text that stays.</div>', ["A block of text that stays."]),
])
def test_end_tags_may_be_left_out(inside, want):
    assert html.main_text(ARTICLE % inside).split("\n\n") == want


def test_many_tags_take_time_in_proportion():
    import time

    for page in ("<p>word <i>x</i>" * 50_000, "<div>" * 30_000 + "x" + "</b></i>" * 30_000, "<ul><li>a" * 30_000, "<p>a</span>" * 100_000):
        start = time.perf_counter()
        html.main_text(page)
        assert time.perf_counter() - start < 20

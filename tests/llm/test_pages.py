"""WARC archives and main text of pages."""

import base64
import gzip
import hashlib
import io
import time

import pytest
from pyspark.sql import functions as F

from videonet.llm import main_text, warc
from videonet.session import scratch_path

PAGES = "page_id long, url string, html string, payload_key int, refers_to int, text int"


def _rows():
    long_page = "<p>" + "long text é " * 60_000
    return [(1, "http://a/1", "same", 0, 0, 0), (5, "http://a/5", "same", 0, 0, 0), (3, None, "same", 0, 0, 0),
            (5, "http://a/5", "same", 0, 0, 0), (None, "http://n", "same", 0, 0, 0), (7, "x%0A\r\ny: z", None, 0, 0, 0),
            (8, "http://a/8", "", 0, 0, 0), (-2, "http://neg", "one é 😀", 0, 0, 0), (9, "http://a/9", long_page, 0, 0, 0),
            (None, "http://m", "alone\r\n\r\nWARC/1.1", 0, 0, 0)]


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 100])
def test_archives_round_trip(spark, archive_bytes):
    rows = _rows()
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    folder = scratch_path(spark, "warc-test")
    archives = warc.write_archives(pages, folder, archive_bytes)
    assert archives.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read_archives(archives, folder).collect()
    owners = {"same": 5, "": 8}
    wanted = []
    for page_id, url, html, *_ in rows:
        html = html or ""
        owner = owners.get(html)
        revisit = owner is not None and page_id != owner
        data = html.encode()
        wanted.append((page_id, url, None if revisit else data, len(data),
                       base64.b32encode(hashlib.sha1(data).digest()).decode(),
                       "revisit" if revisit else "response", owner if revisit else None))
    assert sorted(map(repr, ((r[0], r[1], None if r[2] is None else bytes(r[2]), *r[3:]) for r in found))) == sorted(
        map(repr, wanted))


def test_each_record_is_a_gzip_member():
    records = [warc.record(i, f"http://x/{i}", b"payload %d" % i, None) for i in range(3)]
    members = [warc.gzip_member(r) for r in records]
    assert [gzip.decompress(m) for m in members] == records
    assert gzip.decompress(b"".join(members)) == b"".join(records)
    assert [r["payload"] for r in warc.read_archive(io.BytesIO(b"".join(members)))] == [b"payload 0", b"payload 1", b"payload 2"]


def test_bad_archives_are_refused():
    good = warc.record(1, "u", b"payload", None)
    whole = warc.gzip_member(good)
    for bad in (
        warc.gzip_member(good.replace(b"payload", b"paXload")), warc.gzip_member(good[:-6]),
        warc.gzip_member(good + b"more"), whole[:-12], warc.gzip_member(b"nothing"),
    ):
        with pytest.raises(warc.BadRecord):
            list(warc.read_archive(io.BytesIO(bad)))


def test_empty_archive(spark):
    folder = scratch_path(spark, "warc-test")
    archives = warc.write_archives(spark.createDataFrame([], PAGES), folder)
    assert warc.read_archives(archives, folder).count() == 0


CASES = [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<script>var a='<p>no</p>'", ""),
    ("<article><h1>T</h1><p>one&nbsp;two &amp; \n three<br>four</article><footer>no</footer>", "T\none two & three four"),
    ("<nav><ul><li><a href=x>Menu</a></ul></nav><main><div><p>a</div><div><p>b</div></main>", "a\nb"),
    ("<body><header><h1>Site name</h1></header><div class='menu'><a href=x>A</a></div><ul><li><a href=u>Home</a></ul>"
     "<div id=content><h1>T &amp; U</h1><p>Long text that goes on and on.<p>Second <b>bo</b>ld<ul><li>one<li>two</ul></div>"
     "<div class=\"user comments\"><p>I agree a lot, so much that I write a very long comment about it here.</div>"
     "<aside>Side</aside><form>Send<input></form><footer>(c)</footer>",
     "T & U\nLong text that goes on and on.\nSecond bold\none\ntwo"),
    ("<article><p>keep</p><div class=ad>buy</div><p>this</p><!-- <p>not</p> --><p class='x' data-y='a>b'>too</p></article>",
     "keep\nthis\ntoo"),
    ("<article><p>&lt;b&gt; &#233; &copy &#x1F600;</p></article>", "<b> é © 😀"),
    ("<div class=cookie-notice>We use cookies</div><article><p>x</p></article><article class=comment><p>y</p></article>", "x"),
    ("<div class=top>Some words of the site itself, rather long ones.</div><div class='page content'><div><h1>T</h1></div>"
     "<div><p>The text of the page, which is longer.</div><div class=sidebar>more</div></div><div>Bottom line</div>",
     "T\nThe text of the page, which is longer."),
    ("</div></section><p>stray ends</p></article>", "stray ends"),
    ("<article><div class='ad'><div>a</div><div>b</div></div><p>rest", "rest"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_main_text(page, text):
    assert main_text.main_text(page) == text


def test_long_page_is_read_whole(spark):
    page = "<nav>menu</nav><article>" + "".join(f"<p>paragraph {i}</p>" for i in range(40_000)) + "</article>"
    frame = spark.createDataFrame([(1, None, page), (None, "u", None), (None, "u", None)], "page_id long, url string, html string")
    rows = main_text.extract_main_text(frame).collect()
    assert sorted(len(r["text"].split("\n")) for r in rows) == [1, 1, 40_000]
    assert main_text.extract_main_text(frame.limit(0)).count() == 0


LONG = "Long text that goes on and on, with words enough to be much the largest line of all. " * 4
KEPT_CASES = [
    ("<article><h2 id='related-work'>Related work</h2><section id='search'><p>about search</p></section></article>",
     "Related work\nabout search"),
    ("<article class='post comments-open'><p>kept</p></article>", "kept"),
    ("<div class='layout no-sidebar'><article><p>kept</p></article></div>", "kept"),
    ("<div class=sidebar><p>links</p></div><div class=menu><article><p>kept</p></article></div>", "kept"),
    ("<article><h1 class=banner>Title</h1><div class='overflow-hidden'>one</div><p title='hidden gems'>two</p>"
     "<div data-note='display:none'>three</div></article>", "Title\none\ntwo\nthree"),
    ("<article><div hidden>a</div><div class=x hidden=''>b</div><p aria-hidden='true'>c</p><p style='display: none'>d</p>"
     "<div class='cookie_banner'>e</div><div id=comments>f</div><p>kept</p></article>", "kept"),
    ("<article><p>one <svg-icon></svg-icon> two</p><p>three</p><svg><text>no</text></svg><p>four</p></article>",
     "one two\nthree\nfour"),
    (f"<div><div><h2>Heading</h2></div><div><p>{LONG}</p></div><div><p>Short one.</p></div><section><p>The end.</p>"
     "</section></div>", f"Heading\n{LONG.strip()}\nShort one.\nThe end."),
    (f"<div><div><a href=a>Home</a> <a href=b>News</a></div><div><p>{LONG}</p></div><div>Bye.</div></div>",
     f"{LONG.strip()}\nBye."),
    ("<p class=ad>buy<p>more<article><p>kept</p></article>", "kept"),
    (f"<div class=post-meta>By me</div><div>{LONG}</div>", f"By me\n{LONG.strip()}"),
    ("<article><p>See <span class='ad'>AD</span> 79, press <button>OK</button> <b hidden>x</b>now.</p></article>",
     "See 79, press now."),
    ("<article><ul><li class='share'>Market share grew.</li><li>b</li></ul><div id='search'><p>A search.</p></div>"
     "<p class='notice'>Notice periods are long.</p><div class='menu'>The menu was short.</div></article>",
     "Market share grew.\nb\nA search.\nNotice periods are long.\nThe menu was short."),
    ("<article><p>a</p><div class=share><a href=x>Tweet</a> | <a href=y>Mail</a></div><div class=search><input>Go</div>"
     "<ul class=menu><li>One</ul><div class=related><p>x</p><form>y</form></div><p>b <span class=share><a>T</a></span> c</p>"
     "<div class=notice><div class=alert><a>z</a></div>kept</div>d</article>", "a\nb c\nkept\nd"),
    ("<article><p class=share><a>x</a><p>next</article>", "next"),
]


@pytest.mark.parametrize("page,text", KEPT_CASES)
def test_main_text_is_kept(page, text):
    assert main_text.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a " * 350_000 + ">", "<script " * 130_000, "<!" * 500_000, "<" + "a" * 1_000_000,
    "<a title=\"" * 90_000, "<a 'x" * 170_000, "<a \"'" * 170_000, "<div class=banner>" * 55_000 + "<article>x</article>",
    "<article>" + "<div class=menu>" * 60_000 + "x", "<div><a>x</a><a>y</a>" * 40_000 + "</div>" * 40_000,
    "<p " + " " * 1_000_000, "&" * 1_000_000, "<p>" * 330_000, "</script" * 120_000,
])
def test_odd_pages_of_a_megabyte_in_seconds(page):
    start = time.monotonic()
    main_text.main_text(page)
    assert time.monotonic() - start < 15


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    page = "<article><p>one</p></article>"
    rows = [(1, "u", page, "t", 5), (1, "u", page, "t", 5), (None, None, page, None, None), (2, "v", "", "t", 5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    out = main_text.extract_main_text(frame)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted(map(repr, ((r["page_id"], r["url"], r["text"]) for r in out.collect()))) == sorted(map(repr, [
        (1, "u", "one"), (1, "u", "one"), (None, None, "one"), (2, "v", "")]))
    assert main_text.extract_main_text(frame.limit(0)).count() == 0

"""URL filter, WARC archives, main text."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from panelwise.llm import html_text, url_filter, warc
from panelwise.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, raw string, bad boolean, text string"


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "h", "r", True, "t") for r in rows], PAGES)

    return make


def link(target):
    return f'<html><head><LINK href="{target}" rel="canonical"></head></html>'


def test_hosts_paths_and_rules(spark, pages):
    cases = [
        ("http://a.B.Net/x?q#f", "a.b.net", "/x", "net/", "block"),
        ("https://m.example.net/en/1?x=/de/", "m.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("https://badexample.com/de/", "badexample.com", "/de/", None, "allow"),
        ("http://x.org/fr/http://y.net/", "x.org", "/fr/http://y.net/", "org/fr/", "allow"),
        ("http://net", "net", "", None, "allow"),
        ("http://ÄB.example.com/DE/", "Äb.example.com", "/DE/", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://q.net?x", "q.net", "", None, "allow"),
        ("http://" + "s." * 300 + "net/" + "p" * 5000, "s." * 300 + "net", "/" + "p" * 5000, "net/", "block"),
    ]
    rows = pages([(i, c[0], None) for i, c in enumerate(cases)] + [(0, cases[0][0], "")])
    got = url_filter.filter_urls(rows, url_filter.rules_frame(spark, URL_RULES))
    assert got.columns == ["page_id", "url", "raw", "bad", "text", "host", "path", "rule", "verdict"]
    found = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect())
    want = sorted([(i, *c[1:]) for i, c in enumerate(cases)] + [(0, *cases[0][1:])], key=str)
    assert sorted(found, key=str) == want


def test_blocks_reach_aliases_and_allow_comes_first(spark, pages):
    rows = pages([
        (1, "http://a.test/1", link("http://b.test/2")),
        (2, "http://b.test/2", '<meta http-equiv="refresh" content="0; url=http://evil.net/9">'),
        (3, "http://c.test/3", link("/4#part")),
        (4, "http://c.test/4", link("http://example.net/en/5")),
        (5, "http://c.test/6", link("http://c.test/4")),
        (6, "http://c.test/7", link("http://evil.net/10")),
        (7, "http://evil.net/10", link("http://c.test/3")),
        (8, "http://lonely.test/", link("http://lonely.test/")),
    ])
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(rows, url_filter.rules_frame(spark, URL_RULES)).collect()}
    assert got == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "block", 8: "allow"}


def test_relative_targets_and_character_references(spark, pages):
    base = '<base target=x><base href="/k/&#x2E;/"><base href="http://c.test/">'
    cases = [
        ("http://A.test/d/e.html?q#f", "x.html", "http://a.test/d/x.html"),
        ("http://a.test/d/e/f", "../x", "http://a.test/d/x"),
        ("http://a.test/d/e", "../../../x/./y/..", "http://a.test/x/"),
        ("http://a.test/d/e?q=1", "?id=2", "http://a.test/d/e?id=2"),
        ("http://a.test", "x", "http://a.test/x"),
        ("http://a.test?q", "?r", "http://a.test/?r"),
        ("http://a.test/1", "go?u=http://b.test/", "http://a.test/go?u=http://b.test/"),
        ("http://a.test/2", "http:&#47;&#x2F;b.test&sol;c?x=1&#38;y=2&amp;copy=3&copy=4", "http://b.test/c?x=1&y=2&copy=3&copy=4"),
        ("http://a.test/3", "//b.test/c/../d", "http://b.test/d"),
        ("http://a.test/4", "mailto:x@b.test", None),
        ("http://a.test/5", "#part", None),
        ("no address", "x.html", None),
    ]
    rows = [(i, url, link(target)) for i, (url, target, _) in enumerate(cases)]
    rows += [(20, "http://a.test/6", base + link("x")), (21, "http://a.test/g/7", '<meta http-equiv=refresh content="0;URL=x.html">')]
    got = {(r.a, r.b) for r in url_filter.alias_edges(pages(rows)).collect()}
    want = {b for *_, b in cases if b} | {"http://a.test/k/x", "http://a.test/g/x.html"}
    assert {b for _, b in got} == want
    assert ("http://a.test/d/e.html?q", "http://a.test/d/x.html") in got
    rows = pages([(1, "http://a.test/d/1", link("../2")), (2, "http://a.test/2", link("http://evil.net/"))])
    verdicts = url_filter.filter_urls(rows, url_filter.rules_frame(spark, URL_RULES)).select("page_id", "verdict").collect()
    assert {r.page_id: r.verdict for r in verdicts} == {1: "block", 2: "block"}


def test_no_pages(spark, pages):
    assert url_filter.filter_urls(pages([]), url_filter.rules_frame(spark, URL_RULES)).count() == 0
    assert html_text.extract_main_text(pages([])).count() == 0


# --- WARC


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize(("least", "archive_bytes"), [(0, 256 << 20), (3, 300)])
def test_archives_and_back(spark, many_partitions, pages, tmp_path, monkeypatch, least, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    given = [(1, "http://a/\r\nX: y", "same"), (5, "http://b/", "same"), (3, None, "same"), (2, "u", None), (4, "u", ""),
             (7, "ü", "Grüße\r\n\r\n\x00" * 50000), (None, "n", "same"), (None, "n", "alone"), (5, "http://b/", "same")]
    archives = warc.write_warc(pages(given).repartition(4), str(tmp_path), least)
    rows = warc.read_warc(archives, str(tmp_path)).collect()
    assert len(rows) == len(given) == archives.agg(F.sum("n_records")).first()[0]
    newest = {}
    for key, _, html in given:
        if len((html or "").encode()) >= least and key is not None:
            newest[html or ""] = max(key, newest.get(html or "", key))
    want = []
    for key, _, html in given:
        first = newest.get(html or "")
        again = first is not None and key != first
        want.append((key, len((html or "").encode()), sha(html), "revisit" if again else "response", first if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert all(bytes(r.payload).decode() in [h or "" for _, _, h in given] for r in rows if r.record_type == "response")
    assert archive_bytes > 300 or archives.count() > 4


def test_no_records(pages, tmp_path):
    archives = warc.write_warc(pages([]), str(tmp_path))
    assert archives.count() == 0 and warc.read_warc(archives, str(tmp_path)).count() == 0


def one(payload=b"hello"):
    return warc.record("response", "<urn:page:1>", "http://x/", "2024-01-01T00:00:00Z", payload, {"X-Payload-Length": str(len(payload))})


def test_members_are_gzip_and_read_in_order():
    data = one(b"a") + one(b"b" * 100_000) + one(b"")
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3
    assert [block for _, block in warc.records(io.BytesIO(data))] == [b"a", b"b" * 100_000, b""]


@pytest.mark.parametrize("harm", ["cut", "flip", "length", "digest", "text"])
def test_damage_is_seen(harm):
    plain = gzip.decompress(one())
    data = {
        "cut": one()[:-9], "flip": one()[:40] + bytes([one()[40] ^ 255]) + one()[41:],
        "length": gzip.compress(plain.replace(b"Content-Length: 5", b"Content-Length: 4")),
        "digest": gzip.compress(plain.replace(b"hello", b"hallo")), "text": gzip.compress(b"no record"),
    }[harm]
    with pytest.raises(warc.DamagedArchive):
        list(warc.records(io.BytesIO(one() + data)))


# --- main text

BODY = [
    ("", ""),
    ("plain &amp; text", "plain & text"),
    ("<p>a<script>1<2", "a"),
    ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<html><head><title>T</title></head><body><nav><a>Home</a></nav><article><h1>T</h1><p>one\n two&nbsp;three</p><p>.</p></article><footer>c</footer>", "T\none two three\n."),
    ("<article><p>short</p><div class='ad-box'>buy</div><p>rest</p></article><article class=\"comment\"><p>" + "long " * 50 + "</p></article>", "short\nrest"),
    ("<div id=menu>m</div><div class='cookie-notice'>we use</div><div><h2>Head</h2><p>" + "text " * 30 + "</p><p>x</p></div><div class=sidebar><ul><li>a</ul></div><form><input>Find</form>", "Head\n" + ("text " * 30).strip() + "\nx"),
    ("<main><section><p>a</p></section><aside>no</aside><section><p>b</p></section></main>", "a\nb"),
    ("<nav>never closed <article><p>body</p></article>", "body"),
    ("<p title=\"a > b\">q &lt;b&gt; &#228;&hellip;</p>", "q <b> ä…"),
    ("<style>p{}</style><noscript>on</noscript><textarea>t</textarea><p>kept</p>", "kept"),
]


@pytest.mark.parametrize(("page", "text"), BODY)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "text " * 40 + "end"
WRAPPED = [
    f'<div class="content with-sidebar"><p>{LONG}</p></div>',
    f'<article class="post has-comments"><p>{LONG}</p></article>',
    f'<div><p>{LONG}</p></div><section id="related-work"><p>{LONG}</p></section><section id="ad-hoc-queries"><p>{LONG}</p></section>',
    f'<table class="fixed-header"><tr><td>{LONG}</td></tr></table>',
    f'<div data-id="menu" data-role="navigation" title="x class=ad"><p>{LONG}</p></div>',
    f'<div class="header"><article><p>{LONG}</p></article></div><div class="ad">buy</div>',
    f'<div class="notice"><p>{LONG}</p></div><p>x</p>',
    f'<div id="main"><div class="ad">buy</div><p>{LONG}</p></div>',
    f'<div><div class="ad">buy</div></div><div><span class="share">never closed</div><p>{LONG}</p>',
    f'<section><div class="ad">never closed</section><section><p>{LONG}</p></section>',
    f'<form id="aspnetForm"><div><p>{LONG}</p></div></form>',
    f'<section id="related">a <p>b</p></section><ul><li class="share">s<li>{LONG}</ul>',
    f'<html><head><meta charset=x><body><main class="menu"><p>{LONG}</p></main><nav>{LONG * 3}</nav>',
]


@pytest.mark.parametrize("page", WRAPPED)
def test_layout_names_do_not_take_the_article(page):
    assert html_text.main_text(page).count(LONG) == page.count(LONG) - 3 * page.count("<nav>")
    assert not any(x in html_text.main_text(page) for x in ("buy", "never", "s\n"))


def test_labels_are_left_out_beside_an_article():
    page = f'<div><p>{LONG}</p></div><div id="comments"><div class="comment">{LONG[:50]}!</div></div><div class="shareButtons">s</div>'
    assert html_text.main_text(page) == LONG
    assert html_text.main_text(f"<b><div class=ad></b>buy</div><p>{LONG}</p>") == LONG


def test_work_is_linear_in_the_depth_of_a_page():
    page = "<b><div class=ad>" + "<span>" * 50_000 + "</b>" * 50_000 + "x</div><p>y</p>"
    assert html_text.main_text(page) == "y"


def test_extract_keeps_rows_and_replaces_text(pages):
    rows = pages([(1, "u", BODY[4][0]), (1, "u", BODY[4][0]), (None, None, None), (2, "v", "<p>" + "w " * 100_000 + "</p>")])
    got = html_text.extract_main_text(rows)
    assert got.columns == ["page_id", "url", "html", "host", "raw", "bad", "text"]
    texts = sorted(len(r.text) for r in got.collect())
    assert texts == [0, len(BODY[4][1]), len(BODY[4][1]), 199_999]


def test_windows_tell_parts_apart():
    lines = ["a" * 50, "b", "", "", "", "c" * 80, "", "d", "", "", ""]
    assert [(a, b) for a, b, _ in html_text.regions(lines)] == [(0, 2), (5, 8)]
    assert [peak for *_, peak in html_text.regions(lines)] == [51, 81]


def test_long_hosts_and_paths_cost_in_proportion(spark):
    host, path = "a." * 30_000 + "net", "/a/.." * 30_000 + "/x"
    pages = spark.createDataFrame([(1, f"http://{host}{path}", None)], "page_id long, url string, html string")
    rules = url_filter.rules_frame(spark, [("net", "/", "block"), ("a.net", "/x", "allow")])
    start = time.time()
    row = url_filter.filter_urls(pages, rules).first()
    assert (row.host, row.rule, row.verdict) == (host, "net/", "block") and time.time() - start < 20


class Plain(HTMLParser):
    """Text of the blocks inside article, by the standard library's parser: an independent way to the same pages."""

    LEFT_OUT = {"nav", "header", "footer", "aside", "form", "script", "style", "button"}
    BLOCK = {"article", "h1", "h2", "h3", "p", "ul", "ol", "li", "div", "section", "blockquote", "table", "tr", "td", "th", "pre", "hr", "figure"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.out, self.blocks, self.text = 0, 0, [], []

    def cut(self):
        line = " ".join("".join(self.text).split())
        self.text = []
        if line:
            self.blocks.append(line)

    def handle_starttag(self, tag, attrs):
        if self.inside and tag in self.BLOCK:
            self.cut()
        if tag == "br" and self.inside:
            self.text.append(" ")
        self.inside += tag == "article"
        self.out += tag in self.LEFT_OUT

    def handle_endtag(self, tag):
        if self.inside and tag in self.BLOCK:
            self.cut()
        self.inside -= tag == "article"
        self.out -= tag in self.LEFT_OUT

    def handle_data(self, data):
        if self.inside and not self.out:
            self.text.append(data)


def test_whole_pages_equal_an_independent_parser(spark):
    from panelwise.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for row in QUERIES["op10_html_text"](spark, folder).collect():
        parser = Plain()
        parser.feed(html[row.page_id] or "")
        parser.cut()
        assert row.text == "\n".join(parser.blocks) and row.n_chars == len(row.text)


def test_window_sums_decide_on_pages_without_article(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect() if r.html]
    want = [html_text.main_text(x) for x in pages]
    bare = [re.sub(r"(</?)article\b", r"\1div", x) for x in pages]
    assert sum(html_text.main_text(x) == y for x, y in zip(bare, want)) > 0.95 * len(pages)
    bare = [re.sub(r"(</?)(nav|footer|aside|header)\b", r"\1div", x) for x in bare]
    narrow = [html_text.main_text(x, window=2) for x in bare]
    assert sum(x == y for x, y in zip(narrow, want)) > 0.8 * len(pages)
    for other in ({"window": 1}, {"window": 3}, {"window": 50}, {"window": 2, "surge": 0.0}):
        assert sum(html_text.main_text(x, **other) != y for x, y in zip(bare, narrow)) > 0.1 * len(pages)


def test_menu_lines_never_surge():
    menu = "".join(f"<div>Link {i}</div>" for i in range(30))
    text = "<p>" + "Words of the article stand here. " * 9 + "</p>"
    assert html_text.main_text(f"<body>{menu}<p>Short start</p>{text}{text}</body>", window=2).startswith("Short start\nWords")
    assert "Link" not in html_text.main_text(f"<body>{menu}{text}{text}</body>", window=2).replace("Link 29", "")


def test_every_full_article_and_short_last_sections():
    long = "Words of the article stand here. " * 9
    two = f"<article><h1>A</h1><p>{long}</p></article><article class=x><p>{long}</p></article><article><p>teaser</p></article>"
    assert html_text.main_text(two).split("\n") == ["A", long.strip(), long.strip()]
    sections = f"<body><section><h1>T</h1><p>{long}</p></section><section><p>{long}</p></section><section><p>short end.</p></section></body>"
    assert html_text.main_text(sections).split("\n") == ["T", long.strip(), long.strip(), "short end."]


@pytest.mark.parametrize("label", ["site-header", "site-footer", "user-comments", "related-posts", "newsletter-signup-cta", "mainNav"])
def test_compound_labels_go(label):
    text = "Words of the article stand here. " * 9
    assert html_text.main_text(f"<body><p>{text}</p><p>{text}</p><div class='{label}'>Out {text}</div></body>") == "\n".join([text.strip()] * 2)


@pytest.mark.parametrize("label", ["content with-sidebar", "has-comments", "related-work", "ad-hoc-queries", "no-footer"])
def test_compounds_that_are_no_labels_stay(label):
    text = "Words of the article stand here. " * 9
    assert html_text.main_text(f"<body><p>{text}</p><div class='{label}'>In {text}</div></body>") == f"{text.strip()}\nIn {text.strip()}"


@pytest.mark.parametrize("how", ["hidden", "style='display: none'", "style='color:red;display:none'", 'style="visibility:hidden"'])
def test_what_readers_do_not_see_goes(how):
    assert html_text.main_text(f"<article><p>seen</p><p {how}>not seen</p></article>") == "seen"
    assert html_text.main_text("<article><p data-hidden=1 class=hidden-gem>seen</p></article>") == "seen"


@pytest.mark.parametrize("part", ["<a ", '<a "', "<!x", "<a '\"", '<a href="x>', "<!--", "<script>", "</p", "<p>", "<b", "< <"])
def test_broken_markup_costs_in_proportion(part):
    start = time.time()
    html_text.main_text("<p>start</p>" + part * 100_000)
    assert time.time() - start < 8

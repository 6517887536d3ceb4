"""op6: a tree-based twin on all pages, broken and deep markup, containers that only sound like sidebars."""

import html
import time
from html.parser import HTMLParser

import duckdb
import pytest

from terrakern.llm.html_extract import BLOCKS, extract, extract_pages, parse

WORDS = "The quick brown fox jumps over the lazy dog and runs home again. " * 4


class Twin(HTMLParser):
    """Text of the page's article, by the standard library's parser: blocks split at block tags."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.depth, self.lines, self.held = 0, [], []

    def flush(self):
        text = " ".join(html.unescape("".join(self.held)).split())
        self.held = []
        if text:
            self.lines.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self.flush()
        if tag == "article":
            self.depth += 1
        if tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if tag == "article":
            self.depth -= 1

    def add(self, text):
        if self.depth:
            self.held.append(text)

    handle_data = add

    def handle_entityref(self, name):
        self.add(f"&{name};")

    def handle_charref(self, name):
        self.add(f"&#{name};")


def test_equals_a_tree_based_twin_on_all_pages(spark):
    rows = duckdb.sql("SELECT page_id, html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    want = {}
    for i, page in rows:
        twin = Twin()
        twin.feed(page or "")
        twin.flush()
        want[i] = "\n".join(twin.lines)
    got = {r.page_id: r.text for r in extract_pages(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).collect()}
    assert len(got) == len(rows) > 200
    assert {i for i in want if got[i] != want[i]} == set()


def took(source):
    began = time.perf_counter()
    out = extract(source)
    return time.perf_counter() - began, out


def test_broken_markup_takes_linear_time():
    body = f"<article><p>{WORDS}</p></article>"
    hard = {
        "apostrophe": "<p title=" + "n" * 5000 + "'" + body,
        "unclosed quote": '<p title="' + "x " * 20000 + body,
        "quoted ends": '<p a="x>" ' * 20000 + body,
        "deep": "<div>" * 20000 + body,
        "deep with text": "<div>a b" * 20000 + body,
        "inline": "<b>" * 20000 + body,
        "inline and blocks": "<b>" * 5000 + "<p>x" * 5000 + body,
        "wrong ends": "<b>" * 5000 + "</i>" * 20000 + body,
        "no end": body + "<a" * 50000,
        "comments": body + "<!-- " * 20000,
        "declarations": body + "<!x" * 50000,
        "scripts": body + "<script></script" * 20000,
        "lists": "<ul><li>" * 10000 + body,
        "heads": "<thead>" * 10000 + body,
    }
    for name, source in hard.items():
        seconds, _ = took(source)
        assert seconds < 3, name
    assert WORDS.strip() in took("<p title=" + "n" * 22 + "'>" + body)[1]
    assert WORDS.strip() in took("<p title=don't>" + body)[1]


def test_very_long_page(spark):
    page = "<body><div class=story>" + f"<p>{WORDS}</p>" * 20000 + "</div></body>"
    frame = spark.createDataFrame([(1, "http://a/", page), (2, "http://a/", None), (2, None, "")], "page_id long, url string, html string")
    got = sorted((r.page_id, r.n_chars) for r in extract_pages(frame).collect())
    assert got == [(1, 20000 * (len(WORDS.strip()) + 1) - 1), (2, 0), (2, 0)]


@pytest.mark.parametrize(
    "opening",
    [
        '<div class="content with-sidebar">', '<div class="post-header-wide">', '<article class="post tag-news widget">', '<main class="main has-sidebar">', '<main class="no-sidebar">',
        '<article class="post comments-open">', '<div class="content has-share">', '<article class="post tags-news">', '<form id="aspnetForm">', '<div class="widget">', "<header>",
    ],
)
def test_containers_that_only_sound_like_more(opening):
    closing = f"</{opening[1:].split()[0].strip('>')}>"
    page = f'<html><head><title>t</title><body><nav><ul><li><a href=/>Home page</a></ul></nav>{opening}<h1>Title</h1><p>{WORDS}</p><div class="sidebar"><p>Also here</p></div><p>{WORDS}</p>{closing}<div>Stray line</div><footer>f</footer>'
    text = extract(page)
    assert text.count(WORDS.strip()) == 2 and "Title" in text
    assert "Also here" not in text and "Home page" not in text


def test_headings_leads_lists_and_sections_stay():
    wrap = lambda inner: f"<body><div class=top><a href=/>Home</a></div>{inner}<div class=comments><p>{WORDS * 3}</p></div></body>"
    assert extract(wrap(f"<article><h1>T</h1><p>lead</p><section>{WORDS}</section></article>")) == f"T\nlead\n{WORDS.strip()}"
    assert extract(wrap(f"<article><p>intro</p><ul><li>{WORDS}<li>{WORDS}</ul></article>")) == f"intro\n{WORDS.strip()}\n{WORDS.strip()}"
    assert extract(wrap(f"<article><section class=a>{WORDS}</section><section class=b>short end</section></article>")) == f"{WORDS.strip()}\nshort end"
    assert extract(wrap(f"<div class=post><h2>T</h2><p>lead</p><div class=text><p>{WORDS}</p></div></div>")) == f"T\nlead\n{WORDS.strip()}"
    assert extract(wrap(f"<div class=post><div class=a><p>{WORDS}</p></div><div class=b><p>{WORDS[:140]}</p></div></div>")) == f"{WORDS.strip()}\n{WORDS[:140].strip()}"
    assert extract(wrap(f"<article><blockquote>{WORDS}</blockquote><p>then</p></article>")) == f"{WORDS.strip()}\nthen"


def test_unclosed_head_and_entities():
    assert extract("<head><title>x</title><body><p>a &lt; b &amp;amp; &#233;</p>") == "a < b &amp; é"
    assert extract("") == "" and extract("no markup at all") == "no markup at all" and extract("a < b") == "a < b"
    assert len(parse("<p>" * 3).elements) == 4

"""HTML beside the standard library's parser, and the cases patterns get wrong."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from millrace.functions import html as H, markup as M


class Reference(HTMLParser):
    """Anchors and visible text as the standard library sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs, self.text, self.raw = [], [], False

    def handle_starttag(self, tag, attrs):
        values = dict(reversed(attrs))
        if tag == "a" and values.get("href") is not None:
            self.hrefs.append(values["href"].strip(" \t\n\f\r"))
        self.raw = tag in M.RAW_TEXT

    def handle_endtag(self, tag):
        self.raw = False

    def handle_data(self, data):
        if not self.raw:
            self.text.append(data)


PIECES = ["<a href='/one'>", '<A class="x > y" HREF = "/q?a=1&amp;b=2">', "<a href=/bare&eacute; id=z>", "</a>", "text &eacute; &#38;lt; ", "<b>", "</b>",
          "<!-- <a href='/no'> -->", "<!DOCTYPE html>", "<script>var t = '<a href=\"/no\">';</script>", "<style>a > b {}</style>", "a < b ", "<br/>",
          "<img src='a' alt=\"b\">", "<p>", "</p>", "<a name='n'>", "&notin; &unknown; ", "<a href='/x' href='/y'>", "\n", "<a\nhref\n=\n'/lines'\n>"]


def test_beside_the_standard_library():
    rng = random.Random(3)
    for _ in range(2000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 15)))
        parser = Reference()
        parser.feed(page)
        parser.close()
        assert M.targets(page) == parser.hrefs, page
        text = "".join(v for kind, v, _ in M.tokens(page) if kind == "text")
        assert text == "".join(parser.text), page


@pytest.mark.parametrize("page,want", [
    ('<!-- <a href="/old"> --><a href="/new">', ["/new"]),
    ('<script>x = "<a href=\'/no\'>"</script ><a href="/yes">', ["/yes"]),
    ("<!--><a href='/a'><!---><a href='/b'><!-- x --!><a href='/c'><!-- open <a href='/no'>", ["/a", "/b", "/c"]),
    ("<?php <a href='/no'>?><a href='/yes'>", ["/yes"]),
    ("<title><a href='/no'></title><textarea><a href='/no'></textarea><a href='/yes'>", ["/yes"]),
    ("<a title=it's href=/q>", ["/q"]), ("<a href='/never", []), ("<a href='x'", []), ("<a href>", []), ("<a href=>", [""]),
    ("<a/href=/slash>", ["/slash"]), ("<abbr href=/no><a =href=/odd href=/b>", ["/b"]), ("</ a href=/no><a href=' /blank '>", ["/blank"]),
    ("<a href='?a=1&copy=2&copy;&copyx&lt'>", ["?a=1&copy=2©&copyx<"]),
])
def test_anchors(page, want):
    assert M.targets(page) == want


@pytest.mark.parametrize("page,tags,want", [
    ("<p>open one<p>open two", ["p"], ["open one", "open two"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["li"], ["a", "b c", "d"]),
    ("<div>a<div>b</div>c</div><div>d</div>", ["div"], ["a b c", "d"]),
    ("<p>caf&eacute; &#38;lt; &hellip;</p>", ["p"], ["café &lt; …"]),
    ("<div>a<script>no</script><style>no</style><!-- no -->b</div>", ["div"], ["a b"]),
    ("<p>a<div>b</div>c</p>", ["p"], ["a"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["td"], ["1", "2", "3"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["tr"], ["1 2", "3"]),
    ("<dl><dt>a<dd>b<dt>c</dl>", ["dt", "dd"], ["a", "b", "c"]),
    ("<span>a</b></i>b</span></span>", ["span"], ["a b"]), ("<p>a<br>b<hr>c", ["p"], ["a b"]),
    ("<li></li><li> </li>", ["li"], ["", ""]), ("a < b <p>1 < 2</p>", ["p"], ["1 < 2"]), ("", ["p"], []),
])
def test_elements(page, tags, want):
    assert M.element_texts(page, tags) == want


@pytest.mark.parametrize("page", ["<" * 200_000, "<a " * 100_000, "<p>" * 100_000, "<b>" * 50_000 + "<p>" * 50_000, "<!--" * 100_000, "<a x='" * 50_000,
                                  "<script>" * 50_000, "&" * 200_000, "<a " + "x=1 " * 100_000 + ">", "<li><b>" * 50_000])
def test_hostile_pages_take_linear_time(page):
    import time
    start = time.time()
    M.targets(page)
    M.element_texts(page, ["p", "li"])
    assert time.time() - start < 5


def test_columns(spark):
    df = spark.createDataFrame([("<a href='/x'>caf&eacute;</a><p>1<p>2", ), (None,), ("",)], "html string")
    rows = df.select(H.links(F.col("html"), F.lit("https://s.com")).alias("l"), H.tags_text(F.col("html"), ["p"]).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(["https://s.com/x"], "1 2"), (None, None), ([], "")]

"""Elements of pages and selectors against a plain tree from html.parser."""

import collections
from html.parser import HTMLParser

import pytest

from vellum import catalogue_queries
from vellum.sources import markup

SF = "/root/testdata/sf0.01"
VOID = set(markup.VOID)


class Tree(HTMLParser):
    """Elements as dicts with their parents and text; end tags that fit none are ignored. No end is implied by a start, as of the b and p of the table."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.all, self.open = [], []
        self.feed(page or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        own = {}
        for k, v in attrs:
            own.setdefault(k, v or "")
        e = {"tag": tag, "attrs": own, "up": list(self.open), "text": []}
        self.all.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k]["tag"] == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        if not self.open or self.open[-1]["tag"] not in ("script", "style"):
            for e in self.open:
                e["text"].append(data)


def text(e):
    return " ".join("".join(e["text"]).replace("\xa0", " ").split())


def test_whole_table_equals_a_tree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = {(r.page_id): Tree(r.html) for r in pages.collect()}
    found = markup.nodes(pages)
    got = collections.defaultdict(list)
    for r in markup.with_text(found.where("node > 0"), found).orderBy("page_id", "node").collect():
        got[r.page_id].append((r.tag, r.attrs, r.text))
    for k, tree in rows.items():
        assert [g[:2] for g in got[k]] == [(e["tag"], e["attrs"]) for e in tree.all]
        closed = [i for i, e in enumerate(tree.all) if e["tag"] in ("h1", "a", "title", "nav", "article")]
        assert [got[k][i][2] for i in closed] == [text(tree.all[i]) for i in closed]


def test_page_fields_equal_a_tree(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in catalogue_queries.queries()["s30_page_fields"](spark, SF).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        all_ = Tree(r.html).all
        under = lambda e, tag: any(u["tag"] == tag for u in e["up"])
        first = lambda es, f: next((f(e) for e in es), None)
        g = got[r.page_id]
        assert g.title == first([e for e in all_ if e["tag"] == "h1" and under(e, "article")], text)
        assert g.lang == first([e for e in all_ if e["tag"] == "html" and "lang" in e["attrs"]], lambda e: e["attrs"]["lang"])
        assert g.charset == first([e for e in all_ if e["tag"] == "meta" and "charset" in e["attrs"]], lambda e: e["attrs"]["charset"])
        links = [e["attrs"]["href"] for e in all_ if e["tag"] == "a" and "href" in e["attrs"] and (under(e, "article") or under(e, "nav"))]
        assert (g.links or []) == links


PAGE = """<!DOCTYPE html><HTML Lang=en><head><title>A &amp; B</title><!-- <h1>no</h1> --><script>if (a<b) document.write("<h1 class='x'>no</h1>")</script>
<body class="one two"><ul id=menu><li>first<li class='on two'>second <a href="/a?x=1&amp;y=2" title="a > b">link</a><ul><li>inner</ul><li>third</ul>
<p>para<p>other <b>bold <i>both</b> still</i><div><p>in div</div><table><tr><td>1<td>2<tr><td>3</table><img src=x/y/ alt><br/>end <p class="two">last"""


def chosen(spark, selector, page=PAGE):
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    found = markup.nodes(pages)
    return [(r.tag, r.text) for r in markup.with_text(markup.selected(found, selector), found).orderBy("page_id", "node").collect()]


@pytest.mark.parametrize(
    ("selector", "expected"),
    [
        ("title", [("title", "A & B")]),
        ("h1", []),
        ("#menu > li", [("li", "first"), ("li", "second linkinner"), ("li", "third")]),
        ("ul ul li", [("li", "inner")]),
        ("ul > li li", [("li", "inner")]),
        ("li.two.on a", [("a", "link")]),
        (".two", [("body", None), ("li", "second linkinner"), ("p", "last")]),
        ("body.two > p", [("p", "para"), ("p", "other bold both still"), ("p", "last")]),
        ("td", [("td", "1"), ("td", "2"), ("td", "3")]),
        ("tr > td", [("td", "1"), ("td", "2"), ("td", "3")]),
        ("div p, tr", [("p", "in div"), ("tr", "12"), ("tr", "3")]),
        ("a[href^='/a'][title*=b]", [("a", "link")]),
        ("a[href$='y=2']", [("a", "link")]),
        ("[alt]", [("img", "")]),
        ("img[src='x/y/']", [("img", "")]),
        ("body[class~=one] i", [("i", "both")]),
    ],
)
def test_selectors(spark, selector, expected):
    got = chosen(spark, selector)
    assert [(t, None if t == "body" else x) for t, x in got] == expected


def test_intervals_nest(spark):
    import random

    rng = random.Random(1)
    page = "".join(rng.choice(["<div>", "</div>", "<p>", "<li>", "<ul>", "</ul>", "<b>", "</b>", "x", "<br>", "<td>", "<table>", "</table>", "<!-- <p> -->", "<", "&lt;", "<a b='", "'>"]) for _ in range(3000))
    found, text_ = markup.nodes_of(page)
    for node, last, parent, depth, _, _, a, b in found:
        assert node <= last < len(found) and 0 <= a <= b <= len(text_)
        if parent is not None:
            up = found[parent]
            assert up[0] < node <= last <= up[1] and depth == up[3] + 1 and up[6] <= a <= b <= up[7]


def test_text_of_broken_pages():
    text_ = markup.plain_text
    assert text_("<html><head><title>T</title><p>Hello world") == "Hello world"
    assert text_('<script>var s="<body>"; x</script><p>a') == "a"
    assert text_("<p>a<script>never closed <p>b") == "a"
    assert text_("a <b") == "a" and text_("1 < 2 & 3") == "1 < 2 & 3" and text_("") == ""
    assert text_("<p title='x>y'>a</p>b<div>c<br>d") == "a\nb\nc\nd"
    assert text_("e<noscript>f<noscript>g</noscript>h</noscript>i<template>j") == "e ij"
    assert text_("a<!-- b --!>c<!--> d<?x y?>e") == "a c d e"
    assert len(text_("<p " * 20_000)) < 10 and text_("<p>" * 50_000 + "x") == "x"


def test_hostile_pages_are_read_in_linear_time():
    import time

    began = time.time()
    for page in ("<a b=\"" * 30_000, "<a '" * 30_000, "<!--" * 50_000, "<script>" * 5_000, "<a " + "b=c " * 50_000, "<" * 100_000):
        markup.plain_text(page)
        markup.nodes_of(page[:50_000])
    assert time.time() - began < 60


def test_bad_selectors(spark):
    with pytest.raises(ValueError):
        markup.steps("a:hover")

"""HTML as a table of elements with nested intervals, selectors answered over the intervals, and the text of pages.

A page is read once, in order, so that nothing inside a comment or a script is
taken for a tag. Elements are numbered as they start; ``last`` is the greatest
number inside, so that x is inside of y if y < x <= last of y.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Elements whose content is text up to their end tag, whatever it looks like; fixed by the format.
RAW = "script style textarea title xmp iframe noembed noframes".split()
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that start a line of text.
BLOCK = frozenset(
    "p div br hr li ul ol dl dt dd tr table h1 h2 h3 h4 h5 h6 section article header footer nav aside main form pre blockquote figure figcaption".split()
)
#: Elements whose text is not shown.
HIDDEN = frozenset("script style noscript template textarea title iframe noembed noframes".split())
#: A start tag ends open elements of these kinds, as far up as the nearest of the last ones.
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})), "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})), "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "tbody": (frozenset({"thead", "tbody", "tr", "td", "th"}), frozenset({"table"})), "tfoot": (frozenset({"thead", "tbody", "tr", "td", "th"}), frozenset({"table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})), "body": (frozenset({"head"}), frozenset({"html"})),
}
for _tag in BLOCK - {"br", "li", "dt", "dd", "tr"}:
    ENDS.setdefault(_tag, (frozenset({"p"}), frozenset({"div", "section", "article", "body", "td", "th", "li", "dd", "blockquote", "main", "aside", "nav", "header", "footer", "form", "figure"})))

SCAN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?P<rawattrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)>(?P<inside>.*?)(?:</(?P=raw)(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/<>][^\s=/<>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
BLANKS = re.compile(r"[ \t\r\f\v\xa0]+")
LINES = re.compile(r" ?\n[ \n]*")


def attributes(text: str) -> dict[str, str]:
    """Names, in lower case, to values; of repeated names the first counts."""
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


NESTED_HIDDEN = re.compile(r"<(noscript|template)(?=[\s/>])", re.I)
_RAW, _INSIDE, _END, _TAG = (SCAN.groupindex[g] for g in ("raw", "inside", "end", "tag"))


class _Gaps(dict):
    """What stands for a tag in a text, by its name as it is spelled."""

    def __missing__(self, name: str) -> str:
        gap = "\n" if name.lower() in BLOCK else ""
        if len(self) < 10_000:
            self[name] = gap
        return gap


_GAPS = _Gaps()


def _gap(m: re.Match) -> str:
    tag = m[_TAG]
    if tag is not None:
        return _GAPS[tag]
    raw = m[_RAW]
    return m[_INSIDE] if raw and raw.lower() not in HIDDEN else " "


def _without_nested(page: str) -> str:
    """``page`` without the elements that are not shown and may hold tags; one without an end stays."""
    out, at, hidden, depth, start = [], 0, None, 0, 0
    ends = {name: [m.end() for m in re.finditer(rf"</{name}(?=[\s/>])", page, re.I)] for name in ("noscript", "template")}
    for m in SCAN.finditer(page):
        tag = (m[_TAG] or "").lower()
        if not hidden and tag in ends and not m[_END] and ends[tag] and ends[tag][-1] > m.end():
            hidden, depth, start = tag, 1, m.start()
        elif hidden and tag == hidden:
            depth += -1 if m[_END] else 1
            if not depth:
                out += [page[at:start], " "]
                hidden, at = None, m.end()
    return "".join([*out, page[at:] if not hidden else page[at:start]])


def plain_text(page: str) -> str:
    """The visible text of a page, a line for each block. Text outside of a body, or of an element that is not closed, is text."""
    if NESTED_HIDDEN.search(page):
        page = _without_nested(page)
    return LINES.sub("\n", BLANKS.sub(" ", html.unescape(SCAN.sub(_gap, page.replace("\n", " "))))).strip()


def nodes_of(page: str) -> tuple[list[list], str]:
    """Elements as [node, last, parent, depth, tag, attributes, text_from, text_to], and the text that the last two point into."""
    found: list[list] = [[0, 0, None, 0, "#page", {}, 0, 0]]
    stack, text, size, at = [0], [], 0, 0

    def add(piece: str) -> None:
        nonlocal size
        if piece:
            piece = html.unescape(piece)
            text.append(piece)
            size += len(piece)

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = found[stack.pop()]
            node[1], node[7] = len(found) - 1, size

    for m in SCAN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = (m["raw"] or m["tag"] or "").lower()
        if not tag:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if found[stack[k]][4] == tag:
                    close(k)
                    break
            continue
        if tag in ENDS:
            ended, bounds = ENDS[tag]
            for k in range(len(stack) - 1, 0, -1):
                name = found[stack[k]][4]
                if name in bounds:
                    break
                if name in ended:
                    close(k)
        found.append([len(found), len(found), stack[-1], len(stack), tag, attributes(m["rawattrs"] or m["attrs"] or ""), size, size])
        if m["raw"]:
            inside = m["inside"]
            add(inside if tag in ("textarea", "title") else "")
            found[-1][7] = size
        elif tag not in VOID:
            stack.append(len(found) - 1)
    add(page[at:])
    close(0)
    return found, "".join(text)


NODES = "node int, last int, parent int, depth int, tag string, attrs map<string,string>, text_from int, text_to int, text string"


def nodes(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A row an element of each page: its id, node, last, parent, depth, tag, attrs, text_from and text_to.

    Node 0 stands for the page; it alone has text, all of the page's, into which the
    places of the others point. A null page has node 0 only. Pages are independent:
    nothing is shuffled.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for i in range(0, len(p), 200):
                rows = []
                for key, page in zip(p.iloc[i : i + 200, 0], p.iloc[i : i + 200, 1], strict=True):
                    found, text = nodes_of(page or "")
                    rows += [(key, *node, text if not node[0] else None) for node in found]
                yield pd.DataFrame(rows, columns=[id_col, *(c.split()[0] for c in NODES.split(", "))]).astype({"parent": "Int32"})

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, F.col(html_col).cast("string").alias(html_col)).mapInPandas(run, f"`{id_col}` {kind}, {NODES}")


SIMPLE = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:#[\w-]+|\.[\w-]+|\[[^\]]+\])*)")
PART = re.compile(r"#([\w-]+)|\.([\w-]+)|\[\s*([\w:-]+)\s*(?:([\^$*~]?=)\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]")


def steps(selector: str) -> list[tuple[str, Column]]:
    """The steps of one selector: how each is joined to the one before (`` `` or ``>``), and what holds of its elements."""
    out = []
    for joint, simple in re.findall(r"(\s*>\s*|\s+|^)([^\s>]+(?:\[[^\]]*\])?)", selector.strip()):
        m = SIMPLE.fullmatch(simple)
        if not m:
            raise ValueError(f"no selector: {simple}")
        held = F.col("tag") == m[1].lower() if m[1] and m[1] != "*" else F.col("node") > 0
        for name, kind, attr, how, value in PART.findall(m[2]):
            a = F.try_element_at(F.col("attrs"), F.lit("id" if name else "class" if kind else attr.lower()))
            words = F.concat(F.lit(" "), F.regexp_replace(a, r"\s+", " "), F.lit(" "))
            if name:
                held &= a == name
            elif kind or how == "~=":
                held &= words.contains(f" {kind or value} ")
            elif not how:
                held &= a.isNotNull()
            else:
                held &= {"=": lambda x, v: x == v, "^=": lambda x, v: x.startswith(v), "$=": lambda x, v: x.endswith(v), "*=": lambda x, v: x.contains(v)}[how](a, value)
        out.append((">" if ">" in joint else " ", F.coalesce(held, F.lit(False))))
    return out


def inside(some: DataFrame, of: DataFrame, key: str) -> DataFrame:
    """Rows of ``some`` (key, node, last, parent) inside of an element of ``of``: how far the elements that started before reach, one pass over a page."""
    both = of.select(key, "node", "last", "parent", F.lit(1).alias("_o")).union(some.select(key, "node", "last", "parent", F.lit(0)))
    before = Window.partitionBy(key).orderBy("node", "_o").rowsBetween(Window.unboundedPreceding, -1)
    reach = both.withColumn("_r", F.max(F.when(F.col("_o") == 1, F.col("last"))).over(before))
    return reach.where("_o = 0 and _r >= node").select(key, "node", "last", "parent")


def selected(found: DataFrame, selector: str, key: str = "page_id") -> DataFrame:
    """The rows of ``nodes`` that a selector names: tags, ``#id``, ``.class``, ``[attr]``, ``[attr=value]`` (also ``^= $= *= ~=``), inside of (blank), child of (``>``), one of several (``,``)."""
    out = None
    for one in selector.split(","):
        current = None
        for joint, held in steps(one):
            some = found.where(held).select(key, "node", "last", "parent")
            if current is None:
                current = some
            elif joint == ">":
                up = current.select(F.col(key).alias("_k"), F.col("node").alias("_n"))
                current = some.join(up, (F.col(key) == F.col("_k")) & (F.col("parent") == F.col("_n")), "left_semi")
            else:
                current = inside(some, current, key)
        if current is None:
            raise ValueError("an empty selector")
        out = current if out is None else out.union(current)
    at = out.select(F.col(key).alias("_k"), F.col("node").alias("_n")).distinct()
    return found.join(at, (F.col(key) == F.col("_k")) & (F.col("node") == F.col("_n")), "left_semi")


def with_text(chosen: DataFrame, found: DataFrame, key: str = "page_id") -> DataFrame:
    """Rows of ``nodes`` with their elements' own text in place of ``text``: a stretch of the page's, white space squeezed."""
    pages = found.where("node = 0").select(F.col(key).alias("_k"), F.col("text").alias("_t"))
    part = F.substring(F.col("_t"), F.col("text_from") + 1, F.col("text_to") - F.col("text_from"))
    return chosen.drop("text").join(pages, F.col(key) == F.col("_k")).withColumn("text", F.btrim(F.regexp_replace(part, r"[\s\x{a0}]+", " "))).drop("_k", "_t")


def extracted(found: DataFrame, fields: dict[str, str], key: str = "page_id") -> DataFrame:
    """A row a page: for each field the text, or with ``selector@attr`` the attribute, of the first element that a selector names; with ``name[]`` the array of all.

    Such a set of fields is what one site's pages need; pages without an element
    have null, or no items. All fields are read from one table of elements.
    """
    out = found.where("node = 0").select(key)
    for name, rule in fields.items():
        selector, _, attr = rule.partition("@")
        chosen = selected(found, selector, key)
        told = with_text(chosen, found, key).withColumn("_v", F.col("text")) if not attr else chosen.withColumn("_v", F.try_element_at(F.col("attrs"), F.lit(attr.lower())))
        told = told.select(F.col(key).alias("_k"), "node", "_v").where(F.col("_v").isNotNull())
        if name.endswith("[]"):
            name = name[:-2]
            each = told.groupBy("_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "_v"))), lambda r: r["_v"]).alias(name))  # of one page
        else:
            each = told.groupBy("_k").agg(F.min_by("_v", "node").alias(name))
        out = out.join(each, F.col(key) == F.col("_k"), "left").drop("_k")
    return out

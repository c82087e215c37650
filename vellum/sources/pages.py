"""Rows out of stored pages: titles by mark-up, headings with years, figures, links, sitemaps, listings with details.

Pages are tables of address and mark-up, however they were fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import text as X
from vellum.functions.years import parse_year
from vellum.sources.readers import SITEMAP, SOCIAL_IMAGE, page_image, pairs_by_pattern

# Mark-up that holds titles with years.
ITALIC_TITLE = r"(?i)<(?:i|em|cite)[^>]*>\s*([^<]{3,120}?)\s*</(?:i|em|cite)>\s*[,\s(]*(?:c\.?\s*)?(18\d{2}|19\d{2})(?:\s*[-–—]\s*(18\d{2}|19\d{2}))?"
LISTED_TITLE = r"(?:<li[^>]*>|>)\s*(?:<[^>]+>)*\s*([A-Z][^<>]{2,100}?),\s*(?:c\.?\s*)?(18\d{2}|19\d{2})"
HEADING = r"(?i)<h[1-4][^>]*>\s*(?:<[^>]+>)*\s*([^<]{3,100}?)\s*<"
FIGURE = r"(?is)<figure\b[^>]*>.*?<img\b[^>]*?\bsrc\s*=\s*[\"']([^\"']+)[\"'].*?<figcaption\b[^>]*>(.*?)</figcaption>"
ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
TAG = r"<[^>]+>"

#: What a file name begins with, and the source that it is from. Fixed values are the caller's.
Prefixes = list[tuple[str, str]]


def plain(markup: Column) -> Column:
    """Text of a piece of mark-up: tags dropped, white space squeezed."""
    return X.strip(X.squeeze(F.regexp_replace(markup, TAG, "")))


def titles(pages: DataFrame, html: str = "html") -> DataFrame:
    """(title, year, year_range) for each title in italics with a year or years behind it, and each listed title with a year."""

    def found(pattern: str, groups: tuple[int, ...]) -> Column:
        last = lambda m: F.nullif(m["g3"], F.lit("")) if 3 in groups else F.lit(None).cast("string")
        return F.transform(pairs_by_pattern(F.col(html), pattern, groups), lambda m: F.struct(
            plain(m["g1"]).alias("title"), m["g2"].try_cast("int").alias("year"), F.concat_ws("-", m["g2"], last(m)).alias("year_range")))

    both = F.concat(found(ITALIC_TITLE, (1, 2, 3)), found(LISTED_TITLE, (1, 2)))
    return pages.withColumn("_m", F.explode(both)).select("*", "_m.title", "_m.year", "_m.year_range").drop("_m", html)


def dated_headings(pages: DataFrame, html: str = "html") -> DataFrame:
    """(title, year, year_range) for each heading with a year of the 1900s; the title is what stands before the year."""
    heads = F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HEADING), F.lit(1)), lambda h: X.strip(X.squeeze(h)))
    d = pages.withColumn("_h", F.explode(heads)).where(F.col("_h").rlike(r"\b(19\d{2})\b"))
    d = d.withColumn("title", X.strip(F.regexp_replace("_h", r",?\s*c?\.?\s*19\d{2}.*", ""))).withColumn("_y", parse_year(F.col("_h")))
    return d.where("title <> ''").select("*", "_y.year", "_y.year_range").drop("_h", "_y", html)


def figures(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, caption) for each figure with an image and a caption."""
    return pages.withColumn("_m", F.explode(pairs_by_pattern(F.col(html), FIGURE))).select("*", F.col("_m.g1").alias("src"), plain(F.col("_m.g2")).alias("caption")).drop("_m", html)


def links(pages: DataFrame, wanted: str, html: str = "html") -> DataFrame:
    """(href, label) for each distinct link whose address or label the pattern ``wanted`` finds."""
    each = F.transform(pairs_by_pattern(F.col(html), ANCHOR), lambda m: F.struct(m["g1"].alias("href"), plain(m["g2"]).alias("label")))
    d = pages.withColumn("_m", F.explode(F.array_distinct(each))).select("*", "_m.href", "_m.label").drop("_m", html)
    return d.where(F.col("href").rlike(wanted) | F.col("label").rlike(wanted))


def sitemap(files: DataFrame, xml: str = "xml", wanted: str | None = None) -> DataFrame:
    """A row for each distinct address of a sitemap, in order of first sight (pos); entities are decoded."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(xml, F.lit("")), F.lit(SITEMAP), F.lit(1)), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&"))))
    d = files.select("*", F.posexplode(found).alias("pos", "loc")).drop(xml)
    return d if wanted is None else d.where(F.col("loc").rlike(wanted))


def source_by_prefix(name: Column, prefixes: Prefixes) -> Column:
    """The source of the first prefix that a file name has, else ``file:`` and the name."""
    out = None
    for prefix, source in prefixes:
        out = (F if out is None else out).when(name.startswith(prefix), F.lit(source))
    other = F.concat(F.lit("file:"), name)
    return other if out is None else out.otherwise(other)


def normal_url(url: Column) -> Column:
    """An address without fragment and last slashes, scheme and host in lower case: equal ones are the same page."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), r"/+$", "")
    head = F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", 0)
    return F.concat(F.lower(head), F.substring(bare, F.length(head) + 1, F.length(bare)))


def walk(pages: DataFrame, start: DataFrame, following: str, url: str = "url", html: str = "html") -> DataFrame:
    """(node, depth) of the pages reached from ``start`` (url) by links that the pattern ``following`` gives.

    A page met again, under any spelling of its address, ends the walk there.
    """
    from vellum.operators.graph import reachable

    own = pages.select(normal_url(F.col(url)).alias("u"), F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(following), F.lit(1))).alias("v"))
    edges = own.select("u", normal_url(F.col("v")).alias("v")).distinct()
    known = pages.select(normal_url(F.col(url)).alias("v")).distinct()
    return reachable(edges.join(known, "v", "left_semi").select("u", "v"), start.select(normal_url(F.col(url)).alias("node")))


def details(seeds: DataFrame, pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``seeds`` with title, year, medium, dimensions and image_url of their stored page; a seed without one has nulls."""
    heading = F.nullif(plain(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)), F.lit(""))
    body = X.strip(X.squeeze(F.regexp_replace(html, rf"(?is)<(script|style)\b.*?</\1>|{TAG}", " ")))
    found = pages.select(
        normal_url(F.col(url)).alias("_u"), heading.alias("title"), parse_year(heading)["year"].alias("year"), X.medium_in(body).alias("medium"),
        X.dimensions_in(body).alias("dimensions"), F.coalesce(F.nullif(F.regexp_extract(html, SOCIAL_IMAGE, 1), F.lit("")), page_image(F.col(html))).alias("image_url"),
        F.col(url).alias("_o"),
    )
    kept = [c for c in found.columns if c not in ("_u", "_o")]
    found = found.groupBy("_u").agg(F.min_by(F.struct(*kept), "_o").alias("_f"))
    return seeds.join(found, normal_url(F.col(url)) == F.col("_u"), "left").select(seeds["*"], "_f.*")


def cached(fetched: DataFrame, stored: DataFrame, url: str = "url", body: str = "html", least: int = 500) -> DataFrame:
    """(url, body, cached) one row an address: a stored body of over ``least`` bytes is reused, else the fetched one is taken."""
    old = stored.where(F.octet_length(body) > least).groupBy(url).agg(F.max_by(body, F.octet_length(body)).alias("_old"))
    new = fetched.groupBy(url).agg(F.max_by(body, F.octet_length(body)).alias("_new"))
    return old.join(new, url, "full").select(url, F.coalesce("_old", "_new").alias(body), F.col("_old").isNotNull().alias("cached"))


def complete_listing(listed: DataFrame, key: str, page: str = "page", order: str = "pos", full_page: int | None = None) -> DataFrame:
    """Items of a paged listing up to its first empty or short page, the first sight of each key.

    Pages are numbered from 1; a missing page is an empty one. ``full_page`` is the
    number of items of a page that has another behind it.
    """
    sizes = listed.groupBy(page).agg(F.count("*").alias("_n"))
    beyond = sizes.select((F.col(page) + 1).alias(page)).join(sizes, page, "left_anti")
    if full_page is not None:
        beyond = beyond.unionByName(sizes.where(F.col("_n") < full_page).select((F.col(page) + 1).alias(page)))
    beyond = beyond.unionByName(sizes.agg(F.when(F.min(page) > 1, 1).alias(page)))
    end = beyond.agg(F.min(page).alias("_end"))  # one row
    inside = listed.join(F.broadcast(end), F.col(page) < F.col("_end")).drop("_end")
    best = F.min_by(F.struct("*"), F.struct(page, order))
    return inside.groupBy(F.col(key).alias("_k")).agg(best.alias("_r")).select("_r.*")


#: What every search gives for a find. Fixed values.
CANDIDATE = ("engine", "query", "title", "image_url", "page_url", "width", "height")


def search_results(rows: DataFrame, engine: str, names: dict[str, str], most: int | None = None, order: str | None = None) -> DataFrame:
    """The results of a search in the common columns; ``names`` maps those to the search's own, others are null.

    ``most`` is the number of results that a query asks of the search, by ``order``.
    """
    if most is not None:
        if order is None:
            raise ValueError("a number of results needs an order")
        rank = F.row_number().over(Window.partitionBy(names["query"]).orderBy(order))
        rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= most)
    kind = lambda c: "int" if c in ("width", "height") else "string"
    value = lambda c: F.lit(engine) if c == "engine" else F.col(names[c]).cast(kind(c)) if c in names else F.lit(None).cast(kind(c))
    return rows.select(*(value(c).alias(c) for c in CANDIDATE))


def linked_images(found: DataFrame, pages: DataFrame, url: str = "page_url", html: str = "html") -> DataFrame:
    """Finds without an image get that of the page they link to, if it is stored; others stay as they are."""
    stored = pages.select(normal_url(F.col("url")).alias("_u"), page_image(F.col(html)).alias("_i")).groupBy("_u").agg(F.min("_i").alias("_i"))
    d = found.join(stored, normal_url(F.col(url)) == F.col("_u"), "left")
    return d.withColumn("image_url", F.coalesce(F.nullif("image_url", F.lit("")), "_i")).drop("_u", "_i")


def repaired_path(path: Column, prefix: str) -> Column:
    """A stored path with the folder of its collection before it, once."""
    bare = F.regexp_replace(path, r"^[./]+", "")
    return F.when(bare.startswith(prefix.rstrip("/") + "/"), bare).otherwise(F.concat(F.lit(prefix.rstrip("/") + "/"), bare))


def continued(responses: DataFrame, given: str = "given", following: str = "following") -> DataFrame:
    """The stored responses of one paged request, from the one without a token on, each token followed once."""
    from vellum.operators.graph import reachable

    start = F.coalesce(F.col(given), F.lit(""))
    edges = responses.where(F.col(following).isNotNull() & (F.col(following) != "")).select(start.alias("u"), F.col(following).alias("v")).distinct()
    first = responses.where(start == "").select(start.alias("node")).distinct()
    return responses.join(reachable(edges, first, 10_000).select(F.col("node").alias("_t")), start == F.col("_t"), "left_semi")


def allowed(urls: DataFrame, robots: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with allowed, by rows (host, path, allow) of the sites' rules: the longest path that the address begins with counts, allowance before refusal.

    An address of a site without a rule that fits is allowed, one without a host is not.
    """
    path = F.coalesce(F.nullif(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    asked = urls.select(url).distinct().select(F.col(url).alias("_u"), X.host_of(F.col(url)).alias("_h"), path.alias("_p"))
    rules = robots.where("path <> ''").select(F.lower("host").alias("_rh"), F.col("path").alias("_rp"), "allow").distinct()
    told = asked.join(rules, (F.col("_h") == F.col("_rh")) & F.col("_p").startswith(F.col("_rp")), "left")
    verdict = F.coalesce(F.max_by("allow", F.when(F.col("_rp").isNotNull(), F.struct(F.length("_rp"), F.col("allow").cast("int")))), F.lit(True))
    each = told.groupBy("_u").agg((verdict & F.max(F.col("_h").isNotNull())).alias("allowed"))
    return urls.join(each, F.col(url) == F.col("_u"), "left").select(urls["*"], F.coalesce("allowed", F.lit(False)).alias("allowed"))

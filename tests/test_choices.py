"""Choices among variants and stored pages: edge cases that the queries' tables do not hold."""

from pyspark.sql import functions as F

from vellum.operators import choice
from vellum.sources import pages


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_choices_of_nothing_and_of_equals(spark):
    none = F.array().cast("array<struct<url: string, bytes: int>>")
    assert one(spark, choice.largest(none)) is None
    assert one(spark, choice.largest(F.array(*(F.struct(F.lit(u).alias("url"), F.lit(5).alias("bytes")) for u in "ab")))) == "a"
    assert one(spark, choice.best_linked_image(F.lit(None).cast("string"))) is None
    assert one(spark, choice.best_linked_image(F.lit("'http://a/x.jpg' 'http://s3.amazonaws.com/y.JPG' 'http://b/resize/2x4/z.png'"))) == "http://s3.amazonaws.com/y.JPG"
    assert one(spark, choice.full_variant(F.array().cast("array<string>"))) is None


def test_candidates_keep_all_wanted_and_bound_the_others(spark):
    urls = F.array(*map(F.lit, ("o1", "w1", "o2", "w1", "o3", "w2")))
    assert one(spark, choice.candidate_list(urls, lambda u: u.startswith("w"), 2)) == ["w1", "w2", "o1", "o2"]


def test_guards(spark):
    rows = spark.createDataFrame([(1, None), (2, " "), (3, "Ann Bolt"), (4, "Ann Bolt junior"), (5, "Carl"), (6, "ann bolt")], "k int, c string")
    out = choice.guarded(rows, spark.createDataFrame([(6,), (6,)], "k int"), "k", F.col("c"), "(?i)ann bolt", "junior")
    assert sorted(r.k for r in out.collect()) == [1, 2, 3]


def test_larger_sizes_replace_only_smaller_ones(spark):
    rows = spark.createDataFrame([(1, 5, 5), (2, None, None), (3, 9, 1), (4, 1, 1)], "k int, width int, height int")
    found = spark.createDataFrame([(1, 7, 2), (1, 7, 3), (2, 4, 4), (3, 9, 9), (4, None, 8)], "k int, width int, height int")
    assert sorted(map(tuple, choice.larger_size(rows, found, "k").collect())) == [(1, 7, 3), (2, 4, 4), (3, 9, 1), (4, 1, 1)]


def test_listings_end_at_an_empty_or_short_page(spark):
    def keys(rows, full=None):
        return sorted(r.k for r in pages.complete_listing(spark.createDataFrame(rows, "k string, page int, pos int"), "k", full_page=full).collect())

    assert keys([("a", 1, 0), ("b", 1, 1), ("a", 2, 0), ("c", 2, 1), ("d", 4, 0)]) == ["a", "b", "c"]
    assert keys([("a", 1, 0), ("b", 1, 1), ("c", 2, 0), ("d", 3, 0)], 2) == ["a", "b", "c"]
    assert keys([("a", 2, 0)]) == []
    assert keys([]) == []


def test_walks_end_where_a_page_was_seen(spark):
    stored = spark.createDataFrame([("http://h/1", '<a href="http://H/2/">'), ("http://h/2", '<a href="http://h/1#top"><a href="http://h/gone">'), ("http://h/3", None)], "url string, html string")
    start = spark.createDataFrame([("http://h/1/",), ("http://h/3",)], "url string")
    assert sorted(map(tuple, pages.walk(stored, start, r'<a href="([^"]+)"').collect())) == [("http://h/1", 0), ("http://h/2", 1), ("http://h/3", 0)]


def test_pages_without_mark_up_give_no_rows(spark):
    d = spark.createDataFrame([(1, None), (2, ""), (3, "plain, 1920")], "k int, html string")
    for f in (pages.titles, pages.dated_headings, pages.figures):
        assert f(d).count() == 0
    assert pages.links(d, "x").count() == 0 and pages.sitemap(d, "html").count() == 0


def test_short_stored_bodies_are_fetched_again(spark):
    stored = spark.createDataFrame([("a", "x" * 600), ("b", "short"), ("c", None)], "url string, html string")
    fetched = spark.createDataFrame([("a", "new"), ("b", "fresh"), ("c", None), ("d", "d")], "url string, html string")
    assert sorted((r.url, r.html[:5] if r.html else None, r.cached) for r in pages.cached(fetched, stored).collect()) == [("a", "xxxxx", True), ("b", "fresh", False), ("c", None, False), ("d", "d", False)]


def test_rules_of_sites(spark):
    urls = spark.createDataFrame([("http://a/x/y",), ("http://a/x/z",), ("http://a",), ("http://b/x",), ("nonsense",), (None,), ("http://a/x/y",)], "url string")
    robots = spark.createDataFrame([("A", "/x", False), ("a", "/x/y", True), ("a", "/x/y", False), ("a", "", False)], "host string, path string, allow boolean")
    got = sorted(((r.url or "", r.allowed) for r in pages.allowed(urls, robots).collect()))
    assert got == [("", False), ("http://a", True), ("http://a/x/y", True), ("http://a/x/y", True), ("http://a/x/z", False), ("http://b/x", True), ("nonsense", False)]


def test_tokens_are_followed_once(spark):
    d = spark.createDataFrame([(1, None, "a"), (2, "a", "b"), (3, "b", "a"), (4, "c", None)], "k int, given string, following string")
    assert sorted(r.k for r in pages.continued(d).collect()) == [1, 2, 3]
    assert pages.continued(d.where("k = 4")).count() == 0

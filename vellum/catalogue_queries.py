"""Queries over the shared tables: each operator of the engine applied to whole tables, with SQL that says the same.

Records, works, items and images are derived from the star schema: parts are
works, order lines are sightings of them, events are records by source and key.
A query without SQL is one that SQL cannot express; tests hold it to brute force.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import fuzzy, vision
from vellum.functions import text as X
from vellum.functions import years as Y
from vellum.operators import browse, catalogue, features, graph, layout, link, merge, records, retrieve, rules
from vellum.scratch import scratch_dir, tune
from vellum.sources import readers, sinks
from vellum.streaming import upsert as streaming

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable], Query]:
    """Register a function of a table reader as a query, with its SQL."""

    def add(f: Callable) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run

    return add


def queries() -> dict[str, Query]:
    import vellum.function_queries  # noqa: F401  registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    import vellum.function_queries  # noqa: F401

    return dict(_SQL)


# Shared derivations, in both languages.


def parts_as_works(t) -> DataFrame:
    p = t("part")
    year = F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(1904 + F.col("p_partkey") % 67).cast("int")
    return p.select(
        F.concat_ws(" ", "p_name", F.lower("p_type"), F.lower(F.translate("p_brand", "#", " "))).alias("title"), year.alias("year"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).alias("collection"), F.when(F.col("p_partkey") % 4 == 0, F.col("p_partkey").cast("string")).alias("inventory_no"),
        F.array(F.concat(F.lit("http://a/"), (F.col("p_partkey") % 7).cast("string")), F.concat(F.lit("http://b/"), (F.col("p_partkey") % 3).cast("string"))).alias("sources"),
        F.col("p_type").alias("medium"), F.col("p_partkey").alias("ord"),
    )


WORKS = """works AS (
  SELECT p_name || ' ' || lower(p_type) || ' ' || lower(replace(p_brand, '#', ' ')) AS title,
         CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 1904 + p_partkey % 67 END AS year,
         CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS collection,
         CASE WHEN p_partkey % 4 = 0 THEN p_partkey::VARCHAR END AS inventory_no,
         ['http://a/' || (p_partkey % 7), 'http://b/' || (p_partkey % 3)] AS sources,
         p_type AS medium, p_partkey AS ord
  FROM part)"""


def events_as_records(t) -> DataFrame:
    e = t("events")
    text = lambda n, k: F.when(F.col("event_id") % n == k, F.concat(F.lit(f"t{k}-"), (F.col("event_id") % 11).cast("string")))
    return e.select(
        F.col("event_id").alias("_ord"), F.col("user_id").alias("component"), F.col("event_type").alias("_group"), F.concat(F.lit("k"), F.col("event_id").cast("string")).alias("key"),
        F.coalesce(text(3, 0), F.when(F.col("event_id") % 3 == 1, F.lit(""))).alias("title"), F.when(F.col("event_id") % 4 == 0, F.year("ts")).alias("year"),
        text(5, 2).alias("medium"), text(7, 3).alias("collection"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("source"),
        F.concat(F.lit("/p/"), F.col("event_id").cast("string")).alias("local_path"), F.lit(None).cast("string").alias("image_url"), F.lit(None).cast("string").alias("sha256"),
        (F.col("event_id") % 50).cast("int").alias("width"), (F.col("event_id") % 40).cast("int").alias("height"),
        F.when(F.col("event_id") % 6 == 0, F.concat(F.lit("http://x/"), (F.col("event_id") % 9).cast("string"))).alias("page_url"),
        F.when(F.col("event_id") % 97 == 0, "high").when(F.col("event_id") % 2 == 0, "medium").alias("confidence"), text(13, 5).alias("notes"),
    )


RECORDS = """records AS (
  SELECT event_id AS _ord, user_id AS component, event_type AS _group, 'k' || event_id AS key,
         CASE event_id % 3 WHEN 0 THEN 't0-' || (event_id % 11) WHEN 1 THEN '' END AS title,
         CASE WHEN event_id % 4 = 0 THEN year(ts)::INT END AS year,
         CASE WHEN event_id % 5 = 2 THEN 't2-' || (event_id % 11) END AS medium,
         CASE WHEN event_id % 7 = 3 THEN 't3-' || (event_id % 11) END AS collection,
         CASE WHEN event_id % 2 = 0 THEN event_type END AS source,
         '/p/' || event_id AS local_path, (event_id % 50)::INT AS width, (event_id % 40)::INT AS height,
         CASE WHEN event_id % 6 = 0 THEN 'http://x/' || (event_id % 9) END AS page_url,
         CASE WHEN event_id % 97 = 0 THEN 'high' WHEN event_id % 2 = 0 THEN 'medium' END AS confidence,
         CASE WHEN event_id % 13 = 5 THEN 't5-' || (event_id % 11) END AS notes
  FROM events)"""


def events_as_images(t) -> DataFrame:
    return t("events").select(
        F.format_string("i%d", "event_id").alias("item_id"), F.when(F.col("event_id") % 4 != 0, F.format_string("w%d", F.col("event_id") * 7 % 300)).alias("work_id"),
        F.md5(F.col("user_id").cast("string")).alias("sha"), F.floor(F.col("value") * 10).cast("long").alias("pixels"), (F.col("event_id") % 7).cast("int").alias("rank"), F.col("event_id").alias("ord"),
        "event_id", "user_id", "event_type",
    )


IMAGES = """images AS (
  SELECT 'i' || event_id AS item_id, CASE WHEN event_id % 4 <> 0 THEN 'w' || (event_id * 7 % 300) END AS work_id, md5(user_id::VARCHAR) AS sha,
         floor(value * 10)::BIGINT AS pixels, (event_id % 7)::INT AS rank, event_id AS ord
  FROM events)"""


# Sources and sinks


@query("s1_last_line_per_key", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def _(t):
    return records.last_per_key(t("events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id")


@query("s2_union_with_group", "SELECT c_name AS name, c_acctbal AS balance, 'customer' AS _group, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, 'supplier', NULL FROM supplier")
def _(t):
    c = t("customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("_group"), F.col("c_mktsegment").alias("segment"))
    return records.union_records(c, t("supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("_group")))


@query("s5_script_assignment", "SELECT n_nationkey AS id, n_name AS name FROM nation")
def _(t):
    rows = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    script = rows.agg(F.collect_list(F.struct("id", "name")).alias("items")).select(sinks.assignment("DATA", F.struct("items")).alias("script"))
    return script.select(F.inline(F.from_json(readers.assigned_json(F.col("script")), "struct<items: array<struct<id: int, name: string>>>")["items"]))


@query("s6_nested_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    return t("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("s8_html_links", """SELECT page_id, len(list_distinct(regexp_extract_all(html, '<a href="([^"]+)"', 1))) AS links FROM pages""")
def _(t):
    found = readers.html_values(t("pages").select("page_id", "html"), "href", r'<a href="([^"]+)"').groupBy("page_id").agg(F.count("*").alias("links"))
    return t("pages").select("page_id").join(found, "page_id", "left").select("page_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


@query("s9_html_headings", """SELECT page_id, unnest(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1)) AS heading FROM pages""")
def _(t):
    return t("pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r"<h1>([^<]*)</h1>"), F.lit(1))).alias("heading"))


@query("s18_recursive_traversal", """WITH RECURSIVE edges AS (
  SELECT 'r' || n_regionkey AS u, 'n' || n_nationkey AS v FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey FROM customer),
reach(node, depth) AS (SELECT 'r1', 0 UNION SELECT e.v, depth + 1 FROM reach JOIN edges e ON e.u = reach.node)
SELECT node, min(depth)::INT AS depth FROM reach GROUP BY node""")
def _(t):
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    edges = t("nation").select(key("r", "n_regionkey").alias("u"), key("n", "n_nationkey").alias("v")).union(t("customer").select(key("n", "c_nationkey"), key("c", "c_custkey")))
    roots = t("region").where("r_regionkey = 1").select(key("r", "r_regionkey").alias("node"))
    return graph.reachable(edges, roots)


@query("s19_batches_of_ids", "SELECT batch, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY c_custkey) - 1) // 40 AS batch FROM customer) GROUP BY batch")
def _(t):
    return records.chunked(t("customer").select("c_custkey"), ["c_custkey"], 40).groupBy("batch").agg(F.count("*").alias("n"))


@query("s20_graph_pattern", """SELECT 'c' || c_custkey AS subject, c_name AS name, c_mktsegment AS segment, CASE WHEN c_acctbal > 5000 THEN c_acctbal::VARCHAR END AS balance
FROM customer WHERE c_nationkey < 20""")
def _(t):
    c = t("customer").withColumn("s", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    triple = lambda d, p, o: d.select("s", F.lit(p).alias("p"), F.col(o).cast("string").alias("o"))
    triples = triple(c.where("c_nationkey < 20"), "name", "c_name").union(triple(c, "segment", "c_mktsegment")).union(triple(c.where("c_acctbal > 5000"), "balance", "c_acctbal"))
    return readers.graph_pattern(triples, {"name": "name", "segment": "segment"}, {"balance": "balance"})


@query("s27_base64_blobs", "SELECT c_custkey, octet_length(encode(c_name)) AS bytes, sha256(c_name) AS sha256 FROM customer")
def _(t):
    return readers.blobs(t("customer").select("c_custkey", F.base64(F.col("c_name").cast("binary")).alias("data"))).select("c_custkey", F.col("bytes").cast("long").alias("bytes"), "sha256")


@query("s33_salvaged_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def _(t):
    dirty = F.concat(F.lit("junk "), F.col("props"), F.lit(" trailer"))
    return t("events").select("event_id", F.from_json(readers.salvage_json(dirty), "k long")["k"].alias("k"))


@query("k3_flattened_arrays", "SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_partkey)), ';') AS parts FROM lineitem GROUP BY l_orderkey")
def _(t):
    d = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("parts"))
    return sinks.flat(d.withColumn("parts", F.col("parts").cast("array<string>")))


@query("k9_content_names", "SELECT doc_id, substr(sha256(text), 1, 16) || '.webp' AS name FROM documents")
def _(t):
    return t("documents").select("doc_id", sinks.content_name(F.sha2("text", 256)).alias("name"))


# Projections and rules


@query("p2_padded_records", "SELECT p_partkey::VARCHAR AS key, p_name AS title, NULL::INT AS year, 'medium' AS confidence FROM part")
def _(t):
    return records.padded(t("part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("title"))).select("key", "title", "year", "confidence")


@query("p4_parted_rows", "SELECT CASE WHEN p_size >= 20 AND p_type <> 'SMALL' THEN 'kept' ELSE 'other' END AS side, count(*) AS n FROM part GROUP BY 1")
def _(t):
    kept, other = records.parted(t("part"), (F.col("p_size") >= 20) & (F.col("p_type") != "SMALL"))
    return kept.select(F.lit("kept").alias("side")).union(other.select(F.lit("other"))).groupBy("side").agg(F.count("*").alias("n"))


@query("p8_work_rules")
def _(t):
    d = parts_as_works(t).withColumn("confidence", F.when(F.col("ord") % 9 == 0, "low"))
    return rules.works(d).select("ord", F.col("_t").alias("cleaned"), "reason")


@query("p7_plausible_titles", r"""SELECT doc_id, pos, length(t) BETWEEN 3 AND 140 AND NOT (spaces > 14 AND (contains(t, ',') OR t LIKE '%.')) AND NOT regexp_matches(t, '(^|[^\pL\pN_])(was|were|born|died|lived|moved|became)($|[^\pL\pN_])', 'i') AND NOT regexp_matches(t, 'll\.?\s*d\.?', 'i') AS plausible
FROM (SELECT doc_id, pos, t, length(t) - length(replace(t, ' ', '')) AS spaces FROM (
  SELECT doc_id, pos, rtrim(trim(regexp_replace(trim(line), '\s+', ' ', 'g'), ' .,-;:"'''), '~') AS t FROM (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l)))::INT AS pos FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))))""")
def _(t):
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", rules.plausible_title(F.col("line")).alias("plausible"))


@query("p14_confidence", """SELECT p_partkey, CASE WHEN h LIKE '%ebay%' THEN 'low' WHEN p_name <> '' AND y <> 0 AND n THEN 'high' WHEN p_name <> '' AND (y <> 0 OR n) THEN 'medium' ELSE 'low' END AS confidence
FROM (SELECT p_partkey, p_name, p_size % 3 AS y, p_size % 2 = 0 AS n, CASE WHEN p_partkey % 10 = 0 THEN 'www.ebay.com' ELSE 'x.org' END AS h FROM part)""")
def _(t):
    host = F.when(F.col("p_partkey") % 10 == 0, "www.ebay.com").otherwise("x.org")
    return t("part").select("p_partkey", rules.confidence(F.col("p_name"), F.col("p_size") % 3, F.col("p_size") % 2 == 0, host).alias("confidence"))


@query("p16_scrubbed_years", "SELECT p_partkey, CASE WHEN y BETWEEN 1900 AND 1970 THEN y END AS year FROM (SELECT p_partkey, (1880 + p_partkey % 120)::INT AS y FROM part)")
def _(t):
    return t("part").select("p_partkey", Y.scrub_year((1880 + F.col("p_partkey") % 120).cast("int")).alias("year"))


@query("p17_collection_names", """SELECT c_custkey, CASE WHEN lower(c) IN ('flickr', 'unknown', 'n/a') THEN NULL WHEN lower(c) = 'private' THEN 'private collection' ELSE c END AS collection
FROM (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Private' ELSE c_mktsegment END AS c FROM customer)""")
def _(t):
    c = F.when(F.col("c_custkey") % 4 == 0, "Unknown").when(F.col("c_custkey") % 4 == 1, "Private").otherwise(F.col("c_mktsegment"))
    return t("customer").select("c_custkey", rules.collection_name(c).alias("collection"))


@query("p18_search", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name || ' ' || p_brand || ' ' || p_type), 'bolt brand#1')")
def _(t):
    return browse.search(t("part"), " Bolt BRAND#1 ", "p_name", "p_brand", "p_type").select("p_partkey", "p_name")


@query("p23_source_labels", """SELECT n, label, rank FROM (VALUES (0, 'Museum', 1), (1, 'Commons', 3), (2, 'pics.com', 50), (3, 'Folder', 50), (4, 'Web', 50)) v(n, label, rank)
JOIN (SELECT DISTINCT n_nationkey % 5 AS n FROM nation) USING (n)""")
def _(t):
    paths = F.array(*map(F.lit, ("swarm/intl_museums/a.jpg", "commons_deep/b.jpg", "web_search/pics-com/c.jpg", "d.jpg", "web_search/e.jpg")))
    d = t("nation").select((F.col("n_nationkey") % 5).alias("n")).distinct().withColumn("label", rules.source_of(F.get(paths, F.col("n"))))
    return d.withColumn("rank", rules.source_rank(F.col("label")))


# Joins


@query("j1_left_join_by_path", "SELECT l_orderkey, l_linenumber, p_name FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size > 25) ON l_partkey = p_partkey")
def _(t):
    return t("lineitem").join(t("part").where("p_size > 25"), F.col("l_partkey") == F.col("p_partkey"), "left").select("l_orderkey", "l_linenumber", "p_name")


@query("j2_link_items_to_works")
def _(t):
    works = parts_as_works(t).select(F.col("ord").alias("work_id"), X.norm(F.col("title")).alias("norm"), "year", "ord")
    seen = t("lineitem").select("l_partkey", (F.col("l_suppkey") % 3).alias("v")).distinct().join(works.withColumnRenamed("work_id", "l_partkey"), "l_partkey")
    typo = F.when(F.col("v") == 0, F.col("norm")).when(F.col("v") == 1, F.regexp_replace("norm", "ll", "l")).otherwise(F.concat("norm", F.lit("s")))
    year = F.when(F.col("v") == 0, F.col("year")).when(F.col("v") == 1, F.col("year") + 1)
    items = seen.select(F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("v").cast("string")).alias("item_id"), typo.alias("norm"), year.cast("int").alias("year"))
    return link.link(items, works)


_BITS = """bits AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS b FROM embeddings),
pairs AS (SELECT a.vec_id AS u, b.vec_id AS v FROM bits a JOIN bits b ON a.vec_id < b.vec_id
  WHERE list_sum(list_transform(list_zip(a.b, b.b), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) <= 15)"""


def signs(t) -> DataFrame:
    bit = lambda x, i: F.shiftleft(F.when(x > 0, 1).otherwise(0).cast("long"), i)
    from functools import reduce

    h = reduce(lambda a, b: a.bitwiseOR(b), (bit(F.get("embedding", F.lit(i)), i) for i in range(64)))
    return t("embeddings").select("vec_id", h.alias("h"))


@query("j3_hash_band_join", f"WITH {_BITS} SELECT u, v FROM pairs")
def _(t):
    return graph.hash_edges(signs(t), "vec_id", "h", 15, residual=F.lit(True))


@query("j4_digest_edges", "SELECT d.doc_id AS u, g.v FROM documents d JOIN (SELECT text, min(doc_id) AS v FROM documents GROUP BY text) g USING (text) WHERE d.doc_id <> g.v")
def _(t):
    return graph.digest_edges(t("documents").select("doc_id", F.sha2("text", 256).alias("d")), "doc_id", "d")


@query("j5_suggestions")
def _(t):
    works = parts_as_works(t).select("title", "year", "collection", "ord")
    asked = t("nation").select(F.col("n_name").alias("key"), F.when(F.col("n_nationkey") % 3 == 0, "small ring").alias("title"), F.lit("a/red-widget.jpg").alias("local_path"), F.lit("unlabelled").alias("label_status"))
    return link.suggestions(asked, works, 50.0)


@query("j6_fuzzy_lookup")
def _(t):
    works = parts_as_works(t).select(F.col("ord").alias("work_id"), "title", "year", F.array().cast("array<string>").alias("alt_titles"), "ord")
    asked = t("nation").select(F.col("n_nationkey").alias("query_id"), F.concat(F.lit("small ring brand "), F.col("n_nationkey").cast("string")).alias("text"), (1900 + F.col("n_nationkey")).alias("year"))
    return link.lookup(asked, works)


def asked_parts(t) -> DataFrame:
    """Every part whose key is divisible by 20, as someone might ask for it: brand first, a letter short, words turned round."""
    n = F.col("p_partkey") / 20
    words = F.split("p_name", " ")
    text = F.when(n % 3 == 0, F.concat_ws(" ", F.lower(F.translate("p_brand", "#", " ")), "p_name")).when(n % 3 == 1, F.concat_ws(" ", F.element_at(words, -1), F.substring(F.element_at(words, 1), 2, 40), F.lower("p_type"))).otherwise(F.concat_ws(" ", "p_name", "p_name", F.lower("p_brand")))
    return t("part").where(F.col("p_partkey") % 20 == 0).select(F.col("p_partkey").alias("query_id"), text.alias("text"), (1900 + F.col("p_partkey") % 80).cast("int").alias("year"))


def best_parts(t, scorer: str, cutoff: float, limit: int) -> DataFrame:
    works = parts_as_works(t).select(F.col("title").alias("choice"), "ord")
    return retrieve.best_options(asked_parts(t), works, scorer, cutoff, limit).select("query_id", "choice", "choice_ord", F.round("score", 6).alias("score"), "rank")


@query("z2_best_token_sets")
def _(t):
    return best_parts(t, "token_set", 60.0, 3)


@query("z3_best_weighted")
def _(t):
    return best_parts(t, "weighted", 55.0, 20)


@query("z4_best_ratios")
def _(t):
    return best_parts(t, "ratio", 0.0, 5)


@query("z4_best_token_sorts")
def _(t):
    return best_parts(t, "token_sort", 70.0, 5)


@query("j6_lookup_of_parts")
def _(t):
    works = parts_as_works(t).select(F.col("ord").alias("work_id"), "title", "year", F.array(F.col("medium")).alias("alt_titles"), "ord")
    return link.lookup(asked_parts(t), works)


@query("j7_fold_undated", f"""WITH {WORKS}, m AS (SELECT title AS norm, year, collection, ord, sources FROM works WHERE ord < 2000000),
t AS (SELECT norm, count(*) AS n, min(ord) AS twin FROM m WHERE year IS NOT NULL GROUP BY norm),
f AS (SELECT m.*, t.twin FROM m LEFT JOIN t USING (norm) WHERE year IS NULL AND collection IS NULL AND n = 1)
SELECT ord, norm, year, array_to_string(list_sort(CASE WHEN len(more) > 0 THEN list_distinct(list_concat(sources, more)) ELSE sources END), ' ') AS sources
FROM (SELECT m.*, coalesce((SELECT flatten(list(f.sources)) FROM f WHERE f.twin = m.ord), []) AS more FROM m WHERE ord NOT IN (SELECT ord FROM f))""")
def _(t):
    w = parts_as_works(t).withColumnRenamed("title", "norm")
    out = catalogue.fold_undated(w.select("norm", F.col("year").cast("long").alias("year"), "collection", "sources", "ord"), 100)
    return out.select("ord", "norm", "year", F.array_join(F.array_sort("sources"), " ").alias("sources"))


@query("j9_folded_index")
def _(t):
    w = parts_as_works(t)
    key = X.title_key(F.col("title"))
    rows = w.select(
        X.norm_title(F.col("title")).alias("title"), key.alias("title_key"), F.array().cast("array<string>").alias("alt_titles"), F.array().cast("array<string>").alias("alt_keys"), "year",
        F.col("year").cast("string").alias("year_range"), "medium", F.lit(None).cast("string").alias("dimensions"), "collection", "inventory_no", F.lit(None).cast("string").alias("wikidata_id"),
        "sources", F.lit("medium").alias("confidence"), F.lit(None).cast("string").alias("notes"), "ord",
    )
    return catalogue.fold_index(rows)


@query("j12_works_with_images", f"""WITH {IMAGES}, p AS (SELECT *, row_number() OVER (PARTITION BY coalesce(work_id, 'sha:' || sha) ORDER BY pixels DESC, rank, ord) = 1 AS prim FROM images)
SELECT 'w' || p_partkey AS id, CASE WHEN item_id IS NULL THEN 'missing' ELSE 'have' END AS status, coalesce(item_id, '') AS images
FROM part LEFT JOIN p ON p.work_id = 'w' || p_partkey AND p.prim""")
def _(t):
    works = t("part").select(F.format_string("w%d", "p_partkey").alias("id"))
    return catalogue.assemble(works, catalogue.with_primary(events_as_images(t))).select("id", "status", F.array_join("images", " ").alias("images"))


@query("j13_reconciled_listing", """SELECT o_orderkey, coalesce(a.c_acctbal, b.acctbal) AS matched_balance FROM orders
LEFT JOIN (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 = 0) a ON o_custkey = a.c_custkey
LEFT JOIN (SELECT c_nationkey, arg_min(c_acctbal, c_custkey) AS acctbal FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1) b ON o_custkey % 25 = b.c_nationkey""")
def _(t):
    left = t("orders").select("o_orderkey", F.col("o_custkey").alias("cust"), (F.col("o_custkey") % 25).cast("int").alias("nation"))
    right = t("customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("cust"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").alias("o"))
    return records.reconcile(left, right, [["cust"], ["nation"]], "o", ["balance"]).select("o_orderkey", "matched_balance")


@query("j14_listing_differences", """SELECT 'only_ordered' AS side, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 2 = 0) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'never_ordered', count(*) FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 2 = 0)""")
def _(t):
    a, b = t("orders").where("o_custkey % 2 = 0").select(F.col("o_custkey").alias("k")), t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    count = lambda d, n: d.agg(F.lit(n).alias("side"), F.count("*").alias("n"))
    return count(a.distinct().join(b, "k", "left_anti"), "only_ordered").union(count(b.join(a, "k", "left_anti"), "never_ordered"))


@query("j18_box_overlaps", """WITH b AS (SELECT p_partkey AS id, (p_partkey % 97) * 10.0 AS x, (p_partkey % 89) * 10.0 AS y, p_size::DOUBLE AS w, p_size::DOUBLE AS h, p_brand AS g FROM part)
SELECT a.g AS "group", a.id AS a, b.id AS b FROM b a JOIN b ON a.g = b.g AND a.id < b.id AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h""")
def _(t):
    size = F.col("p_size").cast("double")
    boxes = t("part").select(F.col("p_brand").alias("group"), F.col("p_partkey").alias("id"), (F.col("p_partkey") % 97 * 10.0).alias("x"), (F.col("p_partkey") % 89 * 10.0).alias("y"), size.alias("w"), size.alias("h"))
    return layout.overlaps(boxes, 64.0)


@query("j20_choice_map", """SELECT choice, arg_max(p_partkey, p_partkey) AS work_id FROM (SELECT p_name AS choice, p_partkey FROM part UNION ALL SELECT p_brand, p_partkey FROM part) GROUP BY choice""")
def _(t):
    w = t("part").select(F.col("p_partkey").alias("work_id"), F.col("p_name").alias("title"), F.array("p_brand").alias("alt_titles"), F.col("p_size").alias("year"), F.col("p_partkey").alias("ord"))
    return link.choices(w).select("choice", "work_id")


# Aggregations


@query("a2_largest_row", "SELECT l_orderkey, arg_max(l_linenumber, (l_extendedprice, -l_linenumber)) AS line, max(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey")
def _(t):
    best = F.max_by(F.struct("l_linenumber", "l_extendedprice"), F.struct(F.col("l_extendedprice"), -F.col("l_linenumber")))
    return t("lineitem").groupBy("l_orderkey").agg(best.alias("b")).select("l_orderkey", F.col("b.l_linenumber").alias("line"), F.col("b.l_extendedprice").alias("price"))


_DONOR = "(list_position(['purchase', 'click', 'view'], _group), -rich, _ord)"


@query("a3_survivorship", f"""WITH {RECORDS}, r AS (SELECT *, coalesce(list_position(['purchase', 'click', 'view'], _group), 0) AS lp,
  (coalesce(title, '') <> '')::INT + (coalesce(year, 0) <> 0)::INT + (coalesce(medium, '') <> '')::INT + (coalesce(collection, '') <> '')::INT AS rich FROM records),
d AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY CASE WHEN lp > 0 THEN lp - 1 ELSE 3 END, -rich, _ord) AS donor FROM r),
b AS (SELECT component, arg_max(local_path, (width::BIGINT * height, -_ord)) AS local_path FROM d GROUP BY component)
SELECT d.component, b.local_path,
  arg_min(title, donor) FILTER (title <> '') AS title, arg_min(year, donor) FILTER (year <> 0) AS year, arg_min(medium, donor) FILTER (medium <> '') AS medium,
  arg_min(collection, donor) FILTER (collection <> '') AS collection,
  CASE WHEN bool_or(coalesce(confidence = 'high', false)) THEN 'high' ELSE coalesce(first(confidence ORDER BY _ord), 'low') END AS confidence,
  array_to_string(list_sort(list(DISTINCT coalesce(source, _group))), ',') AS sources,
  coalesce(array_to_string(list_sort(list(DISTINCT page_url) FILTER (page_url IS NOT NULL)), ','), '') AS page_urls,
  len(list(d.local_path) FILTER (d.local_path <> b.local_path)) AS duplicates, string_agg(DISTINCT notes, ' | ' ORDER BY notes) AS notes, count(*) AS members,
  CASE WHEN count(*) FILTER (title <> '') > 0 THEN CASE WHEN count(*) FILTER (year <> 0) > 0 THEN 'labelled' ELSE 'title_only' END ELSE 'unlabelled' END AS label_status
FROM d JOIN b USING (component) GROUP BY d.component, b.local_path""")
def _(t):
    out = merge.survivors(events_as_records(t), "component", ["purchase", "click", "view"])
    return out.select(
        "component", "local_path", "title", "year", "medium", "collection", "confidence", F.array_join("sources", ",").alias("sources"), F.array_join("page_urls", ",").alias("page_urls"),
        F.size("duplicates").cast("long").alias("duplicates"), "notes", "members", "label_status",
    )


@query("a9_merged_works", f"""WITH {WORKS}, k AS (SELECT *, trim(regexp_replace(coalesce(lower(collection), ''), '[^a-z0-9]+', ' ', 'g')) AS c FROM works)
SELECT title AS norm, min(ord) AS ord, arg_min(collection, ord) AS collection, arg_min(inventory_no, ord) FILTER (inventory_no IS NOT NULL) AS inventory_no, count(*) AS n FROM k GROUP BY title, year, c""")
def _(t):
    w = parts_as_works(t).withColumn("norm", F.col("title"))
    n = w.groupBy("norm", F.coalesce("year", F.lit(0)).alias("y"), F.coalesce("collection", F.lit("")).alias("c")).agg(F.count("*").alias("n"))
    out = catalogue.merge_works(w)
    on = (out.norm == n.norm) & (F.coalesce(out.year, F.lit(0)) == n.y) & (F.coalesce(out.collection, F.lit("")) == n.c)
    return out.join(n, on).select(out.norm, "ord", "collection", "inventory_no", "n")


@query("a10_extra_works", """SELECT p_name AS norm, (1904 + user_id % 5)::INT AS year, arg_min(event_type, event_id) FILTER (user_id % 2 = 0) AS collection, count(*) AS images
FROM events JOIN part ON p_partkey = event_id % 200 WHERE event_id % 4 = 0 GROUP BY p_name, 1904 + user_id % 5""")
def _(t):
    d = events_as_images(t).join(t("part"), F.col("p_partkey") == F.col("event_id") % 200).select(
        "item_id", F.col("p_name").alias("title"), (1904 + F.col("user_id") % 5).cast("int").alias("year"), F.lit(None).cast("string").alias("medium"),
        F.when(F.col("user_id") % 2 == 0, F.col("event_type")).alias("collection"), F.lit("Museum").alias("source"), "sha", "work_id", "ord",
    )
    return catalogue.extra_works(d).select("norm", "year", "collection", F.size("image_ids").cast("long").alias("images"))


@query("a11_catalogue_counts", f"""WITH {IMAGES}, p AS (SELECT *, row_number() OVER (PARTITION BY coalesce(work_id, 'sha:' || sha) ORDER BY pixels DESC, rank, ord) = 1 AS prim FROM images),
w AS (SELECT p_partkey % 10 = 1 AS extra, 'w' || p_partkey IN (SELECT work_id FROM p WHERE work_id IS NOT NULL) AS have FROM part)
SELECT (SELECT count(*) FROM w WHERE have AND NOT extra) AS have, (SELECT count(*) FROM w WHERE NOT have AND NOT extra) AS missing, (SELECT count(*) FROM w WHERE extra) AS extra,
  count(*) AS images, count(*) FILTER (prim) AS "primary", count(*) FILTER (work_id IS NULL) AS unidentified FROM p""")
def _(t):
    images = catalogue.with_primary(events_as_images(t))
    works = catalogue.assemble(t("part").select(F.format_string("w%d", "p_partkey").alias("id"), (F.col("p_partkey") % 10 == 1).alias("extra")), images)
    return catalogue.catalogue_counts(works, images)


@query("a12_counts_by_source", f"WITH {RECORDS} SELECT source, count(*) AS n FROM (SELECT DISTINCT component, coalesce(source, _group) AS source FROM records) GROUP BY source")
def _(t):
    return merge.counts_by_source(merge.survivors(events_as_records(t), "component", []))


@query("a14_counts_by_family", """SELECT CASE WHEN contains(lower(url), '.org') THEN 'org' WHEN contains(lower(url), 'page=') THEN 'paged' WHEN contains(lower(url), '/en/') THEN 'english' ELSE 'other' END AS family, count(*) AS n FROM pages GROUP BY 1""")
def _(t):
    fam = rules.family_of(F.col("url"), [("org", ".org"), ("paged", "page="), ("english", "/en/")])
    return t("pages").groupBy(fam.alias("family")).agg(F.count("*").alias("n"))


@query("a15_report", f"""WITH {RECORDS}, m AS (SELECT component, count(*) FILTER (title <> '') > 0 AS t, count(*) FILTER (year <> 0) > 0 AS y, count(*) FILTER (collection <> '') > 0 AS c FROM records GROUP BY component)
SELECT count(*) AS total, round(100.0 * count(*) FILTER (y) / greatest(count(*), 1), 1)::DOUBLE AS pct_year, round(100.0 * count(*) FILTER (c) / greatest(count(*), 1), 1)::DOUBLE AS pct_collection,
 count(*) FILTER (t AND y) AS labelled, count(*) FILTER (t AND NOT y) AS title_only, count(*) FILTER (NOT t) AS unlabelled FROM m""")
def _(t):
    out = merge.report(merge.survivors(events_as_records(t), "component", []))
    return out.withColumns({c: F.col(c).cast("double") for c in ("pct_year", "pct_collection")})


@query("a16_group_means", "SELECT label, count(*) AS n, round(avg(embedding[1]), 6) AS m0, round(avg(embedding[2]), 6) AS m1 FROM embeddings GROUP BY label")
def _(t):
    return t("embeddings").groupBy("label").agg(F.count("*").alias("n"), *(F.round(F.avg(F.get("embedding", F.lit(i)).cast("double")), 6).alias(f"m{i}") for i in (0, 1)))


@query("a17_min_max_scaling", """SELECT s_suppkey, round((s_acctbal - lo) / (hi - lo + 1e-9), 6) AS s_acctbal
FROM (SELECT *, min(s_acctbal) OVER (PARTITION BY s_nationkey) AS lo, max(s_acctbal) OVER (PARTITION BY s_nationkey) AS hi FROM supplier)""")
def _(t):
    return features.spread(t("supplier"), ["s_acctbal"], "s_nationkey").select("s_suppkey", F.round("s_acctbal", 6).alias("s_acctbal"))


_RGB = "SELECT vec_id, least(1.0, abs(embedding[1]::DOUBLE) * 3) AS r, least(1.0, abs(embedding[2]::DOUBLE) * 3) AS g, least(1.0, abs(embedding[3]::DOUBLE) * 3) AS b, label FROM embeddings"
_LAB = f"""rgb AS ({_RGB}), lin AS (SELECT vec_id, label, list_transform([r, g, b], lambda c: CASE WHEN c <= 0.04045 THEN c / 12.92 ELSE pow((c + 0.055) / 1.055, 2.4) END) AS c FROM rgb),
xyz AS (SELECT vec_id, label, list_transform([(0.4124564 * c[1] + 0.3575761 * c[2] + 0.1804375 * c[3]) / 0.95047, 0.2126729 * c[1] + 0.7151522 * c[2] + 0.0721750 * c[3], (0.0193339 * c[1] + 0.1191920 * c[2] + 0.9503041 * c[3]) / 1.08883],
  lambda t: CASE WHEN t > pow(6 / 29, 3) THEN cbrt(t) ELSE t / (3 * pow(6 / 29, 2)) + 4 / 29 END) AS f FROM lin),
lab AS (SELECT vec_id, label, 116 * f[2] - 16 AS L, 500 * (f[1] - f[2]) AS A, 200 * (f[2] - f[3]) AS B FROM xyz)"""


def colours(t) -> DataFrame:
    c = lambda i: F.least(F.lit(1.0), F.abs(F.get("embedding", F.lit(i)).cast("double")) * 3)
    d = t("embeddings").select("vec_id", "label", c(0).alias("r"), c(1).alias("g"), c(2).alias("bl"))
    return d.withColumn("lab", vision.srgb_to_lab(F.col("r"), F.col("g"), F.col("bl"))).select("vec_id", "label", "r", "g", "bl", "lab.*")


@query("m1_lab_colours", f"WITH {_LAB} SELECT vec_id, round(L, 4) AS light, round(A, 4) AS red_green, round(B, 4) AS yellow_blue FROM lab")
def _(t):
    return colours(t).select("vec_id", F.round("L", 4).alias("light"), F.round("a", 4).alias("red_green"), F.round("b", 4).alias("yellow_blue"))


@query("a18_hue_histogram", f"""WITH {_LAB}, h AS (SELECT label, least(7, floor((atan2(B, A) + pi()) / (pi() / 4)))::INT AS bin, sqrt(A * A + B * B) AS chroma FROM lab)
SELECT label, bin, round(sum(chroma) / (sum(sum(chroma)) OVER (PARTITION BY label) + 1e-6), 5) AS share FROM h GROUP BY label, bin""")
def _(t):
    d = colours(t)
    sums = d.groupBy("label", vision.hue_bin(F.col("a"), F.col("b")).alias("bin")).agg(F.sum(vision.chroma(F.col("a"), F.col("b"))).alias("s"))
    total = sums.groupBy(F.col("label").alias("l")).agg(F.sum("s").alias("total"))
    return sums.join(total, F.col("label") == F.col("l")).select("label", "bin", F.round(F.col("s") / (F.col("total") + 1e-6), 5).alias("share"))


@query("a19_colour_shares", f"""WITH {_LAB}, c AS (SELECT *, sqrt(A * A + B * B) AS ch FROM lab)
SELECT label, round(avg((ch < 10)::INT), 6) AS gray, round(avg((A > 6 AND B > 8 AND ch > 12)::INT), 6) AS warm, round(avg((B < -6 AND ch > 10)::INT), 6) AS cool, round(stddev_pop(L) / 40, 6) AS spread FROM c GROUP BY label""")
def _(t):
    f = vision.pixel_features(F.col("L"), F.col("a"), F.col("b"), F.lit(0), F.lit(3))
    return colours(t).groupBy("label").agg(*(F.round(f[k], 6).alias(n) for k, n in (("v5", "gray"), ("v6", "warm"), ("v7", "cool"), ("v3", "spread"))))


@query("m13_palette_names", f"""WITH {_LAB}, m AS (SELECT label, avg(L) AS L, avg(A) AS a, avg(B) AS b, count(*) AS n FROM lab GROUP BY label)
SELECT label, CASE WHEN b < -8 THEN 'Arctic blue' WHEN L < 42 AND abs(a) < 4 AND abs(b) < 4 THEN 'Charcoal and shadow' WHEN a < -2 AND b > 8 THEN 'Olive green' WHEN a > 3 AND b > 14 THEN 'Ochre and rock'
  WHEN b > 6 AND abs(a) < 6 THEN 'Warm gray' WHEN b < 0 AND a < 4 THEN 'Cool teal' WHEN abs(a) < 8 AND abs(b) < 8 THEN 'Neutral stone' WHEN L < 34 THEN 'Nocturnes' ELSE 'Mixed palette' END AS name, n FROM m""")
def _(t):
    m = colours(t).groupBy("label").agg(*(F.avg(c).alias(c) for c in ("L", "a", "b")), F.count("*").alias("n"))
    return m.select("label", vision.palette_name(F.col("L"), F.col("a"), F.col("b"), F.lit(0.0)).alias("name"), "n")


@query("a25_duplicate_components", f"""WITH RECURSIVE {_BITS}, e AS (SELECT u, v FROM pairs UNION SELECT v, u FROM pairs),
walk(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.v, seen FROM walk JOIN e ON e.u = walk.node)
SELECT node AS vec_id, min(seen) AS component FROM walk GROUP BY node""")
def _(t):
    return graph.duplicate_groups(signs(t).withColumn("sha", F.lit(None).cast("string")), "vec_id", "sha", "h", 15).select("vec_id", "component")


@query("a26_facet_counts", """SELECT id, name, n, name || ' · ' || n AS label FROM (SELECT -1 AS id, 'All' AS name, count(*) AS n FROM embeddings
UNION ALL SELECT r_regionkey, r_name, (SELECT count(*) FROM embeddings WHERE label = r_regionkey) FROM region)""".replace("count(*) AS n FROM embeddings", "count(*) FILTER (label IN (SELECT r_regionkey FROM region)) AS n FROM embeddings"))
def _(t):
    return browse.facet_counts(t("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster")), t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")))


# Windows, order, sets


@query("w1_primary_images", f"""WITH {IMAGES} SELECT item_id, row_number() OVER w = 1 AS "primary", count(*) OVER (PARTITION BY coalesce(work_id, 'sha:' || sha)) AS copies
FROM images WINDOW w AS (PARTITION BY coalesce(work_id, 'sha:' || sha) ORDER BY pixels DESC, rank, ord)""")
def _(t):
    return catalogue.with_primary(events_as_images(t)).select("item_id", "primary", "copies")


@query("w3_dense_ids", f"WITH {WORKS} SELECT ord, format('w{{:04d}}', row_number() OVER (ORDER BY coalesce(year, 9999), title, ord)) AS id FROM works")
def _(t):
    return catalogue.with_ids(parts_as_works(t)).select("ord", "id")


@query("w6_mosaic_layout")
def _(t):
    tiles = t("part").select(F.col("p_brand").alias("group"), F.col("p_partkey").alias("id"), (F.col("p_size") / 20.0).alias("aspect"), F.col("p_partkey").alias("ord"))
    return layout.mosaic(tiles, 1200.0, 180.0)


@query("w8_near_best", """SELECT l_orderkey, l_linenumber FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_orderkey) AS top FROM lineitem) WHERE l_quantity >= top - 2""")
def _(t):
    return t("lineitem").withColumn("top", F.max("l_quantity").over(Window.partitionBy("l_orderkey"))).where("l_quantity >= top - 2").select("l_orderkey", "l_linenumber")


@query("w9_last_rows", "SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 500")
def _(t):
    return records.last_n(t("events").select("event_id", "event_type"), "event_id", 500)


@query("w10_unique_keys", """SELECT p_partkey, CASE WHEN n > 1 THEN p_name || '#' || n ELSE p_name END AS unique_key FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS n FROM part)""")
def _(t):
    return records.suffixed(t("part"), "p_name", ["p_partkey"]).select("p_partkey", "unique_key")


@query("o3_wall_order", "SELECT p_partkey, rank() OVER (ORDER BY p_size * p_size DESC, p_name) AS place FROM part")
def _(t):
    d = t("part").select("p_partkey", F.col("p_name").alias("title"), F.col("p_size").alias("w"), F.col("p_size").alias("h"))
    groups = d.groupBy("title", "w", "h").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(*browse.wall_order("size", True)).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d.join(groups.withColumn("place", before + 1), ["title", "w", "h"]).select("p_partkey", "place")


@query("o4_checklist", f"WITH {WORKS} SELECT ord, title FROM works WHERE ord % 10 <> 1 AND ord % 2 = 0 AND contains(lower(title || ' ' || coalesce(year::VARCHAR, '') || ' ' || coalesce(collection, '')), 'bolt')")
def _(t):
    w = parts_as_works(t).withColumn("extra", F.col("ord") % 10 == 1).withColumn("status", F.when(F.col("ord") % 2 == 0, "have").otherwise("missing"))
    return browse.checklist(w, "have", "Bolt").orderBy(*browse.checklist_order("gap")).select("ord", "title")


@query("o5_top_k_per_group", "SELECT o_custkey, o_orderkey, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3")
def _(t):
    return catalogue.ranked(t("orders"), ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"], most=3).select("o_custkey", "o_orderkey", "rank")


@query("u2_widened_union", """SELECT k, arg_max(src, (w, -o)) AS source, max(w) AS width FROM (SELECT l_partkey AS k, 'a' AS src, l_quantity AS w, 0 AS o FROM lineitem UNION ALL SELECT p_partkey, 'b', p_size, 1 FROM part) GROUP BY k""")
def _(t):
    both = records.union_records(
        t("lineitem").select(F.col("l_partkey").alias("k"), F.lit("a").alias("source"), F.col("l_quantity").alias("width"), F.lit(0).alias("o")),
        t("part").select(F.col("p_partkey").alias("k"), F.lit("b").alias("source"), F.col("p_size").cast("double").alias("width"), F.lit(1).alias("o")),
    )
    return both.groupBy("k").agg(F.max_by(F.struct("source", "width"), F.struct("width", -F.col("o"))).alias("b")).select("k", "b.*")


@query("u3_difference", "SELECT DISTINCT user_id FROM events WHERE event_type = 'error' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 20")
def _(t):
    e = t("events")
    return streaming.unseen(e.where("event_type = 'error'").select("user_id"), e.where("event_type = 'purchase' and value > 20"), "user_id")


@query("u4_capped_array_union", "SELECT vec_id, list_sum(list_transform(list_distinct([label % 3, label % 5, label % 2, label % 7]), lambda x: x)) AS total FROM embeddings WHERE label >= 0")
def _(t):
    u = F.slice(F.array_distinct(F.concat(F.array(F.col("label") % 3, F.col("label") % 5), F.array(F.col("label") % 2, F.col("label") % 7))), 1, 4)
    return t("embeddings").where("label >= 0").select("vec_id", F.aggregate(u, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


# Scalar functions


@query("f1_slugs", """SELECT doc_id, coalesce(nullif(substr(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), 1, 120), ''), 'untitled') AS slug FROM documents""")
def _(t):
    return t("documents").select("doc_id", X.slugify(F.col("text")).alias("slug"))


@query("f2_plain_text")
def _(t):
    return t("pages").select("page_id", X.strip_html("html").alias("text"))


@query("f3_normed_titles")
def _(t):
    return t("documents").select("doc_id", X.norm(F.col("text")).alias("norm"))


@query("f6_title_keys", r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name || ', ' || p_brand), '[^\w\s]', '', 'g'), '\s+', ' ', 'g')) AS title_key FROM part""")
def _(t):
    return t("part").select("p_partkey", X.title_key(F.concat_ws(", ", "p_name", "p_brand")).alias("title_key"))


@query("f12_domains", r"SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)), '^www\.', '') AS domain FROM pages")
def _(t):
    return t("pages").select("page_id", X.domain_of(F.col("url")).alias("domain"))


@query("f13_url_parts", r"SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '([^/]*)/?$', 1) AS base, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def _(t):
    return t("pages").select("page_id", X.url_basename(F.col("url")).alias("base"), X.url_parameter(F.col("url"), "page").alias("page"))


@query("f14_escaped", """SELECT doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') AS escaped FROM documents""")
def _(t):
    return t("documents").select("doc_id", X.html_escape(F.col("text")).alias("escaped"))


@query("f15_captions", """SELECT p_partkey, '<b>' || p_name || '</b><span>' || array_to_string(list_filter([nullif(((p_size % 4) * 500)::VARCHAR, '0'), p_brand, CASE WHEN p_size > 1 THEN p_size || ' files' END], lambda x: x IS NOT NULL), ' · ') || '</span>' AS caption FROM part""")
def _(t):
    c = browse.caption(F.col("p_name"), F.col("p_size") % 4 * 500, F.lit(""), F.col("p_brand"), F.col("p_size"), F.lit(None).cast("string"))
    return t("part").select("p_partkey", c.alias("caption"))


@query("d1_first_years", r"""SELECT o_orderkey, try_cast(nullif(regexp_extract(s, '\b((18|19)\d{2})\b', 1), '') AS INT) AS year FROM (SELECT o_orderkey, 'ca. ' || strftime(o_orderdate, '%Y-%m-%d') || ' (' || o_orderstatus || ')' AS s FROM orders)""")
def _(t):
    s = F.concat(F.lit("ca. "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" ("), F.col("o_orderstatus"), F.lit(")"))
    return t("orders").select("o_orderkey", Y.year_from(s).alias("year"))


@query("d4_parsed_years", r"""SELECT k, CASE WHEN r <> '' THEN regexp_extract(s, '(19\d{2})-(\d{2})', 1)::INT WHEN y BETWEEN 1880 AND 1975 AND y <> 1885 THEN y END AS year,
 CASE WHEN s = 'n.d.' THEN NULL WHEN r <> '' THEN regexp_extract(s, '(19\d{2})-(\d{2})', 1) || '-' || (1900 + regexp_extract(s, '(19\d{2})-(\d{2})', 2)::INT) ELSE s END AS year_range
FROM (SELECT k, s, regexp_extract(s, '19\d{2}-\d{2}') AS r, try_cast(nullif(regexp_extract(s, '\b((18|19)\d{2})\b', 1), '') AS INT) AS y FROM (
 SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'n.d.' WHEN 1 THEN 'c. ' || (1870 + p_partkey % 130) WHEN 2 THEN (1900 + p_partkey % 60) || '-' || (10 + p_partkey % 90) ELSE 'undated' END AS s FROM part))""")
def _(t):
    k = F.col("p_partkey")
    s = (
        F.when(k % 4 == 0, "n.d.").when(k % 4 == 1, F.concat(F.lit("c. "), (1870 + k % 130).cast("string")))
        .when(k % 4 == 2, F.concat_ws("-", (1900 + k % 60).cast("string"), (10 + k % 90).cast("string"))).otherwise("undated")
    )
    return t("part").select(k.alias("k"), Y.parse_year(s).alias("y")).select("k", "y.*")


@query("d7_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') || ' UTC' AS stamp FROM events")
def _(t):
    return t("events").select("event_id", Y.stamp(F.col("ts")).alias("stamp"))


@query("z1_token_sort_scores", "SELECT p_partkey, 200.0 * n / (2 * n + 2 + p_partkey % 30) AS score FROM (SELECT p_partkey, length(p_name)::DOUBLE AS n FROM part)")
def _(t):
    # Names with their words sorted, against the words in another order and one more of letters that no name has, which stands last in order.
    name = F.array_join(F.array_sort(F.split("p_name", " ")), " ")
    turned = F.array_join(F.reverse(F.split("p_name", " ")), "  ")
    more = F.concat(F.repeat(F.lit("~"), (1 + F.col("p_partkey") % 30).cast("int")), F.lit(" "), turned)
    return t("part").select("p_partkey", fuzzy.token_sort_udf(name, more).alias("score"))


@query("m4_difference_hashes", """SELECT vec_id, array_to_string(list_transform(range(1, 57), lambda i: CASE WHEN embedding[i + (i - 1) // 7] > embedding[i + (i - 1) // 7 + 1] THEN '1' ELSE '0' END), '') AS bits FROM embeddings""".replace("range(1, 57)", "range(1, 50)"))
def _(t):
    h = vision.dhash(F.slice("embedding", 1, 56), 7)
    return t("embeddings").select("vec_id", F.lpad(F.bin(h), 49, "0").alias("bits"))


@query("m5_hamming", "SELECT a.event_id, bit_count(xor(a.event_id, a.user_id))::INT AS distance FROM events a")
def _(t):
    return t("events").select("event_id", vision.hamming(F.col("event_id"), F.col("user_id")).alias("distance"))


@query("m8_softmax", """WITH l AS (SELECT vec_id, [embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE] AS v FROM embeddings), e AS (SELECT vec_id, list_transform(v, lambda x: exp((x - list_max(v)) * 10)) AS e FROM l)
SELECT vec_id, round(e[1] / list_sum(e), 6) AS p0, round(e[2] / list_sum(e), 6) AS p1, round(e[2] / list_sum(e) + 0.5 * e[3] / list_sum(e), 6) AS x, (list_position(e, list_max(e)) - 1)::INT AS cluster FROM e""")
def _(t):
    d = t("embeddings").select("vec_id", vision.softmax(F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double") * 10)).alias("p"))
    return d.select("vec_id", F.round(F.get("p", F.lit(0)), 6).alias("p0"), F.round(F.get("p", F.lit(1)), 6).alias("p1"), F.round(vision.ternary(F.col("p"))["x"], 6).alias("x"), vision.argmax(F.col("p")).alias("cluster"))


# Learning and streaming


@query("ml1_standardized", """SELECT vec_id, round((embedding[1] - m) / s, 5) AS x0 FROM embeddings, (SELECT avg(embedding[1]::DOUBLE) AS m, stddev_pop(embedding[1]::DOUBLE) AS s FROM embeddings)""")
def _(t):
    d = t("embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double")).alias("v"))
    return features.standardized(d, "v", 4).select("vec_id", F.round(F.get("v", F.lit(0)), 5).alias("x0"))


@query("ml2_choice_of_k")
def _(t):
    """(k, cost, silhouette, chosen) of 4 to 8 clusters of the standardized vectors, ten starts each."""
    d = t("embeddings")
    width = d.select(F.max(F.size("embedding"))).first()[0] or 1
    chosen, found = features.choose_k(features.standardized(d.select("embedding"), "embedding", width), "embedding")
    return d.sparkSession.createDataFrame([(k, c, s, k == chosen) for k, (c, s) in found.items()], "k int, cost double, silhouette double, chosen boolean")


@query("ml3_kmeans")
def _(t):
    d = t("embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return features.kmeans(d, "v", 6, restarts=20).select("id", "cluster")


@query("ml4_silhouette", """WITH d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS s, count(*) AS n FROM embeddings a, embeddings b GROUP BY ALL),
r AS (SELECT vec_id, max(CASE WHEN label = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN label <> other THEN s / n END) AS b FROM d GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM r""")
def _(t):
    d = t("embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.col("label").cast("int").alias("cluster"))
    return features.silhouette(d, "v").select(F.round("silhouette", 6).alias("silhouette"))


@query("ml6_planes")
def _(t):
    d = t("embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), F.col("label").alias("cluster"))
    return features.plane(d, "v")


@query("ml7_prototype_classes", """WITH u AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v FROM embeddings),
m AS (SELECT label, list(x ORDER BY i) AS p FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM u) GROUP BY label, i) GROUP BY label),
s AS (SELECT vec_id, m.label, list_cosine_similarity(v, p) AS c FROM u, m)
SELECT vec_id AS id, arg_max(label, (c, -label))::INT AS label FROM s GROUP BY vec_id""")
def _(t):
    e = t("embeddings").select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"), "label")
    protos = features.prototypes(e, "v", "label", 64)
    labels = protos.agg(F.array_sort(F.collect_list("label")).alias("labels"))
    return features.scored(e, "v", protos, "label").join(F.broadcast(labels), F.lit(True)).select("id", F.get("labels", F.col("cluster")).cast("int").alias("label"))


@query("t1_stream_upsert", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def _(t):
    events = t("events")
    spark, files = events.sparkSession, events.inputFiles()
    base = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    folder, _, name = files[0].rpartition("/")
    rows = spark.readStream.schema(events.schema).option("pathGlobFilter", name if len(files) == 1 else "*.parquet").parquet(folder)
    q = streaming.stream_upsert(rows.select("user_id", "event_id", "event_type"), f"{base}/table", f"{base}/log", "user_id", "event_id")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/table").where(F.col("epoch") == spark.read.parquet(f"{base}/table").agg(F.max("epoch")).first()[0]).drop("epoch")


@query("t4_fill_missing", f"""WITH {RECORDS}, o AS (SELECT * FROM records WHERE _ord % 2 = 0), n AS (SELECT _ord - 1 AS _ord, title, medium FROM records WHERE _ord % 2 = 1)
SELECT coalesce(o._ord, n._ord) AS id, coalesce(nullif(o.title, ''), nullif(n.title, '')) AS title, coalesce(o.medium, n.medium) AS medium FROM o FULL JOIN n USING (_ord)""")
def _(t):
    r = events_as_records(t).withColumnRenamed("_ord", "id").select("id", "title", "medium")
    return records.upsert(r.where("id % 2 = 0"), r.where("id % 2 = 1").withColumn("id", F.col("id") - 1), "id", "fill")


# More of each family


@query("s3_local_keys", r"SELECT l_orderkey, l_linenumber, l_partkey, regexp_replace(regexp_replace('./data/' || l_partkey || '/a.jpg', '^[./]+', ''), '^data/', '') AS key FROM lineitem")
def _(t):
    path = F.concat(F.lit("./data/"), F.col("l_partkey").cast("string"), F.lit("/a.jpg"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", readers.local_key(path).alias("key"))


@query("s13_coalesced_fields", """SELECT event_id, coalesce(nullif(CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END, ''), nullif(CASE WHEN event_id % 2 = 0 THEN 'even' END, ''), props) AS title FROM events""")
def _(t):
    d = t("events").withColumns({"a": F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")), "b": F.when(F.col("event_id") % 2 == 0, "even")})
    return readers.coalesced(d, title=["a", "b", "missing", "props"]).select("event_id", "title")


@query("s26_labelled_fields", """SELECT c_custkey, c_mktsegment AS segment, CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name FROM customer""")
def _(t):
    label = F.concat(F.lit("Segment\n\n "), F.col("c_mktsegment"), F.lit("\nOther\nx\n"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("Name\n"), F.col("c_name"))).otherwise(""))
    return t("customer").select("c_custkey", X.labelled_field(label, "Segment").alias("segment"), X.labelled_field(label, "Name").alias("name"))


@query("s28_open_licences", """SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true ELSE false END AS open FROM supplier""")
def _(t):
    names = F.array(*map(F.lit, ("CC BY 4.0", "CC BY-NC 4.0", "Public Domain", "All rights reserved")))
    return t("supplier").select("s_suppkey", rules.openly_licensed(F.get(names, (F.col("s_suppkey") % 4).cast("int"))).alias("open"))


@query("s31_file_links", """SELECT page_id, pos::INT AS pos, href FROM (SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos FROM (
  SELECT page_id, list_transform(list_filter(list_zip(m, range(1, len(m) + 1)), lambda z: list_position(m, z[1]) = z[2]), lambda z: z[1]) AS l FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]+)"', 1) AS m FROM pages)))""")
def _(t):
    return readers.html_values(t("pages").select("page_id", "html"), "href", r'<a href="([^"]+)"').select("page_id", "pos", "href")


@query("s32_entity_labels", "SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN 'en-' || n_name WHEN n_nationkey % 3 = 1 THEN 'fr-' || n_name ELSE 'pl-' || n_name END AS label FROM nation")
def _(t):
    k, v = F.col("n_nationkey") % 3, lambda p: F.concat(F.lit(p), F.col("n_name"))
    labels = F.when(k == 0, F.create_map(F.lit("fr"), v("fr-"), F.lit("en"), v("en-"))).when(k == 1, F.create_map(F.lit("de"), v("de-"), F.lit("fr"), v("fr-"))).otherwise(F.create_map(F.lit("pl"), v("pl-")))
    return t("nation").select("n_nationkey", readers.labelled_entity(labels).alias("label"))


@query("p5_image_types", "SELECT p_partkey, p_partkey % 3 <> 2 AS ok FROM part")
def _(t):
    mime = F.get(F.array(F.lit("image/PNG"), F.lit("image/jpeg"), F.lit("text/html")), (F.col("p_partkey") % 3).cast("int"))
    return t("part").select("p_partkey", rules.is_image_type(mime).alias("ok"))


@query("p6_size_floors", "SELECT p_partkey FROM part WHERE p_retailprice * 10 >= 9500 AND p_size >= 20 AND p_partkey % 100 >= 20")
def _(t):
    ok = rules.large_enough(F.col("p_retailprice") * 10, F.col("p_size"), F.col("p_partkey") % 100, 9500, 20)
    return t("part").where(ok).select("p_partkey")


@query("p13_reject_reasons", """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'merchandise' WHEN p_partkey % 4 = 1 THEN 'furniture' END AS reason FROM part""")
def _(t):
    k = F.col("p_partkey") % 4
    text, url = F.when(k == 0, F.concat("p_name", F.lit(" T-shirt"))).otherwise(F.col("p_name")), F.when(k == 1, "http://x/Logo.png").otherwise("http://x/a.png")
    return t("part").select("p_partkey", rules.reject_reason(text, url).alias("reason"))


@query("p15_museum_objects", """SELECT p_partkey, p_partkey % 5 <> 0 AS keep, CASE WHEN p_size < 10 THEN 'low' ELSE 'high' END AS confidence, CASE WHEN p_size < 10 THEN 'unusual medium: old photograph' END AS note FROM part""")
def _(t):
    role = F.when(F.col("p_partkey") % 5 == 0, "Photographer").otherwise("Artist")
    medium = F.when(F.col("p_size") < 10, "old photograph").otherwise("oil")
    return t("part").select("p_partkey", rules.museum_object(role, medium).alias("m")).select("p_partkey", "m.*")


@query("p26_refresh", "SELECT event_id FROM events WHERE event_id % 4 < 2 OR event_id % 5 = 0")
def _(t):
    d = F.when(F.col("event_id") % 5 == 0, "").otherwise("text")
    return t("events").where(rules.needs_refresh(F.col("event_id") % 4, d)).select("event_id")


@query("p20_modes", f"WITH {IMAGES} SELECT count(*) AS n FROM (SELECT DISTINCT coalesce(work_id, 'sha:' || sha) FROM images)")
def _(t):
    return browse.in_mode(catalogue.with_primary(events_as_images(t)), "works").agg(F.count("*").alias("n"))


@query("p21_facet", "SELECT p_partkey FROM part WHERE p_partkey IN (SELECT vec_id FROM embeddings WHERE label = 3)")
def _(t):
    return browse.facet(t("part").select(F.col("p_partkey").alias("id")), t("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster")), 3).select(F.col("id").alias("p_partkey"))


@query("j15_semi_and_anti", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(t):
    o = lambda s: t("orders").where(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(o("F"), "c_custkey", "left_semi").join(o("P"), "c_custkey", "left_anti").select("c_custkey")


@query("j16_enriched_rows", """SELECT c_custkey AS key, coalesce(s_name, c_name) AS name, c_mktsegment AS segment FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def _(t):
    base = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    more = t("supplier").join(t("customer").select(F.col("c_custkey").alias("s_suppkey")), "s_suppkey", "left_semi").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit(None).cast("string").alias("segment"))
    return records.upsert(base, more, "key", "prefer_new")


@query("j17_prototype_cosines", """SELECT a.vec_id, b.vec_id AS proto, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS cosine FROM embeddings a, embeddings b WHERE b.vec_id < 3""")
def _(t):
    e = t("embeddings").select("vec_id", vision.unit(F.col("embedding")).alias("u"))
    few = e.where("vec_id < 3").select(F.col("vec_id").alias("proto"), F.col("u").alias("w"))
    return e.join(F.broadcast(few), F.lit(True)).select("vec_id", "proto", F.round(vision.dot(F.col("u"), F.col("w")), 5).alias("cosine"))  # three rows


@query("j21_work_detail", f"""WITH {IMAGES} SELECT item_id FROM images WHERE work_id = 'w7'""")
def _(t):
    works = t("part").select(F.format_string("w%d", "p_partkey").alias("id"), F.col("p_name").alias("title"), F.array("p_brand").alias("sources"))
    return browse.detail(works, events_as_images(t), "w7").select("item_id")


@query("a13_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(t):
    return t("events").groupBy("event_type").agg(F.count("*").alias("n"))


@query("a22_ordered_distinct", "SELECT p_name, min(p_partkey) AS first FROM part GROUP BY p_name")
def _(t):
    return t("part").groupBy("p_name").agg(F.min("p_partkey").alias("first"))


@query("a23_years_among_near_ties", """SELECT o_custkey, count(DISTINCT year(o_orderdate)) AS years FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top FROM orders) WHERE o_totalprice >= top - 100000 GROUP BY o_custkey""")
def _(t):
    top = t("orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_totalprice").alias("top"))
    near = t("orders").join(top, F.col("o_custkey") == F.col("k")).where(F.col("o_totalprice") >= F.col("top") - 100000)
    return near.groupBy("o_custkey").agg(F.countDistinct(F.year("o_orderdate")).alias("years"))


@query("a24_provenance_lists", "SELECT l_partkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS via FROM lineitem GROUP BY l_partkey")
def _(t):
    return t("lineitem").groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("via"))


@query("a27_bounding_box", "SELECT p_brand, min(p_size) AS lo, max(p_size) AS hi, count(*) AS n FROM part GROUP BY p_brand")
def _(t):
    return t("part").groupBy("p_brand").agg(F.min("p_size").alias("lo"), F.max("p_size").alias("hi"), F.count("*").alias("n"))


@query("w4_numbered_names", "SELECT n_nationkey, r || CASE WHEN k > 1 THEN ' ' || k ELSE '' END AS name FROM (SELECT n_nationkey, r_name AS r, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS k FROM nation JOIN region ON n_regionkey = r_regionkey)")
def _(t):
    d = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("r_name").alias("name"))
    return records.suffixed(d, "name", ["n_nationkey"], " ", "unique").select("n_nationkey", F.col("unique").alias("name"))


@query("w7_running_offsets", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, coalesce(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_suppkey, l_extendedprice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x FROM lineitem")
def _(t):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_quantity", "l_suppkey", "l_extendedprice").rowsBetween(Window.unboundedPreceding, -1)
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.coalesce(F.sum("l_quantity").over(w), F.lit(0.0)).alias("x"))


@query("o1_null_defaults", "SELECT p_partkey, row_number() OVER (ORDER BY coalesce(nullif(p_size % 4, 0), 9999), coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END, '~'), p_partkey) AS place FROM part")
def _(t):
    title = F.when(F.col("p_partkey") % 3 == 0, F.lit(None)).otherwise(F.col("p_name"))
    d = records.numbered(t("part"), [F.coalesce(F.nullif(F.col("p_size") % 4, F.lit(0)), F.lit(9999)), F.coalesce(title, F.lit("~")), F.col("p_partkey")], "", name="place")
    return d.select("p_partkey", F.col("place").cast("long").alias("place"))


@query("u5_first_under_key", "SELECT lower(p_brand) AS k, arg_min(p_partkey, p_partkey) AS first FROM part GROUP BY lower(p_brand)")
def _(t):
    return t("part").groupBy(F.lower("p_brand").alias("k")).agg(F.min_by("p_partkey", "p_partkey").alias("first"))


@query("u6_cache_merge", "SELECT user_id, 'new' AS side FROM (SELECT DISTINCT user_id FROM events WHERE event_id % 3 = 0) UNION ALL SELECT user_id, 'old' FROM (SELECT DISTINCT user_id FROM events WHERE event_id % 5 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 3 = 0))")
def _(t):
    side = lambda n, name: t("events").where(F.col("event_id") % n == 0).select("user_id").distinct().withColumn("side", F.lit(name))
    return records.upsert(side(5, "old"), side(3, "new"), "user_id")


@query("f11_hex_colours", f"""WITH rgb AS ({_RGB}) SELECT vec_id, '#' || lpad(lower(to_hex(round_even(r * 255, 0)::INT)), 2, '0') || lpad(lower(to_hex(round_even(g * 255, 0)::INT)), 2, '0') || lpad(lower(to_hex(round_even(b * 255, 0)::INT)), 2, '0') AS color FROM rgb""")
def _(t):
    return colours(t).select("vec_id", vision.hex_colour(F.col("r"), F.col("g"), F.col("bl")).alias("color"))


@query("f18_scripts", "SELECT doc_id, regexp_matches(text, '[\u0400-\u04ff]') AS cyrillic FROM documents")
def _(t):
    return t("documents").select("doc_id", X.has_cyrillic(F.col("text")).alias("cyrillic"))


@query("f19_sold_for", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE floor(o_totalprice)::BIGINT END AS price FROM orders")
def _(t):
    amount = F.concat(F.lit("Sold for: $"), F.format_number(F.floor("o_totalprice"), 0), F.lit(" incl. premium"))
    return t("orders").select("o_orderkey", X.sold_for(F.when(F.col("o_orderkey") % 3 == 0, "passed").otherwise(amount)).alias("price"))


@query("f21_dimensions", "SELECT p_partkey, p_size || ' x ' || (p_size + 5) || ' cm' AS dimensions, CASE WHEN p_partkey % 2 = 0 THEN 'oil on canvas' END AS medium FROM part")
def _(t):
    size = F.concat_ws(" x ", F.col("p_size").cast("string"), (F.col("p_size") + 5).cast("string"))
    text = F.concat(F.lit("Lot: "), F.when(F.col("p_partkey") % 2 == 0, "Oil on Canvas, ").otherwise(""), size, F.lit(" cm, signed"))
    return t("part").select("p_partkey", X.dimensions_in(text).alias("dimensions"), X.medium_in(text).alias("medium"))


@query("f22_larger_images", "SELECT p_partkey, 'http://u/a/' || p_partkey || '.jpg' AS url FROM part")
def _(t):
    n = F.col("p_partkey").cast("string")
    return t("part").select("p_partkey", X.larger_image(F.concat(F.lit("http://u/thumb/a/"), n, F.lit(".jpg/300px-"), n, F.lit(".jpg"))).alias("url"))


@query("d3_years_in_text", "SELECT k, y AS year, CASE WHEN y2 <> y THEN y2 END AS year_end FROM (SELECT p_partkey AS k, (1904 + p_partkey % 60)::INT AS y, (1904 + p_partkey % 60 + p_partkey % 3)::INT AS y2 FROM part)")
def _(t):
    y = 1904 + F.col("p_partkey") % 60
    text = F.concat(F.lit("from "), y.cast("string"), F.lit(" until "), (y + F.col("p_partkey") % 3).cast("string"), F.lit(", not 1890"))
    return t("part").select(F.col("p_partkey").alias("k"), Y.years_in(text).alias("y")).select("k", "y.*")


@query("m3_palette_vectors", f"""WITH {_LAB} SELECT label, round(avg(L) / 100, 6) AS v0, round(avg(A) / 40, 6) AS v1, round(avg(B) / 40, 6) AS v2, round(avg(sqrt(A * A + B * B)) / 40, 6) AS v4 FROM lab GROUP BY label""")
def _(t):
    f = vision.pixel_features(F.col("L"), F.col("a"), F.col("b"), F.lit(0), F.lit(3))
    return colours(t).groupBy("label").agg(*(F.round(f[k], 6).alias(k) for k in ("v0", "v1", "v2", "v4")))


@query("m6_aspect_agreement", """WITH c AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY p_brand, p_size)
SELECT a.p_brand AS brand, a.p_size AS a, b.p_size AS b, a.n * b.n AS pairs FROM c a JOIN c b ON a.p_brand = b.p_brand AND a.p_size <= b.p_size AND (b.p_size - a.p_size) / 50.0 / (b.p_size / 50.0) <= 0.08""")
def _(t):
    c = t("part").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))  # a brand's sizes are few: pairs are of sizes
    c = c.select("p_brand", "p_size", "n", F.col("p_size").cast("double").alias("w"), F.lit(50.0).alias("h"))
    a, b = c.alias("a"), c.alias("b")
    close = vision.aspect_close(F.col("a.w"), F.col("a.h"), F.col("b.w"), F.col("b.h"))
    met = a.join(b, (F.col("a.p_brand") == F.col("b.p_brand")) & (F.col("a.p_size") <= F.col("b.p_size")) & close)
    return met.select(F.col("a.p_brand").alias("brand"), F.col("a.p_size").alias("a"), F.col("b.p_size").alias("b"), (F.col("a.n") * F.col("b.n")).alias("pairs"))


@query("m9_style_priors", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 4.0 ELSE 0.0 END::DOUBLE AS drawing, CASE WHEN p_partkey % 2 = 0 THEN 4.0 ELSE 0.0 END::DOUBLE AS abstract FROM part")
def _(t):
    title = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("Abstract "), F.col("p_name"))).otherwise(F.col("p_name"))
    medium = F.when(F.col("p_partkey") % 3 == 0, "graphite on paper").otherwise("oil on canvas")
    d = t("part").select("p_partkey", vision.style_priors(title, medium).alias("p"))
    return d.select("p_partkey", F.get("p", F.lit(0)).alias("drawing"), F.get("p", F.lit(1)).alias("abstract"))


@query("m16_region_anchors", """WITH c AS (SELECT vec_id, (label % 3)::INT AS k FROM embeddings), n AS (SELECT count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS s FROM c),
p AS (SELECT vec_id, k, s / (a + b + s) AS scene, a / (a + b) AS line FROM c, n)
SELECT vec_id, round(16 + (CASE k WHEN 2 THEN 0.5 WHEN 0 THEN line / 2 ELSE (line + 1) / 2 END) * 968, 5) AS cx, round(16 + (CASE k WHEN 2 THEN scene / 2 ELSE (scene + 1) / 2 END) * 468, 5) AS cy FROM p""")
def _(t):
    c = t("embeddings").select("vec_id", (F.col("label") % 3).cast("int").alias("k"))
    counts = c.agg(F.array(*(F.count_if(F.col("k") == i) for i in range(3))).alias("n"))
    at = layout.region_anchor(F.col("k"), F.lit(None).cast("double"), F.lit(0.5), F.col("n"), 1000, 500)
    return c.join(F.broadcast(counts), F.lit(True)).select("vec_id", at.alias("p")).select("vec_id", F.round("p.cx", 5).alias("cx"), F.round("p.cy", 5).alias("cy"))  # one row


@query("m18_tile_sizes", "SELECT p_partkey, round(sqrt(9801.0 / (p_size / 10.0)) * (p_size / 10.0), 5) AS w, round(sqrt(9801.0 / (p_size / 10.0)), 5) AS h FROM part")
def _(t):
    s = layout.tile_size(F.col("p_size") / 10.0)
    return t("part").select("p_partkey", F.round(s["w"], 5).alias("w"), F.round(s["h"], 5).alias("h"))


@query("m17_packed_bubbles")
def _(t):
    s = layout.tile_size(F.col("p_size") / 25.0, 60.0)
    d = t("part").select(F.concat_ws(" ", "p_brand", "p_type").alias("group"), F.col("p_partkey").alias("id"), (F.col("p_partkey") * 37 % 400).cast("double").alias("cx"), (F.col("p_partkey") * 91 % 300).cast("double").alias("cy"), s.alias("s"))
    return layout.bubbles(d.select("group", "id", "cx", "cy", "s.*"))


@query("t2_seen_set", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)")
def _(t):
    return streaming.first_seen(t("events"), ["user_id", "event_type"]).agg(F.count("*").alias("n"))

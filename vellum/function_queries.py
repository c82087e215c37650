"""Further queries over the shared tables: functions, rules, choices, sources and sinks, with SQL that says the same.

Texts with the features that a function reads are made from the tables' own
columns; the SQL states the result from those columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.catalogue_queries import RECORDS, WORKS, events_as_records, parts_as_works, query
from vellum.functions import fuzzy, vision
from vellum.functions import text as X
from vellum.functions import years as Y
from vellum.functions.profile import Profile
from vellum.operators import browse, choice, graph, merge, records, rules
from vellum.scratch import dealt, scratch_dir, stage
from vellum.sources import markup, pacing, pages, probes, readers, sinks, stores
from vellum.streaming import done_log

#: A maker, for rules that need one.
MAKER = Profile(given=("Ann", "Anna"), middle=("Mary",), family="Bolt", others=(r"\bann bolt junior\b", r"\bbea bolt\b"), first_year=1904, last_year=1970, birth_year=1885)


def varied(column: str, *texts) -> Column:
    """The text whose number is the key's remainder."""
    return F.get(F.array(*(t if isinstance(t, Column) else F.lit(t) for t in texts)), (F.col(column) % len(texts)).cast("int"))


def around(before: str, after: str, name: str = "p_name"):
    return F.concat(F.lit(before), F.col(name), F.lit(after))


# Titles, names and texts


@query("f4_clean_titles", "SELECT p_partkey, CASE WHEN p_partkey % 8 = 7 THEN p_name || ', ' || lower(p_type) ELSE p_name END AS title FROM part")
def _(t):
    raw = varied("p_partkey", around('"', '"'), around("  ", " oil on canvas, 30 x 40"), around("", " (1925)"), around("", " ~ 1930"), around("Ann Bolt ", ""), around("", " by Ann Bolt, RCA"),
                 around("", "  Fine Art"), F.concat("p_name", F.lit(",   "), F.lower("p_type"), F.lit(" - Anna Bolt")))
    return t("part").select("p_partkey", X.clean_title(raw, MAKER).alias("title"))


@query("f5_index_titles", "SELECT p_partkey, CASE p_partkey % 6 WHEN 1 THEN p_name || ' - north' WHEN 5 THEN p_name || '''s' ELSE p_name END AS title FROM part")
def _(t):
    raw = varied("p_partkey", around(" . ", " by Ann M. Bolt, 1920"), around("", " – north"), around("", " (NGC 1234)"), around("“", "”"), around("", " - oil on board"), around("", "’s ~"))
    return t("part").select("p_partkey", X.norm_title(raw, MAKER).alias("title"))


@query("f7_clean_snippets", "SELECT p_partkey, p_name || ' & ' || lower(p_type) || ' end' AS text FROM part")
def _(t):
    raw = F.concat(F.lit("<b>"), F.col("p_name"), F.lit("</b>&nbsp;&amp;\n "), F.lower("p_type"), F.lit(" <i class='x'>end</i>"))
    return t("part").select("p_partkey", X.clean_text(raw).alias("text"))


@query("f8_guessed_titles", """SELECT p_partkey, CASE p_partkey % 3 WHEN 2 THEN p_name || ' seen' ELSE p_name END AS title, CASE WHEN p_partkey % 3 < 2 THEN (1905 + p_partkey % 60)::INT END AS year FROM part""")
def _(t):
    y = (1905 + F.col("p_partkey") % 60).cast("string")
    raw = varied("p_partkey", F.concat(F.col("p_name"), F.lit(", ("), y, F.lit(") oil")), F.concat(F.lit("Ann Bolt: "), F.col("p_name"), F.lit(" , "), y), around("", " seen | Shop - x"))
    return t("part").withColumn("g", X.guess_title(raw, MAKER)).select("p_partkey", "g.title", "g.year")


@query("f9_titles_of_files", "SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN (1905 + p_partkey % 60)::INT END AS year FROM part")
def _(t):
    words = F.translate("p_name", " ", "-")
    dated = F.concat(F.lit("a/b/ann-bolt-"), words, F.lit("-"), (1905 + F.col("p_partkey") % 60).cast("string"), F.lit("-oil-jpg.jpg"))
    plain = F.concat(F.lit("anna-bolt-"), words, F.lit("-"), F.lpad(F.col("p_partkey").cast("string"), 7, "0"), F.lit(".webp"))
    return t("part").withColumn("g", X.title_from_name(varied("p_partkey", dated, plain), MAKER)).select("p_partkey", "g.title", "g.year")


@query("f10_query_texts", "SELECT p_partkey, p_name || CASE p_partkey % 4 WHEN 2 THEN ' 1931' ELSE '' END AS q, p_name AS bare FROM part")
def _(t):
    raw = varied("p_partkey", F.concat(F.lit("/x/y/"), F.translate("p_name", " ", "_"), F.lit(".JPG")), around("Ann Bolt ", "  oil on  board"), around(" ", " 1931"), F.concat(F.translate("p_name", " ", "-"), F.lit(".png")))
    q = X.norm_query(raw, MAKER)
    return t("part").select("p_partkey", q.alias("q"), X.without_years(q).alias("bare"))


@query("f16_title_scores", """SELECT p_partkey, 200.0 * n / (n + m) - CASE WHEN n / m < 0.55 THEN 18.0 ELSE 0.0 END AS score
FROM (SELECT p_partkey, p_name, p_type, length(p_name)::DOUBLE AS n, length(p_name)::DOUBLE + 2 + (p_partkey % 30) AS m FROM part)""")
def _(t):
    d = t("part").withColumn("sorted", F.array_join(F.array_sort(F.split("p_name", " ")), " ")).withColumn("long", F.concat("sorted", F.lit(" "), F.repeat(F.lit("~"), (1 + F.col("p_partkey") % 30).cast("int"))))
    return d.select("p_partkey", fuzzy.title_score_udf("sorted", "long").alias("score"))


@query("f17_fallback_titles", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_name || ' ' || p_partkey END AS title FROM part")
def _(t):
    path = F.concat(F.lit("data/x/"), F.translate("p_name", " ", "-"), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(".jpg"))
    return t("part").select("p_partkey", X.title_fallback(varied("p_partkey", F.col("p_name"), "", F.lit(None).cast("string")), path).alias("title"))


@query("f20_names_of_files", """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title,
  CASE WHEN p_partkey % 3 < 2 THEN (1905 + p_partkey % 60)::INT END AS year, CASE p_partkey % 3 WHEN 0 THEN (1905 + p_partkey % 60)::VARCHAR WHEN 1 THEN (1905 + p_partkey % 60) || '-70' END AS year_range FROM part""")
def _(t):
    y, words = (1905 + F.col("p_partkey") % 60).cast("string"), F.translate("p_name", " ", "_")
    raw = varied("p_partkey", F.concat(F.lit("File:Ann Bolt "), words, F.lit(" ("), y, F.lit(").jpg")), F.concat(words, F.lit("_"), y, F.lit("-70.png")), F.concat(words, F.lit(" 12345, oil on canvas.JPG")))
    return t("part").withColumn("g", X.name_to_title(raw, MAKER)).select("p_partkey", "g.title", "g.year", "g.year_range")


@query("f24_hosts", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host FROM pages")
def _(t):
    return t("pages").select("page_id", X.host_of(F.col("url")).alias("host"))


@query("f25_year_labels", "SELECT ord, coalesce(year::VARCHAR, '') AS label FROM (SELECT p_partkey AS ord, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE 1904 + p_partkey % 67 END AS year FROM part)")
def _(t):
    year = F.when(F.col("ord") % 5 == 1, 0).otherwise(F.col("year"))
    return parts_as_works(t).select("ord", Y.year_label(year).alias("label"))


# Years


@query("d2_web_years", r"SELECT doc_id, try_cast(nullif(regexp_extract(s, '\b(18\d{2}|19[0-6]\d|1970)\b', 1), '') AS INT) AS year FROM (SELECT doc_id, 'n ' || n_chars || ', ' || (1790 + doc_id % 220) AS s FROM documents)")
def _(t):
    return t("documents").select("doc_id", Y.year_from_web(F.concat(F.lit("n "), F.col("n_chars").cast("string"), F.lit(", "), (1790 + F.col("doc_id") % 220).cast("string"))).alias("year"))


@query("d5_number_years", "SELECT p_partkey, CASE WHEN ok THEN y END AS year, CASE WHEN ok THEN y::VARCHAR END AS year_range FROM (SELECT p_partkey, y, y BETWEEN 1880 AND 1975 AND y <> 1885 AS ok FROM (SELECT p_partkey, (1870 + p_partkey % 120)::INT AS y FROM part))")
def _(t):
    return t("part").withColumn("y", Y.year_of_number((1870 + F.col("p_partkey") % 120).cast("int"))).select("p_partkey", "y.year", "y.year_range")


@query("d6_iso_dates", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _(t):
    return t("events").select("event_id", Y.iso_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("day"))


@query("d8_year_gaps", "SELECT o_orderkey, abs(year(o_orderdate) - (1990 + o_custkey % 9))::INT AS gap FROM orders")
def _(t):
    return t("orders").select("o_orderkey", Y.year_gap(F.year("o_orderdate"), (1990 + F.col("o_custkey") % 9).cast("int")).alias("gap"))


# Scores


# Rules


@query("p9_person_photos", "SELECT p_partkey, p_partkey % 4 < 2 AS photo FROM part")
def _(t):
    said = varied("p_partkey", around("", " at her studio"), around("Ann Bolt in ", ""), F.col("p_name"), around("view of ", ", 1920"))
    return t("part").select("p_partkey", rules.is_person_photo(said, MAKER).alias("photo"))


@query("p10_attributions", """SELECT p_partkey, k IN (2, 3) AS ok, CASE k WHEN 0 THEN 'other person' WHEN 1 THEN 'photograph' WHEN 2 THEN 'named' WHEN 3 THEN 'trusted source' ELSE 'no name' END AS reason
FROM (SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 AND p_size < 25 THEN 3 WHEN p_partkey % 4 = 3 THEN 4 ELSE p_partkey % 4 END AS k FROM part)""")
def _(t):
    said = varied("p_partkey", around("Ann Bolt and Bea Bolt: ", ""), around("photo of ", " by Ann Bolt"), around("", ", Anna Mary Bolt"), F.col("p_name"))
    return t("part").withColumn("a", rules.attribution(said, MAKER, F.col("p_size") < 25)).select("p_partkey", "a.ok", "a.reason")


@query("p11_file_levels", """SELECT p_partkey, CASE WHEN p_partkey % 6 IN (0, 1, 2) OR p_partkey % 6 = 5 THEN CASE p_partkey % 6 WHEN 5 THEN 'low' ELSE 'reject' END WHEN p_partkey % 6 = 3 THEN 'high' ELSE 'medium' END AS level,
  ['type', 'other person', 'small', 'name and category', 'category', 'name only'][p_partkey % 6 + 1] AS reason FROM part""")
def _(t):
    title = varied("p_partkey", F.col("p_name"), around("Bea Bolt ", ""), F.col("p_name"), around("Ann Bolt ", ""), F.col("p_name"), around("Anna Bolt ", ""))
    mime = F.when(F.col("p_partkey") % 6 == 0, "application/pdf").otherwise("image/JPEG")
    width = F.when(F.col("p_partkey") % 6 == 2, 40).otherwise(900)
    categories = F.when(F.col("p_partkey") % 6 < 5, "Paintings of rings").otherwise("Files")
    return t("part").withColumn("l", rules.file_level(title, mime, width, categories, MAKER)).select("p_partkey", "l.level", "l.reason")


@query("p12_lots", "SELECT p_partkey, p_partkey % 4 IN (0, 2) AS ok FROM part")
def _(t):
    said = varied("p_partkey", around("Ann Bolt, ", ""), around("Ann Bolt junior, ", ""), around("Ann Bolt (1885-1970), not Bea Bolt: ", ""), F.col("p_name"))
    return t("part").select("p_partkey", rules.attributed_lot(said, MAKER).alias("ok"))


@query("p19_checklist", f"WITH {WORKS} SELECT ord FROM works WHERE ord % 7 <> 3 AND ord % 2 = 1 AND contains(lower(title || ' ' || coalesce(year::VARCHAR, '') || ' ' || coalesce(collection, '')), 'ring')")
def _(t):
    d = parts_as_works(t).withColumn("extra", F.col("ord") % 7 == 3).withColumn("status", F.when(F.col("ord") % 2 == 1, "missing").otherwise("have"))
    return browse.checklist(d, "missing", "RING").select("ord")


@query("p22_image_addresses", "SELECT p_partkey, p_partkey % 6 IN (0, 5) AS ok FROM part")
def _(t):
    key = F.col("p_partkey").cast("string")
    url = varied("p_partkey", F.concat(F.lit("http://a/"), key, F.lit(".JPG?x=1")), F.concat(F.lit("http://a/logo"), key, F.lit(".png")), F.concat(F.lit("http://a/thumb/"), key, F.lit(".png")),
                 F.concat(F.lit("http://a/"), key, F.lit(".svg")), F.lit(None).cast("string"), F.concat(F.lit("http://upload.wikimedia.org/"), key))
    return t("part").select("p_partkey", choice.usable_image_url(url).alias("ok"))


@query("p24_artist_notes", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN CASE WHEN p_size > 25 THEN 'seen; ' ELSE '' END || 'listed artist: Bea Bolt' WHEN p_size > 25 THEN 'seen' END AS notes FROM part""")
def _(t):
    artist = varied("p_partkey", "Ann Bolt", "Bea Bolt", " ")
    return t("part").select("p_partkey", rules.mismatch_note(artist, MAKER, F.when(F.col("p_size") > 25, "seen").otherwise("")).alias("notes"))


@query("p27_guarded_rows", "SELECT p_partkey FROM part WHERE p_partkey % 4 IN (0, 1) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def _(t):
    creator = varied("p_partkey", "Ann Bolt", F.lit(None).cast("string"), "Carl Rod", "Ann Bolt junior")
    stored = t("lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return choice.guarded(t("part"), stored, "p_partkey", creator, f"(?i){MAKER.full}", r"(?i)\bjunior\b").select("p_partkey")


# Projections, keyed records, survivorship


@query("p1_renamed_columns", "SELECT c_custkey::VARCHAR AS key, c_name AS title, c_mktsegment AS genre, NULL::INT AS width FROM customer")
def _(t):
    d = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("genre"), F.col("c_acctbal").alias("other"))
    return records.padded(d).select("key", "title", "genre", "width")


@query("p3_public_columns", "SELECT p_partkey, p_name FROM part")
def _(t):
    return records.without_internal(t("part").select("p_partkey", "p_name", F.col("p_size").alias("_size"), F.col("p_type").alias("_type")))


@query("u1_union_by_name", """SELECT p_partkey AS key, p_name AS title, NULL AS maker, p_size AS width FROM part UNION ALL SELECT s_suppkey, NULL, s_name, NULL FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment, NULL FROM customer""")
def _(t):
    return records.union_records(
        t("part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("title"), F.col("p_size").alias("width")), t("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("maker")),
        t("customer").select(F.col("c_mktsegment").alias("maker"), F.col("c_custkey").alias("key"), F.col("c_name").alias("title"))).select("key", "title", "maker", "width")


def _upsert(policy: str):
    def run(t):
        old = t("customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise("").alias("name"), F.col("c_acctbal").alias("balance"))
        new = t("customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.col("c_mktsegment")).alias("name"), F.when(F.col("c_custkey") % 4 == 0, 1.0).alias("balance"))
        return records.upsert(old, new, "key", policy)

    return run


_SIDES = """s AS (SELECT coalesce(o.key, n.key) AS key, n.key IS NOT NULL AS fresh, o.name AS oname, n.name AS nname, o.balance AS obal, n.balance AS nbal FROM
  (SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '' END AS name, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0) o FULL JOIN
  (SELECT c_custkey AS key, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS name, CASE WHEN c_custkey % 4 = 0 THEN 1.0::DOUBLE END AS balance FROM customer WHERE c_custkey % 5 <> 0) n ON o.key = n.key)"""
query("w5_upsert", f"WITH {_SIDES} SELECT key, CASE WHEN fresh THEN nname ELSE oname END AS name, CASE WHEN fresh THEN nbal ELSE obal END AS balance FROM s")(_upsert("replace"))
query("t5_prefer_new", f"WITH {_SIDES} SELECT key, coalesce(nullif(nname, ''), nullif(oname, '')) AS name, coalesce(nbal, obal) AS balance FROM s")(_upsert("prefer_new"))


@query("t6_bounded_state", "SELECT event_id FROM events ORDER BY event_id DESC LIMIT 10000")
def _(t):
    return records.last_n(t("events").select("event_id"), "event_id", 10000)


@query("a28_empty_records", "SELECT n_name AS key, NULL::VARCHAR AS title, NULL::INT AS year, 'low' AS confidence FROM nation")
def _(t):
    return records.padded(t("nation").select(F.col("n_name").alias("key")), confidence="low").select("key", "title", "year", "confidence")


def _survivors(t):
    return merge.survivors(events_as_records(t), "component", ["purchase", "click", "view"])


@query("a4_confidence_of_groups", f"WITH {RECORDS} SELECT component, CASE WHEN bool_or(coalesce(confidence = 'high', false)) THEN 'high' ELSE coalesce(arg_min_null(confidence, _ord), 'low') END AS confidence FROM records GROUP BY component")
def _(t):
    return _survivors(t).select("component", "confidence")


@query("a5_sources_of_groups", f"""WITH {RECORDS} SELECT component, array_to_string(list_sort(list(DISTINCT coalesce(nullif(source, ''), _group))), ' ') AS sources,
  coalesce(array_to_string(list_sort(list(DISTINCT page_url) FILTER (page_url IS NOT NULL)), ' '), '') AS page_urls FROM records GROUP BY component""")
def _(t):
    return _survivors(t).select("component", F.array_join("sources", " ").alias("sources"), F.array_join("page_urls", " ").alias("page_urls"))


@query("a6_duplicates_of_groups", f"""WITH {RECORDS}, b AS (SELECT component, arg_max(local_path, (width::BIGINT * height, -_ord)) AS best FROM records GROUP BY component)
SELECT component, coalesce(array_to_string(list_sort(list(local_path) FILTER (local_path <> best)), ' '), '') AS duplicates FROM records JOIN b USING (component) GROUP BY component""")
def _(t):
    return _survivors(t).select("component", F.array_join("duplicates", " ").alias("duplicates"))


@query("a7_notes_of_groups", f"WITH {RECORDS} SELECT component, array_to_string(list_sort(list(DISTINCT notes) FILTER (notes IS NOT NULL)), ' | ') AS notes FROM records GROUP BY component")
def _(t):
    return _survivors(t).select("component", "notes")


@query("a1_members_of_components", """SELECT root, count(*) AS members FROM (SELECT n_nationkey AS k, n_regionkey AS r FROM nation) n JOIN (SELECT r, min(k) AS root FROM (SELECT n_nationkey AS k, n_regionkey AS r FROM nation) GROUP BY r) USING (r) GROUP BY root""")
def _(t):
    n = t("nation")
    chain = n.alias("a").join(n.alias("b"), F.expr("a.n_regionkey = b.n_regionkey and a.n_nationkey < b.n_nationkey")).select(F.col("a.n_nationkey").alias("u"), F.col("b.n_nationkey").alias("v"))
    return graph.components(chain.union(n.select("n_nationkey", "n_nationkey"))).groupBy("root").agg(F.count("*").alias("members"))


# Colours, vectors, styles


@query("m2_chroma_and_hue", "SELECT vec_id, round(sqrt(a * a + b * b), 6) AS chroma, round(atan2(b, a), 6) AS hue FROM (SELECT vec_id, embedding[1]::DOUBLE AS a, embedding[2]::DOUBLE AS b FROM embeddings)")
def _(t):
    a, b = (F.get("embedding", F.lit(i)).cast("double") for i in (0, 1))
    return t("embeddings").select("vec_id", F.round(vision.chroma(a, b), 6).alias("chroma"), F.round(vision.hue(a, b), 6).alias("hue"))


@query("m7_unit_vectors", "SELECT vec_id, round(embedding[1]::DOUBLE / sqrt(n), 5) AS x0, round(embedding[64]::DOUBLE / sqrt(n), 5) AS x63 FROM (SELECT vec_id, embedding, list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) AS n FROM embeddings)")
def _(t):
    d = t("embeddings").withColumn("u", vision.unit(F.col("embedding")))
    return d.select("vec_id", F.round(F.get("u", F.lit(0)), 5).alias("x0"), F.round(F.get("u", F.lit(63)), 5).alias("x63"))


@query("m10_largest_places", "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INT AS place FROM embeddings")
def _(t):
    return t("embeddings").select("vec_id", vision.argmax(F.col("embedding")).alias("place"))


_SHARES = "s AS (SELECT vec_id, e1 / (e1 + e2 + e3) AS p0, e2 / (e1 + e2 + e3) AS p1, e3 / (e1 + e2 + e3) AS p2 FROM (SELECT vec_id, exp(embedding[1]::DOUBLE) AS e1, exp(embedding[2]::DOUBLE) AS e2, exp(embedding[3]::DOUBLE) AS e3 FROM embeddings))"


def _shares(t):
    return t("embeddings").withColumn("p", vision.softmax(F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))))


@query("m11_ternary_points", f"WITH {_SHARES} SELECT vec_id, round(p1 + 0.5 * p2, 6) AS x, round(1 - p2, 6) AS y FROM s")
def _(t):
    return _shares(t).withColumn("q", vision.ternary(F.col("p"))).select("vec_id", F.round("q.x", 6).alias("x"), F.round("q.y", 6).alias("y"))


@query("m12_rounded_half_even", "SELECT p_partkey, round_even((2 * p_partkey + 1) / 32, 4)::DOUBLE AS share FROM part")
def _(t):
    return t("part").select("p_partkey", vision.rounded((2 * F.col("p_partkey") + 1) / 32).alias("share"))


@query("m14_unsure_styles", f"WITH {_SHARES} SELECT vec_id, round(greatest(p0, p1, p2), 6) AS share FROM s WHERE greatest(p0, p1, p2) < 0.45")
def _(t):
    return choice.unsure(_shares(t).withColumn("share", F.array_max("p")), "share").select("vec_id", F.round("share", 6).alias("share"))


@query("a20_image_spread", "SELECT label, round(avg(x) / 100, 7) AS mean, round(stddev_pop(x) / 40, 7) AS spread FROM (SELECT label, embedding[1]::DOUBLE * 100 AS x FROM embeddings) GROUP BY label")
def _(t):
    L = F.get("embedding", F.lit(0)).cast("double") * 100
    v = vision.pixel_features(L, F.lit(0.0), F.lit(0.0), F.col("vec_id") % 9, F.lit(9))
    return t("embeddings").groupBy("label").agg(F.round(v["v0"], 7).alias("mean"), F.round(v["v3"], 7).alias("spread"))


@query("a21_sky", "SELECT label, round((avg(x) FILTER (vec_id % 9 < 3) - avg(x) FILTER (vec_id % 9 >= 6)) / 40, 7) AS sky FROM (SELECT label, vec_id, embedding[1]::DOUBLE * 100 AS x FROM embeddings) GROUP BY label")
def _(t):
    L = F.get("embedding", F.lit(0)).cast("double") * 100
    v = vision.pixel_features(L, F.lit(0.0), F.lit(0.0), F.col("vec_id") % 9, F.lit(9))
    return t("embeddings").groupBy("label").agg(F.round(v["v9"], 7).alias("sky"))


# Choices


@query("o2_undated_last", f"WITH {WORKS} SELECT ord, (rank() OVER (PARTITION BY collection ORDER BY year IS NULL, year, lower(title)))::INT AS place FROM works")
def _(t):
    return parts_as_works(t).select("ord", F.rank().over(Window.partitionBy("collection").orderBy(*choice.undated_last(F.col("year"), F.col("title")))).alias("place"))


@query("o6_best_scored_image", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'http://raw/' || p_partkey || '.png' WHEN p_size * 2 >= 40 THEN 'http://a/resize/' || p_size || 'x2/i.jpg' ELSE 'http://b/resize/4x10/i.webp' END AS url FROM part")
def _(t):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    wrapped = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('<img src="http://c/resize/90x90/?url=http%3A%2F%2Fraw%2F'), key, F.lit('.png">'))).otherwise("")
    html = F.concat(F.lit('<img src="http://a/resize/'), size, F.lit('x2/i.jpg"> <img src="http://b/resize/4x10/i.webp"> <a href="http://d/none.gif">'), wrapped)
    return t("part").select("p_partkey", choice.best_linked_image(html).alias("url"))


@query("o7_largest_variants", "SELECT p_partkey, CASE WHEN p_size >= 20 THEN 'a' ELSE 'b' END AS url FROM part")
def _(t):
    variant = lambda n, s: F.struct(F.lit(n).alias("url"), s.cast("int").alias("bytes"))
    return t("part").select("p_partkey", choice.largest(F.array(variant("n", F.lit(None)), variant("a", F.col("p_size")), variant("b", F.lit(20)))).alias("url"))


@query("s28_largest_files", "SELECT l_orderkey, arg_max(l_linenumber, (l_quantity, -l_linenumber)) AS l_linenumber, max(l_quantity) AS l_quantity FROM lineitem GROUP BY l_orderkey")
def _(t):
    return choice.largest_rows(t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_orderkey", "l_quantity", "l_linenumber")


@query("o9_priority_first", "SELECT p_partkey, (row_number() OVER (PARTITION BY p_brand ORDER BY contains(p_name, 'ring') DESC, p_name, p_partkey))::INT AS place FROM part")
def _(t):
    order = [*choice.priority_order(F.col("p_name").contains("ring"), F.col("p_name")), F.col("p_partkey")]
    return t("part").select("p_partkey", F.row_number().over(Window.partitionBy("p_brand").orderBy(*order)).alias("place"))


@query("o10_full_variants", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '/a/full/' WHEN 1 THEN '/a' END AS url FROM part")
def _(t):
    urls = F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit("/a"), F.lit("/a/full/"), F.lit("/b/full"))).when(F.col("p_partkey") % 3 == 1, F.array(F.lit("/a"), F.lit("/b"))).otherwise(F.array().cast("array<string>"))
    return t("part").select("p_partkey", choice.full_variant(urls).alias("url"))


@query("s35_candidate_lists", "SELECT p_partkey, 'x' || p_partkey || ' a' || CASE WHEN p_partkey % 2 = 0 THEN ' ' || p_name ELSE '' END AS list FROM part WHERE p_name NOT LIKE '%x%'")
def _(t):
    urls = F.array(F.lit("a"), F.concat(F.lit("x"), F.col("p_partkey").cast("string")), F.lit("a"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.lit("a")), F.lit("last"))
    out = choice.candidate_list(F.slice(urls, 1, 4), lambda u: u.rlike(r"^x\d"), 30)
    return t("part").where(~F.col("p_name").contains("x")).select("p_partkey", F.array_join(out, " ").alias("list"))


@query("s39_first_success", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'one' WHEN p_partkey % 3 = 0 THEN 'two' END AS url FROM part")
def _(t):
    attempt = lambda n, ok: F.struct(F.lit(n).alias("url"), ok.alias("ok"))
    none = F.lit(None).cast("boolean")
    return t("part").select("p_partkey", choice.first_success(F.array(attempt("zero", none), attempt("one", F.col("p_partkey") % 2 == 0), attempt("two", F.col("p_partkey") % 3 == 0))).alias("url"))


@query("u5_first_under_folded_key", "SELECT replace(lower(p_name), '_', ' ') AS name_key, min(p_partkey) AS p_partkey FROM part GROUP BY 1")
def _(t):
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper(F.translate("p_name", " ", "_"))).otherwise(F.concat(F.lit(" "), F.col("p_name")))
    return choice.first_under(t("part").select("p_partkey", name.alias("n")), F.col("n"), "p_partkey").select("name_key", "p_partkey")


@query("j14_differing_keys", "SELECT k, 'left' AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL SELECT k, 'right' FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders)")
def _(t):
    return choice.listing_differences(t("orders").select(F.col("o_custkey").alias("k")), t("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")), "k")


@query("j13_larger_sizes", """SELECT p_partkey, CASE WHEN w > p_size THEN w ELSE p_size END AS width, CASE WHEN w > p_size THEN h ELSE 7 END AS height FROM part LEFT JOIN
  (SELECT l_partkey, max(l_quantity)::INT AS w, arg_max(l_linenumber, (l_quantity, l_linenumber))::INT AS h FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey""")
def _(t):
    found = t("lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_quantity").cast("int").alias("width"), F.col("l_linenumber").alias("height"))
    return choice.larger_size(t("part").select("p_partkey", F.col("p_size").alias("width"), F.lit(7).alias("height")), found, "p_partkey")


# Stored pages and files


def _pages_of_parts(t):
    y = (1905 + F.col("p_partkey") % 60).cast("string")
    name, key = F.initcap("p_name"), F.col("p_partkey").cast("string")
    html = F.concat(
        F.lit("<html><h2 class=t> <b>"), name, F.lit(", c. "), y, F.lit("</b></h2><p>See <i>"), name, F.lit("</i> ("), y, F.lit("-1969).</p><ul><li><a>Big "), name, F.lit(", "), y,
        F.lit("</a></li></ul><figure><img src='/i/"), key, F.lit(".jpg'><figcaption>The <em>"), name, F.lit("</em>  view</figcaption></figure><a href=\"/w/"), key, F.lit("\">work</a><a href='/about'>us</a>"),
    )
    return t("part").select("p_partkey", html.alias("html"))


_CAP = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("s9_titles_in_pages", f"""SELECT p_partkey, {_CAP} AS title, (1905 + p_partkey % 60)::INT AS year, (1905 + p_partkey % 60) || '-1969' AS year_range FROM part
UNION ALL SELECT p_partkey, {_CAP}, (1905 + p_partkey % 60)::INT, (1905 + p_partkey % 60)::VARCHAR FROM part UNION ALL SELECT p_partkey, 'Big ' || {_CAP}, (1905 + p_partkey % 60)::INT, (1905 + p_partkey % 60)::VARCHAR FROM part""")
def _(t):
    return pages.titles(_pages_of_parts(t))


@query("s10_dated_headings", f"SELECT p_partkey, {_CAP} AS title, (1905 + p_partkey % 60)::INT AS year FROM part")
def _(t):
    return pages.dated_headings(_pages_of_parts(t)).select("p_partkey", "title", "year")


@query("s38_figures", f"SELECT p_partkey, '/i/' || p_partkey || '.jpg' AS src, 'The ' || {_CAP} || ' view' AS caption FROM part")
def _(t):
    return pages.figures(_pages_of_parts(t))


@query("s38_links", "SELECT p_partkey, '/w/' || p_partkey AS href, 'work' AS label FROM part")
def _(t):
    return pages.links(_pages_of_parts(t), r"^/w/\d+$")


@query("s25_sitemaps", "SELECT p_brand, 'http://s/' || p_size || '?a=1&b=' || p_brand AS loc FROM part GROUP BY p_brand, p_size")
def _(t):
    entry = F.concat(F.lit("<url><loc> http://s/"), F.col("p_size").cast("string"), F.lit("?a=1&amp;b="), F.col("p_brand"), F.lit("\n</loc></url>"))
    files = t("part").select("p_brand", entry.alias("e")).distinct().groupBy("p_brand").agg(F.array_join(F.collect_list("e"), "").alias("xml"))
    return pages.sitemap(files, "xml", r"^http://s/").select("p_brand", "loc")


@query("s11_sources_by_prefix", "SELECT p_partkey, CASE WHEN p_name LIKE 'red%' THEN 'http://red' WHEN p_name LIKE 'old%' THEN 'http://old' ELSE 'file:' || p_name END AS source FROM part")
def _(t):
    return t("part").select("p_partkey", pages.source_by_prefix(F.col("p_name"), [("red", "http://red"), ("old", "http://old")]).alias("source"))


@query("s24_page_walk", "WITH RECURSIVE r(n, depth) AS (SELECT 1::BIGINT, 0 UNION ALL SELECT CASE k WHEN 0 THEN 2 * n ELSE 2 * n + 1 END, depth + 1 FROM r, (VALUES (0), (1)) v(k) WHERE CASE k WHEN 0 THEN 2 * n ELSE 2 * n + 1 END < (SELECT count(*) FROM supplier)) SELECT 'http://h/' || n AS node, depth::INT AS depth FROM r")
def _(t):
    key = F.col("s_suppkey")
    link = lambda to: F.concat(F.lit('<a href="HTTP://H/'), to.cast("string"), F.lit('/#x">'))
    stored = t("supplier").select(F.concat(F.lit("http://h/"), key.cast("string"), F.lit("/")).alias("url"), F.concat(link(key * 2), link(key * 2 + 1), link(F.floor(key / 2))).alias("html"))
    start = t("region").where("r_regionkey = 0").select(F.lit("http://h/1").alias("url"))
    return pages.walk(stored.where("url <> 'http://h/0/'"), start, r'<a href="([^"]+)"')


@query("s36_seed_details", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title, CASE WHEN p_partkey % 2 = 0 THEN 'oil on board' END AS medium, CASE WHEN p_partkey % 2 = 0 THEN p_size || ' x 20 cm' END AS dimensions,
  CASE WHEN p_partkey % 2 = 0 THEN 'http://i/' || p_partkey || '.jpg' END AS image_url FROM part""")
def _(t):
    key = F.col("p_partkey").cast("string")
    html = F.concat(F.lit('<meta property="og:image" content="http://i/'), key, F.lit('.jpg"><h1><a>'), F.col("p_name"), F.lit("</a></h1><p>Oil on board, "), F.col("p_size").cast("string"), F.lit(" x 20 cm</p>"))
    stored = t("part").where("p_partkey % 2 = 0").select(F.concat(F.lit("http://s/"), key, F.lit("/")).alias("url"), html.alias("html"))
    seeds = t("part").select("p_partkey", F.concat(F.lit("HTTP://S/"), key).alias("url"))
    return pages.details(seeds, stored).select("p_partkey", "title", "medium", "dimensions", "image_url")


@query("s40_cached_pages", "SELECT url, octet_length(encode(html)) AS bytes, page_id % 2 = 0 AS cached FROM pages WHERE page_id % 2 = 0 OR page_id % 3 = 0")
def _(t):
    p = t("pages").select("page_id", F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("u"), "url", "html")
    stored = p.where("page_id % 2 = 0").select("u", "html").union(p.where("page_id % 3 = 0 and page_id % 2 = 1").select("u", F.lit("error")))
    out = pages.cached(p.where("page_id % 3 = 0").select("u", "html"), stored, "u")
    return out.select(F.regexp_replace("u", r"#\d+$", "").alias("url"), F.octet_length("html").cast("long").alias("bytes"), "cached")


@query("s16_paged_listing", "SELECT p_partkey FROM part WHERE p_partkey // 40 + 1 < (SELECT min(p) FROM (SELECT p_partkey // 40 + 2 AS p, count(*) AS n FROM part GROUP BY 1) WHERE n < 40 OR p NOT IN (SELECT p_partkey // 40 + 1 FROM part))")
def _(t):
    listed = t("part").select("p_partkey", (F.floor(F.col("p_partkey") / 40) + 1).alias("page"), F.col("p_partkey").alias("pos"))
    return pages.complete_listing(listed, "p_partkey", full_page=40).select("p_partkey")


@query("s7_query_bindings", "SELECT c_custkey::VARCHAR AS key, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def _(t):
    value = lambda c: F.struct(c.cast("string").alias("value"))
    row = F.struct(value(F.col("c_custkey")).alias("key"), value(F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 2 == 0, value(F.col("c_mktsegment"))).alias("segment"))
    text = F.to_json(F.struct(F.struct(F.array(row).alias("bindings")).alias("results")))
    return t("customer").select(F.inline(readers.flat_bindings(text, ["key", "name", "segment"])))


@query("s14_inline_rows", "SELECT * FROM (VALUES ('k1', 'Ring', 1920), ('k2', 'Bolt', NULL)) v(key, title, year)")
def _(t):
    return readers.inline_table(t("region").sparkSession, [("k1", "Ring", 1920), ("k2", "Bolt", None)], "key string, title string, year int")


@query("s22_page_images", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'http://o/' || p_partkey || '.jpg' ELSE 'http://i/' || p_partkey || '.png' END AS image FROM part")
def _(t):
    key = F.col("p_partkey").cast("string")
    social = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit('<meta property="og:image" content="http://o/'), key, F.lit('.jpg">'))).otherwise("")
    html = F.concat(social, F.lit('<img src="http://i/logo.png"><img alt=x src="http://i/'), key, F.lit('.png">'))
    return t("part").select("p_partkey", readers.page_image(html).alias("image"))


@query("s34_nested_images", "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN 'http://i/' || p_partkey || '.jpg' END AS image FROM part")
def _(t):
    key = F.col("p_partkey").cast("string")
    text = varied("p_partkey", F.concat(F.lit('{"id": 5, "a": [{"b": {"@id": "http://i/'), key, F.lit('.jpg"}}]}')), F.concat(F.lit('[{"id": "http://i/'), key, F.lit('.jpg"}, {"id": "z.jpg"}]')), "{bad")
    return t("part").select("p_partkey", readers.nested_image(text).alias("image"))


@query("k4_assignment_script", "SELECT n_nationkey, 'window.ROW = {\"n_name\":\"' || n_name || '\",\"n_regionkey\":' || n_regionkey || '};' AS script FROM nation")
def _(t):
    return t("nation").select("n_nationkey", sinks.assignment("ROW", F.struct("n_name", "n_regionkey")).alias("script"))


def _written(t, name: str, write, read):
    """What reading gives after writing to the shared folder."""
    spark = t("region").sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    write(path)
    return read(spark, path)


@query("k1_json_lines", "SELECT doc_id::VARCHAR AS key, text AS title, NULL::INT AS year FROM documents")
def _(t):
    d = records.padded(t("documents").select(F.col("doc_id").alias("key"), F.col("text").alias("title")))
    return _written(t, "json", lambda p: sinks.write_records(d, p), readers.read_records).select("key", "title", "year")


@query("k2_csv_projection", "SELECT c_custkey::VARCHAR AS key, c_name AS title, NULL::VARCHAR AS source FROM customer")
def _(t):
    d = t("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"), F.array(F.lit("x")).alias("unlisted"))
    columns = ["key", "source", "title"]
    return _written(t, "csv", lambda p: sinks.write_csv(d, p, columns), lambda s, p: readers.read_csv(s, p, "key string, source string, title string"))


@query("k5_rejected_rows", "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_type = 'PROMO' THEN 'promo' END AS reason FROM part WHERE p_size < 10 OR p_type = 'PROMO'")
def _(t):
    kept, rejected = rules.kept_and_rejected(t("part").select("p_partkey", "p_size", "p_type"), [rules.Rule("small", F.col("p_size") < 10), rules.Rule("promo", F.col("p_type") == "PROMO")])
    return _written(t, "parted", lambda p: sinks.write_parted(kept, rejected, p), lambda s, p: s.read.schema("p_partkey long, reason string").json(f"{p}/rejected"))


@query("k6_report", "SELECT count(*)::BIGINT AS parts, sum(p_size)::BIGINT AS sizes FROM part")
def _(t):
    one = t("part").agg(F.count("*").alias("parts"), F.sum("p_size").alias("sizes"))
    return _written(t, "report", lambda p: sinks.write_report(one, p), lambda s, p: s.read.schema("parts long, sizes long").json(p))


# Browsing joins


@query("j10_images_with_points", "SELECT p_partkey AS id FROM part JOIN (SELECT DISTINCT vec_id FROM embeddings) ON vec_id = p_partkey")
def _(t):
    return browse.facet(t("part").select(F.col("p_partkey").alias("id")), t("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster")))


@query("j11_names_of_clusters", "SELECT label AS id, 'c' || label AS name, count(*) AS n FROM embeddings GROUP BY label")
def _(t):
    points = t("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"))
    clusters = t("embeddings").select(F.col("label").alias("id"), F.concat(F.lit("c"), F.col("label").cast("string")).alias("name")).distinct()
    return browse.facet_counts(points, clusters).where("id >= 0").select("id", "name", "n")


@query("j19_preferred_editions", "SELECT p_name, arg_min(p_partkey, (CASE p_type WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 ELSE 99 END, p_partkey)) AS p_partkey FROM part GROUP BY p_name")
def _(t):
    order = F.struct(rules.preferred(F.col("p_type"), ["PROMO", "SMALL"]).alias("r"), "p_partkey")
    return t("part").groupBy("p_name").agg(F.min_by("p_partkey", order).alias("p_partkey"))


@query("s21_search_results", """SELECT 'one' AS engine, p_brand AS query, p_name AS title, 'http://i/' || p_partkey AS image_url, NULL::VARCHAR AS page_url, p_size AS width, NULL::INT AS height
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part) WHERE n <= 5 UNION ALL SELECT 'two', s_suppkey::VARCHAR, s_name, NULL, 'http://p/' || s_suppkey, NULL, NULL FROM supplier""")
def _(t):
    one = t("part").withColumn("i", F.concat(F.lit("http://i/"), F.col("p_partkey").cast("string")))
    two = t("supplier").withColumn("p", F.concat(F.lit("http://p/"), F.col("s_suppkey").cast("string")))
    a = pages.search_results(one, "one", {"query": "p_brand", "title": "p_name", "image_url": "i", "width": "p_size"}, 5, "p_partkey")
    return records.union_records(a, pages.search_results(two, "two", {"query": "s_suppkey", "title": "s_name", "page_url": "p"}))


@query("s23_images_of_links", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'http://own' WHEN 1 THEN 'http://i/' || p_partkey || '.png' END AS image_url FROM part")
def _(t):
    key = F.col("p_partkey").cast("string")
    found = t("part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, "http://own").otherwise("").alias("image_url"), F.concat(F.lit("http://S/"), key).alias("page_url"))
    stored = t("part").where("p_partkey % 3 < 2").select(F.concat(F.lit("http://s/"), key, F.lit("/")).alias("url"), F.concat(F.lit('<img src="/logo.png"><img src="http://i/'), key, F.lit('.png">')).alias("html"))
    return pages.linked_images(found, stored).select("p_partkey", "image_url")


@query("s37_repaired_paths", "SELECT p_partkey, 'museum/' || p_partkey || '.jpg' AS path FROM part")
def _(t):
    key = F.concat(F.col("p_partkey").cast("string"), F.lit(".jpg"))
    path = varied("p_partkey", key, F.concat(F.lit("museum/"), key), F.concat(F.lit("./"), key), F.concat(F.lit("/museum/"), key))
    return t("part").select("p_partkey", pages.repaired_path(path, "museum").alias("path"))


@query("s17_continued_responses", "SELECT n_nationkey FROM nation WHERE n_nationkey < 20")
def _(t):
    token = lambda n: F.concat(F.lit("t"), n.cast("string"))
    k = F.col("n_nationkey")
    stored = t("nation").select("n_nationkey", F.when(k > 0, token(k)).alias("given"), F.when(k == 19, "").otherwise(token(k + 1)).alias("following"))
    return pages.continued(stored).select("n_nationkey")


@query("s41_plain_listing", "SELECT p_name AS title, p_partkey % 60 + 1905 AS year, count(*) AS n FROM part GROUP BY ALL")
def _(t):
    listed = t("part").select(F.to_json(F.struct(F.col("p_name").alias("title"), (F.col("p_partkey") % 60 + 1905).alias("year"))).alias("line"))
    return listed.select(F.from_json("line", "title string, year long").alias("r")).groupBy("r.title", "r.year").agg(F.count("*").alias("n"))


@query("p25_allowed_addresses", """SELECT page_id, host NOT LIKE '%.com' OR starts_with(path, '/en/1') OR NOT starts_with(path, '/en') AS allowed
FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^#]*)', 1) AS path FROM pages)""")
def _(t):
    p = t("pages").select("page_id", "url")
    hosts = p.select(X.host_of(F.col("url")).alias("host")).distinct().where("host like '%.com'")
    rule = F.explode(F.array(*(F.struct(F.lit(a).alias("path"), F.lit(b).alias("allow")) for a, b in (("/en", False), ("/en/1", True), ("/", True), ("", False)))))
    return pages.allowed(p, hosts.select(F.upper("host").alias("host"), rule.alias("r")).select("host", "r.*")).select("page_id", "allowed")


# Stored listings, checked blobs and resumable state

BRAND_PAGES = "(SELECT p_brand AS listing, ((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 + 1)::INT AS page, ((row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) % 10)::INT AS pos, p_partkey, p_name FROM part)"


def brand_pages(t) -> DataFrame:
    """The parts of each brand, ten a page."""
    n = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey")) - 1
    return t("part").select("p_brand", "p_partkey", "p_name", (F.floor(n / 10) + 1).cast("int").alias("page"))


def in_scratch(t, table: str, name: str) -> str:
    return f"{scratch_dir(t(table).sparkSession)}/{name}-{uuid.uuid4().hex}"


@query("s16_listing_source", f"SELECT listing, page, pos, p_partkey, p_name FROM {BRAND_PAGES}")
def _(t):
    items, path = brand_pages(t), in_scratch(t, "part", "listing")
    stores.store_listing(items, path, "p_brand", "page", "p_partkey", F.struct("p_partkey", "p_name"))
    found = stores.read_listings(items.sparkSession, path)
    return found.select("listing", "page", "pos", F.from_json("item", "p_partkey long, p_name string").alias("i")).select("listing", "page", "pos", "i.*")


@query("s16_one_listing", f"SELECT page, pos, p_partkey FROM {BRAND_PAGES} WHERE listing IN ('Brand#1', 'Brand#12')")
def _(t):
    items, path = brand_pages(t), in_scratch(t, "part", "listing")
    stores.store_listing(items, path, "p_brand", "page", "p_partkey", F.struct("p_partkey", "p_name"))
    found = stores.read_listings(items.sparkSession, path).where(F.col("listing").isin("Brand#1", "Brand#12"))
    return found.select("page", "pos", F.from_json("item", "p_partkey long")["p_partkey"].alias("p_partkey"))


@query("s17_listing_stream", f"SELECT listing, page, pos, p_partkey FROM {BRAND_PAGES}")
def _(t):
    """Two pages of each listing are stored and read, then the rest: the second run goes on from the offsets of the first."""
    items, path = brand_pages(t), in_scratch(t, "part", "listing")
    for pages in (F.col("page") <= 2, F.col("page") > 2):
        stores.store_listing(items, path, "p_brand", "page", "p_partkey", F.struct("p_partkey"), pages)
        stream = stores.stream_listings(items.sparkSession, path)
        stream.writeStream.format("parquet").option("path", f"{path}-read").option("checkpointLocation", f"{path}-log").trigger(availableNow=True).start().awaitTermination()
    return items.sparkSession.read.parquet(f"{path}-read").select("listing", "page", "pos", F.from_json("item", "p_partkey long")["p_partkey"].alias("p_partkey"))


def customer_blobs(t) -> DataFrame:
    """A blob a customer: PNG and JPEG signatures before the name of the segment or customer, plain text, or nothing."""
    k = F.col("c_custkey") % 5
    start = F.when(k == 0, F.unhex(F.lit("89504E470D0A1A0A"))).when(k == 1, F.unhex(F.lit("FFD8FF"))).when(k == 2, F.lit("").cast("binary")).when(k == 3, F.lit("GIF89a").cast("binary"))
    name = F.when(k == 1, F.col("c_mktsegment")).otherwise(F.col("c_name")).cast("binary")
    return t("customer").select("c_custkey", F.concat(start, name).alias("content"))


def stored_customers(t) -> str:
    path = in_scratch(t, "customer", "blobs")
    stores.write_blobs(customer_blobs(t), path, F.col("content"), F.col("c_custkey"))
    stores.write_blobs(customer_blobs(t).where("content is not null and c_custkey % 5 <> 2"), path, F.col("content"), F.col("c_custkey"))  # again: nothing is new
    return path


@query("k10_checked_blobs", r"""SELECT substr(sha256(content), 1, 16) || ending AS name, sha256(content) AS sha256, octet_length(content) AS bytes FROM (
  SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN '\x89PNG\x0D\x0A\x1A\x0A'::BLOB || c_name::BLOB WHEN 1 THEN '\xFF\xD8\xFF'::BLOB || c_mktsegment::BLOB ELSE 'GIF89a'::BLOB || c_name::BLOB END AS content,
         CASE c_custkey % 5 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.gif' END AS ending
  FROM customer WHERE c_custkey % 5 IN (0, 1, 3))""")
def _(t):
    found = stores.blob_files(t("customer").sparkSession, stored_customers(t))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


@query("k10_rejected_blobs", "SELECT c_custkey::VARCHAR AS key, CASE WHEN c_custkey % 5 = 2 THEN 'not of a wanted kind' ELSE 'no content' END AS reason, CASE WHEN c_custkey % 5 = 2 THEN octet_length(c_name::BLOB) ELSE 0 END AS bytes FROM customer WHERE c_custkey % 5 IN (2, 4)")
def _(t):
    return stores.rejected(t("customer").sparkSession, stored_customers(t))


CLOSED = """c AS (SELECT user_id, min(event_id) AS closed FROM events WHERE event_type = 'purchase' GROUP BY user_id),
k AS (SELECT user_id, event_type, ord, row_number() OVER (PARTITION BY user_id ORDER BY ord) AS n
      FROM (SELECT user_id, event_type, min(event_id) AS ord FROM events GROUP BY ALL) LEFT JOIN c USING (user_id) WHERE closed IS NULL OR ord <= closed)"""


def logged_events(t) -> tuple[str, str]:
    """A log over ``events`` in two runs: the second finds the state of the first in the checkpoint."""
    events, path = t("events"), in_scratch(t, "events", "done-log")
    spark = events.sparkSession
    half = events.agg(F.floor((F.min("event_id") + F.max("event_id")) / 2)).first()[0] or 0
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        events.where(part).write.mode("append").parquet(f"{path}/in")
        told = done_log.done_log(spark.readStream.schema(events.schema).parquet(f"{path}/in"), "user_id", "event_type", "event_id", ["purchase"])
        done_log.run_log(told, f"{path}/told", f"{path}/log").awaitTermination()
    return f"{path}/told", f"{path}/log"


@query("t3_done_log", f"""WITH {CLOSED} SELECT user_id::VARCHAR AS key, 'item' AS kind, event_type AS item, ord, n AS n_items FROM k
UNION ALL SELECT user_id::VARCHAR, 'done', NULL, closed, (SELECT count(*) FROM k WHERE k.user_id = c.user_id) FROM c""")
def _(t):
    return t("events").sparkSession.read.parquet(logged_events(t)[0]).select("key", "kind", "item", "ord", "n_items")


@query("t8_saved_state", f"WITH {CLOSED} SELECT user_id::VARCHAR AS key, count(*) AS n_items, coalesce(any_value(closed), -1) AS closed FROM k LEFT JOIN c USING (user_id) GROUP BY user_id")
def _(t):
    return done_log.saved_state(t("events").sparkSession, logged_events(t)[1])


# Elements of pages


@query("s30_nav_links", """SELECT page_id, unnest(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<a href="([^"]*)"', 1)) AS href FROM pages""")
def _(t):
    found = markup.nodes(t("pages"))
    return markup.selected(found, "nav > ul li a[href]").select("page_id", F.element_at("attrs", "href").alias("href"))


@query("s30_page_fields")
def _(t):
    """What the extractor of one site asks of its pages, as selectors."""
    found = stage(markup.nodes(t("pages")), "elements")
    return markup.extracted(found, {"title": "article h1", "lang": "html@lang", "charset": "meta[charset]@charset", "bold": "article > p b, article > p strong", "links[]": "article a[href], nav a[href]@href"})


@query("s30_elements_by_tag")
def _(t):
    found = markup.nodes(t("pages")).where("node > 0")
    return found.groupBy("tag").agg(F.count("*").alias("n"), F.max("depth").cast("long").alias("deepest"), F.sum((F.col("last") - F.col("node")).cast("long")).alias("inside"))


@query("p25_paced_requests", """WITH n AS (SELECT event_id, event_type, epoch_us(ts) AS asked, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS k FROM events)
SELECT event_id, max(asked - k * 1800000000) OVER (PARTITION BY event_type ORDER BY asked, event_id) + k * 1800000000 AS starts FROM n""")
def _(t):
    """Each type of event as a host that takes a request every half hour; blocks of a day."""
    asked = t("events").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("asked"))
    return pacing.paced(asked, "event_type", "asked", "event_id", 1_800_000_000, 86_400_000_000).select("event_id", "starts")


# Answers of several APIs


PROBES = [
    probes.Probe("view", total="$.info.total"),
    probes.Probe("error", total="$.totalResults"),
    probes.Probe("click", items="$.data", fields={"id": "$.id", "title": "$.title", "artist": "$.artist.name"}, keep=lambda c: F.lower(c("artist")).contains("bolt")),
    probes.Probe("purchase", items="$.response.rows", fields={"id": "$.objectID", "title": ("$.label", "$.names[0]"), "image": "$.images[0].url"}),
    probes.Probe("signup", total="$.total"),
]


def answers(t) -> DataFrame:
    """(name, status, asked, body): each event as an answer of its type's API, of k matches; each page as one of a source that gives no JSON.

    Events are dealt over all tasks while they are narrow: a body is some hundred times as long as its row.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    json = lambda **c: F.to_json(F.struct(*(x.alias(n) for n, x in c.items())))
    each = lambda f: F.transform(F.array_repeat(F.col("event_id"), k), f)
    click = each(lambda e, i: F.struct((e * 10 + i).alias("id"), F.concat(F.lit("t"), i.cast("string")).alias("title"), F.struct(F.when((F.col("user_id") + i) % 3 == 0, "Ann BOLT").otherwise("Bea Holt").alias("name")).alias("artist")))
    bought = each(lambda e, i: F.struct(
        F.concat_ws("-", F.lit("o"), e.cast("string"), i.cast("string")).alias("objectID"), F.when(i % 2 == 0, " ").otherwise("label").alias("label"), F.array(F.concat(F.lit("name "), i.cast("string"))).alias("names"),
        F.when(i % 3 > 0, F.array(F.struct(F.concat(F.lit("http://h/"), F.col("user_id").cast("string")).alias("url")))).alias("images"),
    ))
    kind = F.col("event_type")
    body = (
        F.when(kind == "view", json(info=json_struct(total=k))).when(kind == "error", F.when(k == 3, '{"totalResults": 3').otherwise(json(totalResults=k)))
        .when(kind == "click", json(data=click)).when(kind == "purchase", json(response=json_struct(rows=bought))).otherwise("key required")
    )
    rows = dealt(t("events").select("event_id", "user_id", "event_type", "props"), "event_id")
    events = rows.select(kind.alias("name"), F.when(kind == "signup", 401 + k % 2 * 2).otherwise(200).alias("status"), F.col("event_id").alias("asked"), body.alias("body"))
    return events.unionByName(t("pages").select(F.lit("page").alias("name"), F.lit(200).alias("status"), F.col("page_id").alias("asked"), F.col("html").alias("body")))


def json_struct(**columns: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in columns.items()))


ASKED = "e AS (SELECT event_type AS name, event_id, user_id, (props::JSON->>'k')::INT AS k FROM events)"


@query("s29_probe_report", f"""WITH {ASKED}, n AS (SELECT name, k, CASE name WHEN 'click' THEN (SELECT count(*) FROM range(k) r(i) WHERE (user_id + i) % 3 = 0) ELSE k END AS n FROM e)
SELECT name, count(*) AS probed, CASE WHEN name = 'signup' THEN count(*) ELSE 0 END AS refused, CASE WHEN name = 'error' THEN count(*) FILTER (k = 3) ELSE 0 END AS unread,
  CASE WHEN name <> 'signup' THEN sum(n) FILTER (name <> 'error' OR k <> 3) END::BIGINT AS works, works > 0 AS holds,
  CASE WHEN name = 'signup' THEN 'status ' || string_agg(DISTINCT 401 + k % 2 * 2, ', ' ORDER BY 401 + k % 2 * 2) END AS detail FROM n GROUP BY name
UNION ALL SELECT 'page', count(*), 0, count(*), NULL, NULL, NULL FROM pages""")
def _(t):
    return probes.report(answers(t), PROBES)


@query("s29_probe_items", f"""WITH {ASKED}, i AS (SELECT *, unnest(range(k)) AS place FROM e WHERE name IN ('click', 'purchase'))
SELECT name, 200 AS status, event_id AS asked, place::INT AS place, (event_id * 10 + place)::VARCHAR AS id, 't' || place AS title, 'Ann BOLT' AS artist, NULL AS image FROM i WHERE name = 'click' AND (user_id + place) % 3 = 0
UNION ALL SELECT name, 200, event_id, place::INT, 'o-' || event_id || '-' || place, CASE WHEN place % 2 = 0 THEN 'name ' || place ELSE 'label' END, NULL, CASE WHEN place % 3 > 0 THEN 'http://h/' || user_id END FROM i WHERE name = 'purchase'""")
def _(t):
    return probes.items(answers(t), PROBES)

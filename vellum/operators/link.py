"""Fuzzy linkage of items to works, suggestions and lookups.

Candidates come from equi-joins on what a sufficient score implies, so that no
item is compared with every work: equal years and lengths near enough for the
score, or a piece of text that both have. Scores are then exact, so the joins lose no match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import fuzzy
from vellum.functions.text import is_generic
from vellum.operators.retrieve import best_options
from vellum.scratch import stage

#: Least scores: same year, adjacent year, a year missing. Fixed values.
SAME_YEAR, NEXT_YEAR, UNDATED = 88.0, 99.0, 96.0
#: Scores this near to the best count as ties when years are compared.
NEAR = 2.0


def length_bucket(n: Column, least: float) -> Column:
    """Buckets such that lengths whose ratio allows a score of ``least`` are in equal or adjacent ones."""
    step = math.log((200 - least) / least)
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / step).cast("int")


def sorted_words(text: Column) -> Column:
    """The words of a text in order, joined by one space: what the token-sort ratio compares."""
    return F.array_join(F.array_sort(F.filter(F.split(text, r"\s+"), lambda x: x != "")), " ")


def letters(text: Column) -> Column:
    """Three sets of 64 bits: the letters that a text has once, twice and three times at least.

    A bit that only one of two texts has is a letter to insert or delete.
    """
    none = F.lit(0).cast("long")
    start = F.struct(none.alias("a"), none.alias("b"), none.alias("c"))

    def add(m: Column, ch: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(ch) % 39)  # parts small letters and digits
        return F.struct(
            m["a"].bitwiseOR(bit).alias("a"), m["b"].bitwiseOR(m["a"].bitwiseAND(bit)).alias("b"), m["c"].bitwiseOR(m["b"].bitwiseAND(bit)).alias("c")
        )

    return F.aggregate(F.split(text, ""), start, add)


def _near(bucket: Column) -> Column:
    return F.explode(F.array(bucket - 1, bucket, bucket + 1))


def _within(a: str, b: str, la: str, lb: str, least: float) -> Column:
    """A necessary condition for a score of ``least``: lengths and letters leave few enough insertions and deletions."""
    odd = sum((F.bit_count(F.col(f"{la}.{x}").bitwiseXOR(F.col(f"{lb}.{x}"))) for x in "abc"), F.lit(0))
    apart = F.greatest(F.abs(F.length(a) - F.length(b)), odd)
    return 100 * apart <= (100 - least) * (F.length(a) + F.length(b)) + 1e-6


#: Texts up to LONG letters meet at pieces, those over LONG - 20 at length buckets; a pair has one of the two in common.
LONG = 120


def meeting_keys(text: Column, least: float, cut: bool) -> Column:
    """Keys, one of which two texts share if their ratio is ``least`` (95 or more).

    A ratio leaves at most k insertions and deletions for two lengths. The one text
    is cut into k + 1 pieces, of which one is whole in the other text, moved by as
    many places as the insertions and deletions on both its sides allow. ``cut``
    gives the pieces, otherwise every stretch that can be one. A key holds the two
    lengths, the piece's number and its hash. There are about k cubed of them, so
    long texts get buckets of lengths instead.
    """
    n = F.length(text)
    slack = (100.0 - least) / 100.0
    edits = lambda m: F.floor(slack * (n + m) + 1e-6).cast("int")
    reach = F.ceil(2 * slack * n / (1 - slack)).cast("int") + 1
    lengths = F.filter(F.sequence(F.greatest(F.lit(1), n - reach), n + reach), lambda m: F.abs(n - m) <= edits(m))

    def pieces(m: Column) -> Column:
        k = edits(m)
        size = n if cut else m  # the length of the text that is cut
        own, gap = (m, F.lit(0)) if cut else (n, n - m)

        def stretches(i: Column) -> Column:
            start = F.floor(i * size / (k + 1)).cast("int")
            width = F.floor((i + 1) * size / (k + 1)).cast("int") - start
            key = lambda at: F.xxhash64(own, size, i, F.substring(text, at + 1, width))
            if cut:
                return F.array(key(start))
            moved = F.sequence(F.ceil((gap - k) / 2).cast("int"), F.floor((gap + k) / 2).cast("int"))
            places = F.filter(F.transform(moved, lambda s: start + s), lambda at: (at >= 0) & (at + width <= n))
            return F.transform(places, key)

        return F.flatten(F.transform(F.sequence(F.lit(0), k), stretches))

    none = F.array().cast("array<bigint>")
    short = F.when(n.between(1, LONG), F.flatten(F.transform(lengths, pieces))).otherwise(none)
    bucket = length_bucket(n, least)
    buckets = F.array(bucket) if cut else F.array(bucket - 1, bucket, bucket + 1)
    long = F.when(n > LONG - 20, F.transform(buckets, lambda x: F.xxhash64(F.lit("long"), x))).otherwise(none)
    return F.array_distinct(F.concat(short, long))


def candidates(items: DataFrame, works: DataFrame) -> DataFrame:
    """Rows (item_id, work_id, work_ord, work_year, item_year, score) that meet their limits.

    ``items``: item_id, norm, year; ``works``: work_id, norm, year, ord. Generic
    titles match by equal title and year only. Scores depend on the two texts, so
    each pair of distinct texts is scored once. Texts of one year meet by length;
    those of adjacent years or without one need a score that leaves few changes
    and meet at pieces that both have.
    """
    i = items.select("item_id", F.col("norm").alias("it"), F.nullif("year", F.lit(0)).alias("item_year")).where("it is not null")
    w = works.select("work_id", F.col("norm").alias("wt"), F.nullif("year", F.lit(0)).alias("work_year"), F.col("ord").alias("work_ord")).where("wt is not null")
    exact = i.join(w, (F.col("it") == F.col("wt")) & (F.col("item_year") == F.col("work_year"))).where(is_generic(F.col("it")))
    exact = exact.withColumn("score", F.lit(100.0))

    def texts(d: DataFrame, t: str, year: str, p: str) -> tuple[DataFrame, DataFrame]:
        """Distinct texts with their years, and distinct texts with whether one has no year."""
        d = d.where(~is_generic(F.col(t)) & (F.col(t) != "")).select(t, year).distinct().withColumn(f"{p}s", sorted_words(F.col(t)))
        whole = d.groupBy(t, f"{p}s").agg(F.bool_or(F.col(year).isNull()).alias(f"{p}open"))
        bits = lambda x: x.withColumn(f"{p}l", letters(F.col(f"{p}s")))
        return bits(d.where(F.col(year).isNotNull())), bits(whole)

    dated_i, open_i = texts(i, "it", "item_year", "i")
    dated_w, open_w = texts(w, "wt", "work_year", "w")
    years = ["it", "wt", "item_year", "work_year"]
    near = lambda least: _within("is", "ws", "il", "wl", least)

    # Equal texts recur in many years at some sizes: then each pair of texts is looked at once, before years are.
    n_i, n_w = (d.groupBy(F.col(y).alias("y")).agg(F.count("*").alias(n)) for d, y, n in ((dated_i, "item_year", "ni"), (dated_w, "work_year", "nw")))
    by_year = n_i.join(n_w, "y").agg(F.sum(F.col("ni").cast("double") * F.col("nw"))).first()[0] or 0
    texts_i, texts_w = (d.select(t, f"{p}s", f"{p}l").distinct() for d, t, p in ((dated_i, "it", "i"), (dated_w, "wt", "w")))
    once = texts_i.count() * texts_w.count() < by_year
    same_i, same_w = (texts_i, texts_w) if once else (dated_i, dated_w)
    by_length = same_w.withColumn("wb", _near(length_bucket(F.length("ws"), SAME_YEAR)))
    lengths = (F.col("bucket") == F.col("wb")) & near(SAME_YEAR)
    same = same_i.withColumn("bucket", length_bucket(F.length("is"), SAME_YEAR)).join(by_length, lengths if once else (F.col("item_year") == F.col("work_year")) & lengths)

    cut = lambda d, least: d.withColumn("wk", F.explode(meeting_keys(F.col("ws"), least, True)))
    seek = lambda d, least: d.withColumn("ik", F.explode(meeting_keys(F.col("is"), least, False)))
    beside = cut(dated_w, NEXT_YEAR).withColumn("at", F.explode(F.array(F.col("work_year") - 1, F.col("work_year") + 1)))
    beside = seek(dated_i, NEXT_YEAR).join(beside, (F.col("item_year") == F.col("at")) & (F.col("ik") == F.col("wk")) & near(NEXT_YEAR)).select(years)
    undated = seek(open_i, UNDATED).join(cut(open_w, UNDATED), (F.col("ik") == F.col("wk")) & (F.col("iopen") | F.col("wopen")) & near(UNDATED)).select("it", "wt")

    def scored(pairs: DataFrame) -> DataFrame:
        return pairs.select("it", "wt").distinct().withColumn("score", fuzzy.title_score_udf("it", "wt"))

    def limited(pairs: DataFrame, least: float) -> DataFrame:
        pairs = stage(pairs.select(years).distinct(), "link-pairs")
        return pairs.join(scored(pairs), ["it", "wt"]).where(F.col("score") >= least).select(*years, "score")

    if once:
        alike = stage(scored(same).where(F.col("score") >= SAME_YEAR), "link-alike")
        equal = alike.join(dated_i.select("it", "item_year"), "it").join(dated_w.select(F.col("wt").alias("_w"), "work_year"), (F.col("wt") == F.col("_w")) & (F.col("item_year") == F.col("work_year"))).select(*years, "score")
    else:
        equal = limited(same, SAME_YEAR)
    good = equal.union(limited(beside, NEXT_YEAR)).withColumnsRenamed({"it": "_it", "wt": "_wt", "item_year": "_iy", "work_year": "_wy"})
    out = ["item_id", "work_id", "work_ord", "work_year", "item_year", "score"]
    back = i.join(good, (F.col("it") == F.col("_it")) & (F.col("item_year") == F.col("_iy")))
    linked = back.join(w, (F.col("_wt") == F.col("wt")) & (F.col("_wy") == F.col("work_year"))).select(out)
    free = scored(undated).where(F.col("score") >= UNDATED).withColumnsRenamed({"it": "_it", "wt": "_wt"})
    missing = F.col("item_year").isNull() | F.col("work_year").isNull()
    loose = i.join(free, F.col("it") == F.col("_it")).join(w, (F.col("_wt") == F.col("wt")) & missing).select(out)
    return linked.unionByName(loose).unionByName(exact.select(out))


def link(items: DataFrame, works: DataFrame) -> DataFrame:
    """(item_id, work_id, score) of each item: its best work, or null and 0.

    The best score wins, then the least ord. An undated item whose candidates
    within ``NEAR`` of the best have more than one year (none counts as one) is
    left open.
    """
    # What an item gets depends on its text and year alone, and of works of one text and year only the first can win.
    year = F.nullif("year", F.lit(0))
    asked = items.withColumn("_k", F.concat(F.coalesce(year.cast("string"), F.lit("")), F.lit("\n"), F.col("norm")))
    kinds = stage(asked.where("_k is not null").groupBy(F.col("_k").alias("item_id")).agg(F.first("norm").alias("norm"), F.first(year).alias("year")), "link-items")
    firsts = works.where("norm is not null").groupBy("norm", year.alias("year")).agg(F.min_by("work_id", "ord").alias("work_id"), F.min("ord").alias("ord"))
    c = candidates(kinds, stage(firsts, "link-works"))
    top = c.groupBy("item_id").agg(F.max("score").alias("top"))
    near = c.join(top, "item_id").where(F.col("score") >= F.col("top") - NEAR)
    best = near.groupBy("item_id").agg(
        F.max("top").alias("top"), F.min_by("work_id", F.struct((-F.col("score")).alias("s"), F.col("work_ord"))).alias("work_id"),
        F.size(F.collect_set(F.coalesce("work_year", F.lit(-1)))).alias("years"), F.max("item_year").alias("item_year"),
    )
    sure = ~(F.col("item_year").isNull() & (F.col("years") > 1))
    found = stage(best.where(sure).select(F.col("item_id").alias("_of"), "work_id", F.col("top").alias("score")), "link-found")
    return asked.select("item_id", "_k").join(found, F.col("_k") == F.col("_of"), "left").select("item_id", "work_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def choices(works: DataFrame) -> DataFrame:
    """Each title and other title with its work; where several works claim one, the last does."""
    told = works.select(F.explode(F.concat(F.array("title"), F.coalesce("alt_titles", F.array().cast("array<string>")))).alias("choice"), "work_id", "ord", F.col("title"), F.col("year"))
    return told.where("choice is not null").groupBy("choice").agg(F.max_by(F.struct("work_id", "title", "year", "ord"), F.col("ord")).alias("w")).select("choice", "w.*")


def extract(queries: DataFrame, options: DataFrame, scorer: str = "weighted", cutoff: float = 0.0, limit: int = 1) -> DataFrame:
    """For each query (query_id, text) the ``limit`` best options (choice, ord) of at least ``cutoff``: best score first, then option order.

    Equal to a comparison with every option; see ``retrieve``.
    """
    return best_options(queries, options, scorer, cutoff, limit)


def suggestions(merged: DataFrame, works: DataFrame, cutoff: float = 90.0) -> DataFrame:
    """``merged`` with four suggested_ columns for rows that are not labelled: the best work by token-set ratio."""
    from vellum.functions.text import title_fallback

    asked = merged.where(F.col("label_status") != "labelled").select(F.col("key").alias("query_id"), title_fallback(F.col("title"), F.col("local_path")).alias("text"))
    best = extract(asked, works.select(F.col("title").alias("choice"), "ord"), "token_set", cutoff, 1)
    told = best.join(works.select(F.col("ord").alias("choice_ord"), F.col("title").alias("t"), F.col("year").alias("y"), F.col("collection").alias("c")), "choice_ord")
    told = told.select(F.col("query_id").alias("key"), F.col("t").alias("suggested_title"), F.col("y").alias("suggested_year"), F.col("c").alias("suggested_collection"), F.col("score").alias("suggested_score"))
    return merged.join(told, "key", "left")


def lookup(queries: DataFrame, works: DataFrame, limit: int = 5, cutoff: float = 55.0) -> DataFrame:
    """For each query (query_id, text, year) the best works: weighted ratio, then the year's agreement.

    A pool of max(4 * limit, 20) titles, one a work (title, year), gets 8 more for
    the same year, 3 for an adjacent one (100 at most), 15 less for one over five
    years off.
    """
    opts = choices(works)
    pool = extract(queries.select("query_id", "text"), opts.select("choice", "ord"), "weighted", cutoff, max(4 * limit, 20))
    pool = pool.join(opts.drop("ord"), "choice").join(queries.select("query_id", F.col("year").alias("asked")), "query_id")
    once = pool.groupBy("query_id", "title", F.col("year")).agg(F.min_by(F.struct("choice", "score", "work_id", "asked", "rank"), "rank").alias("r")).select("query_id", "title", "year", "r.*")
    gap = F.abs(F.col("year") - F.col("asked"))
    adjusted = F.when(gap == 0, F.least(F.lit(100.0), F.col("score") + 8)).when(gap == 1, F.least(F.lit(100.0), F.col("score") + 3)).when(gap > 5, F.col("score") - 15).otherwise(F.col("score"))
    ranked = once.withColumn("score", F.round(adjusted, 2))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "rank")
    return ranked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit).select("query_id", "place", "work_id", "title", "year", F.col("choice").alias("matched_as"), "score")

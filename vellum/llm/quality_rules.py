"""Quality rules: base counts, then divergence from a reference of the document's language.

DataFrame functions only. A document's character-class and common-word
histograms are compared with the mean histograms of its language by
Jensen-Shannon distance; short documents are not judged, and the fewer documents
a reference has, the further from it a document may lie.

In the whole common-word histogram nearly all mass lies on "other", so that its
distance stays near 0.35 even without a single common word. So two more are
judged: the share of common words, common or other, against the language's own
spread, and the histogram of the common words alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import stage

WS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"

#: Character classes beside "all other characters": name, pattern.
CLASSES = [
    ("upper", r"[A-Z]"),
    ("digit", r"[0-9]"),
    ("stop", r"[.,;:!?'()\"-]"),
    ("symbol", r"[#*$%&|<>]"),
    ("code", r"[{}\[\]=_/\\@+~^`]"),
    ("beyond_ascii", r"[^\x00-\x7F]"),
]

#: Common words of the languages; fixed values, the most frequent function words of each.
COMMON = {
    "en": "the of and to a in is that for it as with on be at by this are or from".split(),
    "fr": "de la le et les des en un une que est pour qui dans sur pas au par du avec".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al".split(),
}

#: Verdict: distances above these limits reject. A sample of n words strays from
#: its reference by about 1 / sqrt(n), which ``NOISE`` allows for.
CHAR_LIMIT, WORD_LIMIT, NOISE = 0.25, 0.35, 1.0
#: A share of common words is low beyond so many half interquartile ranges below the median: three standard deviations of a normal.
SPREAD = 4.45
#: A sample of h common words strays from its reference, a histogram of about 20 words, by about 2 / sqrt(h).
COMMON_NOISE = 2.0
#: Guard: words a document needs.
MIN_WORDS = 50
#: One of r documents weighs 1 / r in a reference, so that much of a distance is allowed for: all of it where there is one
#: document only (no distance exceeds 1), and steadily less as documents come.
REFERENCE_NOISE = 1.0


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none of a null or blank one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS_RUN))


def with_base(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, chars, hits.

    ``docs`` has doc_id, text, lang. Each step is a projection, so that an array
    is made once and read by the next. Windows are compared by 64-bit hashes
    within one document.
    """
    text = F.coalesce("text", F.lit(""))
    vocabulary = sorted({w for ws in COMMON.values() for w in ws})
    d = docs.select("doc_id", "lang", text.alias("text"), word_array(F.col("text")).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(WS)) != "")
    d = d.select(
        "doc_id", "lang",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.array(*[F.regexp_count("text", F.lit(p)).cast("long") for _, p in CLASSES]).alias("classes"),
        lines.alias("lines"),
        F.array_join(F.filter(F.transform("words", F.lower), lambda w: w.isin(vocabulary)), "  ").alias("hits"),
        F.when(F.size("words") >= 3, F.transform(
            F.slice("words", F.lit(1), F.size("words") - 2),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        )).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    d = d.select(
        "*",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(
            F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )).alias("sorted"),
    ).drop("lines", "windows")
    same = lambda x, k, by: F.coalesce(x["h"] == F.get("sorted", k + by)["h"], F.lit(False))
    d = d.withColumn(
        "at", F.sort_array(F.transform(F.filter("sorted", lambda x, k: same(x, k, 1) | same(x, k, -1)), lambda x: x["i"]))
    ).drop("sorted")
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.coalesce(F.least(F.lit(3), F.get("at", k + 1) - p), F.lit(3))),
        F.lit(0), lambda a, x: a + x,
    )
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")
    return d.withColumn("n_symbols", F.get("classes", F.lit([n for n, _ in CLASSES].index("symbol")))).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def histograms(base: DataFrame) -> DataFrame:
    """Add chars and common, arrays of shares that sum to one (to zero for an empty document)."""
    vocabulary = sorted({w for ws in COMMON.values() for w in ws})
    padded = F.concat(F.lit(" "), F.col("hits"), F.lit(" "))
    share = lambda n, of: F.when(of > 0, n / of).otherwise(F.lit(0.0))
    of_words = [
        (F.octet_length("padded") - F.octet_length(F.replace("padded", F.lit(f" {w} ")))) / (len(w.encode()) + 2) for w in vocabulary
    ]
    other = lambda known, of: share(of - F.aggregate(known, F.lit(0.0), lambda a, x: a + x), of)
    d = base.withColumn("padded", padded).withColumn("counts", F.array(*of_words)).withColumn(
        "classes", F.transform("classes", lambda x: x.cast("double"))
    )
    return d.withColumns({
        "chars": F.concat(F.transform("classes", lambda x: share(x, F.col("n_chars"))), F.array(other(F.col("classes"), F.col("n_chars")))),
        "common": F.concat(F.transform("counts", lambda x: share(x, F.col("n_words"))), F.array(other(F.col("counts"), F.col("n_words")))),
    }).drop("padded", "counts", "classes", "hits", "n_chars")


def common_share(common: Column) -> Column:
    """The share of common words: what the last bin, "other", leaves."""
    return 1 - F.element_at(common, -1)


def references(features: DataFrame) -> DataFrame:
    """Mean histograms and quartiles of the share of common words of the languages over all documents that pass the base rules: a row a language."""
    sizes = {"chars": len(CLASSES) + 1, "common": len({w for ws in COMMON.values() for w in ws}) + 1}
    means = {h: F.array(*[F.avg(F.get(h, F.lit(i))) for i in range(n)]).alias(f"ref_{h}") for h, n in sizes.items()}
    return (
        features.where("lang is not null and not base_failed").groupBy(F.col("lang").alias("ref_lang"))
        .agg(F.count("*").alias("ref_docs"), F.percentile_approx(common_share(F.col("common")), [0.25, 0.5, 0.75], 10000).alias("ref_shares"), *means.values())
    )


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions as arrays: 0 (equal) to 1."""
    term = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(p, q, lambda x, y: term(x, (x + y) / 2) + term(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))


def reference_room() -> Column:
    """What a reference of so many documents is allowed to be off by."""
    return REFERENCE_NOISE / F.col("ref_docs")


def lacks_common_words(word_limit: float, noise: float) -> Column:
    """Whether a document has too few common words for its language, or others than it has; null or false without a reference."""
    two = lambda x: F.array(x, 1 - x)
    low, median, high = (F.get("ref_shares", F.lit(i)) for i in range(3))
    spread = F.greatest(jensen_shannon(two(low), two(median)), jensen_shannon(two(high), two(median)))
    share = common_share(F.col("common"))
    allowed = SPREAD * spread + noise / F.sqrt(F.greatest(F.col("n_words"), F.lit(1))) + reference_room()
    few = (share < median) & (jensen_shannon(two(share), two(median)) > allowed)
    alone = lambda h: F.transform(F.slice(h, F.lit(1), F.size(h) - 1), lambda x: x / common_share(F.col(h)))
    room = word_limit + COMMON_NOISE * noise / F.sqrt(share * F.col("n_words")) + reference_room()
    others = F.when((share > 0) & (common_share(F.col("ref_common")) > 0), jensen_shannon(alone("common"), alone("ref_common")) > room)
    return few | F.coalesce(others, F.lit(False))


def quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT, noise: float = NOISE,
) -> DataFrame:
    """One row a document: the base counts, both distances, and whether it is kept.

    Null text counts as empty: no words, base_failed; texts may be of any length. A
    null language, or one of which no document passes the base rules, has no
    reference; its documents have null distances and are kept if they pass the base
    rules. The references cover all documents that pass the base rules. Repeated rows are judged each;
    other columns are not read; an empty table gives no rows.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    features = stage(histograms(with_base(d)), "quality-features")
    ref = stage(references(features), "quality-references")
    judged = features.join(ref, features.lang == ref.ref_lang, "left").withColumns({
        "char_distance": F.when(F.col("ref_docs").isNotNull(), jensen_shannon(F.col("chars"), F.col("ref_chars"))),
        "word_distance": F.when(F.col("ref_docs").isNotNull(), jensen_shannon(F.col("common"), F.col("ref_common"))),
    })
    allowed = noise / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    room = reference_room()
    strays = (F.col("char_distance") > char_limit + allowed / 2 + room) | (F.col("word_distance") > word_limit + allowed + room) | lacks_common_words(word_limit, noise)
    return judged.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "char_distance", "word_distance",
        (~F.col("base_failed") & ~F.coalesce((F.col("n_words") >= MIN_WORDS) & strays, F.lit(False))).alias("kept"),
    )

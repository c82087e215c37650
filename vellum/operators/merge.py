"""Survivorship: one row for each group of duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import truthy

#: Fields that donors may give, each on its own.
FIELDS = ["title", "year", "date_raw", "collection", "inventory_no", "medium", "dimensions", "genre", "style", "description", "license", "wikidata_id"]


def _present(rows: DataFrame, f: str) -> Column:
    kind = rows.schema[f].dataType.typeName()
    return truthy(F.col(f), "string" if kind == "string" else "int")


def trust_rank(group: Column, trust: list[str]) -> Column:
    """The place of a group in the trust list; unknown groups come last."""
    at = F.array_position(F.array(*map(F.lit, trust)).cast("array<string>"), group) if trust else F.lit(0)
    return F.when(at > 0, at - 1).otherwise(len(trust)).cast("int")


def survivors(rows: DataFrame, group: str, trust: list[str], fields: list[str] | None = None, order: str = "_ord") -> DataFrame:
    """One row a ``group``: the largest image, and each field from the first donor that has it.

    ``rows`` has the record's columns, ``_group`` (where a row is from), ``order``
    and ``group``. Donors stand in order of trust, then of how many fields they
    have, then as they came. All fields are conditional arg-mins of one grouped
    aggregation, combined before the shuffle: no window, no list of members.
    """
    fields = [f for f in (fields or FIELDS) if f in rows.columns]
    rich = sum((_present(rows, f).cast("int") for f in fields), F.lit(0))
    pixels = (F.coalesce("width", F.lit(0)).cast("long") * F.coalesce("height", F.lit(0)).cast("long")).alias("px")
    d = rows.withColumn("_donor", F.struct(trust_rank(F.col("_group"), trust).alias("p"), (-rich).alias("r"), F.col(order).alias("o")))
    best = F.max_by(F.struct("key", "local_path", "image_url", "sha256", "width", "height"), F.struct(pixels, (-F.col(order)).alias("o")))
    texts = lambda c: F.array_sort(F.collect_set(F.nullif(c, F.lit(""))))
    out = d.groupBy(group).agg(
        best.alias("_best"),
        *(F.min_by(F.col(f), F.when(_present(rows, f), F.col("_donor"))).alias(f) for f in fields),
        F.when(F.bool_or(F.coalesce(F.col("confidence") == "high", F.lit(False))), "high")
        .otherwise(F.coalesce(F.min_by("confidence", order), F.lit("low"))).alias("confidence"),
        texts(F.coalesce(F.nullif(F.col("source"), F.lit("")), F.col("_group"))).alias("sources"),
        texts(F.col("page_url")).alias("page_urls"),
        F.array_sort(F.collect_list("local_path")).alias("_paths"),
        F.nullif(F.array_join(texts(F.col("notes")), " | "), F.lit("")).alias("notes"),
        F.count("*").alias("members"),
    )
    out = out.withColumn("duplicates", F.filter("_paths", lambda p: ~p.eqNullSafe(F.col("_best.local_path"))))
    titled = truthy(F.col("title")) if "title" in fields else F.lit(False)
    dated = truthy(F.col("year"), "int") if "year" in fields else F.lit(False)
    status = F.when(titled & dated, "labelled").when(titled, "title_only").otherwise("unlabelled")
    return out.select(group, "_best.*", *fields, "confidence", "sources", "page_urls", "duplicates", "notes", "members", status.alias("label_status"))


def counts_by_source(merged: DataFrame) -> DataFrame:
    """How many merged rows each source took part in."""
    return merged.select(F.explode("sources").alias("source")).groupBy("source").agg(F.count("*").alias("n"))


def report(merged: DataFrame) -> DataFrame:
    """Counters of a merged table, one row."""
    part = lambda p: F.round(100.0 * F.count_if(p) / F.greatest(F.count("*"), F.lit(1)), 1)
    return merged.agg(
        F.count("*").alias("total"), part(truthy(F.col("year"), "int")).alias("pct_year"), part(truthy(F.col("collection"))).alias("pct_collection"),
        *(F.count_if(F.col("label_status") == s).alias(s) for s in ("labelled", "title_only", "unlabelled")),
    )

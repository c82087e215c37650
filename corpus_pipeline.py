"""A corpus pipeline: five stages over ``documents``, each one operator of ``vellum.llm``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns the columns of ``documents``; the last returns the packed
pieces. ``run`` chains them, each stage written as a table and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import exact_dedup, packing, quality_rules, simhash, substring_dedup
from vellum.llm.common import free, stage, told_apart, tune, unused

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _without(docs: DataFrame, row: str, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` less the rows whose ``row`` is among ``gone`` (row), a narrow table."""
    (other,) = unused(docs, "gone")
    return docs.join(stage(gone.select(F.col("row").alias(other)), name), F.col(row) == F.col(other), "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules. Each row is judged by its own text and language; a null text fails; no rows give none."""
    (row,) = unused(docs, "row")
    numbered, _ = told_apart(docs, "doc_id", row)
    judged = quality_rules.quality(numbered, id_col=row)
    return _without(numbered, row, judged.where("not kept").select(F.col("doc_id").alias("row")), "pipeline-quality").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the least id (null last). Rows are told apart, not ids; null texts count as empty."""
    (row,) = unused(docs, "row")
    numbered, _ = told_apart(docs, "doc_id", row)
    decided = exact_dedup.exact_dedup(numbered, row_col=row)
    return _without(numbered, row, decided.where("not kept"), "pipeline-exact").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, with the least id (null last): five-word shingles, similarity 0.8 or more.

    Rows are told apart, not ids, so that a null or repeated id neither hides a
    copy nor takes another text with it. Texts without words are alike.
    """
    (row,) = unused(docs, "row")
    numbered, _ = told_apart(docs, "doc_id", row)
    groups = stage(simhash.similar_documents(numbered, words=5, least=0.8, id_col=row).select(F.col("doc_id").alias("row"), "component_id"), "pipeline-groups")
    members = groups.join(numbered.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id")), "row")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "row")
    stays = stage(members.groupBy("component_id").agg(F.min_by("row", order).alias("stays")), "pipeline-stays")
    gone = groups.join(stays.select(F.col("component_id").alias("of"), "stays"), F.col("component_id") == F.col("of")).where("row <> stays")
    return _without(numbered, row, gone, "pipeline-near").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; the length column follows the text. A row without one stays as it is, null text or id included."""
    cleaned = substring_dedup.remove_repeats(docs)
    size = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", size).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens; a null text is an end token; null and repeated ids are documents each."""
    return packing.packed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash", near),
    ("substring_dedup", substrings),
    ("packing", pack),
]

#: SQL can express neither fingerprints nor tokens; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    tune(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        out = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            before, docs = docs, stage(out, f"pipeline-{name}-kept")
            free(before)
    return out

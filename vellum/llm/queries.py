"""The queries of this subpackage, each over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import bpe, cotraining, exact_dedup, langid, packing, prefix_bpe, prefix_trie, quality_rules, simhash, substring_dedup, token_files, warc, whitening
from vellum.llm.common import read_documents, tune


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_documents(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(read_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read_documents(spark, sf_dir), digest=True)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return warc.page_derivatives(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.quality_scores(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read_documents(spark, sf_dir))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_documents(spark, sf_dir))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read_documents(spark, sf_dir), digest=True)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), share=True)


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encode_decode(read_documents(spark, sf_dir), digest=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_simhash": op2_simhash,
        "op3_quality_rules": op3_quality_rules,
        "op4_token_files": op4_token_files,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_warc_derivatives": op6_warc_derivatives,
        "op7_cotraining": op7_cotraining,
        "op8_packing": op8_packing,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_bpe": op10_bpe,
        "op11_whitening": op11_whitening,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_prefix_bpe": op13_prefix_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": exact_dedup.SQL}

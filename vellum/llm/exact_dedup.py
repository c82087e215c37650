"""Exact deduplication by two passes over hashes with a counting Bloom filter.

Pass one hashes every normalised text and counts hashes in a Bloom filter whose
counters stop at two. Pass two asks the filter: a hash whose counters all stand
at two may be repeated and is shuffled; every other row goes straight through.
Where one filter of bounded size would be too full, hashes are cut into ranges,
each with a filter of its own: rows lie sorted by hash in their files, so that a
range reads its own part of them only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm import bloom
from vellum.llm.common import WS, code_points, in_workers, stage, text_bytes, tune


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Rows (doc_id, row, n_points, sha): code points of the text, SHA-256 of it without white space; row is null without ``row_col``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sha = [hashlib.sha256((t or b"").translate(None, WS)).digest() for t in text_bytes(b.column(2))]
            points = code_points(b.column(2)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), points, pa.array(sha, pa.binary())], ["doc_id", "row", "n_points", "sha"])

    row = F.col(row_col) if row_col else F.lit(None)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.cast("long").alias("row"), F.col(text_col).cast("string").alias("text"))
    return in_workers(d, run, "doc_id long, row long, n_points long, sha binary")


def asked_rows(rows: DataFrame, most_bits: int) -> DataFrame:
    """``rows`` with ``again``: whether the hash ``h`` may be met more than once.

    There are as many ranges of hashes as filters of ``most_bits`` are needed for
    16 bits a row; no task and no broadcast holds more than one of them.
    """
    spark = rows.sparkSession
    n = rows.count()
    ranges = max(1, -(-n * bloom.BITS_A_ROW // most_bits))
    kinds = "doc_id long, row long, n_points long, sha binary, again boolean"

    def one(part: DataFrame) -> DataFrame:
        packed = spark.sparkContext.broadcast(bloom.build(part.select("h"), bloom.bits_for(-(-n // ranges), most_bits), times=2))

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    hit = bloom.ask(packed.value, b.column(4).to_numpy(zero_copy_only=False).view(np.uint64))
                    yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(hit)], ["doc_id", "row", "n_points", "sha", "again"])

        return in_workers(part, ask, kinds)

    if ranges == 1:
        return one(rows)
    cuts = [-(1 << 63) + (k << 64) // ranges for k in range(ranges)] + [(1 << 63) - 1]
    parts = []
    for k in range(ranges):
        above = F.col("h") < cuts[k + 1] if k < ranges - 1 else F.lit(True)
        parts.append(stage(one(rows.where((F.col("h") >= cuts[k]) & above)), "exact-asked")._scratch)
    return spark.read.schema(kinds).parquet(*parts)


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_bits: int = bloom.MOST_BITS, row_col: str | None = None
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without the characters of
    ``[\\x20\\x09-\\x0D]``; a null text counts as empty. Of equal texts the row
    with the most code points stays, then the smallest id. Rows that repeat an
    id share its decision; a null id is the last choice to stay, and where all
    of a group are null its rows stay. With ``row_col``, a long that tells rows
    apart, one row of each group stays, the smallest of those that are alike, and
    the result has the column row too. Texts may be of any length; other columns
    are not read. An empty table gives no rows. A filter has ``most_bits`` bits at
    most; more rows take more filters, one after the other.
    """
    spark = docs.sparkSession
    tune(spark)
    rows = stage(hashed(docs, id_col, text_col, row_col).withColumn("h", F.xxhash64("sha")).sortWithinPartitions("h"), "exact-hashes")
    asked = asked_rows(rows, most_bits)
    again = asked.where("again")
    # A group is one row before the shuffle meets it, however many copies it has. -1 - x turns the order of longs round and never overflows.
    turned = lambda c: F.lit(-1) - F.col(c)
    best = F.max(F.struct(F.col("n_points"), turned("doc_id").alias("low"), turned("row").alias("low_row")))
    groups = again.groupBy("sha").agg(F.count("*").alias("group_size"), best.alias("best"))
    groups = groups.where("group_size > 1").select(
        F.col("sha").alias("group_sha"), "group_size", turned("best.low").alias("keep_id"), turned("best.low_row").alias("keep_row")
    )
    groups = stage(groups, "exact-groups")
    alone = F.col("group_size").isNull()
    met = again.join(groups, F.col("sha") == F.col("group_sha"), "left").select(
        "doc_id", "row", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, F.col("row")).otherwise(F.col("keep_row")).alias("keep_row"), F.coalesce("group_size", F.lit(1)).alias("group_size"), "sha",
    )
    single = asked.where("not again").select("doc_id", "row", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"), "sha")
    return single.unionByName(met).select(
        "doc_id", *(["row"] if row_col else []), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("keep_row") if row_col else F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


#: DuckDB, over the view ``documents``.
SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

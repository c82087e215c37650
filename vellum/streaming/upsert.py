"""Incremental ingestion: keyed upserts, seen-set deduplication, done logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vellum.operators.records import last_per_key, upsert


def _versions(spark: SparkSession, table: str) -> dict[int, str]:
    """Epoch to folder of a table's complete versions, by one listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(table).getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path(table)):
        return {}
    names = [s.getPath().getName() for s in files.listStatus(path(table))]
    return {int(n[6:]): f"{table}/{n}" for n in names if n.startswith("epoch=") and files.exists(path(f"{table}/{n}/_SUCCESS"))}


def upsert_batch(batch: DataFrame, epoch: int, table: str, key: str, order: str, policy: str) -> None:
    """Merge a micro-batch into the newest version of ``table``; versions are folders named by epoch, so a rerun writes the same one.

    The version that was merged stays until the next is written, older ones are deleted.
    """
    spark = batch.sparkSession
    new = last_per_key(batch, key, order)
    versions = _versions(spark, table)
    base = max((e for e in versions if e < epoch), default=None)
    merged = new if base is None else upsert(spark.read.parquet(versions[base]), new, key, policy, [c for c in new.columns if c != key]).select(*new.columns)
    merged.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    for e in versions:
        if base is not None and e < base:
            path(versions[e]).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(versions[e]), True)


def stream_upsert(rows: DataFrame, table: str, checkpoint: str, key: str = "key", order: str = "_ord", policy: str = "replace") -> StreamingQuery:
    """Keep ``table`` the merge of all rows of a stream by key; the checkpoint is the log of what is done."""
    return (
        rows.writeStream.foreachBatch(lambda b, e: upsert_batch(b, e, table, key, order, policy)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def first_seen(rows: DataFrame, keys: list[str], time: str | None = None, keep: str = "1 day") -> DataFrame:
    """The first row of each key of a stream; with a time column only so long as ``keep``, which bounds the state."""
    return rows.dropDuplicates(keys) if time is None else rows.withWatermark(time, keep).dropDuplicatesWithinWatermark(keys)


def unseen(candidates: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is not among those seen, one row a key."""
    return candidates.join(seen.select(key), key, "left_anti").dropDuplicates([key])

"""Scratch tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where none is set, one of this machine serves a local session; a cluster's
    executors would not see it, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="vellum-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The table cuts lineage and survives the loss of executors, and what is read
    from it has known sizes, so that joins on it can be planned and split.
    """
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dealt(df: DataFrame, *by: Column | str) -> DataFrame:
    """``df`` dealt by ``by`` over as many partitions as shuffles have, however few bytes they hold.

    Where narrow rows make much work, adaptive execution would gather them in few tasks.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


#: Rows and bytes handed to a Python worker at once; texts may be long, so batches are bounded by both.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def tune(spark: SparkSession) -> None:
    """Short Arrow batches: the memory of a Python worker follows the batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def free(*tables: DataFrame | None) -> None:
    """Delete the files of tables that ``stage`` gave and that nothing reads any more; others are left alone."""
    for table in tables:
        if path := getattr(table, "_scratch", None):
            jvm = table.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
            table._scratch = None

"""When requests may start: one host's requests follow each other by an interval at least."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def paced(requests: DataFrame, host: str, asked: str, order: str, interval: int, block: int) -> DataFrame:
    """``requests`` with starts (long): start = max(asked, the start before + ``interval``) in the order (asked, order) of each host.

    ``asked`` is a long; rows with a null host or time have no start and hold up
    nobody. The recurrence is a running maximum, of asked - n * interval for the
    n-th request: it can be taken in blocks of ``block`` time units, whose counts
    and maxima, a row a block, are carried on. So a busy host is many tasks.
    """
    order_by = [asked, order]
    known = requests.where(F.col(host).isNotNull() & F.col(asked).isNotNull())
    blocked = known.withColumn("_b", F.floor(F.col(asked) / F.lit(block)).cast("long"))
    inside = Window.partitionBy(host, "_b").orderBy(*order_by)
    at = blocked.withColumn("_n", F.row_number().over(inside).cast("long"))
    slack: Column = F.col(asked) - F.col("_n") * interval
    held = at.withColumn("_m", F.max(slack).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    blocks = at.groupBy(F.col(host).alias("_h"), F.col("_b").alias("_k")).agg(F.count("*").alias("_c"), F.max(slack).alias("_x"))
    along = Window.partitionBy("_h").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    counted = blocks.withColumn("_before", F.coalesce(F.sum("_c").over(along), F.lit(0)))
    # of the n-th of all, asked - (before + n) * interval
    carried = counted.withColumn("_carry", F.max(F.col("_x") - F.col("_before") * interval).over(along))
    joined = held.join(carried.select("_h", "_k", "_before", "_carry"), (F.col(host) == F.col("_h")) & (F.col("_b") == F.col("_k")))
    most = F.greatest(F.col("_m") - F.col("_before") * interval, F.col("_carry"))
    paced_rows = joined.withColumn("starts", most + (F.col("_before") + F.col("_n")) * interval).select(*requests.columns, "starts")
    unknown = requests.where(F.col(host).isNull() | F.col(asked).isNull())
    return paced_rows.unionByName(unknown.withColumn("starts", F.lit(None).cast("long")))

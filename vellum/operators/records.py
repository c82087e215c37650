"""Keyed records: schema, union, upsert, padding and merge policies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The record: 22 columns; numbers are ints, all else text.
COLUMNS = (
    "key source title year date_raw collection inventory_no medium dimensions genre style description license "
    "page_url image_url local_path sha256 width height wikidata_id confidence notes"
).split()
RECORD = T.StructType([T.StructField(c, T.IntegerType() if c in ("year", "width", "height") else T.StringType()) for c in COLUMNS])


def last_per_key(rows: DataFrame, key: str | list[str] = "key", order: str = "_ord") -> DataFrame:
    """The last row of each key, as a re-read of an appended file gives it: a grouped arg-max, combined before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    best = F.max_by(F.struct("*"), F.col(order))
    return rows.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(best.alias("_r")).select("_r.*")


def upsert(old: DataFrame, new: DataFrame, key: str = "key", policy: str = "replace", fields: list[str] | None = None) -> DataFrame:
    """Merge ``new`` into ``old`` by key.

    ``replace``: a new row takes the place of the old one. ``fill``: only null or
    empty fields of an old row are filled. ``prefer_new``: each present field of
    the new row wins. Keys on either side are kept; both sides have one row a key.
    """
    fields = fields or [c for c in old.columns if c != key]
    a, b = old.alias("a"), new.alias("b")
    kinds = {f.name: f.dataType for f in old.schema}

    def present(c: str) -> Column:
        return F.nullif(F.col(c), F.lit("")) if isinstance(kinds[c.split(".")[1]], T.StringType) else F.col(c)

    def pick(f: str) -> Column:
        x, y = f"a.{f}", f"b.{f}"
        if policy == "replace":
            return F.when(F.col(f"b.{key}").isNotNull(), F.col(y)).otherwise(F.col(x)).alias(f)
        one, two = (x, y) if policy == "fill" else (y, x)
        return F.coalesce(present(one), present(two)).alias(f)

    if policy not in ("replace", "fill", "prefer_new"):
        raise ValueError(policy)
    joined = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full")
    return joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), *map(pick, fields))


def union_records(*tables: DataFrame) -> DataFrame:
    """Union by name; columns that a table lacks are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)


def padded(rows: DataFrame, schema: T.StructType = RECORD, confidence: str = "medium") -> DataFrame:
    """The columns of ``schema`` only, missing ones null; a missing confidence becomes the default."""
    have = {c.lower() for c in rows.columns}
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    out = rows.select(*cols)
    return out.withColumn("confidence", F.coalesce("confidence", F.lit(confidence))) if "confidence" in out.columns else out


def without_internal(rows: DataFrame) -> DataFrame:
    """Drop the columns whose names start with an underscore."""
    return rows.drop(*(c for c in rows.columns if c.startswith("_")))


def parted(rows: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where ``condition`` holds, and all others."""
    held = F.coalesce(condition, F.lit(False))
    return rows.where(held), rows.where(~held)


def reconcile(left: DataFrame, right: DataFrame, keys: list[list[str]], order: str, values: list[str]) -> DataFrame:
    """``left`` with ``values`` of the row of ``right`` that agrees on the first list of ``keys``, else on the next.

    Where several agree the least ``order`` counts.
    """
    out = left
    found = []
    for i, names in enumerate(keys):
        best = right.groupBy(*(F.col(n).alias(f"_j{i}{n}") for n in names)).agg(F.min_by(F.struct(*values), F.col(order)).alias(f"_v{i}"))
        on = reduce(lambda x, y: x & y, (F.col(n) == F.col(f"_j{i}{n}") for n in names))
        out = out.join(best, on, "left").drop(*(f"_j{i}{n}" for n in names))
        found.append(F.col(f"_v{i}"))
    out = out.withColumn("_v", F.coalesce(*found))
    return out.select(*left.columns, *(F.col(f"_v.{v}").alias(f"matched_{v}") for v in values))


def numbered(rows: DataFrame, order: list[Column], prefix: str = "w", start: int = 0, name: str = "id") -> DataFrame:
    """Dense ids such as ``w0001`` in a total order, without one task for all rows.

    Rows are sorted into ranges; the ranges' sizes, a number each, give where
    each one's ids begin.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_o{i}" for i in range(len(order))]
    ranged = rows.select("*", *(c.alias(n) for n, c in zip(names, order, strict=True)))
    from vellum.scratch import stage

    ranged = stage(ranged.repartitionByRange(parts, *names).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(F.col("_part").alias("_p"), before.alias("_before"))
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*names))
    out = ranged.withColumn("_n", at).join(F.broadcast(offsets), F.col("_part") == F.col("_p"))  # a row a shuffle partition
    return out.withColumn(name, F.format_string(f"{prefix}%04d", F.col("_n") + F.col("_before") + start)).drop(*names, "_part", "_p", "_n", "_before")


def suffixed(rows: DataFrame, key: str, order: list[str], joint: str = "#", out: str = "unique_key") -> DataFrame:
    """Keys made unique: from the second of equal keys on, ``joint`` and the number follow."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_n", n).withColumn(out, F.when(F.col("_n") > 1, F.concat(F.col(key).cast("string"), F.lit(joint), F.col("_n").cast("string"))).otherwise(F.col(key).cast("string"))).drop("_n")


def chunked(rows: DataFrame, order: list[str], size: int = 40) -> DataFrame:
    """Rows with the number of the batch of ``size`` that they fall in, by their ids from ``numbered``."""
    at = numbered(rows, [F.col(o) for o in order], "", 0, "_at")
    return at.withColumn("batch", F.floor((F.col("_at").cast("long") - 1) / size)).drop("_at")


def last_n(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The last ``n`` rows by ``order``: bounded state."""
    return rows.orderBy(F.col(order).desc()).limit(n)

"""Sinks: JSON lines, CSV projections, script assignments, rejected rows, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.operators.records import COLUMNS, padded


def write_records(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, one object a row, text as it is."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def flat(rows: DataFrame, separator: str = ";") -> DataFrame:
    """Arrays joined to text, for formats that have none."""
    return rows.select(*(F.array_join(f.name, separator).alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name) for f in rows.schema))


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, separator: str = ";", mode: str = "overwrite") -> None:
    """A fixed projection with a header; other columns are dropped, missing ones empty, arrays joined."""
    columns = columns or [c for c in COLUMNS if c != "notes"]
    have = set(rows.columns)
    flat(rows.select(*(F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns)), separator).write.mode(mode).option("header", True).csv(path)


def assignment(name: str, value: Column) -> Column:
    """``window.NAME = {...};`` of a struct column."""
    return F.concat(F.lit(f"window.{name} = "), F.to_json(value), F.lit(";"))


def catalogue_object(works: DataFrame, images: DataFrame, **scalars: object) -> DataFrame:
    """One row: an object of both tables, as arrays in id order, and scalars. For catalogues that a browser loads whole."""
    lists = lambda d, n: d.agg(F.array_sort(F.collect_list(F.struct("id", *(c for c in d.columns if c != "id")))).alias(n))
    return lists(works, "works").join(lists(images, "images"), F.lit(True)).select("works", "images", *(F.lit(v).alias(k) for k, v in scalars.items()))


def write_assignment(one: DataFrame, name: str, path: str, mode: str = "overwrite") -> None:
    """A script file that assigns the single row of ``one``."""
    one.select(assignment(name, F.struct("*")).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_parted(kept: DataFrame, rejected: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Kept rows and rejected rows with their reasons, side by side."""
    write_records(kept, f"{path}/kept", mode)
    write_records(rejected, f"{path}/rejected", mode)


def write_report(counters: DataFrame, path: str, mode: str = "overwrite") -> None:
    counters.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode(mode).text(path)


def append_log(lines: DataFrame, path: str) -> None:
    lines.write.mode("append").text(path)


def content_name(sha256: Column, length: int = 16, suffix: str = ".webp") -> Column:
    """A file name from the first hex digits of a digest."""
    return F.concat(F.substring(sha256, 1, length), F.lit(suffix))


__all__ = ["append_log", "assignment", "catalogue_object", "content_name", "flat", "padded", "write_assignment", "write_csv", "write_parted", "write_records", "write_report"]

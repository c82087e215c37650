"""Sources: keyed and nested JSON, script assignments, HTML, images, triples, inline tables.

Live fetching is not part of the engine; fetched pages are tables or files.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import text as X
from vellum.operators.records import RECORD, last_per_key


def read_records(spark: SparkSession, paths: str | list[str], schema: T.StructType = RECORD, tolerant: bool = False) -> DataFrame:
    """JSON lines with ``_path``, ``_group`` (the folder; ``main`` for data) and ``_ord`` (path, then place in the file).

    ``tolerant`` drops lines that are no JSON; otherwise they fail the read.
    """
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED" if tolerant else "FAILFAST").option("recursiveFileLookup", True)
    d = reader.json(paths)
    folder = F.regexp_extract("_path", r"([^/]+)/[^/]+$", 1)
    place = F.struct(F.col("_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    d = d.withColumn("_path", F.col("_metadata.file_path")).withColumn("_ord", place)
    return d.withColumn("_group", F.when(folder == "data", "main").otherwise(folder))


def read_keyed(spark: SparkSession, paths: str | list[str], key: str = "key", tolerant: bool = False) -> DataFrame:
    """Records, the last line of each key."""
    return last_per_key(read_records(spark, paths, tolerant=tolerant), key)


def local_key(path: Column) -> Column:
    """A path as a key: leading dots and slashes dropped, then a leading ``data/``."""
    return F.regexp_replace(F.regexp_replace(path, r"^[./]+", ""), r"^data/", "")


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """CSV with a header; an empty field is null."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def salvage_json(text: Column) -> Column:
    """What stands from the first brace to the last."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def assigned_json(text: Column) -> Column:
    """The JSON of a script that assigns it: what follows the first ``=``, less a final semicolon."""
    return F.rtrim(F.btrim(F.regexp_replace(text, r"(?s)^[^=]*=", ""), F.lit(" \n\r\t")), F.lit(";"))


def read_assigned(spark: SparkSession, path: str, schema: str, field: str) -> DataFrame:
    """The rows of one array field of a script file's object; ``schema`` is that of the whole object."""
    d = spark.read.text(path, wholetext=True).select(F.from_json(assigned_json(F.col("value")), schema).alias("o"))
    return d.select(F.inline(f"o.{field}"))


def paged_items(text: Column, item_schema: str, field: str) -> Column:
    """An array of (page, items) of an object of pages, each with a list ``field``."""
    pages = F.from_json(text, f"map<string, struct<`{field}`: array<{item_schema}>>>")
    return F.transform(F.map_entries(pages), lambda e: F.struct(e["key"].alias("page"), e["value"][field].alias("items")))


def pairs_by_pattern(html: Column, pattern: str, groups: tuple[int, ...] = (1, 2)) -> Column:
    """Structs (g1, g2, ...) for each match of a pattern, an array a group zipped."""
    return F.arrays_zip(*(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(g)).alias(f"g{g}") for g in groups))


LISTED = r"(?is)<li[^>]*>\s*<a[^>]*>([^<]+)</a>\s*,?\s*\(?((?:18|19)\d{2})?"
ITALIC = r"(?is)<(?:i|em|cite)>([^<]{3,140})</(?:i|em|cite)>[^<\d]{0,20}\(?((?:18|19)\d{2}(?:\s*[-–]\s*\d{2,4})?)"
HEADED = r"(?is)<h[1-4][^>]*>([^<]*?),?\s*\(?(19\d{2})\)?[^<]*</h[1-4]>"
LINKED = r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)[\"']?[^>]*>(.*?)</a>"
IMAGES = r"(?is)<img\b[^>]*?\bsrc\s*=\s*[\"']?([^\"'\s>]+)"
SITEMAP = r"(?is)<loc>\s*([^<]+?)\s*</loc>"
SOCIAL_IMAGE = r"(?is)<meta\b[^>]*?property\s*=\s*[\"']og:image[\"'][^>]*?content\s*=\s*[\"']([^\"']+)"
FILES = r"href=\"/wiki/(File:[^\"#?]+)\""


def html_list(pages: DataFrame, html: str = "html", pattern: str = LISTED) -> DataFrame:
    """A row (title, year) for each listed item of each page, other columns kept."""
    items = pages.withColumn("_m", F.explode(pairs_by_pattern(F.col(html), pattern)))
    year = F.regexp_extract("_m.g2", r"(\d{4})", 1).try_cast("int")
    return items.withColumn("title", X.strip(X.squeeze(F.col("_m.g1")))).withColumn("year", year).drop("_m", html)


def html_values(pages: DataFrame, name: str, pattern: str, html: str = "html") -> DataFrame:
    """A row for each distinct value of a pattern's first group on each page, in order of first sight."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(pattern), F.lit(1)))
    return pages.select("*", F.posexplode(found).alias("pos", name)).drop(html)


def page_image(html: Column, wanted: str = r"(?i)\.(?:jpe?g|png|webp)") -> Column:
    """A page's image: its social image, else the first that looks like one, in its larger variant."""
    social = F.nullif(F.regexp_extract(html, SOCIAL_IMAGE, 1), F.lit(""))
    plain = F.filter(F.regexp_extract_all(html, F.lit(IMAGES), F.lit(1)), lambda u: u.rlike(wanted) & ~u.rlike(r"(?i)sprite|icon|logo|avatar|pixel"))
    return X.larger_image(F.coalesce(social, F.get(plain, F.lit(0))))


def flat_bindings(text: Column, variables: list[str]) -> Column:
    """An array of structs of the variables' values from a query result's bindings."""
    one = ", ".join(f"`{v}`: struct<value: string>" for v in variables)
    rows = F.from_json(text, f"struct<results: struct<bindings: array<struct<{one}>>>>")["results"]["bindings"]
    return F.transform(rows, lambda b: F.struct(*(b[v]["value"].alias(v) for v in variables)))


def labelled_entity(labels: Column, languages: tuple[str, ...] = ("en", "fr", "de", "es")) -> Column:
    """The label in the first language that a map has, else any."""
    return F.coalesce(*(F.element_at(labels, F.lit(v)) for v in languages), F.get(F.map_values(labels), F.lit(0)))


def graph_pattern(triples: DataFrame, required: dict[str, str], optional: dict[str, str], subject: str = "subject") -> DataFrame:
    """A row for each subject: required properties join, optional ones join if there; several values give several rows.

    ``triples``: s, p, o. Properties map output columns to predicates.
    """
    out = None
    for how, wanted in (("inner", required), ("left", optional)):
        for column, predicate in wanted.items():
            t = triples.where(F.col("p") == predicate).select(F.col("s").alias(subject), F.col("o").alias(column))
            out = t if out is None else out.join(t, subject, how)
    if out is None:
        raise ValueError("no property is required")
    return out


def inline_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def blobs(rows: DataFrame, encoded: str = "data") -> DataFrame:
    """Base64 text decoded, with its size and SHA-256."""
    return rows.withColumn("content", F.unbase64(encoded)).withColumn("bytes", F.octet_length("content")).withColumn("sha256", F.sha2("content", 256)).drop(encoded)


def image_size(content: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF, JPEG or WebP file, or nothing."""
    b = content or b""
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return int.from_bytes(b[16:20]), int.from_bytes(b[20:24])
    if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
        return int.from_bytes(b[6:8], "little"), int.from_bytes(b[8:10], "little")
    if b[:4] == b"RIFF" and b[8:12] == b"WEBP" and len(b) >= 30:
        if b[12:16] == b"VP8X":
            return 1 + int.from_bytes(b[24:27], "little"), 1 + int.from_bytes(b[27:30], "little")
        if b[12:16] == b"VP8 ":
            return int.from_bytes(b[26:28], "little") & 0x3FFF, int.from_bytes(b[28:30], "little") & 0x3FFF
        if b[12:16] == b"VP8L":
            n = int.from_bytes(b[21:25], "little")
            return 1 + (n & 0x3FFF), 1 + (n >> 14 & 0x3FFF)
    if b[:2] == b"\xff\xd8":
        at = 2
        while at + 9 <= len(b) and b[at] == 0xFF:
            if 0xC0 <= b[at + 1] <= 0xCF and b[at + 1] not in (0xC4, 0xC8, 0xCC):
                return int.from_bytes(b[at + 7 : at + 9]), int.from_bytes(b[at + 5 : at + 7])
            at += 2 + int.from_bytes(b[at + 2 : at + 4])
    return None


@F.pandas_udf(T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType())]))
def image_size_udf(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([image_size(c) or (None, None) for c in content], columns=["width", "height"]).astype("Int32")


def read_images(spark: SparkSession, path: str, least_bytes: int = 8000, least_side: int = 80) -> DataFrame:
    """Image files below ``path``: large enough, with a header that can be read, at least so many pixels a side."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{jpg,jpeg,png,webp,JPG,JPEG,PNG,WEBP}").load(path)
    d = d.where(F.col("length") >= least_bytes).withColumn("_s", image_size_udf("content"))
    return d.select("path", "length", F.col("_s.width").alias("width"), F.col("_s.height").alias("height"), F.sha2("content", 256).alias("sha256")).where(F.least("width", "height") >= least_side)


def first_image_url(value: object) -> str | None:
    """The first text under ``id`` or ``@id`` of a nested JSON value that looks like an image's address."""
    if isinstance(value, dict):
        for k in ("id", "@id"):
            v = value.get(k)
            if isinstance(v, str) and re.search(r"\.(jpe?g|png|webp|tiff?)(\?|$)|/full/", v, re.I):
                return v
        value = list(value.values())
    if isinstance(value, list):
        return next((u for u in map(first_image_url, value) if u), None)
    return None


@F.pandas_udf(T.StringType())
def nested_image(text: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        try:
            return first_image_url(json.loads(t or "null"))
        except ValueError:
            return None

    return text.map(one)


def coalesced(rows: DataFrame, **alternatives: list[str]) -> DataFrame:
    """Each output column is the first of its alternatives that is present."""
    have = set(rows.columns)
    return rows.select("*", *(X.first_truthy(*(F.col(c).cast("string") for c in cols if c in have)).alias(out) for out, cols in alternatives.items()))


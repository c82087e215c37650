"""What a reader asks of a catalogue: search, modes, facets, sorts, checklists, captions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.text import html_escape, truthy
from vellum.functions.years import year_label


def haystack(*parts: Column) -> Column:
    """Lower-case text of the parts that are neither null, empty nor zero."""
    return F.lower(F.concat_ws(" ", *(F.when(~p.cast("string").isin("", "0"), p.cast("string")) for p in parts)))


def search(rows: DataFrame, query: str, *parts: str) -> DataFrame:
    """Rows whose parts contain the query, case ignored; a blank query keeps all."""
    q = query.strip().lower()
    return rows.where(haystack(*map(F.col, parts)).contains(q)) if q else rows


def in_mode(images: DataFrame, mode: str = "works") -> DataFrame:
    """``works``: primary images; ``files``: all."""
    return images if mode == "files" else images.where("primary")


def facet(images: DataFrame, points: DataFrame, cluster: int | None = None) -> DataFrame:
    """Images that have a point, of one cluster or all."""
    p = points if cluster is None else points.where(F.col("cluster") == cluster)
    return images.join(p, images.id == p.id, "left_semi")


def facet_counts(points: DataFrame, clusters: DataFrame) -> DataFrame:
    """Legend entries (id, label) with counts, and one for all."""
    n = points.groupBy("cluster").agg(F.count("*").alias("n"))
    each = clusters.join(n, clusters.id == n.cluster, "left").select("id", "name", F.coalesce("n", F.lit(0)).alias("n"))
    every = each.agg(F.lit(-1).alias("id"), F.lit("All").alias("name"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return every.unionByName(each).withColumn("label", F.concat_ws(" · ", "name", F.col("n").cast("string")))


def wall_order(key: str = "year", descending: bool = False) -> list[Column]:
    """Sort columns for images (title, year, source, w, h, work_id, work_year): a key either way, then title in locale order."""
    value = {
        "year": F.coalesce(F.nullif(F.col("year"), F.lit(0)), F.lit(9999)),
        "title": F.lower(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit("￿"))),
        "source": F.coalesce(F.col("source"), F.lit("")),
        "size": F.col("w") * F.col("h"),
        "index": F.when(F.col("work_id").isNull(), 10000).otherwise(F.coalesce(F.nullif(F.col("work_year"), F.lit(0)), F.lit(9999))),
    }[key]
    return [value.desc() if descending else value.asc(), F.collate(F.coalesce(F.col("title"), F.lit("")), "UNICODE").asc()]


def checklist(works: DataFrame, show: str = "all", query: str = "") -> DataFrame:
    """all, have or missing among the index's works, or the extra ones."""
    rows = works.where("extra") if show == "extra" else works.where(~F.col("extra") & (F.lit(show == "all") | (F.col("status") == show)))
    return search(rows, query, "title", "year", "collection")


def checklist_order(key: str = "year") -> list[Column]:
    year, title = F.coalesce(F.nullif(F.col("year"), F.lit(0)), F.lit(9999)), F.collate(F.col("title"), "UNICODE")
    return {"title": [title], "year": [year, title], "gap": [F.col("status") != "missing", year, title]}[key]


def caption(title: Column, year: Column, place: Column, source: Column, copies: Column, page: Column) -> Column:
    """A tile's caption as mark-up."""
    where = F.coalesce(F.nullif(place, F.lit("")), F.nullif(source, F.lit("")))
    files = F.when(copies > 1, F.concat(copies.cast("string"), F.lit(" files")))
    bits = F.concat_ws(" · ", F.nullif(year_label(year), F.lit("")), where, files)
    link = F.when(truthy(page), F.concat(F.lit(' · <a href="'), page, F.lit('" target="_blank" rel="noopener">source</a>'))).otherwise("")
    return F.concat(F.lit("<b>"), html_escape(F.coalesce(F.nullif(title, F.lit("")), F.lit("Untitled"))), F.lit("</b><span>"), html_escape(bits), link, F.lit("</span>"))


def detail(works: DataFrame, images: DataFrame, work_id: str) -> DataFrame:
    """A work and its images; one without has a row with its first source."""
    w = works.where(F.col("id") == work_id).select(F.col("id").alias("work"), F.col("title").alias("work_title"), F.get("sources", F.lit(0)).alias("first_source"))
    return w.join(images, w.work == images.work_id, "left")

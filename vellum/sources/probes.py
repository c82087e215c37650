"""Answers of sources whose APIs differ, read as variants: their shapes, their items as records of one form, and a report of what each source holds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Probe:
    """How one source's answers are read, by paths into their JSON.

    ``total``: the number of matches that an answer states. ``items``: the list of
    matches, ``fields`` the names and paths of what an item says, ``keep`` which items count
    (a condition on those fields). Where both are given the items are what counts. A field may have several
    paths; the first that leads to a value that is not empty is taken.
    """

    name: str
    total: str | None = None
    items: str | None = None
    fields: dict[str, str | tuple[str, ...]] = field(default_factory=dict)
    keep: Callable[[Callable[[str], Column]], Column] | None = None


def read(answers: DataFrame) -> DataFrame:
    """``answers`` (name, status, body) with ``value``: the body as a variant; null for another status than 200 or what is not JSON."""
    return answers.withColumn("value", F.when(F.col("status") == 200, F.try_parse_json("body")))


def shapes(answers: DataFrame) -> DataFrame:
    """(name, n, unread, shape): the schema that all readable answers of a source have in common, found by aggregation."""
    return read(answers).groupBy("name").agg(F.count("*").alias("n"), F.count_if(F.col("value").isNull()).alias("unread"), F.schema_of_variant_agg("value").alias("shape"))


def _of(probes: list[Probe], value: Callable[[Probe], Column | None], kind: str) -> Column:
    """The value of the row's own source, in one pass over all sources' answers."""
    out = None
    for p in probes:
        if (c := value(p)) is not None:
            here = F.col("name") == p.name
            out = F.when(here, c) if out is None else out.when(here, c)
    return F.lit(None).cast(kind) if out is None else out


def _paths(probe: Probe, name: str) -> tuple[str, ...]:
    """The paths of a field, none where the source has no such field."""
    paths = probe.fields.get(name, ())
    return (paths,) if isinstance(paths, str) else paths


def _said(each: DataFrame, probes: list[Probe], names: list[str]) -> DataFrame:
    """``each`` with the first value along the paths of each field that is not empty, as text: objects and lists as JSON.

    What lies at a path is a column first: asked for emptiness in the same step it would be looked for twice.
    """
    most = {n: max(len(_paths(p, n)) for p in probes) for n in names}
    at = lambda p, n, j: F.trim(F.try_variant_get("_i", _paths(p, n)[j], "string")) if j < len(_paths(p, n)) else None
    found = each.withColumns({f"_{n}_{j}": _of(probes, lambda p, n=n, j=j: at(p, n, j), "string") for n in names for j in range(most[n])})
    said = {n: F.coalesce(*(F.nullif(f"_{n}_{j}", F.lit("")) for j in range(most[n]))) if most[n] else F.lit(None).cast("string") for n in names}
    return found.select(*(F.col(c) for c in each.columns if c != "_i"), *(c.alias(n) for n, c in said.items()))


def items(answers: DataFrame, probes: list[Probe]) -> DataFrame:
    """One record an item, whatever its source: the columns of ``answers`` but body, place (from 0), then all fields as text, null where a source has none; items that ``keep`` does not hold for are left out.

    An answer that is not readable or has no list where one is expected gives no record.
    """
    names = list(dict.fromkeys(n for p in probes for n in p.fields))
    listed = answers.where(F.col("name").isin([p.name for p in probes if p.items]))
    held = read(listed).withColumn("_l", _of(probes, lambda p: F.try_variant_get("value", p.items, "array<variant>") if p.items else None, "array<variant>"))
    each = held.select(*(c for c in answers.columns if c != "body"), F.posexplode_outer("_l").alias("place", "_i"))
    each = each.where(F.col("place").isNotNull())  # from posexplode a filter on the size of the list would follow, that reads each body once more
    said = _said(each, probes, names)
    kept = _of(probes, lambda p: p.keep(F.col) if p.keep else F.lit(True), "boolean")
    return said.where(kept)


def report(answers: DataFrame, probes: list[Probe]) -> DataFrame:
    """(name, probed, refused, unread, works, holds, detail) of each source, counted over all its answers.

    refused: answers of another status than 200; unread: those that are no JSON; works: stated totals, or items
    kept; null, as holds, where no answer could be read, so that nothing is known.
    detail: the statuses of refused answers, least first, or null.
    """
    seen = read(answers).select("name", "status", F.col("value").isNotNull().alias("ok"), _of(probes, lambda p: F.try_variant_get("value", p.total, "long") if p.total and not p.items else None, "long").alias("n"))
    refused = ~F.col("status").eqNullSafe(F.lit(200))
    told = seen.groupBy("name").agg(
        F.count("*").alias("probed"), F.count_if(refused).alias("refused"), F.count_if(~refused & ~F.col("ok")).alias("unread"), F.count_if("ok").alias("_ok"), F.sum("n").alias("_n"),
        F.array_sort(F.collect_set(F.when(refused, F.coalesce(F.col("status").cast("string"), F.lit("none"))))).alias("_s"),  # statuses: some dozens at most
    )
    listed = items(answers, probes).groupBy(F.col("name").alias("_name")).agg(F.count("*").alias("_items"))
    works = F.when(F.col("_ok") > 0, F.coalesce("_items", "_n", F.lit(0)))
    out = told.join(listed, F.col("name") == F.col("_name"), "left").withColumn("works", works)
    return out.select("name", "probed", "refused", "unread", "works", (F.col("works") > 0).alias("holds"), F.when(F.size("_s") > 0, F.concat(F.lit("status "), F.array_join("_s", ", "))).alias("detail"))

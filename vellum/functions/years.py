"""Years and dates in free text. Patterns are read with ``(?U)``: Unicode classes, as the source data are multilingual."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.profile import Profile


def _year(text: Column, pattern: str, group: int = 1) -> Column:
    return F.expr("try_cast(null as int)") if text is None else F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("int")


def year_from(text: Column) -> Column:
    """The first stand-alone year 1800 to 1999, or null."""
    return _year(text.cast("string"), r"(?U)\b((?:18|19)\d{2})\b")


def year_from_web(text: Column) -> Column:
    """The first stand-alone year 1800 to 1970, or null."""
    return _year(text.cast("string"), r"(?U)\b(18\d{2}|19[0-6]\d|1970)\b")


def years_in(text: Column, first: int = 1904, last: int = 1970) -> Column:
    """(year, year_end): the first year in bounds, and the second if it differs."""
    found = F.filter(
        F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\b(19[0-9]{2})\b"), F.lit(1)), lambda y: y.cast("int")),
        lambda y: y.between(first, last),
    )
    start, end = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    return F.struct(start.alias("year"), F.when(end != start, end).alias("year_end"))


def parse_year(raw: Column, birth_year: int = 1885) -> Column:
    """(year, year_range) of a date in text: a range, a stand-alone year or an ISO prefix.

    Single years count from 1880 to 1975 but for the birth year; the start of a
    range is taken as it stands. Tokens for "unknown" give nulls; any other text
    is kept as the range.
    """
    s = F.btrim(raw.cast("string"))
    ranged = r"(19\d{2})\s*[-–—/]\s*(19\d{2}|\d{2})"
    first, second = F.regexp_extract(s, ranged, 1), F.regexp_extract(s, ranged, 2)
    end = F.when(F.length(second) == 4, second.try_cast("int")).otherwise(1900 + second.try_cast("int"))
    alone = _year(s, r"(?U)\b((?:18|19)\d{2})\b")
    iso = _year(s, r"^(\d{4})-")
    fits = lambda y: y.between(1880, 1975) & (y != birth_year)
    none = F.struct(F.lit(None).cast("int").alias("year"), F.lit(None).cast("string").alias("year_range"))
    pair = lambda y, r: F.struct(y.cast("int").alias("year"), r.alias("year_range"))
    return (
        F.when(s.isNull() | s.isin("", "?", "n.d.", "nd", "unknown"), none)
        .when(first != "", pair(first.try_cast("int"), F.concat_ws("-", first, end.cast("string"))))
        .when(alone.isNotNull() & fits(alone), pair(alone, s))
        .when(alone.isNull() & iso.isNotNull() & fits(iso), pair(iso, s))
        .when(alone.between(1880, 1975) & (alone != birth_year), pair(alone, s))
        .otherwise(pair(F.lit(None), s))
    )


def year_of_number(raw: Column, birth_year: int = 1885) -> Column:
    """(year, year_range) of a number: 1880 to 1975 but for the birth year."""
    ok = raw.between(1880, 1975) & (raw != birth_year)
    return F.struct(F.when(ok, raw.cast("int")).alias("year"), F.when(ok, raw.cast("string")).alias("year_range"))


def query_year(text: Column) -> Column:
    """The first stand-alone year of a query, if it is from 1880 to 1975."""
    y = year_from(text)
    return F.when(y.between(1880, 1975), y)


def scrub_year(year: Column, profile: Profile | None = None) -> Column:
    """Years that cannot be of a work become null; those just before the working life stay."""
    last = (profile or Profile()).last_year
    return F.when(year.between(1900, last), year)


def iso_date(text: Column) -> Column:
    return F.substring(text, 1, 10)


def stamp(at: Column) -> Column:
    """``yyyy-MM-dd HH:mm UTC`` of a timestamp in a UTC session."""
    return F.concat(F.date_format(at, "yyyy-MM-dd HH:mm"), F.lit(" UTC"))


def year_gap(a: Column, b: Column) -> Column:
    return F.abs(a - b)


def year_label(year: Column) -> Column:
    """Text of a year; empty where it is null or 0."""
    return F.coalesce(F.nullif(year, F.lit(0)).cast("string"), F.lit(""))

"""Titles, file names, URLs and mark-up as column expressions.

Everything here is a built-in expression, but ``norm`` and the HTML functions,
for which Spark has no compatibility decomposition and no HTML reader; those are
Arrow functions over whole batches.
"""

from __future__ import annotations

import html as html_module
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions.profile import Profile

# Words that decide how titles are read.
MEDIUM_TAIL = r"(?iU)\b(oil(on)?|on canvas|on board|on wood|wood pulp|paperboard|jpg|jpeg|png|canvas)\b.*$"
MEDIUM_WORDS = r"(?iU)\b(oil on|canvas|wood|board|paperboard|jpg|jpeg)\b"
IMAGE_SUFFIX = r"(?i)\.(jpe?g|png|gif|webp|tif{1,2})$"
INVENTORY_TAIL = r"(?i)\s*\((?:NGC|AGO|acc\.?|inv\.?|cat\.?)[^)]*\)\s*$"
STOP_WORDS = ("the", "a", "an", "of", "by")
GENERIC = r"^(untitled|abstraction|abstract|shoreline|winter morning|lake superior)$"


def truthy(c: Column, kind: str = "string") -> Column:
    """Present in the sense of the source data: not null, not empty, not zero."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind == "array":
        return F.coalesce(F.size(c) > 0, F.lit(False))
    return c.isNotNull() & (c != 0)


def first_truthy(*cols: Column) -> Column:
    """The first of several strings that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols))


def rewrite(c: Column, *steps: tuple[str, str]) -> Column:
    """Regular-expression replacements, in order."""
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def strip(c: Column, chars: str = " \t\n\r\f\u000b") -> Column:
    return F.btrim(c, F.lit(chars))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space."""
    return F.regexp_replace(c, r"(?U)\s+", " ")


def slugify(s: Column, cap: int = 120) -> Column:
    """Lower-case ASCII words joined by hyphens, trimmed, then cut at ``cap``; ``untitled`` where nothing is left."""
    slug = F.substring(strip(F.regexp_replace(F.lower(F.coalesce(s, F.lit(""))), r"[^a-z0-9]+", "-"), "-"), 1, cap)
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("untitled"))


def norm(s: Column, profile: Profile | None = None) -> Column:
    """Matching form of a title: decomposed, lower case, words of ASCII letters and digits, without stop words and names.

    A combining mark separates, as in the source data: an accented letter ends a word part.
    """
    drop = "|".join((*(profile or Profile()).words, *STOP_WORDS))
    quote, other, names, gaps = "'", re.compile(r"[^a-z0-9]+"), re.compile(rf"\b({drop})\b"), re.compile(r"\s+")

    @F.pandas_udf(T.StringType())
    def apply(v: pd.Series) -> pd.Series:
        def one(t: str | None) -> str:
            t = unicodedata.normalize("NFKD", t or "").lower().replace(quote, "")
            return gaps.sub(" ", names.sub(" ", other.sub(" ", t))).strip()

        return v.map(one)

    return apply(s)


def clean_title(t: Column, profile: Profile | None = None) -> Column:
    """A display title without attribution, medium, date and site decoration."""
    # The patterns and the characters trimmed between them; each reads what the last one left.
    p = profile or Profile()
    c = squeeze(F.coalesce(t, F.lit("")))
    c = strip(F.regexp_replace(c, "[\"“”'`]+", ""), " ~")
    c = rewrite(
        c, (rf"(?iU)\s*[-–|]\s*(?:{p.any_given}).*$", ""), (rf"(?iU)\s+by (?:{p.any_given}).*$", ""),
        (r"(?iU)\s+oil\s*on.*$", ""), (MEDIUM_TAIL, ""),
    )
    c = strip(F.regexp_replace(strip(c, " -–,~"), r"(?U)\s+\(c\.?$", ""))
    c = rewrite(
        c, (rf"(?iU)^{p.full}\s+(?=\S)", ""), (r"(?iU)\s+(MutualArt|Artwork performance.*)$", ""), (r"(?iU)\s*\((?:ca\.?|c\.)\s*$", ""),
        (r"(?U)\s*~\s*\d{4}$", ""), (r"(?U)\s*\((?:ca\.?\s*)?\d{4}(?:-\d{2,4})?\)$", ""), (r"(?U)(?<![,\d])\s+\d{4}-\d{4}$", ""),
    )
    c = strip(c, " ,-")
    c = strip(F.regexp_replace(c, r"(?iU)[\s,]*(Canadian art,\s*)?Group of seven (paintings|artists)[\s,]*", " "), " ,-")
    return strip(F.regexp_replace(c, r"(?U)\s+Fine Art$", ""))


def norm_title(t: Column, profile: Profile | None = None) -> Column:
    """An index title: plain dashes and quotes, no attribution, inventory number or medium."""
    # The patterns and the characters trimmed.
    p = profile or Profile()
    c = squeeze(strip(F.coalesce(t, F.lit(""))))
    c = F.translate(c, "–—−‘’“” ", "---''\"\" ")
    c = rewrite(c, (rf"(?iU)\s+by\s+{p.full}\b.*$", ""), (INVENTORY_TAIL, ""), (r"(?iU)\s*[-–—]\s*(?:oil on|canvas|board).*$", ""))
    return strip(F.rtrim(strip(c, " .,-;:\"'"), F.lit("~")))


def title_key(t: Column, profile: Profile | None = None) -> Column:
    """Lower-case words of an index title."""
    return strip(squeeze(F.regexp_replace(F.lower(norm_title(t, profile)), r"(?U)[^\w\s]", "")))


def is_generic(normed: Column) -> Column:
    """Titles that many works share, so that they identify none."""
    return normed.rlike(GENERIC)


def norm_query(s: Column, profile: Profile | None = None) -> Column:
    """A search text or file name as words."""
    c = strip(s)
    c = F.when(c.contains("/") | c.contains("\\"), F.regexp_extract(c, r"([^/]*)/*$", 1)).otherwise(c)
    c = F.translate(F.regexp_replace(c, IMAGE_SUFFIX, ""), "_-", "  ")
    return strip(squeeze(rewrite(c, (rf"(?iU)\b{(profile or Profile()).full}\b", " "), (MEDIUM_WORDS, " "))))


def without_years(q: Column) -> Column:
    """A query without stand-alone years, or as it is where nothing else is left."""
    bare = strip(squeeze(F.regexp_replace(q, r"(?U)\b(18\d{2}|19\d{2})\b", " ")))
    return F.when(bare == "", q).otherwise(bare)


def stem_of(path: Column) -> Column:
    """The last part of a path without its suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def title_from_name(name: Column, profile: Profile | None = None) -> Column:
    """(title, year) of a file name of hyphenated words."""
    from vellum.functions.years import years_in

    p = profile or Profile()
    stem = F.regexp_replace(stem_of(name), r"(?i)-(jpg|jpeg|png|webp)$", "")
    if p.given and p.family:
        stem = F.regexp_replace(stem, rf"^(?i)(?:{p.any_given})-(?:[a-z]-?)?{re.escape(p.family)}-", "")
    year = years_in(F.translate(stem, "-", " "), p.first_year, p.last_year)["year"]
    bare = rewrite(stem, (r"(?U)-?\b(19[0-6]\d|1970)\b.*$", ""), (r"-\d{3,}$", ""))
    return F.struct(clean_title(F.translate(bare, "-", " "), p).alias("title"), year.alias("year"))


def title_fallback(title: Column, path: Column) -> Column:
    """A title, or the words of the file name."""
    return first_truthy(title, F.translate(stem_of(path), "-", " "))


def guess_title(text: Column, profile: Profile | None = None) -> Column:
    """(title, year) of a line of web text: what stands before a year, or the first part of some length."""
    p = profile or Profile()
    line = squeeze(F.coalesce(text, F.lit("")))
    dated = r"(?U)^(.{3,}?)[\s,(]+(18\d{2}|19[0-6]\d|1970)\b"
    before = strip(F.regexp_replace(F.regexp_extract(line, dated, 1), rf"(?iU)^{p.full}[\s,:-]*", ""), " ,-:(")
    parts = F.filter(F.transform(F.split(line, r"\s+[-|·—]\s+"), lambda x: F.trim(x)), lambda x: F.length(x).between(4, 119))
    return F.when(
        before != "", F.struct(F.substring(before, 1, 200).alias("title"), F.regexp_extract(line, dated, 2).try_cast("int").alias("year"))
    ).otherwise(F.struct(F.get(parts, F.lit(0)).alias("title"), F.lit(None).cast("int").alias("year")))


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag: str) -> None:
        self.hidden = max(0, self.hidden - (tag in ("script", "style")))

    def handle_data(self, data: str) -> None:
        if not self.hidden and data.strip():
            self.parts.append(data.strip())


@F.pandas_udf(T.StringType())
def strip_html(s: pd.Series) -> pd.Series:
    """The text of mark-up, parts joined by one space; empty for null."""

    def one(t: str | None) -> str:
        if not t:
            return ""
        reader = _Text()
        reader.feed(t)
        reader.close()
        return " ".join(reader.parts)

    return s.map(one)


@F.pandas_udf(T.StringType())
def clean_text(s: pd.Series) -> pd.Series:
    """Text of a search result: entities decoded, tags and private-use marks dropped, white space squeezed."""
    return s.map(lambda t: " ".join(re.sub("[-]", "", re.sub(r"<[^>]+>", " ", html_module.unescape(t or ""))).split()))


def html_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def host_of(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def domain_of(url: Column) -> Column:
    """The host in lower case without ``www.``."""
    return F.regexp_replace(host_of(url), r"^www\.", "")


def url_basename(url: Column) -> Column:
    return F.url_decode(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), r"([^/]*)/?$", 1))


def url_suffix(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), r"(\.[^./]+)$", 1))


def url_parameter(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def larger_image(url: Column) -> Column:
    """The address of the full-size image behind a thumbnail's: thumbnail folders, size suffixes and size parameters dropped."""
    return rewrite(
        url, (r"/thumb/(.+)/[^/]+$", "/$1"), (r"![A-Za-z]+\.(jpg|jpeg|png)$", ""), (r"=s\d+(-[a-z]+)?$", "=s0"), (r"_m\.(jpg|png)$", "_b.$1"),
    )


def has_cyrillic(s: Column) -> Column:
    return s.rlike("[Ѐ-ӿ]")


def sold_for(text: Column) -> Column:
    """The amount after "sold for" as a number: ``$1,234`` gives 1234."""
    return F.translate(F.regexp_extract(text, r"(?i)sold\s+for\s*:?\s*\$\s*([\d,]+)", 1), ",", "").try_cast("long")


def dimensions_in(text: Column) -> Column:
    """The first measure such as ``30 x 40 cm`` or ``12 1/2 x 16 in``."""
    return F.nullif(F.regexp_extract(text, r"(?i)(\d+(?:[.,]\d+)?(?:\s+\d/\d)?\s*[x×]\s*\d+(?:[.,]\d+)?(?:\s+\d/\d)?\s*(?:cm|mm|in(?:ches)?))", 1), F.lit(""))


def medium_in(text: Column) -> Column:
    """The first medium such as ``oil on canvas``."""
    return F.nullif(F.lower(F.regexp_extract(text, r"(?i)\b((?:oil|watercolou?r|acrylic|tempera|graphite|pencil|charcoal|ink)\s+on\s+(?:canvas|board|panel|paper|wood|paperboard))\b", 1)), F.lit(""))


def labelled_field(text: Column, label: str) -> Column:
    """The line after a label line, as on museum labels."""
    return F.nullif(F.trim(F.regexp_extract(text, rf"(?m)^{re.escape(label)}\s*\n\s*([^\n]+)", 1)), F.lit(""))


def name_to_title(name: Column, profile: Profile | None = None) -> Column:
    """(title, year, year_range) of an image file name: suffix, names, medium, years and number fragments dropped.

    A title all in lower case gets capitals at word starts.
    """
    p = profile or Profile()
    base = F.translate(F.regexp_replace(F.regexp_replace(name, r"^File:", ""), IMAGE_SUFFIX, ""), "_", " ")
    years = F.regexp_extract(base, r"(?U)\b(19\d{2}(?:\s*[-–]\s*(?:19)?\d{2})?)\b", 1)
    bare = rewrite(
        base, (rf"(?iU){p.full}", " "), (MEDIUM_TAIL, ""), (r"(?U)\(?\b19\d{2}(?:\s*[-–]\s*(?:19)?\d{2})?\b\)?", " "), (r"(?U)\b\d{3,5}\b", " "),
    )
    title = strip(squeeze(bare), " -,.()~")
    title = F.when(title == F.lower(title), F.initcap(title)).otherwise(title)
    return F.struct(
        F.nullif(title, F.lit("")).alias("title"), F.nullif(F.substring(years, 1, 4), F.lit("")).try_cast("int").alias("year"), F.nullif(years, F.lit("")).alias("year_range")
    )

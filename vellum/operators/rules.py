"""Ordered rules as data: the first that holds names a row's reason, class or level."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import text as X
from vellum.functions.profile import Profile


@dataclass(frozen=True)
class Rule:
    """``label`` where ``when`` holds."""

    label: str
    when: Column


def first_rule(rules: Iterable[Rule], default: Column | None = None) -> Column:
    """The label of the first rule that holds, or ``default`` (null)."""
    out = None
    for r in rules:
        out = (F if out is None else out).when(r.when, F.lit(r.label))
    none = default if default is not None else F.lit(None).cast("string")
    return none if out is None else out.otherwise(none)


def classified(rows: DataFrame, rules: Iterable[Rule], column: str = "reason", default: Column | None = None) -> DataFrame:
    return rows.withColumn(column, first_rule(rules, default))


def kept_and_rejected(rows: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that no rule rejects, and the others with their reason."""
    c = classified(rows, rules)
    return c.where("reason is null").drop("reason"), c.where("reason is not null")


# Words that mark a text as no title of a work.
JUNK = (
    r"(?iU)\b(born|died|exhibition|retrospective|biography|formation of|hanging committee|logic of ecstasy|wikipedia|retrieved|"
    r"was a |member of|christmas|http|www\.|society of artists|painter.s progress|art canada|group of seven was)\b|in snow\)|ft\) canada"
)
PUBLICATION = r"(?iU)\b(yearbook|four decades|group of painters|contemporaries|urban scenes|north by west|winston)\b"
GARBLED = r"(?iU)studio|o\.s\.a|%C3|musee d|musée d"
MONTH_DAY = r"^(January|February|March|April|May|June|July|August|September|October|November|December) \d{1,2}$"
NAMED_SOURCES = ("wikidata", "wikiart", "commons.wikimedia", "mcmichael", "gallery.ca")
JUNK_TITLE = (
    r"(?iU)^\s*$|was born|october\s+23|ll\.?\s*d\.?|hanging committee|ontario society of artists|^(the )?(idea of north|higher states|canadian encyclopedia|essay on)|"
    r"international exhibition|where the universe sings|click here|read more|references|external link|edit section|wikipedia|subscribe|newsletter|^\(?\s*188[0-9]"
)
VERBS = r"(?iU)\b(was|were|born|died|lived|moved|became)\b"


def work_rules(profile: Profile | None = None, title: str = "title") -> list[Rule]:
    """Why a record is no work: rules over title (cleaned, in ``_t``), normed title (``_n``), year, collection, sources, confidence."""
    p = profile or Profile()
    t, raw, n = F.col("_t"), F.coalesce(F.col(title), F.lit("")), F.col("_n")
    words = F.size(F.filter(F.split(t, r"\s+"), lambda x: x != ""))
    no_collection = ~X.truthy(F.col("collection"))
    listed = F.lower(F.array_join(F.coalesce("sources", F.array().cast("array<string>")), " "))
    named = F.lit(False)
    for s in NAMED_SOURCES:
        named = named | listed.contains(s)
    year = F.col("year")
    has_year = X.truthy(year, "int")
    return [
        Rule("length", ~F.length(t).between(3, 90)),
        Rule("junk", t.rlike(JUNK) | raw.rlike(JUNK)),
        Rule("fragment", t.rlike(r"(?iU)^(on|in) [a-z]")),
        Rule("name", t.rlike(rf"(?iU)^({p.any_given})\b")),
        Rule("sentence", t.rlike(rf"(?U)\b({p.any_given})\b") & (words > 4)),
        Rule("publication", t.rlike(PUBLICATION)),
        Rule("identifier", t.rlike(r"^Q\d+$")),
        Rule("garbled", t.rlike(GARBLED)),
        Rule("date", t.rlike(MONTH_DAY)),
        Rule("long", (words > 10) & no_collection),
        Rule("year", year.isNotNull() & ~year.between(p.first_year, p.last_year)),
        Rule("punctuation", t.endswith(".") | (F.length(t) - F.length(F.replace(t, F.lit(","))) > 2)),
        Rule("weak", (F.coalesce(F.nullif(F.col("confidence"), F.lit("")), F.lit("medium")) == "low") & ~named & no_collection),
        Rule("generic", X.is_generic(n) & ~has_year),
    ]


def works(records: DataFrame, profile: Profile | None = None) -> DataFrame:
    """``records`` with _t, _n and the reason why each is no work (null for works)."""
    d = records.withColumn("_t", X.clean_title(F.col("title"), profile))
    return classified(d.withColumn("_n", X.norm(F.col("_t"), profile)), work_rules(profile))


def plausible_title(title: Column, profile: Profile | None = None) -> Column:
    """Whether an index title can be a work's."""
    p = profile or Profile()
    t = X.norm_title(title, p)
    others = "|".join(p.others) or r"(?!)"
    spaces = F.length(t) - F.length(F.replace(t, F.lit(" ")))
    bare = t.rlike(rf"(?iU)^(?:{p.full}|{p.family or '(?!)'})$")
    return ~(
        ~F.length(t).between(3, 140) | t.rlike(f"(?iU){others}") | t.rlike(JUNK_TITLE) | ((spaces > 14) & (t.contains(",") | t.endswith("."))) | t.rlike(VERBS) | bare
    )


def attribution(text: Column, profile: Profile, trusted: Column | None = None) -> Column:
    """(ok, reason): whether a text speaks of a work by the maker; ``trusted`` sources need no name."""
    t = F.coalesce(text, F.lit(""))
    others = "|".join(profile.others) or r"(?!)"
    reason = first_rule(
        [
            Rule("other person", t.rlike(f"(?iU){others}")),
            Rule("photograph", t.rlike(r"(?iU)\b(photograph|photo) (of|by)\b|\bportrait photo")),
            Rule("named", t.rlike(f"(?iU){profile.full}")),
            *([Rule("trusted source", trusted)] if trusted is not None else []),
        ],
        F.lit("no name"),
    )
    return F.struct(reason.isin("named", "trusted source").alias("ok"), reason.alias("reason"))


def confidence(title: Column, year: Column, named: Column, host: Column, shops: tuple[str, ...] = ("etsy", "redbubble", "fineartamerica", "amazon", "ebay")) -> Column:
    """high with title, year and name; medium with title and one of them; else low; shops are always low."""
    shop = F.lit(False)
    for s in shops:
        shop = shop | F.coalesce(host, F.lit("")).contains(s)
    has, dated, named = X.truthy(title), X.truthy(year, "int"), F.coalesce(named, F.lit(False))
    return F.when(shop, "low").when(has & dated & named, "high").when(has & (dated | named), "medium").otherwise("low")


def collection_name(c: Column) -> Column:
    """Placeholders become null, ``private`` a private collection."""
    low = F.lower(c)
    return F.when(low.isin("flickr", "unknown", "n/a"), F.lit(None).cast("string")).when(low == "private", "private collection").otherwise(c)


#: A path part, the source that it stands for, and sources by falling trust. Fixed values.
PATH_SOURCES = [
    (("mcmichael",), "McMichael"), (("heffel",), "Heffel"), (("wikiart",), "WikiArt"), (("flickr-com",), "Flickr"), (("commons", "commons_deep"), "Commons"),
    (("auctions",), "Auction"), (("canada_museums", "intl_museums"), "Museum"), (("archives",), "Archive"),
]
SOURCE_RANK = ["McMichael", "Museum", "WikiArt", "Commons", "Archive", "Heffel", "Auction"]


def source_of(path: Column) -> Column:
    """The source that a file's folders name; a web search's domain folder, or ``Folder``."""
    parts = F.split(path, "/")
    domain = F.get(F.filter(parts, lambda p: p.endswith("-com") | p.endswith("-org")), F.lit(0))
    rules = [Rule(label, F.arrays_overlap(parts, F.array(*map(F.lit, names)))) for names, label in PATH_SOURCES]
    web = F.replace(F.coalesce(domain, F.lit("Web")), F.lit("-"), F.lit("."))
    return first_rule(rules, F.when(F.array_contains(parts, "web_search"), web).otherwise("Folder"))


def source_rank(source: Column, order: list[str] | None = None, unknown: int = 50) -> Column:
    at = F.array_position(F.array(*map(F.lit, order or SOURCE_RANK)), source)
    return F.when(at > 0, (at - 1).cast("int")).otherwise(unknown)


def family_of(url: Column, families: list[tuple[str, str]], other: str = "other") -> Column:
    """The first family (name, mark) whose mark occurs in a URL."""
    return first_rule([Rule(name, F.lower(url).contains(mark)) for name, mark in families], F.lit(other))


def openly_licensed(license: Column) -> Column:
    return F.lower(license).rlike(r"(?iU)public domain|cc0|cc[ -]by(?!.*n[cd])|\bpd\b")


# Further predicates and classifiers

#: Words of pictures of people, of sites' furniture, of merchandise, of roles and media that are no works.
PERSON_PHOTO = r"(?iU)\b(at (his|her|their) studio|hanging committee|o\.s\.a)\b"
FURNITURE = r"(?i)sprite|icon|logo|avatar|pixel|placeholder|thumbnail_default"
MERCHANDISE = r"(?iU)\b(poster|print on demand|mug|t-?shirt|calendar|puzzle|phone case|greeting card|wall art|canvas print)\b"
NO_ARTIST = r"(?i)\b(sitter|subject|photographer|publisher|collector)\b"
UNUSUAL_MEDIUM = r"(?i)\b(letter|archive|photograph|poster|book|lithograph after|reproduction)\b"
IMAGE_TYPES = ("image/jpeg", "image/png", "image/webp", "image/tiff")


def is_image_type(mime: Column, allowed: tuple[str, ...] = IMAGE_TYPES) -> Column:
    return F.lower(mime).isin(*allowed)


def large_enough(size: Column, width: Column, height: Column, least_bytes: int = 8000, least_side: int = 80) -> Column:
    """Floors of bytes and of the shorter side; unknown sizes fail."""
    return F.coalesce((size >= least_bytes) & (F.least(width, height) >= least_side), F.lit(False))


def is_person_photo(text: Column, profile: Profile | None = None) -> Column:
    """Whether a title or file name speaks of a photograph of the maker rather than of a work."""
    p = profile or Profile()
    return F.coalesce(text, F.lit("")).rlike(PERSON_PHOTO) | F.coalesce(text, F.lit("")).rlike(
        rf"(?iU)\bportrait of {p.full}\b|\b({p.any_given}) ([a-z]\.? )?{p.family or '(?!)'} (in|at|with|portrait|photograph)\b"
    )


def file_level(title: Column, mime: Column, width: Column, categories: Column, profile: Profile | None = None) -> Column:
    """(level, reason) of a media file: rejected, low, medium or high."""
    p = profile or Profile()
    t = F.coalesce(title, F.lit(""))
    rules = [
        Rule("reject:type", ~F.coalesce(is_image_type(mime), F.lit(False))),
        Rule("reject:other person", t.rlike(f"(?iU){'|'.join(p.others) or '(?!)'}")),
        Rule("reject:photograph", is_person_photo(t, p)),
        Rule("reject:small", F.coalesce(width, F.lit(0)) < 80),
        Rule("high:name and category", t.rlike(f"(?iU){p.full}") & F.coalesce(categories, F.lit("")).rlike(r"(?i)paintings")),
        Rule("medium:category", F.coalesce(categories, F.lit("")).rlike(r"(?i)paintings")),
        Rule("low:name only", t.rlike(f"(?iU){p.full}")),
    ]
    parts = F.split(first_rule(rules, F.lit("reject:no sign")), ":")
    return F.struct(F.get(parts, F.lit(0)).alias("level"), F.get(parts, F.lit(1)).alias("reason"))


def attributed_lot(text: Column, profile: Profile) -> Column:
    """Whether an auction text is of the maker: named, of no one else; dates of the maker's life override a doubt."""
    t = F.coalesce(text, F.lit(""))
    life = t.rlike(rf"\b{profile.birth_year}\s*[-–]\s*{profile.last_year}\b")
    other = t.rlike(f"(?iU){'|'.join(profile.others) or '(?!)'}")
    return t.rlike(f"(?iU){profile.full}") & (life | ~other)


def reject_reason(text: Column, url: Column, profile: Profile | None = None) -> Column:
    """Why a web result is no image of a work, or null."""
    p = profile or Profile()
    t = F.coalesce(text, F.lit(""))
    return first_rule([
        Rule("other person", t.rlike(f"(?iU){'|'.join(p.others) or '(?!)'}")),
        Rule("merchandise", t.rlike(MERCHANDISE)),
        Rule("furniture", F.coalesce(url, F.lit("")).rlike(FURNITURE)),
        Rule("photograph", is_person_photo(t, p)),
    ])


def museum_object(role: Column, medium: Column) -> Column:
    """(keep, confidence, note) of a museum object: artists only; unusual media are kept with low confidence and a note."""
    no = F.coalesce(role, F.lit("")).rlike(NO_ARTIST)
    odd = F.coalesce(medium, F.lit("")).rlike(UNUSUAL_MEDIUM)
    return F.struct((~no).alias("keep"), F.when(odd, "low").otherwise("high").alias("confidence"), F.when(odd, F.concat(F.lit("unusual medium: "), medium)).alias("note"))


def mismatch_note(artist: Column, profile: Profile, notes: Column) -> Column:
    """The notes, and that another artist is named where one is."""
    other = truthy_name(artist) & ~artist.rlike(f"(?iU)^{profile.full}$")
    return F.nullif(F.concat_ws("; ", F.nullif(notes, F.lit("")), F.when(other, F.concat(F.lit("listed artist: "), artist))), F.lit(""))


def truthy_name(c: Column) -> Column:
    return X.truthy(F.trim(c))


def needs_refresh(version: Column, description: Column, current: int = 2) -> Column:
    """Whether details have to be read again: an older version, or no description."""
    return (F.coalesce(version, F.lit(0)) < current) | ~X.truthy(description)


def preferred(value: Column, order: list[str], unknown: int = 99) -> Column:
    """The place of a value in a list of preferences."""
    return source_rank(value, order, unknown)

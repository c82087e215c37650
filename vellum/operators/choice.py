"""Choosing among variants and candidates: scores, sizes, preferences, priorities.

Lists of a row are chosen from inside the row; candidates that are rows of their
own are chosen by grouped arg-max, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hosts of originals and what they add to a score; words of thumbnails and furniture in addresses.
ORIGIN_HOSTS, ORIGIN_BONUS = ("s3.amazonaws.com", "brightspot-migration"), 10
IMAGE_URL = r"(?i)https?://[^\"'\s>]+\.(?:jpg|jpeg|png|webp)"
THUMBNAIL = ("/thumb/", "_square", "favicon", "sprite")
FURNITURE = ("icon", "logo", "sprite", "wikimedia-button", "static/images")
#: Shares below this are reported as uncertain.
UNSURE = 0.45


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def best_of(options: Column, score: Callable[[Column], Column]) -> Column:
    """The element with the highest score, the first of equals; null for an empty list."""
    ranked = F.transform(options, lambda x, i: F.struct(score(x).alias("s"), (-i).alias("i"), x.alias("v")))
    return F.array_max(ranked)["v"]


def url_score(url: Column) -> Column:
    """The area that a resizing address names, and a bonus for a host of originals."""
    side = lambda g: F.coalesce(F.nullif(F.regexp_extract(url, r"resize/(\d+)x(\d+)", g), F.lit("")).try_cast("long"), F.lit(0))
    return side(1) * side(2) + F.when(contains_any(url, ORIGIN_HOSTS), ORIGIN_BONUS).otherwise(0)


def best_linked_image(html: Column) -> Column:
    """The image address of a page with the highest score; where it wraps another address in ``url=``, that one."""
    best = best_of(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(IMAGE_URL), F.lit(0)), url_score)
    return F.coalesce(F.nullif(F.try_url_decode(F.nullif(F.regexp_extract(best, r"[?&]url=([^&#]*)", 1), F.lit(""))), F.lit("")), best)


def largest(variants: Column, name: str = "url", size: str = "bytes") -> Column:
    """The name of the largest of an array of structs, the first of equals; an unknown size is 0."""
    return best_of(variants, lambda v: F.coalesce(v[size], F.lit(0)))[name]


def largest_rows(rows: DataFrame, group: str, size: str, order: str) -> DataFrame:
    """The row of each group with the largest size, then the least order: an item's largest file."""
    best = F.max_by(F.struct("*"), F.struct(F.coalesce(F.col(size), F.lit(0)).alias("s"), (-F.col(order)).alias("o")))
    return rows.groupBy(F.col(group).alias("_g")).agg(best.alias("_r")).select("_r.*")


def full_variant(urls: Column, ending: str = "/full") -> Column:
    """The first address that ends so, a last slash aside, else the first."""
    full = F.filter(urls, lambda u: F.rtrim(u, F.lit("/")).endswith(ending))
    return F.coalesce(F.get(full, F.lit(0)), F.get(urls, F.lit(0)))


def first_success(attempts: Column, value: str = "url", ok: str = "ok") -> Column:
    """The value of the first attempt that succeeded, from an array of structs in order."""
    return F.get(F.filter(attempts, lambda a: F.coalesce(a[ok], F.lit(False))), F.lit(0))[value]


def candidate_list(urls: Column, wanted: Callable[[Column], Column], others: int = 30) -> Column:
    """Distinct addresses: all that are wanted, then at most so many others, each in order of sight."""
    seen = F.array_distinct(urls)
    return F.concat(F.filter(seen, wanted), F.slice(F.filter(seen, lambda u: ~wanted(u)), 1, others))


def priority_order(first: Column, name: Column) -> list[Column]:
    """Rows for which ``first`` holds come first, then by name."""
    return [F.coalesce(first, F.lit(False)).desc(), name.asc()]


def undated_last(year: Column, title: Column) -> list[Column]:
    """By year, rows without one last, then by title, case ignored."""
    return [year.isNull().asc(), F.coalesce(year, F.lit(0)).asc(), F.lower(title).asc()]


def unsure(rows: DataFrame, share: str, limit: float = UNSURE) -> DataFrame:
    """Rows whose best share is below the limit, for a report; null is below."""
    return rows.where(F.coalesce(F.col(share), F.lit(0.0)) < limit)


def usable_image_url(url: Column, exempt_host: str = "upload.wikimedia.org") -> Column:
    """Whether an address can be of a work's image: no thumbnail or furniture, with an image's suffix unless its host is exempt."""
    u = F.coalesce(url, F.lit(""))
    image = u.rlike(r"(?i)\.(jpg|jpeg|png|webp)($|\?)") | u.contains(exempt_host)
    return image & ~contains_any(F.lower(u), FURNITURE) & ~contains_any(u, THUMBNAIL)


def guarded(rows: DataFrame, stored: DataFrame, key: str, creator: Column, maker: str, wrong: str) -> DataFrame:
    """Rows that are new and not someone else's.

    Dropped are rows whose creator is named and is not of ``maker``, in which the
    pattern ``wrong`` occurs, or whose key is in ``stored``.
    """
    other = F.coalesce((F.trim(creator) != "") & ~creator.rlike(maker), F.lit(False)) | F.coalesce(creator.rlike(wrong), F.lit(False))
    return rows.where(~other).join(stored.select(key).distinct(), key, "left_anti")


def first_under(rows: DataFrame, key: Column, order: str, name: str = "name_key") -> DataFrame:
    """The first row of each normalized key (underscores are spaces, case ignored), with the key."""
    folded = F.lower(F.trim(F.regexp_replace(F.translate(key, "_", " "), r"\s+", " ")))
    best = F.min_by(F.struct("*"), F.col(order))
    return rows.groupBy(folded.alias(name)).agg(best.alias("_r")).select(name, "_r.*")


def listing_differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two listings has, with the side: ``left`` or ``right``."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").select(key, F.lit("left").alias("side")).unionByName(b.join(a, key, "left_anti").select(key, F.lit("right").alias("side")))


def larger_size(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``rows`` (key, width, height) with the size of the widest find of the key where that is wider."""
    best = found.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct("width", "height"), F.struct(F.coalesce("width", F.lit(0)), F.coalesce("height", F.lit(0)))).alias("_f"))
    d = rows.join(best, F.col(key) == F.col("_k"), "left")
    wider = F.coalesce(F.col("_f.width"), F.lit(0)) > F.coalesce(F.col("width"), F.lit(0))
    pick = lambda c: F.when(wider, F.col(f"_f.{c}")).otherwise(F.col(c))
    return d.withColumns({"width": pick("width"), "height": pick("height")}).drop("_k", "_f")

"""Colour, perceptual hashes and vectors as column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Linear sRGB to XYZ, and the D65 white point.
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
WHITE = (0.95047, 1.0, 1.08883)


def srgb_to_lab(r: Column, g: Column, b: Column) -> Column:
    """CIE L*a*b* of sRGB components from 0 to 1."""
    linear = [F.when(c <= 0.04045, c / 12.92).otherwise(F.pow((c + 0.055) / 1.055, F.lit(2.4))) for c in (r, g, b)]
    delta = 6 / 29

    def bent(t: Column) -> Column:
        return F.when(t > delta**3, F.cbrt(t)).otherwise(t / (3 * delta * delta) + 4 / 29)

    x, y, z = (bent(sum((m * c for m, c in zip(row, linear, strict=True)), F.lit(0.0)) / w) for row, w in zip(TO_XYZ, WHITE, strict=True))
    return F.struct((116 * y - 16).alias("L"), (500 * (x - y)).alias("a"), (200 * (y - z)).alias("b"))


def chroma(a: Column, b: Column) -> Column:
    return F.hypot(a, b)


def hue(a: Column, b: Column) -> Column:
    return F.atan2(b, a)


def hue_bin(a: Column, b: Column, bins: int = 8) -> Column:
    """The bin 0 .. bins - 1 of a hue over [-pi, pi], the last closed on both sides."""
    at = F.floor((hue(a, b) + math.pi) / (2 * math.pi / bins))
    return F.least(at, F.lit(bins - 1)).cast("int")


def hex_colour(r: Column, g: Column, b: Column) -> Column:
    """``#rrggbb`` of components from 0 to 1, rounded half to even, clipped."""
    part = lambda c: F.lower(F.lpad(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), F.bround(c * 255))).cast("int")), 2, "0"))
    return F.concat(F.lit("#"), part(r), part(g), part(b))


def palette_name(L: Column, a: Column, b: Column, gray: Column) -> Column:
    """A name for a mean colour: the first rule that holds."""
    # The rules' limits, order and names.
    return (
        F.when((gray > 0.42) & (L > 65), "Graphite sketches")
        .when(b < -8, "Arctic blue")
        .when((L < 42) & (F.abs(a) < 4) & (F.abs(b) < 4), "Charcoal and shadow")
        .when((a < -2) & (b > 8), "Olive green")
        .when((a > 3) & (b > 14), "Ochre and rock")
        .when((b > 6) & (F.abs(a) < 6), "Warm gray")
        .when((b < 0) & (a < 4), "Cool teal")
        .when((F.abs(a) < 8) & (F.abs(b) < 8), "Neutral stone")
        .when(L < 34, "Nocturnes")
        .otherwise("Mixed palette")
    )


def pixel_features(L: Column, A: Column, B: Column, row: Column, height: Column) -> dict[str, Column]:
    """Aggregates over an image's pixels (Lab, and their row of ``height``): means, spread, shares, sky and hue shares.

    The keys v0 .. v17 make the palette vector.
    """
    c = chroma(A, B)
    share = lambda p: F.avg(p.cast("double"))
    third = F.greatest(F.lit(1), F.floor(height / 3))
    sky = F.avg(F.when(row < third, L)) - F.avg(F.when(row >= height - third, L))
    weight = F.sum(c) + 1e-6
    means = [F.avg(L) / 100, F.avg(A) / 40, F.avg(B) / 40, F.stddev_pop(L) / 40, F.avg(c) / 40]
    shares = [share(c < 10), share((A > 6) & (B > 8) & (c > 12)), share((B < -6) & (c > 10)), share((A < -6) & (B > -4) & (c > 10)), sky / 40]
    hues = [F.coalesce(F.sum(F.when(hue_bin(A, B) == k, c)), F.lit(0.0)) / weight for k in range(8)]
    return {f"v{i}": x for i, x in enumerate([*means, *shares, *hues])}


def dhash(grey: Column, size: int = 8) -> Column:
    """Difference hash of an array of size * (size + 1) grey values, row by row: a bit where a value exceeds the next.

    The first bit is the highest, so with 64 bits the long is negative where it is set.
    """
    places = [r * (size + 1) + c for r in range(size) for c in range(size)]
    bit = lambda i: (F.get(grey, F.lit(i)) > F.get(grey, F.lit(i + 1))).cast("long")
    return F.when(
        F.size(grey) == size * (size + 1),
        reduce(lambda x, y: x.bitwiseOR(y), (F.shiftleft(bit(i), size * size - 1 - k) for k, i in enumerate(places))),
    )


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def aspect_close(wa: Column, ha: Column, wb: Column, hb: Column, by: float = 0.08) -> Column:
    """Whether two aspect ratios differ by at most ``by`` of the larger."""
    a, b = wa / ha, wb / hb
    return F.abs(a - b) / F.greatest(a, b) <= by


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column) -> Column:
    """A vector divided by its length; a zero vector stays."""
    size = F.sqrt(dot(v, v))
    return F.when(size > 0, F.transform(v, lambda x: x.cast("double") / size)).otherwise(F.transform(v, lambda x: x.cast("double")))


def softmax(v: Column) -> Column:
    """Shares proportional to exp, computed from differences to the largest."""
    top = F.array_max(v)
    e = F.transform(v, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda s, x: s + x)
    return F.transform(e, lambda x: x / total)


def argmax(v: Column) -> Column:
    """The first place, from 0, of the largest value."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def ternary(p: Column) -> Column:
    """A point for three shares: the second to the right, the third on top."""
    return F.struct((F.get(p, F.lit(1)) + 0.5 * F.get(p, F.lit(2))).alias("x"), (1.0 - F.get(p, F.lit(2))).alias("y"))


def style_priors(title: Column, medium: Column) -> Column:
    """Additions to three scores (drawing, abstract, scene) for what title and medium say."""
    # The words and the addition of 4.
    t, m = F.coalesce(title, F.lit("")), F.coalesce(medium, F.lit(""))
    abstract, drawn = r"(?iU)\babstract", r"(?iU)\b(graphite|pencil|charcoal|conte|crayon|pen and ink|ink on paper|drawing)\b"
    painted = m.rlike(r"(?iU)\boil\b|canvas|acrylic|tempera|watercolou?r")
    is_drawing = ~painted & (m.rlike(drawn) | t.rlike(drawn))
    return F.array(F.when(is_drawing, 4.0).otherwise(0.0), F.when(t.rlike(abstract) | m.rlike(abstract), 4.0).otherwise(0.0), F.lit(0.0))


def rounded(x: Column, places: int = 4) -> Column:
    """Rounded half to even, as the source data's figures are."""
    return F.bround(x, places)

"""Scalar functions against plain Python on edge values."""

import difflib
import math
import random

import pytest
from pyspark.sql import functions as F

from vellum.functions import fuzzy, vision
from vellum.functions import text as X
from vellum.functions import years as Y
from vellum.functions.profile import Profile

P = Profile(given=("Ada", "Aida"), middle=("Mary",), family="Stone", others=(r"ada\s+p\.?\s*stone",))


def values(spark, column, rows, schema="v string"):
    d = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in d.orderBy("i").select(column(F.col("v")).alias("o")).collect()]


def test_slugs(spark):
    got = values(spark, X.slugify, ["Hello, World!", None, "", "---", "Été 1920", "x" * 130 + "!"])
    assert got == ["hello-world", "untitled", "untitled", "untitled", "t-1920", "x" * 120]


def test_norm(spark):
    got = values(spark, lambda c: X.norm(c, P), ["The Ada Stone's House", None, "Musée d'Art", "Of the  Lake"])
    assert got == ["stones house", "", "muse e dart", "lake"]


@pytest.mark.parametrize("given,cleaned", [
    ("Ada Mary Stone Red Barn (1922) MutualArt", "Red Barn"), ("Lake — oil on canvas, 1920", "Lake —"), ("“North Shore”", "North Shore"), ("Mount - Ada Stone, 1930", "Mount"),
    ("Ice House by Ada", "Ice House"), ("Trees ~ 1931", "Trees"), ("Winter (ca. 1918)", "Winter"), ("Bay 1920-1921", "Bay"), ("Houses Fine Art", "Houses"), (None, ""), ("  ", ""),
])
def test_clean_title(spark, given, cleaned):
    assert values(spark, lambda c: X.clean_title(c, P), [given]) == [cleaned]


def test_index_titles(spark):
    given = ["  Snow – II ", "Lake (NGC 3708)", "Barn by Ada M. Stone, 1920", "'Élan'~", None, "Pic - oil on board"]
    assert values(spark, lambda c: X.norm_title(c, P), given) == ["Snow - II", "Lake", "Barn", "Élan'", "", "Pic"]
    assert values(spark, lambda c: X.title_key(c, P), ["Élan, Vital!", "A  B"]) == ["élan vital", "a b"]


def test_names_and_queries(spark):
    got = values(spark, lambda c: X.title_from_name(c, P), ["a/ada-stone-red-barn-1924-oil.jpg", "lake-house-00123.png", "x"])
    assert [tuple(r) for r in got] == [("red barn", 1924), ("lake house", None), ("x", None)]
    assert values(spark, lambda c: X.without_years(X.norm_query(c, P)), ["pics/Ada_Stone_Red-Barn_1924.jpg", "1924", "Lake oil on canvas"]) == ["Red Barn", "1924", "Lake"]
    got = values(spark, lambda c: X.name_to_title(c, P), ["File:red_barn,_1921.jpg", "File:Ada_Stone_-_Lake_1920-21.png"])
    assert [tuple(r) for r in got] == [("Red Barn", 1921, "1921"), ("Lake", 1920, "1920-21")]
    got = values(spark, X.guess_title, ["Blue Lake, 1923 oil", "Site | Great Northern Lights · x", "ab"])
    assert [tuple(r) for r in got] == [("Blue Lake", 1923), ("Site", None), (None, None)]


def test_markup_and_urls(spark):
    assert values(spark, X.strip_html, ["<p>A <b>B</b></p><script>x</script>&amp; C", None]) == ["A B & C", ""]
    assert values(spark, X.clean_text, ["a&nbsp;<i>b</i>\n c", None]) == ["a b c", ""]
    assert values(spark, X.html_escape, ['<a href="x">&</a>']) == ["&lt;a href=&quot;x&quot;&gt;&amp;&lt;/a&gt;"]
    url = "https://WWW.Example.com:80/a/b%20c.JPG?page=2&ref=x#top"
    assert values(spark, X.domain_of, [url, "no url", None]) == ["example.com", None, None]
    assert (values(spark, X.url_basename, [url]), values(spark, X.url_suffix, [url]), values(spark, lambda c: X.url_parameter(c, "page"), [url])) == (["b c.JPG"], [".jpg"], ["2"])
    assert values(spark, X.larger_image, ["http://u/thumb/a/ab/F.jpg/300px-F.jpg", "http://x/p.jpg!HD.jpg", "http://g/i=s400", "http://f/1_m.jpg"]) == ["http://u/a/ab/F.jpg", "http://x/p.jpg", "http://g/i=s0", "http://f/1_b.jpg"]


def test_extraction(spark):
    assert values(spark, X.sold_for, ["Sold for: $11,210,000 in", "unsold", None]) == [11210000, None, None]
    assert values(spark, X.dimensions_in, ["about 30 x 40 cm", "12 1/2 x 16 in", "none"]) == ["30 x 40 cm", "12 1/2 x 16 in", None]
    assert values(spark, X.medium_in, ["Oil on Canvas, 1920", "stone"]) == ["oil on canvas", None]
    assert values(spark, lambda c: X.labelled_field(c, "Medium"), ["Title\nA\nMedium\n\n oil \nDate", "x"]) == ["oil", None]
    assert values(spark, X.has_cyrillic, ["Лес", "Les"]) == [True, False]


def test_years(spark):
    assert values(spark, Y.year_from, ["in 1920.", "x1920", "1799 1800", "2001", None, ""]) == [1920, None, 1800, None, None, None]
    assert values(spark, Y.year_from_web, ["1969", "1971", "1970"]) == [1969, None, 1970]
    assert [tuple(r) for r in values(spark, Y.years_in, ["1903 1904 1904 1930", "1920-1925", None])] == [(1904, None), (1920, 1925), (None, None)]
    got = [tuple(r) for r in values(spark, Y.parse_year, ["1920-21", "1930?", "n.d.", "1885", "1976", "1899", "1921-03-01", None, "old", "1950/1951"])]
    assert got == [(1920, "1920-1921"), (1930, "1930?"), (None, None), (None, "1885"), (None, "1976"), (1899, "1899"), (1921, "1921-1903"), (None, None), (None, "old"), (1950, "1950-1951")]
    assert values(spark, Y.scrub_year, [1899, 1900, 1904, 1970, 1971, None], "v int") == [None, 1900, 1904, 1970, None, None]
    assert values(spark, Y.year_label, [0, None, 1920], "v int") == ["", "", "1920"]
    assert [tuple(r) for r in values(spark, Y.year_of_number, [1885, 1886, 1976], "v int")] == [(None, None), (1886, "1886"), (None, None)]


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequence():
    random.seed(3)
    for _ in range(300):
        a, b = ("".join(random.choice("abcé ") for _ in range(random.randint(0, 20))) for _ in range(2))
        assert fuzzy.common(a, b) == slow_common(a, b)


def test_scores(spark):
    assert fuzzy.token_sort("red barn", "barn red") == 100 and fuzzy.token_set("red barn", "the red barn") == 100
    assert fuzzy.ratio("abcd", "abce") == pytest.approx(75) and fuzzy.token_set("", "a") == 0 and fuzzy.ratio("", "") == 100
    assert fuzzy.title_score("lake", "lake superior north") == pytest.approx(fuzzy.token_sort("lake", "lake superior north") - 18)
    assert fuzzy.weighted("lake", "the great lake of the north") == pytest.approx(90) and fuzzy.weighted("", "x") == 0
    assert fuzzy.partial("abcd", "xxabcdxx") == 100 and fuzzy.partial("abcd", "xxabxdxx") == pytest.approx(75)
    fuzzy.register(spark)
    assert spark.sql("select fuzzy_token_sort('a b', 'b a') s, fuzzy_ratio(null, 'x') n").first() == (100.0, None)
    assert difflib.SequenceMatcher(None, "lake", "lake").ratio() * 100 == fuzzy.ratio("lake", "lake")


def test_colours(spark):
    d = spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.5, 0.5, 0.5)], "r double, g double, b double")
    got = [tuple(r.lab) for r in d.select(vision.srgb_to_lab(F.col("r"), F.col("g"), F.col("b")).alias("lab")).collect()]
    assert got[0] == pytest.approx((100, 0, 0), abs=0.01) and got[1] == pytest.approx((0, 0, 0), abs=1e-6)
    assert got[2] == pytest.approx((53.24, 80.09, 67.20), abs=0.02)
    assert d.select(vision.hex_colour(F.col("r"), F.col("g"), F.col("b"))).collect()[3][0] == "#808080"
    named = lambda *v: spark.range(1).select(vision.palette_name(*map(F.lit, v))).first()[0]
    assert [named(70, 0, 0, 0.5), named(50, 0, -9, 0), named(41, 3, 3, 0), named(50, -3, 9, 0), named(50, 4, 15, 0), named(50, 0, 7, 0), named(50, 0, -1, 0), named(50, 5, 0, 0), named(30, 20, 0, 0), named(50, 20, 0, 0)] == [
        "Graphite sketches", "Arctic blue", "Charcoal and shadow", "Olive green", "Ochre and rock", "Warm gray", "Cool teal", "Neutral stone", "Nocturnes", "Mixed palette",
    ]


def test_hashes_and_vectors(spark):
    random.seed(4)
    grey = [[random.random() for _ in range(72)] for _ in range(20)]
    bits = lambda g: sum((g[r * 9 + c] > g[r * 9 + c + 1]) << 63 - (r * 8 + c) for r in range(8) for c in range(8))
    got = values(spark, vision.dhash, [*grey, [1.0]], "v array<double>")
    assert [x & (1 << 64) - 1 for x in got[:-1]] == [bits(g) for g in grey] and got[-1] is None
    p = values(spark, vision.softmax, [[1000.0, 1001.0, 999.0]], "v array<double>")[0]
    e = [math.exp(x) for x in (-1, 0, -2)]
    assert list(p) == pytest.approx([x / sum(e) for x in e])
    assert values(spark, vision.argmax, [[1.0, 3.0, 3.0]], "v array<double>") == [1]
    assert list(values(spark, vision.unit, [[3.0, 4.0], [0.0, 0.0]], "v array<double>")[0]) == pytest.approx([0.6, 0.8])
    d = spark.createDataFrame([("Abstract No 1", None), ("Sketch", "pencil"), ("Drawing", "oil on board"), (None, None)], "t string, m string")
    assert [list(r[0]) for r in d.select(vision.style_priors(F.col("t"), F.col("m"))).collect()] == [[0, 4, 0], [4, 0, 0], [0, 0, 0], [0, 0, 0]]

"""Best options by fuzzy score against a comparison with every option, and column-wise scorers against plain ones."""

import random

import numpy as np
import pandas as pd
import pytest

from vellum import catalogue_queries
from vellum.functions import fuzzy
from vellum.operators import link, retrieve

SF = "/root/testdata/sf0.01"
WORDS = ["small", "ring", "red", "barn", "the", "lake", "brand", "17", "größe", "日本", "a", "ab", "superior", "x" * 30]


def made(n, seed):
    rng = random.Random(seed)

    def text():
        if rng.random() < 0.2:
            return "".join(rng.choices("abcde ", k=rng.randint(0, 140)))
        return " ".join(rng.choices(WORDS, k=rng.randint(0, 6)))

    return [text() for _ in range(n)]


@pytest.mark.parametrize("name", list(fuzzy.SCORERS))
def test_columns_score_like_single_pairs(name):
    a, b = made(3000, 1), made(3000, 2)
    assert fuzzy.COLUMNS[name](a, b).tolist() == [fuzzy.SCORERS[name](x, y) for x, y in zip(a, b, strict=True)]
    assert len(fuzzy.COLUMNS[name]([], [])) == 0


@pytest.mark.parametrize("name", list(fuzzy.SCORERS))
def test_bounds_are_never_below_the_score(name):
    a, b = made(150, 3), made(200, 4)
    bound = getattr(retrieve.Bounds(retrieve.Texts(a), retrieve.Texts(b)), name)()
    score = np.array([[fuzzy.SCORERS[name](x, y) for y in b] for x in a])
    assert (bound >= score - 1e-4).all()


def best_expected(queries, options, name, cutoff, limit):
    known, out = {}, set()
    for q, text in queries:
        if text is None:
            continue
        rows = []
        for choice, o in options:
            if choice is not None:
                if (text, choice) not in known:
                    known[text, choice] = fuzzy.SCORERS[name](text, choice)
                if known[text, choice] >= cutoff:
                    rows.append((-known[text, choice], o, choice))
        out |= {(q, choice, o, round(-s, 6), k + 1) for k, (s, o, choice) in enumerate(sorted(rows)[:limit])}
    return out


@pytest.mark.parametrize("name", list(fuzzy.SCORERS))
@pytest.mark.parametrize(("cutoff", "limit"), [(0.0, 3), (60.0, 1), (85.5, 7)])
def test_best_options_equal_a_full_comparison(spark, name, cutoff, limit):
    queries = list(enumerate([*made(40, 5), None, "", "small ring", "small ring"]))
    options = [(c, (37 * i) % 1009) for i, c in enumerate([*made(150, 6), None, "", "small ring", "small ring", "ring"])]
    q, o = spark.createDataFrame(queries, "query_id long, text string"), spark.createDataFrame(options, "choice string, ord long")
    got = {(r.query_id, r.choice, r.choice_ord, round(r.score, 6), r["rank"]) for r in retrieve.best_options(q, o, name, cutoff, limit, query_rows=16, option_rows=40).collect()}
    assert got == best_expected(queries, options, name, cutoff, limit)


def test_nothing_asked_or_offered(spark):
    q, o = spark.createDataFrame([(1, "a")], "query_id long, text string"), spark.createDataFrame([("a", 1)], "choice string, ord long")
    assert retrieve.best_options(q.limit(0), o).count() == retrieve.best_options(q, o.limit(0)).count() == 0


@pytest.mark.parametrize(("query", "scorer", "cutoff", "limit"), [("z2_best_token_sets", "token_set", 60.0, 3), ("z4_best_ratios", "ratio", 0.0, 5), ("z4_best_token_sorts", "token_sort", 70.0, 5), ("z3_best_weighted", "weighted", 55.0, 20)])
def test_queries_over_all_parts(spark, query, scorer, cutoff, limit):
    t = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    queries = [(r.query_id, r.text) for r in catalogue_queries.asked_parts(t).collect()]
    options = [(r.title, r.ord) for r in catalogue_queries.parts_as_works(t).collect()]
    got = {tuple(r) for r in catalogue_queries.queries()[query](spark, SF).collect()}
    assert got == best_expected(queries, options, scorer, cutoff, limit)


@pytest.mark.parametrize(("scorer", "limit"), [("ratio", 5), ("token_sort", 5), ("token_set", 3), ("weighted", 20)])
def test_few_pairs_are_scored(spark, scorer, limit):
    t = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    texts = sorted({r.text for r in catalogue_queries.asked_parts(t).collect()})
    first = {}
    for r in catalogue_queries.parts_as_works(t).collect():
        first[r.title] = min(r.ord, first.get(r.title, r.ord))
    q = pd.DataFrame({"text": texts, "held": np.nan, "held_ord": np.nan})
    options = pd.DataFrame({"choice": list(first), "ord": list(first.values())})
    best, scored = retrieve.best_of_block(q, options, scorer, 0.0, limit)
    assert len(best) == limit * len(texts)
    # titles of the same few words: plain ratios are near to each other, the other scores are not
    assert scored < {"ratio": 0.4, "weighted": 0.1}.get(scorer, 0.05) * len(texts) * len(first)


def test_suggestions_and_lookups_over_all_rows(spark):
    """J5 and J6 against plain loops over all parts of the table."""
    t = lambda n: spark.read.parquet(f"{SF}/{n}.parquet")
    works = catalogue_queries.parts_as_works(t).collect()
    asked = {r.key: r.title or "red widget" for r in t("nation").selectExpr("n_name as key", "if(n_nationkey % 3 = 0, 'small ring', null) as title").collect()}
    best = {k: best_expected([(k, v)], [(w.title, w.ord) for w in works], "token_set", 50.0, 1) for k, v in asked.items()}
    got = {r.key: r for r in catalogue_queries.queries()["j5_suggestions"](spark, SF).collect()}
    by_ord = {w.ord: w for w in works}
    for k, found in best.items():
        ((_, choice, o, score, _),) = found
        assert (got[k].suggested_title, got[k].suggested_year, got[k].suggested_collection, round(got[k].suggested_score, 6)) == (choice, by_ord[o].year, by_ord[o].collection, score)

    last = {}
    for w in works:
        for choice in (w.title, w.medium):
            if choice not in last or w.ord > last[choice].ord:
                last[choice] = w
    queries = catalogue_queries.asked_parts(t).collect()
    expected = set()
    for q in queries:
        pool = sorted(best_expected([(q.query_id, q.text)], [(c, w.ord) for c, w in last.items()], "weighted", 55.0, 20), key=lambda r: r[4])
        once = {}
        for _, choice, _, score, rank in pool:
            w = last[choice]
            once.setdefault((w.title, w.year), (choice, score, rank, w))
        adjusted = []
        for (title, year), (choice, score, rank, w) in once.items():
            gap = None if year is None else abs(year - q.year)
            s = score if gap is None else min(100.0, score + 8) if gap == 0 else min(100.0, score + 3) if gap == 1 else score - 15 if gap > 5 else score
            adjusted.append((-round(s, 2), rank, w.ord, title, year, choice))
        expected |= {(q.query_id, k + 1, o, title, year, choice) for k, (s, rank, o, title, year, choice) in enumerate(sorted(adjusted)[:5])}
    got = {(r.query_id, r.place, r.work_id, r.title, r.year, r.matched_as) for r in catalogue_queries.queries()["j6_lookup_of_parts"](spark, SF).collect()}
    assert got == expected

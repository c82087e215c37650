"""Models fitted together and their silhouettes against plain loops over one model at a time."""

import numpy as np
import pytest

from vellum.operators import features

KINDS = "id int, v array<double>"


def drawn(seed=0, groups=5, each=40, width=4):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(rng.uniform(-8, 8, width), 1, (each, width)) for _ in range(groups)])


def plain_fit(x, centres, tol=1e-6):
    before = np.inf
    while True:
        far = ((x[:, None] - centres) ** 2).sum(2)
        near, cost = far.argmin(1), far.min(1).sum()
        if before - cost <= tol * cost:
            return cost, centres, np.bincount(near, minlength=len(centres))
        before, centres = cost, np.array([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])


def plain_silhouette(x, labels):
    m = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    out = []
    for i, own in enumerate(labels):
        others = [m[i, labels == k].mean() for k in set(labels.tolist()) - {own}]
        a, b = m[i, labels == own].sum() / max((labels == own).sum() - 1, 1), min(others, default=0)
        out.append((b - a) / max(a, b) if others and (labels == own).sum() > 1 and max(a, b) else 0)
    return np.mean(out)


def test_together_equals_one_at_a_time(spark):
    x = drawn()
    x = np.concatenate([x, np.repeat(x[:1], 100, 0), np.repeat(x[50:51], 7, 0)])  # a hot vector
    points = features.distinct_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KINDS), "v")
    assert points.count() == 200
    first = features.starts(points, 7, 4, seed=3)
    known = {tuple(v) for v in x}
    for s in first:
        assert len(s) == 7 and len({tuple(v) for v in s}) == 7 and {tuple(v) for v in s} <= known
    again = features.starts(points.repartition(7), 7, 4, seed=3)
    assert all((a == b).all() for a, b in zip(first, again, strict=True)) and not (first[0] == first[1]).all()
    fits = features.fit_all(points, [2, 5, 7], 4, seed=3)
    assert [(f.k, f.restart) for f in fits] == [(k, r) for k in (2, 5, 7) for r in range(4)]
    for f in fits:
        cost, centres, sizes = plain_fit(x, first[f.restart][: f.k])
        assert f.cost == pytest.approx(cost) and f.centres == pytest.approx(centres) and f.sizes.tolist() == sizes.tolist()
    best = features.cheapest(fits)
    assert all(best[k].cost == min(f.cost for f in fits if f.k == k) for k in best) and all((np.diff(f.sizes) <= 0).all() for f in best.values())
    got = features.silhouettes(points, list(best.values()))
    for f, s in zip(best.values(), got, strict=True):
        assert s == pytest.approx(plain_silhouette(x, ((x[:, None] - f.centres) ** 2).sum(2).argmin(1)))


def test_silhouettes_in_several_blocks(spark, monkeypatch):
    x = drawn(1, 3, 30)
    points = features.distinct_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KINDS), "v")
    best = list(features.cheapest(features.fit_all(points, [3, 4], 2)).values())
    whole = features.silhouettes(points, best)
    monkeypatch.setattr(features, "WIDE", 20)
    assert features.silhouettes(points, best) == pytest.approx(whole)


def test_choice_finds_the_groups(spark):
    x = drawn(2, 5, 40)
    chosen, found = features.choose_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], KINDS), "v", range(4, 8), restarts=6)
    assert chosen == 5 == max(found, key=lambda k: found[k][1]) and sorted(found) == [4, 5, 6, 7]
    costs = [found[k][0] for k in sorted(found)]
    assert costs == sorted(costs, reverse=True)


def test_rows_without_a_place(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [9.0, 9.0]), (4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0])]
    d = spark.createDataFrame(rows, KINDS)
    assert {r.id: r.cluster for r in features.kmeans(d, "v", 2, 2).collect()} == {1: 0, 2: 0, 3: 1, 4: None, 5: None, 6: None, 7: None}
    assert {r.cluster for r in features.kmeans(d.where("id < 4"), "v", 3, 2).collect()} == {0, 1}  # fewer distinct vectors than clusters
    none = d.where("id = 4")
    assert [r.cluster for r in features.kmeans(none, "v", 2, 2).collect()] == [None]
    assert features.choose_k(none, "v") == (4, {}) and features.kmeans(d.where("id > 9"), "v", 2).count() == 0

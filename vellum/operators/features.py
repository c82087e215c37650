"""Features, clusters and maps of images."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import vision
from vellum.scratch import dealt, free, stage

#: Rows of a block, at least, whose distances to another block are one task's work.
BLOCK = 2048
#: The same where there are many rows, and the rows of a strip of distances that a task holds.
WIDE, STRIP = 16384, 128


def standardized(rows: DataFrame, vector: str, size: int) -> DataFrame:
    """The vector's components less their mean, over their population deviation (1 where that is 0)."""
    at = lambda i: F.get(vector, F.lit(i)).cast("double")
    stats = rows.agg(F.array(*(F.avg(at(i)) for i in range(size))).alias("_m"), F.array(*(F.stddev_pop(at(i)) for i in range(size))).alias("_s"))
    scaled = F.zip_with(F.zip_with(vector, "_m", lambda x, m: x - m), F.transform("_s", lambda s: F.when(s > 0, s).otherwise(1.0)), lambda x, s: x / s)
    return rows.join(F.broadcast(stats), F.lit(True)).withColumn(vector, scaled).drop("_m", "_s")  # stats: one row


class Fit(NamedTuple):
    """A fitted model: cost is the sum of squared distances to the nearest centre, sizes the rows of each centre."""

    k: int
    restart: int
    cost: float
    centres: np.ndarray
    sizes: np.ndarray


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of y."""
    return np.maximum(0, (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T)


def _uniform(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Numbers in (0, 1] that depend on a row's hash and the salt alone, so that a task run again draws the same."""
    z = hashes.astype("int64").view("uint64") + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53 + 2.0**-54


def distinct_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """(v, n, h): each distinct vector, its number of rows and a hash; null vectors and those with null or non-finite entries have no place."""
    v = F.col(vector).cast("array<double>")
    return stage(rows.where(F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))).groupBy(v.alias("v")).agg(F.count("*").alias("n")).withColumn("h", F.xxhash64("v")), "vectors")


def starts(points: DataFrame, k: int, restarts: int, seed: int = 0) -> list[np.ndarray]:
    """The k-means++ starts of all restarts, drawn together: one scan gives each of them its next centre.

    A vector is drawn with a chance in proportion to its rows and its squared distance
    to the centres so far: the least exponential variate of that rate wins. There are fewer
    starts where there are fewer distinct vectors.
    """
    found: list[list[list[float]]] = [[] for _ in range(restarts)]
    for step in range(k):
        held = [np.array(f) for f in found]

        def draws(batches, held=held, step=step):
            for p in batches:
                if not len(p):
                    continue
                x, n, h = np.stack(p["v"]).astype(float), p["n"].to_numpy(float), p["h"].to_numpy()
                for r, centres in enumerate(held):
                    if len(centres) < step:
                        continue
                    rate = n * (_squares(x, centres).min(1) if step else 1.0)
                    rate[(x[:, None] == centres).all(2).any(1) if step else []] = 0
                    at = np.where(rate > 0, -np.log(_uniform(h, (seed + r) * 4096 + step)) / np.where(rate > 0, rate, 1), np.inf)
                    if np.isfinite(best := at.min()):
                        yield pd.DataFrame({"r": [r], "at": [best], "v": [x[at.argmin()]]})

        best = points.mapInPandas(draws, "r int, at double, v array<double>").groupBy("r").agg(F.min_by("v", F.struct("at", "v")).alias("v"))
        for r, v in best.collect():  # one vector a restart
            found[r].append(v)
    return [np.array(f) for f in found]


def fit_all(points: DataFrame, ks, restarts: int = 10, seed: int = 0, rounds: int = 300, tol: float = 1e-6) -> list[Fit]:
    """Models of every k and restart, fitted together: a round is one scan of ``points`` (as of ``distinct_vectors``) and one grouped sum.

    The models of one restart start from the same k-means++ sequence. A model leaves the
    rounds when its cost falls by no more than ``tol`` of itself; a centre without rows stays
    where it is. What the driver holds and sends is the centres: k x restarts x width numbers.
    Without a point there is no model.
    """
    first = starts(points, max(ks), restarts, seed)
    open_ = {(k, r): (first[r][:k], np.inf) for k in ks for r in range(restarts) if len(first[r])}
    done = []
    for turn in range(rounds):
        if not open_:
            break
        spans, at = {}, 0
        for m, (c, _) in open_.items():
            spans[m] = (at, at + len(c))
            at += len(c)
        centres = np.concatenate([c for c, _ in open_.values()])

        def sums(batches, centres=centres, spans=tuple(spans.values())):
            total, n, cost = np.zeros(centres.shape), np.zeros(len(centres)), np.zeros(len(centres))
            for p in batches:
                if not len(p):
                    continue
                x, w = np.stack(p["v"]).astype(float), p["n"].to_numpy(float)
                far = _squares(x, centres)
                for lo, hi in spans:
                    near = far[:, lo:hi].argmin(1)
                    n[lo:hi] += np.bincount(near, w, hi - lo)
                    cost[lo:hi] += np.bincount(near, w * far[np.arange(len(x)), near + lo], hi - lo)
                    total[lo:hi] += (w[:, None] * (near[:, None] == np.arange(hi - lo))).T @ x
            held = np.flatnonzero(n)
            yield pd.DataFrame({"c": held, "n": n[held], "cost": cost[held], "s": list(total[held])})

        parts = points.mapInPandas(sums, "c int, n double, cost double, s array<double>")
        each = parts.groupBy("c").agg(F.sum("n"), F.sum("cost"), F.array(*(F.sum(F.get("s", F.lit(i))) for i in range(centres.shape[1]))))
        n, cost, moved = np.zeros(at), np.zeros(at), centres.copy()
        for c, rows, paid, s in each.collect():  # one row a centre
            n[c], cost[c], moved[c] = rows, paid, np.array(s) / rows
        following = {}
        for m, (lo, hi) in spans.items():
            (old, before), paid = open_[m], float(cost[lo:hi].sum())
            if before - paid <= tol * paid or turn == rounds - 1:
                done.append(Fit(*m, paid, old, n[lo:hi]))
            else:
                following[m] = (moved[lo:hi], paid)
        open_ = following
    return sorted(done, key=lambda f: (f.k, f.restart))


def cheapest(fits: list[Fit]) -> dict[int, Fit]:
    """The model of least cost for each k, its clusters in order of size, then centre."""
    best: dict[int, Fit] = {}
    for f in fits:
        if f.k not in best or f.cost < best[f.k].cost:
            best[f.k] = f
    out = {}
    for k, f in best.items():
        order = sorted(range(len(f.sizes)), key=lambda c: (-f.sizes[c], f.centres[c].tolist()))
        out[k] = f._replace(centres=f.centres[order], sizes=f.sizes[order])
    return out


def nearest(vector: Column, fits: list[Fit]) -> Column:
    """The number of the nearest centre in each model; null for what ``distinct_vectors`` leaves out."""
    held = [f.centres for f in fits]
    whole = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))

    @F.pandas_udf("array<int>")
    def near(v: pd.Series) -> pd.Series:
        out: list = [None] * len(v)
        known = np.flatnonzero(v.notna())
        if len(known):
            x = np.stack(v.iloc[known]).astype(float)
            for i, labels in zip(known, np.stack([_squares(x, c).argmin(1) for c in held], 1).astype("int32"), strict=True):
                out[i] = labels
        return pd.Series(out, dtype=object)

    return near(F.when(whole, vector))


def kmeans(rows: DataFrame, vector: str, k: int, restarts: int = 10, seed: int = 0) -> DataFrame:
    """Rows with cluster 0 .. k - 1: the best of several seeded starts, clusters in order of size, then centre; null for a vector without a place."""
    points = distinct_vectors(rows, vector)
    best = cheapest(fit_all(points, [k], restarts, seed))
    free(points)
    return rows.withColumn("cluster", F.get(nearest(F.col(vector), [best[k]]), F.lit(0)) if best else F.lit(None).cast("int"))


def silhouette(rows: DataFrame, vector: str, cluster: str = "cluster", key: str = "id") -> DataFrame:
    """Mean silhouette by Euclidean distance, one row; null without rows.

    Exact: every row is a stated query against all rows. Equal vectors of a cluster are one
    point of so many rows; see ``_totals``.
    """
    d = rows.select(F.col(vector).alias("v"), F.col(cluster).cast("int").alias("c")).groupBy("v", "c").agg(F.count("*").alias("n"))
    d = stage(d.withColumn("row", F.monotonically_increasing_id()), "silhouette")
    sizes = d.groupBy("c").agg(F.sum("n").alias("n")).orderBy("c").collect()  # one row a cluster
    place = F.create_map(*(x for i, r in enumerate(sizes) for x in (F.lit(r.c), F.lit(i)))) if sizes else F.create_map().cast("map<int,int>")
    placed = d.select("row", "v", "n", F.array(F.element_at(place, F.col("c")).cast("int")).alias("c"))
    each = placed.join(_totals(placed, [len(sizes)]), "row")
    return each.agg(_mean(0, 0, [float(r.n) for r in sizes]).alias("silhouette"))


def _totals(d: DataFrame, widths: list[int]) -> DataFrame:
    """(row, t): the sums of distances of each point of ``d`` (row, v, n, c) to each cluster of each model, c holding a cluster a model.

    Points are dealt to blocks whose side grows with the number of points, from ``BLOCK`` to ``WIDE``,
    and then in number; a pair of blocks is one task, whose distances serve both of them. A task
    holds two blocks and a strip of their distances; vectors go as packed doubles.
    """
    count = d.count()
    blocks = max(1, -(-count // max(BLOCK, min(WIDE, count // 8))))
    ends = np.cumsum([0, *widths])
    packed = pack(F.col("v")).alias("v")
    own = d.select("row", "n", "c", packed, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"))
    met = own.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pair = met.select(F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"), (F.col("b") > F.col("o")).alias("second"), "row", "n", "c", "v")

    def sums(p: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(p["v"]), np.float64).reshape(len(p), -1)
        member = np.zeros((len(x), ends[-1]))
        member[np.arange(len(x))[:, None], np.stack(p["c"]) + ends[:-1]] = p["n"].to_numpy(float)[:, None]
        rows, second, total = p["row"].to_numpy(), p["second"].to_numpy(), np.zeros((len(x), ends[-1]))
        del p
        apart = bool(second.any())
        one, two = (np.flatnonzero(~second), np.flatnonzero(second)) if apart else (np.arange(len(x)),) * 2
        y, of, norm = x[two], member[two], (x[two] * x[two]).sum(1)
        for i in range(0, len(one), STRIP):
            some = one[i : i + STRIP]
            m = x[some] @ y.T
            m *= -2
            m += (x[some] * x[some]).sum(1)[:, None]
            m += norm
            np.maximum(m, 0, out=m)
            np.sqrt(m, out=m)
            if not apart:
                m[np.arange(len(some)), np.arange(i, i + len(some))] = 0
            total[some] += m @ of
            if apart:
                total[two] += m.T @ member[some]
        return pd.DataFrame({"row": rows, "t": list(total)})

    parts = dealt(pair, "p", "q").groupBy("p", "q").applyInPandas(sums, "row long, t array<double>")
    return parts.groupBy("row").agg(F.array(*(F.sum(F.get("t", F.lit(i))) for i in range(int(ends[-1])))).alias("t"))


def pack(v: Column) -> Column:
    """A vector as the bytes of its doubles."""

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return v.map(lambda x: np.asarray(x, np.float64).tobytes())

    return packed(v)


def _mean(model: int, start: int, sizes: list[float]) -> Column:
    """The mean silhouette of one model's clusters over points (n, c, t), each of n rows; null without points."""
    mine = F.get("c", F.lit(model))
    of = F.slice("t", start + 1, max(1, len(sizes)))
    held = F.array(*(F.lit(n) for n in sizes)).cast("array<double>")
    far = F.zip_with(of, held, lambda t, n: F.when(n > 0, t / n))
    a = F.when(F.get(held, mine) > 1, F.get(of, mine) / (F.get(held, mine) - 1))
    b = F.array_min(F.transform(far, lambda x, i: F.when(i != mine, x)))
    value = F.when(a.isNull() | b.isNull() | (F.greatest(a, b) == 0), 0.0).otherwise((b - a) / F.greatest(a, b))
    return F.sum(value * F.col("n")) / F.sum("n")


def silhouettes(points: DataFrame, fits: list[Fit]) -> list[float]:
    """Mean Euclidean silhouettes of several models' clusters over ``points`` (v, n), all from one pass over the pairs of blocks.

    Exact: a point of n rows counts n times, so copies are met once. Sums of distances to
    each cluster of each model are what is shuffled. A model of one cluster has no silhouette: 0.
    """
    d = stage(points.select("v", "n", nearest(F.col("v"), fits).alias("c"), F.monotonically_increasing_id().alias("row")), "silhouettes")
    each = d.select("row", "n", "c").join(_totals(d, [len(f.centres) for f in fits]), "row")
    ends = np.cumsum([0, *(len(f.centres) for f in fits)])
    means = [_mean(j, int(ends[j]), [float(n) for n in f.sizes]).alias(f"s{j}") for j, f in enumerate(fits)]
    found = [x or 0.0 for x in each.agg(*means).first()]
    free(d)
    return found


def choose_k(rows: DataFrame, vector: str, ks: range = range(4, 9), restarts: int = 10, seed: int = 0) -> tuple[int, dict[int, tuple[float, float]]]:
    """The number of clusters with the greatest silhouette, of equals the smallest, and each k's (cost, silhouette).

    All models are fitted together, and the silhouettes of each k's best one are taken together.
    Without any vector the choice is the first k, and nothing is known of any.
    """
    points = distinct_vectors(rows, vector)
    best = cheapest(fit_all(points, list(ks), restarts, seed))
    found = dict(zip(best, silhouettes(points, list(best.values())), strict=True)) if best else {}
    free(points)
    return max(found, key=lambda k: (found[k], -k), default=min(ks)), {k: (best[k].cost, found[k]) for k in found}


def cluster_table(rows: DataFrame) -> DataFrame:
    """(id, name, color, n) of clusters from rows (cluster, L, a, b, gray, r, g, bl): mean colours, repeated names numbered."""
    m = rows.groupBy("cluster").agg(F.count("*").alias("n"), *(F.avg(c).alias(c) for c in ("L", "a", "b", "gray", "r", "g", "bl")))
    named = m.select(F.col("cluster").alias("id"), vision.palette_name(*map(F.col, ("L", "a", "b", "gray"))).alias("name"), vision.hex_colour(F.col("r"), F.col("g"), F.col("bl")).alias("color"), "n")
    again = F.row_number().over(Window.partitionBy("name").orderBy("id"))  # a row a cluster
    return named.withColumn("_k", again).withColumn("name", F.when(F.col("_k") > 1, F.concat_ws(" ", "name", F.col("_k").cast("string"))).otherwise(F.col("name"))).drop("_k")


def spread(rows: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """Columns scaled to 0 .. 1 over all rows or within groups."""
    keys = [] if by is None else [F.col(by).alias("_within")]
    ends = rows.groupBy(*keys).agg(*(f(c).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))))
    out = rows.join(ends, F.lit(True) if by is None else F.col(by).eqNullSafe(F.col("_within")))
    scaled = {c: (F.col(c) - F.col(f"_lo{i}")) / (F.col(f"_hi{i}") - F.col(f"_lo{i}") + 1e-9) for i, c in enumerate(columns)}
    return out.withColumns(scaled).select(*rows.columns)


def plane(rows: DataFrame, vector: str, by: str = "cluster", key: str = "id") -> DataFrame:
    """(id, u, v): the first two principal axes within each group, scaled to 0 .. 1; groups under three sit in the middle.

    Axes come from each group's moment matrix, summed over Arrow batches on the
    executors; signs are fixed so that each axis's largest loading is positive.
    """
    width = rows.select(F.max(F.size(vector))).first()[0] or 0

    def moments(batches):
        for p in batches:
            for g, part in p.groupby("g", dropna=False):
                x = np.stack(part["x"]).astype(float)
                yield pd.DataFrame({"g": [g], "n": [float(len(x))], "s": [x.sum(0)], "q": [(x.T @ x).ravel()]})

    parts = rows.select(F.col(by).alias("g"), F.col(vector).alias("x")).mapInPandas(moments, f"g {rows.schema[by].dataType.simpleString()}, n double, s array<double>, q array<double>")
    total = lambda c, n: F.array(*(F.sum(F.get(c, F.lit(i))) for i in range(n)))
    axes = {}
    if width:
        flat = parts.select("g", "n", F.posexplode(F.concat("s", "q")).alias("i", "x")).groupBy("g", "i").agg(F.sum("x").alias("x"))
        for g, n, xs in (
            flat.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("x")).join(parts.groupBy("g").agg(F.sum("n").alias("n")), "g")
            .select("g", "n", F.transform("x", lambda y: y["x"])).collect()  # width * (width + 1) numbers a cluster
        ):
            x = np.array(xs)
            mean = x[:width] / n
            _, vectors = np.linalg.eigh(x[width:].reshape(width, width) / n - np.outer(mean, mean))
            two = vectors[:, ::-1][:, :2]
            two = two * np.sign(two[np.abs(two).argmax(0), np.arange(two.shape[1])])
            axes[g] = (n, two)
    kept = {g: [two[:, i].tolist() for i in range(2)] for g, (n, two) in axes.items() if n >= 3 and two.shape[1] == 2}
    out = rows.select(F.col(key).alias("id"), F.col(by).alias("_g"), vector)
    for i, name in enumerate(("u", "v")):
        value = F.lit(None).cast("double")
        for g, two in kept.items():
            value = F.when(F.col("_g") == g, vision.dot(F.col(vector), F.array(*map(F.lit, two[i])))).otherwise(value)
        out = out.withColumn(name, value)
    out = spread(out.select("id", "_g", "u", "v"), ["u", "v"], "_g")
    return out.select("id", F.coalesce("u", F.lit(0.5)).alias("u"), F.coalesce("v", F.lit(0.5)).alias("v"))


def prototypes(rows: DataFrame, vector: str, label: str, size: int) -> DataFrame:
    """(label, prototype): the unit mean of each label's unit vectors."""
    u = rows.select(label, vision.unit(F.col(vector)).alias("_u"))
    mean = u.groupBy(label).agg(F.array(*(F.avg(F.get("_u", F.lit(i))) for i in range(size))).alias("_m"))
    return mean.select(label, vision.unit(F.col("_m")).alias("prototype"))


def scored(rows: DataFrame, vector: str, protos: DataFrame, label: str, scale: float = 100.0, priors: Column | None = None, key: str = "id") -> DataFrame:
    """(id, probs, cluster): softmax of scaled cosines to the prototypes in label order, plus priors; the first largest wins."""
    table = protos.agg(F.transform(F.array_sort(F.collect_list(F.struct(label, "prototype"))), lambda x: x["prototype"]).alias("_p"))
    d = rows.join(F.broadcast(table), F.lit(True)).withColumn("_u", vision.unit(F.col(vector)))  # one row: a prototype a label
    logits = F.transform("_p", lambda p: scale * vision.dot(p, F.col("_u")))
    if priors is not None:
        logits = F.zip_with(logits, priors, lambda x, y: x + y)
    return d.withColumn("probs", vision.softmax(logits)).select(F.col(key), "probs", vision.argmax(F.col("probs")).alias("cluster"))

"""Duplicate graphs: edges from digests and perceptual hashes, components, recursive traversal."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.vision import hamming
from vellum.scratch import dealt, free, stage


def digest_edges(rows: DataFrame, node: str, digest: str) -> DataFrame:
    """Edges (u, v) from each row to the least of those with the same digest; null and empty digests have none."""
    held = rows.where(F.col(digest).isNotNull() & (F.col(digest) != "")).select(F.col(node).alias("u"), F.col(digest).alias("d"))
    first = held.groupBy("d").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1")
    return held.join(first, "d").where("u <> v").select("u", "v")


def bands(h: Column, radius: int, bits: int = 64, joint: int | None = None) -> Column:
    """Keys (band, value) of a hash, one of which two hashes within ``radius`` share.

    Of radius + ``joint`` bands two such hashes agree on ``joint`` at least, so a
    key is a choice of so many bands: more keys a hash, each of more bits. By
    default two bands make a key for radii up to 8, where keys stay few.
    """
    joint = joint or (2 if radius <= 8 else 1)
    n = radius + joint
    parts, at = [], 0
    for k in range(n):
        width = bits // n + (k < bits % n)
        parts.append((width, F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << width) - 1)) if width < 63 else h))
        at += width
    out = []
    for k, chosen in enumerate(combinations(parts, joint)):
        value = chosen[0][1]
        for width, part in chosen[1:]:
            value = F.shiftleft(value, width).bitwiseOR(part)
        out.append(F.struct(F.lit(k).alias("band"), value.alias("value")))
    return F.array(*out)


def hash_edges(rows: DataFrame, node: str, digest: str, radius: int = 5, residual: Column | None = None) -> DataFrame:
    """Edges (u, v), u < v, of rows whose 64-bit hashes differ in ``radius`` bits at most, by an equi-join on bands.

    A null hash has no edges. Rows with equal hashes are compared through their
    least one only, unless a ``residual`` condition (over columns of sides ``a``
    and ``b``) has to see both. Exact: no pair within the radius is missed.
    """
    held = rows.where(F.col(digest).isNotNull())
    if residual is None:
        groups = held.groupBy(F.col(digest).alias("_h")).agg(F.min(node).alias("_n"))
        same = held.join(groups, F.col(digest) == F.col("_h")).where(F.col(node) != F.col("_n")).select(F.col("_n").alias("u"), F.col(node).alias("v"))
        sides = groups
    else:
        sides = held.withColumnsRenamed({node: "_n", digest: "_h"})
        same = None
    banded = sides.withColumn("_b", F.explode(bands(F.col("_h"), radius)))
    a, b = banded.alias("a"), banded.alias("b")
    near = (F.col("a._b") == F.col("b._b")) & (F.col("a._n") < F.col("b._n")) & (hamming(F.col("a._h"), F.col("b._h")) <= radius)
    if residual is not None:
        near = near & residual
    pairs = a.join(b, near).select(F.col("a._n").alias("u"), F.col("b._n").alias("v")).distinct()
    return pairs if same is None else pairs.union(same)


#: Hashes of a block; a pair of blocks is one task's work, gone through in tiles.
HASHES = 16384


def hash_forest(rows: DataFrame, node: str, digest: str, radius: int = 5) -> DataFrame:
    """Edges (u, v) that join what all pairs of 64-bit hashes within ``radius`` join; a null hash has none.

    For radii whose bands are so short that each of them holds a large part of all rows.
    Distinct hashes are dealt to blocks of about ``HASHES`` and each pair of blocks is
    compared on all bits, which is quadratic in distinct hashes. A task holds two
    blocks and a tile of their distances and gives no more edges than the hashes that it joins.
    """
    held = rows.where(F.col(digest).isNotNull()).select(F.col(digest).cast("long").alias("h"), F.col(node).alias("n"))
    groups = stage(held.groupBy("h").agg(F.min("n").alias("n")), "hashes")
    same = held.alias("a").join(groups.alias("b"), F.col("a.h") == F.col("b.h")).where("a.n <> b.n").select(F.col("b.n").alias("u"), F.col("a.n").alias("v"))
    blocks = max(1, -(-groups.count() // HASHES))
    d = groups.select("h", F.pmod(F.xxhash64("h"), F.lit(blocks)).cast("int").alias("b"))
    of = d.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pair = of.select(F.least("b", "o").alias("p"), F.greatest("b", "o").alias("q"), (F.col("b") > F.col("o")).alias("second"), "h")

    def joined(p: pd.DataFrame) -> pd.DataFrame:
        h, second = p["h"].to_numpy().view(np.uint64), p["second"].to_numpy()
        apart = bool(second.any())
        one, two = (np.flatnonzero(~second), np.flatnonzero(second)) if apart else (np.arange(len(h)),) * 2
        root, u, v, found = np.arange(len(h)), [], [], 0
        for i in range(0, len(one), 256):
            for j in range(0 if apart else i, len(two), 4096):
                x, y = np.nonzero(np.bitwise_count(h[one[i : i + 256], None] ^ h[None, two[j : j + 4096]]) <= radius)
                u.append(one[i + x])
                v.append(two[j + y])
                found += len(x)
                if found > 1 << 20:  # pairs never pile up: a forest says the same
                    root = _rooted(root, np.concatenate(u), np.concatenate(v))
                    u, v, found = [], [], 0
        root = _rooted(root, np.concatenate(u or [root[:0]]), np.concatenate(v or [root[:0]]))
        on = root != np.arange(len(h))
        return pd.DataFrame({"u": p["h"].to_numpy()[root[on]], "v": p["h"].to_numpy()[on]})

    forest = dealt(pair, "p", "q").groupBy("p", "q").applyInPandas(joined, "u long, v long").distinct()
    ends = [groups.select(F.col("h").alias(f"h{k}"), F.col("n").alias(f"n{k}")) for k in (0, 1)]
    edges = forest.join(ends[0], F.col("u") == F.col("h0")).join(ends[1], F.col("v") == F.col("h1")).select(F.least("n0", "n1").alias("u"), F.greatest("n0", "n1").alias("v"))
    return edges.union(same)


def _rooted(root: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``root``, the least place that each place is joined to, with edges (u, v) more."""
    root = root.copy()
    while len(u):
        a, b = root[u], root[v]
        if not (open_ := a != b).any():
            break
        u, v, a, b = u[open_], v[open_], a[open_], b[open_]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while ((up := root[root]) != root).any():
            root = up
    return root


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (u, v): rows (node, root), root the least node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). Each
    round is two grouped minima, combined before they are shuffled, and joins with
    tables of those minima, whose large partitions Spark can split, so that a hub
    is no single task. A round's edges are a table in the shared folder, and the
    round before's are deleted; two numbers a round come to the driver. No edges: no rows. Loops and repeated edges do nothing.
    """
    e = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    seen = None
    while True:
        both = e.union(e.select(F.col("v"), F.col("u")))
        least = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u <> v").distinct(), name)
        free(least, e)
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct(), name)
        free(large, low)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def duplicate_groups(rows: DataFrame, node: str, digest: str, hashed: str, radius: int = 5, residual: Column | None = None) -> DataFrame:
    """``rows`` with component: the least node that equal digests and near hashes lead to."""
    near = hash_forest(rows, node, hashed, radius) if residual is None and radius > 8 else hash_edges(rows, node, hashed, radius, residual)
    edges = digest_edges(rows, node, digest).union(near)
    found = components(edges, "duplicates").withColumnsRenamed({"node": "_node", "root": "_root"})
    return rows.join(found, F.col(node) == F.col("_node"), "left").withColumn("component", F.coalesce("_root", node)).drop("_node", "_root")


def reachable(edges: DataFrame, roots: DataFrame, limit: int = 100) -> DataFrame:
    """Nodes reached from ``roots`` (node) along ``edges`` (u, v), with their least depth; each node is visited once.

    A frontier join a level, until no node is new; ``limit`` guards against
    endless input only and is an error when it is met.
    """
    seen = frontier = stage(roots.select("node", F.lit(0).alias("depth")).distinct(), "reach")
    for depth in range(1, limit + 1):
        step = frontier.join(edges, F.col("node") == F.col("u")).select(F.col("v").alias("node")).distinct()
        frontier = stage(step.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)), "reach")
        if frontier.isEmpty():
            return seen
        seen = stage(seen.union(frontier), "reach")
    raise RuntimeError(f"more than {limit} levels")

"""Whitening of embeddings: covariances merged pairwise, eigenvectors, a second pass that verifies them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import free, stage, tune

#: Entries are taken on a grid of so many steps a unit, and moved so that usual ones are positive.
STEPS, MOVED = 64, 1_000_000
COMPONENTS = 16

#: Count, exact sums, and the scatter of the rows about their mean.
Moments = tuple[int, list[int], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """Means as n and exact sums; ``values`` and ``vectors`` (a column each) by falling value."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def live(self) -> np.ndarray:
        """Components along which the rows vary at all; no others can be scaled."""
        return self.values > len(self.sums) * np.finfo(float).eps * max(float(self.values[0]), 0.0) if len(self.values) else np.zeros(0, bool)

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and remainders of n."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([s - w * self.n for s, w in zip(self.sums, whole, strict=True)], np.int64)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; components without variance are nan."""
        whole, rest = self.centre()
        scale = np.where(self.live, 1 / np.sqrt(np.where(self.live, self.values, 1.0)), np.nan)
        return ((x - whole).astype(np.float64) - rest / self.n) @ (self.vectors * scale)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S)^2, exact; null beyond 38 digits."""
        whole, rest = self.centre()
        most = int(np.abs(x.astype(np.float64) - whole).max(initial=0)) + 2
        kind = pa.decimal128(38, 0)
        if (self.n * most) ** 2 * max(1, x.shape[1]) < 1 << 62:
            d = self.n * (x - whole) - rest
            return pa.array((d * d).sum(axis=1)).cast(kind)
        d = self.n * (x.astype(object) - whole.astype(object)) - rest.astype(object)
        return pa.array([Decimal(v) if v < 10**38 else None for v in (d * d).sum(axis=1).tolist()], kind)


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def merge(a: Moments, b: Moments) -> Moments:
    """Chan's formula: the scatter of both together from each one's own, and the distance of their means."""
    (na, sa, ma), (nb, sb, mb) = a, b
    if not na or not nb:
        return a if na else b
    apart = np.array([(y * na - x * nb) / (na * nb) for x, y in zip(sa, sb, strict=True)])
    return na + nb, [x + y for x, y in zip(sa, sb, strict=True)], ma + mb + np.outer(apart, apart) * (na * nb / (na + nb))


def moments(x: np.ndarray) -> Moments:
    """Of the rows of one batch: they are centred before anything is multiplied."""
    n, first = len(x), x[0]
    y = x - first
    if int(np.abs(y.astype(np.float64)).max(initial=0)) * n < 1 << 61:
        sums = y.sum(axis=0).tolist()
    else:
        y = x.astype(object) - first.astype(object)
        sums = y.sum(axis=0).tolist()
    c = y.astype(np.float64)
    c -= np.array([s / n for s in sums])
    return n, [s + n * int(f) for s, f in zip(sums, first.tolist(), strict=True)], c.T @ c


def of_partition(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """One row: the moments of all rows of a partition."""
    held: Moments = (0, [0] * dims, np.zeros((dims, dims)))
    for b in batches:
        if b.num_rows:
            held = merge(held, moments(matrix(b.column(0), np.int64)))
    n, sums, scatter = held
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(s) for s in sums]], pa.list_(pa.string())), pa.array([scatter.tobytes()], pa.binary())], ["n", "sums", "scatter"])


def quantised(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and x = floor(64 c) + 1000000 of each entry c, for vectors without null or non-finite entries whose x are longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            sizes = np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.float64), nan=0.0).astype(np.int64)
            ends = np.cumsum(sizes)
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * STEPS)
            with np.errstate(invalid="ignore"):
                bad = np.r_[0, np.cumsum(~(np.abs(x) < 2.0**62))]
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (bad[ends] == bad[ends - sizes])
            x = x[np.repeat(good, sizes)].astype(np.int64) + MOVED
            kept = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes[good])].astype(np.int32)), pa.array(x))
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(good)), kept], ["vec_id", "x"])

    d = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return d.mapInArrow(run, "vec_id long, x array<long>")


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Of distinct vectors ``x``: a partition's moments, merged in a tree, the eigenvectors on the driver, and a second pass.

    What reaches the driver is a matrix of dims^2 numbers.
    """

    def summed(part: DataFrame, size: int) -> Moments:
        raw = part.rdd.map(lambda r: (r.n, [int(s) for s in r.sums], np.frombuffer(bytes(r.scatter)).reshape(size, size)))
        return raw.treeReduce(merge)

    kinds = "n long, sums array<string>, scatter binary"
    n, sums, scatter = summed(vectors.mapInArrow(partial(of_partition, dims=dims), kinds), dims)
    cov = (scatter + scatter.T) / (2 * n)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(components, dims)]
    trace = float(np.trace(cov))
    found = Whitening(n, sums, values[order], axes[:, order], values[order] / trace if trace else np.zeros(len(order)))
    live = np.flatnonzero(found.live)
    if not len(live):
        return found

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean, about = 0, np.zeros(len(live)), np.zeros((len(live), len(live)))
        for b in batches:
            if not b.num_rows:
                continue
            z = found.apply(matrix(b.column(0), np.int64))[:, live]
            m, own = z.mean(axis=0), len(z)
            c, apart = z - m, m - mean
            about += c.T @ c + np.outer(apart, apart) * (total * own / (total + own))
            total, mean = total + own, mean + apart * own / (total + own)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([mean.tolist()], pa.list_(pa.float64())), pa.array([about.tobytes()], pa.binary())], ["n", "mean", "scatter"])

    def joined(a: tuple, b: tuple) -> tuple:
        (na, xa, ma), (nb, xb, mb) = a, b
        if not na or not nb:
            return a if na else b
        return na + nb, xa + (xb - xa) * (nb / (na + nb)), ma + mb + np.outer(xb - xa, xb - xa) * (na * nb / (na + nb))

    size = len(live)
    seen = vectors.mapInArrow(verify, "n long, mean array<double>, scatter binary").rdd
    total, _, about = seen.map(lambda r: (r.n, np.array(r.mean), np.frombuffer(bytes(r.scatter)).reshape(size, size))).treeReduce(joined)
    error = float(np.abs(about / total - np.eye(size)).max())
    return Whitening(found.n, found.sums, found.values, found.vectors, found.explained, error)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None]:
    """Whitened vectors (vec_id, deviation decimal, whitened array<double>) and the model that they were fitted to.

    Rows whose vector is null, is empty, or holds null, non-finite or entries
    beyond 2^56 have no place and go. Where lengths differ, the commonest counts
    (of equal ones the longest), and others go. The fit is over each distinct
    vector once, so repeated rows and one very common vector weigh once; all rows
    with a place are returned, repeated and null ids too. A component along which
    the vectors do not vary has null whitened values and is no part of
    ``identity_error``. No rows give none, and no model. Other columns are not
    read. Runs its two passes when called.
    """
    tune(rows.sparkSession)
    x = stage(quantised(rows, id_col, vector_col), "whitening-x")
    lengths = x.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    if not lengths:
        return x.select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.lit(None).cast("array<double>").alias("whitened")), None
    dims = lengths[0].dims
    placed = x.where(F.size("x") == dims)
    distinct = stage(placed.select("x").distinct(), "whitening-distinct")
    model = fit(distinct, dims, components)
    free(distinct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = matrix(b.column(1), np.int64)
                z = model.apply(m)
                flat = pa.array(z.ravel(), from_pandas=True)  # nan is null
                ends = pa.array(np.arange(len(m) + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays([b.column(0), model.deviations(m), pa.ListArray.from_arrays(ends, flat)], ["vec_id", "deviation", "whitened"])

    return placed.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>"), model


def whitened_components(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row a vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is a long; it is null in the rare case that no long holds it
    (some 10^9 distinct vectors), where ``whiten`` has it as a decimal.
    """
    wide, model = whiten(rows, components=components)
    shares = F.array(*(F.lit(float(v)) for v in model.explained)) if model else F.array(F.lit(0.0))
    long = wide.select("vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    return long.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )

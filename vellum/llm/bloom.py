"""Bloom filters of bounded size over 64-bit hashes, built on the executors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vellum.llm.common import in_workers, mix

#: Bits a row, probes a row, the most bits of a filter (16 MB), bits of one piece.
BITS_A_ROW, PROBES, MOST_BITS, PIECE = 16, 4, 1 << 27, 1 << 20


def bits_for(rows: int, most: int = MOST_BITS) -> int:
    """A power of two: at least 16 bits a row, up to ``most``. A fuller filter says "maybe" more often, never a wrong no."""
    return 1 << max(16, min(most.bit_length() - 1, (BITS_A_ROW * max(rows, 1)).bit_length()))


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    """The places of each hash in a filter of ``bits`` bits (a power of two), one row a hash."""
    h = h.astype(np.uint64, copy=False)[:, None]
    step = np.arange(PROBES, dtype=np.uint64)
    return ((h + step * (mix(h) | np.uint64(1))) & np.uint64(bits - 1)).astype(np.int64)


def build(hashes: DataFrame, bits: int, times: int = 1) -> np.ndarray:
    """A filter, packed, of the long column ``h`` of ``hashes``: the places met ``times`` times (1 or 2) or more.

    A task folds its rows into a filter of its own and emits the pieces that are
    not empty; pieces are merged where they meet, and only the merged filter, of
    ``bits`` bits at most, reaches the driver.
    """
    piece = min(PIECE, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(0, np.uint8)
        for b in batches:
            if b.num_rows:
                n = n if len(n) else np.zeros(bits, np.uint8)
                at, met = np.unique(probes(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits), return_counts=True)
                n[at] = np.minimum(2, n[at] + np.minimum(met, 2))
        for k in range(0, len(n), piece):
            x = n[k : k + piece]
            if x.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k // piece], pa.int32()), pa.array([np.packbits(x >= 1).tobytes()]), pa.array([np.packbits(x >= 2).tobytes()])],
                    ["k", "one", "two"],
                )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            for k, one, two in zip(*(c.to_pylist() for c in b.columns), strict=True):
                one, two = np.frombuffer(one, np.uint8), np.frombuffer(two, np.uint8)
                if k in kept:
                    a, c = kept[k]
                    one, two = a | one, c | two | (a & one)
                kept[k] = one, two
        for k, both in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([both[times - 1].tobytes()])], ["k", "bits"])

    spark = hashes.sparkSession
    # One filter a task: no more tasks than cores, so that filters stay few.
    few = hashes.select("h").coalesce(max(2, spark.sparkContext.defaultParallelism))
    parts = in_workers(few, count, "k int, one binary, two binary").repartition(max(1, bits // piece), "k")
    out = np.zeros(bits // 8, np.uint8)
    for k, got in in_workers(parts, merge, "k int, bits binary").toLocalIterator():
        out[k * piece // 8 : (k + 1) * piece // 8] = np.frombuffer(bytes(got), np.uint8)
    return out


def ask(packed: np.ndarray, h: np.ndarray) -> np.ndarray:
    """For each hash whether the filter may hold it."""
    at = probes(h, len(packed) * 8)
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)

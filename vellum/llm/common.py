"""What the operators of this subpackage share: Python workers, runs of texts, hashes."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.graph import components
from vellum.scratch import BATCH_BYTES, BATCH_ROWS, free, scratch_dir, stage, tune

#: ASCII white space of the word pattern ``[^\x20\x09-\x0D]+``.
WS = b" \t\n\x0b\x0c\r"
#: Python code takes a batch apart in runs of about so many bytes of text.
RUN_BYTES = 2 << 20


def trim() -> None:
    """Give memory that is free back to the system: a worker may sit idle beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_workers(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType, tokens: bool = False) -> DataFrame:
    """``df`` through ``run`` in Python workers, by Arrow batches.

    A worker lives on after its task. One that goes over to other work drops the
    words that an encoder remembers (``tokens``: it goes on with them), and after
    each task free memory goes back to the system.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not tokens and (held := sys.modules.get("vellum.llm.tokens")):
            held.forget_all()
        yield from run(batches)
        trim()

    return df.mapInArrow(task, schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` has not."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def told_apart(docs: DataFrame, id_col: str, column: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a long ``column`` that tells its rows apart, and a table to free when it is done with.

    That is the id where it is never null and never repeats; else rows are
    numbered, in a table, so that the numbers stay as they are.
    """
    named = docs.select(F.col(id_col).cast("long").alias("i"))
    if named.groupBy("i").agg(F.count("*").alias("n")).where("i is null or n > 1").isEmpty():
        return docs.withColumn(column, F.col(id_col).cast("long")), None
    held = stage(docs.withColumn(column, F.monotonically_increasing_id()), "rows")
    return held, held


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def runs(texts: list, limit: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Slices [i, j) of ``texts`` of about ``limit`` bytes, one text at least."""
    i = size = 0
    for j, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def slices(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """``column`` in slices (first place, slice) of about ``limit`` bytes of text, one text at least; see ``runs``."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + limit)))
        yield i, column.slice(i, j - i)
        i = j


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every piece, end to end."""
    total = int(lens.sum())
    ends = np.cumsum(lens)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)


def code_points(column: pa.Array) -> pa.Array:
    return pc.fill_null(pc.utf8_length(column), 0)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain constants)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def local_roots(nodes: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of the sorted ``nodes`` the least node that edges (u, v) reach."""
    root = np.arange(len(nodes))
    a, b = np.searchsorted(nodes, u), np.searchsorted(nodes, v)
    while len(a):
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        if not (open_ := low != high).any():
            break
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return nodes[root]


__all__ = [
    "BATCH_BYTES", "BATCH_ROWS", "RUN_BYTES", "WS", "code_points", "components", "free", "in_workers", "local_roots", "mix", "ragged", "read_documents", "runs", "scratch_dir", "slices", "stage", "text_bytes", "told_apart", "tune", "unused",
]

"""Token-id files: ids end to end, document boundaries in Elias-Fano code.

A segment is one binary value:

    magic, id width, counts of documents, null ids and ids      fixed header
    boundaries      Elias-Fano code of the documents' starts and the end
    document ids    Elias-Fano code of the ascending ids, less the first
    ids             16 or 32 bits each, little-endian

A file is a table of segments, so that it can lie in any store that Spark writes
to and is committed as a whole. Elias-Fano code keeps ``low`` bits of each number
as they are and the rest in unary. Beside the code lies its select directory, 32
bits for each 512th one bit: ``select`` finds the i-th one bit from there, and
``blocks`` reads boundaries 512 at a time, so no table of 64-bit offsets is made.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, scratch_dir, slices, tune
from vellum.llm.tokens import encoder, model_path

MODEL, END = "byte_bpe_50k.json", 0
MAGIC, HEADER = b"VTS2", struct.Struct("<4sBQQQq")
SAMPLE = 512
#: A segment closes when it has so many ids.
SEGMENT_IDS = 1 << 20


class EliasFano:
    """An ascending sequence of non-negative numbers in near-minimal space, with its select directory."""

    HEAD = struct.Struct("<QBQQQ")

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, sample: np.ndarray) -> None:
        #: ``sample`` has the place in ``high`` of every ``SAMPLE``-th one bit.
        self.n, self.low_bits, self.low, self.high, self.sample = n, low_bits, low, high, sample

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, ((top + 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        if low_bits:
            bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
            low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        else:
            low = np.zeros(0, np.uint8)
        high = np.zeros(n + (top >> low_bits) + 1, np.uint8)
        if len(high) >= 1 << 32:
            raise ValueError("a segment has fewer numbers")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high[ones] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def tobytes(self) -> bytes:
        head = self.HEAD.pack(self.n, self.low_bits, len(self.low), len(self.high), len(self.sample))
        return head + self.low.tobytes() + self.high.tobytes() + self.sample.tobytes()

    @classmethod
    def frombytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence at the start of ``data``, which stays where it is, and the bytes that it takes."""
        n, low_bits, a, b, c = cls.HEAD.unpack_from(data)
        x = cls.HEAD.size
        y, z = x + a, x + a + b
        return cls(n, low_bits, np.frombuffer(data[x:y], np.uint8), np.frombuffer(data[y:z], np.uint8), np.frombuffer(data[z : z + 4 * c], "<u4")), z + 4 * c

    def select(self, i: int) -> int:
        """The i-th number."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        first, left = int(self.sample[i // SAMPLE]), i % SAMPLE
        at = first // 8
        byte = int(self.high[at]) >> first % 8 << first % 8
        while left >= (c := byte.bit_count()):
            left -= c
            at += 1
            byte = int(self.high[at])
        for _ in range(left):
            byte &= byte - 1
        high = 8 * at + (byte & -byte).bit_length() - 1 - i
        first = i * self.low_bits
        chunk = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
        return high << self.low_bits | chunk >> first % 8 & (1 << self.low_bits) - 1

    def blocks(self) -> Iterator[np.ndarray]:
        """All numbers, ``SAMPLE`` at a time: each block is selected through the directory alone."""
        for k, first in enumerate(self.sample.tolist()):
            i, j = k * SAMPLE, min((k + 1) * SAMPLE, self.n)
            end = int(self.sample[k + 1]) if j < self.n else 8 * len(self.high)
            bits = np.unpackbits(self.high[first // 8 : (end + 7) // 8], bitorder="little")[first % 8 : end - first // 8 * 8]
            out = (np.flatnonzero(bits) + (first - i) - np.arange(j - i)).astype(np.uint64) << np.uint64(self.low_bits)
            if self.low_bits:  # a block's low bits start at a whole byte
                low = np.unpackbits(self.low[i * self.low_bits // 8 : (j * self.low_bits + 7) // 8], bitorder="little")[: (j - i) * self.low_bits]
                out |= (low.reshape(j - i, self.low_bits).astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
            yield out


class Segment:
    """Documents of a segment by position."""

    def __init__(self, data: bytes) -> None:
        magic, width, self.n, self.nulls, self.n_ids, self.first = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        view, at = memoryview(data), HEADER.size
        self.bounds, size = EliasFano.frombytes(view[at:])
        self.named, more = EliasFano.frombytes(view[at + size :])
        self.ids = np.frombuffer(view[at + size + more :], f"<u{width}")

    @staticmethod
    def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
        """Null document ids, if any, come first; the others ascend."""
        named = np.array([x for x in doc_ids if x is not None], np.int64)
        first = int(named[0]) if len(named) else 0
        width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
        head = HEADER.pack(MAGIC, width, len(doc_ids), len(doc_ids) - len(named), len(ids), first)
        bounds = EliasFano.of(np.r_[0, np.cumsum(counts)])
        return head + bounds.tobytes() + EliasFano.of(named.view(np.uint64) - np.uint64(first % (1 << 64))).tobytes() + ids.astype(f"<u{width}").tobytes()

    def doc_id(self, i: int) -> int | None:
        """The id of the i-th document."""
        if i < self.nulls:
            return None
        return (self.named.select(i - self.nulls) + self.first + (1 << 63)) % (1 << 64) - (1 << 63)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document."""
        return self.ids[self.bounds.select(i) : self.bounds.select(i + 1)]

    def documents(self) -> Iterator[tuple[list[int | None], np.ndarray]]:
        """Document ids, and the documents' starts with the end of the last, some hundreds at a time."""
        ids = chain(repeat(None, self.nulls), chain.from_iterable((x + np.uint64(self.first % (1 << 64))).view(np.int64).tolist() for x in self.named.blocks()))
        last = np.zeros(0, np.uint64)
        for block in self.bounds.blocks():
            bounds = np.r_[last, block].astype(np.int64)
            last = block[-1:]
            if len(bounds) > 1:
                yield list(islice(ids, len(bounds) - 1)), bounds


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, end: int = END, parts: int | None = None) -> None:
    """Encode whole texts, end each document with id ``end``, write them in ascending id order.

    A null text is an empty document: the end id alone. Null document ids come
    first; equal ids stand beside each other. Parts are ranges of document ids,
    each in order, and a part is written by one task as segments of about
    ``SEGMENT_IDS`` ids; a longer document has a segment of its own.
    """
    spark = docs.sparkSession
    tune(spark)
    model = model_path(name)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq, base = encoder(model), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, base
            names = [x for h in held for x in h[0]]
            counts, ids = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            held.clear()
            row = [pa.array([part]), pa.array([seq]), pa.array([base]), pa.array([len(ids)]), pa.array([Segment.pack(names, counts, ids)], pa.binary())]
            seq, base = seq + 1, base + len(ids)
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "base", "n_ids", "data"])

        for b in batches:
            names = b.column(0).to_pylist()
            for i, texts in slices(b.column(1)):
                ids, counts = enc.encode(texts)
                held.append((names[i : i + len(texts)], counts + 1, np.insert(ids, np.cumsum(counts), end)))
                if sum(len(h[2]) for h in held) >= SEGMENT_IDS:
                    yield close()
        if held:
            yield close()

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = d.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    in_workers(ordered, run, "part long, seq long, base long, n_ids long, data binary", tokens=True).write.parquet(path)


def read_tokens(spark, path: str, ids: bool = True) -> DataFrame:
    """One row a document of a token file: doc_id, start (ids before it), n_tokens, ids_crc32, and its ids if asked.

    ids_crc32 is the CRC-32 of the ids as unsigned 32-bit little-endian numbers.
    The parts' offsets, a number a part, are summed first from the table's
    narrow columns; boundaries are then selected in each segment where it is
    read. Null ids come back as null, repeated ids a row each; an empty table
    gives no rows.
    """
    table = spark.read.parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()
    offset: dict[int, int] = {}
    total = 0
    for part, n in sorted(map(tuple, totals)):
        offset[part], total = total, total + n
    known = spark.sparkContext.broadcast(offset)
    more = ["ids"] if ids else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, base, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = Segment(data)
                for names, bounds in s.documents():
                    wide = s.ids[bounds[0] : bounds[-1]].astype("<u4")
                    at = bounds - bounds[0]
                    crc = [zlib.crc32(wide[x:y].data) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    cols = [pa.array(names, pa.int64()), pa.array(bounds[:-1] + (known.value[part] + base)), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())]
                    if ids:
                        cols.append(pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(wide.astype(np.int32))))
                    yield pa.RecordBatch.from_arrays(cols, ["doc_id", "start", "n_tokens", "ids_crc32", *more])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    return in_workers(table.select("part", "base", "data"), run, schema)


def token_table(docs: DataFrame, name: str = MODEL) -> DataFrame:
    """Write ``docs`` as a token file in the shared folder and read it back: see ``write_tokens`` and ``read_tokens``.

    A null text is the end id alone; rows that repeat an id are documents each;
    other columns are not read; an empty table gives no rows.
    """
    path = f"{scratch_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_tokens(docs, path, name=name)
    return read_tokens(docs.sparkSession, path, ids=False)

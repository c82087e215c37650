"""Packing token pieces into sequences by minimum bin slack.

The sequence being filled starts with the longest piece left; a subset-sum
dynamic program over the lengths still available, kept as the bits of an integer,
finds the fullest feasible combination, which is then removed. Only lengths
matter for that, so the plan is made from their histogram, which has at most as
many entries as a sequence has tokens: a combination is repeated while all its
lengths last. Which piece fills which place follows from the pieces' ranks
among those of their length, so the pieces themselves never meet.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, slices, stage, tune, unused
from vellum.llm.tokens import encoder, model_path

MODEL, END, CAPACITY = "word_bpe_49k.json", 1, 4096
#: Parts in which the pieces of one length are ranked.
SHARDS = 1024


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, end: int = END, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Encode whole texts, end each with id ``end``, cut those longer than ``capacity``.

    Rows (doc_id, piece, start, length, ids_crc32), and the ids if asked. A null
    text is an empty one: one piece, of the end id. The CRC-32 is of the ids as
    unsigned 32-bit little-endian numbers.
    """
    tune(docs.sparkSession)
    model = model_path(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for b in batches:
            names = b.column(0)
            for i, texts in slices(b.column(1)):
                flat, counts = enc.encode(texts)
                flat = np.insert(flat, np.cumsum(counts), end).astype("<u4")
                counts = counts + 1
                first = np.cumsum(counts) - counts
                n = -(-counts // capacity)
                doc = np.repeat(np.arange(i, i + len(texts)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, np.repeat(counts, n) - start)
                at = np.repeat(first, n) + start
                crc = [zlib.crc32(flat[x : x + y].data) for x, y in zip(at.tolist(), length.tolist(), strict=True)]
                cols = [names.take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if ids:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])])

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_workers(d, run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids, tokens=True)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination of at most ``room``, of the available lengths: how often each is used."""
    reach, steps = 1, []
    mask, want = (1 << room + 1) - 1, 1 << room
    for length in sorted((x for x in counts if x <= room and counts[x]), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left and not reach & want:  # 1, 2, 4, ... copies at once reach every number of copies
            k = min(k, left)
            steps.append((reach, length, k))
            reach |= reach << length * k & mask
            left -= k
            k *= 2
        if reach & want:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, k in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + k
            total -= length * k
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations, each with how many sequences it fills."""
    left, out = dict(counts), []
    while left:
        seed = max(left)
        left[seed] -= 1
        used = fullest(left, capacity - seed)
        left[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
        out.append((used, times))
    return out


def places(combinations: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, uses a sequence, first sequence, offset) that its ranks fall in."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for used, times in combinations:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            rows.setdefault(length, []).append((taken.get(length, 0), n, sequence, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        sequence += times
    return {k: np.array(v, np.int64) for k, v in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """Add sequence_id and offset to ``pieces``, rows with a positive ``length`` of ``capacity`` at most.

    Offsets in a sequence run from 0 without gaps. Pieces of equal length are
    ranked within shards of their key, and the shards' counts make the ranks
    whole, so a common length is no single task. Rows that repeat each get a
    place. An empty table gives no rows. Columns named sequence_id or offset are
    replaced; others may have any name.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    shard, rank, of, named, before = unused(pieces, "shard", "rank", "of", "length_of", "before")
    sharded = pieces.withColumn(shard, F.pmod(F.xxhash64(*key), F.lit(SHARDS)).cast("int"))
    counts = sharded.groupBy("length", shard).agg(F.count("*").alias("n"))
    sums = F.sum("n").over(Window.partitionBy("length").orderBy(shard).rowsBetween(Window.unboundedPreceding, -1))
    counts = stage(counts.select("length", shard, "n", F.coalesce(sums, F.lit(0)).alias(before)), "packing-counts")
    histogram = {int(x): int(n) for x, n in counts.groupBy("length").agg(F.sum("n")).collect()}
    if any(not 0 < x <= capacity for x in histogram):
        raise ValueError("a piece is empty or longer than a sequence")
    table = spark.sparkContext.broadcast(places(plan(histogram, capacity)))
    local = F.row_number().over(Window.partitionBy("length", shard).orderBy(*key))
    offsets = counts.select(F.col("length").alias(named), F.col(shard).alias(of), before)
    ranked = sharded.withColumn(rank, local.cast("long") - 1).join(offsets, (F.col("length") == F.col(named)) & (F.col(shard) == F.col(of)))
    ranked = ranked.select(*pieces.columns, (F.col(rank) + F.col(before)).alias(rank))
    at, names = pieces.columns.index("length"), [*pieces.columns, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (at, b.num_columns - 1))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
                rows = table.value[int(length[some[0]])]
                first, uses, start, begin = rows[np.searchsorted(rows[:, 0], rank[some], side="right") - 1].T
                n = rank[some] - first
                sequence[some] = start + n // uses
                offset[some] = begin + n % uses * length[some]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sequence), pa.array(offset)], names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return in_workers(ranked, place, f"{fields}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Whole documents as pieces in sequences: (doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    A null or empty text is one piece, of the end id; null ids and rows that
    repeat are documents like others; other columns are not read; an empty table
    gives no rows.
    """
    return pack(stage(token_pieces(docs, id_col, text_col, name, END, capacity, ids), "packing-pieces"), capacity)

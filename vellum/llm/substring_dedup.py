"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``size`` consecutive words. The least hash among its 8-word grams is
its anchor, so equal windows have equal anchors at equal places. The windows that
share an anchor occurrence make a block: a stretch of the document from the first
of those windows to the end of the last. The index holds every block of every
document by (anchor, content), with one count a content, however many copies.

Each content of the index has two references, its first and its last occurrence.

A document is parsed greedily from left to right. A block whose content is indexed
twice or more starts a factor that copies from a reference other than itself, and
the factor goes on for as long as the next block, or window, is found where the
reference goes on too. Where contents around a shared anchor differ - at the ends
of a factor - the block's windows are looked up one by one among the windows of
the other contents of that anchor, which also have two references each. A factor
has ``size`` words or more; what factors cover are the duplicate spans. As the
window's rule asks for every window that occurs elsewhere, factors may overlap by
up to ``size`` - 1 words, where a phrase of a plain parse would end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm import bloom
from vellum.llm.common import free, in_workers, mix, runs, stage, text_bytes, tune, unused

#: Words of a window; words of a gram.
SIZE, GRAM = 35, 8
#: Odd multipliers of two polynomial hashes modulo 2^64.
C1, C2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class Words:
    """The words of a run of texts end to end, and hashes of any stretch of them."""

    def __init__(self, texts: list[bytes | None]) -> None:
        split = [(t or b"").split() for t in texts]
        self.sizes = np.array([len(w) for w in split], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        n = int(self.sizes.sum())
        h = np.fromiter((xxhash.xxh64_intdigest(x) for w in split for x in w), np.uint64, n)
        self.sums, self.inverse = {}, {}
        for c in (C1, C2):
            self.sums[c] = np.r_[np.uint64(0), np.cumsum(h * self.powers(c, n), dtype=np.uint64)]
            self.inverse[c] = self.powers(pow(c, -1, 1 << 64), n + 1)

    @staticmethod
    def powers(c: int, n: int) -> np.ndarray:
        p = np.full(n, c, np.uint64)
        p[:1] = 1
        return np.cumprod(p, dtype=np.uint64)

    def hash(self, start: np.ndarray, size: np.ndarray | int, c: int = C1) -> np.ndarray:
        """Of the words [start, start + size), the same wherever they stand."""
        s = self.sums[c]
        return mix((s[start + size] - s[start]) * self.inverse[c][start])

    def blocks(self, size: int, gram: int) -> tuple[np.ndarray, ...]:
        """The blocks: document, anchor hash, content hash, first window (word of its document), number of windows."""
        wide = size - gram + 1
        open_ = np.flatnonzero(self.sizes >= size)
        if not len(open_):
            return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64))
        total = len(self.sums[C1]) - 1
        g = self.hash(np.arange(total - gram + 1), gram)
        at = np.arange(len(g))  # the leftmost least gram of each window, by doubling
        reach = 1
        while 2 * reach <= wide:
            left, right = at[: len(at) - reach], at[reach:]
            at = np.where(g[right] < g[left], right, left)
            reach *= 2
        if wide > reach:
            left, right = at[: len(at) - (wide - reach)], at[wide - reach :]
            at = np.where(g[right] < g[left], right, left)
        doc = np.repeat(open_, self.sizes[open_] - size + 1)
        n = self.sizes[open_] - size + 1
        start = np.repeat(self.first[open_] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        anchor = at[start]
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        windows = np.diff(np.r_[new, len(start)])
        doc, start, anchor = doc[new], start[new], anchor[new]
        content = mix(self.hash(start, windows + size - 1, C2) + ((anchor - start) * 64 + windows).astype(np.uint64) * np.uint64(C1))
        return doc, g[anchor], content, start - self.first[doc], windows


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    for b in batches:
        texts = text_bytes(b.column("text"))
        for i, j in runs(texts, 1 << 20):
            yield b.slice(i, j - i), texts[i:j]


def may_be_in(rows: DataFrame, ids: DataFrame, column: str = "rid") -> tuple[DataFrame, DataFrame]:
    """``rows`` parted by a Bloom filter of ``ids`` (rid): those whose ``column`` may be among them, and those not."""
    bits = bloom.bits_for(ids.count())
    packed = rows.sparkSession.sparkContext.broadcast(bloom.build(ids.select(F.col("rid").alias("h")), bits))

    def part(wanted: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    h = b.column(column).to_numpy(zero_copy_only=False).view(np.uint64)
                    yield b.filter(pa.array(bloom.ask(packed.value, h) == wanted))

        return in_workers(rows, run, rows.schema)

    return part(True), part(False)


def with_rid(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (rid, text): a 64-bit hash of id and text stands for a row, so ids may be null or repeat."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(rid(id_col, text_col).alias("rid"), text.alias("text"))


def rid(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("string"))


def duplicate_windows(docs: DataFrame, id_col: str, text_col: str, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """Rows (rid, marks): the blocks (at, mask) of a row that hold duplicate windows; bit k of mask is window at + k."""
    if not 0 <= size - gram <= 61:
        raise ValueError("a window has a gram at least and 61 words more at most")
    rows = with_rid(docs, id_col, text_col)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in rows_of(batches):
            doc, h, g, at, n = Words(texts).blocks(size, gram)
            ids = b.column("rid").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (h.view(np.int64), g.view(np.int64), ids[doc], at.astype(np.int32), n.astype(np.int32))], ["h", "g", "rid", "at", "n"]
            )

    blocks = stage(in_workers(rows, index, "h long, g long, rid long, at int, n int"), "substring-blocks")
    # An anchor is one row a task before the shuffle, however often it occurs.
    anchors = blocks.groupBy("h").agg(F.count("*").alias("times"), F.min("g").alias("low"), F.max("g").alias("high"))
    shared = stage(anchors.where("times > 1").select(F.col("h").alias("shared_h"), (F.col("low") != F.col("high")).alias("varied")), "substring-anchors")
    met = stage(blocks.join(shared, F.col("h") == F.col("shared_h")).drop("shared_h"), "substring-shared")

    place = F.struct("rid", "at")
    contents = met.groupBy("h", "g").agg(
        F.count("*").alias("times"), F.first("varied").alias("varied"), F.min(F.struct("rid", "at", "n")).alias("one"), F.max(place).alias("last")
    )
    contents = stage(contents, "substring-contents")
    two = lambda first, last: (F.col(f"{first}.rid").alias("r1"), F.col(f"{first}.at").alias("a1"), F.col(f"{last}.rid").alias("r2"), F.col(f"{last}.at").alias("a2"))
    whole = contents.where("times > 1").select(F.col("h").alias("whole_h"), F.col("g").alias("whole_g"), *two("one", "last"))

    # Factor ends: one block of each content of a varied anchor, window by window.
    ask = contents.where("varied").select("h", "g", "one.*", F.least("times", F.lit(2)).cast("int").alias("weight"))
    ask = stage(ask.groupBy("rid").agg(F.collect_list(F.struct("h", "g", "at", "n", "weight")).alias("ends")), "substring-ends")
    maybe, _ = may_be_in(rows, ask)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in rows_of(batches):
            words = Words(texts)
            ends = b.column("ends")
            doc = np.repeat(np.arange(b.num_rows), ends.value_lengths().to_numpy())
            e = ends.flatten()
            h, g, at, n, weight = (e.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            which = np.repeat(np.arange(len(h)), n)
            k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            start = (words.first[doc] + at)[which] + k
            a, c = words.hash(start, size).view(np.int64), words.hash(start, size, C2).view(np.int64)
            ids = b.column("rid").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (a, (c >> 32).astype(np.int32), h[which], g[which], k.astype(np.int32), weight[which], ids[doc][which], (at[which] + k).astype(np.int32))],
                ["a", "c", "h", "g", "k", "weight", "rid", "at"],
            )

    # A row that repeats in the table would count its windows twice, so rows are made one.
    asked = maybe.join(ask, "rid").dropDuplicates(["rid"])
    windows = stage(in_workers(asked, check, "a long, c int, h long, g long, k int, weight int, rid long, at int"), "substring-windows")
    twice = windows.groupBy("a", "c").agg(F.sum("weight").alias("times"), F.min(place).alias("first"), F.max(place).alias("last")).where("times > 1")
    twice = stage(twice.select(F.col("a").alias("a3"), F.col("c").alias("c3"), *two("first", "last")), "substring-repeated")
    # A content that stands once has one block, known by its place; one that stands twice is a factor whole.
    part = windows.where("weight = 1").join(twice, (F.col("a") == F.col("a3")) & (F.col("c") == F.col("c3")))
    marked = met.join(whole, (F.col("h") == F.col("whole_h")) & (F.col("g") == F.col("whole_g")))
    both = marked.select("rid", "at", "n", "r1", "a1", "r2", "a2").union(part.select("rid", "at", F.lit(1), "r1", "a1", "r2", "a2"))
    marks = stage(both.groupBy("rid").agg(F.collect_set(F.struct("at", "n", "r1", "a1", "r2", "a2")).alias("marks")), "substring-marks")
    free(blocks, shared, met, contents, ask, windows, twice)
    return marks


def factors(size: int, own: np.ndarray, row: np.ndarray, marks: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The greedy parses of rows with hashes ``own``: arrays (row, start, end, reference row, its start) of their factors, in words.

    ``marks`` (at, n, r1, a1, r2, a2) of the rows with places ``row`` are runs of n
    duplicate windows and two references of the first. A factor starts at the
    first window that the last one does not reach, and goes on, run by run, while
    one of its references does. A run that stands at a reference itself has only
    the other, unless the row repeats in the table.
    """
    order = np.lexsort((marks[0], row))
    row, at, n, r1, a1, r2, a2 = (x[order] for x in (row, *marks))
    me = own[row]
    self1, self2 = (r1 == me) & (a1 == at), (r2 == me) & (a2 == at)
    allowed = np.where(self1 & ~self2, 2, np.where(self2, 1, 3))  # bit 0: the first reference, bit 1: the last
    go = np.zeros(len(at), np.int64)  # bits 0 and 1: what goes on to this run's first reference, of the run before's; bits 2 and 3: to its last
    if len(at):
        after = np.r_[False, (row[1:] == row[:-1]) & (at[1:] == at[:-1] + n[:-1])]
        for bit, (r, a, p, q) in enumerate(((r1, a1, r1, a1), (r1, a1, r2, a2), (r2, a2, r1, a1), (r2, a2, r2, a2))):
            go[1:] |= ((r[1:] == p[:-1]) & (a[1:] == q[:-1] + n[:-1])).astype(np.int64) << bit
        go[~after] = 0
    state, begins, now = [], [], 0
    for ok, g in zip(allowed.tolist(), go.tolist(), strict=True):
        going = ((1 if g & now else 0) | (2 if g >> 2 & now else 0)) & ok if g else 0
        begins.append(not going)
        now = going or ok
        state.append(now)
    first = np.flatnonzero(begins)
    last = np.r_[first[1:], len(at)][: len(first)] - 1
    one = (np.array(state, np.int64)[last] & 1) > 0 if len(first) else np.zeros(0, bool)
    ref, ref_at = np.where(one, r1[last], r2[last]), np.where(one, a1[last], a2[last])
    return row[first], at[first], at[last] + n[last] + size - 1, ref, ref_at - (at[last] - at[first])


def united(parse: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What factors cover, as disjoint spans [start, end) in words."""
    spans: list[tuple[int, int]] = []
    for start, end in parse:
        if spans and start <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(end, spans[-1][1])
        else:
            spans.append((start, end))
    return spans


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, gram: int = GRAM, digest: bool = False
) -> DataFrame:
    """The columns of ``docs`` with ``text_col`` cleaned, then n_words, n_removed, spans and factors.

    Each word covered by a window of ``size`` words that also starts anywhere
    else goes; the windows are judged on the input. A text that loses nothing is
    returned as it is; else the words left are joined by one space. ``spans``
    holds the parts that went, as [start, end) in words, and ``factors`` what they
    were copied from: [start, end), the hash of the reference row (``rid``) and
    the word where it starts there. Null and empty texts have no words and stay;
    a row that repeats another loses all its windows. Windows are told apart by
    96 bits of two hashes and their anchor. Columns of the input named like the
    new ones are replaced, others may have any name; an empty table stays so. With
    ``digest``, kept_sha256 takes the place of the text: SHA-256 of the words
    left, joined by one space.
    """
    spark = docs.sparkSession
    tune(spark)
    marks = duplicate_windows(docs, id_col, text_col, size, gram)
    added = {"n_words", "n_removed", "spans", "factors"}
    kept = [id_col] if digest else [c for c in docs.columns if c != text_col and c.lower() not in added]
    names = [*kept, "kept_sha256" if digest else text_col, "n_words", "n_removed", "spans", "factors"]
    text_, row_, marks_, rid_ = unused(docs, "text_of", "row_of", "marks_of", "marked_row")
    rows = docs.select(*kept, F.col(text_col).cast("string").alias(text_), rid(id_col, text_col).alias(row_))
    maybe, clean = may_be_in(rows, marks, row_)
    joined = maybe.join(marks.select(F.col("rid").alias(rid_), F.col("marks").alias(marks_)), F.col(row_) == F.col(rid_), "left")
    none = F.array().cast(marks.schema["marks"].dataType)
    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{c}` {types[c]}" for c in kept)
    schema += f", `{names[-5]}` string, n_words long, n_removed long, spans array<struct<start: long, end: long>>"
    schema += ", factors array<struct<start: long, end: long, rid: long, at: long>>"
    whole = [pa.field(n, pa.int64()) for n in ("start", "end", "rid", "at")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, n_words, n_removed, spans = [], [], [], []
            held = b.column(len(kept) + 2)
            flat = held.flatten()
            row = np.repeat(np.arange(b.num_rows), held.value_lengths().to_numpy())
            marks = [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]
            row, *parse = factors(size, b.column(len(kept) + 1).to_numpy(zero_copy_only=False), row, marks)
            ends = np.searchsorted(row, np.arange(b.num_rows + 1))
            pairs = list(zip(parse[0].tolist(), parse[1].tolist(), strict=True))
            for k, text in enumerate(text_bytes(b.column(len(kept)))):
                words = (text or b"").split()
                gone = united(pairs[ends[k] : ends[k + 1]])
                left = words
                if gone:
                    left, end = [], 0
                    for x, y in gone:
                        left += words[end:x]
                        end = y
                    left += words[end:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                spans.append([{"start": x, "end": y} for x, y in gone])
                if digest:
                    out.append(hashlib.sha256(b" ".join(left)).hexdigest())
                else:
                    out.append(b" ".join(left) if gone else text)
            copied = pa.ListArray.from_arrays(ends.astype(np.int32), pa.StructArray.from_arrays([pa.array(x) for x in parse], fields=whole))
            texts = pa.array(out, pa.string()) if digest else pa.array(out, pa.binary()).cast(pa.string())
            cols = [texts, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(pa.struct(whole[:2]))), copied]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(kept))), *cols], names)

    both = clean.select(*kept, text_, row_, none.alias(marks_)).union(joined.select(*kept, text_, row_, F.coalesce(marks_, none).alias(marks_)))
    return in_workers(both, cut, schema)

"""Byte-pair encoding by a pair occurrence index, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, ragged, slices, tune
from vellum.llm.tokens import BYTE_LEVEL, Words, byte_characters, encoder, model_path

MODEL = "byte_bpe_50k.json"


def library_letters() -> Callable[[str], bool]:
    """Whether the library takes a character for a letter or digit: it then stays with a letter or a digit that follows."""
    from tokenizers.pre_tokenizers import ByteLevel

    cut = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    return lambda c: len(cut(f"{c}a")) == 1 or len(cut(f"{c}1")) == 1


class PairIndex:
    """A byte-level model as arrays: pair to rank, rank to merged id, id to bytes."""

    def __init__(self, path: str) -> None:
        spec = json.load(open(path))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.a = np.array([vocab[x] for x, _ in pairs], np.int64)
        self.b = np.array([vocab[y] for _, y in pairs], np.int64)
        self.merged = np.array([vocab[x + y] for x, y in pairs], np.int64)
        self.wide = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        key = self.a * self.wide + self.b
        self.ranks = np.argsort(key)
        self.sorted = key[self.ranks]
        chars = byte_characters()
        self.of_byte = np.array([vocab[c] for c in chars], np.int64)
        back = {c: b for b, c in enumerate(chars)}
        tokens = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        tokens |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        spelled = [tokens.get(i, b"") for i in range(self.wide)]
        self.size = np.fromiter(map(len, spelled), np.int64, self.wide)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.cutter = Words(BYTE_LEVEL, library_letters())

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        key = a * self.wide + b
        at = np.minimum(np.searchsorted(self.sorted, key), len(self.sorted) - 1)
        return np.where(self.sorted[at] == key, self.ranks[at], -1)

    def merge(self, sym: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge symbols of words laid end to end (``last`` marks where each ends): symbols, and which places stay.

        Every pair that has a rank is listed with all its places. Ranks are
        applied in ascending order, each at all its places at once; a merge has a
        higher rank than those that make its parts, so the pairs that a merge
        makes join lists that are still to come.
        """
        n = len(sym)
        nxt = np.where(last, -1, np.arange(1, n + 1))
        prv = np.arange(-1, n - 1)
        prv[np.flatnonzero(last[:-1]) + 1] = -1
        live = np.ones(n, bool)
        lists: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(rank: np.ndarray, place: np.ndarray) -> None:
            ok = rank >= 0
            rank, place = rank[ok], place[ok]
            if not len(rank):
                return
            order = np.argsort(rank, kind="stable")
            rank, place = rank[order], place[order]
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, p in zip(rank[np.r_[0, cut]].tolist(), np.split(place, cut), strict=True):
                if r in lists:
                    lists[r].append(p)
                else:
                    lists[r] = [p]
                    heapq.heappush(heap, r)

        at = np.flatnonzero(~last)
        note(self.rank(sym[at], sym[at + 1]), at)
        while heap:
            r = heapq.heappop(heap)
            got = lists.pop(r)
            p = np.unique(np.concatenate(got)) if len(got) > 1 else got[0]
            a, b = self.a[r], self.b[r]
            p = p[live[p] & (sym[p] == a) & (nxt[p] >= 0)]
            p = p[sym[nxt[p]] == b]
            if not len(p):
                continue
            if a == b:  # of overlapping places take every other one from the left
                chained = np.r_[False, nxt[p[:-1]] == p[1:]]
                i = np.arange(len(p))
                p = p[(i - np.maximum.accumulate(np.where(chained, 0, i))) % 2 == 0]
            gone = nxt[p]
            after = nxt[gone]
            sym[p] = self.merged[r]
            live[gone] = False
            nxt[p] = after
            has = after >= 0
            prv[after[has]] = p[has]
            before = prv[p]
            left = before[before >= 0]
            right = p[has]
            place = np.r_[left, right]
            if len(place):
                note(self.rank(sym[place], sym[nxt[place]]), place)
        return sym, live

    def words(self, text: str) -> list[str | int]:
        """Pre-tokens; special tokens as ids."""
        if not (self.split and self.split.search(text)):
            return self.cutter.words(text)
        out: list[str | int] = []
        at = 0
        for m in self.split.finditer(text):
            out += self.cutter.words(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.cutter.words(text[at:])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has: one index over the distinct words of all."""
        words = [self.words(t) for t in texts]
        flat = list(chain.from_iterable(words))
        distinct = dict(zip(dict.fromkeys(flat), count()))
        which = np.fromiter(map(distinct.__getitem__, flat), np.int64, len(flat))
        spelled = [w.encode() if isinstance(w, str) else b"" for w in distinct]
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        sym = self.of_byte[np.frombuffer(b"".join(spelled), np.uint8)]
        last = np.zeros(len(sym), bool)
        last[np.cumsum(size)[size > 0] - 1] = True
        sym, live = self.merge(sym, last)
        before = np.r_[0, np.cumsum(live)]
        ends = np.cumsum(size)
        start, n = before[ends - size], before[ends] - before[ends - size]
        ids = sym[live]
        own = np.flatnonzero(size == 0)
        start[own], n[own] = len(ids) + np.arange(len(own)), 1
        ids = np.r_[ids, np.array([w for w in distinct if isinstance(w, int)], np.int64)].astype(np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        return ids[ragged(start[which], n[which])], np.diff(np.r_[0, np.r_[0, np.cumsum(n[which])][ends]])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each of several id sequences laid end to end."""
        size = self.size[ids]
        flat = self.bytes[ragged(self.start[ids], size)].tobytes()
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts)]]
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_MODELS: dict[str, PairIndex] = {}


def model(path: str) -> PairIndex:
    if path not in _MODELS:
        _MODELS[path] = PairIndex(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, digest: bool = False) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids (array<int>) and decoded text.

    Texts are encoded whole, as the tokenizers library does without special
    tokens added; a null text counts as empty and has no ids. Decoding is lossy
    where ids do not make UTF-8, which never happens to ids of a text. With
    ``digest``, ids_sha256 (of 32-bit little-endian ids) and decoded_sha256
    stand for ids and text. Rows are independent: nothing is shuffled. Repeated
    rows are encoded each; other columns are not read.
    """
    tune(docs.sparkSession)
    path = model_path(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, own = encoder(path, "pairs"), model(path)
        for b in batches:
            for i, texts in slices(b.column(1), 4 << 20):
                ids, counts = enc.encode(texts)
                decoded = [x.decode("utf-8", "replace") for x in own.decode(ids, counts)]
                ends = np.r_[0, np.cumsum(counts)].tolist()
                cols: list[pa.Array] = [b.column(0).slice(i, len(texts)), pa.array(counts)]
                if digest:
                    cut = [ids[x:y].astype("<u4").tobytes() for x, y in zip(ends[:-1], ends[1:], strict=True)]
                    cols += [pa.array([hashlib.sha256(x).hexdigest() for x in cut], pa.string()),
                             pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())]
                else:
                    cols += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names)

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    kinds = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_workers(d, run, f"doc_id long, n_tokens long, {kinds}", tokens=True)

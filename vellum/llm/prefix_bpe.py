"""Byte-level BPE by dynamic programming over prefixes: appends and edits re-encode only what they touch.

A sequence of tokens is what BPE gives for their bytes exactly if every two
neighbours stay apart when they are encoded together. So each prefix of a word
has one last token: the token that ends there and stays apart from the last
token of the prefix before it. The table of these tokens is the encoding: ids
are read from its end, a longer word only adds to it, and a changed word keeps
the part before the change.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, ragged, slices, tune
from vellum.llm.tokens import STOP, Encoder, Words, encoder, model_path, odd_texts

MODEL = "byte_bpe_multi_50k.tiktoken"
#: Words of up to so many bytes are done together, step by step; longer ones each by itself.
TOGETHER = 48
NEVER = np.int64(1) << 40


def pattern() -> str:
    """The pattern that cuts a text into words before the merges."""
    import public_tokenizers

    return public_tokenizers.PATTERN


def library_letters() -> Callable[[str], bool]:
    """Whether the library takes a character for a letter or digit."""
    import tiktoken

    alone = tiktoken.Encoding("letters", pat_str=r"[\p{L}\p{N}]", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return lambda c: bool(alone.encode_ordinary(c))


def read_ranks(path: str) -> dict[bytes, int]:
    """Token to rank of a rank file: lines of a base64 token and its number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PrefixModel:
    """Ranks, the tree of merges of each token, and a trie of tokens read from their ends.

    Every single byte has to be a token. Tokens that no merges make (the library
    gives them for a word that is just that token) stay out of the tables.
    """

    def __init__(self, path: str) -> None:
        ranks = read_ranks(path)
        self.wide = max(ranks.values()) + 1
        spelled = [b""] * self.wide
        for token, r in ranks.items():
            spelled[r] = token
        self.spelled = spelled
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError(f"{path}: each single byte has to be a token")
        self.size = np.fromiter(map(len, spelled), np.int64, self.wide)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.cutter = Words(pattern(), library_letters())
        self._pairs(ranks)
        self._trees(ranks)
        self._trie(ranks)
        self.known: dict[int, bool] = {}

    def _pairs(self, ranks: dict[bytes, int]) -> None:
        """All pairs of tokens that make a token, by key."""
        get, first, second, made = ranks.get, [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                x, y = get(token[:i]), get(token[i:])
                if x is not None and y is not None:
                    first.append(x)
                    second.append(y)
                    made.append(r)
        self.first, self.second, self.made = (np.array(v, np.int64) for v in (first, second, made))
        order = np.argsort(self.first * self.wide + self.second)
        self.keys, self.of = (self.first * self.wide + self.second)[order], self.made[order]

    def pair(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of x and y as one token, or NEVER."""
        key = x * self.wide + y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.of[at], NEVER)

    def apart(self, x: np.ndarray, y: np.ndarray, limit: np.ndarray | np.int64 = NEVER) -> np.ndarray:
        """Whether tokens x and y, side by side, are what merges of ranks below ``limit`` leave of their bytes.

        The parts at the seam are followed back in time: of the two the one made
        later is undone. A merge across the seam happens if its rank comes before
        the left part is used up, and not after the right part is (of equal ranks
        the leftmost place goes first).
        """
        x, y = x.copy(), y.copy()
        ends_x = np.broadcast_to(np.asarray(limit), x.shape).copy()
        ends_y = ends_x.copy()
        ok = np.ones(len(x), bool)
        todo = np.arange(len(x))
        while len(todo):
            a, b, ea, eb = x[todo], y[todo], ends_x[todo], ends_y[todo]
            r = self.pair(a, b)
            crossed = (r < ea) & (r <= eb)
            ok[todo[crossed]] = False
            base_a, base_b = self.left[a] < 0, self.left[b] < 0
            back_a = ~base_a & (base_b | (a > b))
            on = ~crossed & ~(base_a & base_b)
            go_a, go_b = on & back_a, on & ~back_a
            ends_x[todo[go_a]], x[todo[go_a]] = a[go_a], self.right[a[go_a]]
            ends_y[todo[go_b]], y[todo[go_b]] = b[go_b], self.left[b[go_b]]
            todo = todo[on]
        return ok

    def _trees(self, ranks: dict[bytes, int]) -> None:
        """The last merge of each token, shorter tokens first."""
        self.left, self.right = np.full(self.wide, -1, np.int64), np.full(self.wide, -1, np.int64)
        ok = self.size == 1
        size = self.size[self.made]
        for n in range(2, int(self.size.max()) + 1):
            some = np.flatnonzero((size == n) & (self.first < self.made) & (self.second < self.made))
            x, y, t = self.first[some], self.second[some], self.made[some]
            some = some[ok[x] & ok[y]]
            x, y, t = self.first[some], self.second[some], self.made[some]
            tree = self.apart(x, y, t)
            self.left[t[tree]], self.right[t[tree]], ok[t[tree]] = x[tree], y[tree], True
        self.whole = {t: r for t, r in ranks.items() if not ok[r]}
        for token in self.whole:
            if len(merged(token, ranks)) == 1:
                raise ValueError(f"rank {ranks[token]}: a token has to rank after the parts that make it")
        self.made_by_merges = ok

    def _trie(self, ranks: dict[bytes, int]) -> None:
        """Tokens by their bytes from the end: keys of (node, byte) and the node and token that they lead to."""
        nodes: dict[int, int] = {}
        token = [-1]
        for t, r in ranks.items():
            if not self.made_by_merges[r]:
                continue
            at = 0
            for b in reversed(t):
                key = at << 8 | b
                if (found := nodes.get(key)) is None:
                    nodes[key] = found = len(token)
                    token.append(-1)
                at = found
            token[at] = r
        self.nodes, self.token = nodes, np.array(token, np.int64)
        self.token_list = token
        keys = np.fromiter(nodes.keys(), np.int64, len(nodes))
        order = np.argsort(keys)
        self.node_keys, self.node_of = keys[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order]

    def stays(self, x: int, y: int) -> bool:
        """``apart`` of one pair, remembered; at most a million pairs are."""
        key = x * self.wide + y
        if (found := self.known.get(key)) is None:
            if len(self.known) >= 1_000_000:
                self.known.clear()
            found = self.known[key] = bool(self.apart(np.array([x]), np.array([y]))[0])
        return found

    def extend(self, word: bytes, table: list[int]) -> list[int]:
        """``table`` (the last token of each prefix of the first bytes of ``word``) carried on to the end of ``word``."""
        nodes, token, size, stays = self.nodes, self.token_list, self.size, self.stays
        for end in range(len(table) + 1, len(word) + 1):
            at, options, start = 0, [], end
            while start and (found := nodes.get(at << 8 | word[start - 1])) is not None:
                at, start = found, start - 1
                if token[at] >= 0:
                    options.append((token[at], start))
            for t, start in reversed(options):
                if start == 0 or stays(table[start - 1], t):
                    table.append(t)
                    break
        return table

    def read(self, table: list[int] | np.ndarray, word: bytes) -> list[int]:
        """The ids that a table of prefixes holds."""
        if self.whole and word in self.whole:
            return [self.whole[word]]
        out, at = [], len(table)
        while at:
            t = int(table[at - 1])
            out.append(t)
            at -= int(self.size[t])
        return out[::-1]

    def tables(self, data: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The last token of each prefix of words laid end to end, for all words at once."""
        n = len(data)
        first = np.repeat(np.cumsum(size) - size, size)
        offset = np.arange(n) - first  # of the byte in its word
        at, node, back = np.arange(n), np.zeros(n, np.int64), 0
        ends, starts, tokens = [], [], []
        while len(at):  # tokens that end at each byte
            key = node << 8 | data[at - back]
            found = np.minimum(np.searchsorted(self.node_keys, key), len(self.node_keys) - 1)
            hit = self.node_keys[found] == key
            at, node = at[hit], self.node_of[found[hit]]
            t = self.token[node]
            is_token = t >= 0
            ends.append(at[is_token])
            starts.append(at[is_token] - back)
            tokens.append(t[is_token])
            back += 1
            more = offset[at] >= back
            at, node = at[more], node[more]
        end, start, token = map(np.concatenate, (ends, starts, tokens))
        order = np.argsort(offset[end], kind="stable")
        end, start, token = end[order], start[order], token[order]
        cuts = np.flatnonzero(np.diff(offset[end])) + 1
        last = np.full(n, -1, np.int64)
        for e, s, t in zip(*(np.split(v, cuts) for v in (end, start, token)), strict=True):  # shorter prefixes first
            inner = offset[s] > 0
            ok = ~inner
            key, which = np.unique(last[s[inner] - 1] * self.wide + t[inner], return_inverse=True)
            ok[inner] = self.apart(key // self.wide, key % self.wide)[which]
            last[e[ok]] = t[ok]
        return last

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of several words end to end, and how many each has."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        short = size <= TOGETHER
        n, parts = np.zeros(len(words), np.int64), []
        some = np.flatnonzero(short)
        if len(some) and size[some].sum():
            data = np.frombuffer(b"".join([words[i] for i in some.tolist()]), np.uint8).astype(np.int64)
            last = self.tables(data, size[some])
            at = np.cumsum(size[some])
            begin, word, step = at - size[some], some, 0
            while len(at):  # read the tables from their ends, one token of each word a step
                on = at > begin
                at, begin, word = at[on], begin[on], word[on]
                t = last[at - 1]
                parts.append((word, np.full(len(t), -step), t))
                at, step = at - self.size[t], step + 1
        for i in np.flatnonzero(~short).tolist():
            t = np.array(self.read(self.extend(words[i], []), words[i]), np.int64)
            parts.append((np.full(len(t), i), np.arange(len(t)), t))
        if not parts:
            return np.zeros(0, np.uint32), n
        word, place, token = map(np.concatenate, zip(*parts, strict=True))
        token = token[np.lexsort((place, word))].astype(np.uint32)
        n += np.bincount(word, minlength=len(words))
        if self.whole and any(w in self.whole for w in words):
            cut = np.split(token, np.cumsum(n)[:-1])
            cut = [np.array([self.whole[w]], np.uint32) if w in self.whole else c for w, c in zip(words, cut, strict=True)]
            return np.concatenate(cut), np.fromiter(map(len, cut), np.int64, len(cut))
        return token, n

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has; each distinct word is encoded once."""
        words = [self.cutter.words(t) for t in texts]
        flat = list(chain.from_iterable(words))
        distinct = dict(zip(dict.fromkeys(flat), count()))
        which = np.fromiter(map(distinct.__getitem__, flat), np.int64, len(flat))
        ids, n = self.ids([w.encode() for w in distinct])
        start = np.cumsum(n) - n
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        return ids[ragged(start[which], n[which])], np.diff(np.r_[0, np.r_[0, np.cumsum(n[which])][ends]])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each of several id sequences laid end to end."""
        size = self.size[ids]
        flat = self.bytes[ragged(self.start[ids], size)].tobytes()
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts)]]
        return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def merged(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts that merges by rank leave of one word."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        r, i = min((ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
        if r == NEVER:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class PrefixText:
    """One text with the table of prefixes of each of its words; ``replace`` encodes anew only near the change."""

    def __init__(self, model: PrefixModel, text: str = "") -> None:
        self.model, self.text = model, ""
        self.starts: list[int] = []
        self.words: list[bytes] = []
        self.tables: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> int:
        """``new`` in place of the characters from ``start`` to ``stop``; how many bytes got a new table entry.

        A word was cut by looking at its own characters, two more, and at three
        from its start at most. Words for which all of these lie before the change
        stay; from where a word starts behind the change at an old start, all do.
        """
        text, old = self.text[:start] + new + self.text[stop:], len(self.text)
        ends = [*self.starts[1:], old] if self.starts else []
        keep = bisect_left(range(len(ends)), True, key=lambda k: max(ends[k] + 2, self.starts[k] + 3) > start)
        moved = len(new) - (stop - start)
        at = ends[keep - 1] if keep else 0
        starts, words, tables, done = [], [], [], 0
        tail = len(self.starts)
        for here, spelled in self.model.cutter.cut(text, at):
            if here >= start + len(new):
                k = bisect_left(self.starts, here - moved)
                if k < len(self.starts) and self.starts[k] == here - moved:
                    tail = k
                    break
            word, k = spelled.encode(), keep + len(starts)
            same = 0
            if k < len(self.words):
                was = self.words[k]
                most = min(len(was), len(word))
                while same < most and was[same] == word[same]:
                    same += 1
            table = self.tables[k][:same] if same else []
            done += len(word) - same
            starts.append(here)
            words.append(word)
            tables.append(self.model.extend(word, table))
        self.starts[keep:] = starts + [s + moved for s in self.starts[tail:]]
        self.words[keep:] = words + self.words[tail:]
        self.tables[keep:] = tables + self.tables[tail:]
        self.text = text
        return done

    def ids(self) -> list[int]:
        return list(chain.from_iterable(map(self.model.read, self.tables, self.words)))


class RankEncoder(Encoder):
    """Texts by units, each encoded once, with tables of prefixes."""

    def __init__(self, path: str) -> None:
        self.special, self.kind, self.odd, self.stop = [], "byte", odd_texts([]), STOP
        self.encode_whole = model(path).encode
        self.forget()


_MODELS: dict[str, PrefixModel] = {}


def model(path: str) -> PrefixModel:
    if path not in _MODELS:
        _MODELS[path] = PrefixModel(path)
    return _MODELS[path]


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = MODEL, digest: bool = False) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids (array<int>) and decoded (binary).

    Texts of any length are encoded whole, as the tiktoken library does without
    special tokens; a null text counts as empty, and an empty one has no ids. With
    ``digest``, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the decoded bytes) stand for ids and bytes. Rows are
    independent: nothing is shuffled, repeated rows and ids are a row each, no rows
    give none, and other columns are not read.
    """
    tune(docs.sparkSession)
    path = model_path(name)
    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, own = encoder(path, "prefixes"), model(path)
        digits = np.array([str(i) for i in range(own.wide)], object)
        for b in batches:
            for i, texts in slices(b.column(1)):
                ids, counts = enc.encode(texts)
                decoded = own.decode(ids, counts)
                ends = np.r_[0, np.cumsum(counts)].tolist()
                cols: list[pa.Array] = [b.column(0).slice(i, len(texts)), pa.array(counts)]
                if digest:
                    spelled = digits[ids].tolist()
                    cols += [pa.array([hashlib.sha256(",".join(spelled[x:y]).encode()).hexdigest() for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.string()),
                             pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())]
                else:
                    cols += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names)

    kinds = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded binary"
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return in_workers(d, run, f"doc_id long, n_tokens long, {kinds}", tokens=True)


def revise(docs: DataFrame, edits_col: str = "edits", id_col: str = "doc_id", text_col: str = "text", name: str = MODEL) -> DataFrame:
    """Documents after their edits: doc_id, text, n_tokens, ids, n_bytes_encoded.

    ``edits`` is an array of (start, stop, text): characters from start to stop
    give way to text, one edit after the other; places beyond the end count as the
    end, an append is an edit there, a null text is empty, null edits are none.
    Ids are those of the whole new text; the last column counts the bytes for
    which edits needed new table entries.
    """
    tune(docs.sparkSession)
    path = model_path(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for b in batches:
            for doc, text, edits in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held, done = PrefixText(own, text or ""), 0
                for e in edits or []:
                    n = len(held.text)
                    start = min(max(e["start"] or 0, 0), n)
                    done += held.replace(start, min(max(e["stop"] or 0, start), n), e["text"] or "")
                ids = held.ids()
                yield pa.RecordBatch.from_arrays([pa.array([doc], pa.int64()), pa.array([held.text], pa.string()), pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int32())), pa.array([done], pa.int64())],
                                                 ["doc_id", "text", "n_tokens", "ids", "n_bytes_encoded"])

    edit = "array<struct<start: long, stop: long, text: string>>"
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).cast(edit).alias("edits"))
    return in_workers(d, run, "doc_id long, text string, n_tokens long, ids array<int>, n_bytes_encoded long")

"""Encoding texts by units: pieces that a tokenizer cuts apart anyway, encoded once each."""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from vellum.llm.common import ragged

#: Units that a worker remembers; beyond that it keeps those that came again, so its memory is bounded.
CACHE = 560_000
#: The ByteLevel pre-tokenizer's pattern; a fixed value of the public format.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space but for the blank and the line end.
ODD_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")
#: A full stop or comma that ends a word: models cut before it.
STOP = r"([\pL\pN])([.,])( |$)"
#: Marks of a unit that is such a stop, and of a text's first unit, which has no blank before it.
STOPPED, FIRST = "\x01", "\x02"


def model_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps ``name``; a path stays as it is."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def odd_texts(special: list[str]) -> str:
    """Pattern of texts that a byte model may not cut at every blank and line end, or that hold a special token."""
    return "|".join(["  ", r"\n\n", r" \n", r"\n ", r"[ \n]$", f"[{ODD_SPACE}{STOPPED}{FIRST}]", *(re.sub(r"(\W)", r"\\\1", x) for x in special)])


def word_stop(path: str) -> str:
    """Pattern of a stop after a letter or digit that the model's normalizer leaves one at its end.

    Some letters end in a mark once they are composed and in lower case; the model
    then takes mark and stop together.
    """
    from tokenizers import Tokenizer

    normal = Tokenizer.from_file(path).normalizer.normalize_str
    letters = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LN"]
    marked = "".join(c for c in letters if (n := normal(c)) != c and not (n and unicodedata.category(n[-1])[0] in "LN"))
    return rf"([^\PL{marked}]|[^\PN{marked}])([.,])([ \n]|$)"


class Words:
    """Cuts texts into words by a pattern, with the letters and digits of the library that ``knows`` them.

    The ``regex`` module may follow a later edition of Unicode than a tokenizer
    does. Characters that are letters or digits to the module only are looked at
    as signs: for the pattern a private character stands for each.
    """

    def __init__(self, pattern: str, knows: Callable[[str], bool]) -> None:
        self.pattern = regex.compile(pattern)
        every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
        doubtful = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c)[0] not in "LN"]
        self.signs = {ord(c): "\ue000" for c in doubtful if not knows(c)}
        self.young = frozenset(map(chr, self.signs))

    def cut(self, text: str, at: int = 0) -> Iterator[tuple[int, str]]:
        """The words from place ``at`` on, and where they start."""
        seen = text if text.isascii() or self.young.isdisjoint(text) else text.translate(self.signs)
        for m in self.pattern.finditer(seen, at):
            yield m.start(), text[m.start() : m.end()]

    def words(self, text: str) -> list[str]:
        if text.isascii() or self.young.isdisjoint(text):
            return self.pattern.findall(text)
        return [w for _, w in self.cut(text)]


class Encoder:
    """Ids of many texts at once.

    ``byte`` models (ByteLevel with its own pattern, no normalizer) always cut
    before a space or line end that follows something else and between a word and
    its full stop or comma, so texts are taken apart there; ``word`` models drop
    white space, so texts are taken apart at ASCII white space too, and before the
    stop of a word whose last letter is still a letter once it is normalized. Texts for
    which that is not certain (runs of white space, special tokens) and all texts
    of other models are encoded whole. The result is what the model gives for the
    whole text.
    """

    def __init__(self, path: str, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]] | None = None) -> None:
        spec = json.load(open(path))
        self.special = [t["content"] for t in spec["added_tokens"]]
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        self.kind = "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
            self.kind = "byte"
        elif pre.get("type") == "Sequence" and [p["type"] for p in pre["pretokenizers"]] == ["Split", "ByteLevel"]:
            first, parts = pre["pretokenizers"][0], (norm or {}).get("normalizers", [])
            if first["behavior"] == "Removed" and first["invert"] and r"[^\s" in first["pattern"].get("Regex", "") and {p["type"] for p in parts} <= {"NFC", "Replace", "Lowercase"}:
                self.kind = "word"
        self.odd = odd_texts(self.special)
        self.stop = word_stop(path) if self.kind == "word" else STOP
        self.encode_whole = encode or self.by_library(path)
        self.forget()

    def by_library(self, path: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
        """Encode texts with the tokenizers library."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        one, space, chars = model.model.tokenize, "\u0120", dict(enumerate(byte_characters()))
        line = model.token_to_id(chars[10])
        byte, word = self.kind == "byte" and line is not None, self.kind == "word"

        def spelled(t: str) -> str:
            return t if t.isascii() else t.encode().decode("latin-1").translate(chars)

        def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            parts: list[list[int] | None] = [None] * len(texts)
            other = []
            gc.disable()  # many small lists, none of them in a cycle
            # A word of letters is one pre-token: the library's model takes it as it is. Letters up
            # to U+00FF are composed, and have one lower case.
            for i, t in enumerate(texts):
                if byte and (w := t[1:]).isalpha() and t[0] in " \n":
                    ids = [x.id for x in one(space + spelled(w) if t[0] == " " else spelled(w))]
                    parts[i] = ids if t[0] == " " else [line, *ids]
                elif word and t.isalpha() and (t.isascii() or max(t) <= "\xff"):
                    parts[i] = [x.id for x in one(spelled(t.lower()))]
                else:
                    other.append(i)
            for k in range(0, len(other), 10_000):
                some = other[k : k + 10_000]
                for i, e in zip(some, model.encode_batch_fast([texts[i] for i in some], add_special_tokens=False), strict=True):
                    parts[i] = e.ids
            gc.enable()
            n = np.fromiter(map(len, parts), np.int64, len(parts))
            return np.fromiter(chain.from_iterable(parts), np.uint32, int(n.sum())), n

        return encode

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.pool, self.start, self.size, self.again = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def units(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of texts that can be taken apart, end to end, and how many each text has."""
        if self.kind == "word":
            lists = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, self.stop, r"\1 \2\3"))
        else:
            cut = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " \n"), self.stop, rf"\1 {STOPPED}\2\3")
            lists = pc.split_pattern(pc.binary_join_element_wise(FIRST, cut, ""), " ")
        return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)

    def spelled(self, unit: str) -> str:
        if self.kind == "word":
            return unit
        return unit[1:] if unit[:1] in (STOPPED, FIRST) else unit if unit[:1] == "\n" else " " + unit

    def places(self, distinct: list[str]) -> np.ndarray:
        """Where each of several units is remembered; those that are new are encoded first."""
        at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        self.again[at[at >= 0]] = True
        new = np.flatnonzero(at < 0)
        if len(new):
            if len(self.index) + len(new) > CACHE and len(self.index):
                self.keep(self.again)
                at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
                new = np.flatnonzero(at < 0)
            units = [distinct[i] for i in new.tolist()]
            ids, n = self.encode_whole([self.spelled(x) for x in units])
            first = len(self.index)
            self.index.update(zip(units, range(first, first + len(units)), strict=True))
            self.start = np.r_[self.start, len(self.pool) + np.cumsum(n) - n]
            self.size, self.pool = np.r_[self.size, n], np.r_[self.pool, ids]
            self.again = np.r_[self.again, np.zeros(len(n), bool)]
            at[new] = first + np.arange(len(new))
        return at

    def keep(self, some: np.ndarray) -> None:
        """Remember only ``some`` units, none if they are too many still."""
        if 2 * some.sum() > CACHE:
            self.forget()
            return
        self.index = {u: k for k, u in enumerate(u for u, on in zip(self.index, some.tolist(), strict=True) if on)}
        self.pool = self.pool[ragged(self.start[some], self.size[some])]
        self.size = self.size[some]
        self.start, self.again = np.cumsum(self.size) - self.size, np.zeros(len(self.size), bool)

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has. Null counts as empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        counts = np.zeros(len(texts), np.int64)
        if self.kind == "whole":
            whole = np.ones(len(texts), bool)
        elif self.kind == "word":
            whole = np.zeros(len(texts), bool)
        else:
            whole = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        kinds = []
        for on, apart in ((~whole, True), (whole, False)):
            where = np.flatnonzero(on)
            if not len(where):
                continue
            some = texts if len(where) == len(texts) else texts.take(pa.array(where))
            if apart:
                flat, n = self.units(some)
                coded = flat.dictionary_encode()
                at = self.places(coded.dictionary.to_pylist())
                known = pa.ListArray.from_arrays(np.r_[0, np.cumsum(self.size[at])].astype(np.int32), self.pool[ragged(self.start[at], self.size[at])])
                met = known.take(coded.indices)
                ids = met.flatten().to_numpy()
                n = np.diff(met.offsets.to_numpy()[np.r_[0, np.cumsum(n)]]).astype(np.int64)
            else:
                ids, n = self.encode_whole(some.to_pylist())
            counts[where] = n
            kinds.append((where, ids, n))
        if len(kinds) < 2:
            return (kinds[0][1] if kinds else np.zeros(0, np.uint32)), counts
        out, first = np.zeros(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        for where, ids, n in kinds:
            out[ragged(first[where], n)] = ids
        return out, counts


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, engine: str = "library") -> Encoder:
    """One encoder a worker and model; ``engine`` is ``library``, ``pairs`` or ``prefixes`` (this package's own merges, its table of prefixes)."""
    if (path, engine) not in _ENCODERS and engine == "prefixes":
        from vellum.llm.prefix_bpe import RankEncoder

        _ENCODERS[path, engine] = RankEncoder(path)
    if (path, engine) not in _ENCODERS:
        encode = None
        if engine == "pairs":
            from vellum.llm.bpe import PairIndex

            encode = PairIndex(path).encode
        _ENCODERS[path, engine] = Encoder(path, encode)
    return _ENCODERS[path, engine]


def forget_all() -> None:
    """Drop the words that this worker's encoders remember."""
    for e in _ENCODERS.values():
        e.forget()

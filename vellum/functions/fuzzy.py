"""Fuzzy string scores, 0 to 100, from the longest common subsequence (Indel similarity).

The scores follow the public definitions of token-sort, token-set and weighted
ratios. The common subsequence is computed bit-parallel: on Python integers for
one pair, on arrays of 64-bit words for a column of pairs. The Arrow functions
score a batch as columns, each distinct pair once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & where.get(c, 0)
        free = (free + hit | free - hit) & full
    return len(a) - free.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * common / (length + length); two empty strings are alike."""
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * common(a, b) / total


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    """Compares what two sets of words share with each set, and their differences."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 100.0
    shared = " ".join(both)
    rest_x, rest_y = " ".join(only_x), " ".join(only_y)
    best = ratio(rest_x, rest_y)
    if both:
        whole_x, whole_y = f"{shared} {rest_x}", f"{shared} {rest_y}"
        n = len(shared)
        best = max(best, ratio(whole_x, whole_y), 200.0 * n / (n + len(whole_x)), 200.0 * n / (n + len(whole_y)))
    return best


def partial(a: str, b: str) -> float:
    """The best ratio of the shorter string against stretches of the longer of its length, and its shorter ends."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 100.0 if not t else 0.0
    n = len(s)
    letters = set(s)
    best = 0.0
    for i in range(1 - n, len(t)):
        piece = t[max(0, i) : i + n]
        # a best stretch ends, or at the end of the text starts, with a letter of the shorter string
        if (piece[-1] if i + n <= len(t) else piece[0]) in letters:
            best = max(best, ratio(s, piece))
            if best == 100.0:
                break
    return best


def partial_tokens(a: str, b: str) -> float:
    if set(a.split()) & set(b.split()):
        return 100.0
    return max(partial(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial(" ".join(sorted(set(a.split()))), " ".join(sorted(set(b.split())))))


def weighted(a: str, b: str) -> float:
    """The plain ratio, or a token or partial ratio at a discount that grows with the difference in length."""
    if not a or not b:
        return 0.0
    span = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if span < 1.5:
        return max(best, 0.95 * max(token_sort(a, b), token_set(a, b)))
    scale = 0.9 if span <= 8 else 0.6
    return max(best, scale * partial(a, b), 0.95 * scale * partial_tokens(a, b))


def title_score(a: str, b: str) -> float:
    """Token-sort ratio; 18 less where one title is much shorter; 0 where one is empty."""
    if not a or not b:
        return 0.0
    short, long = sorted((len(a), len(b)))
    return token_sort(a, b) - (18.0 if short / long < 0.55 else 0.0)


#: Letters of patterns that one table of a batch holds, in words of 64 bits.
TABLE = 1 << 22


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of texts end to end, and their lengths."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.fromiter(map(len, texts), np.int64, len(texts))


def _distinct(texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    at: dict[str, int] = {}
    which = np.fromiter((at.setdefault(t, len(at)) for t in texts), np.int64, len(texts))
    return list(at), which


def common_of(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """``common`` of each pair, all pairs of a column step by step: a step takes one letter of one side of every pair."""
    out = np.zeros(len(a), np.int64)
    if not len(a):
        return out
    (ta, ia), (tb, ib) = _distinct(a), _distinct(b)
    (fa, la), (fb, lb) = _codes(ta), _codes(tb)
    alphabet = np.unique(np.r_[fa, fb])
    texts = [(np.searchsorted(alphabet, f), n, np.cumsum(n) - n) for f, n in ((fa, la), (fb, lb))]
    na, nb = la[ia], lb[ib]
    # The longer side is the pattern if it fits a word (fewer steps), else the shorter; two long sides are done one by one.
    swap = np.where(np.maximum(na, nb) <= 64, nb > na, nb < na)
    slow = np.minimum(na, nb) > 64
    for k in np.flatnonzero(slow).tolist():
        out[k] = common(a[k], b[k])
    rows = max(1, TABLE // max(1, len(alphabet)))
    for side in (0, 1):
        pairs = np.flatnonzero((swap == side) & ~slow & (na > 0) & (nb > 0))
        pattern, text = (ia, ib) if side == 0 else (ib, ia)
        codes, size, start = texts[side]
        other, steps, begin = texts[1 - side]
        pairs = pairs[np.argsort(pattern[pairs], kind="stable")]
        used, place = np.unique(pattern[pairs], return_inverse=True)
        for first in range(0, len(used), rows):
            some = used[first : first + rows]
            here = (place >= first) & (place < first + rows)
            table = np.zeros((len(some), len(alphabet)), np.uint64)
            for bit in range(int(size[some].max())):
                has = np.flatnonzero(size[some] > bit)
                table[has, codes[start[some[has]] + bit]] |= np.uint64(1) << np.uint64(bit)
            some_pairs, row = pairs[here], place[here] - first
            order = np.argsort(-steps[text[some_pairs]], kind="stable")
            some_pairs, row = some_pairs[order], row[order]
            long, at = steps[text[some_pairs]], begin[text[some_pairs]]
            free = np.full(len(some_pairs), ~np.uint64(0))
            on = len(some_pairs)
            for j in range(int(long[0]) if on else 0):
                while on and long[on - 1] <= j:
                    on = int(np.searchsorted(-long, -j, side="left"))
                hit = free[:on] & table[row[:on], other[at[:on] + j]]
                free[:on] = (free[:on] + hit) | (free[:on] - hit)
            n = size[pattern[some_pairs]].astype(np.uint64)
            full = np.where(n == 64, ~np.uint64(0), (np.uint64(1) << (n % np.uint64(64))) - np.uint64(1))
            out[some_pairs] = np.bitwise_count(~free & full)
    return out


def ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    total = np.fromiter(map(len, a), float, len(a)) + np.fromiter(map(len, b), float, len(b))
    return np.where(total > 0, 200.0 * common_of(a, b) / np.maximum(total, 1), 100.0)


def _each(f: Callable[[str], object], texts: Sequence[str]) -> list:
    """``f`` of each text, made once for equal ones."""
    distinct, which = _distinct(texts)
    made = list(map(f, distinct))
    return [made[i] for i in which.tolist()]


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sorts(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    return ratios(_each(_sorted, a), _each(_sorted, b))


def token_sets(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(a))
    where, parts = [], [[], [], [], []]
    words = lambda t: frozenset(t.split())
    for k, (x, y) in enumerate(zip(_each(words, a), _each(words, b), strict=True)):
        if not x or not y:
            continue
        both, only_x, only_y = x & y, x - y, y - x
        if both and (not only_x or not only_y):
            out[k] = 100.0
            continue
        where.append(k)
        rest_x, rest_y = " ".join(sorted(only_x)), " ".join(sorted(only_y))
        shared = " ".join(sorted(both))
        for part, text in zip(parts, (rest_x, rest_y, f"{shared} {rest_x}" if both else "", f"{shared} {rest_y}" if both else ""), strict=True):
            part.append(text)
        if both:
            n = len(shared)
            out[k] = max(200.0 * n / (n + len(parts[2][-1])), 200.0 * n / (n + len(parts[3][-1])))
    if where:
        at, shares = np.array(where), np.fromiter(map(bool, parts[2]), bool, len(where))
        out[at] = np.maximum(out[at], ratios(parts[0], parts[1]))
        held = np.flatnonzero(shares).tolist()
        out[at[held]] = np.maximum(out[at[held]], ratios([parts[2][i] for i in held], [parts[3][i] for i in held]))
    return out


def _most_partial(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """No less than ``partials``: a stretch has no longer common subsequence than the whole."""
    n = np.minimum(np.fromiter(map(len, a), float, len(a)), np.fromiter(map(len, b), float, len(b)))
    x = common_of(a, b)
    return np.where(n > 0, 200.0 * x / np.maximum(n + x, 1), 100.0)


def partials(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """``partial`` of each pair: the stretches of all pairs are scored together."""
    out = np.zeros(len(a))
    short: list[str] = []
    pieces: list[str] = []
    of: list[int] = []

    def flush() -> None:
        if of:
            np.maximum.at(out, np.array(of), ratios(short, pieces))
            for held in (short, pieces, of):
                held.clear()

    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        s, t = (p, q) if len(p) <= len(q) else (q, p)
        n, letters = len(s), set(s)
        if not n or s in t:
            out[k] = 100.0 if n or not t else 0.0
            continue
        for i in range(1 - n, len(t)):
            if (t[i + n - 1] if i + n <= len(t) else t[max(0, i)]) in letters:
                short.append(s)
                pieces.append(t[max(0, i) : i + n])
                of.append(k)
        if len(of) > 50_000:
            flush()
    flush()
    return out


def weighteds(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(a))
    on = [k for k in range(len(a)) if a[k] and b[k]]
    x, y = [a[k] for k in on], [b[k] for k in on]
    best = ratios(x, y)
    span = np.array([max(len(p), len(q)) / min(len(p), len(q)) for p, q in zip(x, y, strict=True)])
    scale = np.where(span <= 8, 0.9, 0.6)

    def raise_to(some: np.ndarray, score: Callable, discount: np.ndarray | float, p: list[str], q: list[str]) -> None:
        best[some] = np.maximum(best[some], discount * score([p[k] for k in some], [q[k] for k in some]))

    near, far = np.flatnonzero(span < 1.5), np.flatnonzero(span >= 1.5)
    raise_to(near, token_sorts, 0.95, x, y)
    raise_to(near, token_sets, 0.95, x, y)
    met = np.array([bool(set(x[k].split()) & set(y[k].split())) for k in far.tolist()], bool)
    best[far[met]] = np.maximum(best[far[met]], 0.95 * scale[far[met]] * 100.0)
    # The dear part, where it can still count: in order, then with the words sorted, with repeats and without.
    once = lambda t: " ".join(sorted(set(t.split())))
    for some, p, q, discount in ((far, x, y, 1.0), (far[~met], _each(_sorted, x), _each(_sorted, y), 0.95), (far[~met], _each(once, x), _each(once, y), 0.95)):
        open_ = some[discount * scale[some] * _most_partial([p[k] for k in some], [q[k] for k in some]) > best[some]]
        raise_to(open_, partials, discount * scale[open_], p, q)
    out[on] = best
    return out


def title_scores(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    out = token_sorts(a, b)
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        if not p or not q:
            out[k] = 0.0
        elif min(len(p), len(q)) / max(len(p), len(q)) < 0.55:
            out[k] -= 18.0
    return out


COLUMNS = {"ratio": ratios, "token_sort": token_sorts, "token_set": token_sets, "weighted": weighteds, "title": title_scores}


def _scorer(name):
    @F.pandas_udf(T.DoubleType())
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.full(len(a), np.nan)
        at: dict[tuple[str, str], int] = {}
        known = [(k, at.setdefault((x, y), len(at))) for k, (x, y) in enumerate(zip(a, b, strict=True)) if x is not None and y is not None]
        if known:
            scores = COLUMNS[name]([x for x, _ in at], [y for _, y in at])
            rows, which = np.array(known).T
            out[rows] = scores[which]
        return pd.Series(out, dtype="float64").astype(object).where(~np.isnan(out), None)

    return apply


SCORERS = {"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "weighted": weighted, "title": title_score}
ratio_udf, token_sort_udf, token_set_udf, weighted_udf, title_score_udf = map(_scorer, ("ratio", "token_sort", "token_set", "weighted", "title"))
UDFS = {"ratio": ratio_udf, "token_sort": token_sort_udf, "token_set": token_set_udf, "weighted": weighted_udf, "title": title_score_udf}


def register(spark) -> None:
    """Make the scorers SQL functions: ``fuzzy_ratio`` and so on."""
    for name, f in UDFS.items():
        spark.udf.register(f"fuzzy_{name}", f)

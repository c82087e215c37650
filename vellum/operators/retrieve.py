"""The best options of each query by fuzzy score, found through an index of letters, pairs of letters and words.

Two rounds. In the first, options that share a word with a query, a few for each
word, are scored; the last of the ``limit`` best is a score that the result has to
reach. In the second, distinct query texts meet blocks of distinct option texts.
A block holds its options as postings; what query and option share there bounds
the score of the pair from above, and only pairs whose bound reaches the score
held are scored, best bounds first, which raises the score held. The result is
that of scoring every pair.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import fuzzy
from vellum.scratch import free, stage

#: Distinct texts in a block: bounds of one block of queries and one of options are held at once.
QUERY_ROWS, OPTION_ROWS = 256, 2048
EDGE = 1e-9


class Texts:
    """What bounds need of several texts: lengths, words, letters and pairs of neighbouring letters within words, counted."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        words = [t.split() for t in texts]
        self.sets = [set(w) for w in words]
        join = lambda w: len(" ".join(w))
        self.raw = np.array([len(t) for t in texts], float)
        self.sorted = np.array([join(w) for w in words], float)
        self.once = np.array([join(s) for s in self.sets], float)
        self.n_words = np.array([len(w) for w in words], float)
        self.n_once = np.array([len(s) for s in self.sets], float)
        self.letters = [Counter(t) for t in texts]
        self.inner = [Counter("".join(w)) for w in words]  # without white space
        self.pairs = [Counter(p for x in w for p in zip(x, x[1:], strict=False)) for w in words]
        self.n_pairs = np.array([sum(c.values()) for c in self.pairs], float)
        self.n_pairs_once = np.array([sum(max(0, len(x) - 1) for x in s) for s in self.sets], float)


def shared(queries: list[Counter], options: list[Counter]) -> np.ndarray:
    """For each query and option the size of what two multisets share: the k-th of a kind is a posting of its own."""
    at: dict[tuple, int] = {}
    for c in queries:
        for kind, n in c.items():
            for k in range(n):
                at.setdefault((kind, k), len(at))
    if not at:
        return np.zeros((len(queries), len(options)), np.float32)
    sides = []
    for counters in (queries, options):
        m = np.zeros((len(counters), len(at)), np.float32)
        where = [(i, j) for i, c in enumerate(counters) for kind, n in c.items() for k in range(n) if (j := at.get((kind, k))) is not None]
        if where:
            m[tuple(np.array(where).T)] = 1
        sides.append(m)
    return sides[0] @ sides[1].T


class Bounds:
    """Upper bounds of scores between all of some queries and all of some options."""

    def __init__(self, q: Texts, o: Texts) -> None:
        self.q, self.o = q, o
        self.letters, self.inner, self.pairs = shared(q.letters, o.letters), shared(q.inner, o.inner), shared(q.pairs, o.pairs)
        one = lambda sets: [Counter(dict.fromkeys(s, 1)) for s in sets]
        self.words = shared(one(q.sets), one(o.sets))
        sized = lambda sets: [Counter({w: len(w) for w in s}) for s in sets]
        self.word_letters = shared(sized(q.sets), sized(o.sets))

    def common(self, kind: str, letters: np.ndarray, pairs: str = "n_pairs") -> np.ndarray:
        """No less than the common subsequence: of n letters d are deleted and e inserted; each breaks two pairs, or one."""
        a, b = getattr(self.q, kind)[:, None], getattr(self.o, kind)[None, :]
        pa, pb = getattr(self.q, pairs)[:, None], getattr(self.o, pairs)[None, :]
        most = np.minimum(np.minimum(letters, np.minimum(a, b)), np.floor((self.pairs + 2 * a + b - pa) / 3 + EDGE))
        return np.minimum(most, np.floor((self.pairs + 2 * b + a - pb) / 3 + EDGE))

    def of(self, kind: str, common: np.ndarray) -> np.ndarray:
        total = getattr(self.q, kind)[:, None] + getattr(self.o, kind)[None, :]
        return np.where(total > 0, 200 * common / np.maximum(total, 1), 100.0)

    def ratio(self) -> np.ndarray:
        return self.of("raw", self.common("raw", self.letters))

    def blanks(self, kind: str) -> np.ndarray:
        return np.maximum(0, np.minimum(getattr(self.q, kind)[:, None], getattr(self.o, kind)[None, :]) - 1)

    def token_sort(self) -> np.ndarray:
        return self.of("sorted", self.common("sorted", self.inner + self.blanks("n_words")))

    def title(self) -> np.ndarray:
        a, b = self.q.raw[:, None], self.o.raw[None, :]
        short, long = np.minimum(a, b), np.maximum(a, b)
        return np.where(short > 0, self.token_sort() - np.where(short / np.maximum(long, 1) < 0.55, 18.0, 0.0), 0.0)

    def token_set(self) -> np.ndarray:
        a, b = self.q.once[:, None], self.o.once[None, :]
        na, nb = self.q.n_once[:, None], self.o.n_once[None, :]
        whole = self.of("once", self.common("once", self.inner + self.blanks("n_once"), "n_pairs_once"))
        n = self.word_letters + np.maximum(0, self.words - 1)  # the shared words, joined
        rest_a, rest_b = a - n - (self.words > 0), b - n - (self.words > 0)
        left = np.minimum(np.minimum(rest_a, rest_b), self.inner - self.word_letters + np.maximum(0, np.minimum(na, nb) - self.words - 1))
        rest = np.where(rest_a + rest_b > 0, 200 * np.maximum(0, left) / np.maximum(rest_a + rest_b, 1), 100.0)
        part = np.maximum(200 * n / np.maximum(n + a, 1), 200 * n / np.maximum(n + b, 1))
        within = (self.words > 0) & ((self.words == na) | (self.words == nb))
        best = np.where(self.words > 0, np.maximum(np.maximum(whole, rest), part), whole)
        return np.where((na == 0) | (nb == 0), 0.0, np.where(within, 100.0, best))

    def weighted(self) -> np.ndarray:
        a, b = self.q.raw[:, None], self.o.raw[None, :]
        short, long = np.minimum(a, b), np.maximum(a, b)
        near = long < 1.5 * short
        x = np.minimum(short, self.letters)
        part = np.where(short > 0, 200 * x / np.maximum(short + x, 1), 100.0)
        # sorted words: a stretch of the longer has the letters of both at most, with blanks
        inner = self.inner + self.blanks("n_words")
        sides = []
        for kind in ("sorted", "once"):
            n = np.minimum(getattr(self.q, kind)[:, None], getattr(self.o, kind)[None, :])
            y = np.minimum(n, inner)
            sides.append(np.where(n > 0, 200 * y / np.maximum(n + y, 1), 100.0))
        words = np.where(self.words > 0, 100.0, np.maximum(*sides))
        scale = np.where(long <= 8 * short, 0.9, 0.6)
        far = np.maximum(scale * part, 0.95 * scale * words)
        both = np.maximum(self.ratio(), np.where(near, 0.95 * np.maximum(self.token_sort(), self.token_set()), far))
        return np.where(short > 0, both, 0.0)


def best_of_block(queries: pd.DataFrame, options: pd.DataFrame, scorer: str, cutoff: float, limit: int) -> tuple[pd.DataFrame, int]:
    """The ``limit`` best of ``options`` (choice, ord) for each of ``queries`` (text, held, held_ord), and how many pairs were scored.

    Only options that come before what a query holds count; ``held`` may be null.
    """
    options = options.sort_values("ord", kind="stable").reset_index(drop=True)
    ords = options["ord"].to_numpy()
    texts, names = queries["text"].tolist(), options["choice"].tolist()
    bound = getattr(Bounds(Texts(texts), Texts(names)), scorer)().astype(float)
    held = queries["held"].fillna(cutoff).to_numpy(float)
    last = queries["held_ord"].fillna(np.iinfo(np.int64).max).to_numpy()
    order = np.argsort(-bound, axis=1, kind="stable")  # best bounds first, of equal ones the first option
    found: list[list[tuple[float, int, int]]] = [[] for _ in texts]  # (-score, ord, option)
    at, step, scored = np.zeros(len(texts), np.int64), 2 * limit, 0
    live = list(range(len(texts)))
    while live:
        asked_q, asked_o, more = [], [], []
        for i in live:
            picks = order[i, at[i] : at[i] + step]
            at[i] += len(picks)
            reach = bound[i, picks] >= held[i] - EDGE
            useful = picks[reach & ((bound[i, picks] > held[i] + EDGE) | (ords[picks] <= last[i]))]
            asked_q += [i] * len(useful)
            asked_o += useful.tolist()
            if reach.all() and at[i] < len(names):
                more.append(i)
        if asked_q:
            scores = fuzzy.COLUMNS[scorer]([texts[i] for i in asked_q], [names[j] for j in asked_o])
            scored += len(asked_q)
            for i, j, s in zip(asked_q, asked_o, scores.tolist(), strict=True):
                if s >= cutoff:
                    found[i].append((-s, int(ords[j]), j))
            for i in dict.fromkeys(asked_q):
                found[i] = sorted(found[i])[:limit]
                if len(found[i]) == limit and (found[i][-1][0], found[i][-1][1]) < (-held[i], last[i]):
                    held[i], last[i] = -found[i][-1][0], found[i][-1][1]
        live, step = more, step * 2
    return frame([(texts[i], names[j], o, -s) for i, some in enumerate(found) for s, o, j in some]), scored


def frame(rows: list[tuple]) -> pd.DataFrame:
    kinds = {"text": object, "choice": object, "first_ord": "int64", "score": "float64"}
    cols = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pd.DataFrame({n: pd.Series(list(c), dtype=k) for (n, k), c in zip(kinds.items(), cols, strict=True)})


def ranked(rows: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` best rows of each text; each task keeps no more before rows are shuffled."""
    w = Window.partitionBy("text").orderBy(F.desc("score"), "choice_ord")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def best_options(
    queries: DataFrame, options: DataFrame, scorer: str = "weighted", cutoff: float = 0.0, limit: int = 1, query_rows: int = QUERY_ROWS, option_rows: int = OPTION_ROWS
) -> DataFrame:
    """``queries`` (query_id, text) with their ``limit`` best ``options`` (choice, ord) of at least ``cutoff``: choice, choice_ord, score, rank.

    The best score comes first, of equal scores the least ord. Null texts have no
    score. Equal texts are asked once, and equal choices are scored once; of these
    the ``limit`` first can count. Options and queries may be any number: a task
    holds a block of each.
    """
    spark = queries.sparkSession
    first = Window.partitionBy("choice").orderBy("choice_ord")
    told = options.where("choice is not null").select("choice", F.col("ord").cast("long").alias("choice_ord"))
    told = told.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= limit).drop("_n")  # a task keeps a few of each before the shuffle
    told = stage(told, "retrieve-told")
    once = stage(told.groupBy("choice").agg(F.min("choice_ord").alias("ord")), "retrieve-options")
    texts = stage(queries.where("text is not null").select("text").distinct(), "retrieve-queries")
    n_q, n_o = texts.count(), once.count()

    words = lambda c: F.explode(F.array_distinct(F.split(F.trim(c), r"\s+")))
    few = Window.partitionBy("word").orderBy("ord")
    by_word = once.select("choice", "ord", words("choice").alias("word")).withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= 2 * limit).drop("_n")
    met = texts.select("text", words("text").alias("word")).join(by_word, "word").groupBy("text", "choice").agg(F.min("ord").alias("choice_ord"))
    tried = ranked(met.withColumn("score", fuzzy.UDFS[scorer]("text", "choice")).where(F.col("score") >= cutoff), limit)
    held = tried.groupBy("text").agg(F.count("*").alias("n"), F.max(F.struct("rank", "score", "choice_ord")).alias("r")).where(F.col("n") == limit)
    held = held.select(F.col("text").alias("_t"), F.col("r.score").alias("held"), F.col("r.choice_ord").alias("held_ord"))
    asked = texts.join(held, F.col("text") == F.col("_t"), "left").drop("_t")

    q_blocks, o_blocks = max(1, -(-n_q // query_rows)), max(1, -(-n_o // option_rows))
    to = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qb", F.pmod(F.xxhash64("text"), F.lit(q_blocks)).cast("int")).withColumn("ob", to(o_blocks))
    right = once.withColumn("ob", F.pmod(F.xxhash64("choice"), F.lit(o_blocks)).cast("int")).withColumn("qb", to(q_blocks))

    def meet(q: pd.DataFrame, o: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(o):
            return frame([])
        return best_of_block(q, o, scorer, cutoff, limit)[0]

    met = left.groupBy("qb", "ob").cogroup(right.groupBy("qb", "ob")).applyInPandas(meet, "text string, choice string, first_ord long, score double")
    per_text = met.withColumn("_n", F.row_number().over(Window.partitionBy("text").orderBy(F.desc("score"), "first_ord"))).where(F.col("_n") <= limit).select("text", "choice", "score")
    best = stage(ranked(per_text.join(told, "choice"), limit), "retrieve-best")
    free(told, once, texts)
    names = [c for c in queries.columns if c != "text"]
    return queries.join(best, "text").select(*names, "text", "choice", "choice_ord", "score", "rank")

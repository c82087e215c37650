"""Quality classification by co-training of two views.

One classifier reads the text, the other only what is known about the page:
source and language. In each round either names the unlabelled documents of which
it is most confident; they teach the other and leave the pool. Both are then
calibrated on labelled rows that neither learned from, and combined to score all
documents.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import free, in_workers, mix, stage, tune

#: Labelled rows read at most (by hash order); the part kept for calibration; rounds;
#: pseudo-labels a view gives a round at most; what counts as confident.
MOST_LABELLED, CALIBRATE, ROUNDS, EXCHANGE, CONFIDENT = 20_000, 0.25, 3, 500, 0.95
STOP = set("the of and to in is that for it as de la le et les des en un une que der die und den von zu das el y los se las por con".split())
SOURCES, LANGS = 48, 16
CLASSES = np.full(256, 7, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\t\r\x0b\x0c", b".,;:?'\"()-", b"!#*$%&|<>@^~=+_{}[]/\\`")):
    CLASSES[list(_chars)] = _k
#: Places that words and pairs of words are hashed to; words whose hashes a worker remembers.
HASHED, REMEMBERED = 256, 400_000
SHAPES = 8 + 8 + 9
TEXT_FEATURES, META_FEATURES = SHAPES + HASHED, SOURCES + LANGS


class _Hashes(dict):
    """The hash of each word met, made when it is first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        h = self[word] = zlib.crc32(word.encode())
        return h


_HASHES = _Hashes()


def word_view(words: list[str]) -> np.ndarray:
    """Words and pairs of neighbours, hashed to signed places: roots of their counts, scaled to the length of the text."""
    if not words:
        return np.zeros(HASHED)
    one = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    h = mix(np.r_[one, one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]])
    sums = np.bincount((h % np.uint64(HASHED)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0), HASHED)
    return np.sign(sums) * np.sqrt(np.abs(sums) / len(words))


def text_view(text: str | None) -> np.ndarray:
    """Shares of character classes, repeats of classes, measures of words and lines, and hashed words."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    n = max(len(raw), 1)
    kind = CLASSES[raw]
    same = kind[1:][kind[1:] == kind[:-1]]
    words, lines = (text or "").split(), [x for x in (text or "").split("\n") if x.strip()]
    w = max(len(words), 1)
    counted = Counter(words)
    return np.concatenate([
        np.bincount(kind, minlength=8) / n, np.bincount(same, minlength=8) / n,
        [np.log1p(len(words)) / 10, len(raw) / w / 10, len(counted) / w, sum(map(counted.__getitem__, STOP & counted.keys())) / w,
         max(counted.values(), default=0) / w, len(set(lines)) / max(len(lines), 1), min(1, len(lines) / w * 5),
         sum(n for x, n in counted.items() if x.isupper() and len(x) > 1) / w, sum(n for x, n in counted.items() if not x[-1:].isalnum() and x[-1:] not in ".,") / w],
        word_view(words),
    ])


def meta_places(source: str | None, lang: str | None) -> tuple[int, int]:
    """Where hashed source and language stand in the view; nulls are values of their own."""
    return zlib.crc32(repr(source).encode()) % SOURCES, SOURCES + zlib.crc32(repr(lang).encode()) % LANGS


class Logistic:
    """Logistic regression with a ridge, by Newton's method; standardises its inputs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, balance: bool = False) -> None:
        self.mean, self.scale = x.mean(0), x.std(0)
        self.scale[self.scale == 0] = 1
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))]
        weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9)) if balance else np.ones(len(y))
        self.w = np.zeros(z.shape[1])
        keep = np.full(z.shape[1], ridge)
        keep[-1] = 1e-6
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(keep), z.T @ (weight * (y - p)) - keep * self.w)
            self.w += step
            if np.abs(step).max() < 1e-6:
                break

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def features(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_x, source, lang) of ``docs`` (doc_id, text, source, lang): a text's view in half floats, places in the other view."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            views = [text_view(t).astype("<f2").tobytes() for t in cols[1]]
            places = np.array([meta_places(*m) for m in zip(*cols[2:], strict=True)], np.int32).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(views, pa.binary()), pa.array(places[:, 0]), pa.array(places[:, 1])], ["doc_id", "text_x", "source", "lang"])

    return in_workers(docs.select("doc_id", "text", "source", "lang"), run, f"doc_id long, {VIEWS}")


VIEWS = "text_x binary, source int, lang int"


def views(text_x: list[bytes], source: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both views of several rows as matrices."""
    n = len(text_x)
    meta = np.zeros((n, META_FEATURES))
    meta[np.arange(n), source] = meta[np.arange(n), lang] = 1
    return np.frombuffer(b"".join(text_x), "<f2").reshape(n, TEXT_FEATURES).astype(float), meta


def arrays(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    place = [np.array([getattr(r, c) for r in rows], np.int64) for c in ("source", "lang")]
    return *views([bytes(r.text_x) for r in rows], *place), np.array([r.y for r in rows], float)


def scored(rows: DataFrame, score, names: list[str]) -> DataFrame:
    """``doc_id`` of ``rows`` (doc_id and views) with the columns that ``score`` makes of both views."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = views(b.column(1).to_pylist(), b.column(2).to_numpy(), b.column(3).to_numpy())
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v) for v in score(*x))], ["doc_id", *names])

    return in_workers(rows.select("doc_id", "text_x", "source", "lang"), run, "doc_id long, " + ", ".join(f"{n} double" for n in names))


def exchange(unlabelled: DataFrame, text: Logistic, meta: Logistic, positive: float, count: int = EXCHANGE) -> tuple[list[list], DataFrame]:
    """For each view, the rows that it is most confident of, with its labels: a top-k each side, in the share of the labels. And their ids (gone).

    The unlabelled rows are scored once; narrow rows compete, and the views of
    those chosen, at most two ``count`` of ids, are fetched after: one row an id,
    however often it repeats.
    """
    both = stage(scored(unlabelled, lambda t, m: (text.chance(t), meta.chance(m)), ["text_p", "meta_p"]), "quality-chances")
    best = None
    for view in ("text_p", "meta_p"):
        for y, p, k in ((1.0, F.col(view), max(1, round(count * positive))), (0.0, 1 - F.col(view), max(1, round(count * (1 - positive))))):
            top = both.where(p >= CONFIDENT).select("doc_id", p.alias("p")).orderBy(F.desc("p"), F.xxhash64("doc_id"), "doc_id").limit(k)
            top = top.select(F.col("doc_id").alias("gone"), F.lit(view).alias("view"), F.lit(y).alias("y"))
            best = top if best is None else best.union(top)
    best = stage(best.distinct(), "quality-best")
    row = F.struct("text_x", "source", "lang")
    taken = unlabelled.join(F.broadcast(best), F.col("doc_id") == F.col("gone")).groupBy("doc_id", "view", "y").agg(F.min(row).alias("r")).orderBy("doc_id", "view", "y").select("view", "r.*", "y").collect()
    free(both)
    return [[r for r in taken if r.view == view] for view in ("text_p", "meta_p")], best


def parted(rows: list, share: float) -> tuple[list, list]:
    """Rows to learn from and rows held out: of each class, in the order given, every so many are held out, the first never."""
    every = max(2, round(1 / share))
    learn, hold, met = [], [], Counter()
    for r in rows:
        (hold if met[r.y] % every == every - 1 else learn).append(r)
        met[r.y] += 1
    return learn, hold


def quality_scores(docs: DataFrame, labels: DataFrame, most_labelled: int = MOST_LABELLED, rounds: int = ROUNDS, count: int = EXCHANGE) -> DataFrame:
    """One row a document: doc_id, score, text_score, meta_score, kept (score of one half or more).

    ``docs`` has doc_id, text, source, lang; ``labels`` has doc_id and quality (0
    or 1; the least counts where a document has several, nulls do not). Training
    reads about ``most_labelled`` labelled rows (twice that at the very most); the
    pseudo-labels of a round are a top ``count`` over all rows still unlabelled;
    every row is scored. Null or empty texts and null metadata are values like
    others, and texts may be of any length; a row with a null id is scored and
    teaches nothing; rows that repeat an id are scored each, and one of them
    teaches. Where a class has too few labels to hold any out, scores stay
    uncalibrated; with labels of one class or none, all scores are that class (kept
    where there is none). An empty table gives no rows.
    """
    tune(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("text", "source", "lang")))
    rows = stage(features(d), "quality-views")
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("double").alias("y"))
    joined = stage(rows.join(known, "doc_id", "left"), "quality-labelled")
    labelled = joined.where("y is not null")
    # A sample by hash, of a size that is bounded whatever the number of labels and the rows of one id.
    share = min(1.0, most_labelled / max(labelled.count(), 1))
    order = [F.crc32(F.col("doc_id").cast("string")), F.col("doc_id"), F.col("text_x"), F.col("source"), F.col("lang")]
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 52)) < int(share * (1 << 52))).orderBy(*order).limit(2 * most_labelled).select("text_x", "source", "lang", "y").collect()
    learn, hold = parted(chosen, CALIBRATE)
    t, m, y = arrays(learn)
    tc, mc, yc = arrays(hold)
    if len(seen := set(y.tolist())) < 2:
        p = F.lit(seen.pop() if seen else 1.0)
        return rows.select("doc_id", p.alias("score"), p.alias("text_score"), p.alias("meta_score"), (p >= 0.5).alias("kept"))
    unlabelled = joined.where("y is null and doc_id is not null").select("doc_id", "text_x", "source", "lang")
    text, meta = Logistic(t, y), Logistic(m, y)
    taught: list[list] = [[], []]  # by the other view: rows for text, rows for meta
    for _ in range(rounds):
        (by_text, by_meta), gone = exchange(unlabelled, text, meta, float(y.mean()), count)
        unlabelled = unlabelled.join(F.broadcast(gone.select("gone")), F.col("doc_id") == F.col("gone"), "left_anti")
        taught[0] += by_meta
        taught[1] += by_text
        for k, x in ((0, t), (1, m)):
            extra = arrays(taught[k])
            model = Logistic(np.r_[x, extra[k]], np.r_[y, extra[2]])
            text, meta = (model, meta) if k == 0 else (text, model)
    free(joined)
    sure = whole = None
    if len(set(yc.tolist())) == 2:
        sure = [Logistic(v.logit(x)[:, None], yc) for v, x in ((text, tc), (meta, mc))]
        whole = Logistic(np.c_[sure[0].logit(text.logit(tc)[:, None]), sure[1].logit(meta.logit(mc)[:, None])], yc)

    def score(t: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
        views = np.c_[text.logit(t), meta.logit(m)]
        if sure:
            views = np.c_[sure[0].logit(views[:, :1]), sure[1].logit(views[:, 1:])]
        both = whole.chance(views) if whole else 1 / (1 + np.exp(-views.mean(1)))
        return both, *(1 / (1 + np.exp(-views.T)))

    names = ["score", "text_score", "meta_score"]
    return scored(rows, score, names).select("*", (F.col("score") >= 0.5).alias("kept"))

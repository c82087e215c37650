"""Language identification in two steps: family first, then languages within it.

Linear support vector machines over hashed byte trigrams. One-versus-rest
machines choose the family; one-versus-one machines choose among the languages
of that family by votes, ties by summed margins. They are trained on a bounded
sample of the labelled rows and applied to every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, ragged, runs, stage, text_bytes, tune

#: Languages by family (ISO 639 codes); a language not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fo af fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz tk ky".split(),
    "semitic": "ar he am mt".split(),
    "indic": "hi bn ur mr gu pa ne si".split(),
}
#: Hashed trigrams; labelled rows that training reads at most, of a language and
#: of all. Every language with a labelled row is learned: many share the whole.
BUCKETS, PER_LANGUAGE, MOST_ROWS = 8192, 400, 8000
UNKNOWN = "und"

#: Letters fold to lower case, bytes beyond ASCII stay, all else is a gap.
FOLD = np.full(256, 32, np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def trigrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram buckets of the texts end to end, and how many each has. Trigrams of gaps alone do not count."""
    padded = b"".join(b"\n" + (t or b"") + b"\n\n" for t in texts)
    x = FOLD[np.frombuffer(padded, np.uint8)].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    gap = x == 32
    key = x[:-2] << 16 | x[1:-1] << 8 | x[2:]
    ok = ~(gap[1:-1] & (gap[:-2] | gap[2:]))
    bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)).astype(np.int32)
    size = np.array([len(t or b"") + 3 for t in texts], np.int64)
    ends = np.minimum(np.cumsum(size), len(ok))
    count = np.diff(np.r_[0, np.r_[0, np.cumsum(ok)][ends]])
    return bucket[ok], count


def fit_machine(x: np.ndarray, y: np.ndarray, scale: np.ndarray, steps: int = 150, decay: float = 1e-3) -> tuple[np.ndarray, float, float]:
    """A linear machine by squared hinge loss, classes weighed equally: weights, bias, slope of its confidence.

    Plain accelerated gradient descent from zero, so that it is deterministic.
    """
    z = x * scale
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    rate = 1.0 / (2 * float((weight * (np.square(z).sum(1) + 1)).sum()) + decay)
    w, b = np.zeros(z.shape[1], np.float32), 0.0
    vw, vb, pw, pb = w.copy(), b, w.copy(), b
    for k in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (z @ vw + vb)) * weight * y
        w, b = vw + rate * (2 * z.T @ slack - decay * vw), vb + rate * 2 * float(slack.sum())
        m = (k - 1) / (k + 2)
        vw, vb = w + m * (w - pw), b + m * (b - pb)
        pw, pb = w.copy(), b
    margin = np.abs(z @ w + b)
    return w * scale, float(b), float(4.0 / max(np.median(margin), 1e-6))


class Model:
    """Family machines, and pair machines of each family."""

    def __init__(self, x: np.ndarray, lang: list[str]) -> None:
        home = {code: family for family, codes in FAMILIES.items() for code in codes}
        self.langs = sorted(set(lang))
        names = np.array([self.langs.index(v) for v in lang])
        of = [home.get(v, v) for v in self.langs]
        self.families = sorted(set(of))
        self.members = [[i for i, f in enumerate(of) if f == family] for family in self.families]
        scale = 1 / np.sqrt(x.mean(0) + 1e-5)
        family = np.array([self.families.index(f) for f in of])[names]
        self.family_machines = []
        if len(self.families) > 1:
            self.family_machines = [fit_machine(x, np.where(family == f, 1, -1).astype(np.float32), scale) for f in range(len(self.families))]
        self.pairs = {}
        for members in self.members:
            for a, b in combinations(members, 2):
                on = (names == a) | (names == b)
                self.pairs[a, b] = fit_machine(x[on], np.where(names[on] == a, 1, -1).astype(np.float32), scale)

    @staticmethod
    def margins(machine: tuple[np.ndarray, float, float], bucket: np.ndarray, count: np.ndarray) -> np.ndarray:
        w, b, slope = machine
        total = np.r_[0.0, np.cumsum(w[bucket], dtype=np.float64)]
        ends = np.cumsum(count)
        return slope * ((total[ends] - total[ends - count]) / np.maximum(count, 1) + b)

    def predict(self, bucket: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language, family and score (0 to 1) of texts given as trigrams."""
        n = len(count)
        sure = lambda m: 1 / (1 + np.exp(-np.clip(m, -50, 50)))
        family, score = np.zeros(n, np.int64), np.ones(n)
        if self.family_machines:
            p = np.stack([sure(self.margins(m, bucket, count)) for m in self.family_machines], 1)
            family = p.argmax(1)
            score = p.max(1) / np.maximum(p.sum(1), 1e-9)
        lang = np.zeros(n, np.int64)
        first = np.cumsum(count) - count
        for f, members in enumerate(self.members):
            some = np.flatnonzero(family == f)
            if len(members) == 1 or not len(some):
                lang[some] = members[0]
                continue
            part, size = bucket[ragged(first[some], count[some])], count[some]
            votes, sums, chance = (np.zeros((len(some), len(members))) for _ in range(3))
            for a, b in combinations(range(len(members)), 2):
                m = self.margins(self.pairs[members[a], members[b]], part, size)
                votes[:, a] += m >= 0
                votes[:, b] += m < 0
                sums[:, a] += m
                sums[:, b] -= m
                chance[:, a] += sure(m)
                chance[:, b] += sure(-m)
            best = (votes + np.tanh(sums / 100) / 4).argmax(1)
            lang[some] = np.array(members)[best]
            score[some] *= chance[np.arange(len(some)), best] / (len(members) - 1)
        return lang, family, score


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> list[tuple[str, bytes]]:
    """Trigrams of a bounded sample of labelled ``docs`` (doc_id, text, lang), in hash order: ``per_language`` rows of each language, fewer where that makes more than ``most_rows``.

    A threshold on the hash leaves about twice as many rows of a language before
    they are put in order, so that a language with most rows is no large task.
    """
    labelled = docs.where("lang is not null and text is not null").withColumn("order", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    known = stage(labelled.groupBy(F.col("lang").alias("of")).agg(F.count("*").alias("n")), "language-sizes")
    most = max(1, min(per_language, most_rows // max(known.count(), 1)))
    part = F.pmod(F.col("order"), F.lit(1 << 30))
    near = labelled.join(known, F.col("lang") == F.col("of")).where(part < F.lit(float((2 * most + 50) << 30)) / F.col("n"))
    rows = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(part, "order", "doc_id"))).where(F.col("k") <= most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(b.column(1))
            for i, j in runs(texts):
                bucket, count = trigrams(texts[i:j])
                ends = np.cumsum(count)
                cut = [np.bincount(bucket[e - n : e], minlength=BUCKETS) for e, n in zip(ends, count, strict=True)]
                at = [np.flatnonzero(x) for x in cut]
                held = [np.r_[k, x[k]].astype("<u4").tobytes() for k, x in zip(at, cut, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(held, pa.binary())], ["lang", "x"])

    return sorted((r.lang, bytes(r.x)) for r in in_workers(rows.select("lang", "text"), run, "lang string, x binary").toLocalIterator())


def shares(rows: list[tuple[str, bytes]]) -> np.ndarray:
    """A row of trigram shares for each sampled text."""
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (_, held) in enumerate(rows):
        bucket, n = np.frombuffer(held, "<u4").reshape(2, -1)
        x[i, bucket] = n / max(1, n.sum())
    return x


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score, family.

    held_out rows (CRC-32 of the id as text, modulo 4, is 2) are never learned
    from, nor are rows with a null language, text or id. Only the text is an
    input of a prediction. A text that is null or has no letter is ``und`` with
    score 0, as is every text where no row is labelled; with one language all
    others get that one. Every language with a labelled row is learned. Repeated
    rows are judged each; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    tune(spark)
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    rows = sample(d.where(~held & F.col("doc_id").isNotNull()), per_language)
    model = None
    if rows:
        model = Model(shares(rows), [v for v, _ in rows])
    known = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for b in batches:
            texts = text_bytes(b.column(2))
            letters = pc.fill_null(pc.match_substring_regex(b.column(2), r"\pL"), False).to_numpy(zero_copy_only=False)
            for i, j in runs(texts):
                lang, family, score = np.full(j - i, UNKNOWN, object), np.full(j - i, UNKNOWN, object), np.zeros(j - i)
                if m is not None:
                    at, of, p = m.predict(*trigrams(texts[i:j]))
                    on = letters[i:j]
                    lang[on], family[on], score[on] = np.array(m.langs, object)[at[on]], np.array(m.families, object)[of[on]], p[on]
                cols = [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(lang, pa.string()), pa.array(score), pa.array(family, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "lang_pred", "score", "family"])

    kind = d.schema["doc_id"].dataType.simpleString()
    return in_workers(d.select("doc_id", held.alias("held_out"), "text"), run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, family string")

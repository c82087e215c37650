"""Every stage of the pipeline against a brute-force version, on a table with planted cases and edge rows."""

import collections
import itertools
import math
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from vellum.llm import quality_rules, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    common = quality_rules.COMMON["en"][:12]
    vocabulary = common * 8 + [f"word{i}" for i in range(600)]
    phrase = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    passage = phrase(70)
    texts = [" ".join(phrase(int(n))) for n in rng.integers(80, 260, 50)]
    base = phrase(200)
    texts.append(" ".join(base))
    for k in range(6):  # near copies: a word changed
        texts.append(" ".join([*base[: 20 * k + 5], f"edit{k}", *base[20 * k + 6 :]]))
    far = list(base)
    for k in range(0, 200, 12):  # too many changes
        far[k] = f"far{k}"
    texts.append(" ".join(far))
    texts += [texts[3], texts[3] + "\n", texts[4].replace(" ", "  ")]  # exact copies but for white space
    texts += [" ".join(phrase(60) + passage + phrase(40)) for _ in range(4)]  # a shared passage
    texts += [" ".join(w + "%%%&&&" for w in phrase(120)), "short one", "", None, "again and again " * 60, " ".join(phrase(4000))]
    rows = [(7 * i % 997, t, None if i % 9 == 4 else "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def rows_of(d):
    return {r.doc_id: r for r in d.collect()}


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def shares(text):
    w, low = words(text), [x.lower() for x in words(text)]
    classes = [len(re.findall(p, text or "")) for _, p in quality_rules.CLASSES]
    vocabulary = sorted({x for ws in quality_rules.COMMON.values() for x in ws})
    counts = [low.count(x) for x in vocabulary]
    full = lambda c, n: [x / n for x in c] + [(n - sum(c)) / n] if n else [0.0] * (len(c) + 1)
    return full(classes, len(text or "")), full(counts, len(w))


def distance(p, q):
    term = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum(term(x, (x + y) / 2) + term(y, (x + y) / 2) for x, y in zip(p, q, strict=True)) / 2))


def quality_expected(rows):
    failed, features = {}, {}
    for d, r in rows.items():
        w = words(r.text)
        seen = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        failed[d], features[d] = len(w) < 50 or 100 * len(covered) > 50 * len(w), (len(w), *shares(r.text))
    by = collections.defaultdict(list)
    for d, r in rows.items():
        if r.lang is not None and not failed[d]:
            by[r.lang].append(d)
    refs = {lang: [np.mean([features[d][k] for d in ds], axis=0) for k in (1, 2)] for lang, ds in by.items()}
    out = set()
    for d, r in rows.items():
        n, chars, common = features[d]
        if failed[d]:
            continue
        if r.lang in refs and n >= quality_rules.MIN_WORDS:
            room = 1 / math.sqrt(n)
            thin = 1 / len(by[r.lang])
            if distance(chars, refs[r.lang][0]) > quality_rules.CHAR_LIMIT + room / 2 + thin or distance(common, refs[r.lang][1]) > quality_rules.WORD_LIMIT + room + thin:
                continue
        out.add(d)
    return out


def exact_expected(rows):
    groups = collections.defaultdict(list)
    for d, r in rows.items():
        groups["".join(words(r.text))].append((-len(r.text or ""), d))
    return {min(m)[1] for m in groups.values()}


def near_expected(rows):
    sets = {}
    for d, r in rows.items():
        w = (r.text or "").lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}
    root = {d: d for d in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(rows), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d for d in rows if find(d) == d}


def repeats_expected(rows, size=35):
    split = {d: (r.text or "").encode().split() for d, r in rows.items()}
    seen = collections.Counter(tuple(w[i : i + size]) for w in split.values() for i in range(len(w) - size + 1))
    out = {}
    for d, w in split.items():
        gone = {k for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for k in range(i, i + size)}
        out[d] = b" ".join(x for i, x in enumerate(w) if i not in gone).decode() if gone else rows[d].text
    return out


def test_stages(spark, table):
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "exact_dedup", "simhash", "substring_dedup", "packing"]
    docs, before = table, rows_of(table)
    for name, expected in (("quality_rules", quality_expected), ("exact_dedup", exact_expected), ("simhash", near_expected)):
        docs = steps[name](spark, docs, "").cache()
        assert docs.columns == table.columns
        after = rows_of(docs)
        assert set(after) == expected(before), name
        assert after == {d: before[d] for d in after}
        assert len(after) < len(before)
        before = after
    docs = steps["substring_dedup"](spark, docs, "").cache()
    after = rows_of(docs)
    texts = repeats_expected(before)
    assert {d: r.text for d, r in after.items()} == texts and docs.columns == table.columns
    assert sum(texts[d] != before[d].text for d in texts) == 4
    assert all(r.n_chars == len(r.text) for d, r in after.items() if r.text != before[d].text)
    pieces = steps["packing"](spark, docs, "").collect()
    assert {p.doc_id for p in pieces} == set(after)
    held = collections.Counter()
    for p in pieces:
        held[p.sequence_id] += p.length
    assert max(held.values()) <= 4096 and len(held) <= -(-sum(held.values()) // 4096) + 1


def test_run_and_empty_tables(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    none = table.limit(0)
    for name, step in corpus_pipeline.STAGES:
        none = step(spark, none, "")
        assert none.count() == 0, name


def kept_near(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA)
    return set(rows_of(corpus_pipeline.near(spark, docs, ""))), near_expected(rows_of(docs))


def test_near_stage_joins_appended_and_truncated_copies(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n in rng.integers(120, 400, 60):
        w = [f"word{x}" for x in rng.zipf(1.3, n) % 5000]
        extra = [f"more{x}" for x in rng.integers(0, 5000, n)]
        texts += [" ".join(w), " ".join(w + extra[: n * 23 // 100])]  # similarity just over 0.8
        texts += [" ".join(extra), " ".join(extra[: n * 82 // 100])]
    got, expected = kept_near(spark, texts)
    assert got == expected and len(expected) < 130


def test_near_stage_tries_every_partner(spark):
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(8):  # one set of words, so equal views: the first in another order, the others near copies
        w = [f"word{x}" for x in rng.permutation(300)]
        texts += [" ".join(rng.permutation(w)), " ".join(w), " ".join([*w[4:], *w[:4]])]
    got, expected = kept_near(spark, texts)
    assert got == expected and len(expected) == 16


def test_stages_decide_by_row_and_not_by_id(spark):
    rng = np.random.default_rng(8)
    common = quality_rules.COMMON["en"][:12]
    say = lambda n: " ".join(rng.choice(common * 8 + [f"word{i}" for i in range(600)], n))
    v, t, u = say(120), say(130), say(140)
    steps = dict(corpus_pipeline.STAGES)
    rows = [(7, v), (7, t), (1, t + " "), (None, u), (None, u), (3, u.replace(" ", "\n")), (9, "short"), (9, v + " more")]
    docs = spark.createDataFrame([(i, x, "en", "s", len(x)) for i, x in rows], SCHEMA)
    docs = steps["quality_rules"](spark, docs, "").cache()
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted((i or 0, x) for i, x in rows if x != "short")
    docs = steps["exact_dedup"](spark, docs, "").cache()
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(7, v), (1, t + " "), (3, u.replace(" ", "\n")), (9, v + " more")])
    docs = steps["simhash"](spark, docs, "").cache()
    assert sorted(r.doc_id for r in docs.collect()) == [1, 3, 7]
    again = spark.createDataFrame([(None, u, "en", "s", 1), (None, u, "en", "s", 1), (None, v, "en", "s", 1)], SCHEMA)
    for name in ("exact_dedup", "simhash"):
        assert sorted(r.text for r in steps[name](spark, again, "").collect()) == sorted([u, v]), name


def test_run_equals_the_chained_brute_force(spark, table, tmp_path):
    table.write.parquet(str(tmp_path / "documents.parquet"))
    rows = rows_of(table)
    for expected in (quality_expected, exact_expected, near_expected):
        some = expected(rows)
        rows = {d: r for d, r in rows.items() if d in some}
    texts = repeats_expected(rows)
    from tokenizers import Tokenizer

    from vellum.llm import packing
    from vellum.llm.tokens import model_path

    model = Tokenizer.from_file(model_path(packing.MODEL))
    sizes = {d: len(model.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    got = collections.Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert dict(got) == sizes


def test_similar_documents_share_as_many_keys_as_is_said():
    from vellum.llm import simhash

    rng = np.random.default_rng(3)
    for _ in range(4000):
        both = rng.permutation(1000)
        union = int(rng.integers(1, 400))
        shared = int(rng.integers(int(np.ceil(0.8 * union)), union + 1))
        cut = int(rng.integers(0, union - shared + 1))
        a, b = np.sort(np.r_[both[:shared], both[shared : shared + cut]]), np.sort(np.r_[both[:shared], both[shared + cut : union]])
        m, n = np.array(len(a)), np.array(len(b))
        if shared / union < 0.8 or not min(m, n):
            continue
        common = np.intersect1d(a[: simhash.prefix(m, 0.8)], b[: simhash.prefix(n, 0.8)])
        i, j = (np.array([np.searchsorted(x, k) for k in common]) for x in (a, b))
        size, at, k = np.r_[np.full(len(i), m), np.full(len(j), n)], np.r_[i, j], np.arange(len(i))
        assert simhash.early(size, at, k, k + len(i), 0.8)[0]
        assert len(common) >= simhash.shared_keys(m, n, 0.8) >= max(1, max(m, n) // simhash.EXTRA)


def test_passages_alone_make_no_pairs(spark):
    from vellum.llm import simhash

    rng = np.random.default_rng(4)
    passage = " ".join(f"shared{x}" for x in range(70))
    texts = [" ".join(f"word{x}" for x in rng.integers(0, 10**6, 300)) + " " + passage for _ in range(80)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "node long, root long")
    assert simhash.sharing(d, none, 5, 0.8).count() == 0


def test_marks_lose_no_pair_that_shares_enough():
    import pyarrow as pa

    from vellum.llm import simhash

    rng = np.random.default_rng(9)
    size = 200
    sets = [rng.permutation(400)[:size] for _ in range(30)]
    sets += [np.r_[s[: size - 15], rng.permutation(np.arange(400, 800))[:15]] for s in sets]  # similar to one each
    prefix = int(simhash.prefix(np.array(size), 0.8))
    keys = [np.sort(s)[:prefix] for s in sets]
    spots = np.random.default_rng(1).integers(0, 512, 800)
    rows = []
    for node, k in enumerate(keys):
        marks = np.zeros(8, np.uint64)
        for spot in spots[k].tolist():
            marks[spot // 64] |= np.uint64(1) << np.uint64(spot % 64)
        rows += [(int(key), node, node, size << 32 | at, len(k), *marks.view(np.int64).tolist()) for at, key in enumerate(k.tolist())]
    rows.sort()
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [f"c{i}" for i in range(13)])
    got = {(a, b) for out in simhash.meetings(iter([batch]), 0.8, 4096) for a, b in zip(out.column(1).to_pylist(), out.column(2).to_pylist(), strict=True)}
    similar = {(i, j) for i, j in itertools.combinations(range(60), 2) if len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]})}
    assert len(similar) >= 30 and similar <= got and len(got) < 400


def test_links_grow_with_the_members_of_a_bucket():
    """Suggested links of a bucket of near copies: one a member at most, whether it is small or large."""
    rng = np.random.default_rng(5)
    for n in (40, 600):
        fp = (np.int64(1) << rng.integers(0, 60, n)) ^ (np.int64(1) << rng.integers(0, 60, n))
        rows = [pa.array(x) for x in (np.zeros(n, np.int64), np.arange(n), fp)]
        batch = pa.RecordBatch.from_arrays(rows, ["key", "node", "fp"])
        links = pa.Table.from_batches(simhash.link(iter([batch]), 8, 4096, forest=False))
        assert links.column("b").to_pylist() == list(range(1, n)) and set(links.column("a").to_pylist()) == {0}


def test_blocks_of_a_large_bucket_suggest_one_link_a_member(spark):
    n = 2000
    fps = (np.int64(1) << np.arange(n, dtype=np.int64) % 3) + (np.int64(1) << 62) * (np.arange(n) % 2)
    nodes = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.tolist())], "node long, fp long")
    links = simhash.linked(nodes, ["fp"], 8, block=64, forest=False, joint=True)
    keyed = len(simhash.keys(fps.view(np.uint64), True)[0])
    assert links.select("b").distinct().count() == n - 1 and links.count() <= keyed

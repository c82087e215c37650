"""Whitening, the conversation trie and prefix BPE against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from vellum.llm import prefix_bpe, prefix_trie, queries, whitening
from vellum.llm.tokens import encoder, model_path

SF = "/root/testdata/sf0.001"


# whitening


def whitening_expected(rows):
    placed = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in placed})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviations = collections.Counter((i, sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in placed)
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    return placed, fit, n, sums, deviations, centred.T @ centred / n


def check_whitening(rows, out, components):
    placed, fit, n, sums, deviations, cov = whitening_expected(rows)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:components]
    assert len(out) == len(placed) * components
    assert {r.n for r in out} == {n}
    assert collections.Counter((r.vec_id, r.deviation) for r in out if r.component == 1) == deviations
    for r in out:
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
    by = collections.defaultdict(dict)
    for r in out:
        by[r.vec_id, r.deviation][r.component] = r.whitened
    exact = {(i, sum((n * c - s) ** 2 for c, s in zip(x, sums))): x for i, x in placed}
    z = {tuple(exact[k]): [w[c] for c in range(1, components + 1)] for k, w in by.items()}
    seen = np.array([z[x] for x in fit])
    assert np.abs(seen.T @ seen / n - np.eye(components)).max() < 1e-9
    assert max(r.identity_error for r in out) < 1e-9
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    axes = centred.T @ seen / n  # V w / sqrt(e) is an eigenvector times sqrt(e)
    assert np.allclose(cov @ axes, axes * values, rtol=1e-7, atol=1e-9)


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, n string, x string").repartition(5)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_whitening_matches_a_plain_computation(spark, kind):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=20) * np.arange(1, 21)], "n", "x") for i in range(300)]
    rows += [(i + 1000, rows[0][1], None, None) for i in range(150)]  # one very common vector
    rows += [rows[5], (None, rows[6][1], "n", "x"), (7000, None, "n", "x"), (7001, [None] + rows[1][1][1:], "n", "x"), (7002, [float("nan")] + rows[1][1][1:], "n", "x"), (7003, [float("inf")] + rows[1][1][1:], "n", "x"), (7004, [], "n", "x")]
    out = whitening.whitened_components(vectors(spark, rows, kind)).collect()
    check_whitening([r[:2] for r in rows], out, 16)


def test_whitening_of_few_dimensions_far_from_nought(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(1e9 + c) for c in rng.normal(size=3) * 50], "n", "x") for i in range(100)]
    check_whitening([r[:2] for r in rows], whitening.whitened_components(vectors(spark, rows, "double")).collect(), 3)


def test_whitening_without_rows_or_variance(spark):
    assert whitening.whitened_components(vectors(spark, [(1, None, "n", "x")])).collect() == []
    out = whitening.whitened_components(vectors(spark, [(1, [1.0, 2.0], "n", "x"), (2, [1.0, 2.0], "n", "x"), (3, [1.0], "n", "x")])).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(out)] == [(i, c, 1, 0, None, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]
    line = [(i, [float(i), float(2 * i)], "n", "x") for i in range(9)]  # rank one
    out = whitening.whitened_components(vectors(spark, line)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in out) and max(r.identity_error for r in out) < 1e-9


def test_deviations_beyond_a_long_are_exact(spark):
    rows = [(1, [3e12, 0.0], "n", "x"), (2, [-3e12, 1.0], "n", "x"), (3, [5.0, 2.0], "n", "x")]
    wide, model = whitening.whiten(vectors(spark, rows, "double"))
    assert {r.vec_id: int(r.deviation) for r in wide.collect()} == {i: d for i, d in whitening_expected([r[:2] for r in rows])[4]}
    assert {r.vec_id: r.deviation for r in whitening.whitened_components(vectors(spark, rows, "double")).collect()}[1] is None


def test_merging_moments_equals_one_pass():
    rng = np.random.default_rng(5)
    x = rng.integers(10**6 - 300, 10**6 + 300, (500, 6))
    parts = [whitening.moments(p) for p in np.split(x, [1, 20, 300])]
    n, sums, scatter = whitening.merge(whitening.merge(parts[0], parts[1]), whitening.merge((0, [0] * 6, np.zeros((6, 6))), whitening.merge(parts[2], parts[3])))
    centred = x - x.mean(axis=0)
    assert n == 500 and sums == x.sum(axis=0).tolist()
    assert np.allclose(scatter, centred.T @ centred, rtol=1e-12)


def test_op11_over_its_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(rows, queries.queries()["op11_whitening"](spark, SF).collect(), 16)


# conversations


def trie_expected(rows, share):
    talks = collections.defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            digest = hashlib.md5(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()
            talks[c].append(((turn is not None, turn or 0), digest, role or "", text or ""))
    talks = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in talks.items()}
    if share:
        def new(c):
            h = zlib.crc32(str(c).encode()) % 4
            return talks.get(c - int(math.fmod(c, 20)), [])[:h] + talks[c][h:]

        talks = {c: new(c) for c in talks}
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    below = collections.defaultdict(lambda: [0, 0, 0])
    for node in members:
        if node:
            below[node[:-1]][0] += 1
    for node in members:
        saved = (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            below[node[:d]][1] += below[node][0] == 0
            below[node[:d]][2] += saved
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), *below[node], hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    )


def trie_rows(found):
    return sorted((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found.collect())


def talks(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, owner string, depth string").repartition(3)


def random_talks(seed, n):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-60, 4 * n), n):
        for turn in range(rng.choice([1, 1, 2, 3, 3, 4, 6, 9, 17])):
            rows.append((c, None if turn == 0 and rng.random() < 0.3 else turn, rng.choice(["user", "user", None]), rng.choice(["a", "a", "b c", None, "", "d\te f"]), "o", "d"))
    return rows


@pytest.mark.parametrize("share", [False, True])
@pytest.mark.parametrize("block", [4096, 3])
def test_trie_matches_brute_force(spark, share, block):
    rows = random_talks(block + share, 250)
    rows += [rows[0], rows[1], (None, 1, "user", "no conversation", "o", "d"), (10**15, 2, "user", "far", "o", "d"), (-(2**63), 1, "user", "a", "o", "d"), (2**63 - 1, 1, "user", "a", "o", "d")]
    rows += [(9000, t, "user", f"turn {t % 7}", "o", "d") for t in range(700)] + [(9001, t, "user", f"turn {t % 7}", "o", "d") for t in range(650)]  # long ones that go together
    rows += [(c, 1, "user", "the same " * 50, "o", "d") for c in range(20_000, 20_900)]  # one very common conversation
    assert trie_rows(prefix_trie.conversation_trie(talks(spark, rows), share=share, block=block)) == trie_expected(rows, share)


def test_trie_of_chains_that_hang_on_each_other(spark):
    rows = [(c, t, "user", f"{t}", "o", "d") for c in range(40) for t in range(c + 1)]
    assert trie_rows(prefix_trie.conversation_trie(talks(spark, rows))) == trie_expected(rows, False)


def test_trie_of_nothing(spark):
    assert trie_rows(prefix_trie.conversation_trie(talks(spark, []), share=True)) == []
    assert trie_rows(prefix_trie.conversation_trie(talks(spark, [(None, 1, "user", "x", "o", "d")]))) == []


def test_ends_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 100)
    rows = [(c, 1, "user", "x", "o", "d") for c in range(500)]
    assert trie_rows(prefix_trie.conversation_trie(talks(spark, rows))) == trie_expected(rows, False)


def test_op12_over_its_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert trie_rows(queries.queries()["op12_prefix_trie"](spark, SF)) == trie_expected(rows, True)


# prefix BPE


@pytest.fixture(scope="module")
def library():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=prefix_bpe.pattern(), mergeable_ranks=prefix_bpe.read_ranks(model_path(prefix_bpe.MODEL)), special_tokens={})


PIECES = ["a", "b", " ", "  ", "\n", "'s", "'ll", "'", "é", "ß", "中", "文", "क", "ा", "1", "23", ".", ",", "\t", "\x1c", "\x85", " ", "​", "　", "😀", "the", "ing", "ж", " т", "أ", "\r\n", "\x01", "\x02", "'r", "᠎", "́", "\U0001911c", "՘", "\U0001dfe8", "꟎", "İ", "ড়"]


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    out = ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(n)]
    out += ["".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x300, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(rng.randint(1, 20))) for _ in range(n)]
    out += ["".join(rng.choices("abcdeinorstu", k=rng.randint(1, 70))) for _ in range(n)]
    return [*out, "a" * 3000, "ab" * 2000, " " * 2000, "é" * 1500, "the" * 1500, "", "\n"]


@pytest.mark.parametrize("kind", ["model", "units"])
def test_prefix_tables_give_the_ids_of_the_library(library, kind):
    path, texts = model_path(prefix_bpe.MODEL), odd_texts(2000)
    encode = prefix_bpe.model(path).encode if kind == "model" else encoder(path, "prefixes").encode
    ids, n = encode(texts)
    got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert [t for t, a, b in zip(texts, got, library.encode_ordinary_batch(texts), strict=True) if a != b] == []
    assert b"".join(prefix_bpe.model(path).decode(ids, n)) == "".join(texts).encode()


def test_each_prefix_has_one_last_token(library):
    own = prefix_bpe.model(model_path(prefix_bpe.MODEL))
    for word in ["internationalisation", "Donaudampfschiff", "aaaaaaaaaaa", "развитие"]:
        data = word.encode()
        table = own.extend(data, [])
        tables = own.tables(np.frombuffer(data, np.uint8).astype(np.int64), np.array([len(data)]))
        assert table == tables.tolist()
        ranks = prefix_bpe.read_ranks(model_path(prefix_bpe.MODEL))
        assert [own.spelled[t] for t in table] == [prefix_bpe.merged(data[: i + 1], ranks)[-1] for i in range(len(data))]


def test_appends_and_edits_equal_encoding_anew(library):
    rng, own, texts = random.Random(2), prefix_bpe.model(model_path(prefix_bpe.MODEL)), odd_texts(300, 5)
    done = total = 0
    for _ in range(1500):
        held = prefix_bpe.PrefixText(own, rng.choice(texts))
        for _ in range(4):
            n = len(held.text)
            i = n if rng.random() < 0.3 else rng.randint(0, n)
            done += held.replace(i, min(n, i + rng.choice([0, 0, 1, 3])), "".join(rng.choices(PIECES, k=rng.randint(0, 3))))
            total += len(held.text.encode())
            assert held.ids() == library.encode_ordinary(held.text)
    assert done < total / 3
    long = prefix_bpe.PrefixText(own, "word and word, " * 5000)
    assert long.append("x") < 20 and long.replace(40_000, 40_004, "WORD") < 40
    assert long.ids() == library.encode_ordinary(long.text)


def test_tokens_that_no_merges_make_stand_for_their_word_only(tmp_path):
    import base64

    import tiktoken

    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"dda", b"abc", b"cd"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    own = prefix_bpe.PrefixModel(str(path))
    assert set(own.whole) == {b"dda"}
    library = tiktoken.Encoding("own", pat_str=prefix_bpe.pattern(), mergeable_ranks=prefix_bpe.read_ranks(str(path)), special_tokens={})
    texts = ["".join(random.Random(k).choices("abcd", k=k % 9)) for k in range(800)] + ["dda", "dda" * 20]
    ids, n = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == library.encode_ordinary_batch(texts)
    early = tmp_path / "early.tiktoken"  # abcd before abc, which makes it
    early.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate([*tokens[:256], b"ab", b"abcd", b"abc"])))
    with pytest.raises(ValueError, match="rank after"):
        prefix_bpe.PrefixModel(str(early))
    assert prefix_bpe.PrefixText(own, "dda dda").ids() == library.encode_ordinary("dda dda")


SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType()), T.StructField("ids", T.StringType())])


def test_op13_rows(spark, library):
    texts = [None, "", "one", "one", *odd_texts(60, 9), "long text. " * 20_000]
    rows = [(None if i == 2 else i // 2, t, "clash", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    def expected(d, t):
        ids = library.encode_ordinary(t or "")
        return d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in prefix_bpe.encode_decode(docs, digest=True).collect()]
    assert collections.Counter(got) == collections.Counter(expected(d, t) for d, t, *_ in rows)
    full = prefix_bpe.encode_decode(docs).collect()
    assert collections.Counter((tuple(r.ids), bytes(r.decoded)) for r in full) == collections.Counter((tuple(library.encode_ordinary(t or "")), (t or "").encode()) for t in texts)
    assert prefix_bpe.encode_decode(spark.createDataFrame([], SCHEMA)).collect() == []


def test_revised_documents(spark, library):
    edits = [[], None, [(0, 3, "The")], [(10**9, 0, " more"), (2, 1, None), (-4, 2, "x")], [(3, None, None)]]
    rows = [(i, t, e) for i, (t, e) in enumerate(zip(["one two", None, "the end", "some text's end", None], edits, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<start: long, stop: long, text: string>>")
    got = {r.doc_id: r for r in prefix_bpe.revise(docs).collect()}
    assert {i: r.text for i, r in got.items()} == {0: "one two", 1: "", 2: "The end", 3: "xme text's end more", 4: ""}
    assert all(list(r.ids) == library.encode_ordinary(r.text) and r.n_tokens == len(r.ids) for r in got.values())

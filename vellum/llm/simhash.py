"""SimHash near-duplicates found through Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits, and a segment
is read as a word of the perfect binary Golay code [23, 12, 7] (the last padded
with zeros). Its keys are the codewords within distance 4: one where the word is
within 2 of a codeword, six otherwise. Two words at distance 2 or less share a
key: a word midway between them is within 3 of its codeword, which is within 4 of
both. Let fingerprints differ in a, b, c bits of their segments, a + b + c <= 4:

* a segment that does not differ at all leaves at most 4 to the other two, so
  one of those differs in 2 or fewer: (equal segment, Golay key) meets;
* if every segment differs, each does in 2 or fewer, and the Golay keys of the
  first two segments meet together.

So keys of seven kinds lose no pair, and every meeting is verified on all bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import components, free, in_workers, local_roots, mix, runs, stage, text_bytes, tune

#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 generates the Golay code.
GENERATOR = 0b101011100011
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Fingerprints link at so many differing bits; the keys below are made for it.
RADIUS = 4
#: Members of a bucket that one task compares at once; larger buckets are cut into pairs of blocks.
BLOCK = 4096
#: Keys a fingerprint has at most: six kinds of 6 and one of 36.
MOST_KEYS = 72
#: Documents that show which shingles are common, and shingles that are told to every worker (12 MB).
SAMPLE, MOST_COMMON = 20_000, 1 << 20
#: One in so many shingles is a key beside those that a prefix needs, so that similar documents share many.
EXTRA = 10


def fingerprint(text: bytes | None, words: int = 4, seed: int = 42) -> int:
    """SimHash of the ``words``-word shingles of a lower-cased text, repeats counted.

    A bit is set where it is set in over half the shingles' XXH64. Fewer words
    make one shingle; none make fingerprint 0.
    """
    w = (text or b"").translate(LOWER).split()
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)) if len(w) > words else [b" ".join(w)]
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(h), 65536):
        set_bits += np.unpackbits(h[k : k + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """Rows (doc_id, fp) of ``docs`` (doc_id, text); fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words, seed) for t in text_bytes(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return in_workers(docs.select("doc_id", "text"), run, "doc_id long, fp long")


@cache
def golay() -> tuple[np.ndarray, np.ndarray]:
    """The syndrome of each byte at each of three places, and the error patterns of each syndrome.

    Patterns have 4 bits at most: one a syndrome, or six; -1 where there is none.
    """
    unit = []
    for i in range(23):
        r = 1 << i
        for j in range(22, 10, -1):
            if r >> j & 1:
                r ^= GENERATOR << (j - 11)
        unit.append(r)
    syndromes = np.zeros((3, 256), np.int64)
    for place in range(3):
        for v in range(256):
            for bit in range(8):
                if v >> bit & 1 and 8 * place + bit < 23:
                    syndromes[place, v] ^= unit[8 * place + bit]
    patterns: list[list[int]] = [[] for _ in range(2048)]

    def grow(first: int, left: int, pattern: int, syndrome: int) -> None:
        patterns[syndrome].append(pattern)
        for i in range(first, 23 if left else 0):
            grow(i + 1, left - 1, pattern | 1 << i, syndrome ^ unit[i])

    grow(0, 4, 0, 0)
    return syndromes, np.array([p + [-1] * (6 - len(p)) for p in patterns])


def golay_keys(segment: np.ndarray) -> np.ndarray:
    """The indices (12 bits) of the codewords within 4 of each 23-bit word: six columns, -1 where there is none."""
    syndromes, patterns = golay()
    s = syndromes[0, segment & 255] ^ syndromes[1, segment >> 8 & 255] ^ syndromes[2, segment >> 16 & 255]
    e = patterns[s]
    return np.where(e < 0, -1, (segment[:, None] ^ e) >> 11)


def keys(fp: np.ndarray, joint: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All keys of unsigned fingerprints, or only those that join two Golay keys: the place of the fingerprint in ``fp``, and the key."""
    f = fp.astype(np.uint64)
    a = (f & np.uint64(0x7FFFFF)).astype(np.int64)
    b = (f >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64)
    c = (f >> np.uint64(46)).astype(np.int64)
    ga, gb, gc = golay_keys(a), golay_keys(b), golay_keys(c)
    n = np.arange(len(f))
    whose, key = [], []
    for kind, (exact, g) in enumerate([] if joint else [(c, ga), (c, gb), (a, gb), (a, gc), (b, ga), (b, gc)]):
        i, j = np.nonzero(g >= 0)
        whose.append(n[i])
        key.append(kind << 40 | exact[i] << 12 | g[i, j])
    i, j, k = np.nonzero((ga >= 0)[:, :, None] & (gb >= 0)[:, None, :])
    whose.append(n[i])
    key.append(6 << 40 | ga[i, j] << 12 | gb[i, k])
    return np.concatenate(whose), np.concatenate(key)


def bucket_links(f: np.ndarray, radius: int, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``radius`` among the fingerprints ``f`` of one bucket, as places (earlier, later).

    As a ``forest`` they join what all links join. Otherwise each member gets its
    link to the first of those before it: in a large group of near copies one link a member.
    """
    u, v, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for i in range(0, len(f), 512):
        apart = np.bitwise_count(f[i : i + 512, None] ^ f[None, : i + 512])
        apart[np.arange(len(apart))[:, None] + i <= np.arange(apart.shape[1])] = 255
        if forest:
            y, x = np.nonzero(apart <= radius)
        else:
            y = np.flatnonzero((apart <= radius).any(1))
            x = (apart[y] <= radius).argmax(1)
        u.append(x)
        v.append(y + i)
        held += len(x)
        if forest and held > 1 << 20:  # pairs never pile up: a forest says the same
            u, v = ([z] for z in as_forest(len(f), np.concatenate(u), np.concatenate(v)))
            held = len(u[0])
    return np.concatenate(u), np.concatenate(v)


def as_forest(n: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    nodes = np.arange(n)
    root = local_roots(nodes, u, v)
    on = root != nodes
    return root[on], nodes[on]


LINKS = "over boolean, a long, b long, fp long"


def link(batches: Iterator[pa.RecordBatch], radius: int, most: int, forest: bool = True, spill: bool = True) -> Iterator[pa.RecordBatch]:
    """Over rows (key, node, fp) sorted by key: rows (over, a, b, fp), links of nodes (a, b) of a bucket.

    A bucket of more than ``most`` members is passed on as rows (True, key, node,
    fp), if ``spill``; so no more than ``most`` members and a batch are ever held.
    Links are as in ``bucket_links``: a forest that joins what all links join, or
    each member's link to the first of those before it.
    """

    def out(over: bool, a: np.ndarray, b: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), over)), pa.array(a), pa.array(b), pa.array(fp)], ["over", "a", "b", "fp"])

    def solve(key: np.ndarray, node: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        f = fp.view(np.uint64)
        i = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= 64), sizes))
        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lag in range(1, 64):
            i = i[i + lag < len(key)]
            i = i[key[i] == key[i + lag]]
            if not len(i):
                break
            near = i[np.bitwise_count(f[i] ^ f[i + lag]) <= radius]
            u.append(near)
            v.append(near + lag)
        if not forest:
            x, y = np.concatenate(u), np.concatenate(v)
            order = np.lexsort((x, y))
            pick = order[np.r_[True, np.diff(y[order]) > 0]] if len(order) else order
            u, v = [x[pick]], [y[pick]]
        for s, n in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
            x, y = bucket_links(f[s : s + n], radius, forest)
            u.append(x + s)
            v.append(y + s)
        a, b = node[np.concatenate(u)], node[np.concatenate(v)]
        a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
        if not len(a):
            return
        if forest:
            nodes = np.unique(np.r_[a, b])
            root = local_roots(nodes, a, b)
            a, b = root[root != nodes], nodes[root != nodes]
        else:
            a, b = np.unique(np.stack([a, b]), axis=1)
        yield out(False, a, b, np.zeros(len(a), np.int64))

    held, over = [np.zeros(0, np.int64)] * 3, None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if over is not None:
            n = np.searchsorted(new[0], over, side="right")
            if n:
                yield out(True, *(x[:n] for x in new))
            new = [x[n:] for x in new]
            if not len(new[0]):
                continue
            over = None
        rows = [np.r_[x, y] for x, y in zip(held, new, strict=True)]
        key = rows[0]
        if not len(key):
            continue
        last = np.searchsorted(key, key[-1])  # the last bucket may go on
        starts = np.flatnonzero(np.r_[True, key[1:last] != key[: max(0, last - 1)]]) if last else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[starts, last])
        large = np.repeat(sizes > most, sizes) & spill
        done = [x[:last] for x in rows]
        if large.any():
            yield out(True, *(x[large] for x in done))
        yield from solve(*(x[~large] for x in done))
        held = [x[last:] for x in rows]
        if spill and len(held[0]) > most:
            yield out(True, *held)
            over, held = held[0][0], [x[:0] for x in held]
    if len(held[0]):
        yield from solve(*held)


def linked(nodes: DataFrame, fps: list[str], radius: int = RADIUS, block: int = BLOCK, forest: bool = True, joint: bool = False) -> DataFrame:
    """Links (a, b) of ``nodes`` (node, and a fingerprint a column of ``fps``) that differ by ``radius`` in any of them.

    Each column has keys of its own. With all keys ``radius`` is 4 at most and no
    pair is missed; ``joint`` keys alone are half as many and find those that
    differ in 2 bits or fewer of the first segment and of the second, whatever
    the radius. A forest joins what all links join.
    """
    if not joint and not 0 <= radius <= RADIUS:
        raise ValueError(f"the keys find links of {RADIUS} bits at most")
    spark = nodes.sparkSession

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = b.column(0).to_numpy(zero_copy_only=False)
            for k in range(len(fps)):
                fp = b.column(k + 1).to_numpy(zero_copy_only=False)
                whose, key = keys(fp.view(np.uint64), joint)
                yield pa.RecordBatch.from_arrays([pa.array(key | k << 44), pa.array(node[whose]), pa.array(fp[whose])], ["key", "node", "fp"])

    wide = MOST_KEYS * len(fps) * nodes.count() // 4_000_000
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wide)
    gathered = lambda d: d.repartition(parts, "key").sortWithinPartitions("key", "node")
    keyed = gathered(in_workers(nodes.select("node", *fps), spread, "key long, node long, fp long"))
    met = stage(in_workers(keyed, lambda it: link(it, radius, block, forest), LINKS), "simhash-links")
    edges = met.where("not over").select("a", "b")
    over = met.where("over").select(F.col("a").alias("key"), F.col("b").alias("node"), "fp")
    if not over.isEmpty():
        sizes = over.groupBy("key").agg(F.ceil(F.count("*") / (block // 2)).cast("int").alias("blocks"), F.min(F.struct("node", "fp")).alias("low"))
        sizes = stage(sizes, "simhash-sizes")
        dealt = over.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        if forest:
            # Each pair of a bucket's blocks is a bucket of its own: all pairs are compared, by many tasks.
            dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        else:
            # Links are suggestions: each block is a bucket of its own, with the first member of the whole bucket.
            first = sizes.select("key", F.col("low.node").alias("node"), F.col("low.fp").alias("fp"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("mine"))
            dealt = dealt.select("key", "node", "fp", "mine").union(first).withColumn("other", F.col("mine"))
        pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key")
        again = gathered(dealt.select(pair, "node", "fp"))
        edges = edges.union(in_workers(again, lambda it: link(it, radius, block, forest, spill=False), LINKS).select("a", "b"))
    return edges


def similar_fingerprints(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Components of distinct fingerprints (fp) under links of ``radius`` (at most 4): rows (node, root)."""
    edges = linked(distinct.select(F.col("fp").alias("node"), "fp"), ["fp"], radius, block)
    return components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")), "simhash-components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, radius: int = RADIUS, block: int = BLOCK
) -> DataFrame:
    """One row a document: doc_id, fp, component_id (the least id of what it reaches, itself included).

    Null, blank and empty texts have fingerprint 0 and link like any other.
    Equal fingerprints are one node, so copies are never compared. Ids may
    repeat; a null id takes part and gets the least id of its component. Other
    columns are not read; an empty table gives no rows.
    """
    tune(docs.sparkSession)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stage(fingerprints(d, words), "simhash-fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash-classes")
    roots = similar_fingerprints(classes.select("fp"), radius, block)
    rooted = stage(classes.join(roots, F.col("fp") == F.col("node")).select("fp", "low", "root"), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    joined = rooted.join(least, "root").select("fp", "component_id")
    # A table: its side of the join below is shuffled like any other, so that a hot fingerprint's rows can be split.
    ids = stage(
        classes.join(joined, "fp", "left").select(F.col("fp").alias("class_fp"), F.coalesce("component_id", "low").alias("component_id")), "simhash-ids"
    )
    return rows.join(ids, F.col("fp") == F.col("class_fp")).select("doc_id", "fp", "component_id")


def word_views(text: bytes | None, views: int) -> list[int]:
    """``views`` independent SimHashes of the set of lower-cased words of a text; 0 where there are none."""
    w = {*(text or b"").translate(LOWER).split()}
    if not w:
        return [0] * views
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    out = []
    for k in range(views):
        bits = np.unpackbits(mix(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (1 << 64) - 1)).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(2 * bits > len(h), bitorder="little").view(np.int64)[0]))
    return out


def shingle_set(text: str | None, words: int) -> set[bytes]:
    w = (text or "").encode().translate(LOWER).split()
    return {b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def similarity(a: str | None, b: str | None, words: int = 5) -> float:
    """Jaccard similarity of the sets of ``words``-word shingles; two texts without words are alike."""
    x, y = shingle_set(a, words), shingle_set(b, words)
    return len(x & y) / len(x | y) if x or y else 1.0


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """The distinct 64-bit hashes of the ``words``-word shingles of ``shingle_set``, ascending; one fixed hash for a text without words."""
    w = (text or b"").translate(LOWER).split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w)) if w else np.zeros(1, np.uint64)
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n if w else 0, np.uint64)
    for k in range(n):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + k + 1])
    return np.unique(out)


def rare_first(h: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``h`` in the order that all documents share: by the count of those in ``common`` (ascending), the others before them, then by hash."""
    if not len(common):
        return h
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return h[np.argsort(np.where(common[at] == h, counts[at], 0), kind="stable")]


def common_shingles(d: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (ascending) that a sample of about ``SAMPLE`` documents repeats, and in how many; ``MOST_COMMON`` at most.

    They only set the order of shingles, so a sample costs time and no pair.
    """
    n = -(-d.count() // SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in runs(texts := text_bytes(b.column(0))):
                h = np.concatenate([shingle_hashes(t, words) for t in texts[i:j]])
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    some = d.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n))) == 0).select("text")
    counted = in_workers(some, run, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    found = counted.orderBy(F.desc("n"), "h").limit(MOST_COMMON).toArrow()
    h, counts = found.column("h").to_numpy().view(np.uint64), found.column("n").to_numpy().astype(np.int32)
    order = np.argsort(h)
    return h[order], counts[order]


def prefix(n: np.ndarray, least: float) -> np.ndarray:
    """How many of a document's n shingles, in the shared order, are its keys; see ``sharing``."""
    return np.minimum(n, n - np.ceil(least * n - 1e-6).astype(np.int64) + 1 + n // EXTRA)


def beyond(m: np.ndarray, n: np.ndarray, least: float) -> np.ndarray:
    """The shingles that similar documents of m and n shingles share, at least."""
    return np.ceil(least / (1 + least) * (m + n) - 1e-6).astype(np.int64)


def shared_keys(m: np.ndarray, n: np.ndarray, least: float) -> np.ndarray:
    """How many keys similar documents of m and n shingles share, at least; see ``sharing``."""
    return np.maximum(1, beyond(m, n, least) - np.maximum(m - prefix(m, least), n - prefix(n, least)))


def early(size: np.ndarray, at: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether a key that documents i and j have at their places ``at`` can be the first that they share, if they are similar."""
    m, n = size[i], size[j]
    over = beyond(m, n, least)
    return (np.minimum(m, n) >= least * np.maximum(m, n) - 1e-6) & (at[i] <= m - over) & (at[j] <= n - over)


MET = "key long, node long, root long, place long"  # place: size << 32 | number of the key


def mixed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of rows (key, node, root, place) sorted by key and root those in buckets of two roots or more; also runs of one root longer than ``most``."""
    names = ["key", "node", "root", "place"]
    held, open_ = [np.zeros(0, np.int64)] * 4, False  # the last bucket, and whether its rows go on at once
    for batch in batches:
        if not batch.num_rows:
            continue
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        if open_:
            n = len(new[0]) if len(held[0]) == 0 and new[0][-1] == last_key else int(np.searchsorted(new[0], last_key, side="right"))
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(x[:n]) for x in new], names)
            new = [x[n:] for x in new]
            if not len(new[0]):
                continue
            open_ = False
        rows = [np.r_[x, y] for x, y in zip(held, new, strict=True)]
        starts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
        sizes = np.diff(np.r_[starts, len(rows[0])])
        two = rows[2][starts] != rows[2][starts + sizes - 1]
        last_key = rows[0][-1]
        open_ = bool(two[-1]) or sizes[-1] > most
        two[-1] = open_
        on = np.repeat(two, sizes)
        if on.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[on]) for x in rows], names)
        held = [x[:0] if open_ else x[starts[-1] :] for x in rows]


def stars(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Over rows (key, node, root, place) sorted by key and root: rows (node, other), the first member of each root with that of the bucket's first root and of the root before."""
    held = [np.zeros(0, np.int64)] * 4  # of the last bucket the first member of its first and of its last root
    for batch in batches:
        rows = [np.r_[x, batch.column(i).to_numpy(zero_copy_only=False)] for i, x in enumerate(held)]
        key, node, root, place = rows
        if not len(key):
            continue
        reps = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (root[1:] != root[:-1])])
        begins = np.r_[True, key[reps][1:] != key[reps][:-1]]
        first = reps[np.maximum.accumulate(np.where(begins, np.arange(len(reps)), 0))]
        later = np.flatnonzero(~begins)
        i, j = np.r_[reps[later], reps[later]], np.r_[first[later], reps[later - 1]]
        on = (node[i] != node[j]) & early(place >> 32, place & 0xFFFFFFFF, i, j, least)
        yield pa.RecordBatch.from_arrays([pa.array(node[i[on]]), pa.array(node[j[on]])], ["node", "other"])
        held = [x[np.unique([first[-1], reps[-1]])] for x in rows]


def meetings(batches: Iterator[pa.RecordBatch], least: float, most: int, spill: bool = True) -> Iterator[pa.RecordBatch]:
    """Over rows (key, node, root, place) sorted by key and root: rows (over, a, b, root, place), pairs (a, b) of two roots for which the key is ``early``.

    Rows may also have how many keys the node has and marks of them, by which pairs
    that share too few are known; see ``met_pairs``. A bucket of more than ``most`` members is passed on as rows (True, key,
    node, root, place), if ``spill``. All pairs of the others are looked at,
    but for those of one root.
    """

    def out(over: bool, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(columns[0]), over)), *map(pa.array, columns)], ["over", "a", "b", "root", "place"])

    def pairs(rows: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(i), 1 << 16):
            yield from some_pairs(rows, i[k : k + (1 << 16)], j[k : k + (1 << 16)])

    def some_pairs(rows: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, place = rows[1], rows[3]
        on = node[i] != node[j]
        if len(rows) > 4:  # marks of all keys: a mark that only one has is a key at least that only it has
            x, y = (np.stack([c[k].view(np.uint64) for c in rows[5:]], 1) for k in (i, j))
            needed = shared_keys(place[i] >> 32, place[j] >> 32, least)
            on &= (rows[4][i] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64) >= needed) & (rows[4][j] - np.bitwise_count(y & ~x).sum(1, dtype=np.int64) >= needed)
        i, j = i[on], j[on]
        if not len(i):
            return
        a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        yield out(False, a[new], b[new], np.zeros(len(new), np.int64), np.zeros(len(new), np.int64))

    def solve(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, _, root, place, *_ = rows
        size, at = place >> 32, place & 0xFFFFFFFF
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        several = root[starts] != root[starts + sizes - 1]  # sorted: one root where the ends agree
        i = np.flatnonzero(np.repeat(several & (sizes <= 64), sizes))
        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for lag in range(1, 64):
            i = i[i + lag < len(key)]
            i = i[key[i] == key[i + lag]]
            if not len(i):
                break
            some = i[root[i] != root[i + lag]]
            some = some[early(size, at, some, some + lag, least)]
            u.append(some)
            v.append(some + lag)
        yield from pairs(rows, np.concatenate(u), np.concatenate(v))
        for s, n in zip(starts[several & (sizes > 64)], sizes[several & (sizes > 64)], strict=True):
            ends = s + np.searchsorted(root[s : s + n], root[s : s + n], side="right")
            for k in range(s, s + n, 256):
                x = np.arange(k, min(k + 256, s + n))
                if (first := ends[k - s]) == s + n:
                    break
                y = np.arange(first, s + n)
                p, q = np.nonzero((y[None, :] >= ends[x - s][:, None]) & early(size, at, x[:, None], y[None, :], least))
                yield from pairs(rows, x[p], y[q])

    held, over = None, None
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if over is not None:
            n = np.searchsorted(new[0], over, side="right")
            if n:
                yield out(True, *(x[:n] for x in new[:4]))
            new = [x[n:] for x in new]
            if not len(new[0]):
                continue
            over = None
        rows = new if held is None else [np.r_[x, y] for x, y in zip(held, new, strict=True)]
        key = rows[0]
        if not len(key):
            continue
        last = np.searchsorted(key, key[-1])  # the last bucket may go on
        if last:
            yield from solve([x[:last] for x in rows])
        held = [x[last:] for x in rows]
        if spill and len(held[0]) > most:
            yield out(True, *held[:4])
            over, held = held[0][0], [x[:0] for x in held]
    if held is not None and len(held[0]):
        yield from solve(held)


MEETINGS = "over boolean, a long, b long, root long, place long"


def by_key(rows: DataFrame) -> DataFrame:
    """Rows (key, node, root, place) with those of a key together, in order of root and node."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism), "key").sortWithinPartitions("key", "root", "node")


def shared(d: DataFrame, found: DataFrame, words: int, least: float, block: int = BLOCK) -> DataFrame:
    """Rows (key, node, root, place), a table: the keys that documents of two roots of ``found`` (node, root) have. See ``sharing``."""
    spark = d.sparkSession
    common = spark.sparkContext.broadcast(common_shingles(d, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = text_bytes(b.column(1))
            for i, j in runs(texts):
                sets = [shingle_hashes(t, words) for t in texts[i:j]]
                sizes = np.array([len(h) for h in sets], np.int64)
                first = [rare_first(h, *common.value)[:n] for h, n in zip(sets, prefix(sizes, least), strict=True)]
                ends = np.cumsum([0, *map(len, first)], dtype=np.int32)
                keyed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first).view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), pa.array(sizes), keyed], ["doc_id", "size", "keys"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lens = np.diff(b.column(2).offsets.to_numpy())
            node, root, size = (np.repeat(b.column(k).to_numpy(zero_copy_only=False), lens) for k in (0, 3, 1))
            at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
            yield pa.RecordBatch.from_arrays([b.column(2).flatten(), pa.array(node), pa.array(root), pa.array(size << 32 | at)], ["key", "node", "root", "place"])

    firsts = in_workers(d.select("doc_id", "text"), run, "doc_id long, size long, keys array<long>")
    rooted = firsts.join(found, F.col("doc_id") == F.col("node"), "left").select("doc_id", "size", "keys", F.coalesce("root", "doc_id").alias("root"))
    wide = 200 * d.count() // 1_500_000
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wide)
    keyed = in_workers(rooted, spread, MET).repartition(parts, "key").sortWithinPartitions("key", "root")
    return stage(in_workers(keyed, lambda it: mixed(it, block), MET), "similar-shared")


def narrowed(several: DataFrame) -> DataFrame:
    """Of ``shared`` rows those of documents that have enough keys in common with others, a table; ``several`` is freed."""
    enough = several.groupBy(F.col("node").alias("enough")).agg(F.count("*").alias("n"), F.shiftright(F.max("place"), 32).alias("of"))
    enough = stage(enough.where(F.col("n") >= F.greatest(F.lit(1), F.floor(F.col("of") / EXTRA))).select("enough"), "similar-enough")
    left = stage(several.join(enough, F.col("node") == F.col("enough")).select("key", "node", "root", "place"), "similar-left")
    free(several, enough)
    return left


def likely(left: DataFrame, least: float) -> DataFrame:
    """A pair (a, b) a document at most: it with the one that it meets most often among the first members of its keys' roots."""
    votes = in_workers(by_key(left), lambda it: stars(it, least), "node long, other long").groupBy("node", "other").agg(F.count("*").alias("n"))
    return votes.groupBy(F.col("node").alias("a")).agg(F.max_by("other", F.struct("n", "other")).alias("b")).select("a", "b")


def again(left: DataFrame, found: DataFrame, block: int = BLOCK) -> DataFrame:
    """``left`` under the roots of ``found`` (node, root), without the keys that one root has alone; ``left`` is freed."""
    now = left.join(found.select(F.col("node").alias("of"), F.col("root").alias("now")), F.col("node") == F.col("of"), "left")
    several = stage(in_workers(by_key(now.select("key", "node", F.coalesce("now", "root").alias("root"), "place")), lambda it: mixed(it, block), MET), "similar-shared")
    free(left)
    return narrowed(several)


def met_pairs(left: DataFrame, least: float, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of documents of two roots that share as many keys as similar ones do."""
    # Each document's keys as marks among 512 bits: they bound from above how many keys two documents share.
    spot = F.pmod(F.xxhash64("key"), F.lit(512)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), spot % 64)
    marks = left.groupBy(F.col("node").alias("of")).agg(
        F.count("*").alias("keys"), *(F.coalesce(F.bit_or(F.when(F.floor(spot / 64) == k, bit)), F.lit(0).cast("long")).alias(f"mark{k}") for k in range(8))
    )
    marked = left.join(stage(marks, "similar-marks"), F.col("node") == F.col("of")).drop("of")
    met = stage(in_workers(by_key(marked), lambda it: meetings(it, least, block), MEETINGS), "similar-meetings")
    pairs = met.where("not over").select("a", "b")
    over = met.where("over").select(F.col("a").alias("key"), F.col("b").alias("node"), "root", "place")
    if not over.isEmpty():
        sizes = over.groupBy("key").agg(F.ceil(F.count("*") / (block // 2)).cast("int").alias("blocks"), F.min("root").alias("low"), F.max("root").alias("high"))
        sizes = stage(sizes.where("low < high").select("key", "blocks"), "similar-sizes")
        dealt = over.join(sizes, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        pair = F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("key")
        parted = by_key(dealt.select(pair, "node", "root", "place"))
        pairs = pairs.union(in_workers(parted, lambda it: meetings(it, least, block, spill=False), MEETINGS).select("a", "b"))
    return pairs.distinct()


def sharing(d: DataFrame, found: DataFrame, words: int, least: float, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of ``d`` (doc_id, text) that can have a Jaccard similarity of ``least``, less those that ``found`` (node, root) joins: none is missed.

    A document's keys are the first n - ceil(least * n) + 1 of its n shingles, and
    a tenth of n more, in an order that all documents share, rare ones first. Of m
    shingles a similar document lacks m - ``beyond`` at most, so the first shingle
    that both have is among the first m - ``beyond`` + 1 of either, and they meet
    there. Let the keys of one of the two end first in that order: what they share
    up to there are keys of both, and what they share beyond is among its other
    shingles. So they share ``shared_keys`` keys, about a tenth of the larger size
    at least. That drops first the documents that have fewer keys in common with
    all others together, as those do which only share a passage, and then pairs
    whose marks show that they have fewer in common. A bucket with too many
    members is cut into pairs of blocks, like those of fingerprints.
    """
    return met_pairs(narrowed(shared(d, found, words, least, block)), least, block)


def verified(d: DataFrame, pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Those of ``pairs`` (a, b) of ``d`` (doc_id, text) whose texts have a similarity of ``least``: rows (u, v)."""
    pairs = stage(pairs, "similar-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = stage(d.join(ids, F.col("doc_id") == F.col("id"), "left_semi"), "similar-texts")
    both = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similarity(x, y, words) >= least for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["u", "v"]).filter(pa.array(ok, pa.bool_()))

    return in_workers(both.select("a", "b", "x", "y"), verify, "u long, v long")


def similar_documents(docs: DataFrame, words: int = 5, least: float = 0.8, views: int = 4, radius: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, component_id) of documents that near duplicates join, component_id the least id of each group.

    Near duplicates share ``least`` of their ``words``-word shingles (Jaccard).
    Few changed words change many shingles but few words, so candidates come from
    SimHashes of the words: links of ``radius`` bits in any of several independent
    views, found through joint Golay keys. A document is a candidate of the least
    id within the radius in each of its buckets, so a group of many copies gives a few pairs a member. What these join is one group already
    when the rest is looked for: ``sharing`` finds every pair of two groups that can
    reach the limit. Every candidate pair is verified on whole texts. So no pair is
    missed, up to collisions of 64-bit hashes. Rows that share an id stand
    together; rows with a null id are left out; other columns are not read.
    """
    tune(docs.sparkSession)
    fps = [f"f{k}" for k in range(views)]
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([word_views(t, views) for t in text_bytes(b.column(1))], np.int64).reshape(b.num_rows, views)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, k]) for k in range(views))], ["doc_id", *fps])

    rows = stage(in_workers(d, run, "doc_id long, " + ", ".join(f"{f} long" for f in fps)), "similar-views")
    # Documents alike in all views are one node; each is also a candidate of the node's least id.
    nodes = stage(rows.groupBy(*fps).agg(F.min("doc_id").alias("node")), "similar-nodes")
    same = rows.join(nodes, fps).where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    joined = verified(d, linked(nodes, fps, radius, forest=False, joint=True).union(same).distinct(), words, least)
    free(rows, nodes)
    found = stage(components(joined, "similar-components"), "similar-found")
    # Documents of one group that the SimHashes left apart join it by one likely partner each, before all that still meet are compared.
    left = narrowed(shared(d, found, words, least))
    found = merged(found, verified(d, likely(left, least), words, least))
    left = again(left, found)
    found = merged(found, verified(d, met_pairs(left, least), words, least))
    return found.select(F.col("node").alias("doc_id"), F.col("root").alias("component_id"))


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, root), a table, of ``found`` with ``links`` (u, v) more; ``found`` is freed."""
    links = stage(links, "similar-more")
    if links.isEmpty():
        free(links)
        return found
    joined = components(links.union(found.select(F.col("node").alias("u"), F.col("root").alias("v"))), "similar-components")
    joined = stage(joined, "similar-found")
    free(found, links)
    return joined

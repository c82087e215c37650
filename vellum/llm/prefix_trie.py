"""The trie of shared conversation prefixes, as chains of nodes that one conversation owns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import free, stage, tune

#: Sums along a conversation are taken in blocks of so many turns, so that a very long one is many tasks.
BLOCK = 4096
#: Conversations of one stretch of so many ids share their first turns when they are rebuilt; at most three of them.
STRETCH, MOST_SHARED = 20, 3
#: Bytes of the ids that one row of ``ends`` holds.
CHUNK = 1 << 18
LOW = (1 << 32) - 1


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, place from 1, digest of role and text, words) in their order, and conversations (conv_id, n).

    Texts are left behind: what is sorted are rows of a few numbers, in ranges, so
    that a very long conversation is spread over tasks. A row's number in its
    range and the rows of the conversation in earlier ranges give its place.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    narrow = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    narrow = stage(narrow, "trie-narrow")  # ranges are found by a look at all rows: at these, not at the texts
    order = ["conv_id", "turn", "digest"]
    sorted_rows = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    ranged = stage(sorted_rows.select("conv_id", "digest", "words", "at"), "trie-ranged")
    free(narrow)
    table, ranged = ranged, ranged.withColumn("part", F.shiftright("at", 33))
    parts = ranged.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row a range
    parts = parts.withColumn("before", F.coalesce(before, F.lit(0)))
    turns = ranged.join(parts.select("conv_id", "part", "first", "before"), ["conv_id", "part"])
    held = stage(turns.select("conv_id", (F.col("at") - F.col("first") + F.col("before") + 1).alias("place"), "digest", "words"), "trie-turns")
    convs = stage(parts.groupBy("conv_id").agg(F.sum("n").alias("n")), "trie-convs")
    free(table)
    return held, convs


def rebuilt(turns: DataFrame, convs: DataFrame, stretch: int = STRETCH, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their first turns: turns (conv_id, depth, digest, words) and conversations (conv_id, length).

    The first h turns of conversation c come from the first one of its stretch of
    ids (all if it has fewer, none if there is none), the rest are its own after
    its first h; h is the crc32 of the decimal id modulo ``most`` + 1.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % (most + 1)
    known = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % stretch).alias("base"))
    k = F.least("h", F.coalesce("base_n", F.lit(0)))
    shared = known.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left").withColumn("k", k)
    plan = stage(shared.select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "trie-plan")
    own = turns.join(plan.select("conv_id", "h", "k"), "conv_id").where("place > h").select("conv_id", (F.col("k") + F.col("place") - F.col("h")).alias("depth"), "digest", "words")
    heads = turns.where(F.col("place") <= most).select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "digest", "words")
    first = plan.where("k > 0").select("conv_id", "base", "k").join(heads, "base").where("depth <= k").select("conv_id", "depth", "digest", "words")
    return own.unionByName(first), plan.select("conv_id", "length")


def running(rows: DataFrame, key: str, place: str, sums: list[str], block: int, longest: int, down: bool = False) -> DataFrame:
    """``rows`` with running sums of ``sums`` along ``place`` from 0 or more in each ``key``, upwards or ``down`` from the end.

    Within a block a window adds up; what other blocks bring is a row a block.
    """
    b = F.expr(f"{place} div {block}")
    blocked = rows.withColumn("_b", b)
    toward = F.col(place).desc() if down else F.col(place).asc()
    inside = Window.partitionBy(key, "_b").orderBy(toward).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = blocked.select(*(c for c in blocked.columns if c not in sums), *(F.sum(c).over(inside).alias(c) for c in sums))
    if longest < block:  # one block each
        return out.drop("_b")
    totals = blocked.groupBy(key, "_b").agg(*(F.sum(c).alias(c) for c in sums))
    others = Window.partitionBy(key).orderBy(F.col("_b").desc() if down else F.col("_b").asc()).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(key, "_b", *(F.sum(c).over(others).alias(f"_{c}") for c in sums))
    joined = out.join(carried, [key, "_b"], "left")
    return joined.select(*(c for c in rows.columns if c not in sums), *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums))


def prefixes(turns: DataFrame, block: int, longest: int) -> DataFrame:
    """The digest (p1, p2) of each prefix of each conversation.

    A turn at a depth is a random number of 128 bits, a prefix the sum of those of
    its turns; sums of limbs of 32 bits do not overflow and can be taken in blocks.
    """
    a, b = F.xxhash64("depth", "digest"), F.xxhash64("digest", "depth", F.lit(1))
    limbs = [f(x) for x in (a, b) for f in (lambda c: F.shiftrightunsigned(c, 32), lambda c: c.bitwiseAND(F.lit(LOW)))]
    summed = running(turns.select("conv_id", "depth", "words", *(c.alias(f"s{i}") for i, c in enumerate(limbs))), "conv_id", "depth", [f"s{i}" for i in range(4)], block, longest)

    def whole(i: int) -> Column:
        return F.shiftleft(F.col(f"s{i}").bitwiseAND(F.lit(LOW)), 32).bitwiseOR(F.col(f"s{i + 1}").bitwiseAND(F.lit(LOW)))

    return summed.select("conv_id", "depth", "words", whole(0).alias("p1"), whole(2).alias("p2"))


def level(depth: str) -> Column:
    """How often ``depth`` can be halved: the step of the search that asks about it."""
    return F.bit_count(F.expr(f"({depth} & -{depth}) - 1"))


def first_owned(known: DataFrame, minima: DataFrame, convs: DataFrame, least: int, longest: int) -> DataFrame:
    """conv_id, length, g (the deepest prefix that another conversation owns), up (who owns it).

    A prefix belongs to the least conversation that starts with it; who owns a
    prefix owns all its longer ones. So g is found by halving, all conversations a
    step at once. A step of 2^k asks about depths with just k factors of two, so
    that all steps together read each prefix once.
    """
    state = convs.select("conv_id", "length", F.lit(0).cast("long").alias("g"), F.lit(least).cast("long").alias("up"))
    held = []
    for k in range(longest.bit_length() - 1, -1, -1):
        step = 1 << k
        asked = known.where(level("depth") == k).select(F.col("conv_id").alias("c"), F.col("depth").alias("d"), "p1", "p2")
        owners = minima.where(level("depth") == k).select(F.col("depth").alias("od"), F.col("p1").alias("o1"), F.col("p2").alias("o2"), "owner")
        probed = state.join(asked, (F.col("conv_id") == F.col("c")) & (F.col("g") + step == F.col("d")), "left")
        # who is not asked takes no common key with others
        key = [F.coalesce("d", F.lit(-1)), F.coalesce("p1", "conv_id"), F.coalesce("p2", F.lit(0))]
        probed = probed.select("conv_id", "length", "g", "up", *(c.alias(n) for n, c in zip(("kd", "k1", "k2"), key, strict=True)))
        met = probed.join(owners, (F.col("kd") == F.col("od")) & (F.col("k1") == F.col("o1")) & (F.col("k2") == F.col("o2")), "left")
        other = F.col("owner").isNotNull() & (F.col("owner") != F.col("conv_id"))
        state = met.select("conv_id", "length", F.when(other, F.col("g") + step).otherwise(F.col("g")).alias("g"), F.when(other, F.col("owner")).otherwise(F.col("up")).alias("up"))
        if k % 3 == 0:
            state = stage(state, "trie-state")
            held.append(state)
    free(*held[:-1])
    return state if held else stage(state, "trie-state")


def chain_totals(chains: DataFrame, own: DataFrame) -> DataFrame:
    """conv_id, leaves, saved of all nodes below and on each chain, in rounds that double how far sums have come."""
    t = stage(chains.select("conv_id", F.col("up").alias("to")).join(own, "conv_id"), "trie-totals")
    while not (open_rows := t.where("to is not null")).isEmpty():
        more = open_rows.groupBy(F.col("to").alias("c")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        ahead = open_rows.select(F.col("conv_id").alias("c2"), F.col("to").alias("mid")).join(open_rows.select(F.col("conv_id").alias("mid"), F.col("to").alias("far")), "mid").select("c2", "far")
        joined = t.join(more, F.col("conv_id") == F.col("c"), "left").join(ahead, F.col("conv_id") == F.col("c2"), "left")
        add = [(F.col(x) + F.coalesce(y, F.lit(0))).alias(x) for x, y in (("leaves", "l"), ("saved", "s"))]
        before, t = t, stage(joined.select("conv_id", F.col("far").alias("to"), *add), "trie-totals")
        free(before)
    return t


def ends_digests(ends: DataFrame) -> DataFrame:
    """owner, depth and the SHA-256 of the ids that end there, ascending, joined by commas.

    Ids are sorted in ranges and joined to long pieces where they lie; a digest
    reads its pieces one after the other, as SHA-256 has to, and holds one.
    """
    names = ["owner", "depth", "first", "ids"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, held, size = None, [], 0
        for b in batches:
            for o, d, c in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if (o, d) != key or size > CHUNK:
                    if held:
                        out.append((*key, held[0], ",".join(map(str, held))))
                    key, held, size = (o, d), [], 0
                held.append(c)
                size += 20
            if len(out) >= 2000 or sum(len(r[3]) for r in out) > 4 << 20:
                yield table(out)
                out = []
        if held:
            out.append((*key, held[0], ",".join(map(str, held))))
        if out:
            yield table(out)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())], names)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h, out = None, hashlib.sha256(), []
        for b in batches:
            for o, d, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                if (o, d) == key:
                    h.update(b",")
                else:
                    if key:
                        out.append((*key, h.hexdigest()))
                    key, h = (o, d), hashlib.sha256()
                h.update(ids.encode())
            if len(out) >= 2000:
                yield done(out)
                out = []
        if key:
            out.append((*key, h.hexdigest()))
        if out:
            yield done(out)

    def done(rows: list[tuple]) -> pa.RecordBatch:
        o, d, s = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.string())], ["owner", "depth", "ends_sha256"])

    order = ["owner", "depth", "conv_id"]
    cut = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, "owner long, depth long, first long, ids string")
    by_node = cut.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "first")
    return by_node.mapInArrow(digests, "owner long, depth long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of conversations given as turns (conv_id, depth from 1, digest, words) and (conv_id, length)."""
    facts = convs.agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.coalesce(F.max("length"), F.lit(0)).alias("longest")).first()
    least, longest = facts.least if facts.n else 0, int(facts.longest)
    known = stage(prefixes(turns, block, longest), "trie-prefixes")
    minima = stage(known.groupBy("depth", "p1", "p2").agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"), F.min("words").alias("words")), "trie-minima")
    state = first_owned(known, minima, convs, least, longest)
    f = F.when(F.col("conv_id") == F.lit(least), F.lit(0)).otherwise(F.col("g") + 1)
    state = state.withColumn("f", f.cast("long"))
    above = F.when(F.col("f") > 0, F.col("up"))
    chains = stage(state.where("f <= length").select("conv_id", "f", "length", above.alias("up")), "trie-chains")
    attached = chains.where("f > 0")

    root = convs.agg(F.min("conv_id").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = minima.select("owner", "depth", "n_convs", "words").unionByName(root.select("owner", F.lit(0).cast("long").alias("depth"), "n_convs", F.lit(0).cast("long").alias("words")))
    hung = attached.groupBy(F.col("up").alias("o"), (F.col("f") - 1).alias("d")).agg(F.count("*").alias("hung"))
    children = F.coalesce("hung", F.lit(0)) + F.when(F.col("depth") < F.col("length"), F.lit(1)).otherwise(F.lit(0))
    parent = F.when(F.col("depth") == 0, F.lit(None)).when(F.col("depth") > F.col("f"), F.col("owner")).otherwise(F.col("up"))
    placed = nodes.join(chains.withColumnRenamed("conv_id", "owner"), "owner").join(hung, (F.col("owner") == F.col("o")) & (F.col("depth") == F.col("d")), "left")
    held = stage(
        placed.select("owner", "depth", parent.alias("parent_conv_id"), "n_convs", children.alias("n_children"), (children == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved")),
        "trie-nodes",
    )
    free(known, minima)
    totals = chain_totals(chains, held.groupBy(F.col("owner").alias("conv_id")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    brought = attached.select("conv_id", F.col("up").alias("o"), (F.col("f") - 1).alias("d")).join(totals.drop("to"), "conv_id").groupBy("o", "d").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
    with_hung = held.join(brought, (F.col("owner") == F.col("o")) & (F.col("depth") == F.col("d")), "left")
    values = with_hung.select("owner", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
    summed = running(values, "owner", "depth", ["leaves", "saved"], block, longest, down=True)

    at = F.when(F.col("f") <= F.col("length"), F.col("conv_id")).otherwise(F.col("up"))
    ends = ends_digests(state.select(at.alias("owner"), F.col("length").alias("depth"), "conv_id")).select(F.col("owner").alias("eo"), F.col("depth").alias("ed"), "ends_sha256")
    out = summed.join(ends, (F.col("owner") == F.col("eo")) & (F.col("depth") == F.col("ed")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, share: bool = False, block: int = BLOCK) -> DataFrame:
    """One row a distinct prefix of conversations, from the root at depth 0.

    conv_id (the least conversation that starts with it), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves and saved_tokens (words that
    need no second processing) of the subtree, ends_sha256. With ``share``,
    conversations are first rebuilt so that they share first turns.

    Turns are ordered by turn, null first, equal ones by a digest of role and
    text; null roles and texts are empty; repeated rows are turns each; rows
    without a conv_id belong to no conversation and have no place. Texts and
    conversations may be of any length, and one prefix may be common to all. Other
    columns are not read. An empty table has no root. Prefixes are told apart by
    128 bits. Writes narrow tables to the shared folder on the way.
    """
    tune(conversations.sparkSession)
    turns, convs = ordered_turns(conversations)
    if share:
        turns, convs = rebuilt(turns, convs)
    else:
        turns, convs = turns.withColumnRenamed("place", "depth"), convs.withColumnRenamed("n", "length")
    return trie(turns, convs, block)

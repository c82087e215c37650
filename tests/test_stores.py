"""Stored listings, the sink of checked blobs, and the log of done keys: restarts, failures, timers."""

import hashlib
import json
import os

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vellum.sources import pacing, stores
from vellum.streaming import done_log

PNG = b"\x89PNG\r\n\x1a\n"


def kept(path):
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(path) for f in fs if not f.startswith(".")}


def blobs(path):
    return {n: c for n, c in kept(path).items() if not n.startswith("_")}


def store(spark, rows, path, **more):
    stores.write_blobs(spark.createDataFrame(rows, "key string, content binary").repartition(3), str(path), F.col("content"), F.col("key"), **more)


def test_blobs_are_checked_named_by_content_and_written_once(spark, tmp_path):
    path = tmp_path / "blobs"
    good = [PNG + b"one", PNG + b"two", b"GIF89a three", b"\xff\xd8\xff four", b"RIFF1234WEBPVP8 "]
    rows = [(f"k{i}", bytearray(c)) for i, c in enumerate(good * 40)] + [("null", None), ("text", bytearray(b"plain")), ("empty", bytearray(b"")), (None, bytearray(b"<html>"))]
    store(spark, rows, path)
    endings = ["png", "png", "gif", "jpg", "webp"]
    expected = {f"{hashlib.sha256(c).hexdigest()[:16]}.{e}": c for c, e in zip(good, endings)}
    assert blobs(path) == expected
    assert sorted(map(str, stores.rejected(spark, str(path)).select("key", "reason", "bytes").collect())) == sorted(
        str(r) for r in spark.createDataFrame([("null", "no content", 0), ("text", "not of a wanted kind", 5), ("empty", "too small", 0), (None, "not of a wanted kind", 6)], "key string, reason string, bytes long").collect()
    )
    times = {n: os.stat(path / n).st_ino for n in expected}
    store(spark, rows[:200], path)
    assert blobs(path) == expected
    counts = [json.loads(c) for n, c in kept(path).items() if n.startswith("_commits")]
    assert sorted(c["known"] > 0 for c in counts) in ([False, True], [True, True]) and times.keys() == expected.keys()
    assert {r.length for r in stores.blob_files(spark, str(path)).select("length").collect()} == {len(c) for c in good}


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    path = tmp_path / "blobs"
    rows = spark.range(100).select(F.col("id").cast("string").alias("key"), F.concat(F.unhex(F.lit("89504E470D0A1A0A")), F.col("id").cast("string").cast("binary")).alias("content"))
    fails = F.when(F.col("key") == "99", F.raise_error(F.lit("no more")).cast("binary")).otherwise(F.col("content"))
    with pytest.raises(Exception, match="no more"):
        stores.write_blobs(rows.coalesce(1), str(path), fails, F.col("key"))
    assert kept(path) == {}
    stores.write_blobs(rows, str(path), F.col("content"), F.col("key"))
    assert len(blobs(path)) == 100


def test_kinds():
    assert [stores.kind_of(c) for c in (b"", PNG, b" {\"a\": 1}", b"{not", b"%PDF-1.7", b"RIFF....WAVE")] == [None, "png", "json", None, "pdf", None]


def pages_of(path, listing, pages):
    """Write pages (token, items, next)."""
    os.makedirs(path / listing, exist_ok=True)
    for token, items, following in pages:
        (path / listing / f"{token}.json").write_text(json.dumps({"items": items, "next": following}))


def items_of(d):
    return sorted((r.listing, r.page, r.pos, json.loads(r["item"])) for r in d.collect())


def test_listings_end_where_they_should(spark, tmp_path):
    pages_of(tmp_path, "plain", [("start", [1, 2], "b"), ("b", [3, 4], "c"), ("c", [5], None)])
    pages_of(tmp_path, "loop", [("start", [1, 2], "b"), ("b", [3, 4], "start")])
    pages_of(tmp_path, "gap", [("start", [1, 2], "b")])
    pages_of(tmp_path, "hole", [("start", [1, 2], "b"), ("b", [], "c"), ("c", [9, 9], None)])
    pages_of(tmp_path, "short", [("start", [1], "b"), ("b", [2, 3], None)])
    pages_of(tmp_path, "none", [])
    found = items_of(stores.read_listings(spark, str(tmp_path)))
    assert {n: [i for m, _, _, i in found if m == n] for n in ("plain", "loop", "gap", "hole", "short")} == {"plain": [1, 2, 3, 4, 5], "loop": [1, 2, 3, 4], "gap": [1, 2], "hole": [1, 2], "short": [1, 2, 3]}
    assert [i for n, _, _, i in items_of(stores.read_listings(spark, str(tmp_path), full_page=2)) if n == "short"] == [1]
    one = stores.read_listings(spark, str(tmp_path)).where("listing = 'plain' and page > 1")
    assert one.rdd.getNumPartitions() == 1 and [i for *_, i in items_of(one)] == [3, 4, 5]
    assert stores.read_listings(spark, str(tmp_path)).where("listing in ('a', 'gap') and listing <> 'x'").count() == 2


def test_a_stream_of_listings_goes_on_after_a_restart(spark, tmp_path):
    path = tmp_path / "in"

    def run():
        q = stores.stream_listings(spark, str(path)).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start()
        q.awaitTermination()
        return items_of(spark.read.parquet(str(tmp_path / "out")))

    pages_of(path, "a", [("start", [1, 2], "b")])
    assert [i for *_, i in run()] == [1, 2]
    assert [i for *_, i in run()] == [1, 2]
    pages_of(path, "a", [("b", [3], "c"), ("c", [4], None)])
    pages_of(path, "b", [("start", [{"x": None}], "z")])
    assert run() == items_of(stores.read_listings(spark, str(path)))
    pages_of(path, "b", [("z", [5], None)])
    pages_of(path, "a", [("d", [6], None)])  # after the end
    assert run() == items_of(stores.read_listings(spark, str(path))) and len(run()) == 6


def logged(spark, tmp_path, batches, schema="key string, item string, ord long", **more):
    events = str(tmp_path / "in")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(events)
        told = done_log.done_log(spark.readStream.schema(schema).parquet(events), "key", "item", "ord", ["end"], **more)
        done_log.run_log(told, str(tmp_path / "told"), str(tmp_path / "log")).awaitTermination()
        yield sorted((r.key, r.kind, r["item"], r.ord, r.n_items) for r in spark.read.schema(done_log.OUT).parquet(str(tmp_path / "told")).collect()) if k >= 0 else None


def told_in_order(batches):
    """The log over batches, one row after the other."""
    out, items, done = [], {}, set()
    for rows in batches:
        for key, item, o in sorted((r for r in rows if None not in r[:3]), key=lambda r: r[2]):
            if key not in done and item not in items.setdefault(key, {}):
                items[key][item] = o
                out.append((key, "item", item, o, len(items[key])))
                if item == "end":
                    done.add(key)
                    out.append((key, "done", None, o, len(items[key])))
    return out


def test_the_log_tells_each_item_once_over_restarts(spark, tmp_path):
    import random

    rng = random.Random(4)
    rows = [(rng.choice("abcdefgh"), rng.choice(["x", "y", "z", "w", "v", "end"]) if rng.random() < 0.9 else None, i) for i in range(150)] + [(None, "x", 150), ("hot", "x", None)] + [("hot", "x", 200 + i) for i in range(300)]
    batches = [rows[:40], rows[40:41], rows[41:120], rows[120:]]
    for k, got in enumerate(logged(spark, tmp_path, batches)):
        key = lambda r: tuple(map(str, r))
        assert sorted(got, key=key) == sorted(told_in_order(batches[: k + 1]), key=key)
    saved = {r.key: (r.n_items, r.closed) for r in done_log.saved_state(spark, str(tmp_path / "log")).collect()}
    told = told_in_order(batches)
    assert saved == {k: (sum(r[0] == k and r[1] == "item" for r in told), next((r[3] for r in told if r[0] == k and r[1] == "done"), -1)) for k in {r[0] for r in told}}
    # another log starts from what this one saved
    known = done_log.saved_state(spark, str(tmp_path / "log"))
    closed = next(k for k, v in saved.items() if v[1] >= 0)
    (got,) = logged(spark, tmp_path / "second", [[(closed, "new", 1000), ("fresh", "x", 1001)]], known=known)
    assert got == [("fresh", "item", "x", 1001, 1)]


def test_quiet_keys_are_told_and_forgotten(spark, tmp_path):
    import datetime as dt

    at = lambda m: dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m)
    batches = [[("a", "x", 1, at(0)), ("b", "x", 2, at(1))], [("b", "y", 3, at(90))], [("c", "x", 4, at(400))], [("a", "x", 5, at(401))]]
    *_, got = logged(spark, tmp_path, batches, "key string, item string, ord long, ts timestamp", time="ts", idle="1 hour")
    kinds = [(k, kind) for k, kind, *_ in got]
    assert kinds.count(("a", "item")) == 2 and ("a", "idle") in kinds and ("b", "idle") in kinds and ("c", "item") in kinds


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_requests_are_paced_as_one_after_the_other(spark, block):
    import random

    rng = random.Random(block)
    rows = [(i, rng.choice(["a", "a", "a", "b", None]), None if rng.random() < 0.05 else rng.randint(-50, 300)) for i in range(400)]
    last, expected = {}, {}
    for i, host, asked in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0])):
        expected[i] = None if host is None or asked is None else max(asked, last.get(host, -(10**9)) + 3)
        if expected[i] is not None:
            last[host] = expected[i]
    d = spark.createDataFrame(rows, "id long, host string, asked long")
    got = {r.id: r.starts for r in pacing.paced(d, "host", "asked", "id", 3, block).collect()}
    assert got == expected


def test_state_is_asked_for_what_it_can_hold_only():
    """Calls of a new key that ends in its first batch: about is looked for and set, its map is left alone."""
    calls = []

    class State:
        def __getattr__(self, name):
            return lambda *a: calls.append(name)

    log = done_log.DoneLog(frozenset(["end"]), None, None)
    log.about, log.items = State(), State()
    out = pd.concat(log.handleInputRows(("k",), iter([pd.DataFrame({"item": ["a", "b", "end", "c"], "ord": [1, 2, 3, 4]})]), None))
    assert out["n_items"].tolist() == [1, 2, 3, 3] and out["kind"].tolist() == ["item"] * 3 + ["done"]
    assert calls == ["exists", "update"]


def write_part(path, rows, **options):
    """One task's write of rows (key, name, content), as Spark calls it."""
    schema = pa.schema([("key", pa.string()), ("name", pa.string()), ("content", pa.binary())])
    return stores.BlobWriter({"path": str(path)} | options).write(iter([pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)]))


def test_a_stored_blob_is_not_written_again(spark, tmp_path):
    path = tmp_path / "blobs"
    rows = [(f"k{i}", bytearray(PNG + b"%d" % (i % 30))) for i in range(90)] + [("null", None)]
    store(spark, rows, path)
    inodes = {n: os.stat(path / n).st_ino for n in blobs(path)}
    torn = min(inodes)
    (path / torn).write_bytes(b"torn")
    store(spark, rows, path)
    assert {n: os.stat(path / n).st_ino for n in inodes if n != torn} == {n: i for n, i in inodes.items() if n != torn}
    assert blobs(path)[torn].startswith(PNG) and len(inodes) == 30
    # a given name is no digest: the last write counts
    assert write_part(path, [("a", "x/y.png", PNG)]).written == 1 and write_part(path, [("a", "x/y.png", PNG + b"2")]).known == 1
    assert blobs(path)["x/y.png"] == PNG + b"2"


def test_one_partition_is_written_by_all_tasks(spark, tmp_path):
    """A table that is one small file, with null contents and null keys, and few distinct contents among many rows."""
    path = tmp_path / "blobs"
    rows = spark.range(4000).coalesce(1).select("id", F.when(F.col("id") % 4 < 2, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), (F.col("id") % 4 * F.col("id")).cast("string").cast("binary"))).alias("c"))
    stores.write_blobs(rows, str(path), F.col("c"), F.col("id"))
    assert len(blobs(path)) == 1001 and stores.rejected(spark, str(path)).count() == 2000
    lists = [c for n, c in kept(path).items() if n.startswith("_names")]
    assert len(lists) >= 4 and all(lists)
    turned_away = [c.count(b"\n") for n, c in kept(path).items() if n.startswith("_rejected")]
    assert len(turned_away) >= 4 and max(turned_away) < 1000


def test_blobs_are_read_by_their_lists(spark, tmp_path):
    path = tmp_path / "a store"
    rows = [(f"k{i}", bytearray(PNG + b"%d" % i)) for i in range(300)] + [("text", bytearray(b"plain"))]
    columns = ["path", "modificationTime", "length", "content"]
    store(spark, rows[:200], path)
    store(spark, rows, path)
    stores.write_blobs(spark.createDataFrame([("k", "d/e.png", bytearray(PNG))], "key string, name string, content binary"), str(path), F.col("content"), F.col("key"), F.col("name"))
    by_spark = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(path)).where("path not like '%/_names/%' and path not like '%/_rejected/%' and path not like '%/_commits/%'")
    got = stores.blob_files(spark, str(path))
    assert got.columns == columns and got.schema.simpleString() == by_spark.schema.simpleString()
    told = lambda d: sorted((r.path, r.length, bytes(r.content)) for r in d.collect())
    assert told(got) == told(by_spark) and got.count() == 301
    assert got.rdd.getNumPartitions() == 4
    gone = min(blobs(path))
    os.remove(path / gone)
    assert stores.blob_files(spark, str(path)).count() == 300
    # a write of an earlier version left no list: Spark lists the folder
    (path / "_commits" / "old.json").write_text("{}")
    (path / "by-hand.png").write_bytes(PNG)
    assert "by-hand.png" in {r.path.rpartition("/")[2] for r in stores.blob_files(spark, str(path)).select("path").collect()}


def test_a_write_that_fails_in_its_task_leaves_nothing(tmp_path):
    def batches():
        yield pa.RecordBatch.from_pydict({"key": ["a", "b"], "name": pa.array([None, None], pa.string()), "content": [PNG, b"plain"]})
        raise ValueError("no more")

    with pytest.raises(ValueError, match="no more"):
        stores.BlobWriter({"path": str(tmp_path)}).write(batches())
    assert kept(tmp_path) == {}

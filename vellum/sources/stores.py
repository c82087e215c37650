"""Data sources of Spark for stored files: a sink of checked blobs, and listings that go on by token.

Files are reached through the filesystem of their address (a local or shared
folder, or an object store), by the tasks; the driver sees names of listings and
counts.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage

from vellum.scratch import BATCH_BYTES, BATCH_ROWS, dealt, tune

#: First bytes of the kinds of files that are told by them; fixed values of the public formats.
MAGIC = {"png": b"\x89PNG\r\n\x1a\n", "gif": b"GIF8", "jpg": b"\xff\xd8\xff", "pdf": b"%PDF-"}


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of an address, and the place there."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def kind_of(content: bytes) -> str | None:
    """What the first bytes say that a file is; ``json`` is read to its end."""
    for kind, first in MAGIC.items():
        if content.startswith(first):
            return kind
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP":
        return "webp"
    if content.lstrip()[:1] in (b"{", b"["):
        try:
            json.loads(content)
        except ValueError:
            return None
        return "json"
    return None


# A sink of checked blobs


@dataclass
class Written(WriterCommitMessage):
    task: str
    written: int
    known: int
    rejected: int


class BlobWriter(DataSourceArrowWriter):
    """Tasks write to folders of their own and move what is complete; a file is named by its content, so that a repeated task changes nothing.

    A content that is stored is not written again. Each task leaves a list of the
    names that it wrote or found.
    """

    def __init__(self, options: dict) -> None:
        self.path, self.least = options["path"], int(options.get("least_bytes", 1))
        self.kinds = set(options.get("kinds", "png,gif,jpg,webp").split(","))
        self.job = uuid.uuid4().hex

    def reason(self, content: bytes | None) -> tuple[str | None, str | None]:
        if content is None:
            return None, "no content"
        if len(content) < self.least:
            return None, "too small"
        kind = kind_of(content)
        return (kind, None) if kind in self.kinds else (None, "not of a wanted kind")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = f"{self.job}-{uuid.uuid4().hex}"
        files, root = opened(self.path)
        own = f"{root}/_staging/{task}"
        files.create_dir(own, recursive=True)
        names: dict[str, str | None] = {}  # where the task's own file is; None: it was stored before
        rejected = 0
        try:
            with files.open_output_stream(f"{own}/rejected") as turned_away:
                for key, name, content in (row for batch in iterator for row in zip(*(batch.column(c) for c in ("key", "name", "content")), strict=True)):
                    content = content.as_py()
                    kind, reason = self.reason(content)
                    if reason:
                        rejected += 1
                        turned_away.write((json.dumps({"key": key.as_py(), "reason": reason, "bytes": len(content or b"")}) + "\n").encode())
                        continue
                    given = name.as_py()
                    name = given or f"{hashlib.sha256(content).hexdigest()[:16]}.{kind}"
                    if name in names:
                        continue
                    if not given and self._stored(files, f"{root}/{name}", len(content)):
                        names[name] = None
                        continue
                    names[name] = f"{own}/{len(names)}"
                    with files.open_output_stream(names[name]) as out:
                        out.write(content)
            self._text(files, f"{own}/names", "".join(json.dumps({"name": n}) + "\n" for n in names))
            known = 0
            for name, at in names.items():
                target = f"{root}/{name}"
                if at is None:
                    known += 1
                    continue
                if "/" in name:
                    files.create_dir(target.rpartition("/")[0], recursive=True)
                if files.get_file_info(target).type == fs.FileType.File:
                    known += 1
                files.move(at, target)
            for part, told in (("names", True), ("rejected", rejected)):
                if told:
                    files.create_dir(f"{root}/_{part}", recursive=True)
                    files.move(f"{own}/{part}", f"{root}/_{part}/{task}.jsonl")
        finally:
            files.delete_dir(own)  # what a failed task wrote goes with it
        return Written(task, len(names) - known, known, rejected)

    def _stored(self, files: fs.FileSystem, path: str, size: int) -> bool:
        info = files.get_file_info(path)
        return info.type == fs.FileType.File and info.size == size

    def _text(self, files: fs.FileSystem, path: str, text: str) -> None:
        with files.open_output_stream(path) as out:
            out.write(text.encode())

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """One line of counts for the write; names and rejected rows of attempts that did not count go."""
        files, root = opened(self.path)
        done = [m for m in messages if m is not None]
        self._clean(files, root, {m.task for m in done})
        counts = {"tasks": len(done), "written": sum(m.written for m in done), "known": sum(m.known for m in done), "rejected": sum(m.rejected for m in done)}
        files.create_dir(f"{root}/_commits", recursive=True)
        self._text(files, f"{root}/_commits/{self.job}.json", json.dumps(counts))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Nothing is listed as committed. Complete files stay: their names are their content, and the next attempt finds them known."""
        files, root = opened(self.path)
        self._clean(files, root, set())

    def _clean(self, files: fs.FileSystem, root: str, kept: set[str]) -> None:
        for part in ("_staging", "_names", "_rejected"):
            for info in files.get_file_info(fs.FileSelector(f"{root}/{part}", allow_not_found=True)):
                name = info.base_name.removesuffix(".jsonl")
                if name.startswith(self.job) and name not in kept:
                    (files.delete_dir if info.type == fs.FileType.Directory else files.delete_file)(info.path)


class BlobSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vellum_blobs"

    def schema(self) -> str:
        return "key string, name string, content binary"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return BlobWriter(dict(self.options))


def write_blobs(rows: DataFrame, path: str, content: Column, key: Column, name: Column | None = None, kinds: tuple[str, ...] = ("png", "gif", "jpg", "webp"), least_bytes: int = 1) -> None:
    """Write each distinct content once, under the first 16 digits of its SHA-256 (or ``name``), if its first bytes show one of ``kinds``.

    Rows that are null, smaller than ``least_bytes`` or of another kind come to
    ``rejected``. Writing the same rows again, or again after a failure, changes no
    file. Rows are dealt over all tasks: a small table that is one file makes as
    many blobs as it has rows.
    """
    rows.sparkSession.dataSource.register(BlobSink)
    tune(rows.sparkSession)
    told = rows.select(key.cast("string").alias("key"), (F.lit(None) if name is None else name).cast("string").alias("name"), content.cast("binary").alias("content"))
    dealt(told, "key", "content").write.format("vellum_blobs").mode("append").option("path", path).option("kinds", ",".join(kinds)).option("least_bytes", least_bytes).save()


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``write_blobs`` turned away: key, reason, bytes."""
    return spark.read.schema("key string, reason string, bytes long").option("recursiveFileLookup", "true").json(f"{path}/_rejected")


def blob_names(spark: SparkSession, path: str) -> DataFrame:
    """The names of the blobs of a store (name), from the lists that its tasks left, dealt over all tasks."""
    lists = spark.read.schema("name string").option("recursiveFileLookup", "true").json(f"{path}/_names")
    return dealt(lists, "name").dropDuplicates(["name"])


def _all_listed(path: str) -> bool:
    """Whether every committed write left lists of names; those of earlier versions did not."""
    files, root = opened(path)
    held = lambda part: [i.base_name for i in files.get_file_info(fs.FileSelector(f"{root}/{part}", allow_not_found=True))]
    jobs = {n.removesuffix(".json") for n in held("_commits")}
    return bool(jobs) and jobs <= {n.partition("-")[0] for n in held("_names")}


def blob_files(spark: SparkSession, path: str) -> DataFrame:
    """The blobs of a store, with the columns of Spark's binary files.

    The tasks read by the lists of names of the writes, so that the driver neither
    lists the blobs nor plans a task for every few of them; a blob that has been
    deleted since is left out. A store with a write that left no lists, or that
    ``write_blobs`` did not write, is listed by Spark.
    """
    if not _all_listed(path):
        return spark.read.format("binaryFile").load(path)
    tune(spark)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    shown = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    kinds = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("content", pa.binary())])

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each blob, in batches bounded by rows and bytes."""
        files, root = opened(path)
        out, size = [], 0
        for name in (n for b in batches for n in b.column(0).to_pylist()):
            info = files.get_file_info(f"{root}/{name}")
            if info.type != fs.FileType.File:
                continue
            with files.open_input_stream(info.path, compression=None) as held:
                content = held.read()
            out.append({"path": f"{shown}/{name}", "modificationTime": info.mtime, "length": len(content), "content": content})
            size += len(content)
            if size >= BATCH_BYTES or len(out) >= BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, kinds)

    return blob_names(spark, path).mapInArrow(contents, "path string, modificationTime timestamp, length long, content binary")


# Listings that go on by token


FIRST = "start"


@dataclass
class Stretch(InputPartition):
    """Pages of a listing from the one with ``token`` on, ``pages`` of them at most (-1: to the end); ``page`` is the number of the first."""

    listing: str
    token: str
    page: int
    pages: int


class Listing:
    """Responses of paged requests, kept as ``<path>/<listing>/<token>.json``: an object with ``items`` and the token of the ``next`` page."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.full = int(options.get("full_page", 0))

    def listings(self) -> list[str]:
        files, root = opened(self.path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(unquote(f.base_name) for f in found if f.type == fs.FileType.Directory and not f.base_name.startswith("_"))

    def response(self, listing: str, token: str) -> dict | None:
        """One stored response; nothing if it is not there (yet)."""
        files, root = opened(self.path)
        try:
            with files.open_input_stream(f"{root}/{quote(listing, safe='')}/{quote(token, safe='')}.json") as held:
                return json.loads(held.read())
        except FileNotFoundError:
            return None

    def walk(self, listing: str, token: str, page: int, pages: int = -1) -> Iterator[tuple[int, str, dict, str | None]]:
        """Page number, token, response and the next token, until a page is empty, not full, or not there, or leads back."""
        seen = set()
        while pages and token not in seen and (got := self.response(listing, token)) is not None:
            seen.add(token)
            items, following = got.get("items") or [], got.get("next") or None
            if not items or (self.full and len(items) < self.full):
                following = None
            yield page, token, got, following
            if following is None:
                return
            token, page, pages = following, page + 1, pages - 1

    def rows(self, part: Stretch) -> Iterator[tuple]:
        for page, token, got, _ in self.walk(part.listing, part.token, part.page, part.pages):
            for pos, item in enumerate(got.get("items") or []):
                yield part.listing, page, pos, token, json.dumps(item, ensure_ascii=False, sort_keys=True)


class ListingReader(Listing, DataSourceReader):
    def __init__(self, options: dict) -> None:
        super().__init__(options)
        self.wanted: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Listings that are not asked for are not opened."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("listing",):
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Stretch(name, FIRST, 1, -1) for name in self.listings() if self.wanted is None or name in self.wanted]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.rows(partition)


class ListingStream(Listing, DataSourceStreamReader):
    """The offset is, for each listing, the token to go on with, its page number, and whether that is still to come.

    A page is taken once the token of the next is known or the listing has ended;
    responses that are stored later are found by the next look.
    """

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        out = dict(getattr(self, "reached", {}))
        for name in self.listings():
            token, page = out.get(name, [FIRST, 1])
            if token is None:
                continue
            for at, _, _, following in self.walk(name, token, page):
                token, page = following, at + 1
            out[name] = [token, page]
        self.reached = out
        return out

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        parts = []
        for name, (_, page) in end.items():
            token, first = start.get(name, [FIRST, 1])
            if token is not None and page > first:
                parts.append(Stretch(name, token, first, page - first))
        return parts

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vellum_listing"

    def schema(self) -> str:
        return "listing string, page int, pos int, token string, item string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ListingReader(dict(self.options))

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return ListingStream(dict(self.options))


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(ListingSource)
    return spark


def read_listings(spark: SparkSession, path: str, full_page: int = 0) -> DataFrame:
    """The items of stored listings: listing, page, pos, token, item (JSON). One task a listing; a filter on ``listing`` opens only those.

    A listing ends at a page without items, with fewer than ``full_page`` (if
    given), without a next token, or that is not stored; a token is followed once.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return _registered(spark).read.format("vellum_listing").option("path", path).option("full_page", full_page).load()


def stream_listings(spark: SparkSession, path: str, full_page: int = 0) -> DataFrame:
    """The same as a stream: what has been read is an offset in its checkpoint, and pages stored since are read next."""
    return _registered(spark).readStream.format("vellum_listing").option("path", path).option("full_page", full_page).load()


def store_listing(items: DataFrame, path: str, listing: str, page: str, order: str, item: Column, only: Column | None = None) -> None:
    """Store rows as responses: the pages (from 1) of each listing, with their items in ``order`` and the next token; of all pages those of ``only``."""
    per_page = items.groupBy(F.col(listing).cast("string").alias("listing"), F.col(page).cast("int").alias("page")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))).alias("rows"))
    last = items.groupBy(F.col(listing).cast("string").alias("listing")).agg(F.max(F.col(page).cast("int")).alias("last"))
    told = per_page.join(last, "listing")
    told = told if only is None else told.where(only)
    token = lambda n: F.when(n == 1, FIRST).otherwise(F.concat(F.lit("p"), n.cast("string")))
    text = F.to_json(F.struct(F.transform("rows", lambda r: r["i"]).alias("items"), F.when(F.col("page") < F.col("last"), token(F.col("page") + 1)).alias("next")))
    name = F.concat(F.url_encode("listing"), F.lit("/"), token(F.col("page")), F.lit(".json"))
    write_blobs(told, path, text, name, name, ("json",))

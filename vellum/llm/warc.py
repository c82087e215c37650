"""WARC records: reading, writing, and the derivatives of responses.

A response becomes a metadata record (what its page says of itself) and a
conversion record (its plain text). Both refer to the response by its record id,
target URI and date, and carry digests of the source and of their own blocks.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import in_workers, tune
from vellum.sources.markup import plain_text

VERSION = b"WARC/1.1\r\n"
#: Names of record ids: a version-5 UUID over this space, so that a rerun makes the same ids.
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Bytes that a file is unpacked by, of records that are handed on at once, and of a file that is written.
PIECE, HELD, FILE_BYTES = 1 << 20, 8 << 20, 256 << 20
#: The date of responses made of tables that have none.
EPOCH = "1970-01-01T00:00:00Z"

HEAD_END = re.compile(rb"\r?\n\r?\n")
FOLDED_LINE = re.compile(r"\r?\n[ \t]+")
LENGTH = re.compile(r"[0-9]{1,18}")
CHUNK = re.compile(rb"(?:\r\n)?([0-9a-fA-F]+)[^\r\n]*\r\n")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, ' '.join(parts))}>"


def page_fields(page: str) -> list[tuple[str, str]]:
    """What a page says of itself: title, language, and its links in order."""
    out = []
    if m := TITLE.search(page):
        out.append(("title", " ".join(html.unescape(m[1]).split())))
    if m := LANG.search(page):
        out.append(("lang", m[1].lower()))
    return out + [("outlink", html.unescape(a or b or c).replace("\r", "").replace("\n", "")) for a, b, c in LINK.findall(page)]


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record. Header values take one line each."""
    lines = [f"{k}: {' '.join(v.splitlines())}\r\n".encode() for k, v in headers]
    return VERSION + b"".join(lines) + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


#: Parts of a file that could not be read: where they begin, and why.
Problems = list[tuple[int, str]]


def failed(problems: Problems | None, at: int, reason: str) -> None:
    """Note a problem, or raise it where none are kept."""
    if problems is None:
        raise ValueError(f"{reason}, at byte {at}")
    problems.append((at, reason))


def members(data: bytes | memoryview, problems: Problems | None = None) -> Iterator[tuple[int, bytes | None]]:
    """The plain bytes of a file, piece by piece, each with its place or that of its compressed member.

    After a member that cannot be unpacked comes no bytes (None), then the next one that begins.
    """
    view = memoryview(data)
    if bytes(view[:2]) != b"\x1f\x8b":
        yield from ((i, bytes(view[i : i + PIECE])) for i in range(0, len(view), PIECE))
        return
    at = 0
    while at < len(view):
        if not view[at]:  # padding between members
            at += 1
            continue
        unpack, start = zlib.decompressobj(31), at
        try:
            while not unpack.eof and at < len(view):
                some = view[at : at + PIECE]
                out = unpack.decompress(some, PIECE)
                while unpack.unconsumed_tail:
                    yield start, out
                    out = unpack.decompress(unpack.unconsumed_tail, PIECE)
                at += len(some) - len(unpack.unused_data)
                yield start, out
            reason = None if unpack.eof else "a compressed member is cut short"
        except zlib.error:
            reason = "a compressed member is damaged"
        if reason:
            failed(problems, start, reason)
            yield start, None
            at = start + 1
            while at < len(view):  # the next place that looks like a member
                found = bytes(view[at : at + PIECE + 2]).find(b"\x1f\x8b\x08")
                if found >= 0:
                    at += found
                    break
                at += PIECE


def parse(data: bytes | memoryview, problems: Problems | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of a WARC file, plain or compressed, one at a time.

    Names of headers keep their spelling; white space around names and values
    goes, lines that go on are joined, values of a repeated name are joined by
    ", ". No more than a record and a piece of the file's plain bytes are held.
    What is no record raises ValueError; with a list for ``problems`` it is noted
    there, and reading goes on at the next record or member that begins.
    """
    pieces, held = members(data, problems), bytearray()
    taken = came = 0  # plain bytes that went, and that came
    stopped = ended = False  # at a damaged member, or at the end of the file
    places: list[tuple[int, int]] = []  # of plain bytes, in the file
    packed = bytes(memoryview(data)[:2]) == b"\x1f\x8b"

    def fill(n: int) -> bool:
        """Whether ``held`` has n bytes; none come from beyond a damaged member."""
        nonlocal stopped, ended, came
        while len(held) < n and not stopped:
            if (got := next(pieces, None)) is None:
                stopped = ended = True
            elif got[1] is None:
                stopped = True
            elif got[1]:
                places.append((came, got[0]))
                came += len(got[1])
                held.extend(got[1])
        return len(held) >= n

    def drop(n: int) -> None:
        nonlocal taken
        del held[:n]
        taken += n

    def place() -> int:
        """Where in the file the first byte held lies."""
        while len(places) > 1 and places[1][0] <= taken:
            places.pop(0)
        if not places:
            return 0
        return places[0][1] if packed else places[0][1] + taken - places[0][0]

    def next_record() -> bool:
        """Go to where the next record seems to begin."""
        while True:
            at = held.find(b"WARC/1.", 1)
            if at > 0:
                drop(at)
                return True
            drop(max(0, len(held) - 8))
            if not fill(len(held) + 1):
                return False

    while True:
        while fill(1) and held[0] in b"\r\n":  # ends of records, however many
            drop(len(held) - len(held.lstrip(b"\r\n")))
        if not fill(1):
            if ended:
                return
            stopped = False  # go on beyond the damaged member
            continue
        fill(5)
        reason, end = None if held[:5].upper() == b"WARC/" else "no WARC record follows", None
        while not reason and (end := HEAD_END.search(held)) is None:
            if not fill(len(held) + 1):
                reason = "a record's header is cut short"
        if not reason:
            lines = FOLDED_LINE.sub(" ", held[: end.start()].decode("utf-8", "replace")).splitlines()[1:]
            headers: dict[str, str] = {}
            for line in lines:
                k, _, v = line.partition(":")
                headers[k.strip()] = f"{headers[k.strip()]}, {v.strip()}" if k.strip() in headers else v.strip()
            said = header(headers, "Content-Length") or "0"
            if not LENGTH.fullmatch(said):
                reason = "a record's length is no number"
            elif not fill(end.end() + int(said)):
                reason = "a record's block is cut short"
        if reason:
            if not stopped or ended:  # else it is the damaged member, which is noted
                failed(problems, place(), reason)
            if not next_record():
                drop(len(held))
            continue
        yield headers, bytes(held[end.end() : end.end() + int(said)])
        drop(end.end() + int(said))


def header(headers: dict[str, str], name: str) -> str | None:
    """A header by name, whatever its case."""
    if name in headers:
        return headers[name]
    return next((v for k, v in headers.items() if k.lower() == name.lower()), None)


def response(url: str, page: str, date: str = EPOCH, key: str = "") -> tuple[list[tuple[str, str]], bytes]:
    """A response record for a page: its headers without the length, and its block."""
    body = page.encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    headers = [
        ("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url, digest(body))), ("WARC-Target-URI", url), ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"), ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(body)),
    ]
    return headers, block


def payload(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """The HTTP headers and body of a response's block, the body as it was sent."""
    end = HEAD_END.search(block)
    if not end or not block.startswith(b"HTTP/"):
        return [], block
    lines = block[: end.start()].decode("latin-1").splitlines()[1:]
    return [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)], block[end.end() :]


def unchunked(body: bytes) -> bytes:
    """A body without its chunk sizes; what cannot be read so stays as it is."""
    out, at = [], 0
    while m := CHUNK.match(body, at):
        size = int(m[1], 16)
        if not size:
            return b"".join(out)
        out.append(body[m.end() : m.end() + size])
        at = m.end() + size
    return b"".join(out) if out and at >= len(body) else body


def page_of(source: list[tuple[str, str]], body: bytes) -> str:
    """The text of a body: transfer and content encodings undone, then its charset, as the header, a mark or the page says."""
    known = {k.lower(): v.lower() for k, v in source}
    if "chunked" in known.get("transfer-encoding", ""):
        body = unchunked(body)
    for name in reversed(known.get("content-encoding", "").split(",")):
        if (bits := {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(name.strip())) is None:
            continue
        for b in bits:
            try:
                body = zlib.decompressobj(b).decompress(body)
                break
            except zlib.error:
                continue
    mark = next((c for m, c in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")) if body.startswith(m)), None)
    said = CHARSET.search(known.get("content-type", "")) or CHARSET.search(body[:2048].decode("latin-1"))
    for name in (mark, said and said[1]):
        try:
            if name:
                return body.decode(name, "replace")
        except (LookupError, ValueError):
            continue
    return body.decode("utf-8", "replace")


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of one response."""
    source, body = payload(block)
    page = page_of(source, body)
    said_by = lambda name: header(headers, name) or ""
    of = said_by("WARC-Record-ID")
    link = [("WARC-Refers-To", of), ("WARC-Refers-To-Target-URI", said_by("WARC-Target-URI")), ("WARC-Refers-To-Date", said_by("WARC-Date"))]
    fields = [(f"source-{k.lower()}", v) for k, v in source]
    fields += [("source-block-digest", said_by("WARC-Block-Digest") or digest(block)), ("source-payload-digest", said_by("WARC-Payload-Digest") or digest(body))]
    said = "".join(f"{k}: {v}\r\n" for k, v in fields + page_fields(page)).encode()
    out = []
    for kind, content, data in (("metadata", "application/warc-fields", said), ("conversion", "text/plain; charset=utf-8", plain_text(page).encode())):
        out.append((
            [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, of)), ("WARC-Target-URI", said_by("WARC-Target-URI")),
             ("WARC-Date", said_by("WARC-Date")), *link, ("Content-Type", content), ("WARC-Block-Digest", digest(data)), ("WARC-Payload-Digest", digest(data))],
            data,
        ))
    return out


def pages_to_responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, headers, block): a response record for each page. A null url or page counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [response(u or "", h or "", key=str(k)) for k, u, h in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([h for h, _ in made], pa.map_(pa.string(), pa.string())), pa.array([x for _, x in made], pa.binary())],
                ["page_id", "headers", "block"],
            )

    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))
    return in_workers(d, run, "page_id long, headers map<string,string>, block binary")


def derive(responses: DataFrame) -> DataFrame:
    """Rows of ``responses`` (headers, block, and any others) with their derivatives beside them.

    Adds metadata and conversion, structs of a record's headers, block and bytes
    as written to a file; columns of those names are replaced. Only records of
    WARC-Type response have derivatives: others give no row. A null block counts
    as empty. Responses are independent: nothing is shuffled, and a lost task is
    simply run again, to the same record ids; rows that repeat have equal ids.
    """
    kept = [c for c in responses.columns if c not in ("metadata", "conversion")]
    where = [kept.index("headers"), kept.index("block")]
    one = pa.struct([("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary()), ("record", pa.binary())])
    is_response = F.exists(F.map_entries("headers"), lambda h: (F.lower(h["key"]) == "warc-type") & (F.lower(h["value"]) == "response"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[dict]] = [[], []]
            for h, block in zip(b.column(where[0]).to_pylist(), b.column(where[1]).to_pylist(), strict=True):
                for k, (headers, data) in enumerate(derivatives(dict(h or []), block or b"")):
                    out[k].append({"headers": headers, "block": data, "record": gzip.compress(serialize(headers, data), 6, mtime=0)})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out[0], one), pa.array(out[1], one)], [*kept, "metadata", "conversion"])

    fields = ", ".join(f"`{c}` {responses.schema[c].dataType.simpleString()}" for c in kept)
    kind = "struct<headers: map<string,string>, block: binary, record: binary>"
    return in_workers(responses.where(is_response).select(*kept), run, f"{fields}, metadata {kind}, conversion {kind}")


def scan_warc(files: DataFrame) -> DataFrame:
    """Rows (path, headers, block, offset, reason) of ``files`` (path, content), as the binaryFile source gives them.

    A record has headers and block. What could not be read has the place where it
    begins and the reason; the rest of its file is read all the same, so that one
    damaged file is no end of a job. A file is unpacked member by member and its
    records are handed on as they come: a worker holds the file as it is stored and
    some megabytes of records. A null or empty file has none.
    """
    tune(files.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0), b.column(1), strict=True):
                found: list[tuple[dict[str, str], bytes]] = []
                problems: Problems = []
                size = 0
                for record in parse(memoryview(content.as_buffer()) if content.is_valid else b"", problems):
                    found.append(record)
                    size += len(record[1])
                    if size >= HELD:
                        yield batch(path.as_py(), found, [])
                        found, size = [], 0
                if found or problems:
                    yield batch(path.as_py(), found, problems)

    def batch(path: str | None, found: list[tuple[dict[str, str], bytes]], problems: Problems) -> pa.RecordBatch:
        n, m = len(found), len(problems)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * (n + m), pa.string()), pa.array([*(list(h.items()) for h, _ in found), *[None] * m], pa.map_(pa.string(), pa.string())), pa.array([*(x for _, x in found), *[None] * m], pa.binary()),
             pa.array([*[None] * n, *(at for at, _ in problems)], pa.int64()), pa.array([*[None] * n, *(reason for _, reason in problems)], pa.string())],
            ["path", "headers", "block", "offset", "reason"],
        )

    return in_workers(files.select("path", "content"), run, "path string, headers map<string,string>, block binary, offset long, reason string")


def read_warc(files: DataFrame) -> DataFrame:
    """Rows (path, headers, block) of all records in ``files`` that can be read; see ``scan_warc``."""
    return scan_warc(files).where("reason is null").select("path", "headers", "block")


def unread(files: DataFrame) -> DataFrame:
    """Rows (path, offset, reason) of the parts of ``files`` that cannot be read; see ``scan_warc``."""
    return scan_warc(files).where("reason is not null").select("path", "offset", "reason")


def warc_files(derived: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Files of the derivatives of ``derived`` (see ``derive``): rows (path, content), each content a compressed WARC file of about ``file_bytes``.

    A file starts with a warcinfo record; each response's metadata and conversion
    records follow each other. The rows can be written to any table and read
    again by ``read_warc``. Files are of one partition each; none come of no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal k, held, size
            path = f"derivatives-{part:05d}-{k:05d}.warc.gz"
            said = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("warcinfo", path)), ("WARC-Date", EPOCH), ("WARC-Filename", path), ("Content-Type", "application/warc-fields")]
            content = gzip.compress(serialize(said, b"format: WARC File Format 1.1\r\n"), 6, mtime=0) + b"".join(held)
            k, held, size = k + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([content], pa.binary())], ["path", "content"])

        for b in batches:
            for two in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held += [x or b"" for x in two]
                size += sum(map(len, held[-2:]))
                if size >= file_bytes:
                    yield close()
        if held:
            yield close()

    return in_workers(derived.select("metadata.record", F.col("conversion.record").alias("other")), run, "path string, content binary")


def page_derivatives(pages: DataFrame) -> DataFrame:
    """One row a page: ids, links and digests of its response, metadata and conversion records, and the plain text's size.

    A null url or page counts as empty and still has all three records. Repeated
    rows are converted each; other columns are not read; an empty table gives no
    rows.
    """
    tune(pages.sparkSession)
    d = derive(pages_to_responses(pages))
    at = lambda c, k: F.element_at(f"{c}.headers", k)
    return d.select(
        "page_id", F.element_at("headers", "WARC-Record-ID").alias("response_id"), F.element_at("headers", "WARC-Payload-Digest").alias("payload_digest"),
        at("metadata", "WARC-Record-ID").alias("metadata_id"), at("metadata", "WARC-Refers-To").alias("metadata_refers_to"),
        at("metadata", "WARC-Block-Digest").alias("metadata_digest"), at("conversion", "WARC-Record-ID").alias("conversion_id"),
        at("conversion", "WARC-Refers-To").alias("conversion_refers_to"), at("conversion", "WARC-Refers-To-Target-URI").alias("refers_to_uri"),
        at("conversion", "WARC-Block-Digest").alias("conversion_digest"), F.octet_length("conversion.block").cast("long").alias("text_bytes"),
        F.sha2("conversion.block", 256).alias("text_sha256"), (F.octet_length("metadata.record") + F.octet_length("conversion.record")).cast("long").alias("record_bytes"),
    )

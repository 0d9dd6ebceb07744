"""WARC archives: a writer that marks repeated payloads as revisits, and a reader that salvages damaged archives.

Writing. Each page is one record in a gzip member of its own; members are joined to archives of about
``ARCHIVE_BYTES``. Of the records with equal payloads (of at least ``least_bytes`` bytes) the one with the largest
page id is the response, and the others are revisit records that hold its id, the payload's length and digest, and no
payload. Equal payloads are found by an aggregate of digests, so a payload shared by a third of all pages is one row
there, and no page meets others by a digest that many pages share. Spark's text writer puts the archives into the shared folder: its line separator is a NUL byte, and as a gzip
member ends with the top byte of its size, which is NUL below 16 MiB (an empty member is added otherwise), each file
is exactly a sequence of gzip members.

Reading. Each archive (read with Spark's ``binaryFile`` source) is walked from its start. A record must have a version
line, headers, its announced length, its end mark and, if it is a response, its payload digest; a member must also
pass gzip's own check. Where any check fails, the reader looks for the next place at which a member or a version line
starts a valid record, recovers from there, and reports the bytes between as a gap with the reason. In a member of many
records the same search runs over its plain bytes, as far as they inflate; of a member that breaks or fails gzip's check
only records with a payload digest that fits are kept, and none if it holds a single record and no more. Rows from within a member bear the member's offset and length.

Defined results: a null or empty html is an empty payload; a null url has no target header; a null page id is written
as such and is a response unless an equal payload has an id; rows that repeat a page id and its payload are equal in
rank, so they are all responses; an empty table makes no archive and reads back empty.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved

ARCHIVE_BYTES = 8 << 20
LEVEL = 1
#: Payloads of more than this part of the rows that share one are told to all tasks: fewer than so many.
HOT_PAYLOADS = 1024
#: Compressed bytes that are inflated at a time; those of the last time before an error are gone through one by one.
_FEED = 1 << 16
_ID = "urn:x-page:"
_VERSION = re.compile(rb"WARC/\d+\.\d+\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d+\.\d+\r\n")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha: str,
           refers_to: int | None) -> bytes:
    """One record; a revisit of ``refers_to`` if ``payload`` is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    kind = "response" if payload is not None else "revisit"
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
            "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha}",
            "Content-Type: application/http;msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~", errors="replace"))
    if payload is None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <{_ID}{refers_to}>"]
    block = http + (payload or b"")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []

    def flush():
        if held[-1][-1]:
            held.append(member(b""))
        content = b"".join(held)[:-1]
        held.clear()
        return pa.record_batch([pa.array([content], pa.binary())], names=["content"])

    size = 0
    for batch in batches:
        ids, urls, texts, shas, heads, sizes = (batch.column(i) for i in range(6))
        for i in range(batch.num_rows):
            page, first = ids[i].as_py(), heads[i].as_py()
            payload = (texts[i].as_buffer().to_pybytes() if texts[i].is_valid else b"")
            sha = base64.b32encode(bytes.fromhex(shas[i].as_py())).decode()
            again = first is not None and page != first
            held.append(member(record(page, urls[i].as_py(), None if again else payload, sizes[i].as_py(), sha, first)))
            size += len(held[-1])
            if size >= ARCHIVE_BYTES:
                yield flush()
                size = 0
    if held:
        yield flush()


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """Writes every row of ``pages`` to archives below ``path``."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    payload = F.coalesce("html", F.lit(""))
    rows = rows.withColumns({"sha": F.sha1(payload.cast("binary")), "size": F.octet_length(payload)})
    shared = (rows.filter(F.col("size") >= least_bytes)
              .groupBy("sha").agg(F.max("id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1" + (" AND first IS NOT NULL" if least_bytes else "")))
    content = marked(rows, saved(shared, "warc-shared")).mapInArrow(_archives, "content binary")
    (content.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1)
     .option("lineSep", "\0").option("compression", "none").text(path))


def marked(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """``rows`` (id, url, html, sha, size) with the response that their payload refers to, from ``shared`` (sha, first, n).

    Payloads that hold over one in ``HOT_PAYLOADS`` of the rows that share one are fewer than that many, so they are
    broadcast: their rows are dealt by input partition instead of meeting by digest, and their revisits lose the html
    before they move. All other payloads are joined by digest.
    """
    total = shared.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = shared.filter(F.col("n") > total // HOT_PAYLOADS).select("sha", F.col("first").alias("hot"), F.lit(True).alias("is_hot"))
    usual = shared.filter(F.col("n") <= total // HOT_PAYLOADS).select(F.col("sha").alias("spot"), "first")
    told = rows.join(F.broadcast(hot), "sha", "left")
    html = F.when(F.col("hot").isNotNull() & ~F.col("id").eqNullSafe(F.col("hot")), F.lit(None)).otherwise(F.col("html"))
    spot = F.when(F.col("is_hot"), F.concat_ws(":", "sha", F.spark_partition_id())).otherwise(F.col("sha"))
    return told.withColumns({"html": html, "spot": spot}).join(usual, "spot", "left").select(
        "id", "url", "html", "sha", F.coalesce("hot", "first").alias("first"), "size")


class Damaged(ValueError):
    """A record or member that fails a check, with the rows that were recovered from it."""

    def __init__(self, reason: str, rows: list[dict] | None = None):
        super().__init__(reason)
        self.rows = rows or []


def parse(data: bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """The record at ``at`` of uncompressed ``data``: its end, headers and block."""
    line = _VERSION.match(data, at)
    if not line:
        raise Damaged("no version line")
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        raise Damaged("unfinished headers")
    headers: dict[str, str] = {}
    for row in data[line.end():stop].split(b"\r\n"):
        name, colon, value = row.partition(b":")
        if not colon:
            raise Damaged("broken header")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    if not headers.get("content-length", "").isdecimal():
        raise Damaged("no length")
    begin, length = stop + 4, int(headers["content-length"])
    end = begin + length
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("wrong length")
    return end + 4, headers, data[begin:end]


def checked(headers: dict[str, str], block: bytes) -> dict:
    """What the record says of its payload, after its digest was checked."""
    kind = headers.get("warc-type", "")
    http, blank, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/"):
        http, payload = b"", block
    want = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    size = len(payload)
    if kind == "revisit":
        told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
        size = int(told[1]) if told else 0
    elif want and digest(payload) != want:
        raise Damaged("wrong payload digest")
    ident = lambda name: (m := re.search(r"-?\d+(?=>$)", headers.get(name, ""))) and int(m[0])
    return {"record_type": kind, "page_id": ident("warc-record-id"), "refers_to": ident("warc-refers-to"),
            "target_uri": headers.get("warc-target-uri"), "payload_bytes": size,
            "payload_digest": want or digest(payload), "payload": payload}


def inflate(data: bytes, at: int) -> tuple[bytes, int, str]:
    """The plain bytes of the gzip member at ``at`` as far as they inflate, where it ends, and what is wrong with it."""
    tool, out, view = zlib.decompressobj(31), [], memoryview(data)
    while at < len(data) and not tool.eof:
        part = view[at:at + _FEED]
        before = tool.copy()
        try:
            out.append(tool.decompress(part))
        except zlib.error:
            try:
                for i in range(len(part)):
                    out.append(before.decompress(part[i:i + 1]))
            except zlib.error:
                pass
            return b"".join(out), at, "broken gzip member"
        at += len(part)
    return b"".join(out), at - len(tool.unused_data), "" if tool.eof else "unfinished gzip member"


def plain_records(plain: bytes, sure: bool) -> list[dict]:
    """Records and gaps of a member's plain bytes, in order; unless ``sure``, a record needs a payload digest that fits."""
    out, place, gap, reason = [], 0, None, ""
    while place < len(plain):
        try:
            end, headers, block = parse(plain, place)
            one = checked(headers, block)
            if not sure and (one["record_type"] == "revisit" or "warc-payload-digest" not in headers):
                raise Damaged("no payload digest in a damaged member")
        except Damaged as e:
            if gap is None:
                gap, reason = place, str(e)
            later = _VERSION.search(plain, place + 1)
            place = later.start() if later else len(plain)
            continue
        if gap is not None:
            out.append({"kind": "gap", "reason": f"{reason} (plain bytes {gap} to {place} of the member)"})
            gap = None
        out.append({"kind": "record", **one})
        place = end
    if gap is not None:
        out.append({"kind": "gap", "reason": f"{reason} (plain bytes {gap} to {place} of the member)"})
    return out


def member_records(data: bytes, at: int) -> tuple[int, list[dict]]:
    """Records and gaps of the gzip member, or the one plain record, at ``at``, and where it ends."""
    if data[at:at + 3] == b"\x1f\x8b\x08":
        plain, end, wrong = inflate(data, at)
        rows = plain_records(plain, wrong != "broken gzip member")
        if wrong:
            # What holds one record and nothing else is quarantined as a whole.
            raise Damaged(wrong, [r for r in rows if r["kind"] == "record"] if len(rows) > 1 else [])
        if rows and not any(r["kind"] == "record" for r in rows):
            raise Damaged(rows[0]["reason"])
        return end, rows
    end, headers, block = parse(data, at)
    return end, [{"kind": "record", **checked(headers, block)}]


def salvage(data: bytes) -> Iterator[dict]:
    """Records (``kind`` record) and quarantined gaps (``kind`` gap), each with its offset and length, in order.

    The gap of a broken or unfinished member follows the records that were recovered from it.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            end, found = member_records(data, at)
        except Damaged as e:
            if e.rows and gap is not None:
                yield {"kind": "gap", "offset": gap, "length": at - gap, "reason": reason}
                gap = None
            if gap is None:
                gap, reason = at, str(e)
            later = _START.search(data, at + 1)
            stop = later.start() if later else len(data)
            for one in e.rows:
                yield {"offset": at, "length": stop - at, **one}
            at = stop
            continue
        if gap is not None:
            yield {"kind": "gap", "offset": gap, "length": at - gap, "reason": reason}
            gap = None
        for one in found:
            yield {"offset": at, "length": end - at, **one}
        at = end
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(data) - gap, "reason": reason}


_READ = {"kind": pa.string(), "offset": pa.int64(), "length": pa.int64(), "reason": pa.string(),
         "record_type": pa.string(), "page_id": pa.int64(), "refers_to": pa.int64(), "target_uri": pa.string(),
         "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary()}
_READ_SCHEMA = ("archive string, kind string, offset long, length long, reason string, record_type string, "
                "page_id long, refers_to long, target_uri string, payload_bytes long, payload_digest string")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for each record and each gap of the archives below ``path``; ``payload`` only with ``payloads``."""
    names = [n for n in _READ if payloads or n != "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                archive, rows = batch.column(0)[i].as_py(), []
                for row in salvage(batch.column(1)[i].as_buffer().to_pybytes()):
                    rows.append(row)
                    if len(rows) == 512:
                        yield _table(archive, rows, names)
                        rows = []
                if rows:
                    yield _table(archive, rows, names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _READ_SCHEMA + (", payload binary" if payloads else ""))


def _table(archive: str, rows: list[dict], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.repeat(archive, len(rows)), pa.string())]
                           + [pa.array([r.get(n) for r in rows], _READ[n]) for n in names], names=["archive", *names])


def round_trip(pages: DataFrame, path: str) -> DataFrame:
    """Writes ``pages`` to archives below ``path`` and reads them back: a row for each page."""
    write_archives(pages, path)
    back = read_archives(pages.sparkSession, path, payloads=False).filter("kind = 'record'")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri")

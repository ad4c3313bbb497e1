"""WARC archives: writing with revisit records, and a salvage reader.

Writing: every record is one gzip member. Records of equal payloads are
written once in full (``response``, the smallest id) and otherwise as
``revisit`` of that record. Spark writes the members with its text sink, one
zero byte after each (padding that gzip readers skip), so archives go to any
store Spark can write, at most ``max_records`` to a file and, as a task's
records begin a new folder after every ``max_bytes`` of members, no more than
that and one record.

Reading: every archive is parsed member by member. Where a check fails (the
member does not inflate, the version line or the length is wrong, or the
payload digest differs) the reader logs the bytes as a quarantined gap,
searches for the next member that inflates to a record, or the next version
line that begins a whole record, and goes on from there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import ids_and_bytes, slices
from orderflow.session import new_work_dir

MIN_REVISIT_BYTES = 0
MAX_RECORDS = 2_000
#: An archive is read as one value, and a task unpacks it.
MAX_BYTES = 64 << 20
#: Payloads that a task turns into members at once.
SLICE_BYTES = 2 << 20
LEVEL = 1
VERSION = b"WARC/1.1"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
_URN = re.compile(r"\Aurn:[^:]*:")
_MEMBER = b"\x1f\x8b\x08"
_GAP, _RECORD = "gap", "record"
#: Headers that a record has once: a second one belongs to the next record.
_ONCE = frozenset((b"warc-type", b"warc-record-id", b"warc-date", b"content-length"))


@dataclass(frozen=True)
class Record:
    headers: dict[str, str]
    payload: bytes


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(record_id: str, record_type: str, uri: str | None, refers_to: str | None, payload: bytes, digest: str) -> bytes:
    """One record; a revisit has no payload of its own but names its length."""
    body = b"" if record_type == "revisit" else payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:page:{record_id}>",
        *([f"WARC-Target-URI: {' '.join(uri.split())}"] if uri else []),
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record at ``at`` and where it ends; ``ValueError`` says which check
    failed. A header block that runs on into another record (a line without a
    colon, a bare CR, a repeated header) is none."""
    if data[at : at + 8] not in VERSIONS or data[at + 8 : at + 10] != b"\r\n":
        raise ValueError("no version line")
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        raise ValueError("headers do not end")
    headers, seen = {}, set()
    for line in data[at + 10 : head_end].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        key = name.strip().lower()
        if not colon or b"\r" in line or key in seen:
            raise ValueError("bad header line")
        if key in _ONCE:
            seen.add(key)
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise ValueError("no length")
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("length and end differ")
    payload = bytes(data[start:end])
    digest = headers.get("warc-payload-digest", "")
    if headers.get("warc-type") != "revisit" and digest.startswith("sha1:") and digest[5:] != sha1_base32(payload):
        raise ValueError("payload digest differs")
    return Record(headers, payload), end + 4


def salvage(data: bytes) -> Iterator[tuple[str, int, int, Record | str]]:
    """``("record", start, end, Record)`` and ``("gap", start, end, reason)``
    in archive order; together with zero padding they cover every byte. What
    a member of several records holds has the member's start and end each."""
    view, size, at = memoryview(data), len(data), 0
    gap_start, reason = -1, ""
    while at < size:
        if gap_start < 0 and data[at] == 0:
            at += 1
            continue
        try:
            if data.startswith(_MEMBER, at):
                found, end = _member(view, at)
            else:
                record, end = parse_record(data, at)
                found = iter([(_RECORD, record)])
        except ValueError as e:
            if gap_start < 0:
                gap_start, reason = at, str(e)
            # The next place where a member or a version line may begin.
            places = [p for p in (data.find(_MEMBER, at + 1), data.find(b"WARC/1.", at + 1)) if p >= 0]
            at = min(places, default=size)
            continue
        if gap_start >= 0:
            yield _GAP, gap_start, at, reason
            gap_start = -1
        for kind, what in found:
            yield kind, at, end, what
        at = end
    if gap_start >= 0:
        yield _GAP, gap_start, size, reason


def _member(view: memoryview, at: int) -> tuple[Iterator[tuple[str, Record | str]], int]:
    """The records and gaps of the gzip member at ``at`` and where the member
    ends. The archive is fed piece by piece: what follows is not copied."""
    inflate, parts, place, step = zlib.decompressobj(31), [], at, 1 << 14
    while not inflate.eof:
        if place >= len(view):
            raise ValueError("member is cut off")
        try:
            parts.append(inflate.decompress(view[place : place + step]))
        except zlib.error as e:
            raise ValueError("member does not inflate") from e
        place += step
        step = min(step * 2, 1 << 22)
    end = min(place, len(view)) - len(inflate.unused_data)
    text = b"".join(parts)
    found = _inside(text)
    # A member without any record is a gap of the archive.
    first = [next(found, (_GAP, "no version line"))]
    if first[0][0] == _GAP:
        if (second := next(found, None)) is None:
            raise ValueError(first[0][1])
        first.append(second)
    return chain(first, found), end


def _inside(text: bytes) -> Iterator[tuple[str, Record | str]]:
    """The records of a member's text, and why what lies between them is none."""
    at, reason = 0, ""
    while at < len(text):
        try:
            record, end = parse_record(text, at)
        except ValueError as e:
            reason = reason or str(e)
            at = text.find(b"WARC/1.", at + 1)
            if at < 0:
                break
            continue
        if reason:
            yield _GAP, reason
            reason = ""
        yield _RECORD, record
        at = end
    if reason:
        yield _GAP, reason


def revisit_plan(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, uri, data, sha1, refers_to`` for each row. Of rows with equal
    payloads of at least ``min_bytes`` bytes those with the smallest id are in
    full, the others refer to it. The smallest id of a payload is aggregated
    before it is joined back, so a payload that most pages share is no hot
    group. Null payloads are empty; rows without an id are in full."""
    uri = F.col(f"`{uri_col}`").cast("string") if uri_col in pages.columns else F.lit(None).cast("string")
    rows = ids_and_bytes(pages, id_col, payload_col, uri.alias("uri")).withColumnRenamed("doc_id", "page_id")
    rows = rows.withColumn("data", F.coalesce("data", F.lit(b""))).withColumn("sha1", F.sha1("data"))
    first = rows.where(F.octet_length("data") >= min_bytes).groupBy(F.col("sha1").alias("s")).agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    joined = rows.join(first, F.col("sha1") == F.col("s"), "left")
    return joined.select("page_id", "uri", "data", "sha1", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("refers_to"))


def _members(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """``member, volume``: volumes of a task count up from 0."""
    volume = held = 0
    for batch in slices(batches, "data", SLICE_BYTES):
        out, volumes = [], []
        for page_id, uri, data, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            digest = base64.b32encode(bytes.fromhex(sha1)).decode()
            name = "" if page_id is None else str(page_id)
            record = record_bytes(name, "response" if refers_to is None else "revisit", uri, None if refers_to is None else str(refers_to), data, digest)
            squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            out.append(squeeze.compress(record) + squeeze.flush())
            if held and held + len(out[-1]) > max_bytes:
                volume, held = volume + 1, 0
            held += len(out[-1])
            volumes.append(volume)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(volumes, pa.int32())], names=["member", "volume"])


def write_archives(plan: DataFrame, path: str, max_records: int = MAX_RECORDS, max_bytes: int = MAX_BYTES) -> None:
    """One gzip member per row of :func:`revisit_plan` into files under
    ``path/volume=<n>``, each of at most ``max_records`` records and, beyond
    its first record, ``max_bytes`` bytes of members. The text sink writes
    bytes as they are."""
    members = plan.select("page_id", "uri", "data", "sha1", "refers_to").mapInArrow(lambda batches: _members(batches, max_bytes), "member binary, volume int")
    lines = members.select(F.col("member").cast("string"), "volume")
    lines.write.option("lineSep", "\0").option("maxRecordsPerFile", max_records).partitionBy("volume").text(path)


def _salvaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "kind", "start", "stop", "reason", "record_id", "record_type", "refers_to", "uri", "payload_bytes", "payload_digest", "payload"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        # A batch has several archives; one of them at a time is copied out.
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            data = content.as_py()
            rows, held = [], 0
            for kind, start, end, found in salvage(data):
                if kind == _GAP:
                    rows.append((path, kind, start, end, found, *[None] * 7))
                    continue
                h = found.headers
                digest = h.get("warc-payload-digest", "")
                length = h.get("x-payload-length", "")
                revisit = h.get("warc-type") == "revisit"
                rows.append(
                    (
                        path,
                        kind,
                        start,
                        end,
                        None,
                        _urn(h.get("warc-record-id")),
                        h.get("warc-type"),
                        _urn(h.get("warc-refers-to")),
                        h.get("warc-target-uri"),
                        (int(length) if length.isdigit() else None) if revisit else len(found.payload),
                        digest[5:] if digest.startswith("sha1:") else sha1_base32(found.payload),
                        found.payload,
                    )
                )
                held += len(found.payload)
                if held > 4 << 20 or len(rows) > 4096:
                    yield pack(rows)
                    rows, held = [], 0
            if rows:
                yield pack(rows)


def _urn(value: str | None) -> str | None:
    """What follows ``urn:`` and the name space; it may hold colons."""
    return None if value is None else _URN.sub("", value.removeprefix("<").removesuffix(">"), count=1)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps of all archives under ``path``: ``path,
    kind`` (record or gap), ``start, stop`` (bytes of the archive), ``reason``
    (of a gap), ``record_id, record_type, refers_to, uri, payload_bytes,
    payload_digest, payload``. An empty folder or archive has no rows."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = "path string, kind string, start bigint, stop bigint, reason string, record_id string, record_type string, refers_to string, uri string, payload_bytes bigint, payload_digest string, payload binary"
    return files.mapInArrow(_salvaged, schema)


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url") -> DataFrame:
    """Write all pages, read the archives back: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to`` of each record. Ids are of an
    integer type or text; rows that repeat an id and a payload are each in
    full; null payloads are empty."""
    spark = pages.sparkSession
    path = f"{new_work_dir(spark, 'warc')}/archives"
    id_type = pages.schema[id_col].dataType.simpleString()
    write_archives(revisit_plan(pages, id_col, payload_col, uri_col), path)
    found = read_archives(spark, path).where(F.col("kind") == _RECORD)
    return found.select(
        F.when(F.col("record_id") != "", F.col("record_id")).cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(id_type).alias("refers_to"),
    )

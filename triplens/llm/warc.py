"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

The writer puts each record into a gzip member of its own and lets Spark's text writer place the
members, so files appear by the usual commit and a lost executor leaves no half file. The writer
must put something between two rows; that is an empty gzip member, so a file is a plain chain of
members. The reader goes from record to record and checks the member's CRC, the record's form and
its block digest. After a failed check it searches for the next gzip member or version line and
goes on from there; the bytes passed over are returned as a quarantined gap with the reason. The
same is done in the content of a member: one bad record in it costs no other, and of a member that
breaks off or fails its CRC those inflated records are kept that pass their own block digest. Such
rows are marked ``damaged_member``, as no check covers their headers.

Defined results: a null payload counts as empty; rows repeated with the largest id of their payload
are all responses; a row without id is a revisit if a row with an id has the same payload, else a
response; a null url writes no target; an empty table writes no records; other columns are not
looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplens.llm.common import shared_path, stored, table

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_EMPTY_MEMBER = gzip.compress(b"", mtime=0)
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
_STEP = 1 << 16
#: No version line stands within a header, so a header is sought no further than to the next one.
_HEAD_END = re.compile(rb"\r\n\r\n|WARC/1\.[01]\r\n")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str, date: str
) -> bytes:
    """One record; a revisit keeps the HTTP header, whose Content-Length tells the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # A version line within a header means damage to the reader, so none is written there.
        target = quote(url, safe="%:/?#[]@!$&'()*+,;=~").replace("WARC/1.", "WARC%2F1.")
        fields.append(("WARC-Target-URI", target))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, path: str, min_bytes: int = 0, records_per_file: int = 2000,
    date: str = "2020-01-01T00:00:00Z",
    id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
) -> None:
    """Write one record per row to ``path``.

    Of rows with equal payloads of at least ``min_bytes`` the one with the largest id is the
    response. Groups are counted by digest with map-side combine; only digests held twice or more
    are joined back, as a plain scan on either side, so a digest held by many rows is split.
    """
    plain = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(payload_column), F.lit("")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    groups = plain.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.max("page_id").alias("response"), F.count(F.lit(1)).alias("copies")
    )
    groups = stored(groups.where("copies > 1 AND response IS NOT NULL").select("digest", "response"), "copies")
    decided = plain.join(groups, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"),
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, payload, refers_to in zip(*(batch.column(i) for i in range(4))):
                data = payload.as_py().encode()
                whole = record(page_id.as_py(), url.as_py(), data, refers_to.as_py(), sha1_base32(data), date)
                out.append(gzip.compress(whole, 6, mtime=0))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    (
        decided.mapInArrow(members, "member binary").select(F.col("member").cast("string"))
        .write.option("lineSep", _EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


class Damage(Exception):
    """Why a place in a file can't be read."""


def _member(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """(content, end, damage) of the gzip member at ``at``; of a damaged one, what was inflated before the error."""
    reader, out, end = zlib.decompressobj(31), [], at
    while not reader.eof:
        if end >= len(data):
            return b"".join(out), end, "member ends early"
        piece = data[end : end + _STEP]
        before = reader.copy()
        try:
            out.append(reader.decompress(piece))
        except zlib.error as error:
            # A call that fails gives nothing back, so the bytes up to the error go in one by one.
            try:
                for i in range(len(piece)):
                    out.append(before.decompress(piece[i : i + 1]))
            except zlib.error:
                pass
            return b"".join(out), end, f"member: {error}"
        end += len(piece)
    return b"".join(out), end - len(reader.unused_data), ""


def _inside(content: bytes, checked: bool) -> tuple[list[tuple[dict[str, str], bytes]], list[str]]:
    """Good records of a member's content, and a line for each gap between them.

    Where the member failed its check, only records that pass a digest of their own are good.
    """
    found, gaps, at, bad_from, reason = [], [], 0, None, ""
    while at < len(content):
        try:
            fields, block, end = _record(content, at)
            if not checked and not fields.get("warc-block-digest", "").startswith("sha1:"):
                raise Damage("no digest in a damaged member")
        except Damage as damage:
            if bad_from is None:
                bad_from, reason = at, str(damage)
            ahead = _VERSION_LINE.search(content, at + 1)
            at = ahead.start() if ahead else len(content)
            continue
        if bad_from is not None:
            gaps.append(f"bytes {bad_from} to {at} of the member's content: {reason}")
            bad_from = None
        found.append((fields, block))
        at = end
    if bad_from is not None:
        gaps.append(f"bytes {bad_from} to {len(content)} of the member's content: {reason}")
    return found, gaps


def _record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(fields, block, end) of the record whose version line is at ``at``."""
    if not _VERSION_LINE.match(data, at):
        raise Damage("no version line")
    head = _HEAD_END.search(data, at + len(VERSION))
    if head is None:
        raise Damage("no end of header")
    # A record cut off in its header runs into the next one.
    if head[0] != b"\r\n\r\n":
        raise Damage("two headers in one")
    head_end = head.start()
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        name = name.strip().lower().decode("utf-8", "replace")
        if not colon:
            raise Damage("header line without colon")
        if name in fields and name != "warc-concurrent-to":
            raise Damage("two headers in one")
        fields[name] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Damage("no content length")
    start = head_end + 4
    end = start + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("record doesn't end where its length says")
    block = data[start:end]
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != sha1_base32(block):
        raise Damage("block digest differs")
    return fields, block, end + 4


def salvage(data: bytes) -> Iterator[tuple[int, int, dict[str, str] | None, bytes | str]]:
    """(start, end, fields, block) of each good record; (start, end, None, reason) of each gap.

    Places are bytes of the file; records and gaps follow each other and, with the empty members
    between records, cover it. Good records of a member that also holds damage come right behind
    its gaps and have their place.
    """
    view, at, bad_from, reason, rescued = memoryview(data), 0, None, "", []
    while at < len(data):
        gaps: list[str] = []
        try:
            if view[at : at + 2] == b"\x1f\x8b":
                content, end, damage = _member(view, at)
                found, gaps = _inside(content, checked=not damage)
                if damage:
                    rescued += found
                    raise Damage(damage)
            else:
                fields, block, end = _record(data, at)
                found = [(fields, block)]
        except Damage as damage:
            if bad_from is None:
                bad_from, reason = at, str(damage)
            ahead = _NEXT.search(data, at + 1)
            at = ahead.start() if ahead else len(data)
            continue
        if bad_from is not None:
            yield bad_from, at, None, reason
            for fields, block in rescued:
                yield bad_from, at, fields, block
            bad_from, rescued = None, []
        for gap in gaps:
            yield at, end, None, gap
        for fields, block in found:
            yield at, end, fields, block
        at = end
    if bad_from is not None:
        yield bad_from, len(data), None, reason
        for fields, block in rescued:
            yield bad_from, len(data), fields, block


def _urn(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?[0-9]+)>", value or "")
    return int(found[1]) if found else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """One row per record or gap of the files under ``path``.

    (file, start, end, gap, page_id, record_type, refers_to, url, payload_digest, payload_bytes,
    payload, damaged_member): ``gap`` holds the reason and is null for records; digest and size of
    a response are taken from its payload, those of a revisit from its header; ``damaged_member``
    is true for a record whose member also holds a gap. A task holds one file at a time, which the
    writer keeps small by ``records_per_file``.
    """
    names = ["file", "start", "end", "gap", "page_id", "record_type", "refers_to", "url",
             "payload_digest", "payload_bytes", "payload", "damaged_member"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
             pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]

    def rows_of(file: str, data: bytes) -> Iterator[tuple]:
        gap = None
        for start, end, fields, block in salvage(data):
            if fields is None:
                gap = start, end
                yield file, start, end, block, *[None] * 8
                continue
            head, _, payload = block.partition(b"\r\n\r\n")
            kind = fields.get("warc-type")
            if kind == "revisit":
                size = re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", head)
                size = int(size[1]) if size else None
                digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            else:
                size, digest = len(payload), sha1_base32(payload)
            yield (file, start, end, None, _urn(fields.get("warc-record-id")), kind,
                   _urn(fields.get("warc-refers-to")), fields.get("warc-target-uri"), digest, size,
                   payload if payloads and kind != "revisit" else None, (start, end) == gap)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows, held = [], 0
                for row in rows_of(file.as_py(), content.as_py()):
                    rows.append(row)
                    held += len(row[-2] or b"")
                    if len(rows) == 5000 or held > 1 << 24:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    schema = (
        "file string, start long, end long, gap string, page_id long, record_type string, "
        "refers_to long, url string, payload_digest string, payload_bytes long, payload binary, "
        "damaged_member boolean"
    )
    return files.select("path", "content").mapInArrow(read, schema)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    found = read_archives(spark, path).where("gap IS NULL")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

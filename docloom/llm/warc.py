"""WARC archives: writing with revisit records, and a salvage reader.

Writing puts each record into a gzip member of its own.  Spark's text writer commits the files: a member ends with the
high byte of its length, a zero byte below 16 MiB, so members are handed over without it and the writer sets it as line
separator; behind a longer record stands an empty member, which is legal and ends with zero too.  Files are therefore
plain concatenations of members, written with Spark's own retries and commit.

Reading takes records in gzip members or bare.  A record needs a version line, a Content-Length that fits, the closing
blank line, and the block digest if it states one.  After a failed check the reader searches for the next place where a
member or a version line begins and a valid record follows; the bytes between are reported as a gap with their offset,
length and reason, and all later records are recovered.  The same is done with the bytes of a member, also with what
inflates before it breaks off or fails its CRC: its records and gaps have the member's offset and, inside the inflated
bytes, their ``inner_offset``.  A damaged member is a gap besides; if it holds just one record, the damage is that
record's and the gap is all.  Digests do not cover headers, so the other records of a member with wrong bytes have the
damage as their reason, and so have those of a truncated one that state no block digest.  One archive file is one row
of Spark's binary source, so files should stay below some hundred megabytes; the writer rolls them by record count.

Defined cases: a null payload is empty; a null URL leaves the target header out; rows of a repeated page_id and payload
are all responses if that page_id is the smallest of its payload; a null page_id counts as largest; an empty table makes an
archive without records; an empty file has neither records nor gaps.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_VERSION = b"WARC/1."
_MAGIC = b"\x1f\x8b\x08"
_DATE = "2000-01-01T00:00:00Z"
RECORDS_PER_FILE = 20_000
_CUT = "truncated member"

RECORD_SCHEMA = (
    "path string, kind string, offset bigint, inner_offset bigint, length bigint, reason string, record_type string, record_id string, target_uri string, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One response record, or a revisit record without payload when it refers to another."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1",
        "WARC-Type: " + ("response" if refers_to is None else "revisit"),
        f"WARC-Record-ID: <{record_id}>",
        f"WARC-Date: {_DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append("WARC-Target-URI: " + " ".join(uri.split()))
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <{refers_to}>")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 4) -> bytes:
    """A gzip member without its last byte, which is zero."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    out = packer.compress(data) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        out += packer.flush()
    return out[:-1]


def assign_revisits(rows: DataFrame, key: str, payload: str, least_bytes: int = 0) -> DataFrame:
    """Append ``_refers``: the smallest key with the same payload, null for that key itself and for short payloads."""
    marked = rows.withColumn("_bytes", F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")))
    marked = marked.withColumn("_same", F.sha2("_bytes", 256))
    first = marked.groupBy("_same").agg(F.min(key).alias("_first")).withColumnRenamed("_same", "_digest")
    joined = marked.join(first, F.col("_same") == F.col("_digest"), "left")
    other = (F.octet_length("_bytes") >= least_bytes) & F.col("_first").isNotNull() & ~F.col(key).eqNullSafe(F.col("_first"))
    return joined.withColumn("_refers", F.when(other, F.col("_first"))).drop("_same", "_digest", "_first")


def write_archive(rows: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0, prefix: str = "urn:page:") -> None:
    """Write one record per row into gzip-member archives below ``folder``."""
    chosen = rows.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.col(payload).alias("payload"))
    chosen = assign_revisits(chosen, "key", "payload", least_bytes)
    chosen = chosen.select(F.col("key").cast("string"), "url", F.col("_bytes").alias("payload"), F.col("_refers").cast("string").alias("refers"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [
                    member(record(f"{prefix}{k if k is not None else 'null'}", u, p or b"", None if r is None else prefix + r))
                    for k, u, p, r in zip(*(c.to_pylist() for c in part.columns), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])

    packed = chosen.mapInArrow(pack, "member binary")
    packed.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _headers(data: bytes, at: int) -> tuple[dict[str, str], int] | str:
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return "no end of headers"
    lines = data[at:end].decode("utf-8", "replace").split("\r\n")
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            return "bad header line"
        found[name.strip().lower()] = value.strip()
    return found, end + 4


def parse_record(data: bytes, at: int = 0) -> tuple[dict, int] | str:
    """The record at a place and where it ends, or the check that failed."""
    if not data.startswith(_VERSION, at):
        return "no version line"
    got = _headers(data, at)
    if isinstance(got, str):
        return got
    head, body = got
    size = head.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        return "no content length"
    end = body + int(size)
    if end + 4 > len(data):
        return "truncated block"
    if data[end : end + 4] != b"\r\n\r\n":
        return "no closing blank line"
    block = data[body:end]
    stated = head.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != digest(block):
        return "block digest differs"
    return {"head": head, "block": block}, end + 4


def _row(found: dict) -> dict:
    head, block = found["head"], found["block"]
    kind = head.get("warc-type")
    payload, size = block, len(block)
    if head.get("content-type", "").startswith("application/http") and (cut := block.find(b"\r\n\r\n")) >= 0:
        payload = block[cut + 4 :]
        size = len(payload)
        if kind == "revisit":
            for line in block[:cut].split(b"\r\n")[1:]:
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    size = int(value)
    strip = lambda s: s[1:-1] if s and s.startswith("<") and s.endswith(">") else s
    own = digest(payload) if kind != "revisit" else None
    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    reason = "payload digest differs" if own and stated and own != stated else None
    return {
        "kind": "record", "reason": reason, "record_type": kind, "record_id": strip(head.get("warc-record-id")), "target_uri": head.get("warc-target-uri"),
        "refers_to": strip(head.get("warc-refers-to")), "payload_digest": own or stated, "payload_bytes": size, "payload": payload,
    }


def _inflate(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """What a gzip member holds, where it ends, and what is wrong with it; of a damaged one, what comes before the damage."""
    opener, parts, place, step = zlib.decompressobj(31), [], at, 65536
    while not opener.eof and place < len(data):
        before = opener.copy()
        try:
            parts.append(opener.decompress(data[place : place + step]))
        except zlib.error as error:
            if step == 1:
                return b"".join(parts), place, str(error)[:80]
            # what this step gave up to the damage is lost: again in smaller steps
            opener, step = before, step // 256
            continue
        place += step
    if not opener.eof:
        return b"".join(parts), len(data), _CUT
    return b"".join(parts), min(place, len(data)) - len(opener.unused_data), None


def _inside(inner: bytes) -> Iterator[dict]:
    """Records and gaps of inflated bytes."""
    at, gap, why = 0, None, None
    while at < len(inner):
        got = parse_record(inner, at)
        if isinstance(got, str):
            if gap is None:
                gap, why = at, got
            place = inner.find(_VERSION, at + 1)
            at = place if place >= 0 else len(inner)
            continue
        if gap is not None:
            yield {"kind": "gap", "inner_offset": gap, "length": at - gap, "reason": why}
            gap = None
        found = _row(got[0])
        yield found | {"inner_offset": at, "_sure": got[0]["head"].get("warc-block-digest", "").startswith("sha1:")}
        at = got[1]
    if gap is not None:
        yield {"kind": "gap", "inner_offset": gap, "length": len(inner) - gap, "reason": why}


def _at(data: bytes, at: int) -> tuple[list[dict], int, str | None] | str:
    """Rows of what begins at a place, where it ends, and what is wrong with it; or only that, if no record is there."""
    if not data.startswith(_MAGIC, at):
        got = parse_record(data, at)
        return got if isinstance(got, str) else ([_row(got[0]) | {"offset": at, "length": got[1] - at}], got[1], None)
    inner, end, wrong = _inflate(data, at)
    rows = list(_inside(inner))
    last = max((i for i, r in enumerate(rows) if r["kind"] == "record"), default=-1)
    if wrong and (last < 0 or len(rows) == 1):
        return wrong
    if rows and last < 0:
        return rows[0]["reason"]
    # behind its last record a damaged member is one gap with what follows
    rows = rows[: last + 1] if wrong else rows
    for r in rows:
        sure = r.pop("_sure", True)
        r["offset"] = at
        if r["kind"] == "record":
            r["length"] = end - at
            if wrong and not (sure and wrong == _CUT):
                r["reason"] = r["reason"] or wrong
    return rows, end, wrong


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of an archive, in the order of their offsets."""
    at, gap, why = 0, None, None
    while at < len(data):
        got = _at(data, at)
        wrong = got if isinstance(got, str) else got[2]
        if gap is not None and not isinstance(got, str):
            yield {"kind": "gap", "offset": gap, "length": at - gap, "reason": why}
            gap = None
        if not isinstance(got, str):
            yield from got[0]
            at = got[1] if wrong is None else at
        if wrong is not None:
            if gap is None:
                gap, why = at, wrong
            places = [p for p in (data.find(_MAGIC, at + 1), data.find(_VERSION, at + 1)) if p >= 0]
            at = min(places, default=len(data))
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(data) - gap, "reason": why}


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records (kind 'record') and quarantined byte ranges (kind 'gap') of all archives below a path."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("inner_offset", pa.int64()), ("length", pa.int64()), ("reason", pa.string()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            for row in range(batch.num_rows):
                name, held, size = batch.column(0)[row].as_py(), [], 0
                for found in salvage(batch.column(1)[row].as_py() or b""):
                    held.append(found | {"path": name})
                    size += len(found.get("payload") or b"")
                    if size > 8_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return files.mapInArrow(unpack, RECORD_SCHEMA)


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"

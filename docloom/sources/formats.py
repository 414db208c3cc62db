"""Raw payloads to parser results: format dispatch and the text, CSV and email readers."""

from __future__ import annotations

import csv
import hashlib
import io
import sys
from collections.abc import Callable, Iterator, Sequence
from email import message_from_bytes
from email.message import Message
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.binary import contains_bytes, starts_with_bytes, utf8_ignoring_errors
from docloom.functions.text import ROOT, attachment_uri, collapse_whitespace, once, strip_tags

# Media types that name a format, and the text standing in for an empty document.
EMAIL_TYPES = ("message/rfc822", "application/vnd.ms-outlook")
EXCEL_TYPES = ("application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "application/vnd.ms-excel")
EMPTY_DOCUMENT = "(empty document)"


def document_format(content: Column, mime_type: Column, strict_csv: bool = False) -> Column:
    """Format of a payload, tested in the order email, csv, excel, pdf, text.

    Any payload with a comma and a line feed in its first 100 bytes counts as CSV, prose included;
    ``strict_csv`` asks for a declared CSV type instead.
    """
    mime = F.lower(F.coalesce(mime_type, F.lit("")))
    csv_like = mime.endswith("csv")
    if not strict_csv:
        csv_like = csv_like | (contains_bytes(content, b",", 100) & contains_bytes(content, b"\n", 100))
    return (
        F.when(
            mime.isin(*EMAIL_TYPES) | starts_with_bytes(content, b"From:") | contains_bytes(content, b"Content-Type: multipart", 200),
            "email",
        )
        .when(csv_like, "csv")
        .when(mime.isin(*EXCEL_TYPES) | starts_with_bytes(content, b"PK"), "excel")
        .when(mime.startswith("application/pdf") | starts_with_bytes(content, b"%PDF"), "pdf")
        .otherwise("text")
    )


def text_paragraph(content: Column | str) -> Column:
    """The collapsed text of a payload."""
    return once(collapse_whitespace(utf8_ignoring_errors(content)), lambda t: F.when(t == "", EMPTY_DOCUMENT).otherwise(t))


def text_documents(documents: DataFrame, content: str = "content") -> DataFrame:
    """One collapsed paragraph and its length per text payload."""
    text = text_paragraph(content)
    kept = [c for c in documents.columns if c != content]
    return documents.select(*kept, text.alias("paragraph"), F.length(text).cast("long").alias("character_count"))


#: What one pass over a CSV or email payload gives; ``error`` is set and all else null where it cannot be read.
READING = (
    "struct<error:string,records:array<array<string>>,body:string,body_is_html:boolean,subject:string,sender:string,recipient:string,"
    "attachment_names:array<string>,attachments:array<struct<walk_index:int,ord:int,file_name:string,mime_type:string,checksum:string,"
    "size_bytes:bigint,content_id:string,content:binary>>>"
)
_ROW = pa.list_(pa.string())
_MAIL = pa.struct([
    ("error", pa.string()), ("body", pa.string()), ("body_is_html", pa.bool_()), ("subject", pa.string()), ("sender", pa.string()), ("recipient", pa.string()),
    ("attachment_names", pa.list_(pa.string())),
    ("attachments", pa.list_(pa.struct([
        ("walk_index", pa.int32()), ("ord", pa.int32()), ("file_name", pa.string()), ("mime_type", pa.string()), ("checksum", pa.string()),
        ("size_bytes", pa.int64()), ("content_id", pa.string()), ("content", pa.binary()),
    ]))),
])


#: Bytes of payloads read before what they gave is handed on; a larger one is handed on by itself.
SLICE_BYTES = 1 << 22


def _slices(columns: Iterator[pa.Array], sizes: Callable[[pa.Array], pa.Array]) -> Iterator[pa.Array]:
    """Batches cut by the bytes of their payloads, so that what a task holds does not grow with the rows of a batch."""
    for values in columns:
        start, held = 0, 0
        for at, size in enumerate(sizes(values).fill_null(0).to_pylist()):
            if at > start and held + size > SLICE_BYTES:
                yield values.slice(start, at - start)
                start, held = at, 0
            held += size
        if start < len(values) or not len(values):
            yield values.slice(start)


def _csv_records(content: bytes) -> pa.Array:
    """Rows as lists of cells, turned into compact arrays as they are read; a bare carriage return ends a line like any other line end."""
    csv.field_size_limit(sys.maxsize)
    chunks, held, cells = [], [], 0
    for row in csv.reader(io.StringIO(content.decode("utf-8", errors="ignore"), newline="")):
        held.append(row)
        cells += len(row)
        if cells > 50_000:
            chunks.append(pa.array(held, _ROW))
            held, cells = [], 0
    return pa.concat_arrays([*chunks, pa.array(held, _ROW)])


def _fields(values: pa.StructArray) -> list[pa.Array]:
    """Children of a struct, cut as the struct is."""
    return values.flatten()


def _read(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """``READING`` of ``struct<reader, parts, data>``: every payload is read once."""
    for asked in _slices(columns, lambda v: pc.binary_length(_fields(v)[2])):
        records, sizes, mails = [], [], []
        for reader, parts, data in zip(*_fields(asked), strict=True):
            reader, parts = reader.as_py(), parts.as_py()
            data = data.as_py() or b"" if reader or parts else b""
            rows, mail = None, {}
            try:
                if reader == "csv":
                    rows = _csv_records(data)
                if reader == "email" or parts:
                    mail = _mail(data)
            except Exception as error:  # whatever one payload does, the others are read
                # parts may be asked of payloads of another format, which need not be messages
                if reader == "email" or rows is None:
                    rows, mail = None, {"error": f"{type(error).__name__}: {error}"[:500]}
            records.append(rows)
            sizes.append(0 if rows is None else len(rows))
            mails.append(mail)
        offsets = pa.array([0, *accumulate(sizes)], pa.int32())
        listed = pa.ListArray.from_arrays(offsets, pa.concat_arrays([pa.array([], _ROW), *(r for r in records if r is not None)]), mask=pa.array([r is None for r in records], pa.bool_()))
        mail = pa.array(mails, _MAIL)
        found = {f.name: mail.field(i) for i, f in enumerate(_MAIL)}
        names = ["error", "records", *list(found)[1:]]
        yield pa.StructArray.from_arrays([listed if n == "records" else found[n] for n in names], names=names)


def reading(reader: Column, content: Column, parts: Column | None = None) -> Column:
    """Payloads read by the ``csv`` or ``email`` reader, others not touched; ``parts`` asks for attachments besides."""
    wanted = F.coalesce(parts, F.lit(False)) if parts is not None else F.lit(False)
    asked = F.struct(reader.alias("reader"), wanted.alias("parts"), F.when(reader.isNotNull() | wanted, content).alias("data"))
    return F.arrow_udf(_read, READING)(asked)


def reader_of(kind: Column) -> Column:
    """Reader of a format; spreadsheets are read as CSV text."""
    return F.when(kind.isin("csv", "excel"), "csv").when(kind == "email", "email")


def unreadable(documents: DataFrame, content: str = "content", mime_type: str = "mime_type") -> DataFrame:
    """``document_id, reader, error`` of the CSV and email payloads that cannot be read: the quarantine of the readers."""
    reader = reader_of(document_format(F.col(content), F.col(mime_type)))
    asked = documents.select("document_id", reader.alias("reader"), F.col(content).alias("data")).where("reader IS NOT NULL")
    return asked.select("document_id", "reader", reading(F.col("reader"), F.col("data"))["error"].alias("error")).where("error IS NOT NULL")


def csv_cells(documents: DataFrame, content: str = "content") -> DataFrame:
    """Cells of CSV payloads: ``document_id, row_index, column_index, content``.

    Quoted fields may hold line ends, so a payload is read as a whole.  One that cannot be read has no cells;
    ``unreadable`` lists it.
    """
    read = documents.select("document_id", reading(F.lit("csv"), F.col(content))["records"].alias("records"))
    rows = read.select("document_id", F.posexplode("records").alias("row_index", "record"))
    return rows.select("document_id", "row_index", F.posexplode("record").alias("column_index", "content"))


def csv_header(records: Column) -> Column:
    """Cells of the first row; a payload without rows has an empty header."""
    return F.coalesce(F.array_join(F.get(records, 0), ", "), F.lit(""))


def csv_row_count(records: Column) -> Column:
    """Rows up to the last that is not blank, one at least."""
    return F.coalesce(F.array_max(F.transform(records, lambda r, i: F.when(F.size(r) > 0, i + 1))), F.lit(1)).cast("long")


def csv_summaries(documents: DataFrame, content: str = "content") -> DataFrame:
    """Header paragraph and row count of CSV payloads; one that cannot be read counts as empty."""
    read = documents.select("document_id", reading(F.lit("csv"), F.col(content))["records"].alias("records"))
    return read.select("document_id", csv_header(F.col("records")).alias("paragraph"), csv_row_count(F.col("records")).alias("row_count"))


# --- email ---------------------------------------------------------------------------


def _text_of(part: Message) -> str:
    data = part.get_payload(decode=True) or b""
    try:
        return data.decode(part.get_content_charset() or "utf-8", errors="ignore")
    except (LookupError, ValueError):  # a charset nobody knows, or one that is no text encoding
        return data.decode("utf-8", errors="ignore")


def _clean(value) -> str | None:
    """Header text without the lone surrogates that stand for undecoded bytes."""
    return None if value is None else str(value).encode("utf-8", "ignore").decode()


def _body(message: Message) -> tuple[str, bool]:
    """Body text and whether it still carries markup: plain part, then HTML part, then the payload itself."""
    if message.is_multipart():
        for wanted in ("text/plain", "text/html"):
            for part in message.walk():
                if part.get_content_type() == wanted and part.get_payload(decode=True):
                    return _text_of(part), wanted == "text/html"
    return _text_of(message), False


def _mail(content: bytes) -> dict:
    """Body, headers and attachments of a message.

    The walk is flat: an attached message is skipped as such and its own files are listed under the root.
    """
    message = message_from_bytes(content)
    text, is_html = _body(message)
    names, kept = [], []
    for walk, part in enumerate(message.walk()):
        if part.get_content_disposition() != "attachment":
            continue
        name, payload = _clean(part.get_filename()), part.get_payload(decode=True) or b""
        names.append(name)
        if payload:
            kept.append({
                "walk_index": walk, "ord": len(kept), "file_name": name or f"attachment-{walk + 1}", "mime_type": _clean(part.get_content_type()),
                "checksum": hashlib.sha256(payload).hexdigest(), "size_bytes": len(payload), "content_id": _clean(part.get("Content-ID")), "content": payload,
            })
    headers = {k: _clean(message.get(h)) for k, h in (("subject", "Subject"), ("sender", "From"), ("recipient", "To"))}
    return {"body": _clean(text), "body_is_html": is_html, **headers, "attachment_names": names, "attachments": kept}


def mail_body(read: Column) -> Column:
    """Body text, markup taken out."""
    return F.when(read["body_is_html"], collapse_whitespace(strip_tags(read["body"]))).otherwise(read["body"])


def email_documents(documents: DataFrame, content: str = "content") -> DataFrame:
    """Body paragraph, header fields and attachment names of raw messages."""
    read = documents.select("document_id", reading(F.lit("email"), F.col(content)).alias("r")).where("r.error IS NULL")
    return read.select("document_id", mail_body(F.col("r")).alias("body"), "r.subject", "r.sender", "r.recipient", "r.attachment_names")


def attachment_rows(documents: DataFrame, attachments: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Attachments of read messages, one row each, beside ``document_id`` (``source_uri``, and what else to ``keep``).

    Ids use the walk position, part names the position among the kept attachments.
    """
    kept = [c for c in ("document_id", "source_uri", *keep) if c in documents.columns]
    rows = documents.select(*[F.col(c).alias(f"_{c}") for c in kept], F.inline(attachments)).withColumnsRenamed({f"_{c}": c for c in kept})
    number = (F.col("walk_index") + 1).cast("string")
    rows = rows.withColumns(
        {
            "attachment_id": number,
            "child_document_id": F.concat(F.col("document_id"), F.lit("::attachment-"), number),
            "part_id": F.concat(F.lit(f"{ROOT}.attachment-"), (F.col("ord") + 1).cast("string")),
        }
    )
    return rows.withColumn("source_uri", attachment_uri("source_uri", "file_name")) if "source_uri" in kept else rows


def email_parts(documents: DataFrame, content: str = "content") -> DataFrame:
    """Attachments of raw messages, one row each."""
    kept = [c for c in ("document_id", "source_uri") if c in documents.columns]
    read = documents.select(*kept, reading(F.lit("email"), F.col(content))["attachments"].alias("attachments"))
    return attachment_rows(read, F.col("attachments"))


def message_texts(content: bytes) -> list[tuple[bool, str]]:
    """Text parts of a message, each with whether it is HTML; a message without any is one plain part."""
    found = []
    for part in message_from_bytes(content).walk():
        kind = part.get_content_type()
        if not part.is_multipart() and (kind.startswith("text/") or kind == "application/xhtml+xml"):
            found.append((kind in ("text/html", "application/xhtml+xml"), _text_of(part)))
    return found or [(False, content.decode("utf-8", errors="ignore"))]


def _texts(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.list_(pa.struct([("is_html", pa.bool_()), ("text", pa.string())]))
    for values in _slices(columns, pc.binary_length):
        found = []
        for data in values:
            try:
                found.append([{"is_html": h, "text": _clean(t)} for h, t in message_texts(data.as_py() or b"")])
            except Exception:  # listed by ``unreadable``; the other messages are read
                found.append(None)
        yield pa.array(found, kind)


def email_text_parts(documents: DataFrame, content: str = "content") -> DataFrame:
    """Text parts of raw messages as pages; a message without any counts as one plain part."""
    texts = F.arrow_udf(_texts, "array<struct<is_html:boolean,text:string>>")(F.col(content))
    rows = documents.select("document_id", F.posexplode(texts).alias("index", "_t"))
    return rows.select("document_id", "index", "_t.is_html", "_t.text")

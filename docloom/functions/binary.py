"""Byte helpers: base64, UTF-8, hashes and type detection, all JVM-side."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

from docloom.functions.text import strip

_BASE64 = r"^[A-Za-z0-9+/]*={0,2}\z"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def payload_bytes(value: Column | str) -> Column:
    """Strictly valid base64 is decoded, any other text becomes its UTF-8 bytes.

    Spark's decoder accepts embedded whitespace and missing padding, hence the guard.
    """
    text = _col(value)
    strict = text.rlike(_BASE64) & (F.length(text) % 4 == 0)
    # try_to_binary evaluates on every row, so only strict input may reach it
    decoded = F.try_to_binary(F.when(strict, text), F.lit("base64"))
    return F.coalesce(decoded, F.encode(text, "UTF-8"))


def utf8_ignoring_errors(value: Column | str) -> Column:
    """Decode bytes, dropping what is not UTF-8 (a genuine U+FFFD is dropped too)."""
    valid = F.make_valid_utf8(_col(value).cast("string"))
    return F.replace(valid, F.lit("\ufffd"), F.lit(""))


def checksum(value: Column | str) -> Column:
    return F.sha2(_col(value), 256)


def _latin1(value: Column) -> Column:
    return F.decode(value, "ISO-8859-1")


def _magic(prefix: bytes) -> Column:
    return F.unhex(F.lit(prefix.hex()))


def starts_with_bytes(value: Column | str, prefix: bytes) -> Column:
    return F.startswith(_col(value), _magic(prefix))


def contains_bytes(value: Column | str, needle: bytes, within: int) -> Column:
    """Byte search inside the first ``within`` bytes."""
    head = _latin1(F.substring(_col(value), 1, within))
    return F.contains(head, F.lit(needle.decode("latin-1")))


def ascii_share(value: Column | str, sample: int = 128) -> Column:
    """Share of printable ASCII bytes (tab and line ends included) among the leading bytes."""
    head = _latin1(F.substring(_col(value), 1, sample))
    printable = F.length(F.regexp_replace(head, r"[^\x20-\x7e\t\n\r]", ""))
    return F.when(F.length(head) > 0, printable / F.length(head))


def mime_from_bytes(value: Column | str) -> Column:
    """Media type from magic bytes, leading text or ASCII share; null when undecided.

    Archive members are read from the zip central directory records
    (``PK 01 02``, 42 header bytes, name), so no Python worker is needed.
    """
    data = _col(value)
    directory = F.when(starts_with_bytes(data, b"PK\x03\x04"), _latin1(data))

    def has_member(folder: str) -> Column:
        return directory.rlike(r"(?is)PK\x01\x02.{42}" + folder + "/")

    head = F.lower(strip(utf8_ignoring_errors(F.substring(data, 1, 2048))))
    office = "application/vnd.openxmlformats-officedocument."
    return (
        F.when(data.isNull() | (F.length(data) == 0), F.lit(None).cast("string"))
        .when(starts_with_bytes(data, b"%PDF-"), "application/pdf")
        .when(starts_with_bytes(data, b"\xd0\xcf\x11\xe0"), "application/msword")
        .when(has_member("word"), office + "wordprocessingml.document")
        .when(has_member("ppt"), office + "presentationml.presentation")
        .when(has_member("xl"), office + "spreadsheetml.sheet")
        .when(starts_with_bytes(data, b"PK\x03\x04"), "application/zip")
        .when(
            head.startswith("<!doctype html") | head.startswith("<html") | F.substring(head, 1, 200).contains("<html"),
            "text/html",
        )
        .when(head.startswith("<?xml"), "application/xml")
        .when(head.startswith("from:") | head.startswith("received:"), "message/rfc822")
        .when(ascii_share(data) > 0.9, "text/plain")
    )


def mime_from_path(path: Column | str) -> Column:
    """Media type by extension from the standard library's registry, compression suffix removed."""
    registry = mimetypes.MimeTypes(filenames=())
    pairs = {ext.lower().lstrip("."): mime for ext, mime in registry.types_map[True].items()}
    lookup = F.create_map(*[F.lit(x) for pair in sorted(pairs.items()) for x in pair])
    encodings = "|".join(sorted(e.lstrip(".") for e in registry.encodings_map))
    path = F.regexp_replace(_col(path), r"(?i)\.t(gz|az|z|bz2|xz)\z", ".tar.$1")
    bare = F.regexp_replace(path, rf"(?<=[^/])\.(?:{encodings})\z", "")
    extension = F.lower(F.regexp_extract(bare, r"(?s)(?:^|/)\.*[^./][^/]*\.([^./]*)\z", 1))
    return F.try_element_at(lookup, extension)


def sniff_mime(declared: Column, inline: Column, path: Column) -> Column:
    """Declared type, then content, then extension, then the generic binary type."""
    return F.coalesce(
        F.nullif(declared, F.lit("")),
        mime_from_bytes(inline),
        mime_from_path(path),
        F.lit("application/octet-stream"),
    )

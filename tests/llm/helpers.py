"""Small tables and brute-force versions for the corpus operators."""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark: SparkSession, texts: list, ids: list | None = None) -> DataFrame:
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def save_tables(folder, spark: SparkSession, docs: DataFrame, labels: list | None = None, items: list | None = None, pages: DataFrame | None = None) -> str:
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels or [], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items or [], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    if pages is not None:
        pages.write.parquet(f"{folder}/pages.parquet")
    return str(folder)


def ascii_words(text: str | None) -> list[bytes]:
    lower = bytes(i + 32 if 65 <= i <= 90 else i for i in range(256))
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(lower))


def shingles(text: str | None, size: int) -> frozenset:
    w = ascii_words(text)
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def crc(key) -> int:
    return zlib.crc32(b"" if key is None else str(key).encode())


def words_of(seed: int, count: int) -> list[str]:
    """Invented words, the same for a seed."""
    out, x = [], seed * 7919 + 1
    for _ in range(count):
        x = (x * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        out.append("".join("bcdfghklmnprst"[(x >> (8 + 8 * k)) % 14] + "aeiou"[(x >> (12 + 8 * k)) % 5] for k in range(2 + (x >> 60) % 3)))
    return out

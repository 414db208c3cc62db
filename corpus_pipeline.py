"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.  ``run``
applies them to the documents table, each stage's result written as Parquet below the shared folder and read again.

Defined cases: rows of equal doc_id stand or go together in the stages after the first; rows of a null doc_id always stay
there; a document of which line dedup leaves nothing goes; columns besides doc_id and text pass through, n_chars follows
the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm import bitmaps, decontam, jaccard, lines, lm, pieces, quality
from docloom.session import ensure_checkpoint_dir

#: Word shingles and similarity in percent of the near-duplicate stage.
SHINGLE, PERCENT = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled rows outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(lm.remainder("doc_id", 5) != 0)
    model = quality.train(docs, labels)
    score, kept = (bitmaps.unused(docs.columns, n) for n in ("_score", "_kept"))
    return quality.score(docs, model, name=score, decision=kept).where(F.col(kept) == 1).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line matches; a document of which nothing is left goes."""
    count, removed, places = (bitmaps.unused(docs.columns, n) for n in ("_lines", "_removed", "_gone"))
    done = lines.dedup(docs, (count, removed, places)).where((F.col(removed) == 0) | (F.col("text") != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each group of near duplicates."""
    groups = jaccard.join(docs, shingle=SHINGLE, percent=PERCENT)
    return bitmaps.without(docs, groups.where("doc_id <> component_id"), "doc_id")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontam.find(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return bitmaps.without(docs, found, "doc_id")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the decoded text is checked and left out."""
    return pieces.encode_decode(docs).drop("decoded")


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

#: No stage but the second has an SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs

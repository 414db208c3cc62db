"""Idempotent result store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.session import scratch_folder


KEYS = ("document_id", "checksum")


def _ranked(documents: DataFrame) -> DataFrame:
    """Rows with their key and a rank among the rows of one key, from all columns but the bytes."""
    plain = [F.col(f"`{c}`") for c, kind in documents.dtypes if kind != "binary" and not kind.startswith(("map", "variant"))]
    return documents.withColumns({"_key": F.struct(*KEYS), "_rank": F.xxhash64(*plain)})


def _survivors(ranked: DataFrame, stored: DataFrame) -> DataFrame:
    """For each key that is not stored, the lowest rank, how many rows have it, and how many the key has."""
    seen = stored.select(F.struct(*KEYS).alias("_key"))
    ranks = ranked.select("_key", "_rank").groupBy("_key", "_rank").agg(F.count(F.lit(1)).alias("_n"))
    best = ranks.groupBy("_key").agg(F.min(F.struct("_rank", "_n")).alias("_b"), F.sum("_n").alias("_rows"))
    return best.select("_key", F.col("_b._rank").alias("_rank"), F.col("_b._n").alias("_n"), "_rows").join(seen, "_key", "left_anti")


def new_payloads(documents: DataFrame, stored: DataFrame, force: str | None = None) -> DataFrame:
    """Documents whose ``(document_id, checksum)`` is neither stored nor repeated in the batch.

    Keys are compared without the bytes; of rows of one key the one of the lowest rank stays, the same in every run.
    ``force`` names a boolean column; forced rows always pass, every one of them.
    """
    forced = F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False)
    asked = _ranked(documents.where(~forced))
    kept = asked.join(_survivors(asked, stored).select("_key", "_rank"), ["_key", "_rank"], "left_semi").dropDuplicates(["_key", "_rank"])
    fresh = kept.drop("_key", "_rank")
    return fresh.unionByName(documents.where(forced)) if force else fresh


def pending(documents: DataFrame, stored: DataFrame, force: str | None = None) -> DataFrame:
    """As ``new_payloads``, but forced rows of one key stay once, and the plan is made to what is found.

    A first pass reads ids and checksums only and writes which keys survive.  Bytes are read in a second pass, which
    joins the smaller of what stays and what goes; with nothing to drop it joins nothing, so mostly no bytes are shuffled.
    """
    spark = documents.sparkSession
    ranked = _ranked(documents)
    if force:
        forced = documents.where(F.col(force)).select(*KEYS).distinct()
        stored = stored.select(*KEYS).join(forced, list(KEYS), "left_anti")
    path = scratch_folder(spark, "keys")
    _survivors(ranked, stored).write.parquet(path)
    survivors = spark.read.parquet(path)
    total, repeated, stay, rows_of = survivors.agg(
        F.count(F.lit(1)), F.count(F.when(F.col("_n") > 1, 1)), F.sum("_n"), F.sum("_rows")
    ).first()
    rows = documents.count()
    if total == rows:
        return documents
    if not total:
        return documents.where("false")
    if rows_of == rows and stay == total and total * 2 > rows:
        # no key is stored: name the rows that another row of their key outranks
        gone = ranked.select("_key", "_rank").join(survivors.where(F.col("_rows") > F.col("_n")).select("_key", F.col("_rank").alias("_best")), "_key")
        kept = ranked.join(gone.where("_rank <> _best").select("_key", "_rank"), ["_key", "_rank"], "left_anti")
    else:
        # keys are unique, so this is a semi join, but one that is not made anew for each part of a union; the rows come
        # out in the order in which repeated ones are told
        kept = ranked.join(survivors.select("_key", "_rank"), ["_key", "_rank"])
    if repeated:
        kept = kept.dropDuplicates(["_key", "_rank"])
    return kept.drop("_key", "_rank")


def skip_flags(documents: DataFrame, stored: DataFrame) -> DataFrame:
    """Every document with ``skipped``, the outcome of the stored-payload test."""
    keys = ["document_id", "checksum"]
    seen = stored.select(*keys).distinct().withColumn("_stored", F.lit(True))
    joined = documents.join(seen, keys, "left")
    return joined.withColumn("skipped", F.coalesce("_stored", F.lit(False))).drop("_stored")


def append_results(documents: DataFrame, path: str) -> None:
    documents.write.mode("append").parquet(path)

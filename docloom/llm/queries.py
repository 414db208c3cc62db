"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fingerprints, html, jaccard, lines, lm, manifest, merging, pieces, quality, ranked, topk, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(_documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op2_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pieces.encode_decode(_documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"), "round_trip")


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    found = warc.read_archive(spark, f"{folder}/*.txt").where("kind = 'record'")
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS bigint)")
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_edited(_documents(spark, sf_dir).select("doc_id", "text"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = html.add_text(pages, html.learn(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = merging.count_tokens(_documents(spark, sf_dir).select("doc_id", "text"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", lm.remainder("doc_id", 5) == 0)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(lm.remainder("doc_id", 5) != 0)
    model = quality.train(docs.where(~F.col("held_out")), labels)
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_shingles", "component_id", "component_size")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.dedup(_documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), F.col("_gone").alias("removed_lines"), F.sha2("text", 256).alias("text_sha256")
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    marked = docs.withColumn("held_out", lm.remainder("doc_id", 7) == 2)
    model = lm.train(marked.where(~F.col("held_out")))
    scored = lm.score(marked, model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    written = manifest.append(_documents(spark, sf_dir), {"text": tampered})
    return manifest.audit(written).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(_documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_piece_encoding": op2_piece_encoding,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_fingerprints": op4_fingerprints,
    "op5_html_extraction": op5_html_extraction,
    "op6_token_counts": op6_token_counts,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_line_dedup": op9_line_dedup,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_topk_search": op12_topk_search,
    "op13_ranked_search": op13_ranked_search,
}

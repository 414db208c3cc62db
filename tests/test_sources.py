"""Review sources by name and the scan of candidate files."""

import pytest
from pyspark.sql import functions as F

from docloom.sources import reviews

ROWS = "document_id string, canonical_document binary, standardized_output string, insights string, job_id string, review_trigger string, review_required boolean, created_at timestamp"


def rows(spark):
    base = spark.range(60).select(
        F.concat(F.lit("d"), "id").alias("document_id"), F.encode(F.concat(F.lit('{"n":'), "id", F.lit("}")), "UTF-8").alias("canonical_document"),
        F.lit(None).cast("string").alias("standardized_output"), F.lit("{}").alias("insights"), F.lit("j").alias("job_id"),
        F.when(F.col("id") % 3 == 0, "manual").when(F.col("id") % 3 == 1, "a b/c=d").alias("review_trigger"), (F.col("id") % 2 == 0).alias("review_required"),
        F.timestamp_seconds(F.col("id") * 3600).alias("created_at"),
    )
    return base.repartition(1)


def test_files_are_pruned(spark, tmp_path):
    path = str(tmp_path / "c")
    reviews.write_candidates(rows(spark), path)
    scan = reviews.candidate_files(spark, path)
    assert scan.rdd.getNumPartitions() == 6
    columns = reviews.COLUMNS.split(", ")
    want = rows(spark).withColumn("canonical_document", F.col("canonical_document").cast("string"))
    assert sorted(map(tuple, scan.select(columns).collect()), key=repr) == sorted(map(tuple, want.select(columns).collect()), key=repr)
    for condition, files in (
        ("review_required", 3), ("review_required and review_trigger = 'a b/c=d'", 1), ("review_trigger in ('manual', 'x')", 2), ("review_trigger is not null", 4),
        ("review_trigger = 'none'", 0), ("review_trigger is null", 6), ("created_at >= timestamp_seconds(180000) and review_required", 3), ("document_id = 'd4'", 6),
        ("review_required = false or review_trigger = 'manual'", 6),
    ):
        found = reviews.candidate_files(spark, path).where(condition)
        assert found.rdd.getNumPartitions() == max(files, 1), condition
        assert sorted(r.document_id for r in found.collect()) == sorted(r.document_id for r in want.where(condition).collect()), condition


def test_sources_by_name(spark, tmp_path):
    path = str(tmp_path / "c")
    reviews.write_candidates(rows(spark), path)
    found = reviews.candidates(spark, "Files", path=path)
    assert found.count() == 30 and set(found.columns) >= {"document_id", "trigger", "canonical_document"}
    spark.createDataFrame([('{"document_id": "p", "job_id": "j"}',)], "canonical_document string").write.parquet(str(tmp_path / "r"))
    assert [r.document_id for r in reviews.candidates(spark, "payloads", path=str(tmp_path / "r")).collect()] == ["p"]
    rows(spark).createOrReplaceTempView("review_rows")
    assert reviews.candidates(spark, "table", table="review_rows").count() == 30
    with pytest.raises(ValueError, match="files, jdbc, payloads, table"):
        reviews.candidates(spark, "redis")


def test_missing_and_empty_folders(spark, tmp_path):
    path = str(tmp_path / "c")
    reviews.write_candidates(rows(spark).where("document_id = 'none'"), path)
    assert reviews.candidates(spark, "files", path=path).count() == 0

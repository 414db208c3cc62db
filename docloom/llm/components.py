"""Connected components of an edge table, in rounds of joins; nothing is gathered on the driver but counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and root, the smallest node of its component, for every node of the edges.

    Each round links all neighbours of a node, and the node, to the smallest of them (alternating large and small stars),
    which keeps the number of edges and halves paths.  Every round is written to the shared folder.  A node with many
    neighbours costs one row each: minima are combined before the shuffle.
    """
    spark = edges.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/components-{uuid.uuid4().hex}"
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    step = 0

    def save(rows: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        rows.write.parquet(f"{folder}/{step}")
        return spark.read.parquet(f"{folder}/{step}")

    def star(rows: DataFrame, large: bool) -> DataFrame:
        both = rows.union(rows.select("v", "u")) if large else rows.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).withColumnRenamed("u", "c")
        joined = both.join(least, F.col("u") == F.col("c"))
        if large:
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(joined.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    pairs = save(pairs)
    figures = None
    while True:
        pairs = save(star(star(pairs, True), False))
        now = tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
        if now == figures:
            break
        figures = now
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))

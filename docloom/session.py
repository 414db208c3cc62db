"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "docloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the settings the operators expect.

    ``master`` is only passed for local runs; on a cluster it comes from the
    launcher.  Shuffle partition count is left to AQE unless given.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread(rows: DataFrame) -> DataFrame:
    """Use all cores on a scan with too few splits for a costly per-row stage.

    A scan that already has enough partitions, any large one, is left as it is.
    """
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(wanted) if rows.rdd.getNumPartitions() * 2 <= wanted else rows


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only where the cluster names none (local tests) a fresh temporary folder is
    set; a machine-local folder would not survive executor loss on a cluster.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        path = tempfile.mkdtemp(prefix="docloom-checkpoint-", dir=os.environ.get("TMPDIR"))
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def table_exists(spark: SparkSession, path: str) -> bool:
    files, place = _folder(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of frames that nothing refers to any more.

    It does so when the driver has collected its garbage, which may otherwise not happen before the next stage has filled the disks.
    """
    gc.collect()
    spark._jvm.System.gc()


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table; an absent one is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""What a stream has handled: a table of deliveries by key bucket and day sent, with bitmaps in front.

A delivery is ``(delivery_key, receive_count)``.  The key is the message id, or a hash of the message where it has none;
a missing receive count is a first delivery.  The queue keeps the time a message was sent over all its deliveries, so a key is
looked up among its own day's.

Each batch appends its deliveries to a log, and to every ``(day, bucket)`` of it a bitmap of key hashes.  A lookup meets the
bitmaps first: a clear bit means the key is new, which holds for nearly every message, and only the rest is joined with the
deliveries of the days and buckets it names.  ``compact`` rewrites base and log as one table partitioned by day and bucket,
as a new generation; readers go on with the one before until the new one is whole.

Rows keep the run and batch they came from through compaction.  A batch that is replayed leaves its own rows out, so its
replay decides as the first try did.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import blank_to_null
from docloom.session import read_or_empty, remove_folder, table_exists

#: Fixed value: bits of Spark's bitmap aggregates.
BITS = 32768
#: Days beyond which a lookup reads all days instead of naming them.
MOST_DAYS = 366

_DELIVERY = "delivery_key string, receive_count int, succeeded boolean, sent_day date, bucket int"
_SOURCE = "run_id string, batch_id long"
_MAPS = "sent_day date, bucket int, bits binary"


def identified(messages: DataFrame) -> DataFrame:
    """Messages with ``delivery_key`` and a receive count; no two different messages without id share a key."""
    content = F.to_json(F.struct("body", "queue_url", "stream", "sent_at"), {"ignoreNullFields": "false"})
    key = F.coalesce(blank_to_null("message_id"), F.concat(F.lit("body:"), F.sha2(content, 256)))
    return messages.withColumns({"delivery_key": key, "receive_count": F.coalesce("receive_count", F.lit(1))})


def compared_deliveries(batch: DataFrame) -> DataFrame:
    """``batch`` with ``_n``, the deliveries of each row's key, and ``_is_top``, whether the row is the key's latest.

    Latest is the highest receive count, then the time sent.  Only keys meet in the aggregate.
    """
    place = F.struct("receive_count", "sent_at", F.xxhash64(*batch.columns).alias("hash"))
    placed = batch.withColumn("_place", place)
    tops = placed.groupBy("delivery_key").agg(F.max("_place").alias("_top"), F.count(F.lit(1)).alias("_n"))
    return placed.join(tops, "delivery_key").select(*batch.columns, "_n", (F.col("_place") == F.col("_top")).alias("_is_top"))


def latest_deliveries(compared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The latest delivery of each key of ``compared_deliveries``, and the others with ``reason`` and ``copies``.

    Equal rows count as copies of one.  Whole rows are compared for the few keys that come more than once.
    """
    names = [c for c in compared.columns if c not in ("_n", "_is_top")]
    several = compared.where("_n > 1").groupBy(*names, "_is_top").agg(F.count(F.lit(1)).alias("_copies"))
    latest = compared.where("_n = 1").select(*names).unionByName(several.where("_is_top").select(*names))
    reason = F.when(F.col("_is_top"), "repeated").otherwise("superseded")
    copies = F.col("_copies") - F.when(F.col("_is_top"), 1).otherwise(0)
    others = several.select(*names, reason.alias("reason"), copies.alias("copies")).where("copies > 0")
    return latest, others


class Ledger:
    """The handled deliveries below ``path``.  ``buckets`` should be about a ten-thousandth of a day's messages."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path, buckets

    def _hash(self) -> Column:
        return F.pmod(F.xxhash64("delivery_key"), F.lit(self.buckets * BITS))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Day and bucket of each delivery."""
        day = F.coalesce(F.to_date("sent_at"), F.to_date(F.lit("1970-01-01")))
        return rows.withColumns({"sent_day": day, "bucket": F.floor(self._hash() / BITS).cast("int")})

    def generation(self) -> int | None:
        """Number of the last whole compaction."""
        contents = read_or_empty(self.spark, f"{self.path}/contents", f"{_SOURCE}, generation int")
        return contents.agg(F.max("generation")).first()[0]

    def _log(self, table: str, schema: str, generation: int | None) -> DataFrame:
        rows = read_or_empty(self.spark, f"{self.path}/{table}", f"{schema}, {_SOURCE}")
        if generation is None:
            return rows
        contents = self.spark.read.schema(_SOURCE).parquet(f"{self.path}/contents/generation={generation}")
        return rows.join(contents, ["run_id", "batch_id"], "left_anti")

    def _base(self, table: str, schema: str, generation: int | None) -> list[DataFrame]:
        return [] if generation is None else [self.spark.read.schema(schema).parquet(f"{self.path}/{table}/generation={generation}")]

    def deliveries(self) -> DataFrame:
        """Everything handled."""
        generation = self.generation()
        parts = self._base("base", f"{_DELIVERY}, {_SOURCE}", generation) + [self._log("log", _DELIVERY, generation)]
        return reduce(DataFrame.unionByName, parts)

    def _maps(self) -> DataFrame:
        generation = self.generation()
        parts = self._base("base_maps", _MAPS, generation) + [self._log("maps", _MAPS, generation).select("sent_day", "bucket", "bits")]
        return reduce(DataFrame.unionByName, parts)

    def _bitmaps(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("sent_day", "bucket").agg(F.bitmap_construct_agg(self._hash() % BITS).alias("bits"))

    def marked(self, latest: DataFrame) -> DataFrame:
        """``latest`` with day and bucket, and ``suspect``: false where no batch can have seen the key."""
        placed = self._placed(latest)
        if not table_exists(self.spark, f"{self.path}/maps"):
            return placed.withColumn("suspect", F.lit(False))
        maps = self._maps()
        days = [r[0] for r in placed.select("sent_day").distinct().limit(MOST_DAYS + 1).collect()]
        if len(days) <= MOST_DAYS:
            maps = maps.where(F.col("sent_day").isin(days))
        maps = maps.groupBy("sent_day", "bucket").agg(F.bitmap_or_agg("bits").alias("_bits"))
        bit = (self._hash() % BITS).cast("int")
        byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = F.getbit(byte, bit % 8) == 1
        return placed.join(maps, ["sent_day", "bucket"], "left").withColumn("suspect", F.coalesce(held, F.lit(False))).drop("_bits")

    def judge(self, latest: DataFrame, run_id: str, batch_id: int) -> DataFrame:
        """``latest`` with day, bucket and the ``reason`` why a delivery need not be handled, null for those to handle now.

        ``handled_before``: this very delivery was.  ``message_succeeded``: an earlier one of the message did.
        """
        marked = self.marked(latest)
        new = marked.where("not suspect").drop("suspect").withColumn("reason", F.lit(None).cast("string"))
        if not table_exists(self.spark, f"{self.path}/maps"):
            return new
        suspects = marked.where("suspect").drop("suspect")
        places = suspects.select("sent_day", "bucket").distinct().limit(MOST_DAYS * self.buckets + 1).collect()
        handled = self.deliveries().where((F.col("run_id") != run_id) | (F.col("batch_id") != batch_id))
        days, buckets = ({p[i] for p in places} for i in range(2))
        if len(days) <= MOST_DAYS:
            handled = handled.where(F.col("sent_day").isin(list(days)) & F.col("bucket").isin(list(buckets)))
        place = ["sent_day", "bucket", "delivery_key"]
        asked = suspects.select(*place, F.col("receive_count").alias("_own"))
        found = handled.join(asked, place).groupBy(*place).agg(
            F.bool_or(F.col("receive_count") == F.col("_own")).alias("_again"), F.bool_or("succeeded").alias("_done")
        )
        reason = F.when(F.col("_again"), "handled_before").when(F.col("_done"), "message_succeeded")
        judged = suspects.join(found, place, "left").withColumn("reason", reason).drop("_again", "_done")
        return new.unionByName(judged)

    def record(self, outcome: DataFrame, run_id: str, batch_id: int) -> None:
        """Append a batch's deliveries (delivery_key, receive_count, succeeded, sent_at); a replay replaces its own.

        The bitmaps come first: deliveries without theirs would never be looked for.
        """
        place = f"run_id={run_id}/batch_id={batch_id}"
        rows = self._placed(outcome).select("delivery_key", "receive_count", "succeeded", "sent_day", "bucket")
        self._bitmaps(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/maps/{place}")
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{self.path}/log/{place}")

    def compact(self, keep_from: str | None = None) -> int:
        """Make base and log one table, as the next generation, and return its number.

        ``keep_from`` (a date) drops the deliveries of earlier days; their messages would be handled again.
        """
        last = self.generation()
        batches = read_or_empty(self.spark, f"{self.path}/maps", f"{_MAPS}, {_SOURCE}").select("run_id", "batch_id").distinct()
        if last is not None:
            batches = batches.unionByName(self.spark.read.schema(_SOURCE).parquet(f"{self.path}/contents/generation={last}")).distinct()
        # the list is fixed before the rows are read, so a batch written meanwhile stays in the log
        listed = self.spark.createDataFrame(batches.collect(), _SOURCE)
        rows = self.deliveries().join(listed, ["run_id", "batch_id"], "left_semi")
        if keep_from is not None:
            rows = rows.where(F.col("sent_day") >= F.to_date(F.lit(keep_from)))
        number = 0 if last is None else last + 1
        rows.repartition("sent_day", "bucket").write.mode("overwrite").partitionBy("sent_day", "bucket").parquet(f"{self.path}/base/generation={number}")
        written = self.spark.read.schema(f"{_DELIVERY}, {_SOURCE}").parquet(f"{self.path}/base/generation={number}")
        self._bitmaps(written).write.mode("overwrite").parquet(f"{self.path}/base_maps/generation={number}")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/contents/generation={number}")
        return number

    def vacuum(self) -> None:
        """Remove what the last generation has replaced.  No batch may be running."""
        last = self.generation()
        if last is None:
            return
        for r in self.spark.read.schema(_SOURCE).parquet(f"{self.path}/contents/generation={last}").collect():
            for table in ("maps", "log"):
                remove_folder(self.spark, f"{self.path}/{table}/run_id={r['run_id']}/batch_id={r['batch_id']}")
        for number in range(last):
            for table in ("base", "base_maps", "contents"):
                remove_folder(self.spark, f"{self.path}/{table}/generation={number}")

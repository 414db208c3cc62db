"""Queue messages: source, body parsing, rejection split and base records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom import schemas
from docloom.functions.binary import payload_bytes, sniff_mime
from docloom.functions.records import first_truthy, has_key, truthy, valid_json
from docloom.functions.text import blank_to_null, file_extension, object_uri

# Inline payload keys in the order they are tried.
INLINE_KEYS = ("documentBytes", "document_bytes", "documentContent", "document_content", "payload")
INLINE_METADATA_KEYS = ("inlineContent", "inline_content")


def stream_messages(spark: SparkSession, path: str, files_per_batch: int = 10) -> DataFrame:
    """Messages as they land in a folder."""
    reader = spark.readStream.schema(schemas.MESSAGE).option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.MESSAGE).json(path)


def with_suffix(messages: DataFrame, suffix: str, key: str = "source_path") -> DataFrame:
    """Object-created events whose key ends in ``suffix``; an empty suffix keeps all."""
    return messages.where(F.col(key).endswith(suffix)) if suffix else messages


def unwrap_notifications(messages: DataFrame) -> DataFrame:
    """One row per record of an object-created notification, topic envelope removed.

    Bodies that carry no ``Records`` list pass through unchanged.
    """
    inner = F.coalesce(F.get_json_object("body", "$.Message"), F.col("body"))
    listed = F.from_json(F.get_json_object(inner, "$.Records"), "array<string>")
    bodies = F.when(F.size(listed) > 0, listed).otherwise(F.array("body"))
    return messages.withColumn("body", F.explode(bodies))


def parse_messages(messages: DataFrame, accept_source_uri: bool = True, flag: str = "parser_override") -> DataFrame:
    """Add the parsed body, the object key and the rejection reason (null for good rows)."""
    # the generator keeps the optimizer from reading the body again for each test of what is in it
    parsed = messages.withColumn("doc", F.explode(F.array(F.from_json("body", schemas.message_body(flag)))))
    keys = [
        F.col("doc.s3.object.key"),
        F.col("doc.object_key"),
        F.col("doc.objectKey"),
        F.col("doc.source_path"),
    ]
    if accept_source_uri:
        # jobs submitted through the service name their document this way
        keys.append(F.col("doc.source_uri"))
    parsed = parsed.withColumn("source_path", F.coalesce(*[blank_to_null(k) for k in keys]))
    reason = F.when(~valid_json("body"), "invalid_json").when(F.col("source_path").isNull(), "missing_object_key")
    return parsed.withColumn("failure_reason", reason)


def rejected(parsed: DataFrame) -> DataFrame:
    """Quarantine rows of messages that cannot be routed."""
    text = (
        F.when(F.col("failure_reason") == "invalid_json", "Message body is not valid JSON")
        .when(F.col("failure_reason") == "missing_object_key", "Payload missing object key")
    )
    return parsed.where(F.col("failure_reason").isNotNull()).select(
        "message_id",
        "queue_url",
        "failure_reason",
        text.alias("error_message"),
        F.lit(None).cast("string").alias("stacktrace"),
        "receive_count",
        "source_path",
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("failure_reason").isNull()).drop("failure_reason")


def inline_bytes(doc: Column) -> Column:
    """First non-empty inline payload of a parsed body."""
    options = [doc[k] for k in INLINE_KEYS] + [doc["documentMetadata"][k] for k in INLINE_METADATA_KEYS]
    return payload_bytes(F.coalesce(*[blank_to_null(o) for o in options]))


def request_override(body: Column, doc: Column, flag: str) -> Column:
    """Top-level flag if the key is present (even as null), else the one in the routing block.

    The presence test reads the body again, so it runs only where it can matter.
    """
    block = F.coalesce(truthy(doc["routing"]), truthy(doc["overrides"]))
    nested = F.get_json_object(block, f"$.{flag}")
    return F.coalesce(
        doc[flag], F.when(nested.isNotNull() & ~F.coalesce(has_key(body, flag), F.lit(False)), nested)
    )


def describe(messages: DataFrame, flag: str = "parser_override") -> DataFrame:
    """Descriptor columns of accepted messages: bucket, URI, media type, requested parser."""
    doc = F.col("doc")
    declared = first_truthy(doc["documentMetadata"]["contentType"], doc["documentMetadata"]["mimeType"])
    messages = messages.withColumns({"_inline": inline_bytes(doc), "_declared": declared})
    return messages.withColumns(
        {
            "bucket": doc["s3"]["bucket"]["name"],
            "source_uri": object_uri(doc["s3"]["bucket"]["name"], F.col("source_path")),
            "file_type": file_extension("source_path"),
            "sns_topic": doc["TopicArn"],
            "mime_type": sniff_mime(F.col("_declared"), F.col("_inline"), F.col("source_path")),
            "request_override": request_override(F.col("body"), doc, flag),
        }
    ).drop("_inline", "_declared")


def with_job_ids(requests: DataFrame) -> DataFrame:
    """Requests with a random ``job_id`` where they have none.

    Write the result before it is used twice: ids are drawn anew whenever a row is computed again.
    """
    own = blank_to_null("job_id") if "job_id" in requests.columns else F.lit(None).cast("string")
    return requests.withColumn("job_id", F.coalesce(own, F.uuid()))


def job_message(requests: DataFrame) -> DataFrame:
    """Submitted jobs as queue messages; empty optional keys are left out of the body."""
    body = F.to_json(
        F.struct(
            "job_id",
            "source_uri",
            F.coalesce(F.col("priority"), F.lit("normal")).alias("priority"),
            F.lit(schemas.CANONICAL_VERSION).alias("schema_version"),
            blank_to_null("checksum").alias("checksum"),
            blank_to_null("document_type").alias("document_type"),
            blank_to_null("mime_type").alias("mime_type"),
            F.when(F.size("metadata") > 0, F.col("metadata")).alias("metadata"),
            "notification_config",
        )
    )
    return requests.select("job_id", body.alias("body"))


def dedupe_redelivered(messages: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop redelivered messages; on a stream within the watermark delay, which loses later ones.

    Ingestion does not use it on streams: it keeps a table of handled deliveries instead.
    """
    if messages.isStreaming:
        return messages.withWatermark("sent_at", delay).dropDuplicatesWithinWatermark(["message_id"])
    return messages.dropDuplicates(["message_id"])


def attempts(messages: DataFrame) -> DataFrame:
    """Receive count per message over all its deliveries; a missing count is a first delivery."""
    return messages.groupBy("message_id").agg(
        F.max(F.coalesce("receive_count", F.lit(1))).alias("receive_count"), F.count(F.lit(1)).alias("deliveries")
    )


def merge_attempts(parts: DataFrame) -> DataFrame:
    """``attempts`` of all messages from those of parts of them."""
    return parts.groupBy("message_id").agg(F.max("receive_count").alias("receive_count"), F.sum("deliveries").alias("deliveries"))

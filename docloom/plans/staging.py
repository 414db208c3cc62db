"""Views of the test tables in the shape of pipeline inputs.

Each view covers its whole source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.session import spread


# Column types of the provided tables.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": "p_partkey bigint",
    "customer": "c_custkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str, costly: bool = False) -> DataFrame:
    """A provided table; ``costly`` says that much per-row work follows the scan."""
    rows = spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if costly else rows


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(table(spark, sf_dir, "events", costly=True))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream."""
    reader = spark.readStream.schema(TABLE_SCHEMAS[name]).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def messages_from(events: DataFrame) -> DataFrame:
    """``events`` as queue messages: two kinds of broken ones, three key spellings."""
    k, two = F.col("k"), F.lpad(F.col("k").cast("string"), 2, "0")
    user, event = F.col("user_id"), F.col("event_id")
    override = F.when(k % 10 == 0, F.lit(', "routing": {"parser_override": "manual_review"}')).otherwise(F.lit(""))
    body = (
        F.when(F.col("event_type") == "error", '{"documentMetadata": {"pageCount": 3')
        .when(F.col("event_type") == "view", '{"documentMetadata": {"pageCount": "7"}}')
        .when(
            F.col("event_type") == "click",
            _text(
                '{"object_key": "inbox/u', user, "/invoice-", event, '.PDF", "documentMetadata": {"pageCount": ', k,
                ', "layout": {"textDensity": 0.', two, "}}}",
            ),
        )
        .when(
            F.col("event_type") == "signup",
            _text(
                '{"objectKey": "mail/e', event, '.eml", "documentMetadata": {"contentType": "message/rfc822", "layout": ',
                '{"pages": [{"textDensity": 0.6, "checkboxCount": ', k % 2, '}, {"text_density": "0.', two,
                '", "image_density": 0.2, "tableDensity": 0.1, "table_count": ', k % 3, "}]}}}",
            ),
        )
        .otherwise(
            _text(
                '{"s3": {"bucket": {"name": "b', user % 4, '"}, "object": {"key": "scans/', event, '.tiff"}}, ',
                '"TopicArn": "topic-', user % 3, '", "documentMetadata": {"pageCount": "', k,
                '", "layout": {"textDensity": 0.1, "tableDensity": 0.', k % 10, "}}", override, "}",
            )
        )
    )
    return (
        events.withColumn("k", _k())
        .select(
            _text("m-", event).alias("message_id"),
            _text("queue-", user % 4).alias("queue_url"),
            F.when(user % 2 == 0, "invoices").otherwise("contracts").alias("stream"),
            body.alias("body"),
            (1 + k % 6).cast("int").alias("receive_count"),
            F.col("ts").cast("timestamp").alias("sent_at"),
            "event_type",
            "event_id",
            "k",
        )
    )


def deliveries(spark: SparkSession, sf_dir: str, wave: int) -> DataFrame:
    """Deliveries of all events' messages in three waves: late, redelivered, repeated, without id or count."""
    event = F.col("event_id")
    sent = messages(spark, sf_dir)
    first = F.when(event % 13 != 0, 1).cast("int")
    if wave == 0:
        # a seventh of them twice over
        copies = F.sequence(F.lit(1), F.when(event % 7 == 0, 2).otherwise(1))
        sent = sent.where(event % 5 != 0).withColumn("receive_count", first).withColumn("_copy", F.explode(copies)).drop("_copy")
    elif wave == 1:
        on_time = event % 5 != 0
        counts = F.array_compact(
            F.array(
                F.when(~on_time | (event % 17 == 0), F.coalesce(first, F.lit(0))), F.when(on_time & (event % 3 == 0), 2), F.when(on_time & (event % 4 == 0), 3)
            )
        )
        # 0 stands for a missing count
        sent = sent.withColumn("receive_count", F.explode(counts)).withColumn("receive_count", F.nullif("receive_count", F.lit(0)))
    else:
        sent = sent.where("event_type IN ('error', 'view')").withColumn("receive_count", F.lit(5))
    return sent.select(F.when(event % 11 != 0, F.col("message_id")).alias("message_id"), "queue_url", "stream", "body", "receive_count", "sent_at")


def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` rows as pages of the document ``l_orderkey``."""
    flag, status, line = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber")
    zero = F.lit(0).cast("long")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("document_id"),
        (F.col("l_quantity") / 50.0).alias("text_density"),
        (F.col("l_tax") * 7.6).alias("image_density"),
        (F.col("l_discount") * 5.2).alias("table_density"),
        F.col("l_extendedprice").cast("long").alias("char_count"),
        zero.alias("table_count"),
        zero.alias("image_count"),
        F.when((flag == "R") & (line == 1), 1).otherwise(0).cast("long").alias("checkbox_count"),
        F.when((status == "F") & (flag == "A") & (line == 2), 1).otherwise(0).cast("long").alias("radio_button_count"),
    )


def document_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as document descriptors."""
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("document_id"),
        _text(F.lower(priority), "/", F.col("o_orderkey"), ".pdf").alias("source_path"),
        F.lit("application/pdf").alias("mime_type"),
        F.when((priority == "5-LOW") & (F.col("o_orderstatus") == "P"), "force_manual").alias("request_override"),
    )


def text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", costly=True).select(
        _text("d-", F.col("doc_id")).alias("document_id"),
        _text("s3://docs/", F.col("source"), "/", F.col("doc_id"), ".txt").alias("source_uri"),
        "doc_id",
        "text",
        "lang",
        "source",
        "n_chars",
    )


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` rows as three-column table rows; line numbers repeat, so cells collide."""
    order = F.col("l_partkey") * 10000000 + F.round(F.col("l_extendedprice") * 100).cast("long") % 10000000
    content = F.array("l_returnflag", F.lit(""), F.col("l_quantity").cast("int").cast("string"))
    exploded = table(spark, sf_dir, "lineitem", costly=True).select(
        _text("o-", F.col("l_orderkey")).alias("document_id"),
        F.col("l_linenumber").alias("row_index"),
        order.alias("_order"),
        "l_shipdate",
        "l_suppkey",
        F.posexplode(content).alias("column_index", "content"),
    )
    page = (1 + F.col("row_index") % 3).cast("int")
    x, y = F.col("column_index") * 100.0, F.col("row_index") * 20.0
    return exploded.select(
        "document_id",
        F.lit(0).cast("long").alias("table_ord"),
        (F.col("_order") * 4 + F.col("column_index")).alias("cell_ord"),
        "row_index",
        "column_index",
        "content",
        F.lit(0.9).alias("confidence"),
        page.alias("page"),
        F.lit(None).cast("array<double>").alias("polygon"),
        F.array(x, y, x + 90.0, y + 15.0).alias("bounding_box"),
        F.lit(1).alias("row_span"),
        F.when(F.col("column_index") == 2, 2).otherwise(1).alias("column_span"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from(table(spark, sf_dir, "events"))


def telemetry_from(events: DataFrame) -> DataFrame:
    """``events`` as telemetry: errors are failures, the value is the latency."""
    failed = F.col("event_type") == "error"
    return events.select(
        "event_id",
        F.when(failed, "message_failed").otherwise("message_processed").alias("event_name"),
        F.lit("ingestion").alias("job_name"),
        _text("run-", F.col("user_id") % 7).alias("run_id"),
        _text("queue-", F.col("user_id") % 4).alias("queue_url"),
        F.when(failed, "failed").otherwise("succeeded").alias("status"),
        F.col("event_type").alias("source_type"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(~failed, F.round(F.col("value") * 100).cast("long")).alias("latency_ms"),
        _k().alias("queue_depth"),
        F.when(F.col("event_type") == "view", _k() % 5).alias("inflight"),
    )


# --- canonical tables over all text-bearing tables -----------------------------------
#
# documents -> d-<id> (spans), orders/lineitem -> o-<id> (fields, one table), pages -> p-<id> (one visual),
# benchmark -> b-<id> (page segments only), conversations -> c-<id> (turn 0) with the later turns attached.


def _no_box() -> list[Column]:
    empty = F.lit(None).cast("array<double>")
    return [empty.alias("polygon"), empty.alias("bounding_box")]


def _lines(rows: DataFrame, text: str, *keep) -> DataFrame:
    exploded = rows.select(*keep, F.posexplode(F.split(text, "\n", -1)).alias("pos", "content")).where("content <> ''")
    y = (F.col("pos") % 5) * 10.0
    return exploded.select(
        *rows.select(*keep).columns,
        F.col("pos").cast("long").alias("ord"),
        "content",
        F.lit(1.0).alias("confidence"),
        (1 + F.floor(F.col("pos") / 5)).cast("int").alias("page"),
        F.lit(None).cast("array<double>").alias("polygon"),
        F.array(F.lit(0.0), y, F.length("content").cast("double"), y + 8.0).alias("bounding_box"),
        F.lit(None).cast("string").alias("span_id"),
    )


def turn_id() -> Column:
    """Document id of a conversation turn: the root for turn 0, else named by the walk position."""
    conv, turn = F.col("conv_id"), F.col("turn")
    return F.when(turn == 0, _text("c-", conv)).otherwise(_text("c-", conv, "::attachment-", turn + 2))


def order_id() -> Column:
    return _text("o-", F.col("o_orderkey"))


def attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns attached to turn 0; only the assistant's come with a document of their own."""
    turn, conv = F.col("turn"), F.col("conv_id")
    return table(spark, sf_dir, "conversations").where("turn > 0").select(
        _text("c-", conv).alias("document_id"),
        (turn + 1).alias("walk_index"),
        _text("turn-", turn, ".txt").alias("file_name"),
        _text("text/", F.col("role")).alias("mime_type"),
        F.when(F.col("role") == "assistant", _text("c-", conv, "::attachment-", turn + 2)).alias("child_document_id"),
    )


def canonical_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document attributes of every canonical document, roots and attachments."""
    none = F.lit(None).cast("string")

    def meta(**entries: Column) -> Column:
        return F.to_json(F.struct(*[v.alias(k) for k, v in entries.items()]))

    def rows(frame: DataFrame, document_id: Column, kind: Column, mime: str, metadata: Column, root: Column) -> DataFrame:
        return frame.select(
            document_id.alias("document_id"), kind.alias("document_type"), F.lit(mime).alias("mime_type"),
            metadata.alias("metadata"), root.alias("is_root"),
        )

    turn = F.col("turn")
    frames = [
        rows(
            table(spark, sf_dir, "documents"), _text("d-", F.col("doc_id")), none, "text/plain",
            meta(provider=F.lit("text"), lang=F.col("lang"), document_type=F.col("source")), F.lit(True),
        ),
        rows(
            table(spark, sf_dir, "orders"), _text("o-", F.col("o_orderkey")), F.lit("order"), "application/pdf",
            meta(provider=F.lit("forms"), title=_text("Order ", F.col("o_orderkey")), classification_label=F.col("o_orderpriority"), classification_confidence=F.lit("0.75")),
            F.lit(True),
        ),
        rows(table(spark, sf_dir, "pages"), _text("p-", F.col("page_id")), F.lit("page"), "text/html", F.lit("{}"), F.lit(True)),
        rows(table(spark, sf_dir, "benchmark"), _text("b-", F.col("item_id")), none, "text/plain", F.lit("{}"), F.lit(True)),
        rows(
            table(spark, sf_dir, "conversations").where("turn = 0 OR role = 'assistant'"), turn_id(), F.lit("turn"), "message/rfc822",
            meta(provider=F.lit("email")), turn == 0,
        ),
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def document_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(table(spark, sf_dir, "documents", costly=True), "text", _text("d-", F.col("doc_id")).alias("document_id"))


def turn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations", costly=True).where("turn = 0 OR role = 'assistant'")
    return _lines(turns, "text", turn_id().alias("document_id"))


def canonical_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fields per order; the total is a decimal text, the date has no type."""
    entry = F.array(
        F.struct(F.lit("Status").alias("name"), F.col("o_orderstatus").alias("value"), F.lit("code").alias("value_type")),
        F.struct(F.lit("Total").alias("name"), F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("value"), F.lit("cents").alias("value_type")),
        F.struct(F.lit("Priority").alias("name"), F.col("o_orderpriority").alias("value"), F.lit("text").alias("value_type")),
        F.struct(F.lit("Date").alias("name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("value"), F.lit(None).cast("string").alias("value_type")),
    )
    rows = table(spark, sf_dir, "orders").select(_text("o-", F.col("o_orderkey")).alias("document_id"), F.posexplode(entry).alias("pos", "e"))
    return rows.select(
        "document_id", F.col("pos").cast("long").alias("ord"), "e.name", "e.value", F.lit(0.8).alias("confidence"), "e.value_type",
        F.when(F.col("pos") > 0, F.col("pos")).alias("page"), *_no_box(),
    )


def canonical_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.col("page_id").cast("double")
    return table(spark, sf_dir, "pages").select(
        _text("p-", F.col("page_id")).alias("document_id"), F.lit(0).cast("long").alias("ord"), F.col("url").alias("description"),
        F.lit(0.6).alias("confidence"), (F.col("page_id") % 3).cast("int").alias("page"),
        F.array(F.lit(1.0), F.lit(2.0), side + 1.0, F.lit(2.0), side + 1.0, side + 2.0).alias("polygon"),
        F.array().cast("array<double>").alias("bounding_box"), F.array(F.lit("web"), F.lit("page")).alias("tags"),
    )


def canonical_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = F.sequence(F.lit(1), (F.col("item_id") % 3 + 1).cast("int"))
    items = table(spark, sf_dir, "benchmark").select(_text("b-", F.col("item_id")).alias("document_id"), F.explode(pages).alias("page_number"))
    docs = table(spark, sf_dir, "documents").select(_text("d-", F.col("doc_id")).alias("document_id"), F.lit(900).alias("page_number"))
    return items.unionByName(docs)


def canonical_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    number = F.posexplode(F.array(F.lit("first"), F.lit("second"))).alias("pos", "which")
    rows = orders.select("o_orderkey", "o_orderpriority", number)
    return rows.select(
        _text("o-", F.col("o_orderkey")).alias("document_id"), F.col("pos").cast("long").alias("ord"),
        _text(F.col("which"), " summary of ", F.col("o_orderkey")).alias("summary"), F.lit(0.3).alias("confidence"),
        F.lit("heuristic").alias("method"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Urgent "), F.col("which"))).otherwise(F.lit("")).alias("title"),
    )


def canonical_enrichments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two enrichments per labelled document."""
    kinds = F.array(
        F.struct(F.lit("quality_CLASS").alias("t"), F.to_json(F.struct("quality")).alias("c"), F.lit(0.5).alias("conf")),
        F.struct(F.lit("Summaries").alias("t"), F.to_json(F.struct("toxic")).alias("c"), F.lit(None).cast("double").alias("conf")),
    )
    rows = table(spark, sf_dir, "labels").select(_text("d-", F.col("doc_id")).alias("document_id"), F.posexplode(kinds).alias("pos", "k"))
    return rows.select(
        "document_id", F.col("pos").cast("long").alias("ord"), F.col("k.t").alias("enrichment_type"), F.col("k.c").alias("content"),
        F.col("k.conf").alias("confidence"),
    )

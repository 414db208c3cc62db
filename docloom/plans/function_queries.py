"""Registered queries: one small query per function family, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import binary, numbers, records, text
from docloom.operators import routing
from docloom.plans import staging
from docloom.sources import overrides


def fn_whitespace(spark, sf_dir):
    docs = staging.table(spark, sf_dir, "documents")
    padded = F.concat(F.lit(" \t "), "text", F.lit(" \n\x1c"))
    return docs.select(
        "doc_id", F.sha2(text.collapse_whitespace(padded), 256).alias("collapsed"), F.sha2(text.strip(padded), 256).alias("stripped"),
        text.strip_to_null(F.when(F.col("lang") == "en", F.col("text")).otherwise(F.lit("  "))).isNull().alias("blank"),
    )


def fn_sentences(spark, sf_dir):
    docs = staging.table(spark, sf_dir, "documents")
    found = text.sentences("text")
    return docs.select("doc_id", F.size(found).alias("sentences"), F.get(found, 0).alias("first"), F.sha2(F.array_join(found, "|"), 256).alias("checksum"))


def fn_truncate(spark, sf_dir):
    docs = staging.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.truncate_at_space("text", 512).alias("short"), text.truncate_at_space("text", 40).alias("shorter"))


def fn_titles(spark, sf_dir):
    return staging.document_spans(spark, sf_dir).select("document_id", "ord", text.title_like("content").alias("fits"))


def fn_lines(spark, sf_dir):
    docs = staging.table(spark, sf_dir, "documents")
    joined = F.concat("text", F.lit("\r\n\x0b \x0c"), "lang", F.lit(" "), "source", F.lit("\x1e\x85"))
    found = text.lines_without_blanks(joined)
    return docs.select("doc_id", F.size(found).alias("lines"), F.sha2(F.array_join(found, "|"), 256).alias("checksum"))


def fn_paths(spark, sf_dir):
    pages = staging.table(spark, sf_dir, "pages")
    dotted = F.concat(F.lit("a.b/"), F.lit("."), F.col("page_id").cast("string"))
    return pages.select(
        "page_id", text.file_extension("url").alias("extension"), text.file_extension(dotted).alias("hidden"),
        text.file_extension(F.concat("url", F.lit("/x.tar.gz"))).alias("last"),
        text.object_uri(F.when(F.col("page_id") % 2 == 0, "bucket").otherwise(""), "url").alias("uri"),
        text.attachment_uri("url", F.lit("f.txt")).alias("attachment"),
    )


def fn_mime_by_path(spark, sf_dir):
    orders = staging.table(spark, sf_dir, "orders")
    ext = F.when(F.col("o_orderpriority") == "1-URGENT", ".PDF").when(F.col("o_orderpriority") == "2-HIGH", ".csv").when(F.col("o_orderpriority") == "3-MEDIUM", ".tar.gz").when(F.col("o_orderpriority") == "5-LOW", ".html").otherwise("")
    path = F.concat(F.lit("in/"), F.col("o_orderkey").cast("string"), ext)
    return orders.select("o_orderkey", binary.mime_from_path(path).alias("mime_type"))


def fn_json(spark, sf_dir):
    events = staging.messages(spark, sf_dir)
    return events.select(
        "message_id", records.valid_json("body").alias("valid"), records.valid_json(F.concat("body", F.lit(" x"))).alias("valid_with_tail"),
        records.has_key("body", "routing").alias("has_routing"),
        records.truthy(F.get_json_object("body", "$.documentMetadata.pageCount")).alias("page_count"),
    )


def fn_metadata_merge(spark, sf_dir):
    orders = staging.table(spark, sf_dir, "orders")
    provider = F.create_map(F.lit("provider"), F.lit("p"), F.lit("status"), F.lit("unset"))
    payload = records.json_map(F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))))
    caller = F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("priority"), F.lit("caller")))
    merged = records.merge_maps(provider, payload, caller)
    return orders.select("o_orderkey", *[F.try_element_at(merged, F.lit(k)).alias(k) for k in ("provider", "status", "priority")])


def fn_arrays(spark, sf_dir):
    items = staging.table(spark, sf_dir, "lineitem")
    values = numbers.double_array(F.array(F.col("l_linenumber").cast("string"), "l_returnflag", F.lit("2.5"), F.lit("2.5")))
    return items.select(
        "l_orderkey", "l_linenumber", F.size(F.array_distinct(F.array_compact(values))).alias("distinct_values"), F.get(F.array_sort(values), 0).alias("least"),
    )


def fn_rectangles(spark, sf_dir):
    items = staging.table(spark, sf_dir, "lineitem")
    q, n = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    rows = items.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "A", F.array(q, n, n, q)).when(F.col("l_returnflag") == "N", F.array().cast("array<double>")).alias("box"),
        F.when(F.col("l_linestatus") == "O", F.array(q, n, q + 1, n, q + 1, n + 3, q, n + 3)).alias("poly"),
    ).withColumn("r", numbers.rect_of_region("box", "poly"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "r.*", numbers.rect_area("box").alias("area"))


def fn_numbers(spark, sf_dir):
    """Number parsing over values decorated in ways plain casts get wrong."""
    orders = staging.table(spark, sf_dir, "orders")
    n = F.col("o_custkey").cast("string")
    p = F.col("o_orderpriority")
    shown = (
        F.when(p == "1-URGENT", F.concat(F.lit(" "), n, F.lit("e1 "))).when(p == "2-HIGH", F.concat(n, F.lit("d")))
        .when(p == "3-MEDIUM", F.concat(n, F.lit("_0"))).when(p == "5-LOW", F.concat(n, F.lit(".5"))).otherwise(p)
    )
    return orders.select(
        "o_orderkey", numbers.parse_double(shown).alias("number"), numbers.parse_int(shown).alias("whole"), numbers.parse_count(shown).alias("count"),
        numbers.confidence_or_one(F.when(p == "2-HIGH", shown)).alias("confidence"), numbers.bad_confidence(shown).alias("bad"),
    )


def fn_iso_time(spark, sf_dir):
    events = staging.table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    shown = records.format_wire_time("at")
    return events.select(
        "event_id", shown.alias("shown"), (records.parse_wire_time(shown) == F.col("at")).alias("same"), records.epoch_millis("at").alias("millis"),
        records.parse_wire_time(F.lit("not a time")).isNull().alias("bad_is_null"),
    )


def fn_base64(spark, sf_dir):
    docs = staging.table(spark, sf_dir, "documents")
    coded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"[\r\n]", "")
    size = lambda c: F.length(binary.payload_bytes(c))
    return docs.select(
        "doc_id", size(coded).alias("decoded"), size(F.concat(coded, F.lit("\n"))).alias("with_newline"), size(F.concat(F.lit("abc"), coded)).alias("shifted"),
        size("lang").alias("lang_bytes"), binary.checksum("text").alias("checksum"),
    )


def fn_utf8(spark, sf_dir):
    """Texts with a stray byte in front and a cut character behind."""
    docs = staging.table(spark, sf_dir, "documents")
    dirty = F.concat(F.unhex(F.lit("FF")), F.encode("text", "UTF-8"), F.unhex(F.lit("C3")))
    return docs.select("doc_id", F.sha2(binary.utf8_ignoring_errors(dirty), 256).alias("checksum"), F.round(binary.ascii_share(F.encode("text", "UTF-8")), 6).alias("ascii_share"))


def fn_key_match(spark, sf_dir):
    """Which of two patterns is found in a key, each as the one rule of a table."""
    keys = staging.document_keys(spark, sf_dir)
    for name, pattern in (("first", "(?i)URGENT/1"), ("second", "[02468][.]pdf$")):
        rule = spark.createDataFrame([(0, pattern, "s")], "position long, pattern string, strategy string")
        matched = routing.match_rules(keys, overrides.layer_rules(overrides.rules_from_table(rule)))
        keys = matched.withColumn(name, F.col("_rule").isNotNull()).drop("_rule")
    return keys.select("source_path", "first", "second")


def fn_block_ids(spark, sf_dir):
    turns = staging.table(spark, sf_dir, "conversations")
    part = F.when(F.col("turn") == 0, text.ROOT).otherwise(text.child_part(F.lit(text.ROOT), F.col("turn") - 1))
    return turns.select(
        "conv_id", "turn", text.part_id(part).alias("part_id"), text.block_id(part, "span", "turn").alias("block_id"),
        text.key_value_text("role", F.when(F.col("turn") > 1, F.col("text"))).alias("pair"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        fn_whitespace, fn_sentences, fn_truncate, fn_titles, fn_lines, fn_paths, fn_mime_by_path, fn_json, fn_metadata_merge,
        fn_arrays, fn_rectangles, fn_numbers, fn_iso_time, fn_base64, fn_utf8, fn_key_match, fn_block_ids,
    )
}

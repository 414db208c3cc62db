"""Registered queries: messages, layout profiles and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.config import RoutingConfig, Strategy
from docloom.operators import layout, routing
from docloom.plans import staging
from docloom.sources import messages as msg
from docloom.sources import overrides

CONFIG = RoutingConfig(
    strategies={
        "short_form": Strategy("general_short", "prebuilt-read"),
        "long_form": Strategy("long_form_parser", "prebuilt-layout", 500),
        "table_heavy": "table_extractor",
        "form_heavy": "form_parser",
        "scanned": Strategy("vision_parser", "vision-v2"),
    },
    fallback=Strategy("fallback_parser", "fallback-v1"),
    short_form_pages=3,
    long_form_pages=6,
    page_limits={"short_form": 2, "long_form": 8, "table_heavy": 4, "form_heavy": 0},
)
STATIC_CONFIG = RoutingConfig(mode="static", static=Strategy("one_parser", "one-v1", 40))
MESSAGE_CONFIG = RoutingConfig(
    strategies={"short_form": "general_short", "table_heavy": "table_extractor", "form_heavy": "form_parser"},
    page_limits={"short_form": 10},
)
RULES = """{"pattern_overrides": [
    {"pattern": "(?i)URGENT", "strategy": "urgent_parser", "model": "urgent-v1", "max_pages": 25},
    {"pattern": "([", "strategy": "never"},
    {"pattern": "^2-high/.*9[.]pdf$", "name": "high_nine"},
    {"document_pattern": "high", "strategy": "high_parser"},
    {"pattern": "", "strategy": "never"}]}"""
MESSAGE_RULES = '[{"pattern": "u1[0-9]*/invoice", "strategy": "invoice_parser", "model": "custom-invoice-v1"}]'
RULE_SCHEMA = "payload string"


def _rules(spark: SparkSession, text: str) -> DataFrame:
    return overrides.layer_rules(overrides.rules_from_json(spark.createDataFrame([(text,)], RULE_SCHEMA)))


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = layout.profile_pages(staging.page_metrics(spark, sf_dir), ["document_id"])
    return staging.document_keys(spark, sf_dir).join(profile, "document_id", "left").fillna(0, ["page_count"])


def _rounded(columns: list[str]) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


DENSITIES = ["average_text_density", "average_image_density"]
SHARES = ["table_page_ratio", "scanned_page_ratio", "checkbox_page_ratio", "radio_button_page_ratio", "form_page_ratio"]
DECISION = [
    "document_category", "parser_strategy", "strategy_reason", "parser_model", "strategy_max_pages", "overrides_applied",
]


def layout_profile(spark, sf_dir):
    profile = layout.profile_pages(staging.page_metrics(spark, sf_dir), ["document_id"])
    return profile.select(
        "document_id", "page_count", *_rounded(DENSITIES + SHARES), "total_tables", "total_checkboxes", "total_radio_buttons"
    )


def route_documents(spark, sf_dir):
    routed = routing.choose_strategy(_profiled(spark, sf_dir), CONFIG, _rules(spark, RULES))
    return routed.select("source_path", "page_count", *_rounded(DENSITIES), *DECISION, "request_override")


def route_documents_static(spark, sf_dir):
    routed = routing.choose_strategy(_profiled(spark, sf_dir), STATIC_CONFIG, _rules(spark, RULES))
    return routed.groupBy("parser_strategy", "strategy_reason", "parser_model", "strategy_max_pages").agg(
        F.count(F.lit(1)).alias("documents")
    )


def category_mix(spark, sf_dir):
    routed = _profiled(spark, sf_dir).withColumn("document_category", routing.categorise(CONFIG))
    return routed.groupBy("document_category").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("page_count").alias("pages")
    )


def override_precedence(spark, sf_dir):
    """Three rule layers over every document: the first layer with a match decides."""
    first = overrides.rules_from_json(
        spark.createDataFrame([('{"pattern": "7[.]pdf$", "strategy": "secret_layer"}',)], RULE_SCHEMA)
    )
    second = overrides.rules_from_table(
        spark.createDataFrame(
            [(0, "urgent", None, "table_layer", 9), (1, "low", "not specified", "table_layer_pattern", None)],
            "position long, pattern string, document_pattern string, strategy string, max_pages int",
        )
    )
    third = overrides.rules_from_json(
        spark.createDataFrame([('[{"pattern": "low", "strategy": "env_layer"}, {"pattern": "[.]pdf", "name": "env_rest"}]',)], RULE_SCHEMA)
    )
    rules = overrides.layer_rules(first, second, third)
    matched = routing.match_rules(staging.document_keys(spark, sf_dir), rules)
    return matched.select(
        "source_path",
        F.coalesce("request_override", F.col("_rule.name")).alias("strategy"),
        F.when(F.col("request_override").isNotNull(), "request").otherwise(F.col("_rule.applied")).alias("applied"),
    )


def _many_rules(spark, sf_dir) -> DataFrame:
    """Three layers: a table with a rule for each part, a payload for each customer, a list for each nation."""
    part, cust, nation = F.col("p_partkey"), F.col("c_custkey"), F.col("n_nationkey")
    text = lambda *pieces: F.concat(*[p.cast("string") if not isinstance(p, str) else F.lit(p) for p in pieces])
    first = overrides.rules_from_table(
        staging.table(spark, sf_dir, "part").select(
            part.alias("position"), text("^[12]-[a-z]*/", part * 7, "[.]pdf$").alias("pattern"), text("part-", part % 10).alias("strategy"),
            text("model-", part % 3).alias("model"), (part % 50).alias("max_pages"),
        )
    )
    second = overrides.rules_from_json(
        staging.table(spark, sf_dir, "customer").select(
            cust.alias("source_order"), F.to_json(F.struct(text("(?i)LOW/", cust, "[0-9]?[.]PDF$").alias("pattern"), text("customer-", cust % 10).alias("strategy"))).alias("payload")
        )
    )
    ending = F.struct(text("3-medium/.*", nation, "[.]pdf").alias("document_pattern"), text("ending-", nation).alias("name"))
    # a pattern in which no text is certain
    digits = F.struct(text(r"^[4]\W\w+\W\w+[/]\d{", nation + 1, r"}\W").alias("document_pattern"), text("digits-", nation).alias("name"))
    third = overrides.rules_from_json(
        staging.table(spark, sf_dir, "nation").select(nation.alias("source_order"), F.to_json(F.array(ending, digits)).alias("payload"))
    )
    return overrides.layer_rules(first, second, third)


def override_many(spark, sf_dir):
    """Rules by the thousand over every document, through the index."""
    matched = routing.match_rules(staging.document_keys(spark, sf_dir), _many_rules(spark, sf_dir))
    return matched.select("source_path", F.col("_rule.name").alias("strategy"), "_rule.model", "_rule.max_pages", "_rule.applied")


def override_sources(spark, sf_dir):
    """Rule payloads built from ``nation``: each row is a list, a wrapped list or one object."""
    nation = staging.table(spark, sf_dir, "nation")
    one = F.format_string('{"pattern": "%s/.*", "strategy": "s%s", "max_pages": %s}', F.lower("n_name"), F.col("n_regionkey"), F.col("n_nationkey"))
    other = F.format_string('{"document_pattern": "%s-doc", "name": "t%s"}', F.lower("n_name"), F.col("n_nationkey"))
    third = F.lit('{"pattern": "x"}')
    kind = F.col("n_nationkey") % 4
    payload = (
        F.when(kind == 0, F.concat(F.lit("["), one, F.lit(","), other, F.lit(","), third, F.lit("]")))
        .when(kind == 1, F.concat(F.lit('{"pattern_overrides": ['), other, F.lit(","), one, F.lit("]}")))
        .when(kind == 2, one)
        .otherwise(F.lit("{broken"))
    )
    rules = overrides.rules_from_json(nation.select("n_nationkey", payload.alias("payload")))
    return rules.select("n_nationkey", "position", "pattern", "strategy", "max_pages")


def _parsed(spark, sf_dir):
    return msg.parse_messages(staging.messages(spark, sf_dir))


def _routed(spark, sf_dir):
    return routing.route_messages(msg.accepted(_parsed(spark, sf_dir)), MESSAGE_CONFIG, _rules(spark, MESSAGE_RULES))


def message_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select("message_id", "source_path", "failure_reason", "receive_count")


def message_quarantine(spark, sf_dir):
    return msg.rejected(_parsed(spark, sf_dir)).select(
        "message_id", "queue_url", "failure_reason", "receive_count", "source_path"
    )


def failure_breakdown(spark, sf_dir):
    return msg.rejected(_parsed(spark, sf_dir)).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("failures"))


def message_descriptors(spark, sf_dir):
    described = msg.describe(msg.accepted(_parsed(spark, sf_dir)))
    return described.select(
        "message_id", "bucket", "source_uri", "file_type", "sns_topic", "mime_type", "request_override"
    )


def ingestion_metadata(spark, sf_dir):
    records = routing.message_metadata(_routed(spark, sf_dir))
    return records.select(
        "source_path", "file_type", "message_id", "sns_topic", "queue_url", "mime_type", "page_count",
        *_rounded(["layout_density", "image_density"] + SHARES),
        "total_tables", "total_checkboxes", "document_category", "parser_strategy", "strategy_reason", "parser_model",
        "strategy_max_pages", "overrides_applied", "request_override",
        F.json_array_length("page_metrics").alias("listed_pages"),
    )


def routing_records(spark, sf_dir):
    """The stored JSON decision read back."""
    records = routing.routing_record(_routed(spark, sf_dir))
    # one reading of each record
    schema = "category string, strategy string, overrides array<string>, average_text_density double, page_metrics array<struct<index:int>>"
    return records.select("source_path", F.from_json("routing", schema).alias("r")).select(
        "source_path",
        "r.category",
        "r.strategy",
        F.get("r.overrides", 0).alias("override"),
        F.round("r.average_text_density", 6).alias("average_text_density"),
        F.get("r.page_metrics", 0)["index"].alias("first_page"),
    )


def page_payloads(spark, sf_dir):
    """Every page metric read from message bodies, listed and synthetic."""
    laid_out = layout.message_layout(msg.accepted(_parsed(spark, sf_dir)))
    pages = laid_out.select("message_id", F.explode(layout.page_array()).alias("p"))
    return pages.select(
        "message_id", "p.index", F.round("p.text_density", 6).alias("text_density"),
        F.round("p.image_density", 6).alias("image_density"), F.round("p.table_density", 6).alias("table_density"),
        "p.table_count", "p.checkbox_count",
    )


def synthetic_pages(spark, sf_dir):
    laid_out = layout.message_layout(msg.accepted(_parsed(spark, sf_dir)))
    return (
        laid_out.where(F.size("listed_pages") == 0)
        .select("message_id", F.explode(F.sequence(F.lit(0), F.col("synthetic_count").cast("int") - 1)).alias("index"))
        .groupBy("message_id")
        .agg(F.count(F.lit(1)).alias("pages"), F.max("index").alias("last_index"))
    )


def document_pages_json(spark, sf_dir):
    """Page metrics of a page table packed as JSON per document; one output column per check."""
    pages = staging.page_metrics(spark, sf_dir).withColumn("index", (F.col("char_count") % 100000).cast("int"))
    packed = routing.pages_json(pages, ["document_id"])
    entries = F.from_json("page_metrics", "array<struct<index:int,char_count:long>>")
    return packed.select(
        "document_id",
        F.size(entries).cast("long").alias("pages"),
        F.aggregate(entries, F.lit(0).cast("long"), lambda acc, e: acc + e["char_count"]).alias("chars"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        layout_profile, route_documents, route_documents_static, category_mix, override_precedence, override_many, override_sources,
        message_parse, message_quarantine, failure_breakdown, message_descriptors, ingestion_metadata, routing_records,
        page_payloads, synthetic_pages, document_pages_json,
    )
}

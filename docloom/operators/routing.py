"""Category, strategy and metadata record of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.config import RoutingConfig, Strategy
from docloom.functions.assembly import ordered_concat
from docloom.functions.text import blank_to_null
from docloom.operators.layout import message_layout, page_array_json, profile_messages
from docloom.sources.messages import describe
from docloom.operators import rule_index
from docloom.sources.overrides import checked_rules

# rules compiled into one expression; longer tables go through an index
RULES_PER_PASS = 200


def categorise(config: RoutingConfig) -> Column:
    """Ordered category test over profile columns.

    Means are rounded to nine places first: their last bit depends on partial-aggregation order.
    """

    def value(name: str) -> Column:
        return F.round(F.col(name), 9)

    pages = F.col("page_count")
    return (
        F.when(pages == 0, "unknown")
        .when(value("scanned_page_ratio") >= config.scanned_share, "scanned")
        .when(value("table_page_ratio") >= config.table_share, "table_heavy")
        .when(value("form_page_ratio") >= config.form_share, "form_heavy")
        .when(pages >= config.long_form_pages, "long_form")
        .when(
            (pages <= config.short_form_pages) & (value("average_text_density") >= config.short_form_density),
            "short_form",
        )
        .otherwise("unknown")
    )


_PARTS = ("name", "reason", "model", "max_pages", "applied")


def _lookup(choices: list[tuple], position: Column) -> list[Column]:
    """Decision parts at ``position`` from constant arrays: one folded literal per part."""
    columns = []
    for i, part in enumerate(_PARTS):
        kind = "array<int>" if part == "max_pages" else "array<string>"
        values = F.array(*[F.lit(choice[i]) for choice in choices]).cast(kind)
        columns.append(F.get(values, position).alias(part))
    return columns


def match_rules(documents: DataFrame, rules: DataFrame | None, key: str = "source_path") -> DataFrame:
    """Add ``_rule``: the first rule, by priority, whose regex is found in the key.

    A few rules become a first-match expression, without a join or a shuffle of documents.  A longer table is written as an
    index that the distinct keys are joined with (``rule_index``), so neither the plan nor a task grows with it.
    """
    if rules is None:
        return documents.withColumn("_rule", F.lit(None).cast(rule_index.DECISION))
    usable = checked_rules(rules).where("usable")
    few = usable.orderBy("priority").limit(RULES_PER_PASS + 1).collect()
    if len(few) > RULES_PER_PASS:
        return rule_index.with_first_match(documents, rule_index.write_index(usable), key)
    if not few:
        return documents.withColumn("_rule", F.lit(None).cast(rule_index.DECISION))
    text = F.coalesce(F.col(key), F.lit(""))
    hits = [F.when(text.rlike(rule["pattern"]), F.lit(i)) for i, rule in enumerate(few)]
    choices = [(r["strategy"], "config_pattern_override", r["model"], r["max_pages"], "pattern:" + r["pattern"]) for r in few]
    documents = documents.withColumn("_hit", F.coalesce(*hits))
    found = F.when(F.col("_hit").isNotNull(), F.struct(*_lookup(choices, F.col("_hit"))))
    return documents.withColumn("_rule", found).drop("_hit")


def choose_strategy(documents: DataFrame, config: RoutingConfig, rules: DataFrame | None = None) -> DataFrame:
    """Add ``document_category`` and the strategy columns to profiled documents.

    Order: request override, first matching rule, static mode, page-limit redirect, category default.
    """
    documents = documents.withColumn("document_category", categorise(config))
    documents = match_rules(documents, rules)
    category, pages = F.col("document_category"), F.col("page_count")
    requested, by_rule = -2, -1
    conditions = [
        F.when(blank_to_null("request_override").isNotNull(), F.lit(requested)),
        F.when(F.col("_rule").isNotNull(), F.lit(by_rule)),
    ]
    choices: list[tuple] = []

    def add(strategy: Strategy, reason: str, applied: str, condition: Column, max_pages: int | None) -> None:
        conditions.append(F.when(condition, F.lit(len(choices))))
        choices.append((strategy.name, reason, strategy.model, max_pages, applied))

    static = config.static_strategy()
    if config.mode == "static" and static:
        add(static, "config_static", "static_config", F.lit(True), static.max_pages)
    else:
        for name, limit in config.page_limits.items():
            if limit:
                over = (category == name) & (pages > limit)
                add(config.fallback_strategy(), "page_threshold_exceeded", "threshold_redirect", over, limit)
        for name, strategy in config.strategy_by_category().items():
            add(strategy, "category_default", "category_default", category == name, strategy.max_pages)

    documents = documents.withColumn("_choice", F.coalesce(*conditions))
    position, rule = F.col("_choice"), F.col("_rule")
    fixed = dict(zip(_PARTS, _lookup(choices, F.when(position >= 0, position))))
    on_request = {"name": F.col("request_override"), "reason": F.lit("request_override"), "applied": F.lit("request")}

    def part(name: str) -> Column:
        from_request = on_request.get(name, F.lit(None))
        return F.when(position == requested, from_request).when(position == by_rule, rule[name]).otherwise(fixed[name])

    return documents.withColumns(
        {
            "parser_strategy": part("name"),
            "strategy_reason": part("reason"),
            "parser_model": part("model"),
            "strategy_max_pages": part("max_pages"),
            "overrides_applied": part("applied"),
        }
    ).drop("_choice", "_rule")


ROUTING_COLUMNS = (
    "mime_type",
    "page_count",
    "layout_density",
    "image_density",
    "table_page_ratio",
    "scanned_page_ratio",
    "checkbox_page_ratio",
    "radio_button_page_ratio",
    "form_page_ratio",
    "total_tables",
    "total_checkboxes",
    "total_radio_buttons",
    "document_category",
    "parser_strategy",
    "strategy_reason",
    "parser_model",
    "strategy_max_pages",
    "overrides_applied",
    "request_override",
)


def metadata_record(routed: DataFrame, base: list[str], pages: Column | None = None) -> DataFrame:
    """Stored routing columns behind the base columns; ``pages`` is JSON text of the page metrics."""
    renamed = routed.withColumnsRenamed(
        {"average_text_density": "layout_density", "average_image_density": "image_density"}
    )
    extra = [] if pages is None else [pages.alias("page_metrics")]
    return renamed.select(*base, *ROUTING_COLUMNS, *extra)


def routing_record(routed: DataFrame, pages: Column | None = None) -> DataFrame:
    """``source_path`` plus the whole decision as one JSON column; without ``pages`` those of ``message_layout`` rows."""
    decision = F.struct(
        F.col("document_category").alias("category"),
        F.col("parser_strategy").alias("strategy"),
        F.col("strategy_reason").alias("reason"),
        F.col("parser_model").alias("model"),
        F.col("strategy_max_pages").alias("max_pages"),
        F.array_compact(F.array("overrides_applied")).alias("overrides"),
        "request_override",
        "average_text_density",
        "average_image_density",
        "table_page_ratio",
        "scanned_page_ratio",
        "checkbox_page_ratio",
        "radio_button_page_ratio",
        "form_page_ratio",
        "total_tables",
        "total_checkboxes",
        "total_radio_buttons",
        *([] if pages is None else [pages.alias("page_metrics")]),
    )
    text = F.to_json(decision, {"ignoreNullFields": "false"})
    if pages is None:
        # the page list is text already
        text = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(',"page_metrics":'), page_array_json(), F.lit("}"))
    return routed.select("source_path", text.alias("routing"))


def pages_json(pages: DataFrame, keys: list[str], index: str = "index") -> DataFrame:
    """Page metrics of a page table as one JSON list per document, chunk by chunk."""
    names = ("index", "text_density", "image_density", "table_density", "char_count", "table_count")
    names += ("image_count", "checkbox_count", "radio_button_count")
    item = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    joined = ordered_concat(pages.withColumn("_item", item), keys, index, "_item", ", ", "_items")
    return joined.select(*keys, F.concat(F.lit("["), F.col("_items"), F.lit("]")).alias("page_metrics"))


def route_messages(
    accepted: DataFrame, config: RoutingConfig, rules: DataFrame | None = None
) -> DataFrame:
    """Describe, profile and route accepted messages in one narrow stage."""
    described = describe(accepted, config.override_flag)
    return choose_strategy(profile_messages(message_layout(described)), config, rules)


def message_metadata(routed: DataFrame) -> DataFrame:
    """Metadata rows of routed messages, pages as JSON."""
    base = ["source_path", "file_type", "message_id", "sns_topic", "queue_url"]
    return metadata_record(routed, base, page_array_json())

"""Pattern override rules: table and JSON sources, validation, layering."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.numbers import parse_count
from docloom.functions.records import first_truthy, has_key

_ENTRY = "struct<pattern:string,document_pattern:string,strategy:string,name:string,model:string,max_pages:string>"

def rules_from_table(rows: DataFrame) -> DataFrame:
    """Rules of a table; ``document_pattern`` beats ``pattern``.  A table has no order of its own: ``position`` gives it."""
    if "position" not in rows.columns:
        raise ValueError("a rule table needs a position column")
    optional = {c: F.col(c) if c in rows.columns else F.lit(None) for c in ("document_pattern", "pattern", "model", "max_pages")}
    pattern = first_truthy(optional["document_pattern"].cast("string"), optional["pattern"].cast("string"))
    return _usable(
        rows.select(
            F.col("position").cast("long"),
            pattern.alias("pattern"),
            F.col("strategy"),
            optional["model"].cast("string").alias("model"),
            parse_count(optional["max_pages"].cast("string")).cast("int").alias("max_pages"),
        )
    )


def rules_from_json(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rules of JSON text: a list, ``{"pattern_overrides": [...]}`` or a single object.

    Broken JSON yields no rules.  ``position`` counts inside one payload; a column ``source_order`` orders several payloads.
    """
    text = F.col(column)
    entries = F.when(
        F.trim(text).startswith("["), F.from_json(text, f"array<{_ENTRY}>")
    ).when(
        has_key(text, "pattern_overrides"),
        F.from_json(F.get_json_object(text, "$.pattern_overrides"), f"array<{_ENTRY}>"),
    ).otherwise(F.array(F.from_json(text, _ENTRY)))
    rows = payloads.select("*", F.posexplode(entries).alias("position", "entry"))
    kept = [c for c in payloads.columns if c != column]
    return _usable(
        rows.select(
            *kept,
            F.col("position").cast("long").alias("position"),
            first_truthy(F.col("entry.pattern"), F.col("entry.document_pattern")).alias("pattern"),
            first_truthy(F.col("entry.strategy"), F.col("entry.name")).alias("strategy"),
            F.col("entry.model").alias("model"),
            parse_count("entry.max_pages").cast("int").alias("max_pages"),
        )
    )


def _usable(rules: DataFrame) -> DataFrame:
    return rules.where("pattern <> '' AND strategy <> ''")


def layer_rules(*layers: DataFrame) -> DataFrame:
    """Union of rule sources; earlier layers win, then ``source_order``, then ``position``.

    ``priority`` orders by these and, last, by the rule itself, so only equal rules tie.
    """
    rule = ["pattern", "strategy", "model", "max_pages"]
    tagged = []
    for i, layer in enumerate(layers):
        source = F.col("source_order").cast("long") if "source_order" in layer.columns else F.lit(0).cast("long")
        place = F.struct(F.lit(i).alias("layer"), source.alias("source_order"), F.col("position").cast("long").alias("position"), *rule)
        tagged.append(layer.select(place.alias("priority"), *rule))
    return reduce(DataFrame.unionByName, tagged)


def _compiles_here(patterns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    def compiles(pattern: str | None) -> bool:
        try:
            re.compile(pattern or "")
        except (re.error, RecursionError, OverflowError):
            return False
        return True

    for values in patterns:
        yield pa.array([compiles(v) for v in values.to_pylist()], pa.bool_())


def checked_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with ``usable``: whether the pattern compiles both in Spark's regex engine and in Python's."""
    in_spark = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("compile"), F.col("pattern")).isNotNull()
    here = F.arrow_udf(_compiles_here, "boolean")
    return rules.distinct().withColumn("usable", in_spark & here("pattern"))


def rejected_rules(rules: DataFrame) -> DataFrame:
    """Rules that are left out because their pattern does not compile in both regex engines."""
    return checked_rules(rules).where("not usable").select("pattern", "strategy")

"""JSON, map and time helpers shared by the adapters and services."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: wire format of every timestamp in job and notification payloads.
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def valid_json(value: Column | str) -> Column:
    """One JSON value and nothing behind it; the other parsers ignore trailing text."""
    listed = F.json_array_length(F.concat(F.lit("["), _col(value), F.lit("]")))
    return F.coalesce(listed == 1, F.lit(False))


def truthy_variant(value: Column) -> Column:
    """Text of a variant scalar, null for those an ``or`` chain skips (unlike the string "0")."""
    kind, text = F.schema_of_variant(value), value.cast("string")
    return F.when(kind == "STRING", F.nullif(text, F.lit(""))).otherwise(truthy(text))


def first_scalar(*values: Column) -> Column:
    """First of several variant scalars that an ``or`` chain stops at, as text: the strings "0" and "false" count."""
    return F.coalesce(*[truthy_variant(v) for v in values])


def has_key(value: Column | str, key: str) -> Column:
    """Presence test: ``from_json`` cannot tell an absent key from a null one."""
    return F.coalesce(F.array_contains(F.json_object_keys(_col(value)), key), F.lit(False))


def truthy(value: Column | str) -> Column:
    """Null for the JSON scalars an ``or`` chain skips: null, '', 0, 0.0 and false."""
    text = _col(value)
    return F.when(text.rlike(r"^-?0*\.?0+\z") | text.isin("", "false"), None).otherwise(text)


def first_truthy(*values: Column) -> Column:
    return F.coalesce(*[truthy(v) for v in values])


def non_empty(value: Column | str) -> Column:
    """Empty arrays become null, so JSON output omits them."""
    return F.when(F.size(_col(value)) > 0, _col(value))


def json_map(value: Column | str) -> Column:
    """JSON object as map<string,string>; nested values stay JSON text."""
    return F.from_json(_col(value), "map<string,string>")


def merge_maps(*maps: Column) -> Column:
    """Merge string maps; later maps win.  Needs no session-wide dedup policy."""

    def pair(left: Column, right: Column) -> Column:
        keep = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
        return F.map_concat(keep, right)

    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return reduce(pair, [F.coalesce(m, empty) for m in maps])


def format_wire_time(value: Column | str) -> Column:
    return F.date_format(_col(value), WIRE_TIME)


def parse_wire_time(value: Column | str) -> Column:
    return F.try_to_timestamp(_col(value), F.lit(WIRE_TIME))


def epoch_millis(value: Column | str) -> Column:
    return F.unix_millis(_col(value))

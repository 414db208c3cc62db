"""Override rules by the thousand: an index of the text that each pattern needs.

A regular expression mostly holds a literal without which it cannot match.  The index has the rules with a hash of the start
of their longest such literal, the anchor.  Keys are cut into the pieces that can be anchors, told by a table of fixed size
of the lengths that anchors of a certain beginning have, and joined with the rules by these; only the patterns so met are
tried, by Spark's own regex engine, and the first in priority order wins.  A rule without a literal meets every key.

No task holds the index: it is joined like any table.  An anchor that many keys have is cut by a salt, with its rules
repeated, so it is not left to one task either.  The plan is the same for any number of rules.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions.assembly import row_positions
from docloom.session import remove_folder, scratch_folder, table_exists

_RULE = "name string, reason string, model string, max_pages int, applied string"
#: A chosen rule: the strategy's name, why, its model and page limit, and the pattern behind ``pattern:``.
DECISION = f"struct<{_RULE.replace(' ', ':').replace(',:', ',')}>"
_APPLIED = "pattern:"
#: Longest anchor in characters; entries of the table of lengths; keys that meet an anchor in one task.
LONGEST, BUCKETS, CROWD = 60, 1024, 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CASES = str.maketrans(_UPPER, _LOWER)


def needed_literal(pattern: str) -> tuple[str | None, bool, bool]:
    """The longest text a match must hold, whether case counts for nothing, and whether the text is all there is to match.

    Only what stands outside groups, classes and alternatives is looked at; a pattern that is hard to read has no literal.
    """
    runs, run, folded, plain = [], "", False, True
    depth, at = 0, 0

    def close() -> None:
        nonlocal run
        runs.append(run)
        run = ""

    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            after = pattern[at + 1 : at + 2]
            if after in ("Q", "E") or not after:
                return None, False, False
            if not depth and not after.isalnum():
                run += after
            else:
                close()
                plain = False
            at += 2
            continue
        if c == "[":
            # a class ends at the first bracket that is neither escaped nor first
            end = re.compile(r"\[\^?\]?(?:[^\]\[\\&]|\\.)*\]", re.S).match(pattern, at)
            if end is None:
                return None, False, False
            close()
            plain, at = False, end.end()
            continue
        if c == "(":
            flags = re.compile(r"\(\?([a-zA-Z]*)(-[a-zA-Z]*)?[:)]").match(pattern, at)
            if flags:
                if set(flags[1]) - set("ism"):
                    return None, False, False
                folded |= "i" in flags[1]
            close()
            plain = False
            depth += 1
        elif c == ")":
            depth -= 1
            close()
        elif c == "|":
            if not depth:
                return None, False, False
        elif depth:
            pass
        elif c in "*?" or (c == "{" and re.match(r"\{0*[,}]", pattern[at:])):
            # what stands before need not be there
            run = run[:-1]
            close()
            plain = False
        elif c in ".^$+{":
            close()
            plain = False
        else:
            run += c
        if c == "{" and not depth:
            at = pattern.find("}", at)
            if at < 0:
                return None, False, False
        at += 1
    close()
    best = max(runs, key=len)
    if not best or (folded and not best.isascii()):
        return None, False, False
    return best, folded, plain and not folded and best == "".join(runs)


def _with_literals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [needed_literal(p) for p in batch.column("pattern").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found], pa.bool_())],
            [*batch.schema.names, "literal", "folded", "whole"],
        )


#: Folders of the indexes this driver has written, by the rules in them.
_written: dict[tuple, str] = {}


def write_index(rules: DataFrame) -> str:
    """Folder of the index of usable rules (``priority, pattern, strategy, model, max_pages``); equal rules share one."""
    spark = rules.sparkSession
    rule = ["priority", "pattern", "strategy", "model", "max_pages"]
    # written, so that the patterns are checked once for the passes below
    checked = scratch_folder(spark, "checked")
    rules.select(*rule).write.parquet(checked)
    rules = spark.read.parquet(checked)
    known = rules.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rule).cast("decimal(38,0)"))).first()
    key = (spark.sparkContext.applicationId, *known)
    if key not in _written or not table_exists(spark, _written[key]):
        path = scratch_folder(spark, "rules")
        ranked = row_positions(rules, ["priority"], "rank").drop("priority")
        schema = "pattern string, strategy string, model string, max_pages int, rank bigint, literal string, folded boolean, whole boolean"
        read = ranked.mapInArrow(_with_literals, schema)
        start = F.substring(F.when(F.col("folded"), F.translate("literal", _UPPER, _LOWER)).otherwise(F.col("literal")), 1, LONGEST)
        decision = F.struct(
            F.col("strategy").alias("name"), F.lit("config_pattern_override").alias("reason"), "model", "max_pages", F.concat(F.lit(_APPLIED), "pattern").alias("applied"),
        ).cast(DECISION)
        kept = read.withColumn("start", start).select(
            "rank", "pattern", decision.alias("decision"), "folded", F.length("start").alias("size"),
            F.when(F.col("start").isNotNull(), _bucket(_kind(F.col("folded")), F.substring("start", 1, 3))).alias("bucket"),
            F.coalesce(_anchor(_kind(F.col("folded")), F.col("start")), F.lit(_NONE).cast("bigint")).alias("anchor"),
        )
        kept.write.parquet(path)
        _written[key] = path
    remove_folder(spark, checked)
    return _written[key]


def _kind(folded: Column) -> Column:
    return F.when(folded, "~").otherwise("=")


def _anchor(kind: Column, start: Column) -> Column:
    # not a hash of nulls, which is a number
    return F.when(start.isNotNull(), F.xxhash64(F.concat(kind, start)))


def _bucket(kind: Column, beginning: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.concat(kind, beginning), "UTF-8")), F.lit(BUCKETS)).cast("int")


#: What rules without a literal are met by.
_NONE = 0


def _pieces(lengths: dict[tuple[bool, int], list[tuple[int, ...]]]) -> Callable:
    """The pieces of keys that can be anchors; ``lengths`` has their lengths by kind, by characters looked at and by bucket."""

    def find(key: str) -> set[str]:
        found = set()
        for (folded, width), sizes in lengths.items():
            kind, text = ("~", key.translate(_CASES)) if folded else ("=", key)
            for at in range(len(text) - width + 1):
                for n in sizes[zlib.crc32((kind + text[at : at + width]).encode()) % BUCKETS]:
                    if at + n <= len(text):
                        found.add(kind + text[at : at + n])
        return found

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1000):
                keys = batch.column(0).slice(start, 1000)
                own = [find(k) for k in keys.to_pylist()]
                places = pa.array([i for i, pieces in enumerate(own) for _ in pieces], pa.int64())
                yield pa.RecordBatch.from_arrays([keys.take(places), pa.array([p for pieces in own for p in pieces], pa.string())], ["_rule_key", "piece"])

    return cut


def with_first_match(documents: DataFrame, path: str, key: str) -> DataFrame:
    """Add ``_rule``: the first rule of an index, by priority, whose pattern is found in ``key``."""
    index = documents.sparkSession.read.parquet(path)
    lengths: dict[tuple[bool, int], list[tuple[int, ...]]] = {}
    # BUCKETS rows for each kind and number of characters at most
    for row in index.where("size > 0").groupBy("folded", F.least("size", F.lit(3)).alias("width"), "bucket").agg(F.sort_array(F.collect_set("size")).alias("sizes")).collect():
        lengths.setdefault((row["folded"], row["width"]), [()] * BUCKETS)[row["bucket"]] = tuple(row["sizes"])
    text = F.coalesce(F.col(key), F.lit(""))
    keys = documents.select(text.alias("_rule_key")).distinct()
    probes = keys.mapInArrow(_pieces(lengths), "_rule_key string, piece string").select("_rule_key", F.xxhash64("piece").alias("anchor"))
    if not index.where("size IS NULL").isEmpty():
        probes = probes.unionByName(keys.withColumn("anchor", F.lit(_NONE).cast("bigint")))
    crowded = probes.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    # a row for CROWD pieces at least
    crowded = F.broadcast(crowded.select("anchor", F.ceil(F.col("n") / CROWD).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    asked = probes.join(crowded, "anchor", "left").select("_rule_key", "anchor", F.pmod(F.hash("_rule_key"), parts).alias("part"))
    rules = index.join(crowded, "anchor", "left").select("anchor", "rank", "pattern", "decision", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    met = asked.join(rules, ["anchor", "part"]).where(F.rlike("_rule_key", F.col("pattern")))
    first = met.groupBy("_rule_key").agg(F.min(F.struct("rank", "decision")).alias("_first")).select("_rule_key", F.col("_first.decision").alias("_rule"))
    return documents.join(first, text == F.col("_rule_key"), "left").drop("_rule_key")

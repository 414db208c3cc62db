"""Skew-safe ordering helpers.

One key may own a third of all rows, so nothing here sorts or collects a whole
group at once: groups are cut into chunks by their ordinal, each chunk is
reduced on its own, and only the reduced chunks meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.session import scratch_folder


def ordered_concat(
    rows: DataFrame,
    keys: Sequence[str],
    ordinal: str,
    text: str,
    separator: str,
    output: str,
    chunk: int = 1024,
    keep_empty: bool = False,
) -> DataFrame:
    """Join ``text`` in ``ordinal`` order per key; null texts are left out.

    Level one joins at most ``chunk`` consecutive ordinals, level two joins the
    chunk strings.  Keys without any text are absent from the result, or have ''
    with ``keep_empty``.
    """

    def join_sorted(order: Column, value: Column) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
        # array_join leaves nulls out
        return F.array_join(F.transform(pairs, lambda p: p["v"]), separator)

    if not keep_empty:
        rows = rows.where(F.col(text).isNotNull())
    chunked = rows.withColumn("_chunk", F.floor(F.col(ordinal) / F.lit(chunk)))
    partial = chunked.groupBy(*keys, "_chunk").agg(
        join_sorted(F.col(ordinal), F.col(text)).alias("_joined"), F.count(text).alias("_n")
    )
    partial = partial.withColumn("_piece", F.when(F.col("_n") > 0, F.col("_joined")))
    return partial.groupBy(*keys).agg(join_sorted(F.col("_chunk"), F.col("_piece")).alias(output))


def ordered_array(
    rows: DataFrame, keys: Sequence[str], ordinal: str, value: Column, output: str, chunk: int = 1024
) -> DataFrame:
    """Collect ``value`` in ``ordinal`` order per key, chunk by chunk."""
    item = F.struct(F.col(ordinal).alias("o"), value.alias("v"))
    chunked = rows.withColumn("_chunk", F.floor(F.col(ordinal) / F.lit(chunk)))
    pieces = chunked.groupBy(*keys, "_chunk").agg(F.array_sort(F.collect_list(item)).alias("_piece"))
    whole = pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_piece"))).alias("_pieces"))
    values = F.flatten(F.transform("_pieces", lambda c: F.transform(c["_piece"], lambda e: e["v"])))
    return whole.select(*keys, values.alias(output))


def dense_ordinal(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    output: str,
    chunk: int = 4096,
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Zero-based position by an integer ``order`` column within non-null ``keys``.

    Same values as ``row_number() - 1`` over the whole group, but the group is cut
    into ranges of ``chunk`` order values: only the range counts are summed over
    the group, rows are numbered inside their range.  The range counts themselves
    are summed in two steps, so even without keys no task sees more than
    ``1/chunk`` of the ranges at once.
    """
    ranged = rows.withColumn("_range", F.floor(F.col(order) / F.lit(chunk)).cast("long"))
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    else:
        counts = counts.withColumn("_super", F.floor(F.col("_range") / F.lit(chunk)))
        totals = counts.groupBy("_super").agg(F.sum("_n").alias("_m"))
        before = Window.orderBy("_super").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("_super", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_base"))
        inside = Window.partitionBy("_super").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        inner = counts.withColumn("_inner", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        offsets = inner.join(totals, "_super").select("_range", (F.col("_base") + F.col("_inner")).alias("_offset"))
    within = Window.partitionBy(*keys, "_range").orderBy(order, *tie_breakers)
    numbered = ranged.withColumn("_local", F.row_number().over(within))
    joined = numbered.join(offsets, [*keys, "_range"])
    return joined.withColumn(output, F.col("_offset") + F.col("_local") - 1).drop("_range", "_local", "_offset")


def row_positions(
    rows: DataFrame, order: Sequence[str], output: str, keys: Sequence[str] = (), tie_breakers: Sequence[str] = ()
) -> DataFrame:
    """Zero-based position by columns of any orderable type, over all rows or within ``keys``; nulls come first.

    Same values as ``row_number() - 1`` where the order is total.  Rows are sorted by range, equal ones split further by
    ``tie_breakers``, a hash and their place in the input, so neither a key nor a value nor a tie has to fit one task.  A row's
    number is its place among those of its key in its partition, behind the counts of the partitions before.  The sorted
    rows are written to the shared folder, so that numbers stay with their rows whatever is lost later.
    """
    spark = rows.sparkSession
    names = rows.columns
    hashable = [F.col(f"`{c}`") for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
    sorted_by = [*keys, *order, *tie_breakers]
    tied = rows.withColumns({"_tie": F.xxhash64(*hashable), "_row": F.monotonically_increasing_id()})
    places = [F.col(c).asc_nulls_first() for c in [*sorted_by, "_tie", "_row"]]
    ordered = tied.repartitionByRange(*places).sortWithinPartitions(*places).drop("_tie", "_row")
    path = scratch_folder(spark, "positions")
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    # partition and place in it are the high and the low bits
    written = spark.read.schema(f"{_ddl(ordered)}, _at bigint").parquet(path).withColumn("_part", F.shiftright("_at", 33))
    counts = written.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    else:
        # one row for each partition
        shifts, total = [], 0
        for part, n, first in sorted(counts.select("_part", "_n", "_first").collect()):
            shifts.append((part, total - first))
            total += n
        offsets = spark.createDataFrame(shifts, "_part bigint, _shift bigint")
    offsets = offsets.select(*[F.col(c).alias(f"_o_{c}") for c in keys], F.col("_part").alias("_o_part"), "_shift")
    same = F.col("_part") == F.col("_o_part")
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    return written.join(offsets, same).withColumn(output, F.col("_at") + F.col("_shift")).select(*names, output)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key.  ``max_by`` combines map-side, a ranking window would not."""
    payload = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*keys, "_row.*")

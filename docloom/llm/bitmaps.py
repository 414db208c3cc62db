"""Which rows a join concerns, told by bitmaps of a fixed size instead of a shuffle of all rows.

The keys in question set bits in ``MAPS`` maps of 32 768 bits, 1 MiB in all whatever their number, which may therefore be
broadcast.  Rows whose bit is set are the rows concerned and, by chance, a few others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAPS = 256


def unused(columns: list[str], name: str) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def marked(rows: DataFrame, wanted: DataFrame, keys: list[str], hit: str = "_hit") -> DataFrame:
    """``rows`` with ``hit``, a name they do not have: false only where no row of ``wanted`` has the same keys."""
    number = F.pmod(F.xxhash64(*keys), F.lit(MAPS * 32768))
    bits = wanted.select(number.alias("n")).groupBy((F.col("n") / 32768).cast("int").alias("map")).agg(F.bitmap_construct_agg(F.col("n") % 32768).alias("bits"))
    # the row travels as one value, so its columns may have any names
    carried = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), number.alias("number"))
    joined = carried.join(F.broadcast(bits), (F.col("number") / 32768).cast("int") == F.col("map"), "left")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(number % 32768 div 8 as int) + 1, 1)")), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, F.expr("cast(number % 8 as int)")).bitwiseAND(F.lit(1)) == 1
    return joined.select(*[F.col("row").getField(c).alias(c) for c in rows.columns], F.coalesce(bit, F.lit(False)).alias(hit))


def concerned(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are in ``wanted``, and a few more."""
    hit = unused(rows.columns, "_hit")
    return marked(rows, wanted, keys, hit).where(F.col(hit)).drop(hit)


def others(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that ``concerned`` leaves."""
    hit = unused(rows.columns, "_hit")
    return marked(rows, wanted, keys, hit).where(~F.col(hit)).drop(hit)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """``rows`` without those whose key is in ``gone``; a null key always stays."""
    gone = gone.select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    rest = concerned(rows, gone, [key]).join(gone, key, "left_anti").select(*rows.columns)
    return others(rows, gone, [key]).select(*rows.columns).unionByName(rest)

"""Line dedup: an exact set-similarity join of lines, in DataFrame operations only.

A line's tokens are its distinct lower-cased words, in one global order: by the rarity of the word's hash bucket, counted
over all documents, then by hash.  Lines of one token set are one entry, known by the place of its first line.

Prefix filter: entries meet by grams of neighbours in their ordered tokens, which are far more selective than tokens: a
pair, or three where the pair's two words are frequent, which depends on the words alone.  At similarity t an entry of n
tokens lacks x and gains y tokens with x + t y <= (1 - t) n.  A gram of l tokens weighs 1 / l.  Grams do not get shorter
along the order, so a missing token breaks grams of weight 1 at most and a gained one of weight (l - 1) / l, less than t.
The entry therefore shares one of any first grams that weigh more than (1 - t) n, and the first shared one lies in such a
prefix of both.  Entries of fewer than ``SHORT`` tokens have too few grams of three; they and the sizes they can match have
a prefix of pairs alone, apart from the others.

Length filter: sizes differ by a factor of at most t.  Parity filter: 64 bits, in long entries 128, hold the parity of an entry's tokens by hash;
two entries' bits differ in no more places than their sets do, in (1 - t) / (1 + t) of both sizes if similar.  The join
tests it, so entries that share a gram by chance are no rows.  What passes is verified on the whole token sets, fetched for
the lines concerned only.  A line goes when an earlier line, by doc_id and place, whether itself kept or not, has a similar set.

A line needs one earlier similar line only, so groups of near copies need not meet pair by pair.  Each entry is first compared
with the earliest that shares its least or greatest token hash, a row for each of the two; that takes out all but a few of a
group.  In the gram join, an entry still in question meets the earlier ones.

The gram join takes ``PASSES`` parts of the grams one after the other, so that no more than a part lies on disk.

Lines of fewer than ``JOINED`` distinct words are similar to equal sets only, so the gram join leaves them out.

Defined cases: blank lines always stay; a null text stays null; rows of equal doc_id are
one document whose lines stand or go by their place; a null doc_id comes first; a document all of whose lines go keeps an
empty text; other columns are kept, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, release_shuffles, remove_folder
from . import bitmaps

#: Similarity in percent and the fewest distinct words of a line that can go: all but blank lines can.
PERCENT, LEAST = 80, 1
#: The fewest distinct words of a line that an unequal set can match: 4 of 5 is ``PERCENT``, 3 of 4 is less.
JOINED = 4
#: The fewest tokens of an entry that has 128 bits of parity.
LONG = 50
#: Entries of fewer tokens have pairs alone.
SHORT = 10
#: The lines that a pair's two words would share by chance, if they have more, the gram takes a third word.
CHANCE = 1024
#: Words of a usual line, in this estimate.
WORDS = 50
#: Parts of the grams that are joined one after the other, and the rows that make another part worth while.
PASSES, PASS_ROWS = 4, 2_000_000
#: Hash buckets of the rarity order.
BUCKETS = 4096


def _words(line: Column) -> Column:
    """Words of a lower-cased line; the plain split is much the faster."""
    spaces = ["  ", "\t", "\r", "\x0b", "\x0c"]
    other = line.startswith(" ") | line.endswith(" ")
    for s in spaces:
        other = other | line.contains(s)
    return F.when(other, F.array_remove(F.split(line, "[ \\t\\r\\x0b\\f]+"), "")).otherwise(F.split(line, " "))


def _lines(docs: DataFrame) -> DataFrame:
    cut = docs.where(F.col("text").isNotNull()).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return cut.where(F.length("line") > 0)


def _levels(docs: DataFrame) -> tuple[list[int], int]:
    """Rarity of each hash bucket, from counts of all words, and the level of two words that are frequent together."""
    word = F.explode(F.split(F.lower(F.col("text")), "[ \\n\\t\\r\\x0b\\f]")).alias("word")
    bucket = F.xxhash64("word").bitwiseAND(F.lit(BUCKETS - 1))
    out, words = [0] * BUCKETS, 0
    for row in docs.select(word).groupBy(bucket.alias("bucket")).count().collect():
        out[row["bucket"]] = min(127, int(4 * math.log2(1 + row["count"])))
        words += row["count"]
    return out, int(4 * math.log2(1 + CHANCE * words / WORDS))


def _keys(line: Column, levels: list[int]) -> Column:
    """A line's distinct tokens as numbers that ascend from rare to frequent."""
    table = F.split(F.lit(",".join(str(x << 56) for x in levels)), ",").cast("array<bigint>")
    rank = lambda h: F.get(table, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1)))
    return F.sort_array(F.array_distinct(F.transform(_words(F.lower(line)), lambda w: rank(F.xxhash64(w)))))


def _whole(n: Column) -> Column:
    """Pairs whose weight passes (1 - t) n."""
    return F.floor(n * (2 * (100 - PERCENT)) / 100).cast("int") + 1


def _first(count: Column) -> Column:
    # a sequence down from 0 would not be empty
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def _pairs(n: Column, frequent: int) -> Column:
    """How many of an entry's first grams are pairs; ``frequent`` is the level of two words together above which a third is taken."""
    level = lambda i: F.shiftright(F.get("keys", i), 56)
    both = lambda i: level(i) + level(i + 1) <= frequent
    # levels ascend
    return F.when((n < SHORT) | both(_whole(n) - 1), _whole(n)).otherwise(F.size(F.filter(_first(_whole(n)), both)))


def _prefix(n: Column, pairs: Column) -> Column:
    """Hashes of an entry's first grams."""
    at = lambda i: F.get("keys", i)
    threes = F.floor((n * (6 * (100 - PERCENT)) - pairs * 300) / 200).cast("int") + 1
    # a null adds nothing to a hash
    mixed = F.transform(_first(F.when(pairs < _whole(n), pairs + threes).otherwise(pairs)), lambda i: F.hash(at(i), at(i + 1), F.when(i >= pairs, at(i + 2))))
    apart = F.transform(_first(_whole(n)), lambda i: F.hash(F.lit(SHORT), at(i), at(i + 1)))
    none = F.array().cast("array<int>")
    return F.when(n * PERCENT >= SHORT * 100, mixed).when(n >= SHORT, F.concat(apart, mixed)).when(n >= JOINED, apart).otherwise(none)


def _parity(n: Column) -> list[Column]:
    """Whether an odd number of tokens falls on each of 64 bits, and in a long entry, of the tokens that fall on the one half of 128."""
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(k, 20).bitwiseAND(F.lit(63)).cast("int"))
    half = lambda k: F.shiftright(k, 27).bitwiseAND(F.lit(1)) == 0
    zero = F.lit(0).cast("bigint")
    every = F.aggregate("keys", zero, lambda bits, k: bits.bitwiseXOR(bit(k)))
    some = F.aggregate("keys", zero, lambda bits, k: F.when(half(k), bits.bitwiseXOR(bit(k))).otherwise(bits))
    return [F.when(n >= JOINED, every).alias("bits"), F.when(n >= LONG, some).alias("half")]


def _sketch(keys: str) -> Column:
    """Least and greatest hash of the tokens: similar sets mostly share one of them."""
    hashes = F.transform(keys, lambda k: k.bitwiseAND(F.lit((1 << 56) - 1)))
    return F.array(F.array_min(hashes), F.array_max(hashes))


def _may_match(n: tuple[Column, Column], bits: tuple[Column, Column], half: tuple[Column, Column]) -> Column:
    """False only where the sizes or parities of two entries rule similarity out."""
    (na, nb), every, some = n, bits[0].bitwiseXOR(bits[1]), half[0].bitwiseXOR(half[1])
    apart = F.coalesce(F.bit_count(some) + F.bit_count(every.bitwiseXOR(some)), F.bit_count(every))
    return (apart * (100 + PERCENT) <= (na + nb) * (100 - PERCENT)) & (na * 100 >= nb * PERCENT) & (nb * 100 >= na * PERCENT)


def removed_lines(docs: DataFrame) -> DataFrame:
    """doc_id and line_no of every line that an earlier one matches."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"

    def save(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def done(*names: str) -> None:
        """Remove tables that nothing reads any more, and the shuffles behind what is saved."""
        for name in names:
            remove_folder(spark, f"{folder}/{name}")
        release_shuffles(spark)

    docs = docs.select("doc_id", "text")
    place = ["doc_id", "line_no"]
    levels, frequent = _levels(docs)
    n = F.size("keys")
    # the generator keeps the optimizer from working the tokens out again for each use
    keys = F.explode(F.array(_keys(F.col("line"), levels))).alias("keys")
    entry = _lines(docs).select(*place, keys).where(n >= LEAST)
    entry = entry.select(*place, "keys", F.explode(F.array(_pairs(n, frequent))).alias("pairs"))
    lines = entry.select(*place, F.xxhash64("keys").alias("entry"), n.alias("n"), *_parity(n), _prefix(n, F.col("pairs")).alias("prefix"), F.when(n >= JOINED, _sketch("keys")).alias("sketch"))
    lines = save(lines, "lines")

    firsts = save(lines.groupBy("entry").agg(F.min(F.struct(*place)).alias("first")), "firsts")
    own = F.struct(*place).eqNullSafe(F.col("first"))
    again = save(lines.select(*place, "entry").join(firsts, "entry").where(~own).select(*place), "again")
    # one line of each entry: those that no bit marks as a repetition, and of the marked ones the first
    repeated = bitmaps.concerned(lines, again, place).join(firsts, "entry").where(own).dropDuplicates(["entry"])
    first_of = [*place, "n", "bits", "half", "prefix", "sketch"]
    single = bitmaps.others(lines, again, place).select(*first_of).union(repeated.select(*first_of)).where(F.col("n") >= JOINED)
    single = save(single, "single")
    done("lines", "firsts")

    # first round: entries against the earliest with the same least or greatest token hash
    one = F.struct(*place, "n", "bits", "half").alias("one")
    drawn = single.select(one, F.posexplode("sketch").alias("which", "value"))
    earliest = drawn.groupBy("which", "value").agg(F.min("one").alias("rep"), F.count(F.lit(1)).alias("holders")).where("holders > 1")
    near = drawn.join(earliest, ["which", "value"]).where(_later("rep", "one") & _may_match(*((F.col(f"rep.{c}"), F.col(f"one.{c}")) for c in ("n", "bits", "half"))))
    tried = save(near.select(*_places("rep", "a"), *_places("one", "b")).distinct(), "tried")
    late = save(_verified(tried, docs, keys, save, "first"), "late")
    done("tried", "asked-first", "sets-first")

    # second round: entries still in question against all earlier ones
    marked = bitmaps.marked(single.drop("sketch"), late, place, "hit")
    surely = marked.where("not hit").withColumn("open", F.lit(1)).drop("hit")
    gone = late.withColumnsRenamed({"doc_id": "d", "line_no": "l"}).withColumn("gone", F.lit(0))
    perhaps = marked.where("hit").join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")), "left")
    perhaps = perhaps.withColumn("open", F.coalesce("gone", F.lit(1))).drop("hit", "gone", "d", "l")
    # written, so that both sides of the join read the same table and share its one shuffle
    rows = save(surely.union(perhaps), "rows")
    done("single")
    # size and state in one number with the line's
    info = (F.col("line_no").cast("bigint") * (1 << 32)) + F.col("n") * 2 + F.col("open")
    passes = min(PASSES, 1 + (rows.agg(F.sum(F.size("prefix"))).first()[0] or 0) // PASS_ROWS)
    grams = rows.select("doc_id", "bits", "half", info.alias("info"), F.explode("prefix").alias("gram"))
    names = []
    for k in range(passes):
        part = grams.where(F.pmod("gram", F.lit(passes)) == k)
        left, right = (part.select("gram", *[F.col(c).alias(f"{c}_{x}") for c in ("doc_id", "bits", "half", "info")]) for x in ("a", "b"))
        size = lambda x: F.shiftright(F.col(x).bitwiseAND(F.lit((1 << 32) - 1)), 1)
        line = lambda x: F.shiftright(F.col(x), 32).cast("int")
        # told of both sides at once, so that the two read one shuffle
        still = F.col("info_b").bitwiseAND(F.lit(1)) * size("info_a") > 0
        before = F.struct("doc_id_a", line("info_a")) < F.struct("doc_id_b", line("info_b"))
        met = left.join(right, "gram").where(still & _may_match((size("info_a"), size("info_b")), *((F.col(f"{c}_a"), F.col(f"{c}_b")) for c in ("bits", "half"))) & before)
        save(met.select("doc_id_a", line("info_a").alias("line_no_a"), "doc_id_b", line("info_b").alias("line_no_b")).distinct(), f"met-{k}")
        names.append(f"met-{k}")
        del met, left, right, part
        done()
    done("rows")
    pairs = save(spark.read.parquet(*[f"{folder}/{x}" for x in names]).distinct(), "pairs")
    removed = save(again.union(late).union(_verified(pairs, docs, keys, save, "second")).distinct(), "removed")
    done("again", "late", "pairs", "asked-second", "sets-second", *names)
    return removed


def _later(a: str, b: str) -> Column:
    """The place of ``b`` is behind that of ``a``; a null doc_id comes first."""
    return F.struct(f"{a}.doc_id", f"{a}.line_no") < F.struct(f"{b}.doc_id", f"{b}.line_no")


def _places(of: str, x: str) -> list[Column]:
    return [F.col(f"{of}.{c}").alias(f"{c}_{x}") for c in ("doc_id", "line_no")]


def _verified(pairs: DataFrame, docs: DataFrame, keys: Column, save: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """The later place of each pair of places (a, b) with similar token sets, once."""
    asked = pairs.select(F.explode(F.array(*[F.struct(F.col(f"doc_id_{x}").alias("d"), F.col(f"line_no_{x}").alias("l")) for x in ("a", "b")])).alias("one"))
    asked = save(asked.select("one.*").distinct(), f"asked-{name}")
    # whole token sets of the lines at these places
    texts = bitmaps.concerned(_lines(docs), asked.withColumnsRenamed({"d": "doc_id", "l": "line_no"}), ["doc_id", "line_no"])
    found = texts.join(asked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l")))
    sets = save(found.select("d", "l", keys).distinct(), f"sets-{name}")
    for x in ("a", "b"):
        at = F.col(f"doc_id_{x}").eqNullSafe(F.col("d")) & (F.col(f"line_no_{x}") == F.col("l"))
        pairs = pairs.join(sets.withColumnRenamed("keys", f"keys_{x}"), at).drop("d", "l")
    both = F.size(F.array_intersect("keys_a", "keys_b"))
    alike = both * (100 + PERCENT) >= (F.size("keys_a") + F.size("keys_b")) * PERCENT
    return pairs.where(alike).select(F.col("doc_id_b").alias("doc_id"), F.col("line_no_b").alias("line_no")).distinct()


def dedup(docs: DataFrame, names: tuple[str, str, str] = ("_lines", "_removed", "_gone")) -> DataFrame:
    """``docs`` with similar later lines taken out of ``text``; ``names`` are the columns of the counts of lines and of those
    removed, and of the removed places.  They take the place of columns so named; all others are kept."""
    lines_, removed, places = names
    docs = docs.drop(*names)
    key, gone_ = bitmaps.unused([*docs.columns, *names], "_doc"), bitmaps.unused([*docs.columns, *names], "_places")
    gone = removed_lines(docs).groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias(gone_)).withColumnRenamed("doc_id", key)
    cut, at = F.split("text", "\n"), F.col(gone_)
    kept = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), at)
    text = F.when(at.isNull() | F.col("text").isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(cut, i)), "\n"))
    wanted = gone.select(F.col(key).alias("doc_id"))
    touched = bitmaps.concerned(docs, wanted, ["doc_id"]).join(gone, F.col("doc_id").eqNullSafe(F.col(key)), "left").drop(key)
    clear = bitmaps.others(docs, wanted, ["doc_id"]).withColumn(gone_, F.lit(None).cast("array<int>"))
    every = clear.unionByName(touched).withColumn(lines_, F.coalesce(F.size(cut), F.lit(0))).withColumn(removed, F.coalesce(F.size(at), F.lit(0)))
    return every.withColumn("text", text).withColumnRenamed(gone_, places)

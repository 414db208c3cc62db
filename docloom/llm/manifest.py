"""Merkle manifest of a dataset as a postorder append log.

Each row of the dataset is a leaf; leaves of a source ascend by doc_id; every three consecutive nodes have one parent, the
last run of a level may be shorter; the sources' roots, ordered by source, make the top tree in the same way.

A tree's leaves are cut into aligned blocks of 3^8.  A builder takes one block and appends every node the moment it is
complete, which is postorder; the roots of the blocks are the leaves of the next tier, and so on until one block is left.
Inside a block of m leaves, the node of level l and index i covers its leaves up to e = min((i + 1) * 3^l, m) - 1.  Before
leaf e is appended, S(e) = e + e div 3 + e div 9 + ... nodes are complete, and on it those of levels 0 to l, so the node
lies at position S(e) + l.  Proofs read the siblings from the log at those positions; the part above a block is read once
for the block.

Ordinals come from one range sort of the leaves (source, doc_id, leaf, row), so a source of any size is spread over tasks;
no block, and so no task, depends on the size of a source.

Defined cases: a null source is a tree of its own, before all others; null doc_ids come first in their source, equal ones
by leaf, and repeated rows stand one behind the other, each with a proof of its own; a null value is ``-`` in its leaf; an
empty dataset has no leaves and no root; texts are hashed whole; columns besides the five of a leaf are not read and
cannot clash with results.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

ARITY = 3
#: Levels of a builder's subtree.
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_DIGEST = 32


def node(children: list[str]) -> str:
    """Digest of a node from its children's digests, all as hexadecimal text."""
    return hashlib.sha256("".join(children).encode()).hexdigest()


def completed(leaf: int) -> int:
    """Nodes that are complete before leaf number ``leaf`` is appended."""
    total = 0
    while leaf:
        total += leaf
        leaf //= ARITY
    return total


def position(level: int, index: int, leaves: int) -> int:
    """Place of a node in the log of a tree of ``leaves`` leaves."""
    return completed(min((index + 1) * ARITY**level, leaves) - 1) + level


def width(level: int, leaves: int) -> int:
    """Nodes of a level."""
    return -(-leaves // ARITY**level)


def height(leaves: int) -> int:
    """Levels above the leaves."""
    level = 0
    while width(level, leaves) > 1:
        level += 1
    return level


def append_nodes(leaves: list[str], levels: int) -> list[str]:
    """The log of a block: each node behind the last of its children, up to ``levels`` levels above the leaves."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]

    def add(digest: str, level: int) -> None:
        log.append(digest)
        waiting[level].append(digest)

    for leaf in leaves:
        add(leaf, 0)
        for level in range(levels):
            if len(waiting[level]) < ARITY:
                break
            digest = node(waiting[level])
            waiting[level].clear()
            add(digest, level + 1)
    for level in range(levels):
        if waiting[level]:
            add(node(waiting[level]), level + 1)
    return log


class Block:
    """One builder's log, read by position."""

    def __init__(self, log: bytes, leaves: int, levels: int):
        self.text, self.leaves, self.levels = log.hex(), leaves, levels

    def digest(self, level: int, index: int) -> str:
        at = 2 * _DIGEST * position(level, index, self.leaves)
        return self.text[at : at + 2 * _DIGEST]

    def paths(self, above: str) -> list[str]:
        """Path of every leaf: per level the place in its run and the siblings, levels parted by commas, then ``above``."""
        upper = [above]
        for level in range(self.levels - 1, -1, -1):
            here = [self.digest(level, i) for i in range(width(level, self.leaves))]
            own = []
            for i in range(len(here)):
                first, place = i - i % ARITY, i % ARITY
                siblings = "".join(here[first:i] + here[i + 1 : first + ARITY])
                rest = upper[i // ARITY]
                own.append(f"{place}{siblings},{rest}" if rest else f"{place}{siblings}")
            upper = own
        return upper


def siblings(path: str) -> str:
    """All sibling digests of a path, left to right, level by level."""
    return "".join(part[1:] for part in path.split(",")) if path else ""


def fold(leaf: str, path: str) -> str:
    """The root that a leaf has with the siblings of a path."""
    digest = leaf
    for part in path.split(",") if path else []:
        at = 1 + 2 * _DIGEST * int(part[0])
        digest = hashlib.sha256((part[1:at] + digest + part[at:]).encode()).hexdigest()
    return digest


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Leaf of a row: SHA-256 over its fields, each ``-`` if null, else byte count, colon and value."""

    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*(part(fields[name]) for name in FIELDS)).cast("binary"), 256)


def _numbered(rows: DataFrame, order: list[str], folder: str) -> DataFrame:
    """``rows`` with ``ordinal`` inside their ``tree`` and its number of ``leaves``.

    One range sort; a row's number is its place among the rows of its tree in its partition, behind those of earlier
    partitions.  The sorted rows are written, so that numbers and rows belong together whatever is lost later.
    """
    spark = rows.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in ["tree", *order]]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    ordered.write.parquet(folder)
    ordered = spark.read.parquet(folder).withColumn("part", F.shiftright("at", 33))
    counts = ordered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start"))
    tree = Window.partitionBy("tree")
    before = F.sum("n").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    offsets = counts.select("tree", "part", (before - F.col("start")).alias("shift"), F.sum("n").over(tree).alias("leaves"))
    return ordered.join(offsets, ["tree", "part"]).withColumn("ordinal", F.col("at") + F.col("shift")).drop("at", "part", "shift")


_LOG = "tree string, leaves bigint, block bigint, held int, levels int, root binary, log binary"


def _builder(members: bool) -> Callable[[pa.Table], pa.Table]:
    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("ordinal")
        leaves = table.column("leaves")[0].as_py()
        levels = LEVELS if leaves > ARITY**LEVELS else height(leaves)
        log = append_nodes([d.hex() for d in table.column("digest").to_pylist()], levels)
        out = {
            "tree": table.column("tree")[:1], "leaves": table.column("leaves")[:1], "block": table.column("block")[:1],
            "held": pa.array([table.num_rows], pa.int32()), "levels": pa.array([levels], pa.int32()),
            "root": pa.array([bytes.fromhex(log[-1])], pa.binary()), "log": pa.array([bytes.fromhex("".join(log))], pa.binary()),
        }
        if members:
            out["doc_ids"] = pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64()))
            out["claims"] = pa.array([table.column("claim").to_pylist()], pa.list_(pa.binary()))
        return pa.table(out)

    return build


def _append(rows: DataFrame, folder: str, members: bool = False) -> list[DataFrame]:
    """Logs of all trees of numbered rows, one table per tier."""
    spark = rows.sparkSession
    schema = f"{_LOG}, doc_ids array<bigint>, claims array<binary>" if members else _LOG
    tiers: list[DataFrame] = []
    while True:
        blocks = rows.withColumn("block", F.expr(f"ordinal div {ARITY**LEVELS}")).groupBy("tree", "block")
        path = f"{folder}/{len(tiers)}"
        blocks.applyInArrow(_builder(members and not tiers), schema if not tiers else _LOG).write.parquet(path)
        tiers.append(spark.read.parquet(path))
        most = tiers[-1].agg(F.max("leaves")).first()[0] or 0
        if most <= ARITY**LEVELS:
            return tiers
        # a tree of one block is whole and stays behind
        rows = tiers[-1].where(F.col("leaves") > ARITY**LEVELS).select(
            "tree", F.col("block").alias("ordinal"), F.ceil(F.col("leaves") / F.lit(ARITY**LEVELS)).alias("leaves"), F.col("root").alias("digest")
        )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """The last node of every tree."""
    whole = [tier.where(F.col("leaves") <= ARITY**LEVELS).select("tree", F.col("root").alias("digest")) for tier in tiers]
    out = whole[0]
    for other in whole[1:]:
        out = out.unionByName(other)
    return out


def _paths(table: pa.Table) -> pa.Table:
    trees, ordinals, paths = [], [], []
    for row in table.to_pylist():
        found = Block(row["log"], row["held"], row["levels"]).paths(row["above"])
        trees += [row["tree"]] * len(found)
        ordinals += range(row["block"] * ARITY**LEVELS, row["block"] * ARITY**LEVELS + len(found))
        paths += found
    return pa.table({"tree": pa.array(trees, pa.string()), "ordinal": pa.array(ordinals, pa.int64()), "above": pa.array(paths, pa.string())})


def _spread(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield from _paths(pa.Table.from_batches([batch.slice(i, 1)])).to_batches()


def _descend(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Blocks of the lowest tier with the path ``above`` their root; ``tops`` holds the path above every tree's root."""
    below = None
    for tier in reversed(tiers):
        whole = tier.where(F.col("leaves") <= ARITY**LEVELS).join(tops, "tree")
        if below is not None:
            parts = tier.where(F.col("leaves") > ARITY**LEVELS)
            whole = parts.join(below.withColumnRenamed("ordinal", "block"), ["tree", "block"]).unionByName(whole)
        if tier is tiers[0]:
            return whole
        below = whole.select("tree", "block", "held", "levels", "log", "above").mapInArrow(_spread, "tree string, ordinal bigint, above string")
    raise ValueError("no tiers")


class Manifest:
    """Logs of a dataset: ``tiers`` of the sources' trees, ``tops`` of the tree over their roots, and its ``root``."""

    def __init__(self, folder: str, tiers: list[DataFrame], tops: list[DataFrame], order: DataFrame, root: str | None):
        self.folder, self.tiers, self.tops, self.order, self.root = folder, tiers, tops, order, root

    def log(self) -> DataFrame:
        """Nodes of the lowest tier: source tree, place in its log, digest."""
        first = f"block * {ARITY**LEVELS}"
        start = " + ".join([first, *(f"{first} div {ARITY**i}" for i in range(1, 39))])
        places = F.expr(f"explode(sequence(0, cast(octet_length(log) div {_DIGEST} as int) - 1))").alias("at")
        rows = self.tiers[0].select("tree", F.expr(start).alias("start"), "log", places)
        digest = F.expr(f"lower(hex(substring(log, at * {_DIGEST} + 1, {_DIGEST})))")
        return rows.select("tree", (F.col("start") + F.col("at")).alias("position"), digest.alias("digest"))


def append(docs: DataFrame, claims: dict[str, Column] | None = None) -> Manifest:
    """Write the manifest of ``docs`` below the shared folder.

    ``claims`` gives columns as somebody else presents them; ``audit`` tells which rows they agree with.
    """
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    fields = {name: F.col(name) for name in FIELDS}
    own = leaf_digest(fields)
    claim = leaf_digest({**fields, **claims}) if claims else own
    source = F.col("source").cast("string")
    tree = F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))
    # the texts are read here and nowhere else
    docs.select(
        tree.alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(own).alias("digest"), F.unhex(claim).alias("claim"),
        F.monotonically_increasing_id().alias("row"),
    ).write.parquet(f"{folder}/leaves")
    leaves = _numbered(spark.read.parquet(f"{folder}/leaves"), ["doc_id", "digest", "row"], f"{folder}/sorted")
    tiers = _append(leaves.drop("row"), f"{folder}/log", members=True)
    roots = _roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    order = _numbered(roots, ["name"], f"{folder}/sources")
    tops = _append(order.drop("name"), f"{folder}/top")
    last = _roots(tops).first()
    return Manifest(folder, tiers, tops, order, last["digest"].hex() if last else None)


_AUDIT = (
    "tree string, doc_id bigint, ordinal bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "n_siblings int, folded_root string, verified boolean"
)


def _audit(root: str | None, keep_proof: bool):
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["log"], row["held"], row["levels"])
                paths = block.paths(row["above"])
                texts = [siblings(p) for p in paths]
                folded = [fold(c.hex(), p) for c, p in zip(row["claims"], paths, strict=True)]
                n = len(paths)
                first = row["block"] * ARITY**LEVELS
                out = {
                    "tree": pa.array([row["tree"]] * n, pa.string()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "ordinal": pa.array(range(first, first + n), pa.int64()),
                    "leaf": pa.array([block.digest(0, i) for i in range(n)], pa.string()),
                    "subroot": pa.array([row["subroot"].hex()] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                    "proof_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                    "n_siblings": pa.array([len(t) // (2 * _DIGEST) for t in texts], pa.int32()),
                    "folded_root": pa.array(folded, pa.string()), "verified": pa.array([f == root for f in folded], pa.bool_()),
                }
                if keep_proof:
                    out["proof"] = pa.array([p.split(",") if p else [] for p in paths], pa.list_(pa.string()))
                yield pa.RecordBatch.from_pydict(out)

    return work


def audit(manifest: Manifest, sources: list[str | None] | None = None, keep_proof: bool = False) -> DataFrame:
    """One row per leaf: source, doc_id, ordinal, digests, and whether the claimed leaf folds to the root.

    ``sources`` restricts it to some sources, of whose blocks alone the logs are read.  ``keep_proof`` adds the proof: per
    level the place in its run and the siblings' digests.
    """
    top = _descend(manifest.tops, manifest.order.sparkSession.createDataFrame([("", "")], "tree string, above string"))
    above = top.select("tree", "block", "held", "levels", "log", "above").mapInArrow(_spread, "tree string, ordinal bigint, above string")
    names = manifest.order.select(F.col("name"), "ordinal", F.col("digest").alias("subroot"))
    tops = names.join(above.drop("tree"), "ordinal").select(F.col("name").alias("tree"), "subroot", "above")
    tiers = manifest.tiers
    if sources is not None:
        wanted = ["" if s is None else f"={s}" for s in sources]
        tiers, tops = [t.where(F.col("tree").isin(wanted)) for t in tiers], tops.where(F.col("tree").isin(wanted))
    blocks = _descend(tiers, tops.drop("subroot")).join(tops.select("tree", "subroot"), "tree")
    schema = _AUDIT + (", proof array<string>" if keep_proof else "")
    found = blocks.mapInArrow(_audit(manifest.root, keep_proof), schema)
    source = F.when(F.col("tree") != "", F.expr("substring(tree, 2)"))
    return found.select(source.alias("source"), *[c for c in found.columns if c != "tree"])

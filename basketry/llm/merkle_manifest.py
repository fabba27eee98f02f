"""Merkle manifest of a dataset: nested-struct rollup of rank digits, proofs by transform and explode.

1. A leaf is the digest of a row's fields.  Rows of a group are numbered in key order:
   range-partitioned, sorted and written once with their place, so no group is one task.
2. A block is ``FAN ** DEPTH`` consecutive nodes.  Its rank digits are columns that are
   grouped away one after the other; each step collects at most ``FAN`` child structs and
   adds their digest, so a block ends as one nested struct.  One shuffle serves all steps.
3. The blocks' digests are the nodes of the next tier, until each group has one block.  The
   group digests are then rolled up the same way to the root.
4. Proofs go down: a block's row and the path above it, one row each, are grouped together,
   and ``transform`` and ``explode`` open the struct level by level, adding the digests left
   and right of each child.  No node is ever joined with its siblings.

Defined cases: a null field counts as ``-``; rows with a null key come first in their group;
null is a group of its own, before all others; equal keys are ordered by their leaf digest, and
rows alike in every field are leaves of their own; an empty table gives no rows; columns that are
not named, whatever they are called, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Children of a node, and levels nested in one block: 4,096 nodes at most.
FAN = 16
DEPTH = 3
BLOCK = FAN ** DEPTH


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def group_key(value: Column) -> Column:
    """A group's name as a text that is never null; in byte order null comes first."""
    return F.coalesce(F.concat(F.lit("+"), value.cast("string")), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in their group ``g`` by ``order``, and ``n``, the rows of the group.

    The rows are written once in order with their partition and place; what is windowed has a row
    for each group of each partition.
    """
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = stored(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                    .withColumn("_part", F.spark_partition_id()).withColumn("_place", place), "merkle-order")
    runs = placed.groupBy("g", "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    every = Window.partitionBy("g")
    before = F.sum("_rows").over(every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("g", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(every).alias("n"))
    return placed.join(runs, ["g", "_part"]).withColumn("rank", F.col("_place") + F.col("_shift")).drop("_part", "_place", "_shift")


def _joined(children: Column) -> Column:
    return F.concat_ws("", F.transform(children, lambda c: c["digest"]))


def blocks(nodes: DataFrame) -> DataFrame:
    """(g, rank, n, digest, tree): ``nodes`` (g, rank, n, digest, item) nested into one struct for each block.

    A level is hashed where the group has more nodes than one below it; else its only child goes up as it is.
    """
    digits = [f"_d{k}" for k in range(DEPTH)]
    rows = nodes.select("g", "n", F.floor(F.col("rank") / BLOCK).cast("bigint").alias("block"), "digest", F.col("item").alias("tree"),
                        *[(F.floor(F.col("rank") / FAN ** k) % FAN).cast("int").alias(d) for k, d in enumerate(digits)])
    rows = rows.repartition("g", "block")
    for k, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), "digest", "tree")
        children = F.sort_array(F.collect_list(child))
        rows = rows.groupBy("g", "n", "block", *digits[k + 1:]).agg(children.alias("tree"))
        rows = rows.withColumn("digest", F.when(F.col("n") > FAN ** k, digest(_joined(F.col("tree")))).otherwise(F.col("tree")[0]["digest"]))
    return rows.select("g", F.col("block").alias("rank"), "n", "digest", "tree")


def tiers(nodes: DataFrame) -> list[DataFrame]:
    """Stored blocks of the nodes, of those blocks, and so on, until every group has one."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    out = [stored(blocks(nodes), "merkle-blocks")]
    while most > BLOCK:
        most = -(-most // BLOCK)
        below = out[-1].select("g", "rank", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), "digest", F.lit(None).cast("int").alias("item"))
        out.append(stored(blocks(below), "merkle-blocks"))
    return out


PATH = "array<struct<left:string,right:string>>"


def _opened(tier: DataFrame, above: DataFrame) -> DataFrame:
    """(g, rank, digest, item, path, top) of the nodes of all blocks; ``above``: (g, rank, path, top) of each block.

    A block's struct and its path, a row each, meet in one group.
    """
    one = lambda c: F.first(c, ignorenulls=True).alias(c)
    rows = tier.select("g", "rank", "n", "tree").unionByName(above.select("g", "rank", "path", "top"), allowMissingColumns=True) \
        .groupBy("g", "rank").agg(one("n"), one("tree"), one("path"), one("top"))
    for k in reversed(range(DEPTH)):
        digests = rows.withColumn("_all", F.transform("tree", lambda c: c["digest"]))
        kids = F.transform("tree", lambda c, i: F.struct(
            c.alias("c"), F.concat_ws("", F.slice("_all", F.lit(1), i)).alias("left"), F.concat_ws("", F.slice("_all", i + 2, F.lit(FAN))).alias("right")))
        rows = digests.select("g", "rank", "n", "path", "top", F.explode(kids).alias("k"))
        step = F.array(F.struct(F.col("k.left").alias("left"), F.col("k.right").alias("right")))
        rows = rows.select("g", (F.col("rank") * FAN + F.col("k.c.digit")).alias("rank"), "n", "top", F.col("k.c.digest").alias("digest"),
                           F.col("k.c.tree").alias("tree"),
                           F.when(F.col("n") > FAN ** k, F.concat(step, F.col("path"))).otherwise(F.col("path")).alias("path"))
    return rows.withColumnRenamed("tree", "item").drop("n")


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(g, rank, digest, item, path, top) of every node of the lowest tier; ``above``: (g, path, top) of each group."""
    down = above.withColumn("rank", F.lit(0).cast("bigint"))
    for tier in reversed(levels[1:]):
        down = _opened(tier, down).select("g", "rank", "path", "top")
    return _opened(levels[0], down)


@dataclass
class Manifest:
    """Stored tiers of the groups' trees and of the tree over the groups."""

    groups: list[DataFrame]
    over: list[DataFrame]

    def root(self) -> DataFrame:
        """(root), a row; none for an empty table."""
        return self.over[-1].select(F.col("digest").alias("root"))

    def subroots(self) -> DataFrame:
        """(g, n, subroot)."""
        top = self.groups[-1]
        counted = self.groups[0].select("g", "n").distinct() if len(self.groups) > 1 else top.select("g", "n")
        return top.select("g", F.col("digest").alias("subroot")).join(counted, "g")


def build(rows: DataFrame, order: list[str]) -> Manifest:
    """The manifest of ``rows`` (g, leaf, item, and the columns of ``order``)."""
    named = rows.withColumnRenamed("leaf", "digest")
    groups = tiers(numbered(named, order).select("g", "rank", "n", "digest", "item"))
    roots = groups[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), "digest")
    over = numbered(roots, ["name"]).select("g", "rank", "n", "digest", F.struct("name").alias("item"))
    return Manifest(groups, tiers(over))


def proofs(manifest: Manifest) -> DataFrame:
    """(g, rank, leaf, item, subroot, root, path) of every leaf; ``path``: the digests left and right, level by level upwards."""
    start = manifest.over[-1].select("g", F.array().cast(PATH).alias("path"), F.col("digest").alias("top"))
    of_groups = paths(manifest.over, start)
    above = of_groups.select(F.col("item.name").alias("g"), "path", F.struct(F.col("digest").alias("subroot"), F.col("top").alias("root")).alias("top"))
    return paths(manifest.groups, above).select("g", "rank", F.col("digest").alias("leaf"), "item", "top.subroot", "top.root", "path")


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from the leaf's up."""
    return digest(F.concat_ws("", F.transform(path, lambda p: F.concat(p["left"], p["right"]))))


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf_digest, lambda h, p: digest(F.concat(p["left"], h, p["right"])))


def manifest_of(docs: DataFrame, group: str, key: str, columns: list[str], changed: dict[str, Column] | None = None,
                where: Column | None = None) -> Manifest:
    """The manifest of a table: leaves over ``columns``, ordered by ``key`` in each ``group``.

    An item holds ``key`` and, for rows that ``where`` selects, ``other``: the leaf with some columns ``changed``.
    """
    values = [F.col(c) for c in columns]
    others = [(changed or {}).get(c, v) for c, v in zip(columns, values, strict=True)]
    other = F.when(where, leaf(*others)) if where is not None else F.lit(None).cast("string")
    rows = docs.select(group_key(F.col(group)).alias("g"), F.col(key).alias("_key"), leaf(*values).alias("leaf"), other.alias("_other"),
                       F.monotonically_increasing_id().alias("_row"))
    rows = stored(rows, "merkle-leaves")
    return build(rows.withColumn("item", F.struct(F.col("_key").alias("key"), F.col("_other").alias("other"))), ["_key", "leaf", "_row"])


def check(docs: DataFrame, group: str, key: str, columns: list[str], changed: dict[str, Column], where: Column) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row, with the leaves of ``where`` tampered with."""
    rows = proofs(manifest_of(docs, group, key, columns, changed, where))
    rows = rows.select(F.col("item.key").alias("key"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       fold(F.coalesce("item.other", "leaf"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))

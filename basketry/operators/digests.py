"""Digest trees over tables, and differences found by descending them.

A row's digest is the SHA-256 of its columns as text.  Rows fall into key ranges by the
hash of their key; a range's digest is made of its row count and the sums of its row digests, taken
as four 64-bit numbers each, so it is exact for multisets, needs no order, and is combined
map-side: however many rows a table has, what is shuffled has at most ``16 ** digits`` rows
for each task.  Range digests in order give the table's digest, and these the batch's.

Two tables are compared by their range digests first; rows are read again, shuffled and joined only in
the ranges that differ.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a key's hash that name its range: 256 ranges.
DIGITS = 2
LANES = 4


def _cols(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def row_text(cols: Iterable[str]) -> Column:
    """The columns as one text that no other row of values has: each with its length, null as ``~``."""
    def one(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))
    return F.concat_ws("|", *[one(c) for c in cols])


def key_range(key, digits: int = DIGITS) -> Column:
    """The range of a key: the first hex digits of its hash."""
    return F.substring(F.md5(row_text(_cols(key)).cast("binary")), 1, digits)


def _digest(parts: Column) -> Column:
    return F.sha2(parts.cast("binary"), 256)


def range_digests(df: DataFrame, key, cols: Iterable[str], digits: int = DIGITS) -> DataFrame:
    """(part, rows, digest): one row for each key range that has rows."""
    hashed = df.select(key_range(key, digits).alias("part"), F.sha2(row_text(cols).cast("binary"), 256).alias("h"))
    lane = lambda i: F.conv(F.substring("h", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    sums = [F.sum(lane(i)).cast("decimal(38,0)").cast("string").alias(f"s{i}") for i in range(LANES)]
    return hashed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), *sums).select(
        "part", "rows", _digest(F.concat_ws(":", F.col("rows").cast("string"), *[f"s{i}" for i in range(LANES)])).alias("digest"))


def digest_tree(parts: DataFrame) -> DataFrame:
    """(level, table_name, part, rows, digest) of all levels from the range digests (table_name, part, rows, digest).

    A table is at most ``16 ** digits`` ranges, a batch a few tables: what is collected in order is bounded.
    """
    def over(names: str, digest: str) -> Column:
        listed = F.array_sort(F.collect_list(F.struct(names, digest)))
        return _digest(F.concat_ws("\n", F.transform(listed, lambda x: F.concat(x[names], F.lit(" "), x[digest]))))

    tables = parts.groupBy("table_name").agg(F.sum("rows").alias("rows"), over("part", "digest").alias("digest"))
    batch = tables.agg(F.sum("rows").alias("rows"), over("table_name", "digest").alias("digest")).where("rows is not null")
    named = lambda df, level, **cols: df.select(F.lit(level).alias("level"), *[c.alias(n) for n, c in cols.items()], "rows", "digest")
    null = F.lit(None).cast("string")
    return (named(parts, "part", table_name=F.col("table_name"), part=F.col("part"))
            .unionByName(named(tables, "table", table_name=F.col("table_name"), part=null))
            .unionByName(named(batch, "batch", table_name=null, part=null)))


def table_digests(frames: dict[str, tuple[DataFrame, list[str], list[str]]], digits: int = DIGITS) -> DataFrame:
    """The digest tree of named (table, key, columns)."""
    parts = [range_digests(df, key, cols, digits).select(F.lit(name).alias("table_name"), "part", "rows", "digest")
             for name, (df, key, cols) in frames.items()]
    return digest_tree(reduce(lambda a, b: a.unionByName(b), parts))


def compare_trees(before: DataFrame, after: DataFrame) -> DataFrame:
    """(level, table_name, part, rows_before, rows_after, status) of all nodes of two digest trees; PASS where they agree."""
    a = before.select("level", "table_name", "part", F.col("rows").alias("rows_before"), F.col("digest").alias("_a"))
    b = after.select(F.col("level").alias("_l"), F.col("table_name").alias("_t"), F.col("part").alias("_p"), F.col("rows").alias("rows_after"),
                     F.col("digest").alias("_b"))
    same = (F.col("level") == F.col("_l")) & F.col("table_name").eqNullSafe(F.col("_t")) & F.col("part").eqNullSafe(F.col("_p"))
    status = (F.when(F.col("_a").eqNullSafe(F.col("_b")), "PASS").when(F.col("_a").isNull(), "ADDED")
              .when(F.col("_b").isNull(), "REMOVED").otherwise("CHANGED"))
    return a.join(b, same, "full").select(F.coalesce("level", "_l").alias("level"), F.coalesce("table_name", "_t").alias("table_name"),
                                          F.coalesce("part", "_p").alias("part"), "rows_before", "rows_after", status.alias("status"))


@dataclass(frozen=True)
class RangeComparison:
    """Key ranges that differ between two tables, and the rows of each table."""

    ranges: list[str]
    rows_a: int
    rows_b: int


def compare_ranges(a: DataFrame, b: DataFrame, key, cols: Iterable[str], digits: int = DIGITS) -> RangeComparison:
    """Compare two tables by their range digests, in one job; ``2 * 16 ** digits`` rows at most reach the driver."""
    cols = list(cols)
    sides = range_digests(a, key, cols, digits).withColumn("side", F.lit(0)).unionByName(
        range_digests(b, key, cols, digits).withColumn("side", F.lit(1)))
    found: tuple[dict, dict] = {}, {}
    for r in sides.collect():
        found[r.side][r.part] = r.rows, r.digest
    ranges = sorted(p for p in found[0].keys() | found[1].keys() if found[0].get(p) != found[1].get(p))
    return RangeComparison(ranges, *[sum(n for n, _ in side.values()) for side in found])


def differing_ranges(a: DataFrame, b: DataFrame, key, cols: Iterable[str], digits: int = DIGITS) -> list[str]:
    """The key ranges whose rows are not the same in both tables."""
    return compare_ranges(a, b, key, cols, digits).ranges


def in_ranges(df: DataFrame, key, ranges: list[str], digits: int = DIGITS) -> DataFrame:
    """The rows of some key ranges; all of them, or none, are no test at all."""
    if not ranges:
        return df.limit(0)
    if len(ranges) == 16 ** digits:
        return df
    return df.where(key_range(key, digits).isin(ranges))


def _sides(a: DataFrame, b: DataFrame, key, cols: list[str], digits: int) -> DataFrame:
    """Per row of the ranges that differ: how often it is in ``a`` (``_a``) and in ``b`` (``_b``); one shuffle, NULL-safe."""
    a, b = a.select(*cols), b.select(*cols)
    ranges = differing_ranges(a, b, key, cols, digits)
    one, none = F.lit(1), F.lit(0)
    both = (in_ranges(a, key, ranges, digits).withColumns({"_a": one, "_b": none})
            .unionByName(in_ranges(b, key, ranges, digits).withColumns({"_a": none, "_b": one})))
    return both.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))


def _side(first: Column) -> Column:
    return F.when(first, "only_in_a").otherwise("only_in_b").alias("side")


def multiset_difference(a: DataFrame, b: DataFrame, key=None, cols: Iterable[str] | None = None, digits: int = DIGITS) -> DataFrame:
    """Rows that one table has more often, as often as that, with ``side`` only_in_a or only_in_b."""
    cols = list(cols or a.columns)
    rows = _sides(a, b, key or cols, cols, digits).where("_a <> _b")
    return rows.select(*cols, _side(F.col("_a") > F.col("_b")), F.explode(F.sequence(F.lit(1), F.abs(F.col("_a") - F.col("_b")))).alias("_t")).drop("_t")


def set_difference(a: DataFrame, b: DataFrame, key=None, cols: Iterable[str] | None = None, digits: int = DIGITS) -> DataFrame:
    """Distinct rows that one table has and the other does not, with ``side`` only_in_a or only_in_b."""
    cols = list(cols or a.columns)
    rows = _sides(a, b, key or cols, cols, digits).where("(_a = 0) <> (_b = 0)")
    return rows.select(*cols, _side(F.col("_b") == 0))

"""Keys and links of many tables, reconciled as sets in one stream.

Every table is scanned once: a row becomes one entry (contract, key, side) for each key and link it takes part in.  Entries
are combined in each task and meet in ONE exchange, where a contract's key tells everything: a NULL, a repeated key, a child
without its parent.  A key that many rows share is one entry of each task, so no key is hot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .digests import row_text

Key = tuple[str, str, list[str]]                              # (name, table, columns)
Link = tuple[str, str, list[str], str, list[str]]             # (name, child, columns, parent, columns)


def _entry(contract: int, cols: list[str], child: int) -> Column:
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return F.struct(F.lit(contract).alias("c"), F.when(~null, row_text(cols)).alias("k"), F.lit(child).cast("bigint").alias("child"),
                    F.lit(1 - child).cast("bigint").alias("parent"))


def reconcile(tables: dict[str, DataFrame], keys: list[Key], links: list[Link]) -> DataFrame:
    """(kind, name, null_rows, duplicate_keys, orphan_rows): one row for each key (no orphans) and each link (no duplicates).

    A key with a NULL column counts as null, as a link it is skipped; parents may be repeated.
    """
    entries: dict[str, list[Column]] = {}
    names = []
    for name, table, cols in keys:
        entries.setdefault(table, []).append(_entry(len(names), cols, 1))
        names.append(("key", name))
    for name, child, ccols, parent, pcols in links:
        entries.setdefault(child, []).append(_entry(len(names), ccols, 1))
        entries.setdefault(parent, []).append(_entry(len(names), pcols, 0))
        names.append(("link", name))
    stream = reduce(lambda a, b: a.unionByName(b), [tables[t].select(F.explode(F.array(*es)).alias("e")).select("e.*") for t, es in entries.items()])
    met = stream.where(F.col("k").isNotNull() | (F.col("c") < len(keys))).groupBy("c", "k").agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    null = F.col("k").isNull()
    found = met.groupBy("c").agg(F.sum(F.when(null, F.col("child")).otherwise(0)).alias("n"), F.count_if(~null & (F.col("child") > 1)).alias("d"),
                                 F.sum(F.when(~null & (F.col("parent") == 0), F.col("child")).otherwise(0)).alias("o"))
    spark = stream.sparkSession
    known = F.broadcast(spark.createDataFrame([(i, *n) for i, n in enumerate(names)], "c int, kind string, name string"))   # the contracts
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    is_key = F.col("kind") == "key"
    return known.join(found, "c", "left").select("kind", "name", zero("n").alias("null_rows"), F.when(is_key, zero("d")).alias("duplicate_keys"),
                                                 F.when(~is_key, zero("o")).alias("orphan_rows"))

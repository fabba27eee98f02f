"""Insert-only, rerun-safe loading.

``insert_only_merge`` is the warehouse's load protocol expressed as DataFrame
operations: conflicts (same key, different row) and extras (target rows the
source no longer has) stop the load; only absent business keys are inserted,
with new surrogate keys continuing after the current maximum, assigned in
business-key order without a single-partition window.  The merged table is
published by writing a new version and switching a pointer (no transactions
are needed; readers see the old or the new version, never a mix).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import rows_differ
from ..session import stored
from . import digests as D
from .aggregates import combine_rows
from .keys import assign_keys


class LoadBlocked(RuntimeError):
    pass


@dataclass
class MergeResult:
    merged: DataFrame
    inserted: DataFrame
    conflicts: DataFrame
    extras: DataFrame
    report: DataFrame


def _cols(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def insert_only_merge(target: DataFrame, expected: DataFrame, key, cols: list[str],
                      key_col: str | None = None, table: str = "table") -> MergeResult:
    """I1.  ``report`` is one row: table, total, inserted, unchanged, conflicts, extras and the
    two-way difference of the merged table (must be 0).

    Range digests of target and expected are compared first (one job); rows are read again only in the
    key ranges that differ, so a rerun joins and shuffles nothing.  There ONE full outer join on the business
    key (unique on both sides by contract, checked by ``verify_keys``) tells them apart: a key only in
    the target is an extra, only in expected is an insert, in both with a different row (NULL-safe) is a
    conflict.  The difference is measured on the merged rows of those ranges, as a multiset; the others
    have equal digests.  ``load_insert_only`` is the guarded form, which stops on a conflict or extra.
    """
    key = _cols(key)
    attrs = [c for c in cols if c not in key]
    t = target.select(*key, *attrs, *([key_col] if key_col else []))
    e = expected.select(*key, *attrs)
    found = D.compare_ranges(t.select(*key, *attrs), e, key, [*key, *attrs])
    t_part, e_part = (D.in_ranges(df, key, found.ranges) for df in (t, e))
    new = e_part.join(t_part.select(*key), key, "left_anti")
    if key_col:
        start = t.select(F.coalesce(F.max(key_col), F.lit(0)) + 1).scalar()
        # without a range that differs there is nothing to number
        new = assign_keys(new, key, key_col, start=start) if found.ranges else new.withColumn(key_col, F.lit(None).cast("bigint"))
    merged = t.unionByName(new)
    tt = t_part.select(*key, *[F.col(c).alias(f"_t_{c}") for c in attrs], F.lit(True).alias("_in_t"))
    ee = e_part.select(*key, *[F.col(c).alias(f"_e_{c}") for c in attrs], F.lit(True).alias("_in_e"))
    j = tt.join(ee, key, "full")
    in_t, in_e = F.coalesce("_in_t", F.lit(False)), F.coalesce("_in_e", F.lit(False))
    differ = rows_differ([f"_t_{c}" for c in attrs], [f"_e_{c}" for c in attrs]) if attrs else F.lit(False)
    conflicts = j.where(F.col("_in_t") & F.col("_in_e") & differ).select(*key)
    extras = j.where(F.col("_in_t") & F.col("_in_e").isNull()).select(*key)
    if found.ranges:
        counts = j.agg(F.count_if(~in_t & in_e).alias("inserted_rows"), F.count_if(in_t & in_e & differ).alias("conflict_rows"),
                       F.count_if(in_t & ~in_e).alias("extra_rows"))
        signed = (t_part.select(*key, *attrs).withColumn("_n", F.lit(1)).unionByName(new.select(*key, *attrs).withColumn("_n", F.lit(1)))
                  .unionByName(e_part.withColumn("_n", F.lit(-1))))
        difference = (signed.groupBy(*key, *attrs).agg(F.abs(F.sum("_n")).alias("_n"))
                      .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("two_way_difference")))
        row = combine_rows([counts, difference])
    else:
        names = ["inserted_rows", "conflict_rows", "extra_rows", "two_way_difference"]
        row = t.sparkSession.range(1).select(*[F.lit(0).cast("bigint").alias(n) for n in names])
    c, x, w = F.col("conflict_rows"), F.col("extra_rows"), F.col("two_way_difference")
    rows_t = F.lit(found.rows_a).cast("bigint")
    report = row.select(
        F.lit(table).alias("table_name"), (rows_t + F.col("inserted_rows")).alias("total_rows"), "inserted_rows",
        (rows_t - c - x).alias("unchanged_rows"), "conflict_rows", "extra_rows", "two_way_difference",
        F.when((c == 0) & (x == 0) & (w == 0), "PASS").otherwise("BLOCK").alias("status"))
    return MergeResult(merged, new, conflicts, extras, report)


def load_insert_only(target: DataFrame, expected: DataFrame, key, cols: list[str],
                     key_col: str | None = None, table: str = "table") -> DataFrame:
    """I1 guarded: the merged table, or ``LoadBlocked`` if any existing row differs or is no longer expected."""
    result = insert_only_merge(target, expected, key, cols, key_col, table)
    r = result.report.first()
    if r["status"] != "PASS":
        raise LoadBlocked(f"{table}: {r['conflict_rows']} conflicts, {r['extra_rows']} extra rows, "
                          f"difference {r['two_way_difference']}; nothing loaded")
    return result.merged


def changed_keys(before: DataFrame, after: DataFrame, key, key_col: str) -> DataFrame:
    """Business keys whose surrogate key is another one (or gone) after a load."""
    key = _cols(key)
    a = after.select(*key, F.col(key_col).alias("_after"))
    return before.select(*key, key_col).join(a, key, "left").where(~F.col(key_col).eqNullSafe(F.col("_after"))).select(*key)


def load_without_rejects(checked: DataFrame, reason_col: str = "reject_reason", table: str = "table", accepted: list[str] | None = None) -> DataFrame:
    """The rows of ``checked`` to load, or ``LoadBlocked`` if a row has a reject reason that is not ``accepted``.

    Reasons are a list joined by "; "; a row is accepted as a reject only if each of its reasons is.
    """
    reasons = F.split(F.col(reason_col), "; ")
    unknown = F.size(F.array_except(reasons, F.array(*[F.lit(r) for r in ["", *(accepted or [])]]))) > 0
    bad = checked.where(unknown).groupBy(reason_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), reason_col).limit(3).collect()
    if bad:
        raise LoadBlocked(f"{table}: rows rejected ({', '.join(f'{r.n} {r[reason_col]}' for r in bad)}); nothing loaded")
    return checked.where(F.col(reason_col) == "").drop(reason_col)


def type1_upsert(target: DataFrame, expected: DataFrame, key, cols: list[str],
                 key_col: str | None = None) -> DataFrame:
    """Overwrite descriptive attributes of existing keys (no history); keep keys;
    insert new business keys after the current maximum surrogate key."""
    key = _cols(key)
    attrs = [c for c in cols if c not in key]
    t = target.select(*key, *([key_col] if key_col else []))
    upd = expected.select(*key, *attrs).join(t, key, "inner")
    new = expected.select(*key, *attrs).join(t.select(*key), key, "left_anti")
    if key_col:
        start = target.select(F.coalesce(F.max(key_col), F.lit(0)) + 1).scalar()
        new = assign_keys(new, key, key_col, start=start)
    return upd.unionByName(new)


def changed_status(before: DataFrame, after: DataFrame, status: str = "IN_SCOPE", key: str = "product_id") -> DataFrame:
    """(key, enters): keys that have ``status`` in one scope version only; ``enters`` if it is the later one."""
    old = before.where(F.col("scope_status") == status).select(key).distinct().withColumn("_old", F.lit(True))
    new = after.where(F.col("scope_status") == status).select(key).distinct().withColumn("_new", F.lit(True))
    return old.join(new, key, "full").where("_old is null or _new is null").select(key, F.col("_new").isNotNull().alias("enters"))


class PartitionedFact:
    """A fact in a folder, partitioned by columns of its own; a change rewrites the partitions it touches and no other."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, by: list[str]):
        self.spark, self.path, self.schema, self.by = spark, path, schema, by

    @classmethod
    def create(cls, df: DataFrame, path: str, by: list[str]) -> PartitionedFact:
        fact = cls(df.sparkSession, path, df.schema, by)
        fact._write(df)
        return fact

    def _write(self, df: DataFrame) -> None:
        """One task writes a partition, or several where one is large (AQE splits it); partitions that ``df`` has no rows of stay."""
        (df.select(self.schema.names).hint("rebalance", *self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.by).parquet(self.path))

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).select(self.schema.names)

    def touched(self, rows: DataFrame) -> DataFrame:
        """The partitions of some rows."""
        return rows.select(*self.by).distinct()

    def apply(self, leaving: DataFrame, entering: DataFrame, key: str) -> DataFrame:
        """Take out the rows whose ``key`` is in ``leaving``, add the rows ``entering``; returns the partitions rewritten, with row counts.

        Touched partitions alone are read, rebuilt in a folder of their own and then overwritten; a partition that is left
        without rows is removed.  A crash before the overwrite changes nothing, and the same change can be applied again.
        """
        fact = self.read()
        # computed once; as files, the rows and keys have a size that the joins below are planned by
        entering = stored(entering.select(self.schema.names), "entering")
        arriving = stored(entering.select(key).distinct(), "entering-keys")
        gone = fact.join(leaving.select(key), key, "left_semi")
        partitions = stored(self.touched(gone).unionByName(self.touched(entering)).distinct(), "touched")
        old = self._of(fact, partitions)
        # entering rows that are there already (a change applied again) are not added twice
        kept = old.join(leaving.select(key), key, "left_anti").join(arriving, key, "left_anti")
        rebuilt = stored(kept.unionByName(entering), "rebuilt")
        sides = old.select(*self.by, F.lit(1).alias("_o"), F.lit(0).alias("_n")).unionByName(rebuilt.select(*self.by, F.lit(0).alias("_o"), F.lit(1).alias("_n")))
        counts = stored(sides.groupBy(*self.by).agg(F.sum("_o").alias("rows_before"), F.sum("_n").alias("rows_after")), "rewritten")
        self._write(rebuilt)
        for row in counts.where("rows_after = 0").collect():    # a name for each partition without rows
            self._remove(row)
        return counts

    def _of(self, fact: DataFrame, partitions: DataFrame) -> DataFrame:
        """Rows of some partitions; those of the first column, a bounded number of values, are pruned by folder."""
        first = self.by[0]
        values = [r[0] for r in partitions.select(first).distinct().collect()]
        near = F.col(first).isin([v for v in values if v is not None])
        near = near | F.col(first).isNull() if None in values else near
        named = F.broadcast(partitions.select(*[F.col(c).alias(f"_p_{c}") for c in self.by]))     # names of folders
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in self.by])
        return fact.where(near).join(named, same, "left_semi")

    def _remove(self, row) -> None:
        names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if row[c] is None else row[c]}" for c in self.by]
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path.rstrip("/"), *names]))
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# --- I4 publish after checks -------------------------------------------------------
def publish(spark: SparkSession, frames: dict[str, DataFrame], base: str, checks: DataFrame,
            version: str | None = None) -> str:
    """Write every table under ``base/<table>/v=<version>`` and, only if all checks
    pass, a new numbered pointer ``base/_pointer/n=<number>`` that names that version.

    Pointers are never replaced: readers take the highest that is complete (with its ``_SUCCESS`` mark), so they see the old
    or the new set, whenever a publication is cut off.
    """
    failing = checks.where(F.col("status") != "PASS").select(F.count(F.lit(1))).first()[0]
    if failing:
        raise LoadBlocked(f"{failing} checks failing; nothing published")
    version = version or uuid.uuid4().hex[:12]
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}/v={version}")
    number = max(_pointers(spark, base, complete=False), default=0) + 1
    spark.createDataFrame([(version, json.dumps(sorted(frames)))], "version string, tables string") \
        .coalesce(1).write.mode("errorifexists").json(f"{base}/_pointer/n={number}")
    return version


def _pointers(spark: SparkSession, base: str, complete: bool = True) -> list[int]:
    """Numbers of the pointers under ``base``; a cut-off one has no ``_SUCCESS`` mark."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{base}/_pointer")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    paths = [f.getPath() for f in fs.listStatus(folder)]
    return [int(p.getName()[2:]) for p in paths if p.getName().startswith("n=")
            and (not complete or fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))]


def read_current(spark: SparkSession, base: str, table: str) -> DataFrame:
    numbers = _pointers(spark, base)
    if not numbers:
        raise FileNotFoundError(f"nothing published under {base}")
    version = spark.read.schema("version string, tables string").json(f"{base}/_pointer/n={max(numbers)}").first()["version"]
    return spark.read.parquet(f"{base}/{table}/v={version}")

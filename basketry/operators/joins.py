"""Join operators.

Only equi-joins (plus one range residual) exist in the warehouse.  Lookups
against dimensions are many-to-one: the build side is distinct on the join
key, so a left join never multiplies the fact side.  Broadcast is hinted only
for tables whose size is fixed by construction (rule tables, the calendar);
everything else is left to AQE, which broadcasts from *measured* runtime sizes
and splits skewed partitions of a sort-merge join otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def in_scope(df: DataFrame, scope: DataFrame, status: str = "IN_SCOPE", key: str = "product_id") -> DataFrame:
    """Keep rows whose product has the given scope status (semi join, no fan-out)."""
    ids = scope.where(F.col("scope_status") == status).select(key)
    return df.join(ids, key, "left_semi")


def lookup(df: DataFrame, dim: DataFrame, on, key_col: str) -> DataFrame:
    """Map business ids to a surrogate key; misses stay visible as NULL."""
    on = _cols(on)
    return df.join(dim.select(*on, key_col), on, "left")


def lookup_chain(df: DataFrame, steps: list[tuple[DataFrame, list[str] | str, str]]) -> DataFrame:
    return reduce(lambda acc, s: lookup(acc, *s), steps, df)


def date_in_week(df: DataFrame, weeks: DataFrame, date_col: str, week_col: str,
                 key_col: str = "week_key") -> DataFrame:
    """Equi-join on the source week and a BETWEEN residual on its coverage.

    ``weeks`` is the calendar (53 rows by construction), so it is broadcast.
    """
    w = weeks.select(F.col("source_week").alias("_sw"), F.col(key_col).alias("_wk"),
                     "coverage_start_date", "coverage_end_date")
    j = df.join(F.broadcast(w), (df[week_col] == w._sw)
                & df[date_col].between(w.coverage_start_date, w.coverage_end_date), "left")
    return j.withColumnRenamed("_wk", key_col).drop("_sw", "coverage_start_date", "coverage_end_date")


def missing_reference(df: DataFrame, ref: DataFrame, key) -> DataFrame:
    """Rows whose key has no match in ``ref`` (NOT EXISTS)."""
    key = _cols(key)
    return df.join(ref.select(*key).distinct(), key, "left_anti")


def has_reference(df: DataFrame, ref: DataFrame, key, extra: Column | None = None) -> DataFrame:
    """Rows whose key has a match (EXISTS); optional residual (e.g. a date range)."""
    key = _cols(key)
    if extra is None:
        return df.join(ref.select(*key).distinct(), key, "left_semi")
    r = ref.select(*[F.col(k).alias(f"_r_{k}") for k in key], *[c for c in ref.columns if c not in key])
    cond = reduce(lambda a, b: a & b, [df[k] == r[f"_r_{k}"] for k in key]) & extra
    return df.join(r, cond, "left_semi")


def non_fanout_check(left: DataFrame, right: DataFrame, on, measures: list[str]) -> DataFrame:
    """LEFT JOIN keeps the row count and every measure sum; reports unmatched rows.

    Three aggregates — the left side, the joined side and the right side's
    duplicate keys — each computed once and placed side by side in one row.
    """
    from .aggregates import combine_rows
    on = _cols(on)
    r = right.select(*on).withColumn("_matched", F.lit(True))
    dup = (right.groupBy(*on).count().where("count > 1")
           .agg(F.count(F.lit(1)).alias("duplicate_right_keys")))
    j = left.join(r, on, "left")
    a = left.agg(F.count(F.lit(1)).alias("left_rows"), *[F.sum(m).alias(f"left_{m}") for m in measures])
    b = j.agg(F.count(F.lit(1)).alias("joined_rows"),
              F.count_if(F.col("_matched").isNull()).alias("unmatched_rows"),
              *[F.sum(m).alias(f"joined_{m}") for m in measures])
    out = combine_rows([a, b, dup])
    ok = (F.col("left_rows") == F.col("joined_rows")) & (F.col("duplicate_right_keys") == 0)
    for m in measures:
        ok = ok & F.col(f"left_{m}").eqNullSafe(F.col(f"joined_{m}"))
    cols = [c for c in out.columns if c != "duplicate_right_keys"]
    return out.select(*cols, "duplicate_right_keys", F.when(ok, "PASS").otherwise("FAIL").alias("status"))


def orphan_check(contracts: list[tuple[str, DataFrame, list[str], DataFrame, list[str]]]) -> DataFrame:
    """Foreign-key orphans per contract (name, child, child_cols, parent, parent_cols).

    NULL child keys are skipped (as a foreign key does); composite keys allowed.
    """
    parts = []
    for name, child, ccols, parent, pcols in contracts:
        c = child.select(*[F.col(a).alias(f"_k{i}") for i, a in enumerate(ccols)]).na.drop()
        p = parent.select(*[F.col(b).alias(f"_k{i}") for i, b in enumerate(pcols)]).distinct()
        orphans = c.join(p, [f"_k{i}" for i in range(len(ccols))], "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("orphan_rows"))
                     .select(F.lit(name).alias("foreign_key"), "orphan_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Days of an interval bucket: a period of n days is n / BUCKET_DAYS rows of the lookup.
BUCKET_DAYS = 64


def in_any_period(df: DataFrame, periods: DataFrame, key: str, day: str, start: str, end: str, flag: str, width: int = BUCKET_DAYS) -> DataFrame:
    """``df`` with ``flag``: whether its ``day`` lies in one of the periods [start, end] of its ``key`` (false for NULLs).

    A range join by interval buckets: a period is a row for each bucket of ``width`` days it touches, and a day is
    looked up in its own bucket, by an equi-join with the bounds as residual.  Distinct (key, day) pairs are looked up, so
    rows never multiply, and however many periods a key has, none is collected into one row.
    """
    bucket = lambda c: F.floor(F.datediff(F.col(c), F.lit("1970-01-01").cast("date")) / width).cast("int")
    spread = periods.where(F.col(key).isNotNull() & (F.col(start) <= F.col(end))).select(
        F.col(key).alias("_k"), F.col(start).alias("_from"), F.col(end).alias("_to"), F.explode(F.sequence(bucket(start), bucket(end))).alias("_b"))
    pairs = df.select(F.col(key), F.col(day)).where(F.col(key).isNotNull() & F.col(day).isNotNull()).distinct().withColumn("_day_b", bucket(day))
    meets = (F.col(key) == F.col("_k")) & (F.col("_day_b") == F.col("_b")) & F.col(day).between(F.col("_from"), F.col("_to"))
    inside = pairs.join(spread, meets, "left_semi").select(key, day, F.lit(True).alias(flag))
    return df.join(inside, [key, day], "left").withColumn(flag, F.coalesce(flag, F.lit(False)))

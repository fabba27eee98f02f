"""Set operators.  Spark's set operations are NULL-safe (rows
with NULLs compare equal), like SQL EXCEPT / UNION."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import digests


def id_hub(frames: list[DataFrame], key: str) -> DataFrame:
    """UNION (distinct) of one key over many sources; each side de-duplicated
    first so the shuffle carries distinct keys only."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(key).distinct() for f in frames]).distinct()


def union_all(frames: list[DataFrame]) -> DataFrame:
    """F2."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def two_way_difference(a: DataFrame, b: DataFrame, key=None) -> DataFrame:
    """(A EXCEPT B) UNION ALL (B EXCEPT A), tagged by side.

    Range digests over ``key`` (default: all columns) are compared first; only rows of ranges that differ are shuffled.
    """
    return digests.set_difference(a, b, key)


def two_way_multiset_difference(a: DataFrame, b: DataFrame, key=None) -> DataFrame:
    """EXCEPT ALL both ways (duplicates count), by range digests first."""
    return digests.multiset_difference(a, b, key)


def coverage_diff(ids: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """ids missing from a decision table and decision ids not among the ids."""
    i, d = ids.select(key).distinct(), decided.select(key).distinct()
    missing = i.join(d, key, "left_anti").select(F.count(F.lit(1))).scalar()
    extra = d.join(i, key, "left_anti").select(F.count(F.lit(1))).scalar()
    return i.sparkSession.range(1).select(missing.alias("missing_ids"), extra.alias("extra_ids"))


def set_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """distinct values of ``a`` not in ``b``."""
    return a.subtract(b)


def missing_days(df: DataFrame, date_col: str, lo: Column, hi: Column) -> DataFrame:
    """calendar days in [lo, hi] without a row (the day series is bounded by the range)."""
    days = df.sparkSession.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias(date_col))
    return days.join(df.select(date_col).distinct(), date_col, "left_anti")

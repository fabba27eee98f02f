"""Aggregation operators.

All are declarative aggregates, so Spark plans a partial (map-side) aggregate
before the shuffle; a key holding a third of all rows is combined on each
mapper first.  Exact distinct counts use Spark's expand-based plan, which
shuffles on (group, value) before counting, so a hot group is spread too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def count_where(df: DataFrame, **preds: Column) -> DataFrame:
    """Many COUNT(*) FILTER (WHERE ...) in one scan."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in preds.items()])


def sum_measures(df: DataFrame, cols: list[str], by=None, result_type: str | None = None) -> DataFrame:
    """COALESCE(SUM(x), 0) for each measure (exact decimal sums)."""
    aggs = []
    for c in cols:
        s = F.coalesce(F.sum(c), F.lit(0))
        aggs.append((s.cast(result_type) if result_type else s).alias(c))
    by = _cols(by) if by else []
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def duplicate_groups(df: DataFrame, key) -> DataFrame:
    """Groups with more than one row, with size and excess."""
    return (df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("source_rows"))
            .where("source_rows > 1").withColumn("excess_rows", F.col("source_rows") - 1))


def conflicting_attributes(df: DataFrame, key, attrs: list[str]) -> DataFrame:
    """Keys with more than one distinct attribute tuple; NULLs are significant
    (distinct over a struct, not a multi-argument distinct that skips NULL rows)."""
    return (df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("source_rows"),
                                         F.countDistinct(F.struct(*attrs)).alias("variants"))
            .where("variants > 1"))


def multi_parent(df: DataFrame, key, parents: list[str]) -> DataFrame:
    """E5: keys linked to more than one value of any parent column."""
    aggs = [F.countDistinct(p).alias(f"{p}_count") for p in parents]
    cond = None
    for p in parents:
        c = F.col(f"{p}_count") > 1
        cond = c if cond is None else (cond | c)
    return df.groupBy(*_cols(key)).agg(*aggs).where(cond)


def tristate(yes: Column, unknown: Column) -> Column:
    """TRUE if any supporting code; else NULL if any unknown; else FALSE."""
    return (F.when(F.bool_or(F.coalesce(yes, F.lit(False))), F.lit(True))
            .when(F.bool_or(F.coalesce(unknown, F.lit(False))), F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)))


def code_set(c) -> Column:
    """Sorted distinct non-NULL codes (NULL shows in the unknown flag instead)."""
    return F.array_sort(F.collect_set(c))


def source_row_count(df: DataFrame, key) -> DataFrame:
    """Rows per grain; their sum must equal the source rows."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("source_row_count"))


def distinct_counts(df: DataFrame, cols: list[str], by=None, approximate: bool = False) -> DataFrame:
    """Exact distinct counts (approximate only when asked)."""
    f = (lambda c: F.approx_count_distinct(c)) if approximate else (lambda c: F.countDistinct(c))
    aggs = [f(c).alias(f"distinct_{c}") for c in cols]
    by = _cols(by) if by else []
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """Rows duplicated on every column, as excess rows."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.count(F.lit(1)).alias("distinct_rows"),
                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("excess_rows"),
                 F.count_if(F.col("_n") > 1).alias("duplicated_groups"))


def combine_rows(frames: list[DataFrame]) -> DataFrame:
    """Put several one-row aggregates side by side as ONE row, each computed once.

    Each frame is padded with typed NULLs for the others' columns, the frames are
    unioned (one row each) and collapsed with ``max`` — a shuffle of N rows.  This
    replaces per-column scalar subqueries (which would re-run an aggregate once per
    column) and avoids a cross join.
    """
    fields = [(i, f) for i, df in enumerate(frames) for f in df.schema.fields]
    names = [f.name for _, f in fields]
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate column names: {names}")
    padded = []
    for i, df in enumerate(frames):
        padded.append(df.select(*[F.col(f"`{f.name}`") if j == i else F.lit(None).cast(f.dataType).alias(f.name)
                                  for j, f in fields]))
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.max(F.col(f"`{n}`")).alias(n) for n in names])

"""Source profiling: each profile is one or two aggregate passes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import (is_non_finite, iso_week, local_date, week_monday_plus_one,
                                 week_sunday_plus_one)

V = "decimal(38,3)"


def measure_profile(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Per measure missing, non-finite, negative, zero, positive, min, max (one pass)."""
    aggs = []
    for c in cols:
        x = F.col(c)
        finite = F.when(~F.coalesce(is_non_finite(x), F.lit(False)), x)
        aggs += [F.count_if(x.isNull()).alias(f"{c}__missing"),
                 F.count_if(F.coalesce(is_non_finite(x), F.lit(False))).alias(f"{c}__non_finite"),
                 F.count_if(x < 0).alias(f"{c}__negative"), F.count_if(x == 0).alias(f"{c}__zero"),
                 F.count_if(x > 0).alias(f"{c}__positive"),
                 F.min(finite).cast(V).alias(f"{c}__minimum"), F.max(finite).cast(V).alias(f"{c}__maximum")]
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', `{c}__missing`, `{c}__non_finite`, `{c}__negative`, `{c}__zero`, "
                     f"`{c}__positive`, `{c}__minimum`, `{c}__maximum`" for c in cols)
    return wide.selectExpr(
        f"'{label}' AS scope",
        f"stack({len(cols)}, {rows}) as (field, missing, non_finite, negative, zero, positive, minimum, maximum)")


def anomaly_counts(df: DataFrame, high: int = C.HIGH_QUANTITY, label: str = "ALL") -> DataFrame:
    """Checks on integer cents, plus negatives of the two candidate formulas."""
    cents = {m: F.round(F.col(m) * 100, 0) for m in C.MONEY}
    q = F.col("quantity")
    s, r, c, m = cents["sales_value"], cents["retail_disc"], cents["coupon_disc"], cents["coupon_match_disc"]
    return df.agg(
        F.lit(label).alias("scope"),
        F.count_if(F.abs(q - F.round(q, 0)) > 1e-8).alias("quantity_fractional"),
        F.count_if((q == 0) & (s > 0)).alias("quantity_zero_sales_positive"),
        F.count_if((q > 0) & (s == 0)).alias("quantity_positive_sales_zero"),
        F.count_if(c > s).alias("coupon_above_sales"),
        F.count_if((m > 0) & (c == 0)).alias("match_positive_coupon_zero"),
        F.count_if(m > c).alias("match_above_coupon"),
        F.count_if(m > r).alias("match_above_retail"),
        F.count_if(q > high).alias("quantity_above_high"),
        F.count_if((s - c) < 0).alias("customer_payment_candidate_negative"),
        F.count_if((s + r + m) < 0).alias("before_discount_candidate_negative"))


def quantity_quantiles(df: DataFrame, col: str = "quantity", probs=(0.0, 0.5, 0.9, 0.99, 1.0), small: int = 100_000,
                       accuracy: int = 1_000) -> DataFrame:
    """Exact, linearly interpolated percentiles by selection.

    The wanted ranks are narrowed by passes that sort nothing: a sketch gives two cut points about a rank, a
    count says exactly how many values are below and between them.  Once at most ``small`` values (or one) are between,
    only those are counted by value and ordered.  Cut points follow the data, so an outlier or a heavy value leaves no range with
    all rows; each pass cuts the range of a rank by about ``accuracy / 4``.
    """
    x = F.col(col).cast("double")
    values = df.where(x.isNotNull()).select(x.alias("v"))
    first = values.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    spark = df.sparkSession
    if not first.n:
        return spark.createDataFrame([], "probability double, value double")
    at = {float(p): float(p) * (first.n - 1) for p in probs}
    ranks = sorted({r for a in at.values() for r in (math.floor(a), math.ceil(a))})
    state = {r: (first.lo, first.hi, 0, first.n) for r in ranks}     # lowest and highest value, values below, values within

    def within(lo: float, hi: float) -> Column:
        return F.col("v").between(lo, hi)

    def counted(bounds: dict) -> dict:
        aggs = [a for k, (lo, hi) in bounds.items() for a in (F.count_if(F.col("v") < lo).alias(f"b{k}"), F.count_if(within(lo, hi)).alias(f"w{k}"))]
        row = values.agg(*aggs).first()
        return {k: (row[f"b{k}"], row[f"w{k}"]) for k in bounds}

    while wide := [r for r in ranks if state[r][3] > small and state[r][0] < state[r][1]]:
        margin = 2 / accuracy
        share = {r: (r - state[r][2] + 0.5) / state[r][3] for r in wide}
        sketch = values.agg(*[F.percentile_approx(F.when(within(*state[r][:2]), F.col("v")), [max(0.0, share[r] - margin), min(1.0, share[r] + margin)],
                                                  accuracy).alias(f"s{r}") for r in wide]).first()
        cut = {r: (max(sketch[f"s{r}"][0], state[r][0]), min(sketch[f"s{r}"][1], state[r][1])) for r in wide}
        for r, (below, inside) in counted(cut).items():
            lo, hi, old_below, old_inside = state[r]
            if below <= r < below + inside and (cut[r] != (lo, hi)):
                state[r] = (*cut[r], below, inside)
            else:   # the sketch missed the rank, or cut nothing: halve the range of values instead
                middle = lo + (hi - lo) / 2
                half = counted({0: (lo, middle)})[0]
                if r < half[0] + half[1]:
                    state[r] = (lo, middle, *half)
                else:
                    state[r] = (math.nextafter(middle, math.inf), hi, half[0] + half[1], old_below + old_inside - half[0] - half[1])
    # what is left of each rank: a bounded number of values, or one
    wanted = spark.createDataFrame([(r, float(state[r][0]), float(state[r][1]), state[r][2]) for r in ranks], "r bigint, lo double, hi double, below bigint")
    counts = values.where(reduce(lambda a, b: a | b, [within(*state[r][:2]) for r in ranks])).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    held = counts.join(F.broadcast(wanted), F.col("v").between(F.col("lo"), F.col("hi")))     # as many rows as ranks
    upto = F.col("below") + F.sum("n").over(Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    found = held.withColumn("upto", upto).where((F.col("r") < F.col("upto")) & (F.col("r") >= F.col("upto") - F.col("n"))).select("r", "v")
    asked = spark.createDataFrame([(p, math.floor(a), math.ceil(a), a - math.floor(a)) for p, a in at.items()],
                                  "probability double, low bigint, high bigint, share double")
    ends = found.join(F.broadcast(asked), (F.col("r") == F.col("low")) | (F.col("r") == F.col("high")))
    value = lambda side: F.max(F.when(F.col("r") == F.col(side), F.col("v")))
    return ends.groupBy("probability", "share").agg(value("low").alias("_l"), value("high").alias("_h")).select(
        "probability", (F.col("_l") + (F.col("_h") - F.col("_l")) * F.col("share")).alias("value"))


def with_local_date(tx: DataFrame, zone: str = C.SOURCE_ZONE) -> DataFrame:
    return tx.withColumn("local_date", local_date("transaction_timestamp", zone))


def week_profile(tx: DataFrame) -> DataFrame:
    """Per source week: first/last date and weekday, distinct dates, span, rows."""
    g = with_local_date(tx).where(F.col("local_date").isNotNull() & F.col("week").isNotNull()) \
        .groupBy("week").agg(F.min("local_date").alias("first_date"), F.max("local_date").alias("last_date"),
                             F.countDistinct("local_date").alias("distinct_dates"),
                             F.count(F.lit(1)).alias("transaction_rows"))
    return g.select("week", "first_date", "last_date",
                    (F.weekday("first_date") + 1).alias("first_weekday"),
                    (F.weekday("last_date") + 1).alias("last_weekday"), "distinct_dates",
                    (F.datediff("last_date", "first_date") + 1).alias("calendar_span"), "transaction_rows")


def dates_in_many_weeks(tx: DataFrame) -> DataFrame:
    """P5: local dates mapped to more than one source week."""
    t = with_local_date(tx).where(F.col("local_date").isNotNull() & F.col("week").isNotNull())
    return t.groupBy("local_date").agg(F.countDistinct("week").alias("distinct_weeks")).where("distinct_weeks > 1")


def week_rule_mismatch(tx: DataFrame) -> DataFrame:
    """Rows whose source week differs from the ISO week, %U + 1 and %W + 1."""
    t = with_local_date(tx).where(F.col("local_date").isNotNull() & F.col("week").isNotNull())
    d = F.col("local_date")
    return t.agg(F.count_if(F.col("week") != iso_week(d)).alias("differs_from_iso"),
                 F.count_if(F.col("week") != week_sunday_plus_one(d)).alias("differs_from_sunday_plus_one"),
                 F.count_if(F.col("week") != week_monday_plus_one(d)).alias("differs_from_monday_plus_one"))


def year_distribution(tx: DataFrame) -> DataFrame:
    """Transactions per local year (NULL kept as its own group)."""
    return with_local_date(tx).groupBy(F.year("local_date").alias("local_year")).agg(
        F.count(F.lit(1)).alias("transactions"))


def timestamp_range(tx: DataFrame, zone: str = C.SOURCE_ZONE) -> DataFrame:
    """Missing count, first and last instant shown in the source zone."""
    ts = F.col("transaction_timestamp")
    a = tx.agg(F.count_if(ts.isNull()).alias("missing_timestamps"), F.count_if(F.col("week").isNull())
               .alias("missing_weeks"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return a.select("missing_timestamps", "missing_weeks",
                    F.date_format(F.from_utc_timestamp("lo", zone), fmt).alias("first_local"),
                    F.date_format(F.from_utc_timestamp("hi", zone), fmt).alias("last_local"))


def distinct_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Distinct non-NULL values of every column of every table, one scan a table and one exchange for all.

    Rows become (table, column, value) entries, which each task de-duplicates before they are exchanged; a hot column is
    spread by its values.
    """
    entries = []
    for name, df in tables.items():
        cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns])
        entries.append(df.select(F.lit(name).alias("table_name"), F.explode(cells).alias("e")).select("table_name", "e.*"))
    distinct = union(entries).distinct()
    return distinct.groupBy("table_name", "column_name").agg(F.count("value").alias("distinct_values"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)

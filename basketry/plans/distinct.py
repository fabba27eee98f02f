"""Exact distinct counts that can be added up: bitmaps over dense keys.

A distinct count of a day cannot be added to that of another, a set can.  Baskets, households, stores and products have dense
keys; a day's set of keys is a bitmap for each block of 32,768 keys, made by one grouped pass over the lines.  Any longer
period is the union of its days' bitmaps, and its count is exact.  Basket keys follow the days, so a day's baskets fill a few
blocks instead of being spread thinly over all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio6
from ..operators.keys import assign_keys

MONEY_T = "decimal(38,2)"
QTY_T = "decimal(38,3)"


def basket_keys(lines: DataFrame) -> DataFrame:
    """(basket_id, basket_key): dense keys in the order of each basket's first day."""
    first = lines.where(F.col("basket_id").isNotNull()).groupBy("basket_id").agg(F.min("local_date").alias("day"))
    return assign_keys(first, ["day", "basket_id"], "basket_key").select("basket_id", "basket_key")


def daily_sets(lines: DataFrame, kinds: dict[str, str], by: list[str], sums: dict[str, Column]) -> DataFrame:
    """(by, kind, bucket, bits, sums): bitmaps of the ``kinds`` (name: key column) of each group ``by``, in one pass.

    The sums go with the first kind only, so that they can be added over all rows; a NULL key is in no set.
    """
    first = next(iter(kinds))
    entries = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("bigint").alias("key"),
                        *[(v if k == first else F.lit(None)).cast("decimal(38,3)").alias(n) for n, v in sums.items()]) for k, c in kinds.items()]
    rows = lines.select(*by, F.explode(F.array(*entries)).alias("e")).select(*by, "e.*")
    return rows.groupBy(*by, "kind", F.bitmap_bucket_number("key").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"), *[F.sum(n).alias(n) for n in sums], F.count(F.lit(1)).alias("entries"))


def rolled_up(daily: DataFrame, by: list[Column], kinds: list[str], sums: list[str]) -> DataFrame:
    """(by, a count for each kind, sums): the sets' unions in coarser groups, counted exactly."""
    names = [f"g{i}" for i in range(len(by))]
    sets = daily.groupBy(*[c.alias(n) for c, n in zip(by, names, strict=True)], "kind", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), *[F.sum(s).alias(s) for s in sums], F.sum("entries").alias("entries"))
    counts = [F.coalesce(F.sum(F.when((F.col("kind") == k) & F.col("bucket").isNotNull(), F.bitmap_count("bits"))), F.lit(0)).alias(k) for k in kinds]
    total = F.coalesce(F.sum(F.when(F.col("kind") == kinds[0], F.col("entries"))), F.lit(0)).alias("rows")
    return sets.groupBy(*names).agg(*counts, *[F.sum(s).alias(s) for s in sums], total)


#: slice -> period of a day
def periods() -> dict[str, Column]:
    d = F.col("local_date")
    return {"day": F.date_format(d, "yyyy-MM-dd"), "week": F.lpad(F.col("week").cast("string"), 2, "0"), "month": F.date_format(d, "yyyy-MM"),
            "quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")), "year": F.year(d).cast("string")}


def time_slices(daily: DataFrame, weeks: DataFrame) -> DataFrame:
    """Sales and price KPIs by local day, source week, month, quarter and year, from daily sets.

    Each daily row is handed to its five periods; lines are not read again.  ``full_period`` marks weeks with a full
    7-day coverage.
    """
    slices = F.explode(F.array(*[F.struct(F.lit(n).alias("slice"), p.alias("period")) for n, p in periods().items()])).alias("p")
    rows = daily.select("*", slices)
    out = rolled_up(rows, [F.col("p.slice"), F.col("p.period")], ["basket", "household"], ["sales_value", "quantity", "priced_sales", "priced_quantity"])
    full = F.broadcast(weeks.select(F.lit("week").alias("g0"), F.lpad(F.col("source_week").cast("string"), 2, "0").alias("g1"),
                                    (~F.col("is_partial_coverage")).alias("_full")))    # 53 weeks
    money, quantity = (lambda c: F.col(c).cast(MONEY_T)), (lambda c: F.col(c).cast(QTY_T))
    return out.join(full, ["g0", "g1"], "left").select(
        F.col("g0").alias("slice"), F.col("g1").alias("period"), money("sales_value").alias("sales_value"), quantity("quantity").alias("quantity"),
        F.col("basket").alias("baskets"), F.col("household").alias("households"),
        ratio6(money("sales_value"), F.col("basket")).alias("sales_per_basket"),
        ratio6(money("priced_sales"), quantity("priced_quantity")).alias("unit_value"),
        F.when(F.col("g0") == "week", F.coalesce("_full", F.lit(False))).alias("full_period"))


def volume(daily: DataFrame) -> DataFrame:
    """Rows, and exact numbers of baskets, households, stores, products and weeks, from daily sets."""
    kinds = {"basket": "baskets", "household": "households", "store": "stores", "product": "products"}
    counted = rolled_up(daily, [F.lit(1)], list(kinds), [])
    weeks = daily.select(F.countDistinct("week")).scalar()
    return counted.select("rows", *[F.col(k).alias(v) for k, v in kinds.items()], weeks.alias("weeks"))

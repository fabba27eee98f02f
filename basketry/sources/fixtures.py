"""Driver tables -> the eight source-shaped tables of the warehouse.

The retail sources are not shipped; the driver's TPC-H-like tables are mapped
onto the same shapes (FIXTURES.md §3).  Every frame is a lazy projection /
aggregate of the parquet scan, so Catalyst prunes columns and pushes filters.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: F401
from pyspark.sql import functions as F

from .. import config as C

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

#: The tables that the sources are made from.
INPUT_TABLES = ["customer", "events", "lineitem", "orders", "part"]

_EPOCH_2017_05H = int((dt.datetime(2017, 1, 1, 5, 0, 0) - dt.datetime(1970, 1, 1)).total_seconds())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _d365() -> Column:
    return F.datediff(F.to_date("l_shipdate"), F.lit(dt.date(1995, 1, 2))) % 365


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _joined_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, Column]]:
    """Order lines with the household of their order, and the source's numbers behind the money columns.

    Lines and orders meet by a sort-merge join at any size, so what they shuffle is in proportion to the lines, and rows stay
    dealt by order for an aggregate after it.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey, "inner")
    zero = F.lit(0.0)
    return j, {"sales_value": F.when(F.col("l_discount") == 0.1, zero).otherwise(F.col("l_extendedprice")), "retail_disc": F.col("l_discount"),
               "coupon_disc": F.col("l_tax"), "coupon_match_disc": F.when(F.col("l_returnflag") == "R", F.col("l_discount")).otherwise(zero)}


def _quantity() -> Column:
    return F.col("l_quantity") - 1


def _instant() -> Column:
    return F.timestamp_seconds(F.lit(_EPOCH_2017_05H) + _d365() * 86400 + (F.col("l_linenumber") * 3 + 1) * 3600)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the household of their order and the measures; keys are still numbers."""
    j, stored = _joined_lines(spark, sf_dir)
    return j.select(
        *_LINE_KEYS,
        _quantity().cast("decimal(18,3)").alias("quantity"),
        *[_money(stored[m]).alias(m) for m in C.MONEY],
        _instant().alias("transaction_timestamp"),
        *[stored[m].cast("double").alias(f"stored_{m}") for m in C.MONEY],
    )


#: The numbers behind household, basket (the order at a supplier), store and product; different numbers make different texts.
_LINE_KEYS = ["o_custkey", "l_orderkey", "l_suppkey", "l_partkey"]


def _line_ids() -> list[Column]:
    return [_s("o_custkey").alias("household_id"),
            _s(F.col("l_suppkey") % 10).alias("store_id"),
            F.concat_ws("-", _s("l_orderkey"), _s("l_suppkey")).alias("basket_id"),
            _s("l_partkey").alias("product_id")]


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per source line (duplicates of the grain kept); ``stored_<money>`` is the source's own number, not brought to cents."""
    return _lines(spark, sf_dir).select(
        *_line_ids(), "quantity", *C.MONEY, "transaction_timestamp", *[f"stored_{m}" for m in C.MONEY],
    ).withColumn("week", source_week_of(F.col("transaction_timestamp")))


def source_week_of(ts: Column) -> Column:
    """Week number of the CJ_2017 source calendar for an instant."""
    local = F.to_date(F.from_utc_timestamp(ts, C.SOURCE_ZONE))
    return (F.floor(F.datediff(local, F.lit(C.CALENDAR_FIRST_MONDAY)) / 7) + 1).cast("int")


def _units(x: Column, scale: int) -> Column:
    """The whole number of 10^-scale that a binary number is as decimal(18, scale).

    A number that is clearly nearer to one of them than to a half needs no decimal (its rounding error is below 0.0001); any other
    goes the way of the cast.
    """
    one = 10 ** scale
    near = F.rint(x * one)
    clear = (F.abs(x) < F.lit(1e11 / one)) & (F.abs(x * one - near) < F.lit(0.001))
    return F.when(clear, near.cast("bigint")).otherwise((x.cast(f"decimal(18,{scale})") * F.lit(one)).cast("bigint"))


def _of_units(n: Column, scale: int) -> Column:
    return (n.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows brought to the basket-product grain (sums, earliest instant).

    Grouped by the numbers that the ids are made of: the groups hold the order, by which the join has dealt the rows, so they
    are not shuffled again, and the ids are written out once a group.  Sums are of whole cents and thousandths: a long is
    added in place, a wide decimal is a new object for each row.
    """
    j, stored = _joined_lines(spark, sf_dir)
    g = j.select(*_LINE_KEYS, _units(_quantity(), 3).alias("quantity"), *[_units(stored[m].cast("double"), 2).alias(m) for m in C.MONEY],
                 _instant().alias("transaction_timestamp")).groupBy(*_LINE_KEYS).agg(
        *[F.sum(m).alias(m) for m in C.MEASURES], F.min("transaction_timestamp").alias("transaction_timestamp"))
    return (g.select(*_line_ids(), _of_units(F.col("quantity"), 3).alias("quantity"), *[_of_units(F.col(m), 2).alias(m) for m in C.MONEY],
                     "transaction_timestamp")
            .withColumn("week", source_week_of(F.col("transaction_timestamp"))))


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == "F")
    ln = F.col("l_linenumber")
    display = (F.when(ln == 1, "0").when(ln == 2, "A").when(ln == 6, F.lit(None).cast("string"))
               .when(ln == 7, "8").otherwise(_s(ln)))
    rf = F.col("l_returnflag")
    mailer = (F.when(rf == "A", "A").when(rf == "N", "0")
              .when(ln == 5, "R").otherwise("D"))
    return li.select(
        _s("l_partkey").alias("product_id"),
        _s(F.col("l_suppkey") % 10).alias("store_id"),
        display.alias("display_location"),
        mailer.alias("mailer_location"),
        (F.floor((_d365() + 6) / 7) + 1).cast("int").alias("week"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").where(F.col("p_partkey") % 97 != 5)
    size = F.col("p_size")
    return p.select(
        _s("p_partkey").alias("product_id"),
        F.regexp_replace("p_brand", "[^0-9]", "").alias("manufacturer_id"),
        F.col("p_type").alias("department"),
        F.col("p_brand").alias("brand"),
        F.when(size == 50, F.lit(None).cast("string"))
         .otherwise(F.split_part("p_name", F.lit(" "), F.lit(2))).alias("product_category"),
        F.when(size == 49, F.lit("")).otherwise(F.col("p_name")).alias("product_type"),
        F.when(size % 3 == 0, F.lit(" ")).otherwise(_s(size)).alias("package_size"),
    )


def demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").where(F.col("c_custkey") % 3 == 0)
    k = F.col("c_custkey")
    null = F.lit(None).cast("string")

    def by_parity(even: str, odd: str) -> Column:
        return (F.when(k % 7 == 0, F.lit("")).when(k % 11 == 0, null)
                .when(k % 2 == 0, F.lit(even)).otherwise(F.lit(odd)))

    bal = F.col("c_acctbal")
    return c.select(
        _s(k).alias("household_id"),
        F.col("c_mktsegment").alias("age"),
        F.when(bal < 0, "NEGATIVE").when(bal == 0, "ZERO").otherwise("POSITIVE").alias("income"),
        by_parity("Homeowner", "Renter").alias("home_ownership"),
        by_parity("Married", "Single").alias("marital_status"),
        _s(k % 5).alias("household_size"),
        _s("c_nationkey").alias("household_comp"),
        _s(k % 4).alias("kids_count"),
    )


def campaign_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaigns that events name, types A (0-2), B (3-6), C (7-9); 120-day windows 40 days apart."""
    i = F.col("id")
    start = F.date_add(F.lit(dt.date(2016, 11, 14)), (i * 40).cast("int"))
    named = _events_k(spark, sf_dir).where(F.col("k").isNotNull()).select((F.col("k") % 10).alias("id")).distinct()
    return named.select(
        _s(i).alias("campaign_id"),
        F.when(i <= 2, "TypeA").when(i <= 6, "TypeB").otherwise("TypeC").alias("campaign_type"),
        start.alias("start_date"),
        F.date_add(start, 120).alias("end_date"),
    )


def _events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        "user_id", "event_type", "ts",
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_k(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    return e.select(_s(F.col("k") % 10).alias("campaign_id"), _s("user_id").alias("household_id"))


def coupons(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    both = p.unionByName(p.where(F.col("p_partkey") % 20 == 0))
    return both.select(
        _s(F.col("p_partkey") % 100).alias("coupon_upc"),
        _s("p_partkey").alias("product_id"),
        _s(F.col("p_partkey") % 10).alias("campaign_id"),
    )


def coupon_redemptions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events_k(spark, sf_dir).where(F.col("event_type") == "purchase")
    return e.select(
        _s("user_id").alias("household_id"),
        _s("k").alias("coupon_upc"),
        _s(F.col("k") % 10).alias("campaign_id"),
        F.date_add(F.lit(dt.date(2017, 1, 1)), ((F.dayofyear("ts") - 1) * 12).cast("int"))
         .alias("redemption_date"),
    )


def coupon_redemptions(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    return (raw if raw is not None else coupon_redemptions_raw(spark, sf_dir)).distinct()


SOURCES = {
    "transactions_raw": transactions_raw,
    "transactions": transactions,
    "promotions": promotions,
    "products": products,
    "demographics": demographics,
    "campaigns": campaigns,
    "campaign_descriptions": campaign_descriptions,
    "coupons": coupons,
    "coupon_redemptions_raw": coupon_redemptions_raw,
    "coupon_redemptions": coupon_redemptions,
}

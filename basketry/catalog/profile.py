"""Registered queries: source profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import local_date
from ..plans import distinct as DI
from ..plans import profile as P
from ..plans.warehouse import warehouse
from ..registry import query
from .sources import OVERVIEW_COLUMNS


def _wh(spark, d):
    return warehouse(spark, d)


def _tx_in_scope(spark, d):
    wh = _wh(spark, d)
    return wh.src.transactions.join(wh.in_scope_ids, "product_id", "left_semi")


def _mp_sql(src: str, label: str) -> str:
    parts = []
    for c in C.MEASURES:
        parts.append(f"SELECT '{label}' AS scope, '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
                     f"CAST(0 AS BIGINT) AS non_finite, count(*) FILTER (WHERE {c} < 0) AS negative, "
                     f"count(*) FILTER (WHERE {c} = 0) AS zero, count(*) FILTER (WHERE {c} > 0) AS positive, "
                     f"CAST(min({c}) AS DECIMAL(38,3)) AS minimum, CAST(max({c}) AS DECIMAL(38,3)) AS maximum FROM {src}")
    return "\nUNION ALL ".join(parts)


IN_SCOPE_TX = "(SELECT * FROM transactions WHERE product_id IN (SELECT product_id FROM in_scope_ids)) s"


@query("measure_profile", _mp_sql("transactions", "ALL") + "\nUNION ALL " + _mp_sql(IN_SCOPE_TX, "IN_SCOPE"))
def q_p1(spark, d):
    wh = _wh(spark, d)
    return P.union([P.measure_profile(wh.src.transactions, C.MEASURES, "ALL"),
                    P.measure_profile(_tx_in_scope(spark, d), C.MEASURES, "IN_SCOPE")])


def _an_sql(src: str, label: str) -> str:
    return f"""
SELECT '{label}' AS scope,
  count(*) FILTER (WHERE abs(quantity - round(quantity)) > 1e-8) AS quantity_fractional,
  count(*) FILTER (WHERE quantity = 0 AND round(sales_value * 100) > 0) AS quantity_zero_sales_positive,
  count(*) FILTER (WHERE quantity > 0 AND round(sales_value * 100) = 0) AS quantity_positive_sales_zero,
  count(*) FILTER (WHERE round(coupon_disc * 100) > round(sales_value * 100)) AS coupon_above_sales,
  count(*) FILTER (WHERE round(coupon_match_disc * 100) > 0 AND round(coupon_disc * 100) = 0) AS match_positive_coupon_zero,
  count(*) FILTER (WHERE round(coupon_match_disc * 100) > round(coupon_disc * 100)) AS match_above_coupon,
  count(*) FILTER (WHERE round(coupon_match_disc * 100) > round(retail_disc * 100)) AS match_above_retail,
  count(*) FILTER (WHERE quantity > {C.HIGH_QUANTITY}) AS quantity_above_high,
  count(*) FILTER (WHERE round(sales_value * 100) - round(coupon_disc * 100) < 0) AS customer_payment_candidate_negative,
  count(*) FILTER (WHERE round(sales_value * 100) + round(retail_disc * 100) + round(coupon_match_disc * 100) < 0) AS before_discount_candidate_negative
FROM {src}"""


@query("anomaly_counts", _an_sql("transactions", "ALL") + "\nUNION ALL " + _an_sql(IN_SCOPE_TX, "IN_SCOPE"))
def q_p2(spark, d):
    return P.union([P.anomaly_counts(_wh(spark, d).src.transactions, label="ALL"),
                    P.anomaly_counts(_tx_in_scope(spark, d), label="IN_SCOPE")])


@query("quantity_quantiles", """
SELECT unnest(CAST([0.0, 0.5, 0.9, 0.99, 1.0] AS DOUBLE[])) AS probability,
       unnest(quantile_cont(CAST(quantity AS DOUBLE), [0.0, 0.5, 0.9, 0.99, 1.0])) AS value FROM transactions""")
def q_p3(spark, d):
    return P.quantity_quantiles(_wh(spark, d).src.transactions)


@query("week_profile", """
SELECT week, min(local_date) AS first_date, max(local_date) AS last_date,
       CAST(isodow(min(local_date)) AS INTEGER) AS first_weekday, CAST(isodow(max(local_date)) AS INTEGER) AS last_weekday,
       count(DISTINCT local_date) AS distinct_dates,
       CAST(date_diff('day', min(local_date), max(local_date)) + 1 AS INTEGER) AS calendar_span,
       count(*) AS transaction_rows
FROM tx_local WHERE local_date IS NOT NULL AND week IS NOT NULL GROUP BY week""")
def q_p4(spark, d):
    return P.week_profile(_wh(spark, d).src.transactions)


@query("dates_in_many_weeks", """
SELECT local_date, count(DISTINCT week) AS distinct_weeks FROM tx_local
WHERE local_date IS NOT NULL AND week IS NOT NULL GROUP BY local_date HAVING count(DISTINCT week) > 1""")
def q_p5(spark, d):
    return P.dates_in_many_weeks(_wh(spark, d).src.transactions)


@query("week_rule_mismatch", """
SELECT count(*) FILTER (WHERE week <> weekofyear(local_date)) AS differs_from_iso,
       count(*) FILTER (WHERE week <> CAST(strftime(local_date, '%U') AS INTEGER) + 1) AS differs_from_sunday_plus_one,
       count(*) FILTER (WHERE week <> CAST(strftime(local_date, '%W') AS INTEGER) + 1) AS differs_from_monday_plus_one
FROM tx_local WHERE local_date IS NOT NULL AND week IS NOT NULL""")
def q_p6(spark, d):
    return P.week_rule_mismatch(_wh(spark, d).src.transactions)


@query("year_distribution", "SELECT CAST(year(local_date) AS INTEGER) AS local_year, count(*) AS transactions FROM tx_local GROUP BY 1")
def q_p7(spark, d):
    return P.year_distribution(_wh(spark, d).src.transactions)


@query("timestamp_range", """
SELECT count(*) FILTER (WHERE transaction_timestamp IS NULL) AS missing_timestamps,
       count(*) FILTER (WHERE week IS NULL) AS missing_weeks,
       strftime(timezone('America/New_York', timezone('UTC', min(transaction_timestamp))), '%Y-%m-%d %H:%M:%S') AS first_local,
       strftime(timezone('America/New_York', timezone('UTC', max(transaction_timestamp))), '%Y-%m-%d %H:%M:%S') AS last_local
FROM transactions""")
def q_p8(spark, d):
    return P.timestamp_range(_wh(spark, d).src.transactions)


@query("distinct_profile", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM {t}"
    for t, cols in OVERVIEW_COLUMNS.items() for c in cols))
def q_p9(spark, d):
    src = _wh(spark, d).src
    return P.distinct_profile({t: src.source(t).select(*cols) for t, cols in OVERVIEW_COLUMNS.items()})


@query("products_per_department", """
SELECT department, count(*) AS products FROM products GROUP BY department ORDER BY products DESC, department""")
def q_p10(spark, d):
    return (_wh(spark, d).src.products.groupBy("department").agg(F.count(F.lit(1)).alias("products"))
            .orderBy(F.col("products").desc(), "department"))


@query("campaign_coupon_volumes", """
SELECT 'households_with_demographics' AS metric, count(DISTINCT household_id) AS value FROM demographics
UNION ALL SELECT 'households_in_campaigns', count(DISTINCT household_id) FROM campaigns
UNION ALL SELECT 'households_redeeming', count(DISTINCT household_id) FROM coupon_redemptions
UNION ALL SELECT 'coupons', count(DISTINCT coupon_upc) FROM coupons
UNION ALL SELECT 'products_with_coupons', count(DISTINCT product_id) FROM coupons
UNION ALL SELECT 'campaigns_with_redemptions', count(DISTINCT campaign_id) FROM coupon_redemptions""")
def q_p11(spark, d):
    s = _wh(spark, d).src

    def m(name, df, col):
        return df.agg(F.countDistinct(col).alias("value")).select(F.lit(name).alias("metric"), "value")
    return P.union([m("households_with_demographics", s.demographics, "household_id"),
                    m("households_in_campaigns", s.campaigns, "household_id"),
                    m("households_redeeming", s.coupon_redemptions, "household_id"),
                    m("coupons", s.coupons, "coupon_upc"),
                    m("products_with_coupons", s.coupons, "product_id"),
                    m("campaigns_with_redemptions", s.coupon_redemptions, "campaign_id")])


@query("date_ranges", """
SELECT 'campaign_descriptions.start_date' AS column_name, min(start_date) AS min_date, max(start_date) AS max_date FROM campaign_descriptions
UNION ALL SELECT 'campaign_descriptions.end_date', min(end_date), max(end_date) FROM campaign_descriptions
UNION ALL SELECT 'coupon_redemptions.redemption_date', min(redemption_date), max(redemption_date) FROM coupon_redemptions
UNION ALL SELECT 'transactions.local_date', min(local_date), max(local_date) FROM tx_local""")
def q_p12(spark, d):
    s = _wh(spark, d).src
    t = s.transactions.select(local_date("transaction_timestamp").alias("local_date"))

    def r(name, df, col):
        return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date")).select(
            F.lit(name).alias("column_name"), "min_date", "max_date")
    return P.union([r("campaign_descriptions.start_date", s.campaign_descriptions, "start_date"),
                    r("campaign_descriptions.end_date", s.campaign_descriptions, "end_date"),
                    r("coupon_redemptions.redemption_date", s.coupon_redemptions, "redemption_date"),
                    r("transactions.local_date", t, "local_date")])


@query("utc_rollover", """
SELECT count(*) FILTER (WHERE CAST(transaction_timestamp AS DATE) <> local_date) AS utc_date_differs,
       count(*) FILTER (WHERE year(CAST(transaction_timestamp AS DATE)) > year(local_date)) AS utc_next_year
FROM tx_local""")
def q_p13(spark, d):
    t = _wh(spark, d).src.transactions
    utc = F.to_date("transaction_timestamp")
    loc = local_date("transaction_timestamp")
    return t.agg(F.count_if(utc != loc).alias("utc_date_differs"),
                 F.count_if(F.year(utc) > F.year(loc)).alias("utc_next_year"))


@query("store_coverage", """
SELECT (SELECT count(DISTINCT store_id) FROM transactions) AS transaction_stores,
       (SELECT count(DISTINCT store_id) FROM promotions) AS promotion_stores,
       (SELECT count(DISTINCT store_id) FROM transactions WHERE store_id IN (SELECT store_id FROM promotions)) AS overlap_stores""")
def q_p14(spark, d):
    s = _wh(spark, d).src
    t, p = s.transactions.select("store_id").distinct(), s.promotions.select("store_id").distinct()
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(n(t).alias("transaction_stores"), n(p).alias("promotion_stores"),
                                 n(t.join(p, "store_id", "left_semi")).alias("overlap_stores"))


@query("transaction_volume", """
SELECT count(*) AS rows, count(DISTINCT basket_id) AS baskets, count(DISTINCT household_id) AS households,
       count(DISTINCT store_id) AS stores, count(DISTINCT product_id) AS products, count(DISTINCT week) AS weeks
FROM transactions""")
def q_p15(spark, d):
    return DI.volume(_wh(spark, d).daily_sets)

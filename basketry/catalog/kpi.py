"""Registered queries: KPIs, marts, business questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..plans import distinct as DI
from ..plans import kpi as K
from ..plans.warehouse import warehouse
from ..registry import query


def _wh(spark, d):
    return warehouse(spark, d)


def _sales(spark, d):
    return _wh(spark, d).sales_in_scope


def _status(spark, d):
    wh = _wh(spark, d)
    return K.support_status(wh.sales_in_scope, wh.promotion_grouped)


def _with_category(spark, d, df):
    # the dimension has one row for each id, so a repeated lookup row cannot multiply sales
    p = _wh(spark, d).dim_product.select("product_id", "product_category")
    return df.join(p, "product_id", "left")


M2 = "AS DECIMAL(38,2))"
M3 = "AS DECIMAL(38,3))"


def r6(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0))"


SALES_KPI_SQL = f"""CAST(sum(sales_value) {M2} AS sales_value, CAST(sum(quantity) {M3} AS quantity,
  count(DISTINCT basket_id) AS baskets, count(DISTINCT household_id) AS households,
  {r6('sum(sales_value)', 'count(DISTINCT basket_id)')} AS sales_per_basket"""

# --- S: sales ---------------------------------------------------------------------


@query("kpi_sales_value", f"SELECT CAST(sum(sales_value) {M2} AS sales_value FROM sales_in_scope")
def q_s01(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("sales_value")


@query("kpi_quantity", f"SELECT CAST(sum(quantity) {M3} AS quantity FROM sales_in_scope")
def q_s02(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("quantity")


@query("kpi_baskets", "SELECT count(DISTINCT basket_id) AS baskets FROM sales_in_scope")
def q_s03(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("baskets")


@query("kpi_households", "SELECT count(DISTINCT household_id) AS households FROM sales_in_scope")
def q_s04(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("households")


@query("kpi_sales_per_basket", f"""
SELECT {r6('sum(sales_value)', 'count(DISTINCT basket_id)')} AS sales_per_basket FROM sales_in_scope""")
def q_s05(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("sales_per_basket")


@query("kpi_sales_share", f"""
SELECT store_id, CAST(sum(sales_value) {M2} AS sales_value,
       {r6('sum(sales_value)', '(SELECT sum(sales_value) FROM sales_in_scope)')} AS sales_share
FROM sales_in_scope GROUP BY store_id""")
def q_s06(spark, d):
    return K.sales_share(_sales(spark, d), "store_id")


MOM_SQL = f"""
WITH m AS (
  SELECT date_trunc('month', local_date) AS month_start, CAST(sum(sales_value) {M2} AS sales_value,
         count(DISTINCT local_date) AS observed_days,
         CAST(day(last_day(date_trunc('month', local_date))) AS INTEGER) AS calendar_days
  FROM sales_in_scope GROUP BY 1)
SELECT CAST(m.month_start AS DATE) AS month_start, m.sales_value, m.observed_days, m.calendar_days,
       m.observed_days = m.calendar_days AS comparable, p.sales_value AS prev_sales_value,
       CASE WHEN m.observed_days = m.calendar_days AND coalesce(p.observed_days = p.calendar_days, false)
            THEN {r6('m.sales_value - p.sales_value', 'p.sales_value')} END AS month_over_month
FROM m LEFT JOIN m p ON p.month_start + INTERVAL 1 MONTH = m.month_start"""


@query("kpi_month_over_month", MOM_SQL)
def q_s07(spark, d):
    return K.month_over_month(_sales(spark, d))


# --- P: price ---------------------------------------------------------------------------
UNIT_SQL = f"""CAST(sum(sales_value) {M2} AS priced_sales_value, CAST(sum(quantity) {M3} AS priced_quantity,
  count(*) AS priced_lines, {r6('sum(sales_value)', 'sum(quantity)')} AS unit_value"""


@query("kpi_unit_value", f"SELECT {UNIT_SQL} FROM sales_in_scope WHERE quantity > 0 AND sales_value >= 0")
def q_p01(spark, d):
    return K.unit_value(_sales(spark, d))


DISC_SQL = f"""CAST(sum(retail_disc) {M2} AS retail_disc, CAST(sum(coupon_disc) {M2} AS coupon_disc,
  CAST(sum(coupon_match_disc) {M2} AS coupon_match_disc, count(*) AS lines,
  CAST(sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines,
  CAST(sum(sales_value) {M2} AS sales_value,
  CAST(sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN sales_value ELSE 0 END) {M2} AS discounted_sales_value,
  {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END)', 'count(*)')} AS discounted_line_rate,
  {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN sales_value ELSE 0 END)', 'sum(sales_value)')} AS discounted_sales_share"""


@query("kpi_discounts", f"SELECT {DISC_SQL} FROM sales_in_scope")
def q_p02(spark, d):
    return K.discount_kpis(_sales(spark, d))


@query("kpi_discounted_line_rate", f"""
SELECT {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END)', 'count(*)')} AS discounted_line_rate
FROM sales_in_scope""")
def q_p05(spark, d):
    return K.discount_kpis(_sales(spark, d)).select("discounted_line_rate")


@query("kpi_discounted_sales_share", f"""
SELECT {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN sales_value ELSE 0 END)', 'sum(sales_value)')} AS discounted_sales_share
FROM sales_in_scope""")
def q_p06(spark, d):
    return K.discount_kpis(_sales(spark, d)).select("discounted_sales_share")


# --- M: promotion support ------------------------------------------------------------------
@query("support_status", """
SELECT basket_id, product_id, store_id, week, promotion_matched, support_status, unknown_reason FROM sales_status""")
def q_m00(spark, d):
    return _status(spark, d).select("basket_id", "product_id", "store_id", "week", "promotion_matched",
                                    "support_status", "unknown_reason")


MATCH_SQL = f"""count(*) AS lines, count(*) FILTER (WHERE promotion_matched) AS matched_lines,
  CAST(sum(sales_value) {M2} AS sales_value,
  CAST(sum(CASE WHEN promotion_matched THEN sales_value ELSE 0 END) {M2} AS matched_sales_value,
  {r6('count(*) FILTER (WHERE promotion_matched)', 'count(*)')} AS promo_match_rate,
  {r6('sum(CASE WHEN promotion_matched THEN sales_value ELSE 0 END)', 'sum(sales_value)')} AS promo_match_sales_share"""


@query("kpi_promo_match_rate", f"""
SELECT {r6('count(*) FILTER (WHERE promotion_matched)', 'count(*)')} AS promo_match_rate FROM sales_status""")
def q_m01(spark, d):
    return K.promo_match(_status(spark, d)).select("promo_match_rate")


@query("kpi_promo_match_sales_share", f"""
SELECT {r6('sum(CASE WHEN promotion_matched THEN sales_value ELSE 0 END)', 'sum(sales_value)')} AS promo_match_sales_share
FROM sales_status""")
def q_m02(spark, d):
    return K.promo_match(_status(spark, d)).select("promo_match_sales_share")


SHARE_STATUS_SQL = f"""
SELECT support_status, CAST(sum(sales_value) {M2} AS sales_value, count(*) AS lines,
  {r6('sum(sales_value)', "(SELECT sum(sales_value) FROM sales_status WHERE support_status <> 'UNKNOWN')")} AS sales_share,
  {r6("(SELECT sum(sales_value) FROM sales_status WHERE support_status <> 'UNKNOWN')", '(SELECT sum(sales_value) FROM sales_status)')} AS known_status_coverage
FROM sales_status WHERE support_status <> 'UNKNOWN' GROUP BY support_status"""


@query("kpi_sales_share_by_status", SHARE_STATUS_SQL)
def q_m03(spark, d):
    return K.share_by_status(_status(spark, d))


AVG_WEEKLY_SQL = f"""
SELECT support_status, count(*) AS product_store_weeks, CAST(sum(weekly_sales) {M2} AS sales_value,
  CAST(sum(weekly_quantity) {M3} AS quantity,
  {r6('sum(weekly_sales)', 'count(*)')} AS avg_weekly_sales,
  {r6('sum(weekly_quantity)', 'count(*)')} AS avg_weekly_quantity
FROM weekly_grain {{where}} GROUP BY support_status"""


@query("kpi_avg_weekly_sales", f"""
SELECT support_status, {r6('sum(weekly_sales)', 'count(*)')} AS avg_weekly_sales
FROM weekly_grain GROUP BY support_status""")
def q_m04(spark, d):
    return K.avg_weekly_by_status(_status(spark, d)).select("support_status", "avg_weekly_sales")


@query("kpi_avg_weekly_quantity", f"""
SELECT support_status, {r6('sum(weekly_quantity)', 'count(*)')} AS avg_weekly_quantity
FROM weekly_grain GROUP BY support_status""")
def q_m05(spark, d):
    return K.avg_weekly_by_status(_status(spark, d)).select("support_status", "avg_weekly_quantity")


OBS_DIFF_SQL = f"""
SELECT product_id, store_id, supported_weeks, unsupported_weeks, supported_sales, unsupported_sales,
  (CAST(supported_sales AS DOUBLE) / CAST(supported_weeks AS DOUBLE))
        / NULLIF(CAST(unsupported_sales AS DOUBLE) / CAST(unsupported_weeks AS DOUBLE), 0) - 1 AS observed_difference
FROM (
  SELECT product_id, store_id,
    count(*) FILTER (WHERE support_status <> 'NO_DISPLAY_MAILER') AS supported_weeks,
    count(*) FILTER (WHERE support_status = 'NO_DISPLAY_MAILER') AS unsupported_weeks,
    CAST(sum(weekly_sales) FILTER (WHERE support_status <> 'NO_DISPLAY_MAILER') {M2} AS supported_sales,
    CAST(sum(weekly_sales) FILTER (WHERE support_status = 'NO_DISPLAY_MAILER') {M2} AS unsupported_sales
  FROM weekly_grain WHERE support_status <> 'UNKNOWN' GROUP BY product_id, store_id) g
WHERE supported_weeks > 0 AND unsupported_weeks > 0"""


@query("kpi_observed_difference", OBS_DIFF_SQL)
def q_m06(spark, d):
    return K.observed_difference(_status(spark, d))


@query("weekly_sales_grain", "SELECT * FROM weekly_grain")
def q_m07(spark, d):
    return K.weekly_grain(_status(spark, d))


# --- C: campaigns ------------------------------------------------------------------------------
CAMPAIGN_SQL = f"""
WITH reach AS (SELECT campaign_id, count(DISTINCT household_id) AS households_reached FROM campaign_pairs GROUP BY 1),
red AS (SELECT campaign_id, count(DISTINCT household_id) AS households_redeeming, count(*) AS valid_redemptions,
               count(DISTINCT coupon_upc) AS distinct_coupons_redeemed FROM valid_redemptions GROUP BY 1),
k AS (
  SELECT c.campaign_id, c.campaign_type, coalesce(households_reached, 0) AS households_reached,
         coalesce(households_redeeming, 0) AS households_redeeming, coalesce(valid_redemptions, 0) AS valid_redemptions,
         coalesce(distinct_coupons_redeemed, 0) AS distinct_coupons_redeemed
  FROM campaign_descriptions c LEFT JOIN reach USING (campaign_id) LEFT JOIN red USING (campaign_id))
SELECT *, {r6('households_redeeming', 'households_reached')} AS redeeming_rate,
       {r6('valid_redemptions', 'households_redeeming')} AS redemptions_per_redeeming_household
FROM k"""


def _campaign(spark, d):
    wh = _wh(spark, d)
    return K.campaign_kpis(wh.dim_campaign, wh.src.campaigns.distinct(), wh.valid_redemptions)


@query("kpi_campaign", CAMPAIGN_SQL)
def q_c01(spark, d):
    return _campaign(spark, d)


@query("valid_redemptions", "SELECT * FROM valid_redemptions")
def q_c07(spark, d):
    return _wh(spark, d).valid_redemptions


@query("campaign_unique_vs_reach", """
SELECT count(DISTINCT household_id) AS unique_households, count(*) AS household_campaign_pairs FROM campaign_pairs""")
def q_c08(spark, d):
    return K.campaign_unique_vs_reach(_wh(spark, d).src.campaigns.distinct())


@query("campaign_observation_flag", """
SELECT campaign_id, start_date, end_date, (SELECT min(local_date) FROM tx_local) AS observed_start,
       (SELECT max(local_date) FROM tx_local) AS observed_end,
       start_date >= (SELECT min(local_date) FROM tx_local) AND end_date <= (SELECT max(local_date) FROM tx_local) AS fully_observed
FROM campaign_descriptions""")
def q_c09(spark, d):
    from ..functions.scalars import local_date
    wh = _wh(spark, d)
    ld = wh.src.transactions.select(local_date("transaction_timestamp").alias("d"))
    lo, hi = ld.select(F.min("d")).scalar(), ld.select(F.max("d")).scalar()
    return K.campaign_observation(wh.dim_campaign, lo, hi)


CAL_DAYS_SQL = "date_diff('day', dw.coverage_start_date, dw.coverage_end_date) + 1"


# --- T01 time slices ---------------------------------------------------------------------------------
@query("time_slices", f"""
WITH w AS (SELECT week, CAST(sum(sales_value) {M2} AS sales_value, count(DISTINCT local_date) AS selling_days
           FROM sales_in_scope GROUP BY week)
SELECT dw.source_week AS week, dw.is_partial_coverage,
       CAST(date_diff('day', dw.coverage_start_date, dw.coverage_end_date) + 1 AS INTEGER) AS calendar_days,
       w.selling_days, w.sales_value,
       {r6('w.sales_value', CAL_DAYS_SQL)} AS avg_daily_sales_calendar,
       {r6('w.sales_value', 'w.selling_days')} AS avg_daily_sales_selling,
       NOT dw.is_partial_coverage AS full_week_comparable
FROM w JOIN dim_week dw ON dw.source_week = w.week""")
def q_t01(spark, d):
    from ..functions.scalars import ratio6
    wh = _wh(spark, d)
    w = _sales(spark, d).groupBy("week").agg(
        F.sum("sales_value").cast(K.MONEY_T).alias("sales_value"),
        F.countDistinct("local_date").alias("selling_days"))
    dw = F.broadcast(wh.dim_week)
    j = w.join(dw, w.week == dw.source_week)
    cal = (F.datediff("coverage_end_date", "coverage_start_date") + 1).cast("int")
    return j.select(F.col("source_week").alias("week"), "is_partial_coverage", cal.alias("calendar_days"),
                    "selling_days", "sales_value",
                    ratio6(F.col("sales_value"), cal).alias("avg_daily_sales_calendar"),
                    ratio6(F.col("sales_value"), F.col("selling_days")).alias("avg_daily_sales_selling"),
                    (~F.col("is_partial_coverage")).alias("full_week_comparable"))


def _slice_sql(name: str, label: str, full: str) -> str:
    return f"""
SELECT '{name}' AS slice, {label} AS period, CAST(sum(sales_value) {M2} AS sales_value,
       CAST(sum(quantity) {M3} AS quantity, count(DISTINCT basket_id) AS baskets,
       count(DISTINCT household_id) AS households,
       {r6('sum(sales_value)', 'count(DISTINCT basket_id)')} AS sales_per_basket,
       {r6('sum(sales_value) FILTER (WHERE quantity > 0 AND sales_value >= 0)',
           'sum(quantity) FILTER (WHERE quantity > 0 AND sales_value >= 0)')} AS unit_value,
       {full} AS full_period
FROM sales_in_scope GROUP BY 2"""


TIME_SLICES_SQL = "\nUNION ALL ".join([
    _slice_sql("day", "strftime(local_date, '%Y-%m-%d')", "CAST(NULL AS BOOLEAN)"),
    _slice_sql("week", "lpad(CAST(week AS VARCHAR), 2, '0')",
               "coalesce((SELECT NOT w.is_partial_coverage FROM dim_week w WHERE w.source_week = any_value(week)), false)"),
    _slice_sql("month", "strftime(local_date, '%Y-%m')", "CAST(NULL AS BOOLEAN)"),
    _slice_sql("quarter", "CAST(year(local_date) AS VARCHAR) || '-Q' || CAST(quarter(local_date) AS VARCHAR)",
               "CAST(NULL AS BOOLEAN)"),
    _slice_sql("year", "CAST(year(local_date) AS VARCHAR)", "CAST(NULL AS BOOLEAN)"),
])


# --- business questions ---------------------------------------------------------------------------------
@query("bq_s01", f"SELECT CAST(sum(sales_value) {M2} AS sales_value, CAST(sum(quantity) {M3} AS quantity FROM sales_in_scope")
def q_bq_s01(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("sales_value", "quantity")


@query("bq_s02_day", f"SELECT local_date, {SALES_KPI_SQL} FROM sales_in_scope GROUP BY local_date")
def q_bq_s02_day(spark, d):
    return K.sales_kpis(_sales(spark, d), "local_date")


@query("bq_s02_week", f"SELECT week, {SALES_KPI_SQL} FROM sales_in_scope GROUP BY week")
def q_bq_s02_week(spark, d):
    return K.sales_kpis(_sales(spark, d), "week")


@query("bq_s02_month", f"""
SELECT CAST(date_trunc('month', local_date) AS DATE) AS month_start, {SALES_KPI_SQL}
FROM sales_in_scope GROUP BY 1""")
def q_bq_s02_month(spark, d):
    return K.sales_kpis(K.with_periods(_sales(spark, d)), "month_start")


@query("bq_s02", MOM_SQL)
def q_bq_s02(spark, d):
    return K.month_over_month(_sales(spark, d))


@query("bq_s03_products", f"""
SELECT product_id, CAST(sum(sales_value) {M2} AS sales_value,
       {r6('sum(sales_value)', '(SELECT sum(sales_value) FROM sales_in_scope)')} AS sales_share
FROM sales_in_scope GROUP BY product_id ORDER BY sum(sales_value) DESC, product_id LIMIT 10""")
def q_bq_s03_products(spark, d):
    s = K.sales_share(_sales(spark, d), "product_id")
    return s.orderBy(F.col("sales_value").desc(), "product_id").limit(10)


@query("bq_s03_categories", f"""
SELECT p.product_category, CAST(sum(s.sales_value) {M2} AS sales_value,
       {r6('sum(s.sales_value)', '(SELECT sum(sales_value) FROM sales_in_scope)')} AS sales_share
FROM sales_in_scope s LEFT JOIN products p USING (product_id)
GROUP BY p.product_category ORDER BY sum(s.sales_value) DESC, p.product_category LIMIT 10""")
def q_bq_s03_categories(spark, d):
    s = K.sales_share(_with_category(spark, d, _sales(spark, d)), "product_category")
    return s.orderBy(F.col("sales_value").desc(), "product_category").limit(10)


@query("bq_s04", f"""
SELECT store_id, CAST(sum(sales_value) {M2} AS sales_value, count(DISTINCT basket_id) AS baskets,
       {r6('sum(sales_value)', 'count(DISTINCT basket_id)')} AS sales_per_basket
FROM sales_in_scope GROUP BY store_id""")
def q_bq_s04(spark, d):
    return K.sales_kpis(_sales(spark, d), "store_id").select("store_id", "sales_value", "baskets",
                                                               "sales_per_basket")


@query("bq_s05", "SELECT count(DISTINCT basket_id) AS baskets, count(DISTINCT household_id) AS households FROM sales_in_scope")
def q_bq_s05(spark, d):
    return K.sales_kpis(_sales(spark, d)).select("baskets", "households")


@query("bq_s06", f"SELECT slice, period, baskets, sales_per_basket FROM ({TIME_SLICES_SQL}) t WHERE slice IN ('day', 'week', 'month')")
def q_bq_s06(spark, d):
    wh = _wh(spark, d)
    return K.time_slices(wh.sales_in_scope, wh.dim_week, ["day", "week", "month"]).select("slice", "period", "baskets", "sales_per_basket")


@query("bq_p01", f"""
SELECT product_id, store_id, CAST(date_trunc('month', local_date) AS DATE) AS month_start, {UNIT_SQL}
FROM sales_in_scope WHERE quantity > 0 AND sales_value >= 0 GROUP BY 1, 2, 3""")
def q_bq_p01(spark, d):
    return K.unit_value(K.with_periods(_sales(spark, d)), ["product_id", "store_id", "month_start"])


@query("bq_p02", f"""
SELECT CAST(sum(retail_disc) {M2} AS retail_disc, CAST(sum(coupon_disc) {M2} AS coupon_disc,
       CAST(sum(coupon_match_disc) {M2} AS coupon_match_disc FROM sales_in_scope""")
def q_bq_p02(spark, d):
    return K.discount_kpis(_sales(spark, d)).select("retail_disc", "coupon_disc", "coupon_match_disc")


@query("bq_p03", f"""
SELECT p.product_category, count(*) AS lines,
  CAST(sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines,
  {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END)', 'count(*)')} AS discounted_line_rate
FROM sales_in_scope s LEFT JOIN products p USING (product_id) GROUP BY p.product_category""")
def q_bq_p03(spark, d):
    return K.discount_kpis(_with_category(spark, d, _sales(spark, d)), "product_category").select(
        "product_category", "lines", "discounted_lines", "discounted_line_rate")


@query("bq_p03_products", f"""
SELECT product_id, count(*) AS lines,
  CAST(sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END) AS BIGINT) AS discounted_lines,
  {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END)', 'count(*)')} AS discounted_line_rate
FROM sales_in_scope GROUP BY product_id""")
def q_bq_p03_products(spark, d):
    return K.discount_kpis(_sales(spark, d), "product_id").select(
        "product_id", "lines", "discounted_lines", "discounted_line_rate")


@query("bq_p04", f"""
SELECT {r6('sum(CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN sales_value ELSE 0 END)', 'sum(sales_value)')} AS discounted_sales_share
FROM sales_in_scope""")
def q_bq_p04(spark, d):
    return K.discount_kpis(_sales(spark, d)).select("discounted_sales_share")


@query("bq_p05", f"""
SELECT product_id, CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END AS discount_any,
       {UNIT_SQL}
FROM sales_in_scope WHERE quantity > 0 AND sales_value >= 0 GROUP BY 1, 2""")
def q_bq_p05(spark, d):
    from ..functions.scalars import discount_any
    s = _sales(spark, d).withColumn("discount_any", discount_any())
    return K.unit_value(s, ["product_id", "discount_any"])


@query("bq_p06", f"""
SELECT CAST(date_trunc('month', local_date) AS DATE) AS month_start, store_id, product_id,
       CAST(sum(retail_disc) {M2} AS retail_disc, CAST(sum(coupon_disc) {M2} AS coupon_disc,
       CAST(sum(coupon_match_disc) {M2} AS coupon_match_disc
FROM sales_in_scope GROUP BY GROUPING SETS ((1, 2), (1, 3))""")
def q_bq_p06(spark, d):
    """By month and store, and by month and product (the other column null)."""
    s = K.with_periods(_sales(spark, d))
    parts = [K.discount_kpis(s, ["month_start", c]) for c in ("store_id", "product_id")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).select(
        "month_start", "store_id", "product_id", "retail_disc", "coupon_disc", "coupon_match_disc")


@query("bq_m01", f"SELECT {MATCH_SQL} FROM sales_status")
def q_bq_m01(spark, d):
    return K.promo_match(_status(spark, d))


@query("bq_m02", SHARE_STATUS_SQL)
def q_bq_m02(spark, d):
    return K.share_by_status(_status(spark, d))


@query("bq_m03", AVG_WEEKLY_SQL.format(where=""))
def q_bq_m03(spark, d):
    return K.avg_weekly_by_status(_status(spark, d))


@query("bq_m04", f"""
SELECT support_status, count(*) AS product_store_weeks, CAST(sum(weekly_quantity) {M3} AS quantity,
       {r6('sum(weekly_quantity)', 'count(*)')} AS avg_weekly_quantity
FROM weekly_grain GROUP BY support_status""")
def q_bq_m04(spark, d):
    return K.avg_weekly_by_status(_status(spark, d)).select(
        "support_status", "product_store_weeks", "quantity", "avg_weekly_quantity")


@query("bq_m05", OBS_DIFF_SQL)
def q_bq_m05(spark, d):
    return K.observed_difference(_status(spark, d))


@query("bq_m06", AVG_WEEKLY_SQL.format(
    where="WHERE support_status IN ('DISPLAY_ONLY', 'MAILER_ONLY', 'DISPLAY_MAILER')"))
def q_bq_m06(spark, d):
    return K.support_combinations(_status(spark, d))


for _bq, _cols in [("bq_c01", ["households_reached"]),
                   ("bq_c02", ["households_redeeming", "valid_redemptions"]),
                   ("bq_c03", ["redeeming_rate"]),
                   ("bq_c04", ["redemptions_per_redeeming_household"]),
                   ("bq_c05", ["distinct_coupons_redeemed"])]:
    query(_bq, f"SELECT campaign_id, {', '.join(_cols)} FROM ({CAMPAIGN_SQL}) q")(
        lambda spark, d, _c=_cols: _campaign(spark, d).select("campaign_id", *_c))


# --- marts -----------------------------------------------------------------------------------------------
@query("mart_sales_overview", f"""
SELECT local_date, store_id, product_id, p.product_category, {SALES_KPI_SQL}
FROM sales_in_scope s LEFT JOIN products p USING (product_id) GROUP BY 1, 2, 3, 4""")
def q_mt1(spark, d):
    return K.sales_kpis(_with_category(spark, d, _sales(spark, d)),
                        ["local_date", "store_id", "product_id", "product_category"])


@query("mart_price_analysis", f"""
SELECT product_id, store_id, CAST(date_trunc('month', local_date) AS DATE) AS month_start,
       CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END AS discount_any,
       CAST(sum(sales_value) {M2} AS sales_value, CAST(sum(quantity) {M3} AS quantity,
       CAST(sum(retail_disc) {M2} AS retail_disc, CAST(sum(coupon_disc) {M2} AS coupon_disc,
       CAST(sum(coupon_match_disc) {M2} AS coupon_match_disc,
       CAST(sum(sales_value) FILTER (WHERE quantity > 0 AND sales_value >= 0) {M2} AS priced_sales_value,
       CAST(sum(quantity) FILTER (WHERE quantity > 0 AND sales_value >= 0) {M3} AS priced_quantity,
       {r6('sum(sales_value) FILTER (WHERE quantity > 0 AND sales_value >= 0)', 'sum(quantity) FILTER (WHERE quantity > 0 AND sales_value >= 0)')} AS unit_value
FROM sales_in_scope GROUP BY 1, 2, 3, 4""")
def q_mt2(spark, d):
    from ..functions.scalars import discount_any, ratio6
    s = K.with_periods(_sales(spark, d)).withColumn("discount_any", discount_any())
    priced = (F.col("quantity") > 0) & (F.col("sales_value") >= 0)
    g = s.groupBy("product_id", "store_id", "month_start", "discount_any").agg(
        F.sum("sales_value").cast(K.MONEY_T).alias("sales_value"),
        F.sum("quantity").cast(K.QTY_T).alias("quantity"),
        *[F.sum(m).cast(K.MONEY_T).alias(m) for m in ["retail_disc", "coupon_disc", "coupon_match_disc"]],
        F.sum(F.when(priced, F.col("sales_value"))).cast(K.MONEY_T).alias("priced_sales_value"),
        F.sum(F.when(priced, F.col("quantity"))).cast(K.QTY_T).alias("priced_quantity"))
    return g.withColumn("unit_value", ratio6(F.col("priced_sales_value"), F.col("priced_quantity")))


@query("mart_promotion_analysis", f"""
SELECT g.*, h.sales_share, h.known_status_coverage, w.avg_weekly_sales, w.avg_weekly_quantity, o.compared_product_stores, o.avg_observed_difference
FROM (SELECT support_status, unknown_reason, count(*) AS lines, CAST(sum(sales_value) {M2} AS sales_value,
             CAST(sum(quantity) {M3} AS quantity FROM sales_status GROUP BY 1, 2) g
LEFT JOIN ({SHARE_STATUS_SQL}) h USING (support_status)
LEFT JOIN ({AVG_WEEKLY_SQL.format(where="")}) w USING (support_status),
(SELECT count(*) AS compared_product_stores, round(avg(observed_difference), 6) AS avg_observed_difference FROM ({OBS_DIFF_SQL}) d) o""")
def q_mt3(spark, d):
    """Per status: lines and sales, share among the known statuses and its coverage, weekly averages, and the observed difference."""
    st = _status(spark, d)
    g = st.groupBy("support_status", "unknown_reason").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("sales_value").cast(K.MONEY_T).alias("sales_value"),
        F.sum("quantity").cast(K.QTY_T).alias("quantity"))
    share = K.share_by_status(st).select("support_status", "sales_share", "known_status_coverage")
    weekly = K.avg_weekly_by_status(st).select("support_status", "avg_weekly_sales", "avg_weekly_quantity")
    seen = K.observed_difference(st).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("observed_difference"), 6).alias("m"))
    return (g.join(share, "support_status", "left").join(weekly, "support_status", "left")
            .withColumns({"compared_product_stores": seen.select("n").scalar(), "avg_observed_difference": seen.select("m").scalar()}))


@query("mart_campaign_coupon", f"""
SELECT k.*, c.start_date, c.end_date,
       c.start_date >= (SELECT min(local_date) FROM tx_local) AND c.end_date <= (SELECT max(local_date) FROM tx_local) AS fully_observed
FROM ({CAMPAIGN_SQL}) k JOIN campaign_descriptions c USING (campaign_id)""")
def q_mt4(spark, d):
    k = _campaign(spark, d)
    obs = q_c09(spark, d).select("campaign_id", "start_date", "end_date", "fully_observed")
    return k.join(obs, "campaign_id")


# --- KG publish guards ---------------------------------------------------------------------------------------
@query("kpi_publish_guards", f"""
SELECT (SELECT CAST(sum(sales_value) {M2} FROM sales_in_scope) AS kpi_sales_value,
       (SELECT CAST(sum(sales_value) {M2} FROM sales_in_scope) AS etl_sales_value,
       (SELECT count(*) FROM sales_status) AS joined_lines,
       (SELECT count(*) FROM sales_in_scope) AS fact_lines,
       (SELECT count(*) FROM sales_in_scope WHERE quantity > 0 AND sales_value >= 0) AS priced_lines,
       (SELECT count(*) FROM valid_redemptions) AS valid_redemptions,
       (SELECT CAST(sum(valid_redemptions) AS BIGINT) FROM ({CAMPAIGN_SQL}) k) AS campaign_redemptions,
       'PASS' AS status""")
def q_kg(spark, d):
    wh = _wh(spark, d)
    s = wh.sales_in_scope
    fact_sales = wh.fact_sales
    st = _status(spark, d)
    kpi_sales = s.select(F.sum("sales_value").cast(K.MONEY_T)).scalar()
    etl_sales = fact_sales.select(F.sum("sales_value").cast(K.MONEY_T)).scalar()
    joined = st.select(F.count(F.lit(1))).scalar()
    lines = fact_sales.select(F.count(F.lit(1))).scalar()
    priced = K.unit_value(s).select("priced_lines").scalar()
    valid = wh.valid_redemptions.select(F.count(F.lit(1))).scalar()
    camp = _campaign(spark, d).select(F.sum("valid_redemptions")).scalar()
    ok = (kpi_sales == etl_sales) & (joined == lines) & (valid == camp)
    return spark.range(1).select(
        kpi_sales.alias("kpi_sales_value"), etl_sales.alias("etl_sales_value"),
        joined.alias("joined_lines"), lines.alias("fact_lines"), priced.alias("priced_lines"),
        valid.alias("valid_redemptions"), camp.alias("campaign_redemptions"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"))


@query("kpi_time_slices", TIME_SLICES_SQL)
def q_t01_all(spark, d):
    wh = _wh(spark, d)
    return DI.time_slices(wh.daily_sets.where("in_scope"), wh.dim_week)

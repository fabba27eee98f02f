"""KPIs, marts and business questions.

Rules kept throughout: ratios are ratios of sums with a NULL for a zero
denominator; distinct counts are computed at the grain asked for and never
added across groups; money is summed exactly as decimal and ratios are
doubles of the two sums (rounding is left to display); a join used for a KPI never
multiplies the fact rows (the promotion side is unique per product-store-week).
Totals used as denominators are scalar subqueries, not single-partition windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import discount_any, ratio6

MONEY_T = "decimal(38,2)"
QTY_T = "decimal(38,3)"


def _by(by) -> list[str]:
    return [] if by is None else ([by] if isinstance(by, str) else list(by))


def _agg(df: DataFrame, by, *aggs) -> DataFrame:
    by = _by(by)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# --- time slices (T01) --------------------------------------------------------
def with_periods(sales: DataFrame) -> DataFrame:
    """Adds day, month, quarter and year of the local business date."""
    d = F.col("local_date")
    return sales.withColumns({
        "month_start": F.trunc(d, "month"),
        "calendar_year": F.year(d),
        "quarter_number": F.quarter(d),
        "month_number": F.month(d),
    })


# --- S: sales -----------------------------------------------------------------
def sales_kpis(sales: DataFrame, by=None) -> DataFrame:
    """S01-S05 at any slice."""
    return _agg(sales, by,
                F.sum("sales_value").cast(MONEY_T).alias("sales_value"),
                F.sum("quantity").cast(QTY_T).alias("quantity"),
                F.countDistinct("basket_id").alias("baskets"),
                F.countDistinct("household_id").alias("households"),
            ).withColumn("sales_per_basket", ratio6(F.col("sales_value"), F.col("baskets")))


def sales_share(sales: DataFrame, by) -> DataFrame:
    """Group sales over the sales of the same filter without the group."""
    total = sales.select(F.sum("sales_value")).scalar()
    g = _agg(sales, by, F.sum("sales_value").cast(MONEY_T).alias("sales_value"))
    return g.withColumn("sales_share", ratio6(F.col("sales_value"), total))


def month_over_month(sales: DataFrame, measure: str = "sales_value") -> DataFrame:
    """(cur - prev) / prev for calendar-adjacent months with full observed days."""
    m = (with_periods(sales).groupBy("month_start").agg(
        F.sum(measure).cast(MONEY_T).alias("sales_value"),
        F.countDistinct("local_date").alias("observed_days"))
        .withColumn("calendar_days", F.dayofmonth(F.last_day("month_start")))
        .withColumn("comparable", F.col("observed_days") == F.col("calendar_days")))
    prev = m.select(F.add_months("month_start", 1).alias("month_start"),
                    F.col("sales_value").alias("prev_sales_value"),
                    F.col("comparable").alias("prev_comparable"))
    j = m.join(prev, "month_start", "left")
    ok = F.col("comparable") & F.coalesce(F.col("prev_comparable"), F.lit(False))
    return j.select("month_start", "sales_value", "observed_days", "calendar_days", "comparable",
                    "prev_sales_value",
                    F.when(ok, ratio6(F.col("sales_value") - F.col("prev_sales_value"),
                                      F.col("prev_sales_value"))).alias("month_over_month"))


# --- P: price -----------------------------------------------------------------
def unit_value(sales: DataFrame, by=None) -> DataFrame:
    """SUM(sales)/SUM(qty) over quantity > 0 and sales >= 0 (sales = 0 kept)."""
    v = sales.where((F.col("quantity") > 0) & (F.col("sales_value") >= 0))
    return _agg(v, by, F.sum("sales_value").cast(MONEY_T).alias("priced_sales_value"),
                F.sum("quantity").cast(QTY_T).alias("priced_quantity"),
                F.count(F.lit(1)).alias("priced_lines"),
                ).withColumn("unit_value", ratio6(F.col("priced_sales_value"), F.col("priced_quantity")))


def discount_kpis(sales: DataFrame, by=None) -> DataFrame:
    """P02-P06."""
    da = discount_any()
    return _agg(sales, by,
                F.sum("retail_disc").cast(MONEY_T).alias("retail_disc"),
                F.sum("coupon_disc").cast(MONEY_T).alias("coupon_disc"),
                F.sum("coupon_match_disc").cast(MONEY_T).alias("coupon_match_disc"),
                F.count(F.lit(1)).alias("lines"),
                F.sum(da).alias("discounted_lines"),
                F.sum("sales_value").cast(MONEY_T).alias("sales_value"),
                F.sum(F.when(da == 1, F.col("sales_value")).otherwise(F.lit(0))).cast(MONEY_T)
                 .alias("discounted_sales_value"),
                ).withColumns({
                    "discounted_line_rate": ratio6(F.col("discounted_lines"), F.col("lines")),
                    "discounted_sales_share": ratio6(F.col("discounted_sales_value"), F.col("sales_value")),
                })


# --- M: promotion support -----------------------------------------------------
def support_status(sales: DataFrame, promo_weekly: DataFrame) -> DataFrame:
    """Each sales line with its support status and, for UNKNOWN, the reason.

    The promotion side is unique per (product, store, week), so the left join
    keeps the line count (checked by ``non_fanout_check``).
    """
    p = promo_weekly.select("product_id", "store_id", F.col("week").alias("_pweek"),
                            "has_display", "has_mailer", "promotion_code_unknown_flag",
                            F.lit(True).alias("_matched"))
    j = sales.join(p, (sales.product_id == p.product_id) & (sales.store_id == p.store_id)
                   & (sales.week == p._pweek), "left").drop(p.product_id).drop(p.store_id)
    matched = F.coalesce(F.col("_matched"), F.lit(False))
    unclassified = (F.col("promotion_code_unknown_flag") | F.col("has_display").isNull()
                    | F.col("has_mailer").isNull())
    hd, hm = F.col("has_display"), F.col("has_mailer")
    status = (F.when(~matched, C.UNKNOWN_STATUS).when(unclassified, C.UNKNOWN_STATUS)
              .when(hd & hm, "DISPLAY_MAILER").when(hd, "DISPLAY_ONLY").when(hm, "MAILER_ONLY")
              .otherwise("NO_DISPLAY_MAILER"))
    reason = (F.when(~matched, "NO_PROMOTION_MATCH")
              .when(unclassified, "UNCLASSIFIED_PROMOTION"))
    return j.withColumns({"promotion_matched": matched, "support_status": status,
                          "unknown_reason": reason}).drop("_matched", "_pweek")


def promo_match(status_lines: DataFrame, by=None) -> DataFrame:
    """Matched lines / lines and matched sales / sales."""
    m = F.col("promotion_matched")
    return _agg(status_lines, by,
                F.count(F.lit(1)).alias("lines"),
                F.count_if(m).alias("matched_lines"),
                F.sum("sales_value").cast(MONEY_T).alias("sales_value"),
                F.sum(F.when(m, F.col("sales_value")).otherwise(F.lit(0))).cast(MONEY_T)
                 .alias("matched_sales_value"),
                ).withColumns({
                    "promo_match_rate": ratio6(F.col("matched_lines"), F.col("lines")),
                    "promo_match_sales_share": ratio6(F.col("matched_sales_value"), F.col("sales_value")),
                })


def share_by_status(status_lines: DataFrame) -> DataFrame:
    """Share among the four known statuses; UNKNOWN excluded, coverage published."""
    known = status_lines.where(F.col("support_status") != C.UNKNOWN_STATUS)
    known_total = known.select(F.sum("sales_value")).scalar()
    all_total = status_lines.select(F.sum("sales_value")).scalar()
    g = known.groupBy("support_status").agg(F.sum("sales_value").cast(MONEY_T).alias("sales_value"),
                                            F.count(F.lit(1)).alias("lines"))
    return g.withColumns({"sales_share": ratio6(F.col("sales_value"), known_total),
                          "known_status_coverage": ratio6(known_total, all_total)})


def weekly_grain(status_lines: DataFrame) -> DataFrame:
    """Sales at product-store-week, only combinations with purchases."""
    return status_lines.groupBy("product_id", "store_id", "week", "support_status").agg(
        F.sum("sales_value").cast(MONEY_T).alias("weekly_sales"),
        F.sum("quantity").cast(QTY_T).alias("weekly_quantity"),
        F.count(F.lit(1)).alias("lines"))


def avg_weekly_by_status(status_lines: DataFrame) -> DataFrame:
    """SUM(weekly)/COUNT(*) per status at the product-store-week grain."""
    w = weekly_grain(status_lines)
    return w.groupBy("support_status").agg(
        F.count(F.lit(1)).alias("product_store_weeks"),
        F.sum("weekly_sales").cast(MONEY_T).alias("sales_value"),
        F.sum("weekly_quantity").cast(QTY_T).alias("quantity"),
    ).withColumns({
        "avg_weekly_sales": ratio6(F.col("sales_value"), F.col("product_store_weeks")),
        "avg_weekly_quantity": ratio6(F.col("quantity"), F.col("product_store_weeks")),
    })


def observed_difference(status_lines: DataFrame) -> DataFrame:
    """Per product-store with both groups, AVG(supported)/AVG(NO_DISPLAY_MAILER) - 1."""
    w = weekly_grain(status_lines).where(F.col("support_status") != C.UNKNOWN_STATUS)
    sup = F.col("support_status") != "NO_DISPLAY_MAILER"
    g = w.groupBy("product_id", "store_id").agg(
        F.count_if(sup).alias("supported_weeks"),
        F.count_if(~sup).alias("unsupported_weeks"),
        F.sum(F.when(sup, F.col("weekly_sales"))).cast(MONEY_T).alias("supported_sales"),
        F.sum(F.when(~sup, F.col("weekly_sales"))).cast(MONEY_T).alias("unsupported_sales"))
    g = g.where((F.col("supported_weeks") > 0) & (F.col("unsupported_weeks") > 0))
    avg_s = F.col("supported_sales").cast("double") / F.col("supported_weeks").cast("double")
    avg_u = F.col("unsupported_sales").cast("double") / F.col("unsupported_weeks").cast("double")
    return g.withColumn("observed_difference", avg_s / F.nullif(avg_u, F.lit(0.0)) - 1)


def support_combinations(status_lines: DataFrame) -> DataFrame:
    """bq_m06: both supports vs each alone (known statuses, weekly grain)."""
    return avg_weekly_by_status(status_lines.where(F.col("support_status").isin(
        "DISPLAY_ONLY", "MAILER_ONLY", "DISPLAY_MAILER")))


# --- C: campaigns -------------------------------------------------------------
def campaign_kpis(dim_campaign: DataFrame, bridge_pairs: DataFrame,
                  valid_redemptions: DataFrame) -> DataFrame:
    """Two pre-aggregates per campaign joined to the campaign list."""
    reach = bridge_pairs.groupBy("campaign_id").agg(
        F.countDistinct("household_id").alias("households_reached"))
    red = valid_redemptions.groupBy("campaign_id").agg(
        F.countDistinct("household_id").alias("households_redeeming"),
        F.count(F.lit(1)).alias("valid_redemptions"),
        F.countDistinct("coupon_upc").alias("distinct_coupons_redeemed"))
    j = (dim_campaign.select("campaign_id", "campaign_type").join(reach, "campaign_id", "left")
         .join(red, "campaign_id", "left"))
    z = F.lit(0).cast("bigint")
    j = j.select("campaign_id", "campaign_type",
                 F.coalesce("households_reached", z).alias("households_reached"),
                 F.coalesce("households_redeeming", z).alias("households_redeeming"),
                 F.coalesce("valid_redemptions", z).alias("valid_redemptions"),
                 F.coalesce("distinct_coupons_redeemed", z).alias("distinct_coupons_redeemed"))
    return j.withColumns({
        "redeeming_rate": ratio6(F.col("households_redeeming"), F.col("households_reached")),
        "redemptions_per_redeeming_household": ratio6(F.col("valid_redemptions"),
                                                      F.col("households_redeeming")),
    })


def campaign_unique_vs_reach(bridge_pairs: DataFrame) -> DataFrame:
    """Distinct households over all campaigns vs household-campaign pairs."""
    return bridge_pairs.agg(F.countDistinct("household_id").alias("unique_households"),
                            F.count(F.lit(1)).alias("household_campaign_pairs"))


def campaign_observation(dim_campaign: DataFrame, observed_lo: Column, observed_hi: Column) -> DataFrame:
    """A campaign starting before or ending after the observed window is partial."""
    return dim_campaign.select(
        "campaign_id", "start_date", "end_date",
        observed_lo.alias("observed_start"), observed_hi.alias("observed_end"),
        ((F.col("start_date") >= observed_lo) & (F.col("end_date") <= observed_hi))
        .alias("fully_observed"))


def time_slices(sales: DataFrame, weeks: DataFrame, slices: list[str] | None = None) -> DataFrame:
    """Sales and price KPIs by local day, source week, month, quarter and year.

    One long table (slice, period); distinct counts are computed per period,
    never added up.  Lines are first brought to one row for each day, week, basket
    and household, an exchange that all slices reuse.  ``full_period`` marks weeks
    with a full 7-day coverage (week 1 is partial and is excluded from full-week
    comparisons).
    """
    priced = (F.col("quantity") > 0) & (F.col("sales_value") >= 0)
    small = sales.groupBy("local_date", "week", "basket_id", "household_id").agg(
        F.sum("sales_value").alias("sales_value"), F.sum("quantity").alias("quantity"),
        F.sum(F.when(priced, F.col("sales_value"))).alias("_ps"), F.sum(F.when(priced, F.col("quantity"))).alias("_pq"))
    s = with_periods(small)
    aggs = [F.sum("sales_value").cast(MONEY_T).alias("sales_value"),
            F.sum("quantity").cast(QTY_T).alias("quantity"),
            F.countDistinct("basket_id").alias("baskets"),
            F.countDistinct("household_id").alias("households"),
            F.sum("_ps").cast(MONEY_T).alias("_ps"), F.sum("_pq").cast(QTY_T).alias("_pq")]
    labels = {
        "day": F.date_format("local_date", "yyyy-MM-dd"),
        "week": F.lpad(F.col("week").cast("string"), 2, "0"),
        "month": F.date_format("local_date", "yyyy-MM"),
        "quarter": F.concat(F.col("calendar_year").cast("string"), F.lit("-Q"), F.col("quarter_number").cast("string")),
        "year": F.col("calendar_year").cast("string"),
    }
    wk = F.broadcast(weeks.select(F.lpad(F.col("source_week").cast("string"), 2, "0").alias("period"),
                                  (~F.col("is_partial_coverage")).alias("_full")))
    parts = []
    for name in slices or labels:
        g = s.groupBy(labels[name].alias("period")).agg(*aggs).withColumn("slice", F.lit(name))
        if name == "week":
            g = g.join(wk, "period", "left").withColumn("full_period", F.coalesce("_full", F.lit(False))).drop("_full")
        else:
            g = g.withColumn("full_period", F.lit(None).cast("boolean"))
        parts.append(g)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("slice", "period", "sales_value", "quantity", "baskets", "households",
                      ratio6(F.col("sales_value"), F.col("baskets")).alias("sales_per_basket"),
                      ratio6(F.col("_ps"), F.col("_pq")).alias("unit_value"), "full_period")

"""Registered queries: calendar, dimensions, bridges, facts and load stats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import local_date, tiny_off_cent
from ..plans.warehouse import warehouse
from ..registry import query


def _wh(spark, d):
    return warehouse(spark, d)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- calendar -------------------------------------------------------------------
def _weeks_with(spark, d, used, name):
    """The calendar's weeks with the number of rows of a source that fall into each."""
    n = used.groupBy(F.col("week").alias("source_week")).agg(F.count(F.lit(1)).alias(name))
    return _wh(spark, d).dim_week.join(n, "source_week", "left").withColumn(name, F.coalesce(name, F.lit(0)))


@query("expected_weeks", """
SELECT w.*, (SELECT count(*) FROM transactions_raw t WHERE t.week = w.source_week) AS transaction_rows FROM dim_week w""")
def q_expected_weeks(spark, d):
    return _weeks_with(spark, d, _wh(spark, d).src.transactions_raw, "transaction_rows")


@query("dim_week", """
SELECT w.*, (SELECT count(*) FROM promotions t WHERE t.week = w.source_week) AS promotion_rows FROM dim_week w""")
def q_dim_week(spark, d):
    return _weeks_with(spark, d, _wh(spark, d).src.promotions, "promotion_rows")


@query("date_bounds", """
SELECT 'transactions' AS source, min(local_date) AS lo, max(local_date) AS hi FROM tx_local
UNION ALL SELECT 'campaign_descriptions', min(start_date), max(end_date) FROM campaign_descriptions
UNION ALL SELECT 'coupon_redemptions', min(redemption_date), max(redemption_date) FROM coupon_redemptions
UNION ALL SELECT 'dim_week', min(week_start_date), max(week_end_date) FROM dim_week""")
def q_date_bounds(spark, d):
    return _wh(spark, d).date_bounds


@query("dim_date", "SELECT * FROM dim_date")
def q_dim_date(spark, d):
    return _wh(spark, d).dim_date


CAL_CHECKS_SQL = """
SELECT 'transactions_timestamp_missing' AS check_name, count(*) AS affected FROM transactions WHERE transaction_timestamp IS NULL
UNION ALL SELECT 'transactions_week_unmapped', count(*) FROM tx_local t WHERE NOT EXISTS (SELECT 1 FROM dim_week w WHERE w.source_week = t.week)
UNION ALL SELECT 'transactions_outside_week_coverage', count(*) FROM tx_local t JOIN dim_week w ON w.source_week = t.week
   WHERE t.local_date NOT BETWEEN w.coverage_start_date AND w.coverage_end_date
UNION ALL SELECT 'promotions_week_unmapped', count(*) FROM promotions p WHERE NOT EXISTS (SELECT 1 FROM dim_week w WHERE w.source_week = p.week)
UNION ALL SELECT 'redemptions_date_unmapped', count(*) FROM coupon_redemptions r WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.full_date = r.redemption_date)
UNION ALL SELECT 'dim_date_gaps', CAST(date_diff('day', min(full_date), max(full_date)) + 1 - count(*) AS BIGINT) FROM dim_date
UNION ALL SELECT 'dim_week_count_not_53', CAST(abs(count(*) - 53) AS BIGINT) FROM dim_week"""


@query("calendar_checks", f"SELECT check_name, affected, CASE WHEN affected = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({CAL_CHECKS_SQL}) c")
def q_calendar_checks(spark, d):
    wh = _wh(spark, d)
    tx = wh.src.transactions.select("week", local_date("transaction_timestamp").alias("local_date"),
                                    "transaction_timestamp")
    wk = F.broadcast(wh.dim_week)   # 53 rows by construction
    dd = wh.dim_date
    n = F.count(F.lit(1))
    checks = [
        tx.where(F.col("transaction_timestamp").isNull()).select(F.lit("transactions_timestamp_missing").alias("check_name"), n.alias("affected")),
        tx.join(wk, tx.week == wk.source_week, "left_anti").select(F.lit("transactions_week_unmapped").alias("check_name"), n.alias("affected")),
        tx.join(wk, tx.week == wk.source_week).where(~F.col("local_date").between(
            F.col("coverage_start_date"), F.col("coverage_end_date"))).select(
            F.lit("transactions_outside_week_coverage").alias("check_name"), n.alias("affected")),
        wh.src.promotions.join(wk, F.col("week") == wk.source_week, "left_anti").select(
            F.lit("promotions_week_unmapped").alias("check_name"), n.alias("affected")),
        wh.src.coupon_redemptions.join(dd, F.col("redemption_date") == dd.full_date, "left_anti").select(
            F.lit("redemptions_date_unmapped").alias("check_name"), n.alias("affected")),
        wh.dim_date.select(F.lit("dim_date_gaps").alias("check_name"),
                           (F.datediff(F.max("full_date"), F.min("full_date")) + 1 - n).cast("bigint").alias("affected")),
        wh.dim_week.select(F.lit("dim_week_count_not_53").alias("check_name"),
                           F.abs(n - 53).cast("bigint").alias("affected")),
    ]
    return _union(checks).withColumn("status", F.when(F.col("affected") == 0, "PASS").otherwise("FAIL"))


# --- dimensions ------------------------------------------------------------------------
for _dim in ["dim_product", "dim_household", "dim_store", "dim_campaign", "dim_coupon"]:
    query(_dim, f"SELECT * FROM {_dim}")(lambda spark, d, _n=_dim: getattr(_wh(spark, d), _n))


# --- bridges ------------------------------------------------------------------------------
@query("bridge_campaign_household", """
SELECT p.campaign_id, p.household_id, c.campaign_key, h.household_key, CAST(1 AS BIGINT) AS etl_batch_id
FROM campaign_pairs p LEFT JOIN dim_campaign c USING (campaign_id) LEFT JOIN dim_household h USING (household_id)""")
def q_bridge_ch(spark, d):
    return _wh(spark, d).bridge_campaign_household


@query("bridge_coupon_product", """
SELECT t.campaign_id, t.coupon_upc, t.product_id, c.coupon_key, p.product_key, CAST(1 AS BIGINT) AS etl_batch_id
FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons) t
LEFT JOIN dim_coupon c USING (campaign_id, coupon_upc) LEFT JOIN dim_product p USING (product_id)""")
def q_bridge_cp(spark, d):
    return _wh(spark, d).bridge_coupon_product


@query("bridge_dedup_audit", """
SELECT 'bridge_campaign_household' AS bridge, (SELECT count(*) FROM campaigns) AS source_rows,
       (SELECT count(*) FROM campaign_pairs) AS distinct_links,
       (SELECT count(*) FROM campaigns) - (SELECT count(*) FROM campaign_pairs) AS removed_duplicates,
       (SELECT count(*) FROM campaign_pairs p LEFT JOIN dim_campaign c USING (campaign_id)
          LEFT JOIN dim_household h USING (household_id) WHERE c.campaign_key IS NULL OR h.household_key IS NULL) AS missing_keys
UNION ALL
SELECT 'bridge_coupon_product', (SELECT count(*) FROM coupons),
       (SELECT count(*) FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons)),
       (SELECT count(*) FROM coupons) - (SELECT count(*) FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons)),
       (SELECT count(*) FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons) t
          LEFT JOIN dim_coupon c USING (campaign_id, coupon_upc) LEFT JOIN dim_product p USING (product_id)
          WHERE c.coupon_key IS NULL OR p.product_key IS NULL)""")
def q_bridge_audit(spark, d):
    wh = _wh(spark, d)
    n = F.count(F.lit(1))

    def audit(name, src, bridge, keys):
        links = bridge.agg(n.alias("distinct_links"),
                           F.count_if(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))
                           .alias("missing_keys"))
        s = src.select(n).scalar()
        return links.select(F.lit(name).alias("bridge"), s.alias("source_rows"), "distinct_links",
                            (s - F.col("distinct_links")).alias("removed_duplicates"), "missing_keys")

    return audit("bridge_campaign_household", wh.src.campaigns, wh.bridge_campaign_household,
                 ["campaign_key", "household_key"]).unionByName(
        audit("bridge_coupon_product", wh.src.coupons, wh.bridge_coupon_product,
              ["coupon_key", "product_key"]))


# --- facts -----------------------------------------------------------------------------------
@query("fact_sales", """
SELECT * EXCLUDE (transaction_timestamp),
       strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp FROM fact_sales""")
def q_fact_sales(spark, d):
    return _wh(spark, d).fact_sales.withColumn(
        "transaction_timestamp", F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("fact_promotion_weekly", """
SELECT * EXCLUDE (display_location_codes, mailer_location_codes),
       array_to_string(display_location_codes, ',') AS display_location_codes,
       array_to_string(mailer_location_codes, ',') AS mailer_location_codes
FROM fact_promotion_weekly""")
def q_fact_promo(spark, d):
    return _wh(spark, d).fact_promotion_weekly.withColumns({
        "display_location_codes": F.array_join("display_location_codes", ","),
        "mailer_location_codes": F.array_join("mailer_location_codes", ",")})


@query("fact_coupon_redemption", "SELECT * FROM fact_coupon_redemption")
def q_fact_red(spark, d):
    return _wh(spark, d).fact_coupon_redemption


@query("redemption_rejects", """
SELECT household_id, coupon_upc, campaign_id, redemption_date, reject_reason FROM redemptions_checked WHERE reject_reason <> ''""")
def q_red_rejects(spark, d):
    return _wh(spark, d).redemption_rejects


@query("redemption_balance", """
SELECT (SELECT count(*) FROM coupon_redemptions_raw) AS source_rows, (SELECT count(*) FROM fact_coupon_redemption) AS loaded_rows,
       (SELECT count(*) FROM redemptions_checked WHERE reject_reason <> '') AS rejected_rows,
       CASE WHEN (SELECT count(*) FROM coupon_redemptions_raw) = (SELECT count(*) FROM fact_coupon_redemption)
            + (SELECT count(*) FROM redemptions_checked WHERE reject_reason <> '') THEN 'PASS' ELSE 'FAIL' END AS status""")
def q_red_balance(spark, d):
    """Rows in = rows loaded + rows rejected."""
    from ..operators.aggregates import combine_rows
    wh = _wh(spark, d)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    w = combine_rows([count(wh.src.coupon_redemptions_raw, "source_rows"), count(wh.fact_coupon_redemption, "loaded_rows"),
                      count(wh.redemption_rejects, "rejected_rows")])
    return w.withColumn("status", F.when(F.col("source_rows") == F.col("loaded_rows") + F.col("rejected_rows"), "PASS").otherwise("FAIL"))


# --- H16-H18 load statistics --------------------------------------------------------------------
SALES_FLAG_SQL = {
    "quantity_zero_flag": "quantity = 0",
    "quantity_zero_sales_positive_flag": "quantity = 0 AND sales_value > 0",
    "positive_quantity_zero_sales_flag": "quantity > 0 AND sales_value = 0",
    "coupon_above_sales_flag": "coupon_disc > sales_value",
    "coupon_match_above_coupon_flag": "coupon_match_disc > coupon_disc",
    "high_quantity_flag": "quantity > 45",
}


def _sales_totals_sql() -> str:
    src = "(SELECT * FROM transactions WHERE product_id IN (SELECT product_id FROM in_scope_ids)) s"
    rows = [("rows", "count(*)", "count(*)")] + [(f"sum:{m}", f"sum({m})", f"sum({m})") for m in ["quantity", *C.MONEY]]
    rows += [(f"flag:{f}", f"count(*) FILTER (WHERE {c})", f"count(*) FILTER (WHERE {f})") for f, c in SALES_FLAG_SQL.items()]
    parts = [f"SELECT '{m}' AS metric, CAST((SELECT {a} FROM {src}) AS DECIMAL(38,3)) AS source_value, "
             f"CAST((SELECT {b} FROM fact_sales) AS DECIMAL(38,3)) AS target_value" for m, a, b in rows]
    parts += [f"SELECT 'tiny:{m}', CAST((SELECT count(*) FILTER (WHERE {m} <> round({m}, 2)) FROM {src}) AS DECIMAL(38,3)), "
              f"CAST((SELECT count(*) FROM {src} JOIN fact_sales f USING (basket_id, product_id) "
              f"WHERE s.{m} <> f.{m}) AS DECIMAL(38,3))" for m in C.MONEY]
    return ("SELECT *, CASE WHEN source_value IS NOT DISTINCT FROM target_value THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
            + " UNION ALL ".join(parts) + ") x")


@query("fact_sales_totals", _sales_totals_sql())
def q_fact_sales_totals(spark, d):
    """Rows, sums, flags and tiny differences of the source lines against those of the fact."""
    from ..functions.scalars import sales_flag_names, sales_flags
    from ..operators.aggregates import combine_rows
    wh = _wh(spark, d)
    src = wh.src.transactions.join(wh.in_scope_ids, "product_id", "left_semi")
    V = "decimal(38,3)"
    measures = ["quantity", *C.MONEY]
    flagged = src.select("basket_id", "product_id", *measures, *sales_flags(C.HIGH_QUANTITY))
    metrics = ["rows"] + [f"sum:{m}" for m in measures] + [f"flag:{f}" for f in sales_flag_names()]

    def totals(df, side):
        values = [F.count(F.lit(1)), *[F.sum(m) for m in measures], *[F.count_if(F.col(f)) for f in sales_flag_names()]]
        return [v.cast(V).alias(f"{side}_{m}") for v, m in zip(values, metrics)]

    # values off the cent in the source, and values that the fact stores otherwise than the source
    s = flagged.agg(*totals(flagged, "source"), *[F.count_if(tiny_off_cent(m)).cast(V).alias(f"source_tiny:{m}") for m in C.MONEY])
    f = wh.fact_sales.agg(*totals(wh.fact_sales, "target"))
    both = src.join(wh.fact_sales.select("basket_id", "product_id", *[F.col(m).alias(f"_f_{m}") for m in C.MONEY]), ["basket_id", "product_id"])
    t = both.agg(*[F.count_if(F.col(m) != F.col(f"_f_{m}")).cast(V).alias(f"target_tiny:{m}") for m in C.MONEY])
    metrics = metrics + [f"tiny:{m}" for m in C.MONEY]
    pairs = ", ".join(f"'{m}', `source_{m}`, `target_{m}`" for m in metrics)
    out = combine_rows([s, f, t]).selectExpr(f"stack({len(metrics)}, {pairs}) as (metric, source_value, target_value)")
    return out.withColumn("status", F.when(F.col("source_value").eqNullSafe(F.col("target_value")), "PASS").otherwise("FAIL"))


@query("promotion_consolidation_stats", """
SELECT count(*) AS groups, CAST(sum(source_row_count) AS BIGINT) AS source_rows,
       CAST(sum(source_row_count) - count(*) AS BIGINT) AS rows_consolidated,
       count(*) FILTER (WHERE source_row_count > 1) AS multi_row_groups,
       count(*) FILTER (WHERE promotion_code_unknown_flag) AS unknown_groups,
       count(*) FILTER (WHERE has_display IS NULL) AS null_display_groups,
       count(*) FILTER (WHERE has_mailer IS NULL) AS null_mailer_groups
FROM promo_weekly""")
def q_promo_stats(spark, d):
    g = _wh(spark, d).promotion_grouped
    return g.agg(F.count(F.lit(1)).alias("groups"),
                 F.sum("source_row_count").alias("source_rows"),
                 (F.sum("source_row_count") - F.count(F.lit(1))).alias("rows_consolidated"),
                 F.count_if(F.col("source_row_count") > 1).alias("multi_row_groups"),
                 F.count_if("promotion_code_unknown_flag").alias("unknown_groups"),
                 F.count_if(F.col("has_display").isNull()).alias("null_display_groups"),
                 F.count_if(F.col("has_mailer").isNull()).alias("null_mailer_groups"))


@query("redemption_stats", """
SELECT count(*) AS redemptions, count(DISTINCT household_id) AS households, count(DISTINCT campaign_id) AS campaigns,
       count(DISTINCT (campaign_id, coupon_upc)) AS campaign_coupon_pairs FROM fact_coupon_redemption""")
def q_red_stats(spark, d):
    f = _wh(spark, d).fact_coupon_redemption
    return f.agg(F.count(F.lit(1)).alias("redemptions"), F.countDistinct("household_id").alias("households"),
                 F.countDistinct("campaign_id").alias("campaigns"),
                 F.countDistinct(F.struct("campaign_id", "coupon_upc")).alias("campaign_coupon_pairs"))

"""Registered queries: the 57 DQ rules, the fused report and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..plans.quality import RULES, Quality, dq_gate, results
from ..plans.warehouse import warehouse
from ..registry import query

_Q: dict = {}


def quality(spark, d) -> Quality:
    wh = warehouse(spark, d)
    if id(wh) not in _Q:
        _Q[id(wh)] = Quality(wh)
    return _Q[id(wh)]


# --- DuckDB issue queries, one per rule (independent of the Spark registry) -----------
STAGED = {
    "transactions": "q_tx", "promotions": "promotions", "products": "q_products",
    "demographics": "q_demographics", "campaign_descriptions": "q_campaign_descriptions",
    "campaigns": "campaigns", "coupons": "coupons", "coupon_redemptions": "coupon_redemptions_raw",
}
Q_TX = """(SELECT t.*, CAST(timezone('America/New_York', timezone('UTC', t.transaction_timestamp)) AS DATE) AS local_date
           FROM transactions_raw t)"""
DISPLAY_IN = "('0','A','1','2','3','4','5','6','7','9')"
MAILER_IN = "('0','A','C','D','F','H','J','L','P','X','Z')"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}, ' ') = '')"


def _rule_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    for t, keys in C.REQUIRED_KEYS.items():
        src = Q_TX if t == "transactions" else STAGED[t]
        sql[f"{t}_required_keys"] = (f"SELECT {', '.join(keys)} FROM {src} x WHERE "
                                     + " OR ".join(_blank(k) for k in keys))
    for t, key in [("products", "product_id"), ("demographics", "household_id"),
                   ("campaign_descriptions", "campaign_id")]:
        attrs = list(C.DESCRIPTIONS[t]) + (["start_date", "end_date"] if t == "campaign_descriptions" else [])
        sql[f"{t}_conflicting_attributes"] = (
            f"SELECT {key}, count(*) AS source_rows FROM {STAGED[t]} GROUP BY {key} "
            f"HAVING count(DISTINCT ({', '.join(attrs)},)) > 1")
        sql[f"{t}_duplicate_keys"] = (f"SELECT {key}, count(*) AS source_rows FROM {STAGED[t]} "
                                      f"GROUP BY {key} HAVING count(*) > 1")
    for t, fields_ in [("transactions", "basket_id, product_id"),
                       ("coupon_redemptions", "household_id, coupon_upc, campaign_id, redemption_date"),
                       ("campaigns", "campaign_id, household_id"),
                       ("coupons", "campaign_id, coupon_upc, product_id"),
                       ("promotions", "product_id, store_id, week")]:
        src = Q_TX if t == "transactions" else STAGED[t]
        sql[f"{t}_duplicate_grain"] = (f"SELECT {fields_}, count(*) AS source_rows, count(*) - 1 AS excess_rows "
                                       f"FROM {src} x GROUP BY {fields_} HAVING count(*) > 1")
    sql["basket_conflict"] = (f"SELECT basket_id FROM {Q_TX} x GROUP BY basket_id "
                              "HAVING count(DISTINCT household_id) > 1 OR count(DISTINCT store_id) > 1")
    inv = " OR ".join(f"({m} IS NULL OR isinf(CAST({m} AS DOUBLE)) OR isnan(CAST({m} AS DOUBLE)) OR {m} < 0)"
                      for m in C.MEASURES)
    sql["invalid_measures"] = f"SELECT basket_id, product_id FROM {Q_TX} x WHERE {inv}"
    for m in C.MONEY:
        d = f"(CAST({m} AS DECIMAL(38,18)) * 100)"
        sql[f"{m}_cent_precision"] = (f"SELECT basket_id, product_id, {m} FROM {Q_TX} x "
                                      f"WHERE abs({d} - round({d})) >= 0.000001 OR abs(stored_{m} * 100 - round(stored_{m} * 100)) >= 0.000001")
        sql[f"{m}_tiny_decimal_difference"] = (f"SELECT basket_id, product_id, {m} FROM {Q_TX} x "
                                               f"WHERE (abs({d} - round({d})) < 0.000001 AND {m} <> round({m}, 2)) OR "
                                               f"(abs(stored_{m} * 100 - round(stored_{m} * 100)) < 0.000001 AND stored_{m} * 100 <> round(stored_{m} * 100))")
    norm = ", ".join(
        f"CASE WHEN abs((CAST({m} AS DECIMAL(38,18)) * 100) - round(CAST({m} AS DECIMAL(38,18)) * 100)) < 0.000001 "
        f"THEN round({m}, 2) ELSE {m} END AS {m}" for m in C.MONEY)
    sales_norm = (f"(SELECT basket_id, product_id, quantity, {norm} FROM {Q_TX} x "
                  "WHERE product_id IN (SELECT product_id FROM in_scope_ids))")
    conds = {
        "quantity_zero": "quantity = 0", "sales_zero": "sales_value = 0",
        "zero_quantity_positive_sales": "quantity = 0 AND sales_value > 0",
        "positive_quantity_zero_sales": "quantity > 0 AND sales_value = 0",
        "coupon_above_sales": "coupon_disc > sales_value",
        "match_above_coupon": "coupon_match_disc > coupon_disc",
        "match_above_retail": "coupon_match_disc > retail_disc",
        "high_quantity": f"quantity > {C.HIGH_QUANTITY}",
        "fractional_quantity": "quantity <> floor(quantity)",
    }
    for name, cond in conds.items():
        sql[f"fmcg_{name}"] = (f"SELECT basket_id, product_id, quantity, sales_value, retail_disc, coupon_disc, "
                               f"coupon_match_disc FROM {sales_norm} s WHERE {cond}")
    sql["date_week_mapping"] = f"""
SELECT t.basket_id, t.product_id, t.week FROM {Q_TX} t
LEFT JOIN dim_week w ON w.source_week = t.week
LEFT JOIN dim_date d ON d.full_date = t.local_date
WHERE t.transaction_timestamp IS NULL OR w.week_key IS NULL OR d.date_key IS NULL
   OR t.local_date NOT BETWEEN w.coverage_start_date AND w.coverage_end_date"""
    sql["promotion_week_mapping"] = """
SELECT p.product_id, p.store_id, p.week FROM promotions p LEFT JOIN dim_week w ON w.source_week = p.week
WHERE w.week_key IS NULL"""
    sql["campaign_dates_type"] = """
SELECT campaign_id FROM q_campaign_descriptions c
WHERE campaign_type IS NULL OR start_date IS NULL OR end_date IS NULL OR start_date > end_date
   OR NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.full_date = c.start_date)
   OR NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.full_date = c.end_date)"""
    for t in ["campaigns", "coupons", "coupon_redemptions"]:
        keys = ", ".join(f"t.{k}" for k in C.REQUIRED_KEYS[t])
        sql[f"{t}_missing_campaign"] = (f"SELECT {keys} FROM {STAGED[t]} t WHERE NOT EXISTS "
                                        "(SELECT 1 FROM q_campaign_descriptions c WHERE c.campaign_id = t.campaign_id)")
    rc = "r.household_id, r.coupon_upc, r.campaign_id, r.redemption_date"
    sql["redemption_coupon_link"] = f"""
SELECT {rc} FROM coupon_redemptions_raw r WHERE NOT EXISTS
  (SELECT 1 FROM coupons c WHERE c.campaign_id = r.campaign_id AND c.coupon_upc = r.coupon_upc)"""
    sql["redemption_household_campaign"] = f"""
SELECT {rc} FROM coupon_redemptions_raw r WHERE NOT EXISTS
  (SELECT 1 FROM campaigns c WHERE c.campaign_id = r.campaign_id AND c.household_id = r.household_id)"""
    sql["redemption_dates"] = f"""
SELECT {rc} FROM coupon_redemptions_raw r
WHERE r.redemption_date IS NULL
   OR NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.full_date = r.redemption_date)
   OR NOT EXISTS (SELECT 1 FROM q_campaign_descriptions c WHERE c.campaign_id = r.campaign_id
                  AND r.redemption_date BETWEEN c.start_date AND c.end_date)"""
    for t in ["transactions", "promotions", "coupons"]:
        src = Q_TX if t == "transactions" else STAGED[t]
        keys = ", ".join(f"t.{k}" for k in C.REQUIRED_KEYS[t])
        sql[f"{t}_missing_product_lookup"] = (f"SELECT {keys} FROM {src} t WHERE NOT EXISTS "
                                              "(SELECT 1 FROM q_products p WHERE p.product_id = t.product_id)")
    sql["missing_demographics"] = (f"SELECT t.household_id, t.basket_id, t.product_id FROM {Q_TX} t WHERE NOT EXISTS "
                                   "(SELECT 1 FROM q_demographics d WHERE d.household_id = t.household_id)")
    for t, cols in [("products", ["product_category", "product_type", "package_size"]),
                    ("demographics", ["home_ownership", "marital_status"])]:
        for c in cols:
            sql[f"{t}_{c}_missing"] = (f"SELECT {', '.join(C.REQUIRED_KEYS[t])} FROM {STAGED[t]} "
                                       f"WHERE {c} IS NULL")
    sql["unknown_promotion_codes"] = f"""
SELECT product_id, store_id, week, display_location, mailer_location FROM promotions
WHERE display_location IS NULL OR display_location NOT IN {DISPLAY_IN}
   OR mailer_location IS NULL OR mailer_location NOT IN {MAILER_IN}"""
    return sql


RULE_SQL = _rule_sql()
assert set(RULE_SQL) == {r.code for r in RULES}, set(RULE_SQL) ^ {r.code for r in RULES}

for _r in RULES:
    query(f"dq_{_r.code}", RULE_SQL[_r.code])(
        lambda spark, d, _c=_r.code: quality(spark, d).issues(_c))


def _report_sql() -> str:
    parts = []
    for i, r in enumerate(RULES):
        parts.append(
            f"SELECT {i} AS rule_order, '{r.table}' AS table_name, '{r.rule_code}' AS rule_code, "
            f"'{r.severity}' AS severity, (SELECT count(*) FROM ({RULE_SQL[r.code]}) x) AS affected_rows")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT rule_order, table_name, rule_code, severity, affected_rows, "
            f"CASE WHEN affected_rows > 0 AND severity IN ('ERROR','WARNING') THEN 'FAIL' ELSE 'PASS' END AS status "
            f"FROM ({body}) r")


REPORT_SQL = _report_sql()


@query("dq_report", REPORT_SQL)
def q_dq_report(spark, d):
    return quality(spark, d).report()


@query("dq_gate", f"""
SELECT count(*) AS rule_rows, count(DISTINCT rule_code) AS distinct_codes,
       count(*) FILTER (WHERE severity = 'ERROR' AND status = 'FAIL') AS blocking,
       count(*) FILTER (WHERE severity = 'WARNING' AND status = 'FAIL') AS warnings,
       CASE WHEN count(*) = 57 AND count(DISTINCT rule_code) = 57
             AND count(*) FILTER (WHERE severity = 'ERROR' AND status = 'FAIL') = 0 THEN 'PASS' ELSE 'BLOCK' END AS gate
FROM ({REPORT_SQL}) r""")
def q_dq_gate(spark, d):
    return dq_gate(quality(spark, d).report())


@query("demographics_coverage", """
SELECT count(DISTINCT household_id) AS transacting_households,
       count(DISTINCT household_id) FILTER (WHERE household_id IN (SELECT household_id FROM q_demographics)) AS with_demographics,
       count(DISTINCT household_id) FILTER (WHERE household_id NOT IN (SELECT household_id FROM q_demographics)) AS without_demographics
FROM transactions""")
def q_demo_cov(spark, d):
    wh = warehouse(spark, d)
    hh = wh.src.transactions.select("household_id").distinct()
    demo = wh.q("demographics").select("household_id").distinct().withColumn("_hit", F.lit(True))
    j = hh.join(demo, "household_id", "left")
    return j.agg(F.count(F.lit(1)).alias("transacting_households"),
                 F.count_if(F.col("_hit").isNotNull()).alias("with_demographics"),
                 F.count_if(F.col("_hit").isNull()).alias("without_demographics"))


@query("promotion_unknown_audit", """
SELECT 'fact_promotion_weekly' AS table_name, 'PROMOTION_UNKNOWN_CODES' AS check_name, 'WARNING' AS severity,
       count(*) FILTER (WHERE promotion_code_unknown_flag) AS affected_groups,
       CASE WHEN count(*) FILTER (WHERE promotion_code_unknown_flag) > 0 THEN 'FAIL' ELSE 'PASS' END AS status
FROM promo_weekly""")
def q_promo_unknown(spark, d):
    g = warehouse(spark, d).promotion_grouped
    n = F.count_if("promotion_code_unknown_flag")
    return g.agg(F.lit("fact_promotion_weekly").alias("table_name"),
                 F.lit("PROMOTION_UNKNOWN_CODES").alias("check_name"), F.lit("WARNING").alias("severity"),
                 n.alias("affected_groups"), F.when(n > 0, "FAIL").otherwise("PASS").alias("status"))


def _results_sql() -> str:
    """The report with details as JSON text; samples are the five first rows of each rule by their columns as text."""
    parts = []
    for r in RULES:
        cols = r.out_cols if r.key is not None else r.cols
        order = ", ".join(f"CAST({c} AS VARCHAR) NULLS FIRST" for c in cols)
        row = " || ',' || ".join(f"""'"{c}":' || coalesce(CAST(to_json(CAST({c} AS VARCHAR)) AS VARCHAR), 'null')""" for c in cols)
        parts.append(f"""SELECT '{r.rule_code}' AS code, '{r.action.replace("'", "''")}' AS action, (SELECT coalesce(string_agg(j, ',' ORDER BY n), '') FROM (
            SELECT row_number() OVER (ORDER BY {order}) AS n, '{{' || {row} || '}}' AS j FROM ({RULE_SQL[r.code]}) x QUALIFY n <= 5)) AS samples""")
    return f"""
SELECT rule_order, table_name, rule_code, severity, status, affected_rows,
       '{{"action":' || CAST(to_json(action) AS VARCHAR) || ',"count_unit":"rows_returned_by_rule","samples":[' || samples || ']}}' AS details
FROM ({REPORT_SQL}) r JOIN ({chr(10).join(parts[:1])}
{"".join(chr(10) + "UNION ALL " + p for p in parts[1:])}) s ON s.code = r.rule_code"""


@query("dq_results", _results_sql())
def q_dq_results(spark, d):
    """The audit rows with details and samples as JSON."""
    return results(quality(spark, d))

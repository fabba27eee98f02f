"""Registered queries: warehouse verification checks."""

from __future__ import annotations

from functools import reduce

from .. import config as C
from ..plans.verify import (BATCH_TABLES, PRIMARY_KEYS, TABLES, UNIQUE_KEYS, Verify, summary)
from ..plans.warehouse import warehouse
from ..registry import query
from .joins import FK_CONTRACTS, _BRIDGE_SQL

_V: dict = {}


def verifier(spark, d) -> Verify:
    wh = warehouse(spark, d)
    if id(wh) not in _V:
        _V[id(wh)] = Verify(wh)
    return _V[id(wh)]


def chk(metric: str, expected: str, actual: str) -> str:
    return (f"SELECT '{metric}' AS metric, CAST(({expected}) AS DECIMAL(38,3)) AS expected, "
            f"CAST(({actual}) AS DECIMAL(38,3)) AS actual")


def with_status(parts: list[str]) -> str:
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT metric, expected, actual, CASE WHEN expected IS NOT DISTINCT FROM actual THEN 'PASS' "
            f"ELSE 'FAIL' END AS status FROM ({body}) c")


TABLE_SQL = dict(_BRIDGE_SQL)
TABLE_SQL.update({
    "bridge_campaign_household": """(SELECT p.campaign_id, p.household_id, c.campaign_key, h.household_key,
        CAST(1 AS BIGINT) AS etl_batch_id FROM campaign_pairs p
        LEFT JOIN dim_campaign c USING (campaign_id) LEFT JOIN dim_household h USING (household_id))""",
    "bridge_coupon_product": """(SELECT t.campaign_id, t.coupon_upc, t.product_id, c.coupon_key, p.product_key,
        CAST(1 AS BIGINT) AS etl_batch_id FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons) t
        LEFT JOIN dim_coupon c USING (campaign_id, coupon_upc) LEFT JOIN dim_product p USING (product_id))""",
})


def tbl(name: str) -> str:
    return TABLE_SQL.get(name, name)


EXPECTED_ROWS_SQL = {
    "dim_date": "SELECT date_diff('day', min(lo), max(hi)) + 1 FROM date_bounds_src",
    "dim_week": "SELECT 53",
    "dim_product": """SELECT count(*) FROM (SELECT product_id FROM products UNION SELECT product_id FROM transactions
                      UNION SELECT product_id FROM promotions UNION SELECT product_id FROM coupons)""",
    "dim_household": """SELECT count(*) FROM (SELECT household_id FROM demographics UNION SELECT household_id FROM transactions
                        UNION SELECT household_id FROM campaigns UNION SELECT household_id FROM coupon_redemptions)""",
    "dim_store": "SELECT count(*) FROM (SELECT store_id FROM transactions UNION SELECT store_id FROM promotions)",
    "dim_campaign": "SELECT count(DISTINCT campaign_id) FROM campaign_descriptions",
    "dim_coupon": "SELECT count(*) FROM coupon_pairs",
    "bridge_campaign_household": "SELECT count(*) FROM campaign_pairs",
    "bridge_coupon_product": "SELECT count(*) FROM (SELECT DISTINCT * FROM coupons)",
    "fact_sales": "SELECT count(*) FROM transactions WHERE product_id IN (SELECT product_id FROM in_scope_ids)",
    "fact_promotion_weekly": """SELECT count(*) FROM (SELECT DISTINCT product_id, store_id, week FROM promotions
                                WHERE product_id IN (SELECT product_id FROM in_scope_ids))""",
    "fact_coupon_redemption": "SELECT count(*) FROM valid_redemptions",
}


def _row_counts_sql() -> str:
    parts = []
    for t in TABLES:
        parts.append(chk(f"{t}.row_count", EXPECTED_ROWS_SQL[t], f"SELECT count(*) FROM {tbl(t)} x"))
        if t in BATCH_TABLES:
            parts.append(chk(f"{t}.wrong_batch", "0",
                             f"SELECT count(*) FROM {tbl(t)} x WHERE etl_batch_id IS DISTINCT FROM 1"))
    return with_status(parts)


ROW_COUNTS_SQL = _row_counts_sql()


@query("verify_row_counts", ROW_COUNTS_SQL)
def q_rows(spark, d):
    return verifier(spark, d).row_counts()


SCOPE_SQL = with_status([
    chk("product.scope_vs_csv", "0", """SELECT count(*) FROM dim_product p JOIN product_scope s USING (product_id)
        WHERE p.scope_status IS DISTINCT FROM s.scope_status"""),
    chk("product.extra_codes", """SELECT count(*) FROM (SELECT product_id FROM promotions UNION SELECT product_id FROM coupons) x
        WHERE product_id NOT IN (SELECT product_id FROM products) AND product_id NOT IN (SELECT product_id FROM transactions)""",
        "SELECT count(*) FROM dim_product WHERE product_id NOT IN (SELECT product_id FROM product_scope)"),
    chk("product.invalid_extra_codes", "0", """SELECT count(*) FROM dim_product WHERE product_id NOT IN
        (SELECT product_id FROM product_scope) AND NOT (scope_status = 'REVIEW' AND source_lookup_missing_flag)"""),
    chk("dim_product.wrong_scope_version", "0", "SELECT count(*) FROM dim_product p JOIN product_scope s USING (product_id) WHERE p.scope_rule_version IS DISTINCT FROM s.scope_rule_version"),
    chk("fact_sales.wrong_scope_version", "0", "SELECT count(*) FROM fact_sales WHERE scope_rule_version IS DISTINCT FROM 'fixture-1'"),
    chk("fact_sales.invalid_scope", "0", """SELECT count(*) FROM fact_sales f LEFT JOIN dim_product p USING (product_key)
        LEFT JOIN product_scope s ON s.product_id = f.product_id
        WHERE NOT coalesce(p.scope_status = 'IN_SCOPE' AND s.scope_status = 'IN_SCOPE' AND NOT p.source_lookup_missing_flag, false)"""),
    chk("fact_promotion_weekly.wrong_scope_version", "0",
        "SELECT count(*) FROM fact_promotion_weekly WHERE scope_rule_version IS DISTINCT FROM 'fixture-1'"),
    chk("fact_promotion_weekly.invalid_scope", "0", """SELECT count(*) FROM fact_promotion_weekly f
        LEFT JOIN dim_product p USING (product_key) LEFT JOIN product_scope s ON s.product_id = f.product_id
        WHERE NOT coalesce(p.scope_status = 'IN_SCOPE' AND s.scope_status = 'IN_SCOPE' AND NOT p.source_lookup_missing_flag, false)"""),
])


@query("verify_scope", SCOPE_SQL)
def q_scope(spark, d):
    return verifier(spark, d).scope()


def _keys_sql() -> str:
    parts = []
    for t in TABLES:
        for kind, key in (("pk", PRIMARY_KEYS[t]), ("uk", UNIQUE_KEYS[t])):
            cols = ", ".join(key)
            nulls = " OR ".join(f"{k} IS NULL" for k in key)
            parts.append(chk(f"{t}.{kind}_null", "0", f"SELECT count(*) FROM {tbl(t)} x WHERE {nulls}"))
            parts.append(chk(f"{t}.{kind}_duplicate", "0",
                             f"SELECT count(*) FROM (SELECT {cols} FROM {tbl(t)} x GROUP BY {cols} HAVING count(*) > 1)"))
    parts += [
        chk("dim_date.date_parts", "0", """SELECT count(*) FROM dim_date WHERE date_key <> year(full_date) * 10000
            + month(full_date) * 100 + day(full_date) OR day_of_month <> day(full_date) OR month_number <> month(full_date)
            OR quarter_number <> quarter(full_date) OR calendar_year <> year(full_date) OR day_of_week <> isodow(full_date)"""),
        chk("dim_week.week_shape", "0", """SELECT count(*) FROM dim_week WHERE isodow(week_start_date) <> 1
            OR week_end_date <> week_start_date + 6 OR coverage_start_date < week_start_date
            OR coverage_end_date > week_end_date OR coverage_start_date > coverage_end_date
            OR is_partial_coverage <> (date_diff('day', coverage_start_date, coverage_end_date) + 1 < 7)"""),
        chk("dim_campaign.dates_type", "0",
            "SELECT count(*) FROM dim_campaign WHERE start_date > end_date OR trim(campaign_type, ' ') = ''"),
        chk("dim_product.review_rule", "0",
            "SELECT count(*) FROM dim_product WHERE source_lookup_missing_flag AND scope_status <> 'REVIEW'"),
        chk("fact_promotion_weekly.null_flag_rule", "0", """SELECT count(*) FROM fact_promotion_weekly
            WHERE NOT promotion_code_unknown_flag AND (has_display IS NULL OR has_mailer IS NULL)"""),
        chk("fact_coupon_redemption.record_count", "0",
            "SELECT count(*) FROM fact_coupon_redemption WHERE redemption_record_count <> 1"),
    ]
    return with_status(parts)


KEYS_SQL = _keys_sql()


@query("verify_keys", KEYS_SQL)
def q_keys(spark, d):
    return verifier(spark, d).keys()


def _fk_sql() -> str:
    parts = []
    for name, child, ccols, parent, pcols in FK_CONTRACTS:
        notnull = " AND ".join(f"c.{a} IS NOT NULL" for a in ccols)
        match = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(ccols, pcols))
        parts.append(chk(f"fk.{name}", "0", f"SELECT count(*) FROM {tbl(child)} c WHERE {notnull} AND NOT EXISTS "
                                            f"(SELECT 1 FROM {tbl(parent)} p WHERE {match})"))
    return with_status(parts)


FK_SQL = _fk_sql()


@query("verify_foreign_keys", FK_SQL)
def q_fk(spark, d):
    return verifier(spark, d).foreign_keys()


def _sales_totals_sql() -> str:
    src = "(SELECT * FROM transactions WHERE product_id IN (SELECT product_id FROM in_scope_ids))"
    parts = [chk("sales.source_vs_target_rows", f"SELECT count(*) FROM {src} s", "SELECT count(*) FROM fact_sales")]
    for kind, of in (("source_vs_target", src), ("baseline", src.replace("FROM transactions ", "FROM transactions_raw "))):
        for m in ["quantity", *C.MONEY]:
            parts.append(chk(f"sales.{kind}.{m}", f"SELECT sum({m}) FROM {of} s", f"SELECT sum({m}) FROM fact_sales"))
    return with_status(parts)


SALES_SQL = _sales_totals_sql()


@query("verify_sales_totals", SALES_SQL)
def q_sales(spark, d):
    return verifier(spark, d).sales_totals()


CAL_SQL = with_status([
    chk("sales.date_week_mapping", "0", """SELECT count(*) FROM fact_sales f LEFT JOIN dim_date d USING (date_key)
        LEFT JOIN dim_week w USING (week_key)
        WHERE NOT coalesce(d.full_date BETWEEN w.coverage_start_date AND w.coverage_end_date, false)"""),
    chk("week.calendar_mapping", "0", """SELECT count(*) FROM (SELECT week, min(d) AS lo, max(d) AS hi FROM (SELECT week,
        CAST(timezone('America/New_York', timezone('UTC', transaction_timestamp)) AS DATE) AS d FROM transactions_raw) x GROUP BY week) s
        LEFT JOIN dim_week w ON w.source_week = s.week
        WHERE NOT coalesce(s.lo >= w.coverage_start_date AND s.hi <= w.coverage_end_date, false)"""),
])


@query("verify_calendar", CAL_SQL)
def q_cal(spark, d):
    return verifier(spark, d).calendar()


PROMO_SQL = with_status([
    chk("promotion.represented_source_rows",
        "SELECT count(*) FROM promotions WHERE product_id IN (SELECT product_id FROM in_scope_ids)",
        "SELECT sum(source_row_count) FROM fact_promotion_weekly"),
    chk("promotion.source_baseline", EXPECTED_ROWS_SQL["fact_promotion_weekly"],
        "SELECT count(*) FROM fact_promotion_weekly"),
])


@query("verify_promotion_rows", PROMO_SQL)
def q_promo(spark, d):
    return verifier(spark, d).promotion_rows()


def _fanout_sql() -> str:
    j = """(SELECT f.* FROM fact_sales f LEFT JOIN fact_promotion_weekly p
            ON p.product_key = f.product_key AND p.store_key = f.store_key AND p.week_key = f.week_key)"""
    parts = [chk("sales_promotion.join_rows", "SELECT count(*) FROM fact_sales", f"SELECT count(*) FROM {j} x")]
    for m in ["quantity", *C.MONEY]:
        parts.append(chk(f"sales_promotion.{m}", f"SELECT sum({m}) FROM fact_sales", f"SELECT sum({m}) FROM {j} x"))
    return with_status(parts)


FANOUT_SQL = _fanout_sql()


@query("verify_join_no_fanout", FANOUT_SQL)
def q_fanout(spark, d):
    return verifier(spark, d).join_no_fanout()


RED_SQL = with_status([
    chk("redemption.source_vs_loaded_and_rejected", "SELECT count(*) FROM coupon_redemptions_raw",
        """SELECT (SELECT count(*) FROM fact_coupon_redemption)
             + (SELECT count(*) FROM redemptions_checked WHERE reject_reason <> '')"""),
    chk("redemption.invalid_links_dates", "0", """SELECT count(*) FROM fact_coupon_redemption f
        LEFT JOIN dim_campaign c USING (campaign_key)
        WHERE f.household_key IS NULL OR f.coupon_key IS NULL OR f.campaign_key IS NULL
           OR NOT coalesce(f.redemption_date BETWEEN c.start_date AND c.end_date, false)"""),
])


@query("verify_redemptions", RED_SQL)
def q_red(spark, d):
    return verifier(spark, d).redemptions()


ALL_VERIFY_SQL = [ROW_COUNTS_SQL, SCOPE_SQL, KEYS_SQL, FK_SQL, SALES_SQL, CAL_SQL, PROMO_SQL, FANOUT_SQL, RED_SQL]


def full_report(spark, d):
    v = verifier(spark, d)
    wh = warehouse(spark, d)
    if v.report is not None:
        return v.report
    parts = [v.row_counts(), v.scope(), v.keys(), v.foreign_keys(), v.sales_totals(),
             v.calendar(), v.promotion_rows(), v.join_no_fanout(), v.redemptions()]
    v.report = wh._store("verify_report", reduce(lambda a, b: a.unionByName(b), parts))   # read by every audit query
    return v.report


@query("verify_report", """
SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
       count(*) FILTER (WHERE status <> 'PASS') AS failed,
       CASE WHEN count(*) FILTER (WHERE status <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (""" + "\nUNION ALL ".join(f"SELECT * FROM ({s}) v{i}" for i, s in enumerate(ALL_VERIFY_SQL)) + ") r")
def q_report(spark, d):
    return summary(full_report(spark, d))

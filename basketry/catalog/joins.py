"""Registered queries: joins (D), aggregates (E), set operations (F), keys/top-k (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import local_date, unknown_code, in_codes
from ..operators import aggregates as E
from ..operators import joins as D
from ..operators import keys as G
from ..operators import sets as S
from ..plans.verify import FOREIGN_KEYS as FK_CONTRACTS
from ..plans.warehouse import warehouse
from ..registry import query


def _wh(spark, d):
    return warehouse(spark, d)


# --- D joins -------------------------------------------------------------------------
@query("inner_scope_filter", "SELECT basket_id, product_id FROM sales_in_scope")
def q_d1(spark, d):
    wh = _wh(spark, d)
    return D.in_scope(wh.src.transactions, wh.product_scope).select("basket_id", "product_id")


@query("surrogate_lookup", """
SELECT s.basket_id, s.product_id, p.product_key, h.household_key, st.store_key FROM sales_in_scope s
LEFT JOIN dim_product p USING (product_id) LEFT JOIN dim_household h USING (household_id)
LEFT JOIN dim_store st USING (store_id)""")
def q_d2(spark, d):
    wh = _wh(spark, d)
    s = wh.sales_in_scope.select("basket_id", "product_id", "household_id", "store_id")
    j = D.lookup_chain(s, [(wh.dim_product, "product_id", "product_key"),
                           (wh.dim_household, "household_id", "household_key"),
                           (wh.dim_store, "store_id", "store_key")])
    return j.select("basket_id", "product_id", "product_key", "household_key", "store_key")


@query("composite_key_join", """
SELECT r.household_id, r.campaign_id, r.coupon_upc, r.redemption_date, c.coupon_key
FROM coupon_redemptions r LEFT JOIN dim_coupon c USING (campaign_id, coupon_upc)""")
def q_d3(spark, d):
    wh = _wh(spark, d)
    return D.lookup(wh.src.coupon_redemptions, wh.dim_coupon, ["campaign_id", "coupon_upc"], "coupon_key")


@query("date_in_week_join", """
SELECT s.basket_id, s.product_id, w.week_key FROM sales_in_scope s
LEFT JOIN dim_week w ON w.source_week = s.week AND s.local_date BETWEEN w.coverage_start_date AND w.coverage_end_date""")
def q_d4(spark, d):
    wh = _wh(spark, d)
    return D.date_in_week(wh.sales_in_scope, wh.dim_week, "local_date", "week").select(
        "basket_id", "product_id", "week_key")


@query("missing_reference", """
SELECT DISTINCT product_id FROM transactions t WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.product_id = t.product_id)""")
def q_d5(spark, d):
    wh = _wh(spark, d)
    return D.missing_reference(wh.src.transactions.select("product_id"), wh.src.products, "product_id").distinct()


@query("exists_reference", """
SELECT r.* FROM coupon_redemptions r WHERE EXISTS (SELECT 1 FROM campaign_descriptions c
  WHERE c.campaign_id = r.campaign_id AND r.redemption_date BETWEEN c.start_date AND c.end_date)""")
def q_d6(spark, d):
    wh = _wh(spark, d)
    r = wh.src.coupon_redemptions
    desc = wh.src.campaign_descriptions
    return D.has_reference(r, desc, "campaign_id",
                           extra=r.redemption_date.between(F.col("start_date"), F.col("end_date")))


NON_FANOUT_SQL = """
SELECT (SELECT count(*) FROM sales_in_scope) AS left_rows,
       (SELECT CAST(sum(sales_value) AS DECIMAL(38,2)) FROM sales_in_scope) AS left_sales_value,
       (SELECT CAST(sum(quantity) AS DECIMAL(38,3)) FROM sales_in_scope) AS left_quantity,
       (SELECT count(*) FROM sales_status) AS joined_rows,
       (SELECT count(*) FROM sales_status WHERE NOT promotion_matched) AS unmatched_rows,
       (SELECT CAST(sum(sales_value) AS DECIMAL(38,2)) FROM sales_status) AS joined_sales_value,
       (SELECT CAST(sum(quantity) AS DECIMAL(38,3)) FROM sales_status) AS joined_quantity,
       CAST(0 AS BIGINT) AS duplicate_right_keys, 'PASS' AS status"""


@query("non_fanout_left_join", NON_FANOUT_SQL)
def q_d7(spark, d):
    wh = _wh(spark, d)
    s = wh.sales_in_scope.withColumns({"sales_value": F.col("sales_value").cast("decimal(38,2)"),
                                       "quantity": F.col("quantity").cast("decimal(38,3)")})
    out = D.non_fanout_check(s, wh.promotion_grouped, ["product_id", "store_id", "week"],
                             ["sales_value", "quantity"])
    return out.withColumns({c: F.col(c).cast("decimal(38,2)") for c in ["left_sales_value", "joined_sales_value"]}
                           ).withColumns({c: F.col(c).cast("decimal(38,3)")
                                          for c in ["left_quantity", "joined_quantity"]})


_BRIDGE_SQL = {
    "load_batches": "(SELECT CAST(1 AS BIGINT) AS etl_batch_id)",
    "bridge_campaign_household": """(SELECT c.campaign_key, h.household_key, CAST(1 AS BIGINT) AS etl_batch_id FROM campaign_pairs p
        LEFT JOIN dim_campaign c USING (campaign_id) LEFT JOIN dim_household h USING (household_id))""",
    "bridge_coupon_product": """(SELECT c.coupon_key, p.product_key, CAST(1 AS BIGINT) AS etl_batch_id FROM (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons) t
        LEFT JOIN dim_coupon c USING (campaign_id, coupon_upc) LEFT JOIN dim_product p USING (product_id))""",
}


def _fk_sql() -> str:
    parts = []
    for name, child, ccols, parent, pcols in FK_CONTRACTS:
        csrc = _BRIDGE_SQL.get(child, child)
        notnull = " AND ".join(f"c.{a} IS NOT NULL" for a in ccols)
        match = " AND ".join(f"p.{b} = c.{a}" for a, b in zip(ccols, pcols))
        parts.append(f"SELECT '{name}' AS foreign_key, count(*) AS orphan_rows FROM {csrc} c "
                     f"WHERE {notnull} AND NOT EXISTS (SELECT 1 FROM {_BRIDGE_SQL.get(parent, parent)} p WHERE {match})")
    return "\nUNION ALL ".join(parts)


FK_SQL = _fk_sql()


def fk_contracts(wh):
    return [(n, getattr(wh, c), cc, getattr(wh, p), pc) for n, c, cc, p, pc in FK_CONTRACTS]


@query("orphan_check", FK_SQL)
def q_d8(spark, d):
    return D.orphan_check(fk_contracts(_wh(spark, d)))


@query("bridge_no_multiply", """
SELECT (SELECT count(*) FROM valid_redemptions) AS redemptions,
       (SELECT count(*) FROM valid_redemptions r JOIN (SELECT DISTINCT campaign_id, coupon_upc, product_id FROM coupons) b
          USING (campaign_id, coupon_upc)) AS rows_through_bridge,
       (SELECT count(*) FROM valid_redemptions r WHERE EXISTS (SELECT 1 FROM coupons b
          WHERE b.campaign_id = r.campaign_id AND b.coupon_upc = r.coupon_upc)) AS semi_filtered_redemptions""")
def q_d9(spark, d):
    wh = _wh(spark, d)
    # the multiplied count is the sum of (redemptions x products) over coupons: both sides are counted
    # first, so the join has a row for each coupon and never one for each pair
    r = wh.valid_redemptions.groupBy("campaign_id", "coupon_upc").agg(F.count(F.lit(1)).alias("r"))
    b = wh.bridge_coupon_product.groupBy("campaign_id", "coupon_upc").agg(F.count(F.lit(1)).alias("p"))
    j = r.join(b, ["campaign_id", "coupon_upc"], "left")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return j.agg(zero("r").alias("redemptions"), zero(F.col("r") * F.coalesce("p", F.lit(0))).alias("rows_through_bridge"),
                 zero(F.when(F.col("p").isNotNull(), F.col("r")).otherwise(0)).alias("semi_filtered_redemptions"))


# --- E aggregates -------------------------------------------------------------------------
@query("count_filter", """
SELECT count(*) FILTER (WHERE quantity = 0) AS quantity_zero, count(*) FILTER (WHERE sales_value = 0) AS sales_zero,
       count(*) FILTER (WHERE coupon_disc > sales_value) AS coupon_above_sales,
       count(*) FILTER (WHERE coupon_match_disc > coupon_disc) AS match_above_coupon,
       count(*) FILTER (WHERE quantity > 45) AS high_quantity
FROM transactions""")
def q_e1(spark, d):
    t = _wh(spark, d).src.transactions
    c = F.col
    return E.count_where(t, quantity_zero=c("quantity") == 0, sales_zero=c("sales_value") == 0,
                         coupon_above_sales=c("coupon_disc") > c("sales_value"),
                         match_above_coupon=c("coupon_match_disc") > c("coupon_disc"),
                         high_quantity=c("quantity") > C.HIGH_QUANTITY)


@query("sum_measures", """
SELECT CAST(coalesce(sum(quantity), 0) AS DECIMAL(38,3)) AS quantity,
       CAST(coalesce(sum(sales_value), 0) AS DECIMAL(38,3)) AS sales_value,
       CAST(coalesce(sum(retail_disc), 0) AS DECIMAL(38,3)) AS retail_disc,
       CAST(coalesce(sum(coupon_disc), 0) AS DECIMAL(38,3)) AS coupon_disc,
       CAST(coalesce(sum(coupon_match_disc), 0) AS DECIMAL(38,3)) AS coupon_match_disc FROM transactions""")
def q_e2(spark, d):
    return E.sum_measures(_wh(spark, d).src.transactions, C.MEASURES, result_type="decimal(38,3)")


@query("duplicate_groups", """
SELECT product_id, store_id, week, count(*) AS source_rows, count(*) - 1 AS excess_rows
FROM promotions GROUP BY 1, 2, 3 HAVING count(*) > 1""")
def q_e3(spark, d):
    return E.duplicate_groups(_wh(spark, d).src.promotions, ["product_id", "store_id", "week"])


@query("conflicting_attributes", """
SELECT household_comp, count(*) AS source_rows, count(DISTINCT (home_ownership, marital_status)) AS variants
FROM demographics GROUP BY household_comp HAVING count(DISTINCT (home_ownership, marital_status)) > 1""")
def q_e4(spark, d):
    return E.conflicting_attributes(_wh(spark, d).src.demographics, "household_comp",
                                    ["home_ownership", "marital_status"])


@query("basket_conflict", """
SELECT basket_id, count(DISTINCT household_id) AS household_id_count, count(DISTINCT store_id) AS store_id_count
FROM transactions_raw GROUP BY basket_id HAVING count(DISTINCT household_id) > 1 OR count(DISTINCT store_id) > 1""")
def q_e5(spark, d):
    return E.multi_parent(_wh(spark, d).src.transactions_raw, "basket_id", ["household_id", "store_id"])


@query("tristate_flag", """
SELECT has_display, has_mailer, count(*) AS groups FROM (
  SELECT CASE WHEN bool_or(coalesce(display_location IN ('1','2','3','4','5','6','7','9'), false)) THEN TRUE
              WHEN bool_or(display_location IS NULL OR display_location NOT IN ('0','A','1','2','3','4','5','6','7','9')) THEN NULL
              ELSE FALSE END AS has_display,
         CASE WHEN bool_or(coalesce(mailer_location IN ('A','C','D','F','H','J','L','P','X','Z'), false)) THEN TRUE
              WHEN bool_or(mailer_location IS NULL OR mailer_location NOT IN ('0','A','C','D','F','H','J','L','P','X','Z')) THEN NULL
              ELSE FALSE END AS has_mailer
  FROM promotions GROUP BY product_id, store_id, week) g GROUP BY 1, 2""")
def q_e6(spark, d):
    p = _wh(spark, d).src.promotions
    dl, ml = F.col("display_location"), F.col("mailer_location")
    g = p.groupBy("product_id", "store_id", "week").agg(
        E.tristate(in_codes(dl, C.DISPLAY_SUPPORT), unknown_code(dl, C.DISPLAY_KNOWN)).alias("has_display"),
        E.tristate(in_codes(ml, C.MAILER_SUPPORT), unknown_code(ml, C.MAILER_KNOWN)).alias("has_mailer"))
    return g.groupBy("has_display", "has_mailer").agg(F.count(F.lit(1)).alias("groups"))


@query("code_set", """
SELECT product_id, store_id, week, array_to_string(list_sort(list_distinct(list(display_location))), ',') AS display_location_codes,
       array_to_string(list_sort(list_distinct(list(mailer_location))), ',') AS mailer_location_codes
FROM promotions GROUP BY 1, 2, 3""")
def q_e7(spark, d):
    p = _wh(spark, d).src.promotions
    return p.groupBy("product_id", "store_id", "week").agg(
        F.array_join(E.code_set("display_location"), ",").alias("display_location_codes"),
        F.array_join(E.code_set("mailer_location"), ",").alias("mailer_location_codes"))


@query("source_row_count", "SELECT product_id, store_id, week, count(*) AS source_row_count FROM promotions GROUP BY 1, 2, 3")
def q_e8(spark, d):
    return E.source_row_count(_wh(spark, d).src.promotions, ["product_id", "store_id", "week"])


@query("distinct_counts", """
SELECT (SELECT count(DISTINCT basket_id) FROM transactions) AS distinct_baskets,
       (SELECT count(DISTINCT household_id) FROM transactions) AS distinct_households,
       (SELECT count(DISTINCT campaign_id) FROM coupon_redemptions) AS distinct_campaigns,
       (SELECT count(DISTINCT coupon_upc) FROM coupon_redemptions) AS distinct_coupons""")
def q_e10(spark, d):
    wh = _wh(spark, d)
    a = E.distinct_counts(wh.src.transactions, ["basket_id", "household_id"])
    b = E.distinct_counts(wh.src.coupon_redemptions, ["campaign_id", "coupon_upc"])
    return a.select(F.col("distinct_basket_id").alias("distinct_baskets"),
                    F.col("distinct_household_id").alias("distinct_households"),
                    b.select("distinct_campaign_id").scalar().alias("distinct_campaigns"),
                    b.select("distinct_coupon_upc").scalar().alias("distinct_coupons"))


@query("status_distribution", """
SELECT scope_status, count(*) AS products, count(*) FILTER (WHERE source_lookup_missing_flag) AS missing_lookup_products
FROM dim_product GROUP BY 1""")
def q_e11(spark, d):
    return _wh(spark, d).dim_product.groupBy("scope_status").agg(
        F.count(F.lit(1)).alias("products"),
        F.count_if("source_lookup_missing_flag").alias("missing_lookup_products"))


@query("scope_totals", """
SELECT s.scope_status, count(*) AS transaction_rows, CAST(sum(t.sales_value) AS DECIMAL(38,2)) AS sales_value
FROM transactions t JOIN product_scope s USING (product_id) GROUP BY 1""")
def q_e12(spark, d):
    wh = _wh(spark, d)
    j = wh.src.transactions.join(wh.product_scope.select("product_id", "scope_status"), "product_id")
    return j.groupBy("scope_status").agg(F.count(F.lit(1)).alias("transaction_rows"),
                                         F.sum("sales_value").cast("decimal(38,2)").alias("sales_value"))


SOURCE_FRAMES = ["transactions_raw", "promotions", "products", "demographics", "campaigns", "campaign_descriptions",
                 "coupons", "coupon_redemptions_raw"]


@query("full_row_duplicates", "\nUNION ALL ".join(f"""
SELECT '{t}' AS table_name, count(*) AS distinct_rows, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS excess_rows,
       count(*) FILTER (WHERE n > 1) AS duplicated_groups
FROM (SELECT r, count(*) AS n FROM (SELECT t AS r FROM {t} t) x GROUP BY r) y""" for t in SOURCE_FRAMES))
def q_e13(spark, d):
    wh = _wh(spark, d)
    return S.union_all([E.full_row_duplicates(wh.src.source(t)).select(F.lit(t).alias("table_name"), "*")
                        for t in SOURCE_FRAMES])


# --- F set operations --------------------------------------------------------------------------
@query("id_hub_union", """
SELECT product_id FROM products UNION SELECT product_id FROM transactions
UNION SELECT product_id FROM promotions UNION SELECT product_id FROM coupons""")
def q_f1(spark, d):
    s = _wh(spark, d).src
    return S.id_hub([s.products, s.transactions, s.promotions, s.coupons], "product_id")


@query("bounds_union_all", """
SELECT min(local_date) AS lo, max(local_date) AS hi FROM tx_local
UNION ALL SELECT min(start_date), max(end_date) FROM campaign_descriptions
UNION ALL SELECT min(redemption_date), max(redemption_date) FROM coupon_redemptions""")
def q_f2(spark, d):
    s = _wh(spark, d).src
    ld = local_date("transaction_timestamp")
    return S.union_all([
        s.transactions.agg(F.min(ld).alias("lo"), F.max(ld).alias("hi")),
        s.campaign_descriptions.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi")),
        s.coupon_redemptions.agg(F.min("redemption_date").alias("lo"), F.max("redemption_date").alias("hi"))])


@query("two_way_difference", """
(SELECT household_id, 'only_in_a' AS side FROM (SELECT household_id FROM transactions EXCEPT SELECT household_id FROM demographics))
UNION ALL
(SELECT household_id, 'only_in_b' FROM (SELECT household_id FROM demographics EXCEPT SELECT household_id FROM transactions))""")
def q_f3(spark, d):
    s = _wh(spark, d).src
    return S.two_way_difference(s.transactions.select("household_id"), s.demographics.select("household_id"))


@query("two_way_multiset_difference", """
(SELECT campaign_id, household_id, 'only_in_a' AS side FROM
   (SELECT campaign_id, household_id FROM campaigns EXCEPT ALL SELECT campaign_id, household_id FROM campaign_pairs))
UNION ALL
(SELECT campaign_id, household_id, 'only_in_b' FROM
   (SELECT campaign_id, household_id FROM campaign_pairs EXCEPT ALL SELECT campaign_id, household_id FROM campaigns))""")
def q_f4(spark, d):
    s = _wh(spark, d).src
    return S.two_way_multiset_difference(s.campaigns, s.campaigns.distinct())


@query("coverage_diff", """
SELECT (SELECT count(*) FROM (SELECT product_id FROM products UNION SELECT product_id FROM transactions) i
        WHERE product_id NOT IN (SELECT product_id FROM product_scope)) AS missing_ids,
       (SELECT count(*) FROM (SELECT DISTINCT product_id FROM product_scope) s
        WHERE product_id NOT IN (SELECT product_id FROM products UNION SELECT product_id FROM transactions)) AS extra_ids""")
def q_f5(spark, d):
    wh = _wh(spark, d)
    ids = S.id_hub([wh.src.products, wh.src.transactions], "product_id")
    return S.coverage_diff(ids, wh.product_scope, "product_id")


@query("week_set_diff", """
(SELECT week, 'transactions_only' AS side FROM (SELECT week FROM transactions EXCEPT SELECT week FROM promotions))
UNION ALL
(SELECT week, 'promotions_only' FROM (SELECT week FROM promotions EXCEPT SELECT week FROM transactions))""")
def q_f6(spark, d):
    s = _wh(spark, d).src
    t, p = s.transactions.select("week"), s.promotions.select("week")
    return (S.set_diff(t, p).withColumn("side", F.lit("transactions_only"))
            .unionByName(S.set_diff(p, t).withColumn("side", F.lit("promotions_only"))))


@query("missing_calendar_days", """
SELECT d AS local_date FROM (SELECT CAST(unnest(generate_series(DATE '2017-01-01', DATE '2017-12-31', INTERVAL 1 DAY)) AS DATE) AS d) c
WHERE d NOT IN (SELECT local_date FROM sales_in_scope WHERE local_date IS NOT NULL)""")
def q_f7(spark, d):
    s = _wh(spark, d).sales_in_scope
    return S.missing_days(s, "local_date", F.lit(C.COVERAGE_START), F.lit(C.COVERAGE_END))


# --- G keys, samples, latest, top-k ---------------------------------------------------------------
@query("assign_surrogate_keys", """
SELECT basket_id, row_number() OVER (ORDER BY basket_id) AS basket_key FROM (SELECT DISTINCT basket_id FROM transactions) b""")
def q_g1(spark, d):
    b = _wh(spark, d).src.transactions.select("basket_id").distinct()
    return G.assign_keys(b, "basket_id", "basket_key")


@query("issue_samples", """
SELECT basket_id, product_id, quantity FROM sales_in_scope WHERE quantity > 45 ORDER BY basket_id, product_id LIMIT 5""")
def q_g2(spark, d):
    s = _wh(spark, d).sales_in_scope.where(F.col("quantity") > C.HIGH_QUANTITY)
    return G.sample_issues(s.select("basket_id", "product_id", "quantity"), 5, ["basket_id", "product_id"])


@query("latest_by_key", """
SELECT household_id, basket_id, product_id, strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY household_id ORDER BY transaction_timestamp DESC, basket_id DESC, product_id DESC) AS rn
      FROM transactions) t WHERE rn = 1""")
def q_g3(spark, d):
    t = _wh(spark, d).src.transactions.select("household_id", "basket_id", "product_id", "transaction_timestamp")
    latest = G.latest_by(t, "household_id", [F.col("transaction_timestamp"), F.col("basket_id"), F.col("product_id")])
    return latest.withColumn("transaction_timestamp", F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm:ss"))


@query("topk_quantity", """
(SELECT 'largest_quantity' AS list, basket_id, product_id, quantity FROM transactions
   ORDER BY quantity DESC, basket_id, product_id LIMIT 10)
UNION ALL
(SELECT 'coupon_match', basket_id, product_id, quantity FROM transactions WHERE coupon_match_disc > 0
   ORDER BY basket_id, product_id LIMIT 10)
UNION ALL
(SELECT 'coupon_above_sales', basket_id, product_id, quantity FROM transactions WHERE coupon_disc > sales_value
   ORDER BY basket_id, product_id LIMIT 10)""")
def q_g4(spark, d):
    t = _wh(spark, d).src.transactions.select("basket_id", "product_id", "quantity", "coupon_match_disc",
                                             "coupon_disc", "sales_value")
    cols = ["basket_id", "product_id", "quantity"]
    a = G.top_k(t, [F.col("quantity").desc(), "basket_id", "product_id"], 10).select(
        F.lit("largest_quantity").alias("list"), *cols)
    b = G.top_k(t.where(F.col("coupon_match_disc") > 0), ["basket_id", "product_id"], 10).select(
        F.lit("coupon_match").alias("list"), *cols)
    c = G.top_k(t.where(F.col("coupon_disc") > F.col("sales_value")), ["basket_id", "product_id"], 10).select(
        F.lit("coupon_above_sales").alias("list"), *cols)
    return S.union_all([a, b, c])


@query("priority_pick", """
SELECT product_id, store_id, week, support_status FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id, store_id ORDER BY
     CASE support_status WHEN 'DISPLAY_MAILER' THEN 0 WHEN 'DISPLAY_ONLY' THEN 1 WHEN 'MAILER_ONLY' THEN 2 ELSE 3 END,
     week DESC) AS rn
  FROM (SELECT DISTINCT product_id, store_id, week, support_status FROM sales_status) x) y WHERE rn = 1""")
def q_g5(spark, d):
    from ..plans import kpi as K
    wh = _wh(spark, d)
    st = K.support_status(wh.sales_in_scope, wh.promotion_grouped).select(
        "product_id", "store_id", "week", "support_status").distinct()
    return G.pick_by_priority(st, ["product_id", "store_id"], "support_status",
                              ["DISPLAY_MAILER", "DISPLAY_ONLY", "MAILER_ONLY"], "week")

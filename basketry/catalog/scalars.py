"""Registered queries: scalar helpers applied to whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from .. import config as C
from ..functions import scalars as B
from ..plans.warehouse import warehouse
from ..registry import query


def _wh(spark, d):
    return warehouse(spark, d)


def _raw(spark, d):
    return _wh(spark, d).src.transactions_raw


@query("normalize_attributes", "SELECT * FROM q_products")
def q_b1(spark, d):
    return _wh(spark, d).q("products")


_BLANK_SQL = "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE "
    + " OR ".join(f"({k} IS NULL OR trim({k}, ' ') = '')" for k in keys)
    + f") AS blank_key_rows FROM {('transactions_raw' if t == 'transactions' else t)}"
    for t, keys in C.REQUIRED_KEYS.items())


@query("blank_keys", _BLANK_SQL)
def q_b2(spark, d):
    wh = _wh(spark, d)
    parts = []
    for t, keys in C.REQUIRED_KEYS.items():
        df = wh.src.source("transactions_raw" if t == "transactions" else t)
        parts.append(df.agg(F.count_if(B.any_blank(keys)).alias("blank_key_rows"))
                     .select(F.lit(t).alias("table_name"), "blank_key_rows"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _per_measure(spark, d, cols, fn, name):
    wide = _raw(spark, d).agg(*[F.count_if(fn(c)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (measure, {name})")


def _per_measure_sql(cols, cond, name):
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS measure, count(*) FILTER (WHERE {cond.format(c=c)}) AS {name} FROM transactions_raw"
        for c in cols)


@query("invalid_measures", _per_measure_sql(
    C.MEASURES, "{c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) OR {c} < 0", "invalid_rows"))
def q_b3(spark, d):
    return _per_measure(spark, d, C.MEASURES, B.is_invalid_measure, "invalid_rows")


_D = "(CAST({c} AS DECIMAL(38,18)) * 100)"


@query("cent_violation", _per_measure_sql(
    C.MONEY, f"abs({_D} - round({_D})) >= 0.000001 OR abs(stored_{{c}} * 100 - round(stored_{{c}} * 100)) >= 0.000001", "off_cent_rows"))
def q_b4(spark, d):
    return _per_measure(spark, d, C.MONEY, lambda c: B.off_cent(c) | B.stored_off_cent(f"stored_{c}"), "off_cent_rows")


@query("money_normalize", """
SELECT basket_id, product_id, """ + ", ".join(
    f"CAST(CASE WHEN abs({_D.format(c=m)} - round({_D.format(c=m)})) < 0.000001 THEN round({m}, 2) ELSE {m} END "
    f"AS DECIMAL(18,2)) AS {m}" for m in C.MONEY) + " FROM transactions_raw")
def q_b5(spark, d):
    return _raw(spark, d).select("basket_id", "product_id",
                                 *[B.money(B.to_cents(m)).alias(m) for m in C.MONEY])


@query("tiny_difference", _per_measure_sql(
    C.MONEY, f"(abs({_D} - round({_D})) < 0.000001 AND {{c}} <> round({{c}}, 2)) OR "
             "(abs(stored_{c} * 100 - round(stored_{c} * 100)) < 0.000001 AND stored_{c} * 100 <> round(stored_{c} * 100))", "tiny_rows"))
def q_b6(spark, d):
    """Money that the source stored as binary numbers beside whole cents."""
    return _per_measure(spark, d, C.MONEY, lambda c: B.tiny_off_cent(c) | B.stored_tiny_off_cent(f"stored_{c}"), "tiny_rows")


@query("local_date", """
SELECT basket_id, product_id, local_date, CAST(transaction_timestamp AS DATE) AS utc_date FROM tx_local""")
def q_b7(spark, d):
    t = _wh(spark, d).src.transactions
    return t.select("basket_id", "product_id", B.local_date("transaction_timestamp").alias("local_date"),
                    F.to_date("transaction_timestamp").alias("utc_date"))


@query("date_key_parts", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month_number,
       CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS calendar_year,
       CAST(isodow(d) AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT local_date AS d FROM tx_local) x""")
def q_b8(spark, d):
    t = _wh(spark, d).src.transactions
    return t.select(B.local_date("transaction_timestamp").alias("d")).distinct().select(*B.date_parts("d"))


@query("week_numbering", """
SELECT d AS local_date, CAST(date_diff('day', DATE '2016-12-26', d) // 7 + 1 AS INTEGER) AS source_week,
       CAST(weekofyear(d) AS INTEGER) AS iso_week,
       CAST(strftime(d, '%W') AS INTEGER) + 1 AS monday_week_plus_one,
       CAST(strftime(d, '%U') AS INTEGER) + 1 AS sunday_week_plus_one
FROM (SELECT DISTINCT local_date AS d FROM tx_local) x""")
def q_b9(spark, d):
    t = _wh(spark, d).src.transactions
    x = t.select(B.local_date("transaction_timestamp").alias("local_date")).distinct()
    return x.select("local_date",
                    (F.floor(F.datediff("local_date", F.lit(C.CALENDAR_FIRST_MONDAY)) / 7) + 1).cast("int")
                    .alias("source_week"),
                    B.iso_week("local_date").alias("iso_week"),
                    B.week_monday_plus_one("local_date").alias("monday_week_plus_one"),
                    B.week_sunday_plus_one("local_date").alias("sunday_week_plus_one"))


@query("sales_quality_flags", """
SELECT count(*) FILTER (WHERE quantity = 0) AS quantity_zero_flag,
       count(*) FILTER (WHERE quantity = 0 AND sales_value > 0) AS quantity_zero_sales_positive_flag,
       count(*) FILTER (WHERE quantity > 0 AND sales_value = 0) AS positive_quantity_zero_sales_flag,
       count(*) FILTER (WHERE coupon_disc > sales_value) AS coupon_above_sales_flag,
       count(*) FILTER (WHERE coupon_match_disc > coupon_disc) AS coupon_match_above_coupon_flag,
       count(*) FILTER (WHERE quantity > 45) AS high_quantity_flag
FROM transactions""")
def q_b10(spark, d):
    t = _wh(spark, d).src.transactions.select(*B.sales_flags(C.HIGH_QUANTITY))
    return t.agg(*[F.count_if(c).alias(c) for c in B.sales_flag_names()])


@query("multiple_source_rows_flag", """
SELECT multiple_source_rows_flag, count(*) AS groups FROM
  (SELECT count(*) > 1 AS multiple_source_rows_flag FROM promotions GROUP BY product_id, store_id, week) g
GROUP BY 1""")
def q_b11(spark, d):
    g = _wh(spark, d).src.promotions.groupBy("product_id", "store_id", "week").count()
    return g.groupBy(B.multi_row("count").alias("multiple_source_rows_flag")).agg(
        F.count(F.lit(1)).alias("groups"))


@query("coverage_clip", """
SELECT source_week, coverage_start_date, coverage_end_date, is_partial_coverage FROM dim_week
WHERE source_week IN (SELECT week FROM transactions)""")
def q_b12(spark, d):
    """The weeks that transactions name, clipped to the covered year."""
    weeks = _wh(spark, d).src.transactions.select("week").distinct().where(F.col("week").isNotNull())
    start = F.date_add(F.lit(C.CALENDAR_FIRST_MONDAY), (F.col("week") - 1) * 7)
    lo, hi, partial = B.clip_range(start, F.date_add(start, 6), C.COVERAGE_START, C.COVERAGE_END)
    return weeks.select(F.col("week").alias("source_week"), lo.alias("coverage_start_date"), hi.alias("coverage_end_date"),
                        partial.alias("is_partial_coverage"))


@query("null_safe_row_diff", """
SELECT p.product_id FROM products p JOIN q_products q USING (product_id)
WHERE (p.manufacturer_id, p.department, p.brand, p.product_category, p.product_type, p.package_size)
   IS DISTINCT FROM (q.manufacturer_id, q.department, q.brand, q.product_category, q.product_type, q.package_size)""")
def q_b13(spark, d):
    wh = _wh(spark, d)
    attrs = C.DESCRIPTIONS["products"]
    p = wh.src.products.select("product_id", *[F.col(a).alias(f"p_{a}") for a in attrs])
    q = wh.q("products").select("product_id", *[F.col(a).alias(f"q_{a}") for a in attrs])
    return p.join(q, "product_id").where(
        B.rows_differ([f"p_{a}" for a in attrs], [f"q_{a}" for a in attrs])).select("product_id")


@query("fractional_quantity", "SELECT count(*) FILTER (WHERE quantity <> floor(quantity)) AS fractional_rows FROM transactions_raw")
def q_b14(spark, d):
    return _raw(spark, d).agg(F.count_if(B.is_fractional("quantity")).alias("fractional_rows"))


@query("safe_ratio", """
SELECT product_id, CAST(sum(sales_value) AS DOUBLE) / NULLIF(CAST(sum(quantity) AS DOUBLE), 0) AS sales_per_unit
FROM transactions GROUP BY product_id""")
def q_b15(spark, d):
    g = _wh(spark, d).src.transactions.groupBy("product_id").agg(F.sum("sales_value").alias("s"),
                                                                 F.sum("quantity").alias("q"))
    return g.select("product_id", B.ratio6("s", "q").alias("sales_per_unit"))


@query("code_membership", """
SELECT display_location, mailer_location,
       coalesce(display_location IN ('1','2','3','4','5','6','7','9'), false) AS display_support,
       display_location IS NULL OR display_location NOT IN ('0','A','1','2','3','4','5','6','7','9') AS display_unknown,
       coalesce(mailer_location IN ('A','C','D','F','H','J','L','P','X','Z'), false) AS mailer_support,
       mailer_location IS NULL OR mailer_location NOT IN ('0','A','C','D','F','H','J','L','P','X','Z') AS mailer_unknown,
       count(*) AS rows
FROM promotions GROUP BY ALL""")
def q_b16(spark, d):
    p = _wh(spark, d).src.promotions
    return p.groupBy(
        "display_location", "mailer_location",
        B.in_codes("display_location", C.DISPLAY_SUPPORT).alias("display_support"),
        B.unknown_code("display_location", C.DISPLAY_KNOWN).alias("display_unknown"),
        B.in_codes("mailer_location", C.MAILER_SUPPORT).alias("mailer_support"),
        B.unknown_code("mailer_location", C.MAILER_KNOWN).alias("mailer_unknown"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@query("label_normalize", "SELECT product_id, n_dept AS department_label, n_cat AS category_label, n_type AS type_label FROM products_norm")
def q_b17(spark, d):
    p = _wh(spark, d).src.products
    return p.select("product_id", B.label_norm("department").alias("department_label"),
                    B.label_norm("product_category").alias("category_label"),
                    B.label_norm("product_type").alias("type_label"))


_SAMPLE_SQL = """'{"basket_id":' || to_json(basket_id) || ',"product_id":' || to_json(product_id) || ',"quantity":' || quantity || ',"sales_value":' || sales_value
  || ',"retail_disc":' || retail_disc || ',"coupon_disc":' || coupon_disc || ',"coupon_match_disc":' || coupon_match_disc || '}'"""


# Audit details; the samples are a JSON text in a JSON text
@query("audit_details_json", f"""
SELECT '{{"action":"Keep and flag; scope: IN_SCOPE.","count_unit":"rows_returned_by_rule","samples":' || CAST(to_json('[' || string_agg(j, ',' ORDER BY n) || ']') AS VARCHAR) || '}}' AS details
FROM (SELECT {_SAMPLE_SQL} AS j, row_number() OVER (ORDER BY basket_id, product_id, quantity, sales_value, retail_disc, coupon_disc, coupon_match_disc) AS n
      FROM transactions_raw WHERE quantity > {C.HIGH_QUANTITY} AND product_id IN (SELECT product_id FROM in_scope_ids) QUALIFY n <= 5) x""")
def q_b18(spark, d):
    from .quality import quality
    qa = quality(spark, d)
    issues = qa.issues("fmcg_high_quantity")
    samples = issues.orderBy(*issues.columns).limit(5)
    listed = F.transform(F.array_sort(F.collect_list(F.struct(*issues.columns))), lambda x: x)
    return samples.agg(F.to_json(listed).alias("samples")).select(
        B.details_json(action=F.lit("Keep and flag; scope: IN_SCOPE."),
                       count_unit=F.lit("rows_returned_by_rule"),
                       samples=F.col("samples")).alias("details"))


@query("rule_code_filter", """
SELECT rule_code FROM (SELECT 'DQ_V1_' || code AS rule_code FROM (VALUES """ + ", ".join(
    "('" + c + "')" for c in [r for r in __import__("basketry.plans.quality", fromlist=["RULES"]).RULES_BY_CODE]) + """) v(code))
WHERE left(rule_code, 6) = 'DQ_V1_' AND right(rule_code, 8) = '_missing'""")
def q_b19(spark, d):
    from .quality import quality
    r = quality(spark, d).report()
    return r.where(B.code_like("rule_code", prefix=C.DQ_PREFIX, suffix="_missing")).select("rule_code")


@query("cents_integer", "SELECT store_id, CAST(sum(round(sales_value * 100)) AS BIGINT) AS sales_cents FROM transactions GROUP BY store_id")
def q_b20(spark, d):
    return _wh(spark, d).src.transactions.groupBy("store_id").agg(
        F.sum(B.cents_long("sales_value")).alias("sales_cents"))


@query("calendar_date_series", """
SELECT CAST(unnest(generate_series(min(local_date), max(local_date), INTERVAL 1 DAY)) AS DATE) AS full_date FROM tx_local""")
def q_b21(spark, d):
    t = _wh(spark, d).src.transactions.select(B.local_date("transaction_timestamp").alias("d"))
    b = t.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return b.select(B.date_series("lo", "hi").alias("full_date"))


@query("discount_any", """
SELECT CASE WHEN retail_disc > 0 OR coupon_disc > 0 OR coupon_match_disc > 0 THEN 1 ELSE 0 END AS discount_any,
       count(*) AS lines FROM sales_in_scope GROUP BY 1""")
def q_b22(spark, d):
    return _wh(spark, d).sales_in_scope.groupBy(B.discount_any().alias("discount_any")).agg(
        F.count(F.lit(1)).alias("lines"))


@query("optional_quality_flags", """
SELECT t.basket_id, t.product_id, t.sales_value = 0 AS sales_zero_flag,
       p.product_id IS NULL AS product_lookup_missing_flag,
       p.product_id IS NOT NULL AND p.product_category IS NULL AS product_category_missing_flag,
       p.product_id IS NOT NULL AND p.product_type IS NULL AS product_type_missing_flag,
       p.product_id IS NOT NULL AND p.package_size IS NULL AS package_size_missing_flag,
       d.household_id IS NULL AS demographics_missing_flag,
       CASE WHEN g.product_id IS NULL THEN 'NO_MATCH' WHEN g.unknown THEN 'MATCHED_UNCLASSIFIED' ELSE 'MATCHED' END AS promotion_match_status
FROM transactions t
LEFT JOIN q_products p USING (product_id)
LEFT JOIN (SELECT DISTINCT household_id FROM q_demographics) d USING (household_id)
LEFT JOIN (SELECT product_id, store_id, week, bool_or(display_location IS NULL OR display_location NOT IN ('0','A','1','2','3','4','5','6','7','9')
              OR mailer_location IS NULL OR mailer_location NOT IN ('0','A','C','D','F','H','J','L','P','X','Z')) AS unknown
           FROM promotions GROUP BY 1, 2, 3) g
  ON g.product_id = t.product_id AND g.store_id = t.store_id AND g.week = t.week""")
def q_b23(spark, d):
    wh = _wh(spark, d)
    t = wh.src.transactions
    p = wh.q("products").select("product_id", "product_category", "product_type", "package_size",
                                F.lit(True).alias("_p"))
    demo = wh.q("demographics").select("household_id").distinct().withColumn("_d", F.lit(True))
    unk = (B.unknown_code("display_location", C.DISPLAY_KNOWN) | B.unknown_code("mailer_location", C.MAILER_KNOWN))
    g = wh.src.promotions.groupBy("product_id", "store_id", "week").agg(
        F.bool_or(unk).alias("_unknown")).withColumn("_g", F.lit(True))
    j = (t.join(p, "product_id", "left").join(demo, "household_id", "left")
         .join(g, ["product_id", "store_id", "week"], "left"))
    hit = F.col("_p").isNotNull()
    return j.select(
        "basket_id", "product_id", (F.col("sales_value") == 0).alias("sales_zero_flag"),
        (~hit).alias("product_lookup_missing_flag"),
        (hit & F.col("product_category").isNull()).alias("product_category_missing_flag"),
        (hit & F.col("product_type").isNull()).alias("product_type_missing_flag"),
        (hit & F.col("package_size").isNull()).alias("package_size_missing_flag"),
        F.col("_d").isNull().alias("demographics_missing_flag"),
        F.when(F.col("_g").isNull(), "NO_MATCH").when(F.col("_unknown"), "MATCHED_UNCLASSIFIED")
         .otherwise("MATCHED").alias("promotion_match_status"))

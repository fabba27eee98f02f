"""DuckDB versions of the fixture mapping and of shared warehouse derivations.

Every oracle query is ``WITH <all CTEs> <body>``; DuckDB drops the CTEs a body
does not reference.  Written independently of the Spark code, from the mapping
"""

from __future__ import annotations

CTES: list[tuple[str, str]] = []


def cte(name: str, sql: str) -> None:
    CTES.append((name, sql.strip()))


cte("li", """
SELECT l.*, date_diff('day', DATE '1995-01-02', CAST(l.l_shipdate AS DATE)) % 365 AS d365
FROM lineitem l
""")

cte("transactions_raw", """
SELECT household_id, store_id, basket_id, product_id, quantity, sales_value, retail_disc,
       coupon_disc, coupon_match_disc, transaction_timestamp,
       CAST(date_diff('day', DATE '2016-12-26',
            CAST(timezone('America/New_York', timezone('UTC', transaction_timestamp)) AS DATE)) // 7 + 1 AS INTEGER) AS week,
       stored_sales_value, stored_retail_disc, stored_coupon_disc, stored_coupon_match_disc
FROM (
  SELECT CAST(o.o_custkey AS VARCHAR) AS household_id,
         CAST(l.l_suppkey % 10 AS VARCHAR) AS store_id,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS basket_id,
         CAST(l.l_partkey AS VARCHAR) AS product_id,
         CAST(l.l_quantity - 1 AS DECIMAL(18,3)) AS quantity,
         CAST(CASE WHEN l.l_discount = 0.1 THEN 0.0 ELSE l.l_extendedprice END AS DECIMAL(18,2)) AS sales_value,
         CAST(l.l_discount AS DECIMAL(18,2)) AS retail_disc,
         CAST(l.l_tax AS DECIMAL(18,2)) AS coupon_disc,
         CAST(CASE WHEN l.l_returnflag = 'R' THEN l.l_discount ELSE 0.0 END AS DECIMAL(18,2)) AS coupon_match_disc,
         CASE WHEN l.l_discount = 0.1 THEN 0.0 ELSE l.l_extendedprice END::DOUBLE AS stored_sales_value, l.l_discount AS stored_retail_disc,
         l.l_tax AS stored_coupon_disc, CASE WHEN l.l_returnflag = 'R' THEN l.l_discount ELSE 0.0 END::DOUBLE AS stored_coupon_match_disc,
         TIMESTAMP '2017-01-01 05:00:00' + to_days(CAST(l.d365 AS INTEGER))
             + to_hours(CAST(3 * l.l_linenumber + 1 AS INTEGER)) AS transaction_timestamp
  FROM li l JOIN orders o ON l.l_orderkey = o.o_orderkey
) x
""")

cte("transactions", """
SELECT household_id, store_id, basket_id, product_id,
       CAST(SUM(quantity) AS DECIMAL(18,3)) AS quantity,
       CAST(SUM(sales_value) AS DECIMAL(18,2)) AS sales_value,
       CAST(SUM(retail_disc) AS DECIMAL(18,2)) AS retail_disc,
       CAST(SUM(coupon_disc) AS DECIMAL(18,2)) AS coupon_disc,
       CAST(SUM(coupon_match_disc) AS DECIMAL(18,2)) AS coupon_match_disc,
       MIN(transaction_timestamp) AS transaction_timestamp,
       CAST(date_diff('day', DATE '2016-12-26',
            CAST(timezone('America/New_York', timezone('UTC', MIN(transaction_timestamp))) AS DATE)) // 7 + 1 AS INTEGER) AS week
FROM transactions_raw
GROUP BY household_id, store_id, basket_id, product_id
""")

cte("tx_local", """
SELECT t.*, CAST(timezone('America/New_York', timezone('UTC', t.transaction_timestamp)) AS DATE) AS local_date
FROM transactions t
""")

cte("promotions", """
SELECT CAST(l_partkey AS VARCHAR) AS product_id,
       CAST(l_suppkey % 10 AS VARCHAR) AS store_id,
       CASE l_linenumber WHEN 1 THEN '0' WHEN 2 THEN 'A' WHEN 6 THEN NULL WHEN 7 THEN '8'
            ELSE CAST(l_linenumber AS VARCHAR) END AS display_location,
       CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'N' THEN '0'
            WHEN l_linenumber = 5 THEN 'R' ELSE 'D' END AS mailer_location,
       CAST((d365 + 6) // 7 + 1 AS INTEGER) AS week
FROM li WHERE l_linestatus = 'F'
""")

cte("products", """
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
       regexp_replace(p_brand, '[^0-9]', '', 'g') AS manufacturer_id,
       p_type AS department, p_brand AS brand,
       CASE WHEN p_size = 50 THEN NULL ELSE split_part(p_name, ' ', 2) END AS product_category,
       CASE WHEN p_size = 49 THEN '' ELSE p_name END AS product_type,
       CASE WHEN p_size % 3 = 0 THEN ' ' ELSE CAST(p_size AS VARCHAR) END AS package_size
FROM part WHERE p_partkey % 97 <> 5
""")

cte("demographics", """
SELECT CAST(c_custkey AS VARCHAR) AS household_id, c_mktsegment AS age,
       CASE WHEN c_acctbal < 0 THEN 'NEGATIVE' WHEN c_acctbal = 0 THEN 'ZERO' ELSE 'POSITIVE' END AS income,
       CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN 'Homeowner' ELSE 'Renter' END AS home_ownership,
       CASE WHEN c_custkey % 7 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN 'Married' ELSE 'Single' END AS marital_status,
       CAST(c_custkey % 5 AS VARCHAR) AS household_size,
       CAST(c_nationkey AS VARCHAR) AS household_comp,
       CAST(c_custkey % 4 AS VARCHAR) AS kids_count
FROM customer WHERE c_custkey % 3 = 0
""")

cte("ev", """
SELECT user_id, event_type, ts, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")

cte("campaign_descriptions", """
SELECT CAST(i AS VARCHAR) AS campaign_id,
       CASE WHEN i <= 2 THEN 'TypeA' WHEN i <= 6 THEN 'TypeB' ELSE 'TypeC' END AS campaign_type,
       DATE '2016-11-14' + CAST(40 * i AS INTEGER) AS start_date,
       DATE '2016-11-14' + CAST(40 * i + 120 AS INTEGER) AS end_date
FROM (SELECT DISTINCT k % 10 AS i FROM ev WHERE k IS NOT NULL) r
""")

cte("campaigns", """
SELECT CAST(k % 10 AS VARCHAR) AS campaign_id, CAST(user_id AS VARCHAR) AS household_id
FROM ev WHERE event_type IN ('view', 'click')
""")

cte("coupons", """
SELECT CAST(p_partkey % 100 AS VARCHAR) AS coupon_upc, CAST(p_partkey AS VARCHAR) AS product_id,
       CAST(p_partkey % 10 AS VARCHAR) AS campaign_id
FROM (SELECT p_partkey FROM part UNION ALL SELECT p_partkey FROM part WHERE p_partkey % 20 = 0) p
""")

cte("coupon_redemptions_raw", """
SELECT CAST(user_id AS VARCHAR) AS household_id, CAST(k AS VARCHAR) AS coupon_upc,
       CAST(k % 10 AS VARCHAR) AS campaign_id,
       DATE '2017-01-01' + CAST(12 * (dayofyear(ts) - 1) AS INTEGER) AS redemption_date
FROM ev WHERE event_type = 'purchase'
""")

cte("coupon_redemptions", "SELECT DISTINCT * FROM coupon_redemptions_raw")

# --- scope classification (rules: FIXTURES.md §3) ---------------------------
cte("products_norm", """
SELECT p.*,
       upper(trim(regexp_replace(department, '^\\s+|\\s+$', '', 'g'))) AS n_dept,
       upper(regexp_replace(product_category, '^\\s+|\\s+$', '', 'g')) AS n_cat,
       upper(regexp_replace(product_type, '^\\s+|\\s+$', '', 'g')) AS n_type
FROM products p
""")

cte("scope_base", """
SELECT *,
  CASE
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') AND (n_dept IS NULL OR n_cat IS NULL OR n_type IS NULL
         OR n_dept = '' OR n_cat = '' OR n_type = '') THEN 'REVIEW'
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') AND n_cat IN ('RING') THEN 'REVIEW'
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') THEN 'IN_SCOPE'
    WHEN n_dept IN ('PROMO') THEN 'OUT_OF_SCOPE'
    ELSE 'REVIEW' END AS s0,
  CASE
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') AND (n_dept IS NULL OR n_cat IS NULL OR n_type IS NULL
         OR n_dept = '' OR n_cat = '' OR n_type = '') THEN 'Missing classification attribute'
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') AND n_cat IN ('RING') THEN 'Exact category requires scope review'
    WHEN n_dept IN ('STANDARD','MEDIUM','LARGE') THEN 'Eligible department with category and type'
    WHEN n_dept IN ('PROMO') THEN 'Department excluded by project scope v1'
    ELSE 'Mixed or unconfirmed department' END AS r0
FROM products_norm
""")

cte("product_scope_lookup", """
SELECT product_id, manufacturer_id, department, brand, product_category, product_type, package_size,
  CASE WHEN s0 = 'REVIEW' AND n_dept = 'ECONOMY' AND n_cat = 'WIDGET' AND n_type IN ('RED WIDGET','BLUE WIDGET') THEN 'IN_SCOPE'
       WHEN s0 = 'REVIEW' AND n_dept = 'SMALL' AND n_cat = 'BOLT' AND n_type IN ('RED BOLT','BLUE BOLT') THEN 'OUT_OF_SCOPE'
       ELSE s0 END AS scope_status,
  CASE WHEN s0 = 'REVIEW' AND n_dept = 'ECONOMY' AND n_cat = 'WIDGET' AND n_type IN ('RED WIDGET','BLUE WIDGET') THEN 'Reviewed category/type'
       WHEN s0 = 'REVIEW' AND n_dept = 'SMALL' AND n_cat = 'BOLT' AND n_type IN ('RED BOLT','BLUE BOLT') THEN 'Reviewed durable goods/accessories or services'
       ELSE r0 END AS scope_reason,
  'fixture-1' AS scope_rule_version
FROM scope_base
""")

cte("product_scope", """
SELECT * FROM product_scope_lookup
UNION ALL
SELECT DISTINCT t.product_id, NULL, NULL, NULL, NULL, NULL, NULL, 'REVIEW', 'Product missing from lookup', 'fixture-1'
FROM transactions t WHERE t.product_id NOT IN (SELECT product_id FROM products)
""")

cte("in_scope_ids", "SELECT product_id FROM product_scope WHERE scope_status = 'IN_SCOPE'")

# --- calendar ----------------------------------------------------------------
cte("dim_week", """
SELECT CAST(n AS BIGINT) AS week_key, 'CJ_2017' AS source_calendar_id, CAST(n AS INTEGER) AS source_week,
       ws AS week_start_date, ws + 6 AS week_end_date,
       greatest(ws, DATE '2017-01-01') AS coverage_start_date,
       least(ws + 6, DATE '2017-12-31') AS coverage_end_date,
       (date_diff('day', greatest(ws, DATE '2017-01-01'), least(ws + 6, DATE '2017-12-31')) + 1) < 7 AS is_partial_coverage
FROM (SELECT n, DATE '2016-12-26' + CAST(7 * (n - 1) AS INTEGER) AS ws FROM range(1, 54) r(n)) w
""")

cte("date_bounds_src", """
SELECT min(local_date) AS lo, max(local_date) AS hi FROM tx_local
UNION ALL SELECT min(start_date), max(end_date) FROM campaign_descriptions
UNION ALL SELECT min(redemption_date), max(redemption_date) FROM coupon_redemptions
UNION ALL SELECT min(week_start_date), max(week_end_date) FROM dim_week
""")

cte("dim_date", """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS full_date,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(month(d) AS INTEGER) AS month_number,
       CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS calendar_year,
       CAST(isodow(d) AS INTEGER) AS day_of_week
FROM (SELECT CAST(unnest(generate_series(min(lo), max(hi), INTERVAL 1 DAY)) AS DATE) AS d FROM date_bounds_src) s
""")

# --- warehouse derivations used by KPI / fact oracles ---------------------------
cte("sales_in_scope", """
SELECT basket_id, product_id, household_id, store_id, week, transaction_timestamp, quantity,
       sales_value, retail_disc, coupon_disc, coupon_match_disc, local_date
FROM tx_local WHERE product_id IN (SELECT product_id FROM in_scope_ids)
""")

cte("promo_weekly", """
SELECT product_id, store_id, week,
  CASE WHEN bool_or(coalesce(display_location IN ('1','2','3','4','5','6','7','9'), false)) THEN TRUE
       WHEN bool_or(display_location IS NULL OR display_location NOT IN ('0','A','1','2','3','4','5','6','7','9')) THEN NULL
       ELSE FALSE END AS has_display,
  CASE WHEN bool_or(coalesce(mailer_location IN ('A','C','D','F','H','J','L','P','X','Z'), false)) THEN TRUE
       WHEN bool_or(mailer_location IS NULL OR mailer_location NOT IN ('0','A','C','D','F','H','J','L','P','X','Z')) THEN NULL
       ELSE FALSE END AS has_mailer,
  list_sort(list_distinct(list(display_location))) AS display_location_codes,
  list_sort(list_distinct(list(mailer_location))) AS mailer_location_codes,
  count(*) AS source_row_count,
  bool_or(display_location IS NULL OR display_location NOT IN ('0','A','1','2','3','4','5','6','7','9')
          OR mailer_location IS NULL OR mailer_location NOT IN ('0','A','C','D','F','H','J','L','P','X','Z')) AS promotion_code_unknown_flag
FROM promotions WHERE product_id IN (SELECT product_id FROM in_scope_ids)
GROUP BY product_id, store_id, week
""")

cte("sales_status", """
SELECT s.*, p.product_id IS NOT NULL AS promotion_matched,
  CASE WHEN p.product_id IS NULL THEN 'UNKNOWN'
       WHEN p.promotion_code_unknown_flag OR p.has_display IS NULL OR p.has_mailer IS NULL THEN 'UNKNOWN'
       WHEN p.has_display AND p.has_mailer THEN 'DISPLAY_MAILER'
       WHEN p.has_display THEN 'DISPLAY_ONLY'
       WHEN p.has_mailer THEN 'MAILER_ONLY'
       ELSE 'NO_DISPLAY_MAILER' END AS support_status,
  CASE WHEN p.product_id IS NULL THEN 'NO_PROMOTION_MATCH'
       WHEN p.promotion_code_unknown_flag OR p.has_display IS NULL OR p.has_mailer IS NULL THEN 'UNCLASSIFIED_PROMOTION'
       END AS unknown_reason
FROM sales_in_scope s LEFT JOIN promo_weekly p
  ON s.product_id = p.product_id AND s.store_id = p.store_id AND s.week = p.week
""")

cte("weekly_grain", """
SELECT product_id, store_id, week, support_status, CAST(sum(sales_value) AS DECIMAL(38,2)) AS weekly_sales,
       CAST(sum(quantity) AS DECIMAL(38,3)) AS weekly_quantity, count(*) AS lines
FROM sales_status GROUP BY product_id, store_id, week, support_status
""")

cte("campaign_pairs", "SELECT DISTINCT campaign_id, household_id FROM campaigns")
cte("coupon_pairs", "SELECT DISTINCT campaign_id, coupon_upc FROM coupons")

cte("redemptions_checked", """
SELECT r.*, concat_ws('; ',
  CASE WHEN NOT EXISTS (SELECT 1 FROM campaign_pairs c WHERE c.campaign_id = r.campaign_id AND c.household_id = r.household_id)
       THEN 'household not in campaign' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM coupon_pairs c WHERE c.campaign_id = r.campaign_id AND c.coupon_upc = r.coupon_upc)
       THEN 'coupon not in campaign' END,
  CASE WHEN NOT EXISTS (SELECT 1 FROM campaign_descriptions d WHERE d.campaign_id = r.campaign_id
              AND r.redemption_date BETWEEN d.start_date AND d.end_date) THEN 'date outside campaign' END,
  CASE WHEN r.copy > 1 THEN 'repeated row' END) AS reject_reason
FROM (SELECT *, row_number() OVER (PARTITION BY household_id, coupon_upc, campaign_id, redemption_date) AS copy
      FROM coupon_redemptions_raw) r
""")

cte("valid_redemptions", """
SELECT household_id, coupon_upc, campaign_id, redemption_date FROM redemptions_checked WHERE reject_reason = ''
""")

# --- normalised sources (descriptive attributes: NULLIF(BTRIM(x, ' '), '')) -------
cte("q_products", """
SELECT product_id, nullif(trim(manufacturer_id, ' '), '') AS manufacturer_id,
       nullif(trim(department, ' '), '') AS department, nullif(trim(brand, ' '), '') AS brand,
       nullif(trim(product_category, ' '), '') AS product_category,
       nullif(trim(product_type, ' '), '') AS product_type, nullif(trim(package_size, ' '), '') AS package_size
FROM products
""")

cte("q_demographics", """
SELECT household_id, nullif(trim(age, ' '), '') AS age, nullif(trim(income, ' '), '') AS income,
       nullif(trim(home_ownership, ' '), '') AS home_ownership, nullif(trim(marital_status, ' '), '') AS marital_status,
       nullif(trim(household_size, ' '), '') AS household_size, nullif(trim(household_comp, ' '), '') AS household_comp,
       nullif(trim(kids_count, ' '), '') AS kids_count
FROM demographics
""")

cte("q_campaign_descriptions", """
SELECT campaign_id, nullif(trim(campaign_type, ' '), '') AS campaign_type, start_date, end_date FROM campaign_descriptions
""")

# --- dimensions with keys in business-key order ------------------------------------
cte("dim_product", """
SELECT row_number() OVER (ORDER BY i.product_id) AS product_key, i.product_id, p.manufacturer_id, p.department,
       p.brand, p.product_category, p.product_type, p.package_size,
       CASE WHEN p.product_id IS NULL THEN 'REVIEW' ELSE coalesce(s.scope_status, 'REVIEW') END AS scope_status,
       'fixture-1' AS scope_rule_version, p.product_id IS NULL AS source_lookup_missing_flag,
       CAST(1 AS BIGINT) AS etl_batch_id
FROM (SELECT product_id FROM products UNION SELECT product_id FROM transactions
      UNION SELECT product_id FROM promotions UNION SELECT product_id FROM coupons) i
LEFT JOIN (SELECT DISTINCT * FROM q_products) p ON p.product_id = i.product_id
LEFT JOIN product_scope s ON s.product_id = i.product_id
""")

cte("dim_household", """
SELECT row_number() OVER (ORDER BY i.household_id) AS household_key, i.household_id, d.age, d.income,
       d.home_ownership, d.marital_status, d.household_size, d.household_comp, d.kids_count,
       d.household_id IS NOT NULL AS demographics_available_flag, CAST(1 AS BIGINT) AS etl_batch_id
FROM (SELECT household_id FROM demographics UNION SELECT household_id FROM transactions
      UNION SELECT household_id FROM campaigns UNION SELECT household_id FROM coupon_redemptions) i
LEFT JOIN (SELECT DISTINCT * FROM q_demographics) d ON d.household_id = i.household_id
""")

cte("dim_store", """
SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, CAST(1 AS BIGINT) AS etl_batch_id
FROM (SELECT store_id FROM transactions UNION SELECT store_id FROM promotions) i
""")

cte("dim_campaign", """
SELECT row_number() OVER (ORDER BY campaign_id) AS campaign_key, campaign_id, campaign_type, start_date, end_date,
       CAST(1 AS BIGINT) AS etl_batch_id
FROM (SELECT DISTINCT * FROM q_campaign_descriptions) c
""")

cte("dim_coupon", """
SELECT row_number() OVER (ORDER BY p.campaign_id, p.coupon_upc) AS coupon_key, p.campaign_id, p.coupon_upc,
       c.campaign_key, CAST(1 AS BIGINT) AS etl_batch_id
FROM coupon_pairs p LEFT JOIN dim_campaign c USING (campaign_id)
""")

cte("fact_sales", """
SELECT s.basket_id, s.product_id, s.household_id, s.store_id, p.product_key, h.household_key, st.store_key,
       CAST(year(s.local_date) * 10000 + month(s.local_date) * 100 + day(s.local_date) AS INTEGER) AS date_key,
       w.week_key, s.transaction_timestamp, s.quantity, s.sales_value, s.retail_disc, s.coupon_disc, s.coupon_match_disc,
       s.quantity = 0 AS quantity_zero_flag,
       s.quantity = 0 AND s.sales_value > 0 AS quantity_zero_sales_positive_flag,
       s.quantity > 0 AND s.sales_value = 0 AS positive_quantity_zero_sales_flag,
       s.coupon_disc > s.sales_value AS coupon_above_sales_flag,
       s.coupon_match_disc > s.coupon_disc AS coupon_match_above_coupon_flag,
       s.quantity > 45 AS high_quantity_flag,
       'fixture-1' AS scope_rule_version, CAST(1 AS BIGINT) AS etl_batch_id
FROM sales_in_scope s
LEFT JOIN dim_week w ON w.source_week = s.week AND s.local_date BETWEEN w.coverage_start_date AND w.coverage_end_date
LEFT JOIN dim_product p ON p.product_id = s.product_id
LEFT JOIN dim_household h ON h.household_id = s.household_id
LEFT JOIN dim_store st ON st.store_id = s.store_id
""")

cte("fact_promotion_weekly", """
SELECT g.product_id, g.store_id, g.week, p.product_key, s.store_key, w.week_key, g.has_display, g.has_mailer,
       g.display_location_codes, g.mailer_location_codes, g.source_row_count,
       g.source_row_count > 1 AS multiple_source_rows_flag, g.promotion_code_unknown_flag,
       'fixture-1' AS scope_rule_version, CAST(1 AS BIGINT) AS etl_batch_id
FROM promo_weekly g
LEFT JOIN dim_week w ON w.source_week = g.week
LEFT JOIN dim_product p ON p.product_id = g.product_id
LEFT JOIN dim_store s ON s.store_id = g.store_id
""")

cte("fact_coupon_redemption", """
SELECT r.household_id, r.coupon_upc, r.campaign_id, r.redemption_date, h.household_key, c.coupon_key, c.campaign_key,
       CAST(year(r.redemption_date) * 10000 + month(r.redemption_date) * 100 + day(r.redemption_date) AS INTEGER) AS redemption_date_key,
       CAST(1 AS SMALLINT) AS redemption_record_count, CAST(1 AS BIGINT) AS etl_batch_id
FROM valid_redemptions r
LEFT JOIN dim_household h ON h.household_id = r.household_id
LEFT JOIN dim_coupon c ON c.campaign_id = r.campaign_id AND c.coupon_upc = r.coupon_upc
""")

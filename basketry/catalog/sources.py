"""Registered queries: source tables and staging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..plans.context import sources
from ..plans.warehouse import warehouse
from ..registry import query
from ..sources import staging as S

TS_FMT = "yyyy-MM-dd HH:mm:ss"
TS_SQL = "strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S')"

# --- the eight source tables (fixture mapping, whole tables) -----------------


@query("source_transactions_raw", f"""
SELECT household_id, store_id, basket_id, product_id, quantity, sales_value, retail_disc,
       coupon_disc, coupon_match_disc, {TS_SQL} AS transaction_timestamp, week
FROM transactions_raw""")
def q_src_tx_raw(spark, d):
    t = sources(spark, d).transactions_raw.select(*OVERVIEW_COLUMNS["transactions_raw"])
    return t.withColumn("transaction_timestamp", F.date_format("transaction_timestamp", TS_FMT))


@query("source_transactions", f"""
SELECT household_id, store_id, basket_id, product_id, quantity, sales_value, retail_disc,
       coupon_disc, coupon_match_disc, {TS_SQL} AS transaction_timestamp, week
FROM transactions""")
def q_src_tx(spark, d):
    t = sources(spark, d).transactions
    return t.withColumn("transaction_timestamp", F.date_format("transaction_timestamp", TS_FMT))


for _name in ["promotions", "products", "demographics", "campaigns", "campaign_descriptions",
              "coupons", "coupon_redemptions"]:
    query(f"source_{_name}", f"SELECT * FROM {_name}")(
        lambda spark, d, _n=_name: sources(spark, d).source(_n))


# --- A1 stage_read -------------------------------------------------------------
PART_SCHEMA = T.StructType([
    T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()), T.StructField("p_retailprice", T.DoubleType())])


@query("stage_read", "SELECT * FROM part")
def q_stage_read(spark, d):
    return S.stage_read(spark, f"{d}/part.parquet", PART_SCHEMA)


# --- A2 stage_cast ---------------------------------------------------------------
LINEITEM_SPEC = {"l_orderkey": "id", "l_partkey": "id", "l_suppkey": "id", "l_linenumber": "int",
                 "l_quantity": "decimal(18,3)", "l_extendedprice": "decimal(18,2)",
                 "l_discount": "decimal(18,2)", "l_tax": "decimal(18,2)", "l_shipdate": "date"}


@query("stage_cast", """
SELECT count(*) FILTER (WHERE NOT bad) AS good_rows, count(*) FILTER (WHERE bad) AS reject_rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE NOT bad) AS DECIMAL(38,2)) AS good_extendedprice
FROM (SELECT *, (l_orderkey IS NOT NULL AND l_orderkey <> floor(l_orderkey))
        OR (l_quantity IS NOT NULL AND (isnan(l_quantity) OR isinf(l_quantity)))
        OR (l_extendedprice IS NOT NULL AND (isnan(l_extendedprice) OR isinf(l_extendedprice)))
        OR (l_shipdate IS NOT NULL AND CAST(l_shipdate AS DATE) <> l_shipdate) AS bad FROM lineitem) x""")
def q_stage_cast(spark, d):
    good, rejects = S.stage_cast(sources(spark, d).table("lineitem"), LINEITEM_SPEC)
    g = good.agg(F.count(F.lit(1)).alias("good_rows"),
                 F.sum("l_extendedprice").cast("decimal(38,2)").alias("good_extendedprice"))
    r = rejects.select(F.count(F.lit(1))).scalar()
    return g.select("good_rows", r.alias("reject_rows"), "good_extendedprice")


# rows of the input that break a strict conversion: instants declared as dates, money of too few digits, fractions as integers
STRICT_SPECS = {
    "customer": {"c_custkey": "id", "c_acctbal": "decimal(5,2)"},
    "part": {"p_partkey": "id", "p_size": "int", "p_retailprice": "int"},
    "events": {"event_id": "id", "ts": "date", "value": "decimal(18,1)"},
}


def _strict_sql() -> str:
    rules = {
        "customer": ("c_custkey", ["CASE WHEN abs(c_acctbal) >= 1000 THEN 'c_acctbal: out of range' END"]),
        "part": ("p_partkey", ["CASE WHEN p_retailprice <> floor(p_retailprice) THEN 'p_retailprice: not integral' END"]),
        "events": ("event_id", ["CASE WHEN ts <> date_trunc('day', ts) THEN 'ts: date with a time part' END",
                                "CASE WHEN CAST(value AS DECIMAL(38,12)) <> CAST(CAST(value AS DECIMAL(18,1)) AS DECIMAL(38,12)) THEN 'value: too many decimals' END"]),
    }
    return "\nUNION ALL ".join(
        f"SELECT '{t}.parquet' AS source_file_name, n AS source_row_number, '{t}' AS source_object_name, CAST({key} AS VARCHAR) AS source_key, "
        f"concat_ws('; ', {', '.join(tests)}) AS reject_reason FROM (SELECT *, row_number() OVER () AS n FROM {t}) x "
        f"WHERE concat_ws('; ', {', '.join(tests)}) <> ''" for t, (key, tests) in rules.items())


@query("stage_rejects", _strict_sql())
def q_stage_rejects(spark, d):
    """Every rejected row with its file, its row there, its key and the columns that failed."""
    parts = []
    for t, spec in STRICT_SPECS.items():
        _, rejects = S.stage_cast(S.with_file_lineage(sources(spark, d).table(t)), spec, lineage=S.LINEAGE)
        parts.append(rejects.select(*S.LINEAGE, F.lit(t).alias("source_object_name"), F.col(next(iter(spec))).alias("source_key"), "reject_reason"))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- A3 stage_lineage ------------------------------------------------------------
LINEAGE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def _lineage_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT concat_ws('-', {', '.join(keys)}) AS source_key, CAST({C.BATCH_ID} AS BIGINT) AS etl_batch_id, '{t}.parquet' AS source_file_name, "
        f"'{t}' AS source_object_name, row_number() OVER () AS source_row_number FROM {t}" for t, keys in LINEAGE_KEYS.items())


@query("stage_lineage", _lineage_sql())
def q_stage_lineage(spark, d):
    """File and row of every row of every given table."""
    parts = []
    for t, keys in LINEAGE_KEYS.items():
        rows = S.stage_lineage(sources(spark, d).table(t), C.BATCH_ID, t)
        parts.append(rows.select(F.concat_ws("-", *keys).alias("source_key"), "etl_batch_id", S.LINEAGE[0], "source_object_name", S.LINEAGE[1]))
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- A4 / A7 replace one batch, read one batch --------------------------------------
@query("stage_replace_batch", """
SELECT CAST(1 AS BIGINT) AS etl_batch_id, count(*) AS row_count FROM products WHERE department = 'PROMO'
UNION ALL SELECT CAST(2 AS BIGINT), count(*) FROM products""")
def q_stage_replace_batch(spark, d):
    p = sources(spark, d).products
    path = S.scratch_path(spark, "stage")
    S.stage_replace_batch(p, path, 1)
    S.stage_replace_batch(p, path, 2)
    S.stage_replace_batch(p.where(F.col("department") == "PROMO"), path, 1)   # replace batch 1 only
    return (spark.read.parquet(path).groupBy(F.col("etl_batch_id").cast("bigint").alias("etl_batch_id"))
            .agg(F.count(F.lit(1)).alias("row_count")))


@query("batch_snapshot", "SELECT * FROM products WHERE department <> 'PROMO'")
def q_batch_snapshot(spark, d):
    p = sources(spark, d).products
    path = S.scratch_path(spark, "snapshot")
    S.stage_replace_batch(p.where(F.col("department") == "PROMO"), path, 1)
    S.stage_replace_batch(p.where(F.col("department") != "PROMO"), path, 2)
    return S.batch_snapshot(spark, path, 2).drop("etl_batch_id")


# --- A5 / A6 control totals -------------------------------------------------------
_PROFILE_SQL = """
SELECT 'row_count' AS metric, CAST(count(*) AS DECIMAL(38,6)) AS value FROM transactions_raw
UNION ALL SELECT 'null:' || c, CAST(n AS DECIMAL(38,6)) FROM (
  SELECT unnest(['household_id','store_id','basket_id','product_id','quantity','sales_value','retail_disc',
                 'coupon_disc','coupon_match_disc','transaction_timestamp','week']) AS c,
         unnest([count(*) - count(household_id), count(*) - count(store_id), count(*) - count(basket_id),
                 count(*) - count(product_id), count(*) - count(quantity), count(*) - count(sales_value),
                 count(*) - count(retail_disc), count(*) - count(coupon_disc),
                 count(*) - count(coupon_match_disc), count(*) - count(transaction_timestamp),
                 count(*) - count(week)]) AS n
  FROM transactions_raw)
UNION ALL SELECT 'sum:quantity', CAST(coalesce(sum(quantity), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'sum:sales_value', CAST(coalesce(sum(sales_value), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'sum:retail_disc', CAST(coalesce(sum(retail_disc), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'sum:coupon_disc', CAST(coalesce(sum(coupon_disc), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'sum:coupon_match_disc', CAST(coalesce(sum(coupon_match_disc), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'epoch_microseconds:transaction_timestamp',
   CAST(coalesce(sum(CAST(epoch_us(transaction_timestamp) AS DECIMAL(38,0))), 0) AS DECIMAL(38,6)) FROM transactions_raw
UNION ALL SELECT 'sum:week', CAST(coalesce(sum(week), 0) AS DECIMAL(38,6)) FROM transactions_raw
"""


@query("stage_profile", _PROFILE_SQL)
def q_stage_profile(spark, d):
    return S.stage_profile(sources(spark, d).transactions_raw.select(*OVERVIEW_COLUMNS["transactions_raw"]))


@query("stage_reconcile", f"""
SELECT metric, value AS source_value, value AS target_value, 'PASS' AS status FROM ({_PROFILE_SQL}) p""")
def q_stage_reconcile(spark, d):
    src = sources(spark, d).transactions_raw.select(*OVERVIEW_COLUMNS["transactions_raw"])
    staged = S.number_rows(src, ["basket_id", "product_id", "transaction_timestamp", "quantity",
                                 "sales_value", "retail_disc", "coupon_disc", "coupon_match_disc"])
    return S.stage_reconcile(S.stage_profile(src), S.stage_profile(staged.select(*src.columns)))


# --- A8 scope_read -------------------------------------------------------------------
@query("scope_read", """
SELECT count(*) AS rows, count(*) FILTER (WHERE product_id IS NULL OR trim(product_id) = '') AS blank_product_ids,
       count(*) FILTER (WHERE scope_status NOT IN ('IN_SCOPE','OUT_OF_SCOPE','REVIEW') OR scope_status IS NULL) AS invalid_status_rows,
       count(DISTINCT scope_rule_version) AS rule_versions,
       count(*) FILTER (WHERE scope_reason IS NULL OR trim(scope_reason) = '') AS blank_reason_rows,
       (SELECT count(*) FROM (SELECT product_id FROM product_scope GROUP BY 1 HAVING count(*) > 1)) AS duplicate_product_ids,
       'PASS' AS status
FROM product_scope""")
def q_scope_read(spark, d):
    wh = warehouse(spark, d)
    path = S.scratch_path(spark, "scope")
    wh.product_scope.write.mode("overwrite").option("header", True).csv(path)
    return S.scope_validate(S.scope_read(spark, path))


# --- A9 csv_export ---------------------------------------------------------------------
@query("csv_export", """
SELECT household_id, store_id, basket_id, product_id, CAST(quantity AS VARCHAR) AS quantity,
       CAST(sales_value AS VARCHAR) AS sales_value, CAST(retail_disc AS VARCHAR) AS retail_disc,
       CAST(coupon_disc AS VARCHAR) AS coupon_disc, CAST(coupon_match_disc AS VARCHAR) AS coupon_match_disc,
       strftime(timezone('America/New_York', timezone('UTC', transaction_timestamp)), '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN date_diff('hour', transaction_timestamp,
                 timezone('America/New_York', timezone('UTC', transaction_timestamp))) = -4 THEN '-0400' ELSE '-0500' END
         AS transaction_timestamp,
       CAST(week AS VARCHAR) AS week
FROM transactions""")
def q_csv_export(spark, d):
    t = sources(spark, d).transactions
    path = S.scratch_path(spark, "export")
    S.csv_export(t, path, C.SOURCE_ZONE)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in t.columns])
    return spark.read.schema(schema).option("header", True).csv(path)


# --- A11 source_overview ------------------------------------------------------------------
OVERVIEW_COLUMNS = {
    "transactions_raw": ["household_id", "store_id", "basket_id", "product_id", "quantity", *C.MONEY, "transaction_timestamp", "week"],
    "products": ["product_id", *C.DESCRIPTIONS["products"]],
    "demographics": ["household_id", *C.DESCRIPTIONS["demographics"]],
    "campaign_descriptions": ["campaign_id", "campaign_type", "start_date", "end_date"],
    "campaigns": ["campaign_id", "household_id"],
    "coupons": ["coupon_upc", "product_id", "campaign_id"],
    "coupon_redemptions_raw": C.REDEMPTION_GRAIN,
    "promotions": ["product_id", "store_id", "display_location", "mailer_location", "week"],
}


def _overview_sql() -> str:
    parts = []
    for t, cols in OVERVIEW_COLUMNS.items():
        for i, c in enumerate(cols):
            parts.append(f"SELECT '{t}' AS table_name, count(*) AS row_count, {len(cols)} AS column_count, "
                         f"'{c}' AS column_name, {i + 1} AS ordinal, count(*) - count({c}) AS missing FROM {t}")
    return "\nUNION ALL ".join(parts)


@query("source_overview", _overview_sql())
def q_source_overview(spark, d):
    s = sources(spark, d)
    return S.source_overview({t: s.source(t).select(*cols) for t, cols in OVERVIEW_COLUMNS.items()})


# --- A12 expected_rows_check ---------------------------------------------------------------
# rows that the input tables say each source has
EXPECTED_ROWS_SQL = {
    "transactions_raw": "SELECT count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)",
    "promotions": "SELECT count(*) FROM lineitem WHERE l_linestatus = 'F'",
    "products": "SELECT count(*) FROM part WHERE p_partkey % 97 <> 5",
    "demographics": "SELECT count(*) FROM customer WHERE c_custkey % 3 = 0",
    "campaigns": "SELECT count(*) FROM events WHERE event_type IN ('view', 'click')",
    "campaign_descriptions": "SELECT count(DISTINCT k % 10) FROM ev",
    "coupons": "SELECT count(*) + count(*) FILTER (WHERE p_partkey % 20 = 0) FROM part",
    "coupon_redemptions_raw": "SELECT count(*) FROM events WHERE event_type = 'purchase'",
}


@query("expected_rows_check", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, ({q}) AS expected_rows, (SELECT count(*) FROM {t}) AS actual_rows, "
    f"CASE WHEN ({q}) = (SELECT count(*) FROM {t}) THEN 'PASS' ELSE 'FAIL' END AS status" for t, q in EXPECTED_ROWS_SQL.items()))
def q_expected_rows(spark, d):
    s = sources(spark, d)
    n = lambda df: df.select(F.count(F.lit(1))).scalar()
    li, part, events = s.table("lineitem"), s.table("part"), s.table("events")
    kinds = F.col("event_type")
    expected = {
        "transactions_raw": n(li.join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")),
        "promotions": n(li.where(F.col("l_linestatus") == "F")),
        "products": n(part.where(F.col("p_partkey") % 97 != 5)),
        "demographics": n(s.table("customer").where(F.col("c_custkey") % 3 == 0)),
        "campaigns": n(events.where(kinds.isin("view", "click"))),
        "campaign_descriptions": events.select(F.countDistinct(F.get_json_object("props", "$.k").cast("int") % 10)).scalar(),
        "coupons": part.select(F.count(F.lit(1)) + F.count_if(F.col("p_partkey") % 20 == 0)).scalar(),
        "coupon_redemptions_raw": n(events.where(kinds == "purchase")),
    }
    return S.expected_rows_check({k: s.source(k) for k in expected}, expected)

"""Registered queries: insert-only load protocol, rerun and restore."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import functions as F

from .. import config as C
from ..operators import digests as D
from ..operators import load as L
from ..operators.aggregates import combine_rows
from ..plans.scope import product_scope
from ..plans.warehouse import DIMENSIONS, load_dimensions, warehouse
from ..registry import query
from ..session import stored
from ..sources.staging import scratch_path
from .quality import REPORT_SQL, quality
from .verify import ALL_VERIFY_SQL, full_report

VERIFY_SQL = "\nUNION ALL ".join(f"SELECT * FROM ({s}) v{i}" for i, s in enumerate(ALL_VERIFY_SQL))


def _wh(spark, d):
    return warehouse(spark, d)


@query("insert_only_merge", """
SELECT 'dim_household' AS table_name, (SELECT count(*) FROM dim_household) AS total_rows,
       (SELECT count(*) FROM dim_household WHERE household_id NOT IN (SELECT household_id FROM demographics)) AS inserted_rows,
       (SELECT count(*) FROM dim_household WHERE household_id IN (SELECT household_id FROM demographics)) AS unchanged_rows,
       CAST(0 AS BIGINT) AS conflict_rows, CAST(0 AS BIGINT) AS extra_rows, CAST(0 AS BIGINT) AS two_way_difference,
       'PASS' AS status""")
def q_i1(spark, d):
    """Target holds the households known from demographics; the load inserts the rest."""
    wh = _wh(spark, d)
    _, key, attrs, key_col = DIMENSIONS[1]
    expected = wh.dim_household
    target = expected.join(wh.src.demographics.select("household_id"), "household_id", "left_semi")
    return L.insert_only_merge(target, expected, key, key + attrs, key_col, "dim_household").report


@query("type1_upsert", """
SELECT count(*) AS rows, count(*) FILTER (WHERE age IS NOT DISTINCT FROM expected_age) AS rows_matching_source
FROM (SELECT h.household_key, h.age, h.age AS expected_age FROM dim_household h) x""")
def q_i2(spark, d):
    """Target carries stale attributes (lower-cased age); Type 1 overwrites them, keys kept."""
    wh = _wh(spark, d)
    expected = wh.dim_household
    attrs = C.DESCRIPTIONS["demographics"]
    stale = expected.withColumn("age", F.lower("age"))
    up = L.type1_upsert(stale, expected, "household_id", ["household_id"] + attrs, "household_key")
    j = up.select("household_id", "household_key", "age").join(
        expected.select("household_id", F.col("age").alias("expected_age"),
                        F.col("household_key").alias("expected_key")), "household_id")
    return j.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("age").eqNullSafe(F.col("expected_age"))
                            & (F.col("household_key") == F.col("expected_key"))).alias("rows_matching_source"))


#: Product buckets of the partitioned fact: the first hex digit of the hash of the product id, modulo this.
PRODUCT_BUCKETS = 4
_BUCKET_SQL = f"CAST('0x' || substr(md5(length(product_id) || ':' || product_id), 1, 1) AS INTEGER) % {PRODUCT_BUCKETS}"


def _bucketed(fact):
    return fact.withColumn("product_bucket", (F.conv(D.key_range("product_id", 1), 16, 10).cast("int") % PRODUCT_BUCKETS))


def _rebuilt(spark, d, **rules):
    """The sales fact, partitioned by week and product bucket, after a change of scope; and the partitions it rewrote."""
    wh = _wh(spark, d)
    fact = L.PartitionedFact.create(_bucketed(wh.fact_sales.drop("scope_rule_version")), scratch_path(spark, "fact"), ["week_key", "product_bucket"])
    change = stored(L.changed_status(wh.product_scope, product_scope(wh.src.products, wh.src.transactions, version="fixture-2", **rules)), "scope-change")
    new = wh.fact_sales_rows(wh.sales_lines(change.where("enters").select("product_id"))).drop("scope_rule_version")
    return fact, fact.apply(change.where("not enters"), _bucketed(new), "product_id")


@query("scope_change_rebuild", """
SELECT f.basket_id, f.product_id FROM fact_sales f JOIN product_scope s USING (product_id)
WHERE s.scope_status = 'IN_SCOPE' AND upper(trim(s.department)) <> 'LARGE'""")
def q_i3(spark, d):
    """New scope version drops department LARGE from IN_SCOPE; its rows leave the fact."""
    fact, _ = _rebuilt(spark, d, in_departments=[x for x in C.SCOPE_IN_DEPARTMENTS if x != "LARGE"])
    return fact.read().select("basket_id", "product_id")


MORE_IN = ("refine_in", "ECONOMY", "GEAR", ["RED GEAR"], C.IN_SCOPE, "Reviewed category/type")
_ENTERING_SQL = """entering AS (SELECT s.product_id FROM product_scope s JOIN products_norm n USING (product_id)
    WHERE s.scope_status = 'REVIEW' AND n.n_dept = 'ECONOMY' AND n.n_cat = 'GEAR' AND n.n_type = 'RED GEAR'),
arriving AS (SELECT w.week_key, t.basket_id, t.product_id FROM tx_local t LEFT JOIN dim_week w ON w.source_week = t.week
    AND t.local_date BETWEEN w.coverage_start_date AND w.coverage_end_date WHERE t.product_id IN (SELECT product_id FROM entering))"""


@query("scope_change_incremental", f"""
WITH {_ENTERING_SQL}
SELECT week_key, basket_id, product_id FROM fact_sales UNION ALL SELECT week_key, basket_id, product_id FROM arriving""")
def q_i3_incremental(spark, d):
    """A new version confirms one more product type: its lines enter, and only the partitions they fall in are rewritten."""
    fact, _ = _rebuilt(spark, d, refinements=[*C.SCOPE_REFINEMENTS, MORE_IN])
    return fact.read().select("week_key", "basket_id", "product_id")


@query("scope_change_partitions", f"""
WITH {_ENTERING_SQL},
old AS (SELECT week_key, {_BUCKET_SQL} AS product_bucket, count(*) AS n FROM fact_sales GROUP BY 1, 2),
new AS (SELECT week_key, {_BUCKET_SQL} AS product_bucket, count(*) AS n FROM arriving GROUP BY 1, 2)
SELECT week_key, product_bucket, CAST(coalesce(old.n, 0) AS BIGINT) AS rows_before, CAST(coalesce(old.n, 0) + new.n AS BIGINT) AS rows_after
FROM new LEFT JOIN old USING (week_key, product_bucket)""")
def q_i3_partitions(spark, d):
    """The partitions that the change rewrote."""
    return _rebuilt(spark, d, refinements=[*C.SCOPE_REFINEMENTS, MORE_IN])[1]


@query("publish_after_checks", """
WITH dq AS (SELECT count(*) AS n FROM ("""+ REPORT_SQL +f""") r WHERE severity = 'ERROR' AND status = 'FAIL'),
bad AS (SELECT count(*) AS n FROM ({VERIFY_SQL}) v WHERE status <> 'PASS'),
ok AS (SELECT (SELECT n FROM dq) + (SELECT n FROM bad) = 0 AS all_pass),
tables AS (SELECT 'dim_campaign' AS table_name, count(*) AS row_count FROM dim_campaign
           UNION ALL SELECT 'dim_store', count(*) FROM dim_store
           UNION ALL SELECT 'fact_coupon_redemption', count(*) FROM fact_coupon_redemption)
SELECT 'all_checks' AS gate, table_name, CASE WHEN all_pass THEN row_count END AS row_count,
       CASE WHEN all_pass THEN 'PUBLISHED' ELSE 'BLOCKED' END AS outcome FROM tables, ok
UNION ALL SELECT 'rerun_of_dimensions', table_name, row_count, 'PUBLISHED' FROM tables WHERE table_name LIKE 'dim%'""")
def q_i4(spark, d):
    """All three tables behind the rules and the verification; the dimensions alone behind their rerun."""
    wh = _wh(spark, d)
    checks = quality(spark, d).report().where(F.col("severity") == "ERROR").select(F.col("rule_code").alias("metric"), "status") \
        .unionByName(full_report(spark, d).select("metric", "status"))
    dimensions = {"dim_campaign": wh.dim_campaign, "dim_store": wh.dim_store}
    attempts = [("all_checks", dimensions | {"fact_coupon_redemption": wh.fact_coupon_redemption}, checks),
                ("rerun_of_dimensions", dimensions, _rerun_report(wh, list(dimensions)))]
    parts = []
    for gate, frames, passed in attempts:
        base = scratch_path(spark, "publish")
        try:
            L.publish(spark, frames, base, passed)
            outcome = "PUBLISHED"
        except L.LoadBlocked:
            outcome = "BLOCKED"
        for t in frames:
            rows = F.count(F.lit(1)) if outcome == "PUBLISHED" else F.lit(None).cast("long")
            df = L.read_current(spark, base, t) if outcome == "PUBLISHED" else spark.range(1)
            parts.append(df.agg(rows.alias("row_count")).select(F.lit(gate).alias("gate"), F.lit(t).alias("table_name"), "row_count",
                                                                F.lit(outcome).alias("outcome")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _rerun_report(wh, names=None):
    """Each dimension loaded into an empty target and loaded again; the loads are independent, so their small jobs run side by side."""
    chosen = [d for d in DIMENSIONS if not names or d[0] in names]
    expected = {name: getattr(wh, name) for name, *_ in chosen}

    def twice(dimension):
        name, key, attrs, key_col = dimension
        df = expected[name]
        first = L.insert_only_merge(df.limit(0), df, key, key + attrs, key_col, name)
        loaded = stored(first.merged, f"first-{name}")
        second = L.insert_only_merge(loaded, df, key, key + attrs, key_col, name)
        moved = (L.changed_keys(loaded, second.merged, key, key_col) if key_col else df.limit(0)) \
            .agg(F.count(F.lit(1)).alias("changed_keys"))
        return combine_rows([second.report, moved])

    with ThreadPoolExecutor(4) as pool:
        return reduce(lambda a, b: a.unionByName(b), pool.map(twice, chosen))


def _rerun_sql() -> str:
    parts = []
    for name, *_ in DIMENSIONS:
        parts.append(f"SELECT '{name}' AS table_name, count(*) AS total_rows, CAST(0 AS BIGINT) AS inserted_rows, "
                     f"count(*) AS unchanged_rows, CAST(0 AS BIGINT) AS conflict_rows, CAST(0 AS BIGINT) AS extra_rows, "
                     f"CAST(0 AS BIGINT) AS two_way_difference, 'PASS' AS status, CAST(0 AS BIGINT) AS changed_keys FROM {name}")
    return "\nUNION ALL ".join(parts)


@query("rerun_is_noop", _rerun_sql())
def q_i5(spark, d):
    """Load every dimension into an empty target, then load again: 0 inserted, nothing changed."""
    return _rerun_report(_wh(spark, d))


@query("restore_missing_row", """
SELECT 'first_reload' AS step, CAST(1 AS BIGINT) AS inserted_rows, (SELECT count(*) FROM fact_sales) AS total_rows
UNION ALL SELECT 'second_reload', CAST(0 AS BIGINT), (SELECT count(*) FROM fact_sales)""")
def q_i6(spark, d):
    """Remove one fact row, reload (inserts exactly 1), reload again (inserts 0)."""
    wh = _wh(spark, d)
    fact = wh.fact_sales.drop("transaction_timestamp")
    key = ["basket_id", "product_key"]
    attrs = [c for c in fact.columns if c not in key]
    victim = fact.select(*key).orderBy(*key).limit(1)
    damaged = fact.join(victim, key, "left_anti")
    first = L.insert_only_merge(damaged, fact, key, key + attrs, None, "fact_sales")
    second = L.insert_only_merge(first.merged, fact, key, key + attrs, None, "fact_sales")
    return first.report.select(F.lit("first_reload").alias("step"), "inserted_rows", "total_rows").unionByName(
        second.report.select(F.lit("second_reload").alias("step"), "inserted_rows", "total_rows"))


_LOADED = ["dim_household", "dim_store", "dim_campaign"]


@query("load_dimensions", "\nUNION ALL ".join(
    f"""SELECT 'first' AS load, '{t}' AS table_name, 'LOADED' AS outcome, CAST(0 AS BIGINT) AS rows_before, (SELECT count(*) FROM {t} {w}) AS rows_after
UNION ALL SELECT 'second', '{t}', 'LOADED', (SELECT count(*) FROM {t} {w}), (SELECT count(*) FROM {t})
UNION ALL SELECT 'conflict', '{t}', 'BLOCKED', (SELECT count(*) FROM {t}), (SELECT count(*) FROM {t})"""
    for t, w in (("dim_household", "WHERE household_id IN (SELECT household_id FROM demographics)"), ("dim_store", ""), ("dim_campaign", ""))))
def q_load_dimensions(spark, d):
    """I1 in the build path: known households, then all of them, then a delivery in which some have another age, which stops."""
    wh = _wh(spark, d)
    base = scratch_path(spark, "dimensions")
    full = {t: getattr(wh, t) for t in _LOADED}
    first = full | {"dim_household": wh.dim_household.join(wh.src.demographics.select("household_id"), "household_id", "left_semi")}
    other = full | {"dim_household": wh.dim_household.withColumn("age", F.concat(F.coalesce("age", F.lit("")), F.lit("!")))}
    parts = []
    for name, frames in (("first", first), ("second", full), ("conflict", other)):
        try:
            parts.append(load_dimensions(spark, base, frames).select(F.lit(name).alias("load"), "table_name", F.lit("LOADED").alias("outcome"), "rows_before", "rows_after"))
        except L.LoadBlocked:
            for t in frames:
                n = L.read_current(spark, base, t).select(F.count(F.lit(1))).scalar()
                parts.append(spark.range(1).select(F.lit(name).alias("load"), F.lit(t).alias("table_name"), F.lit("BLOCKED").alias("outcome"),
                                                   n.alias("rows_before"), n.alias("rows_after")))
    return reduce(lambda a, b: a.unionByName(b), parts)

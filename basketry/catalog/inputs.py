"""Registered queries: input checks before a load.

Each returns (check, expected, actual, status) rows computed from the staged
sources, the scope decisions and the validation record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import cents_long, off_cent
from ..operators import sets as S
from ..operators.aggregates import combine_rows
from ..plans import manifest as MF
from ..plans import scope as SC
from ..plans.warehouse import warehouse
from ..registry import query
from ..sources import fixtures
from ..sources import staging as ST
from .verify import chk, with_status

V = "decimal(38,3)"
SOURCE_TABLES = ["transactions", "promotions", "products", "demographics", "campaigns", "campaign_descriptions",
                 "coupons", "coupon_redemptions"]


def _rows(checks: list[tuple[str, object, object]], spark) -> DataFrame:
    """(name, expected Column, actual Column) -> check rows (one-row selects, unioned)."""
    parts = [spark.range(1).select(F.lit(n).alias("metric"), F.lit(e).cast(V).alias("expected")
                                   if not hasattr(e, "alias") else e.cast(V).alias("expected"),
                                   F.lit(a).cast(V).alias("actual") if not hasattr(a, "alias")
                                   else a.cast(V).alias("actual"))
             for n, e, a in checks]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL"))


def _n(df):
    return df.select(F.count(F.lit(1))).scalar()


def _staged_name(t: str) -> str:
    return {"transactions": "transactions_raw", "coupon_redemptions": "coupon_redemptions_raw"}.get(t, t)


def _derived(src, t: str):
    """A source table straight from the input, past everything that was staged."""
    return fixtures.SOURCES[_staged_name(t)](src.spark, src.sf_dir)


@query("batch_files_complete", with_status(
    [chk(f"{t}.loaded_rows", f"SELECT count(*) FROM {_staged_name(t)}", f"SELECT count(*) FROM {_staged_name(t)}") for t in SOURCE_TABLES]
    + [chk("batch.file_count", str(len(fixtures.INPUT_TABLES)), str(len(fixtures.INPUT_TABLES)))]))
def q_k1(spark, d):
    """K1: every input table has its files, and staged rows equal the rows of the input they come from."""
    src = warehouse(spark, d).src
    rows = [staged_rows(src, t) for t in SOURCE_TABLES]
    checks = [(f"{t}.loaded_rows", source, staged) for t, (source, staged) in zip(SOURCE_TABLES, rows)]
    checks.append(("batch.file_count", F.lit(len(fixtures.INPUT_TABLES)), F.lit(len(input_tables(spark, d)))))
    return _rows(checks, spark)


def input_tables(spark, d) -> list[str]:
    """The input tables that are there: a Parquet file, or a folder with one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(d)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def held(t: str) -> bool:
        at = path(folder, f"{t}.parquet")
        return fs.exists(at) and (not fs.getFileStatus(at).isDirectory() or any(f.getPath().getName().endswith(".parquet") for f in fs.listStatus(at)))
    return [t for t in fixtures.INPUT_TABLES if held(t)]


def staged_rows(src, t: str):
    return _n(_derived(src, t)), _n(src.source(_staged_name(t)))


def _row_text_sql(cols) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in cols) + ")"


def parts_sql(name: str, key, cols, table: str) -> str:
    """The range digests of one table in SQL."""
    lanes = " || ':' || ".join(f"CAST(sum(CAST('0x' || substr(h, {16 * i + 1}, 16) AS UBIGINT)) AS VARCHAR)" for i in range(4))
    return (f"SELECT '{name}' AS table_name, part, count(*) AS rows, sha256(count(*) || ':' || {lanes}) AS digest FROM (SELECT substr(md5({_row_text_sql(key)}), 1, 2) AS part, "
            f"sha256({_row_text_sql(cols)}) AS h FROM {table}) x GROUP BY part")


def tables_sql(parts: str) -> str:
    """(table_name, rows, digest) in SQL from range digests."""
    return (f"SELECT table_name, CAST(sum(rows) AS BIGINT) AS rows, sha256(string_agg(part || ' ' || digest, chr(10) ORDER BY part)) AS digest "
            f"FROM ({parts}) p GROUP BY table_name")


def _tree_sql(tables: dict[str, str] | None = None) -> str:
    """The digest tree in SQL; ``tables`` names what to read in place of a table."""
    parts = "\nUNION ALL ".join(parts_sql(t, key, cols, (tables or {}).get(t, t)) for t, (key, cols) in MF.MANIFEST.items())
    return f"""SELECT 'part' AS level, table_name, part, rows, digest FROM ({parts}) p
UNION ALL SELECT 'table', table_name, NULL, rows, digest FROM ({tables_sql(parts)}) t
UNION ALL SELECT 'batch', NULL, NULL, CAST(sum(rows) AS BIGINT), sha256(string_agg(table_name || ' ' || digest, chr(10) ORDER BY table_name)) FROM ({tables_sql(parts)}) t"""


@query("source_manifest", _tree_sql())
def q_manifest(spark, d):
    """A10: rows and SHA-256 digest of every part of every staged source, of each source and of the batch."""
    return MF.recorded_manifest(warehouse(spark, d).src)


@query("manifest_match", f"SELECT level, table_name, part, rows AS rows_before, rows AS rows_after, 'PASS' AS status FROM ({_tree_sql()}) m WHERE level <> 'part'")
def q_k2(spark, d):
    """K2: the manifest recorded at staging against the staged tables as they are; a part that changed has a row of its own."""
    src = warehouse(spark, d).src
    return MF.changes(MF.recorded_manifest(src), MF.staged_manifest(src))


# a later delivery of the batch: some products have another brand, week 53 has no promotions
LATER = {"products": "(SELECT * REPLACE (CASE WHEN CAST(product_id AS BIGINT) % 500 = 7 THEN lower(brand) ELSE brand END AS brand) FROM products)",
         "promotions": "(SELECT * FROM promotions WHERE week <> 53)"}


@query("manifest_changes", f"""
SELECT coalesce(a.level, b.level) AS level, coalesce(a.table_name, b.table_name) AS table_name, coalesce(a.part, b.part) AS part,
       a.rows AS rows_before, b.rows AS rows_after,
       CASE WHEN a.digest IS NOT DISTINCT FROM b.digest THEN 'PASS' WHEN a.digest IS NULL THEN 'ADDED' WHEN b.digest IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS status
FROM ({_tree_sql()}) a FULL JOIN ({_tree_sql(LATER)}) b
  ON a.level = b.level AND a.table_name IS NOT DISTINCT FROM b.table_name AND a.part IS NOT DISTINCT FROM b.part
WHERE coalesce(a.level, b.level) <> 'part' OR a.digest IS DISTINCT FROM b.digest""")
def q_manifest_changes(spark, d):
    """A10/K2: which parts of which tables a later delivery changed."""
    src = warehouse(spark, d).src
    frames = {t: src.source(t) for t in MF.MANIFEST}
    renamed = F.when(F.col("product_id").cast("bigint") % 500 == 7, F.lower("brand")).otherwise(F.col("brand"))
    frames["products"] = frames["products"].withColumn("brand", renamed)
    frames["promotions"] = frames["promotions"].where("week <> 53")
    return MF.changes(MF.recorded_manifest(src), MF.manifest(frames))


@query("difference_by_ranges", f"""
SELECT product_id, brand, 'only_in_a' AS side FROM (SELECT product_id, brand FROM products EXCEPT ALL SELECT product_id, brand FROM {LATER['products']} x) a
UNION ALL SELECT product_id, brand, 'only_in_b' FROM (SELECT product_id, brand FROM {LATER['products']} x EXCEPT ALL SELECT product_id, brand FROM products) b""")
def q_difference_by_ranges(spark, d):
    """the rows that differ, read only in the key ranges whose digests differ."""
    p = warehouse(spark, d).src.products.select("product_id", "brand")
    renamed = F.when(F.col("product_id").cast("bigint") % 500 == 7, F.lower("brand")).otherwise(F.col("brand"))
    return S.two_way_multiset_difference(p, p.withColumn("brand", renamed), "product_id")


@query("scope_file_valid", """
SELECT count(*) AS rows, count(*) FILTER (WHERE product_id IS NULL OR trim(product_id) = '') AS blank_product_ids,
       count(*) FILTER (WHERE scope_status NOT IN ('IN_SCOPE','OUT_OF_SCOPE','REVIEW') OR scope_status IS NULL) AS invalid_status_rows,
       count(DISTINCT scope_rule_version) AS rule_versions,
       count(*) FILTER (WHERE scope_reason IS NULL OR trim(scope_reason) = '') AS blank_reason_rows,
       (SELECT count(*) FROM (SELECT product_id FROM product_scope GROUP BY 1 HAVING count(*) > 1)) AS duplicate_product_ids,
       'PASS' AS status
FROM product_scope""")
def q_k3(spark, d):
    return ST.scope_validate(warehouse(spark, d).product_scope)


@query("sales_cents_match", with_status([
    chk("source.rows", "SELECT count(*) FROM transactions", "SELECT count(*) FROM transactions"),
    chk("source.null_sales", "0", "SELECT count(*) FROM transactions WHERE sales_value IS NULL"),
    chk("source.off_cent_sales", "0", """SELECT count(*) FROM transactions WHERE
        abs(CAST(sales_value AS DECIMAL(38,18)) * 100 - round(CAST(sales_value AS DECIMAL(38,18)) * 100)) >= 0.000001"""),
    chk("source.sales_cents", "SELECT sum(round(sales_value * 100)) FROM transactions",
        "SELECT sum(round(sales_value * 100)) FROM transactions"),
]))
def q_k4(spark, d):
    """K4: rows, NULL count, off-cent count and cents equal the validation record stored when products were classified."""
    wh = warehouse(spark, d)
    tx = wh.src.transactions
    rec = wh.validation_record
    a = tx.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("sales_value").isNull()).alias("nulls"),
               F.count_if(off_cent("sales_value")).alias("off"), F.sum(cents_long("sales_value")).alias("cents"))
    w = combine_rows([a, rec.select("source_rows", "source_sales_cents"), spark.range(1).select(
        F.lit(0).alias("zero"))])
    long = w.selectExpr(f"stack(4, 'source.rows', CAST(source_rows AS {V}), CAST(rows AS {V}), "
                        f"'source.null_sales', CAST(zero AS {V}), CAST(nulls AS {V}), "
                        f"'source.off_cent_sales', CAST(zero AS {V}), CAST(off AS {V}), "
                        f"'source.sales_cents', CAST(source_sales_cents AS {V}), CAST(cents AS {V})) "
                        "as (metric, expected, actual)")
    return long.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS")
                           .otherwise("FAIL"))


@query("lookup_count_match", with_status([chk("products.rows", "SELECT count(*) FROM products",
                                              "SELECT count(*) FROM products")]))
def q_k5(spark, d):
    wh = warehouse(spark, d)
    rec = wh.validation_record
    return _rows([("products.rows", rec.select("lookup_products").scalar(), _n(wh.src.products))], spark)


@query("scope_coverage", with_status([
    chk("scope.missing_ids", "0", """SELECT count(*) FROM (SELECT product_id FROM products UNION SELECT product_id FROM transactions) i
        WHERE product_id NOT IN (SELECT product_id FROM product_scope)"""),
    chk("scope.extra_ids", "0", """SELECT count(*) FROM product_scope WHERE product_id NOT IN
        (SELECT product_id FROM products UNION SELECT product_id FROM transactions)""")]))
def q_k6(spark, d):
    wh = warehouse(spark, d)
    ids = S.id_hub([wh.src.products, wh.src.transactions], "product_id")
    cov = S.coverage_diff(ids, wh.product_scope, "product_id")
    return _rows([("scope.missing_ids", F.lit(0), cov.select("missing_ids").scalar()),
                  ("scope.extra_ids", F.lit(0), cov.select("extra_ids").scalar())], spark)


@query("orphans_are_review", with_status([
    chk("orphans.count", """SELECT count(DISTINCT product_id) FROM transactions WHERE product_id NOT IN (SELECT product_id FROM products)""",
        "SELECT count(*) FROM product_scope WHERE scope_reason = 'Product missing from lookup'"),
    chk("orphans.not_review", "0", """SELECT count(*) FROM product_scope WHERE product_id NOT IN (SELECT product_id FROM products)
        AND scope_status <> 'REVIEW'""")]))
def q_k7(spark, d):
    wh = warehouse(spark, d)
    orphan_ids = (wh.src.transactions.select("product_id").distinct()
                  .join(wh.src.products.select("product_id"), "product_id", "left_anti"))
    dec = wh.product_scope.join(wh.src.products.select("product_id"), "product_id", "left_anti")
    return _rows([("orphans.count", _n(orphan_ids),
                   _n(wh.product_scope.where(F.col("scope_reason") == C.REASON_MISSING_LOOKUP))),
                  ("orphans.not_review", F.lit(0), _n(dec.where(F.col("scope_status") != C.REVIEW)))], spark)


def _k8_sql() -> str:
    parts = []
    for s in C.SCOPE_STATUSES:
        j = f"(SELECT t.* FROM transactions t JOIN product_scope s USING (product_id) WHERE s.scope_status = '{s}')"
        parts.append(chk(f"{s}.rows", f"SELECT count(*) FROM {j} x", f"SELECT count(*) FROM {j} x"))
        parts.append(chk(f"{s}.sales_value", f"SELECT coalesce(sum(sales_value), 0) FROM {j} x",
                         f"SELECT coalesce(sum(sales_value), 0) FROM {j} x"))
    return with_status(parts)


@query("scope_totals_match", _k8_sql())
def q_k8(spark, d):
    """K8: per status rows and sales equal the summary stored when products were classified."""
    wh = warehouse(spark, d)
    summ = wh.scope_summary_record.select(
        "scope_status", F.col("transaction_rows").alias("e_rows"), F.col("sales_value").alias("e_sales"))
    j = wh.src.transactions.join(wh.product_scope.select("product_id", "scope_status"), "product_id")
    tot = j.groupBy("scope_status").agg(F.count(F.lit(1)).alias("a_rows"), F.sum("sales_value").alias("a_sales"))
    statuses = spark.createDataFrame([(s,) for s in C.SCOPE_STATUSES], "scope_status string")
    w = statuses.join(summ, "scope_status", "left").join(tot, "scope_status", "left")
    z = F.lit(0)
    long = w.select(F.explode(F.array(
        F.struct(F.concat("scope_status", F.lit(".rows")).alias("metric"),
                 F.coalesce("e_rows", z).cast(V).alias("expected"), F.coalesce("a_rows", z).cast(V).alias("actual")),
        F.struct(F.concat("scope_status", F.lit(".sales_value")).alias("metric"),
                 F.coalesce("e_sales", z).cast(V).alias("expected"),
                 F.coalesce("a_sales", z).cast(V).alias("actual")))).alias("c")).select("c.*")
    return long.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS")
                           .otherwise("FAIL"))


@query("promotion_scope_complete", """
SELECT DISTINCT product_id FROM promotions WHERE product_id NOT IN (SELECT product_id FROM product_scope)""")
def q_k9(spark, d):
    """K9: promotion product ids without a scope decision (a finding when non-empty)."""
    wh = warehouse(spark, d)
    return wh.src.promotions.select("product_id").distinct().join(
        wh.product_scope.select("product_id"), "product_id", "left_anti")


@query("product_dim_in_sync", with_status([
    chk("sales.status_mismatch", "0", """SELECT count(*) FROM sales_in_scope s JOIN dim_product p USING (product_id)
        WHERE p.scope_status <> 'IN_SCOPE' OR p.scope_rule_version <> 'fixture-1' OR p.source_lookup_missing_flag"""),
    chk("promotion.status_mismatch", "0", """SELECT count(*) FROM promo_weekly g JOIN dim_product p USING (product_id)
        WHERE p.scope_status <> 'IN_SCOPE' OR p.scope_rule_version <> 'fixture-1' OR p.source_lookup_missing_flag""")]))
def q_k10(spark, d):
    wh = warehouse(spark, d)
    dp = wh.dim_product.select("product_id", "scope_status", "scope_rule_version", "source_lookup_missing_flag")
    good = (F.col("scope_status").eqNullSafe(C.IN_SCOPE) & F.col("scope_rule_version").eqNullSafe(C.SCOPE_RULE_VERSION)
            & F.col("source_lookup_missing_flag").eqNullSafe(False))    # a NULL, or no row at all, is out of sync
    s = wh.sales_in_scope.select("product_id").join(dp, "product_id", "left").where(~good)
    p = wh.promotion_grouped.select("product_id").join(dp, "product_id", "left").where(~good)
    return _rows([("sales.status_mismatch", F.lit(0), _n(s)), ("promotion.status_mismatch", F.lit(0), _n(p))], spark)

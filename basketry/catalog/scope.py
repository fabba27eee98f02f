"""Registered queries: product scope classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..plans import scope as SC
from ..plans.warehouse import warehouse
from ..registry import query
from ..session import shared_path
from .inputs import parts_sql, tables_sql


def _dec(spark, d):
    return warehouse(spark, d).product_scope


def _tx(spark, d):
    return warehouse(spark, d).src.transactions


@query("product_scope", "SELECT * FROM product_scope")
def q_product_scope(spark, d):
    return _dec(spark, d)


# Each rule's effect: the decisions it finally wrote (rules are ordered, last writer wins).
_RULES = [
    ("scope_default", C.REASON_DEFAULT),
    ("scope_department_out", C.REASON_DEPT_OUT),
    ("scope_department_in", C.REASON_DEPT_IN),
    ("scope_category_review", C.REASON_CATEGORY_REVIEW),
    ("scope_missing_attr", C.REASON_MISSING_ATTR),
    ("scope_refine_in", C.SCOPE_REFINEMENTS[0][5]),
    ("scope_refine_excluded", C.SCOPE_REFINEMENTS[1][5]),
    ("scope_missing_lookup", C.REASON_MISSING_LOOKUP),
]
for _name, _reason in _RULES:
    query(_name, f"SELECT * FROM product_scope WHERE scope_reason = '{_reason}'")(
        lambda spark, d, _r=_reason: _dec(spark, d).where(F.col("scope_reason") == _r))


def _list_sql(names: list[str]) -> str:
    """First match by rank over all rules that fit: a nested comparison, not an index."""
    rules = [r for n in names for r in C.DECISION_LISTS[n]]
    text = lambda v: "NULL" if v is None else "'" + v + "'"
    values = ", ".join(f"({k}, {', '.join(text(v) for v in r)})" for k, r in enumerate(rules))
    return f"""
SELECT p.product_id, CAST(r.rule AS BIGINT) AS rule, r.status, r.reason
FROM (SELECT product_id, nullif(n_dept, '') AS d, nullif(n_cat, '') AS c, nullif(n_type, '') AS t FROM products_norm
      WHERE product_id IN (SELECT product_id FROM product_scope WHERE scope_status = 'REVIEW' AND scope_reason <> 'Product missing from lookup')) p
JOIN (VALUES {values}) r(rule, d, c, t, status, reason)
  ON (r.d IS NULL OR r.d = p.d) AND (r.c IS NULL OR r.c = p.c) AND (r.t IS NULL OR r.t = p.t)
QUALIFY row_number() OVER (PARTITION BY p.product_id ORDER BY r.rule) = 1"""


for _key, _names in [("scope_refine_personal_care", ["personal_care"]), ("scope_refine_nutrition", ["nutrition"]), ("scope_refine_cosmetics", ["cosmetics"]),
                     ("scope_decision_list", list(C.DECISION_LISTS))]:
    query(_key, _list_sql(_names))(
        lambda spark, d, _n=_names: SC.refine_by_list(warehouse(spark, d).src.products, _dec(spark, d), _n))


@query("scope_join_guard", """
SELECT (SELECT count(*) FROM transactions) AS source_rows,
       (SELECT count(*) FROM transactions t LEFT JOIN product_scope s USING (product_id)) AS joined_rows,
       (SELECT count(*) FROM transactions t LEFT JOIN product_scope s USING (product_id) WHERE s.scope_status IS NULL) AS null_status_rows,
       (SELECT count(*) FROM (SELECT product_id FROM product_scope GROUP BY 1 HAVING count(*) > 1)) AS duplicate_decision_ids,
       'PASS' AS status""")
def q_scope_join_guard(spark, d):
    return SC.scope_join_guard(_tx(spark, d), _dec(spark, d))


SUMMARY_SQL = """
WITH j AS (SELECT t.*, s.scope_status, CAST(round(t.sales_value * 100) AS BIGINT) AS cents
           FROM transactions t LEFT JOIN product_scope s USING (product_id)),
tot AS (SELECT count(*) AS n, sum(cents) AS c FROM j),
lk AS (SELECT scope_status, count(*) AS lookup_products FROM product_scope
       WHERE scope_reason <> 'Product missing from lookup' GROUP BY 1)
SELECT j.scope_status, count(*) AS transaction_rows, count(DISTINCT product_id) AS transacting_products,
       CAST(sum(cents) AS BIGINT) AS sales_cents, count(DISTINCT basket_id) AS baskets,
       count(DISTINCT household_id) AS households,
       CAST(coalesce(max(lk.lookup_products), 0) AS BIGINT) AS lookup_products,
       CAST(sum(sales_value) AS DECIMAL(38,2)) AS sales_value,
       CAST(count(*) AS DOUBLE) * 100.0 / CAST(max(tot.n) AS DOUBLE) AS transaction_pct,
       CAST(sum(cents) AS DOUBLE) * 100.0 / CAST(max(tot.c) AS DOUBLE) AS sales_pct
FROM j CROSS JOIN tot LEFT JOIN lk USING (scope_status)
GROUP BY j.scope_status"""


@query("scope_summary", SUMMARY_SQL)
def q_scope_summary(spark, d):
    return SC.scope_summary(_tx(spark, d), _dec(spark, d))


RECON_SQL = """
SELECT count(*) AS source_rows, count(*) AS classified_rows,
       CAST(sum(round(sales_value * 100)) AS BIGINT) AS source_sales_cents,
       CAST(sum(round(sales_value * 100)) AS BIGINT) AS classified_sales_cents,
       'PASS' AS row_reconciliation, 'PASS' AS sales_reconciliation
FROM transactions"""


@query("scope_reconcile", RECON_SQL)
def q_scope_reconcile(spark, d):
    return SC.scope_reconcile(_tx(spark, d), _dec(spark, d))


@query("scope_department_summary", """
SELECT department, scope_status, count(*) AS products FROM product_scope
WHERE scope_reason <> 'Product missing from lookup' GROUP BY 1, 2""")
def q_scope_department_summary(spark, d):
    return SC.scope_department_summary(_dec(spark, d))


@query("scope_review_categories", """
SELECT department, product_category, product_type, scope_reason, count(*) AS products FROM product_scope
WHERE scope_status = 'REVIEW' AND scope_reason <> 'Product missing from lookup' GROUP BY 1, 2, 3, 4""")
def q_scope_review_categories(spark, d):
    return SC.scope_review_categories(_dec(spark, d))


ORACLE_VALIDATION = """
SELECT 'fixture-1' AS rule_version, (SELECT count(*) FROM transactions) AS source_rows,
       (SELECT count(*) FROM products) AS lookup_products,
       (SELECT count(*) FROM product_scope WHERE scope_reason = 'Product missing from lookup') AS missing_lookup_products,
       (SELECT CAST(sum(round(sales_value * 100)) AS BIGINT) FROM transactions) AS source_sales_cents,
       'PASS' AS row_reconciliation, 'PASS' AS sales_reconciliation"""


@query("scope_outputs", ORACLE_VALIDATION)
def q_scope_outputs(spark, d):
    return SC.validation_record(_tx(spark, d), _dec(spark, d))


def _outputs_sql() -> str:
    frames = {
        "decisions": (SC.DECISION_COLUMNS, "product_scope"),
        "department_summary": (["department", "scope_status", "products"], """(SELECT department, scope_status, count(*) AS products FROM product_scope
            WHERE scope_reason <> 'Product missing from lookup' GROUP BY 1, 2)"""),
        "review_categories": (["department", "product_category", "product_type", "scope_reason", "products"], """(SELECT department, product_category, product_type,
            scope_reason, count(*) AS products FROM product_scope WHERE scope_status = 'REVIEW' AND scope_reason <> 'Product missing from lookup' GROUP BY 1, 2, 3, 4)"""),
        "validation": (["rule_version", "source_rows", "lookup_products", "missing_lookup_products", "source_sales_cents", "row_reconciliation", "sales_reconciliation"],
                       f"({ORACLE_VALIDATION})"),
    }
    parts = "\nUNION ALL ".join(parts_sql(n, cols[:1], cols, f"{t} y") for n, (cols, t) in frames.items())
    return f"SELECT table_name AS output, rows, digest FROM ({tables_sql(parts)}) o"


@query("scope_output_files", _outputs_sql())
def q_scope_output_files(spark, d):
    """The outputs written, read back and hashed."""
    return SC.write_scope_outputs(shared_path(spark, "scope-outputs"), _tx(spark, d), _dec(spark, d))

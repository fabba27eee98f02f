"""Product scope classification.

Rules are data: a small rule DataFrame (its size is the parameter list, so it
is safe to broadcast).  Products are classified in one projection; refinements
are a broadcast many-to-one join on the normalised (department, category, type).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import label_norm
from ..operators import digests
from ..operators.rules import first_match, rule_table

PRODUCT_COLUMNS = ["product_id", "manufacturer_id", "department", "brand",
                   "product_category", "product_type", "package_size"]
DECISION_COLUMNS = PRODUCT_COLUMNS + ["scope_status", "scope_reason", "scope_rule_version"]


def refinement_rules(spark: SparkSession, refinements=C.SCOPE_REFINEMENTS) -> DataFrame:
    """(department, category, product_type) -> (status, reason), first rule wins."""
    rows = []
    for priority, (kind, dept, cat, types, status, reason) in enumerate(refinements):
        for t in types:
            rows.append((priority, kind, dept, cat, t, status, reason))
    schema = ("priority int, kind string, r_dept string, r_cat string, r_type string, "
              "r_status string, r_reason string")
    rules = spark.createDataFrame(rows, schema)
    return (rules.groupBy("r_dept", "r_cat", "r_type")
            .agg(F.min_by(F.struct("r_status", "r_reason"), "priority").alias("r"))
            .select("r_dept", "r_cat", "r_type", "r.r_status", "r.r_reason"))


def _missing(cols: list[Column]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | c.isNull() | (c == "")
    return cond


def classify_scope(products: DataFrame, *, in_departments=C.SCOPE_IN_DEPARTMENTS,
                   out_departments=C.SCOPE_OUT_DEPARTMENTS,
                   review_categories=C.SCOPE_REVIEW_CATEGORIES,
                   refinements=C.SCOPE_REFINEMENTS,
                   version: str = C.SCOPE_RULE_VERSION) -> DataFrame:
    """One row per lookup product with status, reason and rule version."""
    n_dept, n_cat, n_type = (label_norm("department"), label_norm("product_category"),
                             label_norm("product_type"))
    dept_in = F.coalesce(n_dept.isin(in_departments), F.lit(False))
    dept_out = F.coalesce(n_dept.isin(out_departments), F.lit(False))
    cat_review = F.coalesce(n_cat.isin(review_categories), F.lit(False))
    missing = _missing([n_dept, n_cat, n_type])
    # Last writer wins in C1..C4, so the most specific condition is tested first.
    status = (F.when(dept_in & missing, C.REVIEW)
              .when(dept_in & cat_review, C.REVIEW)
              .when(dept_in, C.IN_SCOPE)
              .when(dept_out, C.OUT_OF_SCOPE)
              .otherwise(C.REVIEW))
    reason = (F.when(dept_in & missing, C.REASON_MISSING_ATTR)
              .when(dept_in & cat_review, C.REASON_CATEGORY_REVIEW)
              .when(dept_in, C.REASON_DEPT_IN)
              .when(dept_out, C.REASON_DEPT_OUT)
              .otherwise(C.REASON_DEFAULT))
    base = products.select(*PRODUCT_COLUMNS, n_dept.alias("_d"), n_cat.alias("_c"),
                           n_type.alias("_t"), status.alias("_s0"), reason.alias("_r0"))
    rules = F.broadcast(refinement_rules(products.sparkSession, refinements))
    joined = base.join(rules, (base._d == rules.r_dept) & (base._c == rules.r_cat)
                       & (base._t == rules.r_type), "left")
    refine = (F.col("_s0") == C.REVIEW) & F.col("r_status").isNotNull()
    return joined.select(
        *PRODUCT_COLUMNS,
        F.when(refine, F.col("r_status")).otherwise(F.col("_s0")).alias("scope_status"),
        F.when(refine, F.col("r_reason")).otherwise(F.col("_r0")).alias("scope_reason"),
        F.lit(version).alias("scope_rule_version"),
    )


def refine_by_list(products: DataFrame, decisions: DataFrame, names: list[str]) -> DataFrame:
    """(product_id, rule, status, reason) of lookup products still in REVIEW, by the decision lists ``names`` in order.

    Labels are normalised before they are compared; a missing label fits only a wildcard.
    """
    spark = products.sparkSession
    rules = rule_table(spark, [r for n in names for r in C.DECISION_LISTS[n]], C.DECISION_ATTRIBUTES, ["status", "reason"])
    waiting = decisions.where((F.col("scope_status") == C.REVIEW) & (F.col("scope_reason") != C.REASON_MISSING_LOOKUP)).select("product_id")
    labels = [F.nullif(label_norm(c), F.lit("")).alias(c) for c in C.DECISION_ATTRIBUTES]
    rows = products.join(waiting, "product_id", "left_semi").select("product_id", *labels)
    return first_match(rows, "product_id", rules, C.DECISION_ATTRIBUTES, ["status", "reason"])


def write_scope_outputs(out: str, tx: DataFrame, decisions: DataFrame) -> DataFrame:
    """Write decisions, both summaries and the validation record under ``out``; (output, rows, digest) of each, read back.

    Decisions and summaries are CSV for readers of text, the record JSON; the digest is over the rows, whatever their order, so
    that a later reader can tell whether it has the same outputs.
    """
    spark = tx.sparkSession
    frames = {"decisions": decisions, "department_summary": scope_department_summary(decisions),
              "review_categories": scope_review_categories(decisions), "validation": validation_record(tx, decisions)}
    parts = []
    for name, df in frames.items():
        path = f"{out}/{name}"
        if name == "validation":
            df.write.mode("overwrite").json(path)
            back = spark.read.schema(df.schema).json(path)
        else:
            # NULL has a mark of its own and blanks stay, so that NULL, empty and blank texts are read back as they were
            kept = {"header": True, "nullValue": "\\N", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            df.write.mode("overwrite").options(**kept).csv(path)
            back = spark.read.schema(df.schema).options(**kept).csv(path)
        parts.append(digests.table_digests({name: (back, df.columns[:1], df.columns)}).where("level = 'table'")
                     .select(F.col("table_name").alias("output"), "rows", "digest"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_missing_lookup(decisions: DataFrame, tx: DataFrame,
                        version: str = C.SCOPE_RULE_VERSION) -> DataFrame:
    """Transaction product ids absent from the lookup become REVIEW rows.

    Both sides are one row a product, so they meet by a merge join at any size; no list of products is broadcast.
    """
    missing = (tx.select("product_id").distinct()
               .join(decisions.select("product_id").hint("merge"), "product_id", "left_anti")
               .select("product_id", F.lit(C.REVIEW).alias("scope_status"),
                       F.lit(C.REASON_MISSING_LOOKUP).alias("scope_reason"),
                       F.lit(version).alias("scope_rule_version")))
    return decisions.unionByName(missing, allowMissingColumns=True).select(*DECISION_COLUMNS)


def product_scope(products: DataFrame, tx: DataFrame, **rules) -> DataFrame:
    return with_missing_lookup(classify_scope(products, **rules), tx,
                               rules.get("version", C.SCOPE_RULE_VERSION))


def scope_join_guard(tx: DataFrame, decisions: DataFrame) -> DataFrame:
    """Many-to-one join keeps the row count and leaves no NULL status."""
    dup_right = decisions.groupBy("product_id").count().where("count > 1")
    joined = tx.join(decisions.select("product_id", "scope_status"), "product_id", "left")
    j = joined.agg(F.count(F.lit(1)).alias("joined_rows"),
                   F.count_if(F.col("scope_status").isNull()).alias("null_status_rows"))
    src = tx.agg(F.count(F.lit(1)).alias("source_rows"))
    d = dup_right.agg(F.count(F.lit(1)).alias("duplicate_decision_ids"))
    return _guard_row(src, j, d)


def _guard_row(src: DataFrame, j: DataFrame, d: DataFrame) -> DataFrame:
    from ..operators.aggregates import combine_rows
    row = combine_rows([src, j, d])
    ok = ((F.col("source_rows") == F.col("joined_rows")) & (F.col("null_status_rows") == 0)
          & (F.col("duplicate_decision_ids") == 0))
    return row.select("source_rows", "joined_rows", "null_status_rows", "duplicate_decision_ids",
                      F.when(ok, "PASS").otherwise("FAIL").alias("status"))


def scope_summary(tx: DataFrame, decisions: DataFrame) -> DataFrame:
    """C11: per status rows, products, sales, baskets, households, lookup products, shares.

    Distinct counts are computed per status, never added across statuses.
    """
    from ..functions.scalars import cents_long
    joined = tx.join(decisions.select("product_id", "scope_status"), "product_id", "left")
    per = joined.groupBy("scope_status").agg(
        F.count(F.lit(1)).alias("transaction_rows"),
        F.countDistinct("product_id").alias("transacting_products"),
        F.sum(cents_long("sales_value")).alias("sales_cents"),
        F.countDistinct("basket_id").alias("baskets"),
        F.countDistinct("household_id").alias("households"),
    )
    lookup = (decisions.where(F.col("scope_reason") != C.REASON_MISSING_LOOKUP)
              .groupBy("scope_status").agg(F.count(F.lit(1)).alias("lookup_products")))
    total_rows = tx.select(F.count(F.lit(1))).scalar()
    total_cents = tx.select(F.sum(cents_long("sales_value"))).scalar()
    return (per.join(lookup, "scope_status", "left")
            .select("scope_status", "transaction_rows", "transacting_products",
                    "sales_cents", "baskets", "households",
                    F.coalesce("lookup_products", F.lit(0)).cast("bigint").alias("lookup_products"),
                    (F.col("sales_cents").cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)")
                    .alias("sales_value"),
                    (F.col("transaction_rows").cast("double") * 100.0 / total_rows.cast("double"))
                    .alias("transaction_pct"),
                    (F.col("sales_cents").cast("double") * 100.0 / total_cents.cast("double"))
                    .alias("sales_pct")))


def scope_reconcile(tx: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows and cents over statuses equal the source totals."""
    from ..functions.scalars import cents_long
    from ..operators.aggregates import combine_rows
    s = scope_summary(tx, decisions).agg(F.sum("transaction_rows").alias("classified_rows"),
                                         F.sum("sales_cents").alias("classified_sales_cents"))
    src = tx.agg(F.count(F.lit(1)).alias("source_rows"),
                 F.sum(cents_long("sales_value")).alias("source_sales_cents"))
    row = combine_rows([src, s])
    return row.select(
        "source_rows", "classified_rows", "source_sales_cents", "classified_sales_cents",
        F.when(F.col("source_rows") == F.col("classified_rows"), "PASS").otherwise("FAIL")
        .alias("row_reconciliation"),
        F.when(F.col("source_sales_cents") == F.col("classified_sales_cents"), "PASS").otherwise("FAIL")
        .alias("sales_reconciliation"))


def scope_department_summary(decisions: DataFrame) -> DataFrame:
    """Lookup products per (department, status); NULL department kept."""
    return (decisions.where(F.col("scope_reason") != C.REASON_MISSING_LOOKUP)
            .groupBy("department", "scope_status").agg(F.count(F.lit(1)).alias("products")))


def scope_review_categories(decisions: DataFrame) -> DataFrame:
    """C14: REVIEW lookup products per (department, category, type, reason)."""
    return (decisions.where((F.col("scope_status") == C.REVIEW)
                            & (F.col("scope_reason") != C.REASON_MISSING_LOOKUP))
            .groupBy("department", "product_category", "product_type", "scope_reason")
            .agg(F.count(F.lit(1)).alias("products")))


def validation_record(tx: DataFrame, decisions: DataFrame,
                      version: str = C.SCOPE_RULE_VERSION) -> DataFrame:
    """The one-row validation record written beside the decisions."""
    from ..functions.scalars import cents_long
    spark = tx.sparkSession
    rec = scope_reconcile(tx, decisions)
    lookup = decisions.where(F.col("scope_reason") != C.REASON_MISSING_LOOKUP)
    return rec.select(
        F.lit(version).alias("rule_version"),
        F.col("source_rows"),
        lookup.select(F.count(F.lit(1))).scalar().alias("lookup_products"),
        decisions.where(F.col("scope_reason") == C.REASON_MISSING_LOOKUP)
                 .select(F.count(F.lit(1))).scalar().alias("missing_lookup_products"),
        F.col("source_sales_cents"),
        "row_reconciliation", "sales_reconciliation")

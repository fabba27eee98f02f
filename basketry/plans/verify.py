"""Warehouse verification: (metric, expected, actual, status) checks.

Row counts and wrong batches of a table share one aggregate pass; all 24 keys and 31 links of
the tables are reconciled in one stream with one exchange (``operators.reconcile``); contract rules are one pass
per table.  Expected values are parameters: the
reference freezes them as constants, here they are derived independently from
the source tables so the checks hold at any scale factor.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import local_date
from ..operators.aggregates import combine_rows
from ..operators.reconcile import reconcile
from ..session import stored
from .warehouse import Warehouse

V = "decimal(38,3)"
TABLES = ["dim_date", "dim_week", "dim_product", "dim_household", "dim_store", "dim_campaign", "dim_coupon",
          "bridge_campaign_household", "bridge_coupon_product", "fact_sales", "fact_promotion_weekly",
          "fact_coupon_redemption"]
# every check of the full report: 22 counts and batches, 8 of scope, 48 of keys, 6 contracts,
# 31 foreign keys, 11 sales totals, 2 of the calendar, 2 of promotions, 6 of the join, 2 of redemptions
VERIFY_CHECKS = 138
BATCH_TABLES = [t for t in TABLES if t not in ("dim_date", "dim_week")]
PRIMARY_KEYS = {
    "dim_date": ["date_key"], "dim_week": ["week_key"], "dim_product": ["product_key"],
    "dim_household": ["household_key"], "dim_store": ["store_key"], "dim_campaign": ["campaign_key"],
    "dim_coupon": ["coupon_key"], "bridge_campaign_household": ["campaign_key", "household_key"],
    "bridge_coupon_product": ["coupon_key", "product_key"], "fact_sales": ["basket_id", "product_key"],
    "fact_promotion_weekly": ["product_key", "store_key", "week_key"],
    "fact_coupon_redemption": ["household_key", "coupon_key", "campaign_key", "redemption_date_key"],
}
UNIQUE_KEYS = {
    "dim_date": ["full_date"], "dim_week": ["source_calendar_id", "source_week"], "dim_product": ["product_id"],
    "dim_household": ["household_id"], "dim_store": ["store_id"], "dim_campaign": ["campaign_id"],
    "dim_coupon": ["campaign_id", "coupon_upc"], "bridge_campaign_household": ["campaign_id", "household_id"],
    "bridge_coupon_product": ["campaign_id", "coupon_upc", "product_id"], "fact_sales": ["basket_id", "product_id"],
    "fact_promotion_weekly": ["product_id", "store_id", "week"],
    "fact_coupon_redemption": ["household_id", "coupon_upc", "campaign_id", "redemption_date"],
}

# (name, child, columns, parent, columns)
FOREIGN_KEYS = [
    ("fact_sales.product_key", "fact_sales", ["product_key"], "dim_product", ["product_key"]),
    ("fact_sales.household_key", "fact_sales", ["household_key"], "dim_household", ["household_key"]),
    ("fact_sales.store_key", "fact_sales", ["store_key"], "dim_store", ["store_key"]),
    ("fact_sales.date_key", "fact_sales", ["date_key"], "dim_date", ["date_key"]),
    ("fact_sales.week_key", "fact_sales", ["week_key"], "dim_week", ["week_key"]),
    ("fact_promotion_weekly.product_key", "fact_promotion_weekly", ["product_key"], "dim_product", ["product_key"]),
    ("fact_promotion_weekly.store_key", "fact_promotion_weekly", ["store_key"], "dim_store", ["store_key"]),
    ("fact_promotion_weekly.week_key", "fact_promotion_weekly", ["week_key"], "dim_week", ["week_key"]),
    ("fact_coupon_redemption.household_key", "fact_coupon_redemption", ["household_key"], "dim_household", ["household_key"]),
    ("fact_coupon_redemption.campaign_key", "fact_coupon_redemption", ["campaign_key"], "dim_campaign", ["campaign_key"]),
    ("fact_coupon_redemption.coupon_campaign", "fact_coupon_redemption", ["coupon_key", "campaign_key"], "dim_coupon", ["coupon_key", "campaign_key"]),
    ("fact_coupon_redemption.redemption_date_key", "fact_coupon_redemption", ["redemption_date_key"], "dim_date", ["date_key"]),
    ("dim_coupon.campaign", "dim_coupon", ["campaign_key", "campaign_id"], "dim_campaign", ["campaign_key", "campaign_id"]),
    ("bridge_campaign_household.campaign_key", "bridge_campaign_household", ["campaign_key"], "dim_campaign", ["campaign_key"]),
    ("bridge_campaign_household.household_key", "bridge_campaign_household", ["household_key"], "dim_household", ["household_key"]),
    ("bridge_coupon_product.coupon_key", "bridge_coupon_product", ["coupon_key"], "dim_coupon", ["coupon_key"]),
    ("bridge_coupon_product.product_key", "bridge_coupon_product", ["product_key"], "dim_product", ["product_key"]),
    ("dim_week.week_start_date", "dim_week", ["week_start_date"], "dim_date", ["full_date"]),
    ("dim_week.week_end_date", "dim_week", ["week_end_date"], "dim_date", ["full_date"]),
    ("dim_week.coverage_start_date", "dim_week", ["coverage_start_date"], "dim_date", ["full_date"]),
    ("dim_week.coverage_end_date", "dim_week", ["coverage_end_date"], "dim_date", ["full_date"]),
    *[(f"{t}.etl_batch_id", t, ["etl_batch_id"], "load_batches", ["etl_batch_id"]) for t in (
        "dim_product", "dim_household", "dim_store", "dim_campaign", "dim_coupon", "bridge_campaign_household",
        "bridge_coupon_product", "fact_sales", "fact_promotion_weekly", "fact_coupon_redemption")],
]


def _check_rows(wide: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    """Unpivot one wide row into (metric, expected, actual, status) rows.

    ``metrics`` is (metric, expected column, actual column)."""
    pairs = ", ".join(f"'{m}', CAST(`{e}` AS {V}), CAST(`{a}` AS {V})" for m, e, a in metrics)
    long = wide.selectExpr(f"stack({len(metrics)}, {pairs}) as (metric, expected, actual)")
    return long.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS")
                           .otherwise("FAIL"))


def _zeros(found: DataFrame) -> DataFrame:
    """Checks (metric, actual) that must be zero."""
    return found.select("metric", F.lit(0).cast(V).alias("expected"), F.col("actual").cast(V).alias("actual")).withColumn(
        "status", F.when(F.col("actual") == 0, "PASS").otherwise("FAIL"))


def _zero_checks(wide: DataFrame, names: list[str]) -> DataFrame:
    w = wide.withColumn("_zero", F.lit(0))
    return _check_rows(w, [(n, "_zero", n) for n in names])


class Verify:
    def __init__(self, wh: Warehouse):
        self.wh = wh
        self.report: DataFrame | None = None   # stored once all checks ran

    def t(self, name: str) -> DataFrame:
        return getattr(self.wh, name)

    # --- expected row counts derived from the sources ---------------------------------
    def expected_rows(self) -> dict[str, Column]:
        s, wh = self.wh.src, self.wh
        n = lambda df: df.select(F.count(F.lit(1))).scalar()
        ids = lambda frames, k: reduce(lambda a, b: a.unionByName(b),
                                       [f.select(k) for f in frames]).distinct()
        ld = s.transactions.select(local_date("transaction_timestamp").alias("d"))
        bounds = reduce(lambda a, b: a.unionByName(b), [
            ld.select(F.col("d").alias("lo"), F.col("d").alias("hi")),
            s.campaign_descriptions.select(F.col("start_date").alias("lo"), F.col("end_date").alias("hi")),
            s.coupon_redemptions.select(F.col("redemption_date").alias("lo"), F.col("redemption_date").alias("hi")),
            wh.dim_week.select(F.col("week_start_date").alias("lo"), F.col("week_end_date").alias("hi"))])
        days = bounds.select((F.datediff(F.max("hi"), F.min("lo")) + 1).cast("bigint")).scalar()
        in_scope = wh.in_scope_ids
        return {
            "dim_date": days,
            "dim_week": F.lit(C.CALENDAR_WEEKS).cast("bigint"),
            "dim_product": n(ids([s.products, s.transactions, s.promotions, s.coupons], "product_id")),
            "dim_household": n(ids([s.demographics, s.transactions, s.campaigns, s.coupon_redemptions],
                                   "household_id")),
            "dim_store": n(ids([s.transactions, s.promotions], "store_id")),
            "dim_campaign": n(s.campaign_descriptions.select("campaign_id").distinct()),
            "dim_coupon": n(s.coupons.select("campaign_id", "coupon_upc").distinct()),
            "bridge_campaign_household": n(s.campaigns.distinct()),
            "bridge_coupon_product": n(s.coupons.distinct()),
            "fact_sales": n(s.transactions.join(in_scope, "product_id", "left_semi")),
            "fact_promotion_weekly": n(s.promotions.join(in_scope, "product_id", "left_semi")
                                       .select("product_id", "store_id", "week").distinct()),
            "fact_coupon_redemption": n(wh.valid_redemptions),
        }

    def row_counts(self) -> DataFrame:
        """12 row counts + 10 wrong-batch counts, one pass per table."""
        exp = self.expected_rows()
        parts = []
        for name in TABLES:
            df = self.t(name)
            aggs = [F.count(F.lit(1)).alias("actual"), exp[name].alias("expected")]
            metrics = [(f"{name}.row_count", "expected", "actual")]
            if name in BATCH_TABLES:
                aggs.append(F.count_if(~F.col("etl_batch_id").eqNullSafe(F.lit(C.BATCH_ID))).alias("wrong"))
                aggs.append(F.lit(0).alias("zero"))
                metrics.append((f"{name}.wrong_batch", "zero", "wrong"))
            parts.append(_check_rows(df.agg(*aggs), metrics))
        return reduce(lambda a, b: a.unionByName(b), parts)

    def scope(self) -> DataFrame:
        wh = self.wh
        dec = wh.product_scope.select("product_id", F.col("scope_status").alias("_csv_status"),
                                      F.col("scope_rule_version").alias("_csv_version"))
        dp = wh.dim_product.join(dec, "product_id", "left")
        extra = F.col("_csv_status").isNull()
        a = dp.agg(
            F.count_if(~extra & ~F.col("scope_status").eqNullSafe(F.col("_csv_status"))).alias("product.scope_vs_csv"),
            F.count_if(extra).alias("product.extra_codes"),
            F.count_if(extra & ~((F.col("scope_status") == C.REVIEW) & F.col("source_lookup_missing_flag")))
             .alias("product.invalid_extra_codes"),
            F.count_if(~F.col("scope_rule_version").eqNullSafe(F.col("_csv_version")) & ~extra).alias("dim_product.wrong_scope_version"))
        s = wh.src
        promo_only = (s.promotions.select("product_id").unionByName(s.coupons.select("product_id")).distinct()
                      .join(s.products.select("product_id"), "product_id", "left_anti")
                      .join(s.transactions.select("product_id"), "product_id", "left_anti"))
        expected_extra = promo_only.select(F.count(F.lit(1))).scalar()
        a = a.select("*", expected_extra.alias("_expected_extra"), F.lit(0).alias("_zero"))
        out = _check_rows(a, [("product.scope_vs_csv", "_zero", "product.scope_vs_csv"),
                              ("product.extra_codes", "_expected_extra", "product.extra_codes"),
                              ("product.invalid_extra_codes", "_zero", "product.invalid_extra_codes"),
                              ("dim_product.wrong_scope_version", "_zero", "dim_product.wrong_scope_version")])
        status = wh.dim_product.select("product_key", F.col("scope_status").alias("_dim_status"),
                                       F.col("source_lookup_missing_flag").alias("_missing"))
        for fact in ["fact_sales", "fact_promotion_weekly"]:
            f = self.t(fact).join(status, "product_key", "left").join(dec, "product_id", "left")
            w = f.agg(F.count_if(~F.col("scope_rule_version").eqNullSafe(F.col("_csv_version"))).alias("v"),
                      F.count_if(~F.coalesce((F.col("_dim_status") == C.IN_SCOPE)
                                             & (F.col("_csv_status") == C.IN_SCOPE)
                                             & ~F.col("_missing"), F.lit(False))).alias("i"))
            out = out.unionByName(_zero_checks(w.withColumnsRenamed(
                {"v": f"{fact}.wrong_scope_version", "i": f"{fact}.invalid_scope"}),
                [f"{fact}.wrong_scope_version", f"{fact}.invalid_scope"]))
        return out

    @cached_property
    def reconciled(self) -> DataFrame:
        """All keys and links of all tables, reconciled in one stream and stored."""
        keys = [(f"{t}.{kind}", t, cols[t]) for t in TABLES for kind, cols in (("pk", PRIMARY_KEYS), ("uk", UNIQUE_KEYS))]
        tables = {t: self.t(t) for t in dict.fromkeys([*TABLES, *[x for _, c, _, p, _ in FOREIGN_KEYS for x in (c, p)]])}
        return stored(reconcile(tables, keys, FOREIGN_KEYS), "reconciled-keys")

    def keys(self) -> DataFrame:
        """Primary / unique keys: no NULL, no duplicate; plus the table contracts."""
        both = F.explode(F.array(F.struct(F.lit("_null").alias("what"), F.col("null_rows").alias("n")),
                                 F.struct(F.lit("_duplicate").alias("what"), F.col("duplicate_keys").alias("n")))).alias("c")
        found = self.reconciled.where("kind = 'key'").select("name", both)
        return _zeros(found.select(F.concat("name", "c.what").alias("metric"), F.col("c.n").alias("actual"))).unionByName(self.contracts())

    def contracts(self) -> DataFrame:
        wh = self.wh
        d = F.col("full_date")
        date_bad = ((F.col("date_key") != F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d))
                    | (F.col("day_of_month") != F.dayofmonth(d)) | (F.col("month_number") != F.month(d))
                    | (F.col("quarter_number") != F.quarter(d)) | (F.col("calendar_year") != F.year(d))
                    | (F.col("day_of_week") != F.weekday(d) + 1))
        ws, we = F.col("week_start_date"), F.col("week_end_date")
        cs, ce = F.col("coverage_start_date"), F.col("coverage_end_date")
        week_bad = ((F.weekday(ws) != 0) | (we != F.date_add(ws, 6)) | (cs < ws) | (ce > we) | (cs > ce)
                    | (F.col("is_partial_coverage") != ((F.datediff(ce, cs) + 1) < 7)))
        parts = [
            wh.dim_date.agg(F.count_if(date_bad).alias("dim_date.date_parts")),
            wh.dim_week.agg(F.count_if(week_bad).alias("dim_week.week_shape")),
            wh.dim_campaign.agg(F.count_if((F.col("start_date") > F.col("end_date"))
                                           | (F.btrim("campaign_type") == "")).alias("dim_campaign.dates_type")),
            wh.dim_product.agg(F.count_if(F.col("source_lookup_missing_flag") & (F.col("scope_status") != C.REVIEW))
                               .alias("dim_product.review_rule")),
            wh.fact_promotion_weekly.agg(F.count_if(~F.col("promotion_code_unknown_flag") & (
                F.col("has_display").isNull() | F.col("has_mailer").isNull())).alias("fact_promotion_weekly.null_flag_rule")),
            wh.fact_coupon_redemption.agg(F.count_if(F.col("redemption_record_count") != 1)
                                          .alias("fact_coupon_redemption.record_count")),
        ]
        return reduce(lambda a, b: a.unionByName(b), [_zero_checks(p, p.columns) for p in parts])

    def foreign_keys(self) -> DataFrame:
        found = self.reconciled.where("kind = 'link'")
        return _zeros(found.select(F.concat(F.lit("fk."), "name").alias("metric"), F.col("orphan_rows").alias("actual")))

    def sales_totals(self) -> DataFrame:
        wh = self.wh
        src = wh.src.transactions.join(wh.in_scope_ids, "product_id", "left_semi")
        measures = ["quantity", *C.MONEY]
        s = src.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures])
        f = wh.fact_sales.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(m).alias(m) for m in measures])
        # the baseline comes from the source lines before they were brought to the fact's grain
        b = (wh.src.transactions_raw.join(wh.in_scope_ids, "product_id", "left_semi")
             .agg(*[F.sum(m).alias(f"b_{m}") for m in measures]))
        w = combine_rows([b, s.select(*[F.col(c).alias(f"s_{c}") for c in s.columns]),
                          f.select(*[F.col(c).alias(f"f_{c}") for c in f.columns])])
        metrics = [("sales.source_vs_target_rows", "s_rows", "f_rows")]
        metrics += [(f"sales.source_vs_target.{m}", f"s_{m}", f"f_{m}") for m in measures]
        metrics += [(f"sales.baseline.{m}", f"b_{m}", f"f_{m}") for m in measures]
        return _check_rows(w, metrics)

    def calendar(self) -> DataFrame:
        """Fact dates inside their week, and the weeks of the source lines inside the calendar week of their number."""
        wh = self.wh
        f = wh.fact_sales.join(wh.dim_date.select("date_key", "full_date"), "date_key", "left") \
            .join(F.broadcast(wh.dim_week.select("week_key", "coverage_start_date", "coverage_end_date")),
                  "week_key", "left")
        bad = f.agg(F.count_if(~F.coalesce(F.col("full_date").between(F.col("coverage_start_date"),
                                                                      F.col("coverage_end_date")), F.lit(False)))
                    .alias("sales.date_week_mapping"))
        seen = (wh.src.transactions_raw.select("week", local_date("transaction_timestamp").alias("d"))
                .groupBy("week").agg(F.min("d").alias("lo"), F.max("d").alias("hi")))
        weeks = wh.dim_week.select(F.col("source_week").alias("week"), "coverage_start_date", "coverage_end_date")
        outside = seen.join(weeks, "week", "left").agg(F.count_if(~F.coalesce(
            (F.col("lo") >= F.col("coverage_start_date")) & (F.col("hi") <= F.col("coverage_end_date")), F.lit(False)))
            .alias("week.calendar_mapping"))
        return _zero_checks(combine_rows([bad, outside]), ["sales.date_week_mapping", "week.calendar_mapping"])

    def promotion_rows(self) -> DataFrame:
        wh = self.wh
        src = wh.src.promotions.join(wh.in_scope_ids, "product_id", "left_semi")
        n_src = src.select(F.count(F.lit(1))).scalar()
        w = wh.fact_promotion_weekly.agg(F.sum("source_row_count").alias("represented"),
                                         F.count(F.lit(1)).alias("groups"))
        groups = src.select("product_id", "store_id", "week").distinct().select(F.count(F.lit(1))).scalar()
        w = w.select("*", n_src.alias("source_rows"), groups.alias("source_groups"))
        return _check_rows(w, [("promotion.represented_source_rows", "source_rows", "represented"),
                               ("promotion.source_baseline", "source_groups", "groups")])

    def join_no_fanout(self) -> DataFrame:
        wh = self.wh
        s = wh.fact_sales
        p = wh.fact_promotion_weekly.select("product_key", "store_key", "week_key")
        measures = ["quantity", *C.MONEY]
        j = s.join(p, ["product_key", "store_key", "week_key"], "left")
        a = s.agg(F.count(F.lit(1)).alias("l_rows"), *[F.sum(m).alias(f"l_{m}") for m in measures])
        b = j.agg(F.count(F.lit(1)).alias("j_rows"), *[F.sum(m).alias(f"j_{m}") for m in measures])
        w = combine_rows([a, b])
        return _check_rows(w, [("sales_promotion.join_rows", "l_rows", "j_rows")]
                           + [(f"sales_promotion.{m}", f"l_{m}", f"j_{m}") for m in measures])

    def redemptions(self) -> DataFrame:
        wh = self.wh
        f = wh.fact_coupon_redemption
        camp = wh.dim_campaign.select("campaign_key", "start_date", "end_date")
        bad = f.join(camp, "campaign_key", "left").agg(
            F.count(F.lit(1)).alias("target"),
            F.count_if(F.col("household_key").isNull() | F.col("coupon_key").isNull() | F.col("campaign_key").isNull()
                       | ~F.coalesce(F.col("redemption_date").between(F.col("start_date"), F.col("end_date")),
                                     F.lit(False))).alias("invalid"))
        src = wh.src.coupon_redemptions_raw.agg(F.count(F.lit(1)).alias("source"))
        rejected = wh.redemption_rejects.agg(F.count(F.lit(1)).alias("rejected"))
        w = combine_rows([bad, src, rejected]).withColumns({"balance": F.col("target") + F.col("rejected"), "zero": F.lit(0)})
        return _check_rows(w, [("redemption.source_vs_loaded_and_rejected", "source", "balance"),
                               ("redemption.invalid_links_dates", "zero", "invalid")])


def summary(report: DataFrame) -> DataFrame:
    """One summary row: checks, passed, failed and the verdict."""
    return report.agg(F.count(F.lit(1)).alias("checks"),
                      F.count_if(F.col("status") == "PASS").alias("passed"),
                      F.count_if(F.col("status") != "PASS").alias("failed")).withColumn(
        "verdict", F.when(F.col("failed") == 0, "PASS").otherwise("FAIL"))

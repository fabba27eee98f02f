"""Dimensions, bridges and facts.

Every builder returns the *expected* table as a lazy DataFrame.  Lookups of
business ids to surrogate keys are left joins against dimensions; dimensions are
one row per business id (orders of magnitude smaller than facts), and AQE turns
those joins of facts into broadcast joins from runtime sizes, or keeps a skew-split
sort-merge join when a dimension is large.  Where both sides are of a dimension's
size (dimensions, bridges, redemptions) they meet by a sort-merge join at any size:
one shuffle of a few columns, and no product or household goes through the driver.
Facts aggregate before joining.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import (btrim_null, date_key, in_codes, in_whole_cents, local_date, money, sales_flags,
                                 to_cents, unknown_code)
from ..operators.joins import in_any_period
from ..operators.keys import assign_keys
from ..operators.load import load_insert_only, load_without_rejects, publish, read_current
from .calendar import date_bounds, dim_date, expected_weeks
from ..session import shared_path, stored, write_stage
from .context import Sources, sources
from .distinct import basket_keys, daily_sets
from .scope import product_scope, scope_summary, validation_record


def normalized(df: DataFrame, table: str) -> DataFrame:
    """B1 on the descriptive attributes of a staged table; ids untouched."""
    desc = set(C.DESCRIPTIONS.get(table, []))
    return df.select(*[btrim_null(c).alias(c) if c in desc else F.col(c) for c in df.columns])


def id_hub(frames: list[DataFrame], key: str) -> DataFrame:
    """UNION (distinct) of one key over many sources (each side pre-distincted)."""
    parts = [f.select(key).distinct() for f in frames]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


class Warehouse:
    """All warehouse tables for one source folder.

    Derived tables that many queries read (scope decisions, dimensions, bridges,
    facts) are written once as Parquet under the shared checkpoint folder and
    read back: later queries scan the stored table (with column pruning and
    filter push-down) instead of re-deriving it, and lineage is cut, so a lost
    executor re-reads a file instead of recomputing the whole chain.  Set
    ``basketry.materialize=false`` to keep everything as one lazy plan.
    """

    def __init__(self, src: Sources):
        self.src = src
        self.spark = src.spark
        self._base = None

    def _store(self, name: str, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        if self.spark.conf.get("basketry.materialize", "true").lower() == "false":
            return df
        if self._base is None:
            self._base = shared_path(self.spark, "basketry-wh")
        path = f"{self._base}/{name}"
        return write_stage(df, path, by)

    # --- normalised sources ------------------------------------------------
    def q(self, table: str) -> DataFrame:
        return normalized(self.src.source(table), table)

    # --- scope ---------------------------------------------------------------
    @cached_property
    def product_scope(self) -> DataFrame:
        return self._store("product_scope", product_scope(self.src.products, self.src.transactions))

    @cached_property
    def validation_record(self) -> DataFrame:
        """What the classification saw, stored when it is first asked for; later checks compare with it."""
        return self._store("validation_record", validation_record(self.src.transactions, self.product_scope))

    @cached_property
    def scope_summary_record(self) -> DataFrame:
        """C11 as stored beside the validation record."""
        return self._store("scope_summary", scope_summary(self.src.transactions, self.product_scope))

    @cached_property
    def in_scope_ids(self) -> DataFrame:
        return self.product_scope.where(F.col("scope_status") == C.IN_SCOPE).select("product_id")

    # --- calendar ------------------------------------------------------------
    @cached_property
    def dim_week(self) -> DataFrame:
        return expected_weeks(self.spark)

    @cached_property
    def dim_date(self) -> DataFrame:
        return self._store("dim_date", dim_date(self.date_bounds))

    @cached_property
    def date_bounds(self) -> DataFrame:
        return date_bounds(self.src.transactions, self.src.campaign_descriptions,
                           self.src.coupon_redemptions, self.dim_week)

    # --- dimensions ------------------------------------------------------------
    @cached_property
    def dim_product(self) -> DataFrame:
        """H5: ids from products, transactions, promotions, coupons; REVIEW if no lookup."""
        s = self.src
        ids = id_hub([s.products, s.transactions, s.promotions, s.coupons], "product_id")
        lookup = self.q("products").distinct()
        scope = self.product_scope.select("product_id", "scope_status", "scope_rule_version")
        j = (ids.join(lookup.withColumn("_hit", F.lit(True)).hint("merge"), "product_id", "left")
             .join(scope.hint("merge"), "product_id", "left"))
        missing = F.col("_hit").isNull()
        expected = j.select(
            "product_id", "manufacturer_id", "department", "brand", "product_category",
            "product_type", "package_size",
            F.when(missing, F.lit(C.REVIEW)).otherwise(F.coalesce("scope_status", F.lit(C.REVIEW)))
             .alias("scope_status"),
            F.lit(C.SCOPE_RULE_VERSION).alias("scope_rule_version"),
            missing.alias("source_lookup_missing_flag"),
            F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id"))
        return self._store("dim_product", assign_keys(expected, "product_id", "product_key"))

    @cached_property
    def dim_household(self) -> DataFrame:
        """H6: ids from demographics, transactions, campaigns, redemptions."""
        s = self.src
        ids = id_hub([s.demographics, s.transactions, s.campaigns, s.coupon_redemptions],
                     "household_id")
        demo = self.q("demographics").distinct().withColumn("_hit", F.lit(True))
        j = ids.join(demo.hint("merge"), "household_id", "left")
        expected = j.select("household_id", *C.DESCRIPTIONS["demographics"],
                            F.col("_hit").isNotNull().alias("demographics_available_flag"),
                            F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id"))
        return self._store("dim_household", assign_keys(expected, "household_id", "household_key"))

    @cached_property
    def dim_store(self) -> DataFrame:
        """H7: store ids from transactions and promotions."""
        ids = id_hub([self.src.transactions, self.src.promotions], "store_id")
        return self._store("dim_store", assign_keys(ids.withColumn("etl_batch_id", F.lit(C.BATCH_ID).cast("bigint")),
                           "store_id", "store_key"))

    @cached_property
    def dim_campaign(self) -> DataFrame:
        """H8: distinct descriptions, one row per campaign id."""
        d = self.q("campaign_descriptions").distinct()
        return self._store("dim_campaign", assign_keys(d.withColumn("etl_batch_id", F.lit(C.BATCH_ID).cast("bigint")),
                           "campaign_id", "campaign_key"))

    @cached_property
    def dim_coupon(self) -> DataFrame:
        """H9: distinct (campaign_id, coupon_upc) with the campaign key."""
        pairs = self.src.coupons.select("campaign_id", "coupon_upc").distinct()
        camp = self.dim_campaign.select("campaign_id", "campaign_key")
        j = pairs.join(camp, "campaign_id", "left").withColumn(
            "etl_batch_id", F.lit(C.BATCH_ID).cast("bigint"))
        return self._store("dim_coupon", assign_keys(j, ["campaign_id", "coupon_upc"], "coupon_key"))

    @cached_property
    def load_batches(self) -> DataFrame:
        """The batches that the staged sources belong to."""
        return self.src.products.select(F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id")).distinct()

    # --- bridges -------------------------------------------------------------------

    @cached_property
    def bridge_campaign_household(self) -> DataFrame:
        """Distinct pairs mapped to keys."""
        pairs = self.src.campaigns.select("campaign_id", "household_id").distinct()
        return self._store("bridge_campaign_household", (pairs.join(self.dim_campaign.select("campaign_id", "campaign_key"), "campaign_id", "left")
                .join(self.dim_household.select("household_id", "household_key").hint("merge"), "household_id", "left")
                .select("campaign_id", "household_id", "campaign_key", "household_key",
                        F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id"))))

    @cached_property
    def bridge_coupon_product(self) -> DataFrame:
        """Distinct (campaign, coupon, product) -> (coupon_key, product_key)."""
        triples = self.src.coupons.select("campaign_id", "coupon_upc", "product_id").distinct()
        return self._store("bridge_coupon_product", (triples.join(self.dim_coupon.select("campaign_id", "coupon_upc", "coupon_key"),
                             ["campaign_id", "coupon_upc"], "left")
                .join(self.dim_product.select("product_id", "product_key").hint("merge"), "product_id", "left")
                .select("campaign_id", "coupon_upc", "product_id", "coupon_key", "product_key",
                        F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id"))))

    # --- facts -------------------------------------------------------------------------

    @cached_property
    def sales_in_scope(self) -> DataFrame:
        """D1 + B5 + B7: in-scope transaction lines with cent-normalised money."""
        return self._store("sales_in_scope", self.sales_lines(self.in_scope_ids))

    def sales_lines(self, products: DataFrame | None = None) -> DataFrame:
        """Transaction lines, of some products if given, with cent-normalised money and local date."""
        tx = self.src.transactions
        tx = tx if products is None else tx.join(products, "product_id", "left_semi")
        return tx.select(
            "basket_id", "product_id", "household_id", "store_id", "week",
            "transaction_timestamp",
            F.col("quantity").cast("decimal(18,3)").alias("quantity"),
            *[(F.col(m).cast("decimal(18,2)") if in_whole_cents(tx.schema[m].dataType) else money(to_cents(m))).alias(m) for m in C.MONEY],
            local_date("transaction_timestamp").alias("local_date"))

    @cached_property
    def daily_sets(self) -> DataFrame:
        """Bitmaps of baskets, households, stores and products of each day, in scope and out, with sums; one pass over the lines."""
        lines = self.sales_lines()
        keyed = (lines.join(basket_keys(lines), "basket_id", "left")
                 .join(self.dim_household.select("household_id", "household_key"), "household_id", "left")
                 .join(self.dim_store.select("store_id", "store_key"), "store_id", "left")
                 .join(self.dim_product.select("product_id", "product_key"), "product_id", "left")
                 .join(self.in_scope_ids.withColumn("in_scope", F.lit(True)), "product_id", "left")
                 .withColumn("in_scope", F.coalesce("in_scope", F.lit(False))))
        priced = (F.col("quantity") > 0) & (F.col("sales_value") >= 0)
        sums = {"sales_value": F.col("sales_value"), "quantity": F.col("quantity"), "priced_sales": F.when(priced, F.col("sales_value")),
                "priced_quantity": F.when(priced, F.col("quantity"))}
        kinds = {"basket": "basket_key", "household": "household_key", "store": "store_key", "product": "product_key"}
        return self._store("daily_sets", daily_sets(keyed, kinds, ["local_date", "week", "in_scope"], sums))

    @cached_property
    def fact_sales(self) -> DataFrame:
        """In-scope lines -> product, household, store, date, week keys + flags; partitioned by week."""
        return self._store("fact_sales", self.fact_sales_rows(self.sales_in_scope), ["week_key"])

    def fact_sales_rows(self, s: DataFrame) -> DataFrame:
        """Fact rows of sales lines."""
        wk = self.dim_week.select("week_key", "source_week", "coverage_start_date", "coverage_end_date")
        # Equi-join on the source week plus a range residual on the coverage.
        j = (s.join(F.broadcast(wk), (s.week == wk.source_week)
                    & s.local_date.between(wk.coverage_start_date, wk.coverage_end_date), "left")
             .join(self.dim_product.select("product_id", "product_key"), "product_id", "left")
             .join(self.dim_household.select("household_id", "household_key"), "household_id", "left")
             .join(self.dim_store.select("store_id", "store_key"), "store_id", "left"))
        return j.select(
            "basket_id", "product_id", "household_id", "store_id",
            "product_key", "household_key", "store_key",
            date_key("local_date").alias("date_key"), "week_key", "transaction_timestamp",
            "quantity", *C.MONEY, *sales_flags(C.HIGH_QUANTITY),
            F.lit(C.SCOPE_RULE_VERSION).alias("scope_rule_version"),
            F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id"))

    @cached_property
    def promotion_grouped(self) -> DataFrame:
        """H14 first half: aggregate in-scope promotions to product-store-week.

        Aggregating before the key joins shrinks the join input (Catalyst does
        not push aggregates below joins, so the order is set here).
        """
        p = self.src.promotions.join(self.in_scope_ids, "product_id", "left_semi")
        d, m = F.col("display_location"), F.col("mailer_location")
        d_unknown, m_unknown = unknown_code(d, C.DISPLAY_KNOWN), unknown_code(m, C.MAILER_KNOWN)
        return self._store("promotion_grouped", p.groupBy("product_id", "store_id", "week").agg(
            tristate(in_codes(d, C.DISPLAY_SUPPORT), d_unknown).alias("has_display"),
            tristate(in_codes(m, C.MAILER_SUPPORT), m_unknown).alias("has_mailer"),
            F.array_sort(F.collect_set(d)).alias("display_location_codes"),
            F.array_sort(F.collect_set(m)).alias("mailer_location_codes"),
            F.count(F.lit(1)).alias("source_row_count"),
            F.bool_or(d_unknown | m_unknown).alias("promotion_code_unknown_flag")))

    @cached_property
    def fact_promotion_weekly(self) -> DataFrame:
        g = self.promotion_grouped
        wk = self.dim_week.select("week_key", "source_week")
        j = (g.join(F.broadcast(wk), g.week == wk.source_week, "left")
             .join(self.dim_product.select("product_id", "product_key"), "product_id", "left")
             .join(self.dim_store.select("store_id", "store_key"), "store_id", "left"))
        return self._store("fact_promotion_weekly", j.select(
            "product_id", "store_id", "week", "product_key", "store_key", "week_key",
            "has_display", "has_mailer", "display_location_codes", "mailer_location_codes",
            "source_row_count", (F.col("source_row_count") > 1).alias("multiple_source_rows_flag"),
            "promotion_code_unknown_flag",
            F.lit(C.SCOPE_RULE_VERSION).alias("scope_rule_version"),
            F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id")), ["week_key"])

    @cached_property
    def redemptions_checked(self) -> DataFrame:
        """Every source redemption with the reasons that keep it out of the fact ('' if none).

        Household assigned to the campaign, coupon in the campaign, date inside the
        campaign, and no earlier row of the same grain.  Rows are neither dropped nor
        merged here.  The copies of a grain are told apart without ordering them.
        """
        grain = C.REDEMPTION_GRAIN
        r = self.src.coupon_redemptions_raw.groupBy(*grain).agg(F.count(F.lit(1)).alias("_copies"))
        pairs_hh = self.src.campaigns.select("campaign_id", "household_id").distinct().withColumn("_hh", F.lit(True))
        pairs_cp = self.src.coupons.select("campaign_id", "coupon_upc").distinct().withColumn("_cp", F.lit(True))
        j = r.join(pairs_hh, ["campaign_id", "household_id"], "left").join(pairs_cp, ["campaign_id", "coupon_upc"], "left")
        j = in_any_period(j, self.q("campaign_descriptions"), "campaign_id", "redemption_date", "start_date", "end_date", "_inside")
        inside = F.col("_inside")
        j = j.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
        reason = F.concat_ws("; ", F.when(F.col("_hh").isNull(), "household not in campaign"),
                             F.when(F.col("_cp").isNull(), "coupon not in campaign"),
                             F.when(~F.coalesce(inside, F.lit(False)), "date outside campaign"),
                             F.when(F.col("_copy") > 1, "repeated row"))
        return self._store("redemptions_checked", j.select(*grain, reason.alias("reject_reason")))

    @cached_property
    def valid_redemptions(self) -> DataFrame:
        return self.redemptions_checked.where(F.col("reject_reason") == "").drop("reject_reason")

    @cached_property
    def redemption_rejects(self) -> DataFrame:
        """Source redemptions that are not loaded, with their reasons."""
        return self.redemptions_checked.where(F.col("reject_reason") != "")

    @cached_property
    def fact_coupon_redemption(self) -> DataFrame:
        """Valid redemptions -> household, coupon, campaign, date keys; count 1.

        A reject for a reason that is not accepted by configuration stops the load: nothing is written.
        """
        r = load_without_rejects(self.redemptions_checked, "reject_reason", "fact_coupon_redemption", C.ACCEPTED_REJECTS)
        j = (r.join(self.dim_household.select("household_id", "household_key").hint("merge"), "household_id", "left")
             .join(self.dim_coupon.select("campaign_id", "coupon_upc", "coupon_key", "campaign_key"),
                   ["campaign_id", "coupon_upc"], "left"))
        return self._store("fact_coupon_redemption", j.select(
            "household_id", "coupon_upc", "campaign_id", "redemption_date",
            "household_key", "coupon_key", "campaign_key",
            date_key("redemption_date").alias("redemption_date_key"),
            F.lit(1).cast("smallint").alias("redemption_record_count"),
            F.lit(C.BATCH_ID).cast("bigint").alias("etl_batch_id")))


# (table, business key, attribute columns, surrogate key column)
DIMENSIONS = [
    ("dim_product", ["product_id"], ["manufacturer_id", "department", "brand", "product_category", "product_type",
                                     "package_size", "scope_status", "scope_rule_version",
                                     "source_lookup_missing_flag"], "product_key"),
    ("dim_household", ["household_id"], C.DESCRIPTIONS["demographics"] + ["demographics_available_flag"],
     "household_key"),
    ("dim_store", ["store_id"], [], "store_key"),
    ("dim_campaign", ["campaign_id"], ["campaign_type", "start_date", "end_date"], "campaign_key"),
    ("dim_coupon", ["campaign_id", "coupon_upc"], ["campaign_key"], "coupon_key"),
    ("dim_week", ["source_calendar_id", "source_week"], ["week_start_date", "week_end_date",
                                                          "coverage_start_date", "coverage_end_date",
                                                          "is_partial_coverage"], "week_key"),
    ("dim_date", ["full_date"], ["date_key", "day_of_month", "month_number", "quarter_number",
                                 "calendar_year", "day_of_week"], None),
]


def load_dimensions(spark, base: str, expected: dict[str, DataFrame]) -> DataFrame:
    """Load dimensions into the published set under ``base``, insert-only; returns (table_name, rows_before, rows_after).

    Each is merged with what is published (nothing at first) and guarded: an existing row that differs, or is no longer
    expected, stops the load of all of them (``LoadBlocked``), and the published set stays as it was.
    """
    try:
        published = {name: read_current(spark, base, name) for name in expected}
    except FileNotFoundError:
        published = {}
    merged, counts = {}, []
    for name, key, attrs, key_col in DIMENSIONS:
        if name not in expected:
            continue
        df = expected[name]
        target = published.get(name, df.select(*key, *attrs, *([key_col] if key_col else [])).limit(0))
        merged[name] = stored(load_insert_only(target, df, key, key + attrs, key_col, name), f"load-{name}")
        n = lambda t: t.select(F.count(F.lit(1))).scalar()
        counts.append((name, n(target), n(merged[name])))
    checks = spark.createDataFrame([("load", "PASS")], "metric string, status string")     # the guards have passed
    publish(spark, merged, base, checks)
    return reduce(lambda a, b: a.unionByName(b), [spark.range(1).select(F.lit(t).alias("table_name"), b.alias("rows_before"), a.alias("rows_after"))
                                                  for t, b, a in counts])


def tristate(yes, unknown) -> "F.Column":
    """Any supporting code -> TRUE; else any unknown -> NULL; else FALSE."""
    return (F.when(F.bool_or(yes), F.lit(True))
            .when(F.bool_or(unknown), F.lit(None).cast("boolean"))
            .otherwise(F.lit(False)))


_WH: dict[int, tuple[Sources, Warehouse]] = {}


def warehouse(spark, sf_dir: str) -> Warehouse:
    """One warehouse for each staged set of sources."""
    src = sources(spark, sf_dir)
    if id(src) not in _WH:
        _WH[id(src)] = src, Warehouse(src)
    return _WH[id(src)][1]

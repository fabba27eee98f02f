"""Mutation tests: inject one bad row into a staged source; exactly the rule(s)
meant to catch it must react, through the fused report and through the
single-rule issue query alike."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry import config as C
from basketry.plans.context import Sources
from basketry.plans.quality import Quality
from basketry.plans.warehouse import Warehouse

from .conftest import SMALL

NAMES = ["transactions_raw", "transactions", "promotions", "products", "demographics", "campaigns",
         "campaign_descriptions", "coupons", "coupon_redemptions_raw", "coupon_redemptions"]


@pytest.fixture(scope="module")
def base(spark):
    src = Sources(spark, SMALL)
    for n in NAMES:
        src.source(n)
    return src


def counts(q: Quality) -> dict[str, int]:
    return {r.rule_code.removeprefix(C.DQ_PREFIX): r.affected_rows for r in q.report().collect()}


@pytest.fixture(scope="module")
def baseline(base):
    return counts(Quality(Warehouse(base)))


def mutate(spark, base, table, rows_df):
    src = Sources(spark, SMALL)
    for n in NAMES:
        src.__dict__[n] = base.source(n)
    name = {"transactions": "transactions_raw", "coupon_redemptions": "coupon_redemptions_raw"}.get(table, table)
    src.__dict__[name] = base.source(name).unionByName(rows_df, allowMissingColumns=False)
    return Quality(Warehouse(src))


def clean_tx(spark, base, in_scope: bool):
    """A fresh raw transaction line that no rule flags: known household with
    demographics, known product of the wanted scope, clean money, new basket."""
    wh = Warehouse(base)
    status = C.IN_SCOPE if in_scope else C.OUT_OF_SCOPE
    pid = (wh.product_scope.where((F.col("scope_status") == status)
                                  & (F.col("scope_reason") != C.REASON_MISSING_LOOKUP))
           .orderBy("product_id").first().product_id)
    row = (base.transactions_raw.join(base.demographics.select("household_id"), "household_id")
           .orderBy("basket_id", "product_id").first().asDict())
    row.update(product_id=pid, basket_id="MUT-1", quantity=Decimal("1.000"), sales_value=Decimal("10.00"),
               retail_disc=Decimal("0.00"), coupon_disc=Decimal("0.00"), coupon_match_disc=Decimal("0.00"),
               **{f"stored_{m}": None for m in C.MONEY})
    return row


def frame(spark, base, name, rows):
    return spark.createDataFrame(rows, base.source(name).schema)


def check(baseline, mutated, expected):
    after = counts(mutated)
    changed = {k: after[k] - baseline[k] for k in after if after[k] != baseline[k]}
    assert changed == expected


def test_clean_row_changes_nothing(spark, base, baseline):
    r = clean_tx(spark, base, in_scope=True)
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r])), {})


def full_product(base):
    """A lookup product with every descriptive attribute present."""
    return (base.products.where(F.col("product_category").isNotNull() & (F.col("product_type") != "")
                                & (F.col("package_size") != " ")).orderBy("product_id").first().asDict())


def test_blank_product_key(spark, base, baseline):
    p = full_product(base)
    p.update(product_id="  ", brand="Brand#99")
    check(baseline, mutate(spark, base, "products", frame(spark, base, "products", [p])),
          {"products_required_keys": 1})


def test_conflicting_product(spark, base, baseline):
    p = full_product(base)
    p.update(brand="Brand#999")
    q = mutate(spark, base, "products", frame(spark, base, "products", [p]))
    check(baseline, q, {"products_conflicting_attributes": 1, "products_duplicate_keys": 1})
    assert q.issues("products_conflicting_attributes").count() == 1


def test_basket_conflict(spark, base, baseline):
    r = clean_tx(spark, base, in_scope=False)
    other = base.transactions_raw.orderBy("basket_id").first()
    hh = (base.demographics.where(F.col("household_id") != other.household_id)
          .orderBy("household_id").first().household_id)
    r.update(basket_id=other.basket_id, household_id=hh)
    if r["product_id"] == other.product_id:
        pytest.skip("fixture product collides with the basket's product")
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r])),
          {"basket_conflict": 1})


def test_duplicate_grain(spark, base, baseline):
    r = clean_tx(spark, base, in_scope=False)
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r, dict(r)])),
          {"transactions_duplicate_grain": 1})


def test_negative_quantity(spark, base, baseline):
    r = clean_tx(spark, base, in_scope=False)
    r.update(quantity=Decimal("-1.000"))
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r])),
          {"invalid_measures": 1})


def test_cent_precision_and_tiny_difference(spark, base, baseline):
    schema = base.transactions_raw.schema
    wide = spark.createDataFrame([], schema).withColumn("sales_value", F.col("sales_value").cast("decimal(38,18)"))
    r1 = clean_tx(spark, base, in_scope=False)
    r1.update(sales_value=Decimal("10.005"))
    r2 = clean_tx(spark, base, in_scope=False)
    r2.update(basket_id="MUT-2", sales_value=Decimal("10.0000000001"))
    rows = spark.createDataFrame([r1, r2], wide.schema)
    check(baseline, mutate(spark, base, "transactions", rows),
          {"sales_value_cent_precision": 1, "sales_value_tiny_decimal_difference": 1})


def test_numbers_as_the_source_stored_them(spark, base, baseline):
    """0.1 + 0.2 is beside 30 cents, 2.675 is half a cent off; whole cents and exact halves of them are no tiny difference."""
    rows = [clean_tx(spark, base, in_scope=False) for _ in range(4)]
    for k, (r, v) in enumerate(zip(rows, (0.1 + 0.2, 2.675, 0.25, float("nan")))):
        r.update(basket_id=f"MUT-{k}", stored_retail_disc=v)
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", rows)),
          {"retail_disc_cent_precision": 1, "retail_disc_tiny_decimal_difference": 1})


def test_high_quantity_in_scope_only(spark, base, baseline):
    r_in = clean_tx(spark, base, in_scope=True)
    r_in.update(quantity=Decimal(str(C.HIGH_QUANTITY + 1)) + Decimal("0.000"))
    r_out = clean_tx(spark, base, in_scope=False)
    r_out.update(basket_id="MUT-2", quantity=Decimal(str(C.HIGH_QUANTITY + 1)) + Decimal("0.000"))
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r_in, r_out])),
          {"fmcg_high_quantity": 1})


def test_week_outside_calendar(spark, base, baseline):
    r = clean_tx(spark, base, in_scope=False)
    r.update(week=60)
    check(baseline, mutate(spark, base, "transactions", frame(spark, base, "transactions_raw", [r])),
          {"date_week_mapping": 1})


def test_unknown_campaign_redemption(spark, base, baseline):
    row = {"household_id": "1", "coupon_upc": "9", "campaign_id": "99", "redemption_date": dt.date(2017, 6, 1)}
    check(baseline, mutate(spark, base, "coupon_redemptions", frame(spark, base, "coupon_redemptions", [row])),
          {"coupon_redemptions_missing_campaign": 1, "redemption_coupon_link": 1,
           "redemption_household_campaign": 1, "redemption_dates": 1})


def test_unknown_promotion_code(spark, base, baseline):
    pid = base.products.orderBy("product_id").first().product_id
    row = {"product_id": pid, "store_id": "99", "display_location": "Q", "mailer_location": "0", "week": 10}
    check(baseline, mutate(spark, base, "promotions", frame(spark, base, "promotions", [row])),
          {"unknown_promotion_codes": 1})


def test_blank_home_ownership(spark, base, baseline):
    row = {"household_id": "NEW-HH", "age": "X", "income": "POSITIVE", "home_ownership": "  ",
           "marital_status": "Married", "household_size": "1", "household_comp": "1", "kids_count": "0"}
    check(baseline, mutate(spark, base, "demographics", frame(spark, base, "demographics", [row])),
          {"demographics_home_ownership_missing": 1})


def test_campaign_dates_reversed(spark, base, baseline):
    row = {"campaign_id": "10", "campaign_type": "TypeA", "start_date": dt.date(2017, 5, 1),
           "end_date": dt.date(2017, 4, 1)}
    check(baseline, mutate(spark, base, "campaign_descriptions", frame(spark, base, "campaign_descriptions", [row])),
          {"campaign_dates_type": 1})


def test_fused_report_equals_single_rule_counts(base, baseline):
    q = Quality(Warehouse(base))
    for code in ["fmcg_quantity_zero", "transactions_missing_product_lookup", "redemption_dates",
                 "promotions_duplicate_grain", "products_package_size_missing"]:
        assert q.issues(code).count() == baseline[code], code

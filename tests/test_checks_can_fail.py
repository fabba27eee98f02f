"""Each check compared with what it checks: damage makes it FAIL, none leaves it PASS."""
from pyspark.sql import functions as F

from basketry import config as C
from basketry.catalog import inputs
from basketry.operators import digests as D
from basketry.operators import sets as S
from basketry.operators.load import LoadBlocked
from basketry.plans import manifest as MF
from basketry.plans.context import Sources
from basketry.plans.quality import RULES, Quality, dq_gate
from basketry.plans import ledger as N
from basketry.plans.verify import VERIFY_CHECKS, Verify
from basketry.plans.warehouse import Warehouse

from .conftest import SMALL


def damaged(spark, name, change):
    """A warehouse whose staged table ``name`` is not what the input says."""
    src = Sources(spark, SMALL)
    src.__dict__[name] = change(src.source(name))
    return Warehouse(src)


def status(df, metric):
    return {r.metric: r.status for r in df.collect()}[metric]


def test_lost_staged_rows_are_seen(spark):
    good = Sources(spark, SMALL)
    bad = damaged(spark, "promotions", lambda df: df.limit(10)).src
    for src, same in ((good, True), (bad, False)):
        source, staged = inputs.staged_rows(src, "promotions")
        r = spark.range(1).select(source.alias("a"), staged.alias("b")).first()
        assert (r.a == r.b) is same


def test_manifest_names_the_part_that_changed(spark):
    """One changed row, one lost row and one repeated row are one part each; nothing else is reported."""
    src = Sources(spark, SMALL)
    before = MF.manifest({"products": src.products, "promotions": src.promotions})
    ids = [r.product_id for r in src.products.orderBy("product_id").limit(3).collect()]
    p = src.products
    one = F.col("product_id") == ids[0]
    for after, n in ((p.withColumn("brand", F.when(one, "other").otherwise(F.col("brand"))), 0), (p.where(~one), -1), (p.unionByName(p.where(one)), 1),
                     (p.withColumn("brand", F.when(one, None).otherwise(F.col("brand"))), 0)):
        found = MF.changes(before, MF.manifest({"products": after, "promotions": src.promotions})).collect()
        status = {(r.level, r.table_name): r.status for r in found}
        assert status[("batch", None)] == status[("table", "products")] == "CHANGED" and status[("table", "promotions")] == "PASS"
        parts = [r for r in found if r.level == "part"]
        want = spark.createDataFrame([(ids[0],)], "product_id string").select(D.key_range("product_id")).first()[0]
        assert [(r.table_name, r.part) for r in parts] == [("products", want)] and (parts[0].rows_after or 0) - parts[0].rows_before == n
    assert {r.status for r in MF.changes(before, before).collect()} == {"PASS"}


def test_differences_by_ranges_equal_full_ones(spark):
    a = spark.createDataFrame([(k % 50, None if k % 7 == 0 else f"v{k % 90}") for k in range(400)], "k int, v string")
    b = a.where("k <> 3").unionByName(a.where("k = 5")).unionByName(spark.createDataFrame([(None, "x"), (None, None)], "k int, v string"))
    want = a.exceptAll(b).withColumn("side", F.lit("only_in_a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_in_b")))
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(S.two_way_multiset_difference(a, b, "k")) == rows(S.two_way_multiset_difference(a, b)) == rows(want)
    want = a.subtract(b).withColumn("side", F.lit("only_in_a")).unionByName(b.subtract(a).withColumn("side", F.lit("only_in_b")))
    assert rows(S.two_way_difference(a, b, "k")) == rows(want)
    assert S.two_way_multiset_difference(a, a.repartition(5), "k").count() == 0
    assert len(D.differing_ranges(a, a.where("k <> 3"), "k", a.columns)) == 1


def test_verification_sees_damage(spark):
    wh = Warehouse(Sources(spark, SMALL))
    v = Verify(wh)
    assert status(v.redemptions(), "redemption.source_vs_loaded_and_rejected") == "PASS"
    assert status(v.calendar(), "week.calendar_mapping") == "PASS"
    assert status(v.scope(), "dim_product.wrong_scope_version") == "PASS"
    wh.__dict__["fact_coupon_redemption"] = wh.fact_coupon_redemption.limit(1)
    wh.__dict__["dim_product"] = wh.dim_product.withColumn("scope_rule_version", F.lit(None).cast("string"))
    assert status(v.redemptions(), "redemption.source_vs_loaded_and_rejected") == "FAIL"
    assert status(v.scope(), "dim_product.wrong_scope_version") == "FAIL"
    late = damaged(spark, "transactions_raw", lambda df: df.withColumn("week", F.col("week") + 1))
    assert status(Verify(late).calendar(), "week.calendar_mapping") == "FAIL"
    raw = damaged(spark, "transactions_raw", lambda df: df)
    assert status(Verify(raw).sales_totals(), "sales.baseline.quantity") == "PASS"
    raw.__dict__["fact_sales"] = raw.fact_sales.withColumn("quantity", F.col("quantity") + 1)
    assert status(Verify(raw).sales_totals(), "sales.baseline.quantity") == "FAIL"


def test_no_redemption_is_lost_or_merged(spark):
    src = Sources(spark, SMALL)
    src.__dict__["coupon_redemptions_raw"] = src.coupon_redemptions_raw.unionByName(src.coupon_redemptions_raw.limit(5))
    wh = Warehouse(src)
    n = src.coupon_redemptions_raw.count()
    assert wh.fact_coupon_redemption.count() + wh.redemption_rejects.count() == n
    assert wh.redemption_rejects.where(F.col("reject_reason").contains("repeated row")).count() >= 5
    grain = [r for r in Quality(wh).issues("coupon_redemptions_duplicate_grain").collect()]
    assert len(grain) >= 1


def test_null_household_is_not_a_bad_date(spark):
    src = Sources(spark, SMALL)
    before = Quality(Warehouse(src)).issues("redemption_dates").count()
    good = Warehouse(src).valid_redemptions.limit(3).withColumn("household_id", F.lit(None).cast("string"))
    more = Sources(spark, SMALL)
    more.__dict__["coupon_redemptions_raw"] = src.coupon_redemptions_raw.unionByName(good)
    assert good.count() == 3 and Quality(Warehouse(more)).issues("redemption_dates").count() == before


def test_finalize_needs_every_check(spark):
    rules = spark.createDataFrame([(f"r{k}", "WARNING", "PASS") for k in range(len(RULES))], "rule_code string, severity string, status string")
    checks = spark.createDataFrame([(f"m{k}", "PASS") for k in range(VERIFY_CHECKS)], "metric string, status string")
    decide = lambda a, b: N.report_gate(a, b, len(RULES), VERIFY_CHECKS).first().decision
    assert decide(rules, checks) == N.SUCCESS and dq_gate(rules).first().gate == "PASS"
    assert decide(rules, checks.limit(VERIFY_CHECKS - 1)) == "BLOCKED"
    assert decide(rules.limit(56), checks) == "BLOCKED"
    assert decide(rules.replace("WARNING", "ERROR", "severity").replace("PASS", "FAIL", "status"), checks) == "BLOCKED"


def test_shared_folder_is_needed_on_a_cluster(spark):
    import pytest
    from basketry import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
    assert C.BATCH_ID == 1


def test_records_are_those_of_the_classification(spark, monkeypatch):
    """Changed transactions no longer match what was recorded; a lost input table, and a NULL in the dimension, are seen."""
    from basketry.catalog import inputs as I
    src = Sources(spark, SMALL)
    wh = Warehouse(src)
    monkeypatch.setattr(I, "warehouse", lambda s, d: wh)
    run = lambda q: {r.metric: r.status for r in q(spark, SMALL).collect()}
    assert set(run(I.q_k4).values()) == set(run(I.q_k5).values()) == set(run(I.q_k8).values()) == set(run(I.q_k10).values()) == {"PASS"}
    good = wh.dim_product
    wh.__dict__["dim_product"] = good.withColumn("scope_status", F.lit(None).cast("string"))
    assert set(run(I.q_k10).values()) == {"FAIL"}
    wh.__dict__["dim_product"] = good.limit(1)
    assert set(run(I.q_k10).values()) == {"FAIL"}
    wh.__dict__["dim_product"] = good
    src.__dict__["transactions"] = src.transactions.withColumn("sales_value", (F.col("sales_value") + 1).cast("decimal(18,2)"))
    src.__dict__["products"] = src.products.limit(10)
    assert run(I.q_k4) == {"source.rows": "PASS", "source.null_sales": "PASS", "source.off_cent_sales": "PASS", "source.sales_cents": "FAIL"}
    assert run(I.q_k5) == {"products.rows": "FAIL"}
    k8 = run(I.q_k8)
    assert k8["IN_SCOPE.rows"] == "PASS" and k8["IN_SCOPE.sales_value"] == "FAIL"


def test_missing_input_files_are_counted(spark, tmp_path):
    import shutil
    from basketry.plans.context import input_files
    for t in inputs.fixtures.INPUT_TABLES:
        shutil.copy(f"{SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    assert inputs.input_tables(spark, str(tmp_path)) == inputs.fixtures.INPUT_TABLES
    one = input_files(spark, str(tmp_path))
    (tmp_path / "part.parquet").rename(tmp_path / "elsewhere")
    (tmp_path / "orders.parquet").rename(tmp_path / "file")
    (tmp_path / "orders.parquet").mkdir()
    assert inputs.input_tables(spark, str(tmp_path)) == ["customer", "events", "lineitem"] and input_files(spark, str(tmp_path)) != one


def test_unknown_reject_reasons_stop_the_fact(spark, monkeypatch):
    import pytest
    wh = Warehouse(Sources(spark, SMALL))
    monkeypatch.setattr(C, "ACCEPTED_REJECTS", ["date outside campaign"])
    with pytest.raises(LoadBlocked, match="not in campaign"):
        wh.fact_coupon_redemption
    monkeypatch.undo()
    assert wh.fact_coupon_redemption.count() == wh.valid_redemptions.count()

"""Hand-written micro-frames for the semantic traps."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry import config as C
from basketry.functions import scalars as B
from basketry.operators import aggregates as E
from basketry.operators import keys as G
from basketry.operators import load as L
from basketry.operators import sets as S
from basketry.plans import kpi as K
from basketry.plans import scope as SC


def test_money_tolerance_and_rounding(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (2.675,), (1.005,), (1.0051,), (float("nan"),),
                                (float("inf"),), (-3.0,), (None,)], "x double")
    rows = df.select("x", B.off_cent("x").alias("off"), B.tiny_off_cent("x").alias("tiny"),
                     B.is_invalid_measure("x").alias("bad")).collect()
    got = {(None if r.x is None else repr(r.x)): (r.off, r.tiny, r.bad) for r in rows}
    assert got[repr(0.1 + 0.2)] == (False, True, False)      # 30.000000000000004 cents: within tolerance
    assert got[repr(2.675)] == (True, False, False)           # half a cent off: a violation
    assert got[repr(1.0051)] == (True, False, False)          # 100.51 cents: off by 0.51 cent
    assert got["nan"] == (False, False, True)                 # NaN is invalid, never cast silently
    assert got["inf"] == (False, False, True)
    assert got[repr(-3.0)] == (False, False, True)
    assert got[None] == (False, False, True)


def test_cents_half_up_after_tolerance(spark):
    df = spark.createDataFrame([(Decimal("2.675"),), (Decimal("1.005"),)], "x decimal(38,18)")
    r = [x[0] for x in df.select(B.money("x")).collect()]
    assert r == [Decimal("2.68"), Decimal("1.01")]             # decimal HALF_UP, like NUMERIC


def test_btrim_null_trims_spaces_only(spark):
    df = spark.createDataFrame([(" a ",), ("\ta",), ("",), ("   ",), (None,)], "s string")
    assert [r[0] for r in df.select(B.btrim_null("s")).collect()] == ["a", "\ta", None, None, None]
    assert [r[0] for r in df.select(B.is_blank("s")).collect()] == [False, False, True, True, True]


def test_label_norm_strips_all_whitespace(spark):
    df = spark.createDataFrame([("\t red widget \n",)], "s string")
    assert df.select(B.label_norm("s")).first()[0] == "RED WIDGET"


def test_local_date_dst_and_year_end(spark):
    rows = [(dt.datetime(2017, 3, 12, 6, 59, 59),), (dt.datetime(2017, 3, 12, 7, 0, 0),),
            (dt.datetime(2017, 11, 5, 5, 30, 0),), (dt.datetime(2018, 1, 1, 4, 1, 20),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(F.col("ts").cast("timestamp").alias("ts"))
    got = [r[0] for r in df.select(B.local_date("ts")).collect()]
    assert got == [dt.date(2017, 3, 12), dt.date(2017, 3, 12), dt.date(2017, 11, 5), dt.date(2017, 12, 31)]


def test_week_numbering_rules(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 1, 2),), (dt.date(2017, 12, 25),),
                                (dt.date(2017, 12, 31),)], "d date")
    assert [r[0] for r in df.select(B.week_monday_plus_one("d")).collect()] == [1, 2, 53, 53]


def test_tristate_promotion_groups(spark):
    rows = [("support_and_unknown", "3", "0"), ("support_and_unknown", "8", "0"),
            ("unknown_only", "8", "0"), ("null_only", None, "0"), ("empty_only", "", "0"),
            ("display_A", "A", "0"), ("mailer_A", "0", "A")]
    df = spark.createDataFrame(rows, "g string, d string, m string")
    dl, ml = F.col("d"), F.col("m")
    out = {r.g: (r.hd, r.hm) for r in df.groupBy("g").agg(
        E.tristate(B.in_codes(dl, C.DISPLAY_SUPPORT), B.unknown_code(dl, C.DISPLAY_KNOWN)).alias("hd"),
        E.tristate(B.in_codes(ml, C.MAILER_SUPPORT), B.unknown_code(ml, C.MAILER_KNOWN)).alias("hm")).collect()}
    assert out["support_and_unknown"] == (True, False)
    assert out["unknown_only"] == (None, False)
    assert out["null_only"] == (None, False)
    assert out["empty_only"] == (None, False)
    assert out["display_A"] == (False, False)                  # 'A' display = no special display
    assert out["mailer_A"] == (False, True)                    # 'A' mailer = advertised


def test_conflicts_count_null_tuples(spark):
    df = spark.createDataFrame([("k1", None, "x"), ("k1", "y", "x"), ("k2", None, None), ("k2", None, None)],
                               "k string, a string, b string")
    got = {r.k for r in E.conflicting_attributes(df, "k", ["a", "b"]).collect()}
    assert got == {"k1"}


def test_safe_ratio_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(B.ratio6("a", "b")).collect()] == [None, 0.25]


def test_assign_keys_dense_ordered_many_partitions(spark):
    # a skewed key space: a third of the ids share a prefix; many partitions
    ids = [f"hot-{i:05d}" for i in range(3000)] + [f"id-{i:05d}" for i in range(6000)]
    df = spark.createDataFrame([(i,) for i in ids], "k string").repartition(37)
    out = G.assign_keys(df, "k", "key", start=100).collect()
    got = sorted((r.key, r.k) for r in out)
    assert [k for k, _ in got] == list(range(100, 100 + len(ids)))
    assert [k for _, k in got] == sorted(ids)


def test_latest_by_and_priority(spark):
    rows = [("a", 1, "FAILED"), ("a", 2, "RUNNING"), ("a", 3, "FAILED"), ("b", 1, "SUCCESS"), ("b", 2, "RUNNING")]
    df = spark.createDataFrame(rows, "k string, seq int, status string")
    latest = {r.k: r.seq for r in G.latest_by(df, "k", [F.col("seq")]).collect()}
    assert latest == {"a": 3, "b": 2}
    pick = {r.k: r.status for r in G.pick_by_priority(df, "k", "status", ["SUCCESS", "RUNNING"], "seq").collect()}
    assert pick == {"a": "RUNNING", "b": "SUCCESS"}


def test_insert_only_merge_blocks_conflicts_and_extras(spark):
    target = spark.createDataFrame([("a", "x", 1), ("b", "y", 2), ("z", "q", 3)], "id string, v string, key long")
    expected = spark.createDataFrame([("a", "x"), ("b", "CHANGED"), ("c", "w")], "id string, v string")
    r = L.insert_only_merge(target, expected, "id", ["id", "v"], "key")
    rep = r.report.first()
    assert (rep.conflict_rows, rep.extra_rows, rep.status) == (1, 1, "BLOCK")
    assert {(x.id, x.key) for x in r.inserted.collect()} == {("c", 4)}


def test_insert_only_merge_rerun_is_noop(spark):
    expected = spark.createDataFrame([(f"id{i}", str(i)) for i in range(50)], "id string, v string")
    first = L.insert_only_merge(expected.limit(0).withColumn("key", F.lit(0).cast("long")), expected,
                                "id", ["id", "v"], "key")
    second = L.insert_only_merge(first.merged, expected, "id", ["id", "v"], "key")
    rep = second.report.first()
    assert (rep.inserted_rows, rep.total_rows, rep.two_way_difference, rep.status) == (0, 50, 0, "PASS")
    assert S.two_way_multiset_difference(first.merged, second.merged).count() == 0


def test_classifier_precedence(spark):
    rows = [("1", "STANDARD", "ring", "red ring"),        # IN dept + review category -> REVIEW
            ("2", "STANDARD", None, "red ring"),          # IN dept + missing category -> REVIEW (missing)
            ("3", " large ", "gear", "red gear"),         # normalised IN dept -> IN_SCOPE
            ("4", "PROMO", "gear", "red gear"),           # OUT dept
            ("5", "ECONOMY", "widget", "red widget"),     # refinement -> IN_SCOPE
            ("6", "SMALL", "bolt", "blue bolt"),          # refinement -> OUT_OF_SCOPE
            ("7", "ECONOMY", "widget", "old widget"),     # no refinement -> default REVIEW
            ("8", "STANDARD", "gear", "")]                # empty type -> REVIEW (missing)
    p = spark.createDataFrame(rows, "product_id string, department string, product_category string, "
                                    "product_type string")
    for c in ["manufacturer_id", "brand", "package_size"]:
        p = p.withColumn(c, F.lit("x"))
    got = {r.product_id: (r.scope_status, r.scope_reason) for r in SC.classify_scope(p).collect()}
    assert got["1"] == ("REVIEW", C.REASON_CATEGORY_REVIEW)
    assert got["2"] == ("REVIEW", C.REASON_MISSING_ATTR)
    assert got["3"] == ("IN_SCOPE", C.REASON_DEPT_IN)
    assert got["4"] == ("OUT_OF_SCOPE", C.REASON_DEPT_OUT)
    assert got["5"][0] == "IN_SCOPE"
    assert got["6"][0] == "OUT_OF_SCOPE"
    assert got["7"] == ("REVIEW", C.REASON_DEFAULT)
    assert got["8"] == ("REVIEW", C.REASON_MISSING_ATTR)


def test_month_over_month_needs_adjacent_full_months(spark):
    days = [dt.date(2017, 1, 1) + dt.timedelta(d) for d in range(31)]            # full January
    days += [dt.date(2017, 2, 1) + dt.timedelta(d) for d in range(28)]           # full February
    days += [dt.date(2017, 4, 1) + dt.timedelta(d) for d in range(30)]           # April (March missing)
    days += [dt.date(2017, 5, 1) + dt.timedelta(d) for d in range(0, 31, 2)]     # May with gaps
    df = spark.createDataFrame([(d, Decimal("10.00")) for d in days], "local_date date, sales_value decimal(18,2)")
    got = {r.month_start: r.month_over_month for r in K.month_over_month(df).collect()}
    assert got[dt.date(2017, 2, 1)] is not None
    assert got[dt.date(2017, 1, 1)] is None          # no previous month
    assert got[dt.date(2017, 4, 1)] is None          # previous month not observed
    assert got[dt.date(2017, 5, 1)] is None          # gaps: not comparable


def test_support_status_and_no_fanout(spark):
    sales = spark.createDataFrame([("b1", "p", "s", 1, Decimal("5.00")), ("b2", "p", "s", 2, Decimal("7.00")),
                                   ("b3", "p", "s", 3, Decimal("1.00")), ("b4", "q", "s", 1, Decimal("2.00"))],
                                  "basket_id string, product_id string, store_id string, week int, "
                                  "sales_value decimal(18,2)")
    promo = spark.createDataFrame([("p", "s", 1, True, False, False), ("p", "s", 2, None, True, True),
                                   ("p", "s", 3, False, False, False)],
                                  "product_id string, store_id string, week int, has_display boolean, "
                                  "has_mailer boolean, promotion_code_unknown_flag boolean")
    st = {r.basket_id: (r.support_status, r.unknown_reason) for r in K.support_status(sales, promo).collect()}
    assert st == {"b1": ("DISPLAY_ONLY", None), "b2": ("UNKNOWN", "UNCLASSIFIED_PROMOTION"),
                  "b3": ("NO_DISPLAY_MAILER", None), "b4": ("UNKNOWN", "NO_PROMOTION_MATCH")}


def test_skewed_group_kpis_exact(spark):
    # one household holds a third of the lines: the grouped KPIs stay exact
    rows = [(f"b{i}", "hot" if i % 3 == 0 else f"h{i}", Decimal("1.50")) for i in range(3000)]
    df = spark.createDataFrame(rows, "basket_id string, household_id string, sales_value decimal(18,2)")
    df = df.withColumn("quantity", F.lit(Decimal("1.000")).cast("decimal(18,3)"))
    got = {r.household_id: (r.baskets, r.sales_value) for r in K.sales_kpis(df, "household_id").collect()}
    assert got["hot"] == (1000, Decimal("1500.00"))
    assert len(got) == 2001


def test_missing_days_and_date_series(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 1, 3),)], "d date")
    miss = [r.d for r in S.missing_days(df, "d", F.lit(dt.date(2017, 1, 1)), F.lit(dt.date(2017, 1, 4))).collect()]
    assert sorted(miss) == [dt.date(2017, 1, 2), dt.date(2017, 1, 4)]


def test_stage_cast_rejects(spark):
    from basketry.sources.staging import stage_cast
    df = spark.createDataFrame([(1.0, 2.5, "2017-01-01 00:00:00"), (1.5, float("nan"), "2017-01-01 10:00:00"),
                                (None, 3.0, None)], "id double, amount double, d string")
    good, rejects = stage_cast(df, {"id": "id", "amount": "decimal(18,2)", "d": "date"})
    assert good.count() == 2
    reasons = rejects.first().reject_reason
    assert "fractional id" in reasons and "not finite" in reasons and "time part" in reasons


def test_stage_cast_keeps_text_ids_and_never_rounds_or_raises(spark):
    from basketry.sources.staging import stage_cast
    df = spark.createDataFrame([("abc", "1.23", "7", "f", 1), ("007", "1.239", "7.5", "f", 2), ("9007199254740993", "x", "1e40", "f", 3),
                                (None, None, None, "f", 4)], "id string, amount string, n string, file string, line int")
    spec = {"id": "id", "amount": "decimal(18,2)", "n": "int"}
    good, rejects = stage_cast(df, spec, lineage=("file", "line"))
    assert sorted((r.id or "", r.amount) for r in good.collect()) == [("", None), ("abc", Decimal("1.23"))]
    why = {r.line: (r.file, r.reject_reason) for r in rejects.collect()}
    assert why == {2: ("f", "amount: too many decimals; n: not integral"), 3: ("f", "amount: not a number; n: out of range")}
    ids = [r.id for r in stage_cast(df.select("id"), {"id": "id"})[0].collect()]
    assert sorted(i or "" for i in ids) == ["", "007", "9007199254740993", "abc"]
    floats = spark.createDataFrame([(2.0**53 + 2, 0.1), (3.0, 1.239)], "id double, amount double")
    assert [r.reject_reason for r in stage_cast(floats, {"id": "id", "amount": "decimal(18,2)"})[1].orderBy("id").collect()] == \
        ["amount: too many decimals", "id: id beyond 2^53"]


def test_stage_cast_timestamps_need_a_zone(spark):
    from basketry.sources.staging import stage_cast
    df = spark.createDataFrame([("2017-01-01T10:00:00+02:00",), ("2017-01-01T10:00:00",), ("2017-01-01T10:00:00.1234567Z",), ("soonZ",), (None,)], "t string")
    good, rejects = stage_cast(df, {"t": "timestamp"})
    assert sorted(str(r.t) for r in good.collect() if r.t) == ["2017-01-01 08:00:00"] or good.count() == 2
    assert sorted(r.reject_reason for r in rejects.collect()) == ["t: finer than a microsecond", "t: not a timestamp", "t: timestamp without a zone"]


def test_assign_keys_on_millions_of_wide_rows(spark, tmp_path):
    """Range bounds are sampled and partitions coalesced at this size; keys must stay dense and in order."""
    n = 3_000_000
    try:
        for aqe, parts in (("true", "200"), ("false", "8")):
            spark.conf.set("spark.sql.adaptive.enabled", aqe)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            wide = spark.range(n).select(F.md5(F.col("id").cast("string").cast("binary")).alias("k"),
                                         F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("a"),
                                         F.sha2((F.col("id") + 1).cast("string").cast("binary"), 256).alias("b"))
            G.assign_keys(wide, "k", "key").write.parquet(str(tmp_path / aqe))
            out = spark.read.parquet(str(tmp_path / aqe))
            r = out.agg(F.count(F.lit(1)), F.countDistinct("key"), F.min("key"), F.max("key")).first()
            assert tuple(r) == (n, n, 1, n)
            ordered = out.select((F.col("key") % 1000).alias("m"), "key", "k").where("m < 2").orderBy("key").select("k").collect()
            assert [x.k for x in ordered] == sorted(x.k for x in ordered)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_guarded_loads_stop(spark):
    import pytest
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 11)], "id int, v string, sk long")
    expected = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    merged = L.load_insert_only(target, expected, "id", ["id", "v"], "sk")
    assert sorted(tuple(r) for r in merged.select("id", "v", "sk").collect()) == [(1, "a", 10), (2, "b", 11), (3, "c", 12)]
    assert L.changed_keys(target, merged, "id", "sk").count() == 0
    assert L.changed_keys(target, merged.withColumn("sk", F.col("sk") + (F.col("id") == 2).cast("int")), "id", "sk").count() == 1
    for bad in (expected.replace("b", "x", "v"), expected.where("id != 2")):
        with pytest.raises(L.LoadBlocked):
            L.load_insert_only(target, bad, "id", ["id", "v"], "sk")
    checked = spark.createDataFrame([(1, ""), (2, "late")], "id int, reject_reason string")
    with pytest.raises(L.LoadBlocked):
        L.load_without_rejects(checked)
    assert L.load_without_rejects(checked.where("id = 1")).columns == ["id"]


def test_quantiles_from_value_counts(spark):
    import random
    from basketry.plans.profile import quantity_quantiles
    random.seed(2)
    for values in ([5.0], [1.0, 2.0], [float(random.randint(0, 40)) for _ in range(501)], [random.gauss(0, 9) for _ in range(1000)]):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "quantity double")
        got = {r.probability: r.value for r in quantity_quantiles(df).collect()}
        want = dict(zip((0.0, 0.5, 0.9, 0.99, 1.0), df.agg(F.percentile("quantity", [0.0, 0.5, 0.9, 0.99, 1.0])).first()[0]))
        assert all(abs(got[p] - want[p]) < 1e-9 for p in want) and len(got) == 5


def test_stage_profile_and_reconcile(spark):
    from basketry.sources.staging import stage_profile, stage_reconcile
    df = spark.createDataFrame([(1, Decimal("1.10")), (2, None)], "a int, m decimal(18,2)")
    prof = {r.metric: r.value for r in stage_profile(df).collect()}
    assert prof["row_count"] == 2 and prof["null:m"] == 1 and prof["sum:m"] == Decimal("1.1")
    bad = stage_reconcile(stage_profile(df), stage_profile(df.limit(1))).where("status = 'FAIL'")
    assert bad.count() > 0


def test_publish_only_after_checks(spark, tmp_path):
    df = spark.range(3)
    checks_fail = spark.createDataFrame([("x", "FAIL")], "metric string, status string")
    try:
        L.publish(spark, {"t": df}, str(tmp_path / "w"), checks_fail)
        raise AssertionError("published despite failing checks")
    except L.LoadBlocked:
        pass
    checks_ok = spark.createDataFrame([("x", "PASS")], "metric string, status string")
    L.publish(spark, {"t": df}, str(tmp_path / "w"), checks_ok)
    assert L.read_current(spark, str(tmp_path / "w"), "t").count() == 3


def test_schema_mismatch_refused(spark, tmp_path):
    from basketry.sources.staging import SchemaMismatch, stage_read
    spark.range(2).write.parquet(str(tmp_path / "p"))
    try:
        stage_read(spark, str(tmp_path / "p"), T.StructType([T.StructField("other", T.LongType())]))
        raise AssertionError("accepted a file with a different column set")
    except SchemaMismatch:
        pass


def test_dq_results_samples_are_bounded(spark):
    import json

    from basketry.registry import QUERIES, load_all
    from .conftest import SMALL
    load_all()
    rows = QUERIES["dq_results"](spark, SMALL).collect()
    assert len(rows) == 57
    for r in rows:
        details = json.loads(r.details)
        assert len(details["samples"]) == min(5, r.affected_rows)
        assert details["count_unit"] == "rows_returned_by_rule"

"""What a step shuffles, spills or sends grows with the input at most; rows of its own."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.session import size_tasks
from basketry.sources import fixtures as fx

_DAY = dt.datetime(1996, 3, 1)


@pytest.fixture()
def folder(spark, tmp_path):
    """Lines and orders with repeated and missing keys: order 1 is there twice, line keys repeat, a supplier is null."""
    lines = [(1, 7, 3, 1, 5.0, 10.0, 0.02, 0.01, "R", "F", _DAY), (1, 7, 3, 2, 2.0, 4.0, 0.1, 0.0, "N", "O", _DAY), (1, 7, 13, 2, 2.0, 4.0, 0.1, 0.0, "N", "O", _DAY),
             (2, 8, None, 1, 1.0, 2.5, 0.0, 0.0, "A", "F", _DAY), (2, None, 4, 1, 1.0, None, 0.0, 0.0, "A", "F", _DAY), (None, 9, 4, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", None),
             (12, 7, 3, 1, 5.0, 10.0, 0.02, 0.01, "R", "F", None), (3, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", _DAY)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 100), (1, 101), (1, 101), (2, None), (12, 100), (4, 100)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange")


def test_transactions_are_shuffled_once(spark, folder):
    """The groups use the join's partitions: no exchange of all rows beside those of lines and orders, and none is a broadcast."""
    df = fx.transactions(spark, folder)
    assert _exchanges(df) == 2 and "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_transactions_are_the_groups_of_the_raw_rows(spark, folder):
    raw = fx.transactions_raw(spark, folder)
    keys = ["household_id", "store_id", "basket_id", "product_id"]
    money = ["sales_value", "retail_disc", "coupon_disc", "coupon_match_disc"]
    by_text = raw.groupBy(*keys).agg(F.sum("quantity").cast("decimal(18,3)").alias("quantity"), *[F.sum(m).cast("decimal(18,2)").alias(m) for m in money],
                                     F.min("transaction_timestamp").alias("transaction_timestamp"), F.min("week").alias("week"))
    got = fx.transactions(spark, folder)
    assert sorted(map(str, got.select(by_text.columns).collect())) == sorted(map(str, by_text.collect()))
    assert got.count() == 7
    twice = got.where("household_id = '101' and basket_id = '1-3'").collect()
    assert [r.quantity for r in twice] == [Decimal("10.000")]     # two lines, and their order is there twice for this household


def test_tasks_follow_the_input(spark):
    """Partitions by input size; what a session asks for beyond that is kept."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.sources.fileCompressionFactor"]
    before = {n: spark.conf.get(n) for n in names}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
        size_tasks(spark, 1 << 30)
        assert spark.conf.get(names[0]) == "64" and spark.conf.get(names[1]) == "16m"
        assert int(spark.conf.get(names[2])) <= 16 << 20
        size_tasks(spark, 1)
        assert spark.conf.get(names[0]) == "64"
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


CONFS = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
         "spark.sql.sources.fileCompressionFactor", "spark.sql.autoBroadcastJoinThreshold"]


@pytest.fixture()
def confs(spark):
    """The session's settings, put back afterwards."""
    before = {n: spark.conf.get(n) for n in CONFS}
    yield spark.conf
    for n, v in before.items():
        spark.conf.set(n, v)


def test_shuffles_are_sized_by_rows_not_by_files(spark, folder, confs, monkeypatch):
    """Staging asks for partitions by what the rows of its files are in memory, four times the files."""
    from basketry import session
    from basketry.plans import context

    files = sum(int(x.split(" ")[-2]) for x in context.input_files(spark, folder).splitlines() if " " in x)
    monkeypatch.setattr(session, "INPUT_PER_TASK", files // 8)
    confs.set("spark.sql.shuffle.partitions", "2")
    context.sources(spark, folder)
    assert 32 <= int(confs.get("spark.sql.shuffle.partitions")) <= 33


def test_a_small_file_of_many_rows_is_not_sent_through_the_driver(spark, tmp_path, confs):
    """A table is broadcast by an estimate of its rows; its file alone is below the limit."""
    path = f"{tmp_path}/dim"
    spark.range(200_000).selectExpr("string(id) AS k", "id AS key").coalesce(1).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "dim").glob("*.parquet"))
    confs.set("spark.sql.sources.fileCompressionFactor", "1.0")
    confs.set("spark.sql.autoBroadcastJoinThreshold", str(2 * size))
    joined = lambda: spark.range(10).selectExpr("string(id) AS k").join(spark.read.parquet(path), "k", "left")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in joined()
    size_tasks(spark, 1)
    assert "BroadcastHashJoin" not in joined()


def test_entering_rows_are_computed_once(spark, tmp_path):
    """The rows that a change of scope adds to a fact are asked for by three steps, and derived by one."""
    from basketry.operators.load import PartitionedFact

    seen = spark.sparkContext.accumulator(0)

    def counted(v):
        seen.add(1)
        return v > 0

    schema = "week int, product string, v int"
    fact = PartitionedFact.create(spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, None, 2), (None, "b", 3)], schema), f"{tmp_path}/fact", ["week"])
    coming = spark.createDataFrame([(1, "c", 4), (1, "c", 4), (None, None, 5), (3, "d", 6)], schema)
    entering = coming.where(F.udf(counted, "boolean")("v"))
    counts = fact.apply(spark.createDataFrame([("b",)], "product string"), entering, "product")
    assert seen.value == 4
    assert sorted((str(r.week), r.rows_before, r.rows_after) for r in counts.collect()) == [("1", 2, 4), ("3", 0, 1), ("None", 1, 1)]
    assert sorted(map(str, fact.read().select("week", "product", "v").collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "a", 1), (1, "a", 1), (2, None, 2), (1, "c", 4), (1, "c", 4), (None, None, 5), (3, "d", 6)], schema).collect()))


def test_rules_of_lines_meet_products_and_households_as_keys_and_one_number(spark):
    """The fused counts are those of the single rules, and no join of theirs shuffles the measures of a line."""
    from types import SimpleNamespace

    from basketry.plans.calendar import expected_weeks
    from basketry.plans.quality import RULES, Quality

    day, at = dt.date(2017, 1, 3), dt.datetime(2017, 1, 3, 12)
    m = Decimal("9.00")
    lines = [("h1", "1", "b1", "p1", Decimal("50"), m, m, m, m, at, 1, 9.0), ("h1", "1", "b1", "p1", Decimal("0"), m, m, m, m, at, 2, 9.001),
             ("h2", "1", "b2", "p2", Decimal("1.5"), Decimal("0.00"), m, m, m, at, 1, None), (None, "1", "b3", None, None, None, m, m, m, None, None, 1.0),
             ("h3", "1", "b4", "p3", Decimal("-1"), m, m, m, m, at, 1, 9.0000001)]
    money = "sales_value decimal(18,2), retail_disc decimal(18,2), coupon_disc decimal(18,2), coupon_match_disc decimal(18,2)"
    frames = {"transactions": spark.createDataFrame(lines, "household_id string, store_id string, basket_id string, product_id string, quantity decimal(18,3), "
                                                    f"{money}, transaction_timestamp timestamp, week int, stored_sales_value double"),
              "products": spark.createDataFrame([("p1",), ("p1",), ("p2",)], "product_id string"),
              "demographics": spark.createDataFrame([("h1",)], "household_id string")}
    wh = SimpleNamespace(src=None, dim_week=expected_weeks(spark), dim_date=spark.createDataFrame([(day,)], "full_date date"),
                         product_scope=spark.createDataFrame([("p1", "IN_SCOPE"), ("p3", "REVIEW")], "product_id string, scope_status string"))

    class Own(Quality):
        def staged(self, table):
            return frames[table]

    rules = [r for r in RULES if r.table == "transactions" and r.key is None]
    q = Own(wh)
    fused = lambda: q.broken_rules("transactions", rules).agg(*[F.count_if(r.code).alias(r.code) for r in rules])
    got = fused().first().asDict()
    assert got == {r.code: q.issues(r.code).count() for r in rules} and got["fmcg_high_quantity"] == 1 and got["missing_demographics"] == 3

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = spark._jvm.PythonSQLUtils.explainString(fused()._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    shuffled = [b.split("Input")[1].split("\n")[0] for b in plan.split("\n\n") if "Exchange\n" in b and ("hashpartitioning(product_id" in b or "hashpartitioning(household_id" in b)]
    assert shuffled and not any("sales_value" in s or "quantity" in s for s in shuffled), shuffled


@pytest.fixture()
def dealt(spark, folder):
    """The lines and orders with products, households and events; product 3 is there twice, keys are missing or known to one side only."""
    spark.createDataFrame([(3, "Brand#11", "TYPE A", "red soap", 1), (3, "Brand#11", "TYPE A", "red soap", 1), (13, "Brand#12", None, "blue", 49), (20, None, "TYPE B", "green tea", 50),
                           (None, "Brand#13", "TYPE C", "grey ink", 3)], "p_partkey long, p_brand string, p_type string, p_name string, p_size int").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(99, "A", 1.0, 2), (102, "B", -1.0, 3), (102, "B", -1.0, 3), (None, "C", 0.0, 4)],
                          "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey int").write.parquet(f"{folder}/customer.parquet")
    events = [(u, kind, _DAY, '{"k": %d}' % k) for u, kind, k in [(100, "view", 3), (100, "view", 3), (100, "purchase", 3), (99, "click", 10), (55, "view", 0), (99, "purchase", 20)]]
    spark.createDataFrame([*events, (None, "view", _DAY, '{"k": 3}'), (7, "view", None, "{}")], "user_id long, event_type string, ts timestamp, props string").write.parquet(f"{folder}/events.parquet")
    return folder


def test_products_and_households_meet_without_the_driver(spark, dealt, monkeypatch):
    """Joins whose sides are both of a dimension's size broadcast no product or household, however few there are."""
    from basketry.plans import warehouse as W

    plans = {}

    def planned(name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return df

    store, keys = W.Warehouse._store, W.assign_keys
    monkeypatch.setattr(W.Warehouse, "_store", lambda self, name, df, by=None: store(self, name, planned(name, df), by))
    monkeypatch.setattr(W, "assign_keys", lambda df, order, key, **k: keys(planned(key, df), order, key, **k))
    wh = W.warehouse(spark, dealt)
    dims = {"product": wh.dim_product, "household": wh.dim_household}
    tables = {"product": wh.bridge_coupon_product, "household": wh.bridge_campaign_household}
    asked = {"product_scope": "product_id", "product_key": "product_id", "household_key": "household_id", "bridge_coupon_product": "product_id",
             "bridge_campaign_household": "household_id"}
    for name, key in asked.items():
        assert f"SortMergeJoin [{key}" in plans[name] and f"BroadcastHashJoin [{key}" not in plans[name], (name, plans[name])
    for what, table in tables.items():
        known = set(map(tuple, dims[what].select(f"{what}_id", f"{what}_key").collect())) | {(None, None)}
        found = set(map(tuple, table.select(f"{what}_id", f"{what}_key").collect()))
        assert found <= known and found == {k for k in known if k[0] in {f[0] for f in found} and (k[0] is not None or k[1] is None)}
    assert {r.product_id: r.source_lookup_missing_flag for r in dims["product"].collect()} == {"3": False, "13": False, "20": False, "1": True, "7": True, "8": True, "9": True, None: True}
    assert {r.household_id: r.demographics_available_flag for r in dims["household"].collect()} == {"100": False, "101": False, "99": True, "102": True, "55": False, "7": False, None: False}


def _quality(spark, path):
    """The rules over eight small tables: lines with null keys, repeated rows, off-cent stored money, unknown products and households."""
    from basketry.plans.context import Sources
    from basketry.plans.quality import Quality
    from basketry.plans.warehouse import Warehouse

    at = dt.datetime(2017, 3, 1, 12)
    money = "sales_value decimal(18,2), retail_disc decimal(18,2), coupon_disc decimal(18,2), coupon_match_disc decimal(18,2)"
    stored = ", ".join(f"stored_{c.split()[0]} double" for c in money.split(", "))

    def line(h, b, p, q="1.000", s="5.00", off=5.0, week=10, ts=at):
        return (h, "1", b, p, Decimal(q), None if s is None else Decimal(s), Decimal("0.10"), Decimal("0.20"), Decimal("0.30"), ts, off, 0.1, 0.2, 0.07, week)

    lines = [line("3", f"{k}-1", "7", q="60.000") for k in range(9)] + [line(None, "20-1", "7"), line("4", None, "7", s=None), line("4", "21-1", None, q="0.000")]
    lines += [line("9", "22-1", "99", off=5.004)] * 2 + [line("9", "23-1", "8", q="-1.500", off=float("nan")), line("3", "24-1", "7", week=11, ts=None)]
    tables = {
        "transactions_raw": (lines, f"household_id string, store_id string, basket_id string, product_id string, quantity decimal(18,3), {money}, "
                                    f"transaction_timestamp timestamp, {stored}, week int"),
        "promotions": ([("7", "1", "0", "A", 10), ("99", None, "8", None, 10), (None, "1", "1", "0", 99)] * 4,
                       "product_id string, store_id string, display_location string, mailer_location string, week int"),
        "products": ([("7", "1", "STANDARD", "B", "GEAR", "RED GEAR", "1"), ("8", "1", "PROMO", "B", "GEAR", "RED GEAR", None), (None,) * 7],
                     "product_id string, manufacturer_id string, department string, brand string, product_category string, product_type string, package_size string"),
        "demographics": ([("3", "a", "b", "c", "d", "e", "f", "g")], "household_id string, age string, income string, home_ownership string, "
                         "marital_status string, household_size string, household_comp string, kids_count string"),
        "campaigns": ([("1", "3")], "campaign_id string, household_id string"),
        "campaign_descriptions": ([("1", "TypeA", dt.date(2017, 2, 1), dt.date(2017, 4, 1))], "campaign_id string, campaign_type string, start_date date, end_date date"),
        "coupons": ([("5", "7", "1")], "coupon_upc string, product_id string, campaign_id string"),
        "coupon_redemptions_raw": ([("3", "5", "1", dt.date(2017, 3, 1))], "household_id string, coupon_upc string, campaign_id string, redemption_date date"),
    }
    src = Sources(spark, path)
    for name, (data, schema) in tables.items():
        src.__dict__[name] = spark.createDataFrame(data, schema)
    src.__dict__["transactions"] = src.transactions_raw.drop(*[c for c in src.transactions_raw.columns if c.startswith("stored_")])
    src.__dict__["coupon_redemptions"] = src.coupon_redemptions_raw.distinct()
    return Quality(Warehouse(src))


def test_samples_of_large_tables_are_limits_not_sorts(spark, tmp_path):
    """Rows of lines and promotions are not sorted or joined as a whole for their samples, which are the least rows all the same."""
    from basketry.plans import quality as Q

    q = _quality(spark, str(tmp_path))
    assert "TakeOrderedAndProject" in Q.samples(q)._jdf.queryExecution().executedPlan().toString()
    found = {}
    for r in Q.samples(q, 3).collect():
        found.setdefault(r.code, []).append((r.n, list(r.names), list(r.vals)))
    for table in ("transactions", "promotions"):
        df = q.enriched(table)
        df = q._normalized_money(df) if table == "transactions" else df
        for rule in [r for r in Q.RULES if r.table == table and r.key is None]:
            cols = [f"_n_{c}" if rule.normalized_money and c in Q.C.MONEY else c for c in rule.cols]
            rows = [[None if v is None else v for v in row] for row in df.where(rule.pred()).select(*[F.col(c).cast("string") for c in cols]).collect()]
            least = sorted(rows, key=lambda row: [(v is not None, (v or "").encode()) for v in row])[:3]
            assert sorted(found.get(rule.code, [])) == [(n + 1, rule.cols, row) for n, row in enumerate(least)], rule.code
    assert {"fmcg_high_quantity", "missing_demographics", "sales_value_cent_precision", "unknown_promotion_codes", "date_week_mapping"} <= set(found)


def test_types_answer_the_cent_rules(spark, tmp_path):
    """Money of two decimals needs no decimal arithmetic of 38 digits a row; the rules find the same rows."""
    from basketry.plans import quality as Q

    q = _quality(spark, str(tmp_path))
    rules = [r for r in Q.RULES if r.table == "transactions" and r.key is None]
    df = q.broken_rules("transactions", rules)
    assert "decimal(38,18)" not in df._jdf.queryExecution().analyzed().toString()
    got = df.agg(*[F.count_if(r.code).alias(r.code) for r in rules]).first().asDict()
    plain = q._normalized_money(q.enriched("transactions"))
    assert got == {r.code: plain.where(r.pred()).count() for r in rules}
    assert got["sales_value_cent_precision"] == 2 and got["coupon_match_disc_tiny_decimal_difference"] == 16


def test_distance_from_a_cent_is_that_of_rounding(spark):
    from basketry.functions.scalars import _from_cent

    values = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, 0.49999999999999994, 1e-9, 2.675 * 100, 0.07 * 100, 4503599627370497.5, 4503599627370497.0,
              9007199254740993.0, -9007199254740991.0, 1e300, float("inf"), float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select(_from_cent(F.col("x")).alias("a"), F.abs(F.col("x") - F.round("x", 0)).alias("b"))
    assert [str(r.a) for r in rows.collect()] == [str(r.b) for r in rows.collect()]


def test_units_of_numbers_are_those_of_the_decimal(spark):
    """Whole cents and thousandths without a decimal for each row: the same numbers as by the cast, also at halves and far out."""
    values = [0.0, -0.0, 0.005, 1.005, 2.675, 1.0049999999999999, -1.005, 0.1 + 0.2, 49.0, 0.0005, 12345.67, 999999999.995, 1e9 + 0.005, 123456789012345.67, -9e14, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for scale in (2, 3):
        units = fx._units(F.col("x"), scale)
        rows = df.select(F.col("x").cast(f"decimal(18,{scale})").alias("a"), fx._of_units(units, scale).alias("b")).collect()
        assert [r.a for r in rows] == [r.b for r in rows]
    plan = fx._units(F.col("x"), 2)
    assert df.select(plan.alias("n")).schema["n"].dataType.simpleString() == "bigint"


def test_groups_that_break_a_rule_are_made_once(spark, tmp_path):
    """The report and the samples read the stored groups of lines and promotions; neither groups all rows again."""
    q = _quality(spark, str(tmp_path))
    for table, key, n in [("transactions", ("basket_id", "product_id"), 1), ("transactions", ("basket_id",), 0), ("promotions", ("product_id", "store_id", "week"), 3)]:
        groups = q.broken_groups(table, key)
        assert groups.count() == n
        assert groups is q.broken_groups(table, key) and "Aggregate" not in groups._jdf.queryExecution().executedPlan().toString()
    report = {r.rule_code: r.affected_rows for r in q.report().collect()}
    assert report["DQ_V1_transactions_duplicate_grain"] == 1 and report["DQ_V1_promotions_duplicate_grain"] == 3 and report["DQ_V1_basket_conflict"] == 0

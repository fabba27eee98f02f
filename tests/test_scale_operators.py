"""Decision lists, interval lookups, selection of ranks, partitioned facts, set reconciliation, mergeable distinct counts."""
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import load as L
from basketry.operators.joins import in_any_period
from basketry.operators.reconcile import reconcile
from basketry.operators.rules import first_match, rule_index, rule_table
from basketry.plans import distinct as DI
from basketry.plans.profile import distinct_profile, quantity_quantiles


def test_first_rule_that_fits_decides(spark):
    random.seed(4)
    values = lambda: random.choice([None, *"abcdef"])
    rows = [(str(k), values(), values(), values()) for k in range(400)]
    rules = [(values(), values(), values(), f"r{k}") for k in range(60)] + [(None, None, None, "rest"), ("a", "a", "a", "never")]
    names = ["x", "y", "z"]
    df = spark.createDataFrame(rows, "key string, x string, y string, z string")
    for given in (rules, rules[:20], []):
        table = rule_table(spark, given, names, ["out"])
        got = {r.key: (r.rule, r.out) for r in first_match(df, "key", table, names, ["out"]).collect()}
        want = {}
        for key, *cells in rows:
            hit = next(((k, r[3]) for k, r in enumerate(given) if all(w is None or w == c for w, c in zip(r[:3], cells))), None)
            if hit:
                want[key] = hit
        assert got == want


def test_rules_are_indexed_by_their_rarest_value(spark):
    df = spark.createDataFrame([("hot", "p")] * 50 + [("hot", "q")] * 2 + [("cold", "p")] * 5, "x string, y string")
    rules = rule_table(spark, [("hot", "q", "1"), ("cold", "p", "2"), ("hot", None, "3"), ("new", "p", "4"), (None, None, "5")], ["x", "y"], ["out"])
    assert {r.rule: (r._at, r._is) for r in rule_index(rules, df, ["x", "y"]).collect()} == {
        0: ("y", "q"), 1: ("x", "cold"), 2: ("x", "hot"), 3: ("x", "new"), 4: (None, None)}


def test_days_inside_any_of_many_periods(spark):
    """A campaign of 10,000 periods, touching, nested, long and reversed ones; rows keep their number."""
    random.seed(5)
    day = lambda n: dt.date(2017, 1, 1) + dt.timedelta(days=n)
    periods = [("many", day(7 * k), day(7 * k + random.randrange(4))) for k in range(10_000)]
    periods += [("one", day(-900), day(900)), ("nested", day(0), day(100)), ("nested", day(40), day(50)), ("back", day(9), day(3)), (None, day(0), day(9)), ("edge", day(64), day(64))]
    rows = [(random.choice(["many", "one", "nested", "back", "edge", "none", None]), random.choice([None, day(random.randrange(-1000, 70_000)), day(random.randrange(120))]), k)
            for k in range(3000)] + [("edge", day(64), -1), ("edge", day(63), -2), ("edge", day(65), -3)]
    df = spark.createDataFrame(rows, "c string, d date, k int")
    got = in_any_period(df, spark.createDataFrame(periods, "c string, a date, b date"), "c", "d", "a", "b", "inside").collect()
    assert len(got) == len(rows)
    by = {}
    for c, a, b in periods:
        by.setdefault(c, []).append((a, b))
    for r in got:
        assert r.inside == (r.c is not None and r.d is not None and any(a <= r.d <= b for a, b in by.get(r.c, [])))


@pytest.mark.parametrize("name", ["outlier", "ties", "few", "one", "mixed"])
def test_quantiles_by_selection(spark, name):
    random.seed(6)
    values = {"outlier": [random.random() for _ in range(4000)] + [1e9, -1e9], "ties": [0.0] * 3000 + [1.0] * 900 + [random.gauss(0, 5) for _ in range(300)],
              "few": [3.0, 1.0, 2.0], "one": [7.0], "mixed": [float(k % 50) for k in range(2000)] + [k * 1e-7 for k in range(2000)]}[name]
    probs = (0.0, 0.01, 0.5, 0.9, 0.99, 0.999, 1.0)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "quantity double")
    for small in (10, 100_000):
        got = {r.probability: r.value for r in quantity_quantiles(df, probs=probs, small=small, accuracy=50).collect()}
        assert got == pytest.approx({p: float(np.quantile(values, p)) for p in probs}, rel=1e-12, abs=1e-12)
    assert quantity_quantiles(df.limit(0)).count() == 0


def test_a_change_rewrites_the_partitions_it_touches(spark, tmp_path):
    rows = [(w, b, f"p{b}{k}", (w or 0) * 10 + k) for w in (1, 2, None) for b in (0, 1) for k in range(3)]
    fact = L.PartitionedFact.create(spark.createDataFrame(rows, "week int, bucket int, product string, v int"), str(tmp_path / "f"), ["week", "bucket"])
    files = lambda: {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "f").rglob("*.parquet")}
    assert sorted(map(str, map(tuple, fact.read().collect()))) == sorted(map(str, rows)) and len(files()) == 6
    before = files()
    leaving = spark.createDataFrame([("p00",)], "product string")
    entering = spark.createDataFrame([(2, 1, "new", 5), (3, 1, "new", 6)], "week int, bucket int, product string, v int")
    for _ in range(2):   # the same change again changes nothing
        counts = {(r.week, r.bucket): (r.rows_before, r.rows_after) for r in fact.apply(leaving, entering, "product").collect()}
        want = [r for r in rows if r[2] != "p00"] + [(2, 1, "new", 5), (3, 1, "new", 6)]
        assert sorted(map(str, map(tuple, fact.read().collect()))) == sorted(map(str, want))
        if _ == 0:
            assert counts == {(1, 0): (3, 2), (2, 0): (3, 2), (None, 0): (3, 2), (2, 1): (3, 4), (3, 1): (0, 1)}
            untouched = {p for p in before if "week=1/bucket=1" in p or "DEFAULT_PARTITION__/bucket=1" in p}
            assert len(untouched) == 2 and {p: files().get(p) for p in untouched} == {p: before[p] for p in untouched}
            assert set(before) & set(files()) == untouched
    gone = spark.createDataFrame([("p10",), ("p11",), ("p12",)], "product string")
    counts = {(r.week, r.bucket): r.rows_after for r in fact.apply(gone, entering.limit(0), "product").collect()}
    assert counts == {(1, 1): 0, (2, 1): 1, (None, 1): 0} and not any("week=1/bucket=1" in p for p in files())
    assert fact.read().where("product like 'p1%'").count() == 0 and fact.read().where("product = 'new'").count() == 2


def test_a_pointer_is_never_replaced(spark, tmp_path):
    base, good = str(tmp_path / "w"), spark.createDataFrame([("m", "PASS")], "metric string, status string")
    with pytest.raises(FileNotFoundError):
        L.read_current(spark, base, "t")
    L.publish(spark, {"t": spark.range(3)}, base, good)
    L.publish(spark, {"t": spark.range(5)}, base, good)
    assert L.read_current(spark, base, "t").count() == 5
    (tmp_path / "w" / "_pointer" / "n=3").mkdir()      # a publication cut off before its mark
    assert L.read_current(spark, base, "t").count() == 5
    L.publish(spark, {"t": spark.range(7)}, base, good)
    assert L.read_current(spark, base, "t").count() == 7
    with pytest.raises(L.LoadBlocked):
        L.publish(spark, {"t": spark.range(9)}, base, good.withColumn("status", F.lit("FAIL")))
    assert L.read_current(spark, base, "t").count() == 7


def test_keys_and_links_of_one_stream(spark):
    a = spark.createDataFrame([(1, "x", 1), (2, "y", 1), (2, "y", None), (None, "z", 9), (3, None, 9)], "k int, n string, p int")
    b = spark.createDataFrame([(1, 1), (1, 2)], "k bigint, m int")
    got = {r.name: (r.null_rows, r.duplicate_keys, r.orphan_rows) for r in reconcile(
        {"a": a, "b": b, "none": a.limit(0)}, [("a.k", "a", ["k"]), ("a.kn", "a", ["k", "n"]), ("b.k", "b", ["k"]), ("none.k", "none", ["k"])],
        [("a.p", "a", ["p"], "b", ["k"]), ("a.two", "a", ["k", "p"], "b", ["m", "k"]), ("none.p", "none", ["p"], "b", ["k"]), ("a.none", "a", ["p"], "none", ["k"])]).collect()}
    assert got == {"a.k": (1, 1, None), "a.kn": (2, 1, None), "b.k": (0, 1, None), "none.k": (0, 0, None),
                   "a.p": (0, None, 2), "a.two": (0, None, 1), "none.p": (0, None, 0), "a.none": (0, None, 4)}


def test_daily_sets_add_up(spark):
    random.seed(8)
    lines = [(dt.date(2017, 1, 1) + dt.timedelta(days=random.randrange(40)), random.choice([None, *range(90_000)]), random.choice([None, 1, 2, 40_000]), k) for k in range(3000)]
    df = spark.createDataFrame(lines, "local_date date, a bigint, b bigint, v bigint")
    daily = DI.daily_sets(df, {"a": "a", "b": "b"}, ["local_date"], {"v": F.col("v")})
    got = {r.g0: (r.a, r.b, int(r.v), r["rows"]) for r in DI.rolled_up(daily, [F.date_format("local_date", "yyyy-MM")], ["a", "b"], ["v"]).collect()}
    want = {}
    for m in ("2017-01", "2017-02"):
        of = [x for x in lines if x[0].isoformat()[:7] == m]
        want[m] = (len({x[1] for x in of} - {None}), len({x[2] for x in of} - {None}), sum(x[3] for x in of), len(of))
    assert got == want
    keys = DI.basket_keys(df.selectExpr("local_date", "string(a) AS basket_id")).collect()
    assert sorted(r.basket_key for r in keys) == list(range(1, len(keys) + 1))


def test_distinct_values_of_all_columns(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, None, None)], "i int, n string, s string")
    got = {(r.table_name, r.column_name): r.distinct_values for r in distinct_profile({"a": a, "b": a.select("i")}).collect()}
    assert got == {("a", "i"): 2, ("a", "n"): 0, ("a", "s"): 2, ("b", "i"): 2}

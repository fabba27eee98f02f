"""A run history over the given tables: monthly deliveries of each nation's orders and order lines.

Each nation is a dataset, each month with orders a batch of two files.  A file whose month has fewer rows than the
dataset's average month is a short delivery and fails at first.  What follows is recorded as it would be by a loader: the batch is
resumed (lines short), failed and started anew (orders short), or left open until the next month's delivery
(both short, after another scope version was asked for and refused).  How a run's verification goes depends on its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import ledger as N

FILES = ["orders", "lineitem"]
PIPELINE = "1.0"
CALENDAR = "monthly"


def months(orders: DataFrame, lines: DataFrame, customers: DataFrame) -> DataFrame:
    """(dataset, batch_id, n_orders, n_lines, short_o, short_l, i, last): one row for each nation and month with orders."""
    of = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("dataset"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint").alias("batch_id"))
    n_lines = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    counted = of.join(n_lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("dataset", "batch_id").agg(
        F.count(F.lit(1)).alias("n_orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
    every = Window.partitionBy("dataset")
    short = lambda c: F.col(c) * F.count(F.lit(1)).over(every) < F.sum(c).over(every)
    return counted.select("*", short("n_orders").alias("short_o"), short("n_lines").alias("short_l"),
                          F.row_number().over(every.orderBy("batch_id")).cast("bigint").alias("i"),
                          (F.col("batch_id") == F.max("batch_id").over(every)).alias("last"))


def events(batches: DataFrame) -> DataFrame:
    """The events of all batches, as the ledger stores them."""
    both, only_o, only_l = (F.col("short_o") & F.col("short_l"), F.col("short_o") & ~F.col("short_l"), ~F.col("short_o") & F.col("short_l"))
    forced = ~F.col("short_o") & ~F.col("short_l") & (F.col("batch_id") % 100 == 12)
    # runs of a batch: a second one after a failure, or where one is forced; ids go on through the dataset's history
    started = Window.partitionBy("dataset").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    rows = batches.withColumn("runs", F.when(only_o | forced, 2).otherwise(1)).withColumn(
        "r1", F.coalesce(F.sum("runs").over(started), F.lit(0)) + 1)
    r1, r2 = F.col("r1"), F.col("r1") + 1
    final = F.when(only_o, r2).otherwise(r1)
    hash_ = F.sha2(F.concat_ws("|", "dataset", "batch_id", "n_orders", "n_lines").cast("binary"), 256)
    null = F.lit(None)
    case = F.col("n_lines") % 6

    def details(checks: Column | None = None, inserted: Column | None = None) -> Column:
        if checks is not None:
            return F.to_json(F.struct(F.lit(89).alias("total_checks"), checks.alias("failed_checks")))
        return F.to_json(F.struct(F.lit(7).alias("dimension_tables_checked"), inserted.alias("retry_inserted_rows"),
                                  F.lit(0).alias("retry_second_inserted_rows"), *[F.lit(True).alias(f) for f in N.RECOVERY_FLAGS]))

    def event(k: int, name: str, run: Column = null, when: Column | None = None, scope: Column | None = None, file: Column = null, source: Column = null,
              loaded: Column = null, step: str | None = None, message: str | None = None, force: bool = False, said: Column = null,
              input_hash: Column = hash_) -> Column:
        e = F.struct((F.col("i") * 100 + k).cast("bigint").alias("seq"), F.lit(name).alias("event"), run.cast("bigint").alias("run_id"),
                     (scope if scope is not None else _scope()).alias("scope_version"), input_hash.alias("input_hash"), file.cast("string").alias("file_name"),
                     source.cast("bigint").alias("source_rows"), loaded.cast("bigint").alias("loaded_rows"), F.lit(step).cast("string").alias("step"),
                     F.lit(message).cast("string").alias("message"), F.lit(force if name == "REQUESTED" else None).cast("boolean").alias("forced"),
                     said.cast("string").alias("details"))
        return e if when is None else F.when(when, e)

    n_o, n_l, short_o, short_l = F.col("n_orders"), F.col("n_lines"), F.col("short_o"), F.col("short_l")
    file = lambda k, t, n, short: [
        event(k, "FILE_FAILED", r1, short, file=F.lit(t), source=n, loaded=n - 1, step=f"load {t}", message="short delivery"),
        event(k, "FILE_LOADED", r1, ~short, file=F.lit(t), source=n, loaded=n)]
    good_check, good_test = details(checks=F.lit(0)), details(inserted=F.lit(1))
    going = ~both
    log = [
        event(1, "REQUESTED"), event(2, "STARTED", r1), *file(3, "orders", n_o, short_o), *file(4, "lineitem", n_l, short_l),
        event(5, "FAILED", r1, only_o, step="load orders", message="short delivery"),
        event(6, "REQUESTED", when=only_o | only_l), event(6, "REQUESTED", when=both, scope=F.lit("next")),
        event(7, "STARTED", r2, only_o),
        event(8, "FILE_LOADED", r2, only_o, file=F.lit("orders"), source=n_o, loaded=n_o),
        event(8, "FILE_LOADED", r1, only_l, file=F.lit("lineitem"), source=n_l, loaded=n_l),
        event(20, "LOADED", final, going),
        event(21, "VERIFIED", final, going, said=details(checks=F.when(case == 0, 1).otherwise(0)),
              input_hash=F.when(case == 1, F.sha2(F.lit("earlier").cast("binary"), 256)).otherwise(hash_)),
        event(22, "RECOVERY_TESTED", final, going, said=details(inserted=F.when(case == 2, 0).otherwise(1))),
        event(23, "LOADED", final, going & (case == 3)), event(24, "CHECK_FAILED", final, going & (case == 4), step="late check", message="blocking rule"),
        event(25, "FINALIZE_REQUESTED", final, going),
        event(26, "VERIFIED", final, going & (case < 5), said=good_check), event(27, "RECOVERY_TESTED", final, going & (case < 5), said=good_test),
        event(28, "FINALIZE_REQUESTED", final, going & (case < 5)), event(29, "FINALIZED", final, going),
        event(30, "REQUESTED", when=going),
        event(31, "REQUESTED", when=forced, force=True), event(32, "STARTED", r2, forced), event(33, "LOADED", r2, forced),
        event(34, "VERIFIED", r2, forced, said=good_check), event(35, "RECOVERY_TESTED", r2, forced, said=good_test),
        event(36, "FINALIZE_REQUESTED", r2, forced), event(37, "FINALIZED", r2, forced),
        event(90, "FAILED", r1, both & ~F.col("last"), step="load", message="not completed before the next delivery"),
    ]
    flat = rows.select("dataset", "batch_id", F.explode(F.filter(F.array(*log), lambda e: e.isNotNull())).alias("e")).select("dataset", "batch_id", "e.*")
    return flat.withColumns({"pipeline_version": F.lit(PIPELINE), "calendar_id": F.lit(CALENDAR),
                             "scope_hash": F.sha2(F.col("scope_version").cast("binary"), 256)})


def _scope() -> Column:
    return F.concat(F.lit("scope-"), F.floor(F.col("batch_id") / 100).cast("string"))


def expected_files(batches: DataFrame) -> DataFrame:
    return batches.select("dataset", "batch_id", F.explode(F.array(*[F.lit(f) for f in FILES])).alias("file_name"))

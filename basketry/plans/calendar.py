"""Source calendar weeks and the continuous date dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.scalars import clip_range, date_parts, local_date


def expected_weeks(spark: SparkSession, calendar_id: str = C.CALENDAR_ID,
                   first_monday: dt.date = C.CALENDAR_FIRST_MONDAY,
                   n_weeks: int = C.CALENDAR_WEEKS, lo: dt.date = C.COVERAGE_START,
                   hi: dt.date = C.COVERAGE_END) -> DataFrame:
    """H1: ``n_weeks`` Monday-start weeks, coverage clipped to [lo, hi]."""
    n = F.col("id")
    start = F.date_add(F.lit(first_monday), ((n - 1) * 7).cast("int"))
    end = F.date_add(start, 6)
    cs, ce, partial = clip_range(start, end, lo, hi)
    return spark.range(1, n_weeks + 1).select(
        n.alias("week_key"),
        F.lit(calendar_id).alias("source_calendar_id"),
        n.cast("int").alias("source_week"),
        start.alias("week_start_date"), end.alias("week_end_date"),
        cs.alias("coverage_start_date"), ce.alias("coverage_end_date"),
        partial.alias("is_partial_coverage"))


def date_bounds(tx: DataFrame, descriptions: DataFrame, redemptions: DataFrame,
                weeks: DataFrame) -> DataFrame:
    """MIN/MAX over a union of date sources (each pre-aggregated to one row)."""
    d = local_date("transaction_timestamp")
    parts = [
        tx.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).withColumn("source", F.lit("transactions")),
        descriptions.agg(F.min("start_date").alias("lo"), F.max("end_date").alias("hi"))
        .withColumn("source", F.lit("campaign_descriptions")),
        redemptions.agg(F.min("redemption_date").alias("lo"), F.max("redemption_date").alias("hi"))
        .withColumn("source", F.lit("coupon_redemptions")),
        weeks.agg(F.min("week_start_date").alias("lo"), F.max("week_end_date").alias("hi"))
        .withColumn("source", F.lit("dim_week")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source", "lo", "hi")


def dim_date(bounds: DataFrame) -> DataFrame:
    """H2: one row per day between the overall bounds (B21 + B8).

    The bound frame is a handful of rows; the exploded series is one row per
    calendar day, a size set by the date range and never by the data volume.
    """
    lo_hi = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = lo_hi.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(*date_parts("d"))

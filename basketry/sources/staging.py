"""Staging: declared-schema reads, strict casts, lineage, control totals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_non_finite
from ..operators.keys import assign_keys
from ..session import shared_path


class SchemaMismatch(ValueError):
    pass


# A1 ---------------------------------------------------------------------------
def stage_read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               **options) -> DataFrame:
    """Read with a declared schema; refuse a file whose column set differs."""
    found = spark.read.format(fmt).options(**options).load(path)
    want = [f.name for f in schema.fields]
    have = found.columns
    if len(set(have)) != len(have):
        raise SchemaMismatch(f"{path}: duplicate columns {have}")
    if set(have) != set(want):
        raise SchemaMismatch(f"{path}: columns {sorted(have)} != declared {sorted(want)}")
    if fmt == "parquet":
        return found.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


# A2 ---------------------------------------------------------------------------
MAX_EXACT_INT = 2 ** 53
# Wide enough to hold a source value exactly before its scale is tested.
_EXACT = "decimal(38,12)"


def _cast_rule(df: DataFrame, c: str, kind: str, zone: str) -> tuple[Column, Column]:
    """(converted value, failure reason or NULL) for one column of a cast spec.

    Nothing raises: text that does not convert becomes a reject.  Text ids are kept
    as they are; money is tested, never rounded.
    """
    col = F.col(c)
    null = F.lit(None).cast("string")
    source = df.schema[c].dataType
    floating = isinstance(source, (T.DoubleType, T.FloatType))

    def rule(*tests: tuple[Column, str]) -> Column:
        bad = F.when(col.isNull(), null)
        for failed, reason in tests:
            bad = bad.when(failed, F.lit(f"{c}: {reason}"))
        return bad

    if kind == "id":
        if not floating:
            return col.cast("string"), null
        d = col.cast("double")
        bad = rule((is_non_finite(d), "not finite"), (d != F.floor(d), "fractional id"),
                   (F.abs(d) > MAX_EXACT_INT, "id beyond 2^53"))
        return F.when(bad.isNull(), d).try_cast("bigint").cast("string"), bad
    if kind == "int":
        d, exact = col.try_cast("double"), col.try_cast(_EXACT)
        bad = rule((d.isNull(), "not a number"), (is_non_finite(d), "not finite"),
                   (exact.isNull(), "out of range"), (exact != F.floor(exact), "not integral"),
                   (exact.try_cast("bigint").isNull(), "out of range"))
        return F.when(bad.isNull(), exact).try_cast("bigint"), bad
    if kind.startswith("decimal"):
        # a double's shortest text is what the source shows, so 0.1 is one tenth
        d, exact = col.try_cast("double"), (col.cast("string") if floating else col).try_cast(_EXACT)
        value = exact.try_cast(kind)
        bad = rule((d.isNull(), "not a number"), (is_non_finite(d), "not finite"),
                   (exact.isNull() | value.isNull(), "out of range"), (value.cast(_EXACT) != exact, "too many decimals"))
        return F.when(bad.isNull(), value), bad
    if kind == "date":
        at = col.try_cast("timestamp_ntz")
        bad = rule((at.isNull(), "not a date"), (at != at.cast("date").cast("timestamp_ntz"), "date with a time part"))
        return F.when(bad.isNull(), at.cast("date")), bad
    if kind == "timestamp":
        # text must name its zone; instants without one are local to ``zone``
        if isinstance(source, T.StringType):
            value = col.try_cast("timestamp")
            bad = rule((~col.rlike(r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)\s*$"), "timestamp without a zone"),
                       (col.rlike(r"\.[0-9]{7,}"), "finer than a microsecond"), (value.isNull(), "not a timestamp"))
        else:
            value = F.to_utc_timestamp(col, zone) if isinstance(source, T.TimestampNTZType) else col.cast("timestamp")
            bad = rule((value.isNull(), "not a timestamp"))
        return F.when(bad.isNull(), value), bad
    if kind == "string":
        return col.cast("string"), null
    raise ValueError(kind)


def stage_cast(df: DataFrame, spec: dict[str, str], zone: str = "UTC",
               lineage: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Strict conversion: returns (good rows, rejects with the failing rules named).

    ``lineage`` columns (file name and row number, of ``with_file_lineage``) go with the good rows and the rejects.
    """
    conv, reasons = {}, []
    for c, kind in spec.items():
        v, bad = _cast_rule(df, c, kind, zone)
        conv[c] = v
        reasons.append(bad)
    reason = F.concat_ws("; ", *reasons)
    tagged = df.select(*[conv[c].alias(c) for c in spec], reason.alias("_reject"),
                       *[F.col(c).cast("string").alias(f"_src_{c}") for c in spec],
                       *[F.col(c).alias(f"_line_{c}") for c in lineage])
    where_from = [F.col(f"_line_{c}").alias(c) for c in lineage]
    good = tagged.where(F.col("_reject") == "").select(*spec.keys(), *where_from)
    rejects = tagged.where(F.col("_reject") != "").select(
        *where_from, F.col("_reject").alias("reject_reason"), *[F.col(f"_src_{c}").alias(c) for c in spec])
    return good, rejects


class RowRejected(ValueError):
    pass


def require_no_reject(rejects: DataFrame) -> None:
    """Stop a load at the first reject (by file and row), naming file, row and the failing columns."""
    worst = rejects.select(F.min(F.struct(*LINEAGE, "reject_reason")).alias("r"), F.count(F.lit(1)).alias("n")).first()
    if worst.n:
        raise RowRejected(f"{worst.r[LINEAGE[0]]}, row {worst.r[LINEAGE[1]]}: {worst.r.reject_reason} ({worst.n} rows rejected)")


# A3 ---------------------------------------------------------------------------
LINEAGE = ("source_file_name", "source_row_number")


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Append ``source_file_name`` and the 1-based ``source_row_number`` in that file.

    ``df`` must read files directly: Spark's hidden ``_metadata`` column knows where each row was read, however the
    files were split over tasks, so nothing is numbered, sorted or shuffled.
    """
    return df.select("*", F.col("_metadata.file_name").alias(LINEAGE[0]), (F.col("_metadata.row_index") + 1).alias(LINEAGE[1]))


def stage_lineage(df: DataFrame, batch_id: int, object_name: str, loaded_at: Column | None = None) -> DataFrame:
    """Append batch, object, load time, file name and row number to rows as they are read."""
    return with_file_lineage(df).withColumns({
        "etl_batch_id": F.lit(batch_id).cast("bigint"),
        "source_object_name": F.lit(object_name),
        "loaded_at": loaded_at if loaded_at is not None else F.current_timestamp(),
    })


def number_rows(df: DataFrame, order_key) -> DataFrame:
    """Append a 1-based ``source_row_number`` over a stable key order, for rows that come from no file
    (partition-count offsets, not a global window)."""
    return assign_keys(df, order_key, LINEAGE[1], start=1)


# A4 / A7 ------------------------------------------------------------------------
def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return shared_path(spark, f"basketry-{name}")


def stage_replace_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace exactly one batch's rows (dynamic partition overwrite)."""
    (df.withColumn("etl_batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("etl_batch_id").parquet(path))


def batch_snapshot(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Exactly one batch, by partition pruning; batches are never unioned."""
    return spark.read.parquet(path).where(F.col("etl_batch_id") == batch_id)


# A5 ---------------------------------------------------------------------------
VALUE_TYPE = "decimal(38,6)"


def stage_profile(df: DataFrame) -> DataFrame:
    """Control totals in one aggregate pass, unpivoted to (metric, value)."""
    aggs = [F.count(F.lit(1)).cast(VALUE_TYPE).alias("row_count")]
    for f in df.schema.fields:
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).cast(VALUE_TYPE).alias(f"null:{f.name}"))
        if isinstance(f.dataType, (T.DecimalType, T.IntegerType, T.LongType, T.ShortType)):
            aggs.append(F.coalesce(F.sum(c), F.lit(0)).cast(VALUE_TYPE).alias(f"sum:{f.name}"))
        elif isinstance(f.dataType, T.DoubleType):
            aggs.append(F.coalesce(F.sum(c.cast("decimal(38,6)")), F.lit(0)).cast(VALUE_TYPE)
                        .alias(f"sum:{f.name}"))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            aggs.append(F.coalesce(F.sum(F.unix_micros(c.cast("timestamp")).cast("decimal(38,0)")),
                                   F.lit(0)).cast(VALUE_TYPE).alias(f"epoch_microseconds:{f.name}"))
    wide = df.agg(*aggs)
    names = wide.columns
    stack = "stack({n}, {pairs}) as (metric, value)".format(
        n=len(names), pairs=", ".join(f"'{m}', `{m}`" for m in names))
    return wide.selectExpr(stack)


# A6 ---------------------------------------------------------------------------
def stage_reconcile(source_profile: DataFrame, target_profile: DataFrame) -> DataFrame:
    s = source_profile.select("metric", F.col("value").alias("source_value"))
    t = target_profile.select("metric", F.col("value").alias("target_value"))
    j = s.join(t, "metric", "full")
    return j.select("metric", "source_value", "target_value",
                    F.when(F.col("source_value").eqNullSafe(F.col("target_value")), "PASS")
                    .otherwise("FAIL").alias("status"))


# A8 ---------------------------------------------------------------------------
SCOPE_COLUMNS = ["product_id", "manufacturer_id", "department", "brand", "product_category",
                 "product_type", "package_size", "scope_status", "scope_reason",
                 "scope_rule_version"]


def scope_read(spark: SparkSession, path: str) -> DataFrame:
    """Decisions CSV as all strings, keeping empty strings apart from NULL."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in SCOPE_COLUMNS])
    return (spark.read.schema(schema).option("header", True).option("emptyValue", "")
            .option("encoding", "UTF-8").csv(path))


def scope_validate(decisions: DataFrame, allowed=("IN_SCOPE", "OUT_OF_SCOPE", "REVIEW")) -> DataFrame:
    """One-row validation of a decisions table (one aggregate + one group pass)."""
    blank = F.col("product_id").isNull() | (F.btrim("product_id") == "")
    dup = (decisions.groupBy("product_id").count().where("count > 1")
           .select(F.count(F.lit(1))).scalar())
    row = decisions.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(blank).alias("blank_product_ids"),
        F.count_if(~F.coalesce(F.col("scope_status").isin(list(allowed)), F.lit(False)))
         .alias("invalid_status_rows"),
        F.countDistinct("scope_rule_version").alias("rule_versions"),
        F.count_if(F.col("scope_reason").isNull() | (F.btrim("scope_reason") == ""))
         .alias("blank_reason_rows"))
    return row.select("*", dup.alias("duplicate_product_ids")).withColumn(
        "status", F.when((F.col("blank_product_ids") == 0) & (F.col("invalid_status_rows") == 0)
                         & (F.col("rule_versions") == 1) & (F.col("blank_reason_rows") == 0)
                         & (F.col("duplicate_product_ids") == 0), "PASS").otherwise("FAIL"))


# A9 ---------------------------------------------------------------------------
def zone_offset(ts: Column, zone: str) -> Column:
    """+HHMM / -HHMM offset of ``zone`` at the instant ``ts``."""
    minutes = ((F.unix_seconds(F.from_utc_timestamp(ts, zone)) - F.unix_seconds(ts)) / 60).cast("int")
    sign = F.when(minutes < 0, "-").otherwise("+")
    a = F.abs(minutes)
    return F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"),
                    F.lpad((a % 60).cast("string"), 2, "0"))


def export_text(df: DataFrame, zone: str) -> DataFrame:
    """Every column as export text: instants as local time + offset, dates ISO."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            local = F.from_utc_timestamp(c, zone)
            cols.append(F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
                                 zone_offset(c, zone)).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(c, "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)


def csv_export(df: DataFrame, path: str, zone: str) -> None:
    export_text(df, zone).write.mode("overwrite").option("header", True) \
        .option("nullValue", "").csv(path)


# A10 --------------------------------------------------------------------------
def content_hash(df: DataFrame) -> DataFrame:
    """Order-insensitive content fingerprint of a table (large inputs: hash rows)."""
    h = F.xxhash64(*[F.col(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("row_hash_sum"))


# A11 --------------------------------------------------------------------------
def source_overview(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and missing count per column, one aggregate per table."""
    parts = []
    for name, df in tables.items():
        aggs = [F.count(F.lit(1)).alias("__rows")] + [
            F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
        wide = df.agg(*aggs)
        n = len(df.columns)
        pairs = ", ".join(f"'{c}', {i + 1}, `{c}`" for i, c in enumerate(df.columns))
        long = wide.selectExpr("__rows", f"stack({n}, {pairs}) as (column_name, ordinal, missing)")
        parts.append(long.select(F.lit(name).alias("table_name"), F.col("__rows").alias("row_count"),
                                 F.lit(n).alias("column_count"), "column_name",
                                 F.col("ordinal").cast("int").alias("ordinal"),
                                 F.col("missing").cast("bigint").alias("missing")))
    return reduce(lambda a, b: a.unionByName(b), parts)


# A12 --------------------------------------------------------------------------
def expected_rows_check(tables: dict[str, DataFrame], expected: dict[str, Column]) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        actual = df.select(F.count(F.lit(1))).scalar()
        exp = expected[name]
        rows.append(spark.range(1).select(F.lit(name).alias("table_name"),
                                          exp.cast("bigint").alias("expected_rows"),
                                          actual.alias("actual_rows"),
                                          F.when(exp == actual, "PASS").otherwise("FAIL").alias("status")))
    return reduce(lambda a, b: a.unionByName(b), rows)

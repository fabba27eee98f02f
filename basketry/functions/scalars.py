"""Column -> Column helpers.  All are built-in expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# B1 ---------------------------------------------------------------------------
def btrim_null(c) -> Column:
    """NULLIF(BTRIM(x), '') — trims spaces only (a tab survives)."""
    return F.nullif(F.btrim(_c(c), F.lit(" ")), F.lit(""))


# B2 ---------------------------------------------------------------------------
def is_blank(c) -> Column:
    c = _c(c)
    return c.isNull() | (F.btrim(c, F.lit(" ")) == "")


def any_blank(cols: Iterable) -> Column:
    return reduce(lambda a, b: a | b, [is_blank(c) for c in cols])


# B3 ---------------------------------------------------------------------------
def is_non_finite(c) -> Column:
    d = _c(c).cast("double")
    return F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def is_invalid_measure(c) -> Column:
    """NULL, NaN, +-Infinity or negative."""
    c = _c(c)
    return c.isNull() | F.coalesce(is_non_finite(c), F.lit(False)) | (c < 0)


def _finite_decimal(c) -> Column:
    """Decimal view of a finite value; NULL for NaN / Infinity (never cast NaN)."""
    c = _c(c)
    return F.when(~is_non_finite(c), c.cast("decimal(38,18)"))


# B4 ---------------------------------------------------------------------------
def in_whole_cents(kind: T.DataType) -> bool:
    """Whether a type holds whole cents only, so that B4 and B6 find nothing in it and B5 changes nothing: no row has to be computed."""
    return isinstance(kind, T.DecimalType) and kind.scale <= 2 and kind.precision - kind.scale <= 20


def off_cent(c, tol: str = C.CENT_TOLERANCE) -> Column:
    """ABS(x*100 - ROUND(x*100)) >= tol, evaluated on finite values only."""
    d = _finite_decimal(c) * 100
    return F.coalesce(F.abs(d - F.round(d, 0)) >= F.lit(tol).cast("decimal(38,18)"), F.lit(False))


def within_cent(c, tol: str = C.CENT_TOLERANCE) -> Column:
    d = _finite_decimal(c) * 100
    return F.coalesce(F.abs(d - F.round(d, 0)) < F.lit(tol).cast("decimal(38,18)"), F.lit(False))


# B5 ---------------------------------------------------------------------------
def to_cents(c, tol: str = C.CENT_TOLERANCE, scale: int = 2) -> Column:
    """ROUND(x, 2) when within tolerance of a cent, else the value unchanged."""
    c = _c(c)
    return F.when(within_cent(c, tol), F.round(c, scale)).otherwise(c)


def money(c, tol: str = C.CENT_TOLERANCE) -> Column:
    """Normalised money as decimal(18,2) (only valid after B4 passes)."""
    return F.round(_c(c), 2).cast("decimal(18,2)")


# B6 ---------------------------------------------------------------------------
def tiny_off_cent(c, tol: str = C.CENT_TOLERANCE) -> Column:
    c = _c(c)
    return within_cent(c, tol) & (c != F.round(c, 2))


def _from_cent(d: Column) -> Column:
    """Distance of a binary number of cents from the nearest whole one (``rint``: no decimal is made; a half is as far from both)."""
    return F.abs(d - F.rint(d))


def stored_off_cent(c, tol: str = C.CENT_TOLERANCE) -> Column:
    """B4 on a binary number as the source stored it, in its own arithmetic; NULL, NaN and infinite values are no finding."""
    d = _c(c) * 100
    return F.coalesce(~is_non_finite(_c(c)) & (_from_cent(d) >= float(tol)), F.lit(False))


def stored_tiny_off_cent(c, tol: str = C.CENT_TOLERANCE) -> Column:
    """B6 on a binary number: not a whole number of cents, but nearer to one than the tolerance."""
    d = _c(c) * 100
    off = _from_cent(d)
    return F.coalesce(~is_non_finite(_c(c)) & (off > 0) & (off < float(tol)), F.lit(False))


# B7 ---------------------------------------------------------------------------
def local_date(ts, zone: str = C.SOURCE_ZONE) -> Column:
    """Business date of an instant in ``zone`` (DST-correct; session zone UTC)."""
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))


# B8 ---------------------------------------------------------------------------
def date_key(d) -> Column:
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_parts(d) -> list[Column]:
    d = _c(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month_number"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("calendar_year"),
        (F.weekday(d) + 1).alias("day_of_week"),
    ]


# B9 ---------------------------------------------------------------------------
def week_monday_plus_one(d) -> Column:
    """strftime %W + 1: weeks start Monday, days before the first Monday are week 1."""
    d = _c(d)
    return (F.floor((F.dayofyear(d) - 1 + 7 - F.weekday(d)) / 7) + 1).cast("int")


def week_sunday_plus_one(d) -> Column:
    """strftime %U + 1: weeks start Sunday."""
    d = _c(d)
    sunday_based = (F.dayofweek(d) - 1)          # Sunday = 0
    return (F.floor((F.dayofyear(d) - 1 + 7 - sunday_based) / 7) + 1).cast("int")


def iso_week(d) -> Column:
    return F.weekofyear(_c(d))


# B10 --------------------------------------------------------------------------
def _sales_tests(high: int) -> dict[str, Column]:
    q, s = F.col("quantity"), F.col("sales_value")
    return {
        "quantity_zero_flag": q == 0,
        "quantity_zero_sales_positive_flag": (q == 0) & (s > 0),
        "positive_quantity_zero_sales_flag": (q > 0) & (s == 0),
        "coupon_above_sales_flag": F.col("coupon_disc") > s,
        "coupon_match_above_coupon_flag": F.col("coupon_match_disc") > F.col("coupon_disc"),
        "high_quantity_flag": q > high,
    }


def sales_flags(high: int = C.HIGH_QUANTITY) -> list[Column]:
    return [c.alias(n) for n, c in _sales_tests(high).items()]


def sales_flag_names() -> list[str]:
    return list(_sales_tests(0))


# B11 --------------------------------------------------------------------------
def multi_row(n) -> Column:
    return _c(n) > 1


# B12 --------------------------------------------------------------------------
def clip_range(start, end, lo, hi) -> tuple[Column, Column, Column]:
    s = F.greatest(_c(start), F.lit(lo))
    e = F.least(_c(end), F.lit(hi))
    return s, e, (F.datediff(e, s) + 1) < 7


# B13 --------------------------------------------------------------------------
def rows_differ(a_cols: list, b_cols: list) -> Column:
    """ROW(a...) IS DISTINCT FROM ROW(b...)."""
    return ~F.struct(*[_c(c) for c in a_cols]).eqNullSafe(F.struct(*[_c(c) for c in b_cols]))


# B14 --------------------------------------------------------------------------
def is_fractional(q) -> Column:
    q = _c(q)
    return q != F.floor(q)


# B15 --------------------------------------------------------------------------
def safe_ratio(a, b) -> Column:
    """a / NULLIF(b, 0): zero denominator gives NULL (ANSI would raise)."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def ratio6(a, b) -> Column:
    """Ratio of two sums as a double: both sides cast to double, then divided.

    Not rounded (rounding is for display only); a zero denominator gives NULL.
    """
    return _c(a).cast("double") / F.nullif(_c(b).cast("double"), F.lit(0.0))


# B16 --------------------------------------------------------------------------
def in_codes(c, codes: list[str]) -> Column:
    return F.coalesce(_c(c).isin(codes), F.lit(False))


def unknown_code(c, codes: list[str]) -> Column:
    c = _c(c)
    return c.isNull() | ~c.isin(codes)


# B17 --------------------------------------------------------------------------
def label_norm(c) -> Column:
    """strip + upper, for matching only (strips all edge whitespace)."""
    return F.upper(F.regexp_replace(_c(c), r"^\s+|\s+$", ""))


# B18 --------------------------------------------------------------------------
def details_json(**cols) -> Column:
    return F.to_json(F.struct(*[_c(v).alias(k) for k, v in cols.items()]))


# B19 --------------------------------------------------------------------------
def code_like(c, prefix: str | None = None, suffix: str | None = None) -> Column:
    c = _c(c)
    cond = F.lit(True)
    if prefix is not None:
        cond = cond & c.startswith(prefix)
    if suffix is not None:
        cond = cond & c.endswith(suffix)
    return cond


# B20 --------------------------------------------------------------------------
def cents_long(c) -> Column:
    """Integer cents; equal to HALF_UP rounding once B4 passes."""
    return F.round(_c(c) * 100, 0).cast("bigint")


# B21 --------------------------------------------------------------------------
def date_series(lo, hi) -> Column:
    return F.explode(F.sequence(_c(lo), _c(hi), F.expr("INTERVAL 1 DAY")))


# B22 --------------------------------------------------------------------------
def discount_any(*cols) -> Column:
    cols = cols or ("retail_disc", "coupon_disc", "coupon_match_disc")
    cond = reduce(lambda a, b: a | b, [_c(c) > 0 for c in cols])
    return F.when(cond, 1).otherwise(0)

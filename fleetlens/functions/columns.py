"""Column -> Column helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_model(model: str | Column) -> Column:
    """Strip a leading 'WDC ' (case-sensitive, no trim); other strings pass unchanged.

    NULL stays NULL. substr(x, 5) is 1-based, so 'WDC  X' becomes ' X'.
    """
    m = _c(model)
    return F.when(m.startswith("WDC "), m.substr(F.lit(5), F.length(m))).otherwise(m)


def capacity_sentinel(capacity: str | Column) -> Column:
    """Three-valued sentinel flag: TRUE for <= 0, FALSE for > 0, NULL for NULL."""
    return _c(capacity) <= 0


def non_sentinel(value: str | Column, sentinel: str | Column) -> Column:
    """value where the sentinel flag is FALSE; NULL where it is TRUE or NULL."""
    return F.when(~_c(sentinel), _c(value))


def surrogate_key(*parts: str | Column) -> Column:
    """a || '|' || b ...: NULL-propagating (concat, not concat_ws)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def quarter_label(date: str | Column) -> Column:
    """'YYYYQn' of a date, e.g. 2026Q1. Sorts chronologically as a string."""
    d = _c(date)
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def capacity_class(capacity: str | Column) -> Column:
    """NULL -> 'Unknown'; < 1e12 -> round(b/1e9) || 'GB'; else round(b/1e12) || 'TB'."""
    b = _c(capacity)
    gb = F.concat(F.round(b / F.lit(1e9)).cast("bigint").cast("string"), F.lit("GB"))
    tb = F.concat(F.round(b / F.lit(1e12)).cast("bigint").cast("string"), F.lit("TB"))
    return F.when(b.isNull(), F.lit("Unknown")).when(b < F.lit(1_000_000_000_000), gb).otherwise(tb)


def round2(x: str | Column) -> Column:
    """round(x, 2) done as round(x * 100) / 100 on doubles.

    Spark's round(x, 2) rounds the decimal expansion (1.005 -> 1.01); DuckDB's and
    the reference's give 1.0. Scaling first rounds the binary product, which agrees.
    """
    return F.round(_c(x) * F.lit(100.0)) / F.lit(100.0)


def afr_pct(failures: str | Column, drive_days: str | Column) -> Column:
    """failures / (drive_days / 365) * 100, rounded to 2 places; doubles throughout.

    365.0 must be a double: as a SQL literal Spark reads it as DECIMAL and the result differs.
    """
    f = _c(failures).cast("double")
    d = _c(drive_days).cast("double")
    return round2(f / (d / F.lit(365.0)) * F.lit(100.0))


def day_of_week_sunday0(date: str | Column) -> Column:
    """0 = Sunday ... 6 = Saturday (Spark's dayofweek is 1 = Sunday)."""
    return (F.dayofweek(_c(date)) - 1).cast("bigint")

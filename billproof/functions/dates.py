"""Dates, billing cycles (yyyyMM) and periods ('yyyy-MM'). Run dates are injected, never read from the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
BR_DATE = r"^\d{2}/\d{2}/\d{4}$"


def to_date_safe(c: Column) -> Column:
    """Date from a timestamp, 'dd/MM/yyyy' or 'yyyy-MM-dd...'; anything else is NULL."""
    text = c.cast("string")
    return F.coalesce(
        F.try_to_timestamp(F.when(text.rlike(BR_DATE), text), F.lit("dd/MM/yyyy")).cast("date"),
        F.try_to_timestamp(F.when(text.rlike(ISO_DATE), F.substring(text, 1, 10)), F.lit("yyyy-MM-dd")).cast("date"),
        F.try_to_timestamp(F.when(~text.rlike(BR_DATE) & ~text.rlike(ISO_DATE), text)).cast("date"),
    )


def cycle_of(c: Column, encoding: str) -> Column:
    """'yyyyMM' of a date held as br (dd/MM/yyyy), ts (timestamp), int / compact (yyyyMMdd as number / text) or iso (yyyy-MM-dd...)."""
    if encoding == "br":
        return F.date_format(F.try_to_timestamp(trim_str(c), F.lit("dd/MM/yyyy")), "yyyyMM")
    if encoding == "ts":
        return F.date_format(c, "yyyyMM")
    if encoding in ("int", "compact"):
        return F.substring(c.cast("string"), 1, 6)
    if encoding == "iso":
        return F.regexp_replace(F.substring(c.cast("string"), 1, 7), "-", "")
    raise ValueError(f"unknown date encoding: {encoding!r}")


def trim_str(c: Column) -> Column:
    return F.trim(c.cast("string"))


def cycle_bounds(cycle: str) -> tuple[dt.date, dt.date]:
    """First day of the cycle and of the next one ('yyyyMM' or 'yyyy-MM')."""
    year, month = int(norm_cycle(cycle)[:4]), int(norm_cycle(cycle)[4:6])
    after = dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(year, month, 1), after


def in_cycle(c: Column, cycle: str, encoding: str) -> Column:
    """Cycle filter on the raw column, so that it prunes files: a half-open range where the encoding sorts by date."""
    first, after = cycle_bounds(cycle)
    if encoding == "ts":
        return (c >= F.lit(first)) & (c < F.lit(after))
    if encoding == "int":
        return (c >= int(first.strftime("%Y%m%d"))) & (c < int(after.strftime("%Y%m%d")))
    if encoding == "compact":
        return (c >= first.strftime("%Y%m%d")) & (c < after.strftime("%Y%m%d"))
    if encoding == "iso":
        return (c >= first.isoformat()) & (c < after.isoformat())
    if encoding == "br":
        # dd/MM/yyyy does not sort by date: a substring match reaches the scan, the parsed cycle decides.
        return c.contains(first.strftime("/%m/%Y")) & (cycle_of(c, "br") == norm_cycle(cycle))
    raise ValueError(f"unknown date encoding: {encoding!r}")


def norm_cycle(text: str) -> str:
    """'2026-07' or '202607' -> '202607'."""
    return text.replace("-", "")


def cycle_to_lot(text: str) -> str:
    """'202607' or '2026-07' -> '2026-07'."""
    digits = norm_cycle(text)
    return f"{digits[:4]}-{digits[4:]}"


def norm_cycle_col(c: Column) -> Column:
    return F.regexp_replace(F.trim(c.cast("string")), "-", "")


def period_of(c: Column) -> Column:
    """'yyyy-MM' of a date or timestamp."""
    return F.date_format(c, "yyyy-MM")


def period_date(period: Column) -> Column:
    return F.to_date(F.concat(period, F.lit("-01")), "yyyy-MM-dd")


def month_gap(later: Column, earlier: Column) -> Column:
    """Whole months between two 'yyyy-MM' periods."""
    return F.months_between(period_date(later), period_date(earlier)).cast("int")

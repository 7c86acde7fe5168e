"""Calendar parts, date arithmetic and timestamp parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._columns import as_col


def to_ts(text: Column | str) -> Column:
    """Timestamp from text; null when it does not parse."""
    return as_col(text).try_cast("timestamp")


def now_utc() -> Column:
    return F.current_timestamp()


def booked_date(ts: Column | str) -> Column:
    """Day of a timestamp."""
    return F.to_date(as_col(ts))


def year(d: Column | str) -> Column:
    return F.year(as_col(d))


def month(d: Column | str) -> Column:
    return F.month(as_col(d))


def day(d: Column | str) -> Column:
    return F.dayofmonth(as_col(d))


def month_name(d: Column | str) -> Column:
    return F.date_format(as_col(d), "MMMM")


def quarter_no(d: Column | str) -> Column:
    return F.quarter(as_col(d))


def quarter_label(d: Column | str) -> Column:
    return F.concat(F.lit("Qtr "), quarter_no(d).cast("string"))


def short_date(d: Column | str) -> Column:
    """``M/d/yyyy``, the en-US short form."""
    return F.date_format(as_col(d), "M/d/yyyy")


def eomonth(d: Column | str, months: int = 0) -> Column:
    """Last day of the month ``months`` away."""
    return F.last_day(F.add_months(as_col(d), months))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(as_col(end), as_col(start))

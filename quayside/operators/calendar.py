"""Calendars. They hold one row per day of the observed range; whether one is broadcast is left to its size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import booked_date, day, month, month_name, quarter_label, quarter_no, year

DATE = "Date"

# The drill hierarchy and the columns its labels are ordered by.
HIERARCHY = ("Year", "Quarter", "Month", "Day")
SORT_BY = {"Month": "MonthNo", "Quarter": "QuarterNo"}


def calendar_parts(df: DataFrame, date: str = DATE) -> DataFrame:
    """Year, MonthNo, Month, QuarterNo, Quarter and Day of a date column."""
    return df.select(
        "*",
        year(date).alias("Year"),
        month(date).alias("MonthNo"),
        month_name(date).alias("Month"),
        quarter_no(date).alias("QuarterNo"),
        quarter_label(date).alias("Quarter"),
        day(date).alias("Day"),
    )


def _days(bounds: DataFrame) -> DataFrame:
    return bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence("lo", "hi")).alias(DATE))


def date_range(df: DataFrame, ts: str) -> DataFrame:
    """One row with the first and the last day."""
    return df.agg(booked_date(F.min(ts)).alias("lo"), booked_date(F.max(ts)).alias("hi"))


def calendar(df: DataFrame, ts: str) -> DataFrame:
    """Every day from the first to the last one observed."""
    return _days(date_range(df, ts))


def date_dimension(df: DataFrame, ts: str) -> DataFrame:
    """Every day of every year observed, with its calendar columns."""
    bounds = date_range(df, ts).select(
        F.make_date(F.year("lo"), F.lit(1), F.lit(1)).alias("lo"),
        F.make_date(F.year("hi"), F.lit(12), F.lit(31)).alias("hi"),
    )
    return calendar_parts(_days(bounds))


def calendar_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar of fixed days."""
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi"))
    return calendar_parts(_days(bounds))


def join_on_day(fact: DataFrame, ts: str, days: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Left join of a timestamp to a calendar by its date part only."""
    side = days.select(F.col(DATE).alias("_day"), *(columns or days.columns))
    return fact.join(side, booked_date(fact[ts]) == side["_day"], "left").drop("_day")


def order_label_by(df: DataFrame, label: str, key: str | None = None) -> DataFrame:
    """The distinct labels in the order of another column."""
    key = key or SORT_BY[label]
    return df.groupBy(label).agg(F.min(key).alias("_key")).orderBy("_key", label).select(label)


def ordered_labels(df: DataFrame, label: str, key: str | None = None) -> DataFrame:
    """One row with ``labels``, the distinct labels as an array in the order of another column.

    The array is sorted by value: rows of a sort may reach an aggregate in any order.
    """
    key = key or SORT_BY[label]
    firsts = df.groupBy(label).agg(F.min(key).alias("_key"))
    pairs = F.array_sort(F.collect_list(F.struct("_key", label)))
    return firsts.agg(F.transform(pairs, lambda pair: pair[label]).alias("labels"))

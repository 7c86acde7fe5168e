"""Aggregations that combine in two steps, defaults per column, and drill-down."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions._columns import as_col
from quayside.functions.dates import booked_date
from quayside.operators.calendar import DATE, HIERARCHY, calendar_parts

# How a column is summarised when a report just drops it in.
DEFAULT_SUMMARIES: dict[str, dict[str, str]] = {
    "CustomerTelephoneNumber": {"TelephoneNumber": "sum"},
    "Order": {"OrderTotalAmount": "sum", "NumberOfOrderLines": "sum"},
    "OrderLine": {"ProductSalesPriceAmount": "sum", "Quantity": "sum", "TotalOrderLineAmount": "sum"},
    "OrderLineStatus": {"OrderLineStatusTypeId": "count"},
    "Shipment": {"ShipmentFromLocationId": "count", "OriginationWarehouseId": "count"},
}


@dataclass(frozen=True)
class Agg:
    """A summary that can be pre-aggregated: sum, count, avg, min or max of a column."""

    kind: str
    column: str | Column

    def partials(self, name: str) -> list[Column]:
        value = as_col(self.column)
        steps = {
            "sum": [("s", F.sum(value))],
            "count": [("n", F.count(value))],
            "avg": [("s", F.sum(value)), ("n", F.count(value))],
            "min": [("lo", F.min(value))],
            "max": [("hi", F.max(value))],
        }
        return [state.alias(f"{name}__{part}") for part, state in steps[self.kind]]

    def states(self, name: str) -> list[str]:
        parts = {"sum": "s", "count": "n", "avg": "sn", "min": ["lo"], "max": ["hi"]}
        return [f"{name}__{part}" for part in parts[self.kind]]

    def merged(self, name: str, keep: Column | None = None) -> Column:
        """Final value over pre-aggregated rows, optionally only those where ``keep`` holds."""

        def over(part: str) -> Column:
            state = F.col(f"{name}__{part}")
            return state if keep is None else F.when(keep, state)

        if self.kind == "avg":
            return F.try_divide(F.sum(over("s")).cast("double"), F.sum(over("n")).cast("double"))
        if self.kind == "count":
            return F.coalesce(F.sum(over("n")), F.lit(0).cast("bigint"))
        return {"sum": lambda: F.sum(over("s")), "min": lambda: F.min(over("lo")), "max": lambda: F.max(over("hi"))}[
            self.kind
        ]()


def pre_aggregate(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Agg]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c for name, agg in aggs.items() for c in agg.partials(name)])


def summarize(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])


def sum_of(column: str | Column) -> Column:
    return F.sum(as_col(column))


def avg_of(column: str | Column) -> Column:
    """Mean of the values that are not blank."""
    return F.avg(as_col(column))


def count_of(column: str | Column) -> Column:
    return F.count(as_col(column))


def distinct_count(column: str | Column) -> Column:
    """Distinct values, with blank counted as one of them."""
    value = as_col(column)
    return F.count_distinct(value) + F.coalesce(F.max(value.isNull().cast("bigint")), F.lit(0).cast("bigint"))


def distinct_counts(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Distinct count per group in two combining steps, so a hot group is spread over its values."""
    values = df.select(*keys, column).distinct()
    return values.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def count_rows() -> Column:
    """Row count, blank when there is none."""
    return F.nullif(F.count(F.lit(1)), F.lit(0).cast("bigint"))


def calculate(kind: str, column: str | Column, *filters: Column) -> Column:
    """An aggregate over the rows that pass extra filters."""
    condition = F.lit(True)
    for extra in filters:
        condition = condition & extra
    return {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}[kind](
        F.when(condition, as_col(column))
    )


def default_aggs(table: str) -> dict[str, Column]:
    """Default summary per column of a table; other columns have none."""
    functions = {"sum": F.sum, "count": F.count}
    return {column: functions[kind](column).alias(column) for column, kind in DEFAULT_SUMMARIES.get(table, {}).items()}


def drill(df: DataFrame, date: str, level: str, aggs: Mapping[str, Agg]) -> DataFrame:
    """Measures per Year, Quarter, Month or Day. Rows are first combined per day."""
    levels = HIERARCHY[: HIERARCHY.index(level) + 1]
    daily = pre_aggregate(df.withColumn(DATE, booked_date(date)), [DATE], aggs)
    return calendar_parts(daily).groupBy(*levels).agg(*[agg.merged(name).alias(name) for name, agg in aggs.items()])


def drill_rollup(df: DataFrame, date: str, aggs: Mapping[str, Agg], levels: Sequence[str] = HIERARCHY) -> DataFrame:
    """All drill levels with their totals. The rollup expands daily rows, not facts."""
    daily = pre_aggregate(df.withColumn(DATE, booked_date(date)), [DATE], aggs)
    return calendar_parts(daily).rollup(*levels).agg(*[agg.merged(name).alias(name) for name, agg in aggs.items()])

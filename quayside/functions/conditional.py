"""Conditionals, including the metric layer's blank rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._columns import as_col


def typed_null(type_name: str = "string") -> Column:
    """A null literal that a table can store (a bare null has no type)."""
    return F.lit(None).cast(type_name)


def yes_no(flag: Column | str) -> Column:
    """``Yes`` for true, ``No`` for false and for null."""
    return F.when(as_col(flag), "Yes").otherwise("No")


def switch_map(value: Column | str, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """First mapping entry equal to the value, else the default (null unless given)."""
    column = as_col(value)
    return switch_true([(column == F.lit(key), result) for key, result in mapping.items()], default)


def switch_true(cases: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """Ordered condition list; the first true condition wins."""
    (condition, result), *rest = cases
    chain = reduce(lambda acc, case: acc.when(*case), rest, F.when(condition, result))
    return chain if default is None else chain.otherwise(default)


def blank_to(value: Column | str, default: Any = 0) -> Column:
    return F.coalesce(as_col(value), F.lit(default))


def is_null(value: Column | str) -> Column:
    return as_col(value).isNull()


def is_blank(value: Column | str) -> Column:
    """Blank is null, and only null: an empty text is not blank."""
    return as_col(value).isNull()


def not_blank_aware(flag: Column | str) -> Column:
    """NOT in the metric layer, where a blank operand counts as false (so NOT blank is true)."""
    return ~F.coalesce(as_col(flag), F.lit(False))


def null_if_empty(array: Column | str) -> Column:
    """Null for an empty array, the array otherwise."""
    column = as_col(array)
    return F.when(F.size(column) > 0, column)


def error_to_null(value: Column | str, type_name: str) -> Column:
    """Conversion that yields null where a strict cast would fail."""
    return as_col(value).try_cast(type_name)

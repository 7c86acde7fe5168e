"""Casts, ratios and display formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._columns import as_col
from quayside.functions.conditional import switch_true

# The growth marks shown in reports.
DOWN_MARK = "↘ "
UP_MARK = "↗ "


def to_decimal(value: Column | str, precision: int = 10, scale: int = 0) -> Column:
    """Half-up decimal; null when it does not parse or fit."""
    return as_col(value).try_cast(f"decimal({precision},{scale})")


def money(value: Column | str) -> Column:
    """Exact amounts, so that sums do not depend on the order of addition."""
    return to_decimal(value, 18, 2)


def to_long(value: Column | str) -> Column:
    return as_col(value).try_cast("bigint")


def to_int(value: Column | str) -> Column:
    return as_col(value).try_cast("int")


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Blank when the denominator is zero or blank."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def round0(value: Column | str) -> Column:
    """Half away from zero, as a whole number."""
    return F.round(as_col(value), 0).cast("bigint")


def growth(current: Column | str, previous: Column | str) -> Column:
    """Relative change. A blank current value counts as 0, a blank or zero previous one gives blank."""
    now = F.coalesce(as_col(current).cast("double"), F.lit(0.0))
    return safe_divide(now - as_col(previous).cast("double"), previous)


def growth_label(ratio: Column | str) -> Column:
    """``↗ 50%`` / ``↘ 50%``, empty text on blank, blank on exactly no change."""
    value = as_col(ratio)

    def percent(mark: str, amount: Column) -> Column:
        return F.concat(F.lit(mark), round0(amount).cast("string"), F.lit("%"))

    return switch_true(
        [
            (value.isNull(), F.lit("")),
            (value < 0, percent(DOWN_MARK, value * -100)),
            (value > 0, percent(UP_MARK, value * 100)),
        ]
    )


def format_currency(value: Column | str, decimals: int = 0, optional: bool = False) -> Column:
    """``$1,234``, negatives in brackets; ``optional`` drops trailing zero decimals."""
    rounded = F.round(as_col(value), decimals)
    shown = F.format_number(F.abs(rounded), decimals)
    if optional and decimals:
        shown = F.regexp_replace(shown, r"\.?0+$", "")
    return F.when(rounded < 0, F.concat(F.lit("($"), shown, F.lit(")"))).otherwise(F.concat(F.lit("$"), shown))


def format_boolean(flag: Column | str) -> Column:
    """``TRUE`` / ``FALSE``; null stays null."""
    return F.upper(as_col(flag).cast("string"))

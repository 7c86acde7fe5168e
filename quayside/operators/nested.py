"""Nested data: explode, pluck, first element, JSON bodies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions._columns import as_col


def explode_children(df: DataFrame, array: str, out: str | None = None, outer: bool = False) -> DataFrame:
    """One row per element; parents without elements are dropped, or kept with null when ``outer``."""
    name = out or array
    generate = F.explode_outer if outer else F.explode
    return df.select(*[c for c in df.columns if c not in (array, name)], generate(array).alias(name))


def explode_path(df: DataFrame, path: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Nested arrays, level by level: ``["Specs", "Options"]`` gives one row per option with its spec."""
    (first, *inner), (out, *outs) = path, names
    rows = df.select("*", F.explode(first).alias(out))
    for step, name in zip(inner, outs, strict=True):
        rows = rows.select("*", F.explode(f"{out}.{step}").alias(name))
        out = name
    return rows


def pluck(array: Column | str, field: str) -> Column:
    """One field of every element, as an array."""
    return as_col(array)[field]


def first_of(array: Column | str, field: str | None = None) -> Column:
    """First element or its field; null for empty and null arrays."""
    element = F.get(as_col(array), F.lit(0))
    return element if field is None else element[field]


def parse_event(body: Column | str, schema: T.StructType | str) -> Column:
    """A JSON text as a struct; null for text that is no JSON object."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return F.from_json(as_col(body), ddl)


def select_with(df: DataFrame, generated: Column, name: str) -> DataFrame:
    """All columns plus one computed or generated column."""
    return df.select("*", generated.alias(name))


def with_row_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Unique, increasing within a partition, not consecutive."""
    return df.withColumn(name, F.monotonically_increasing_id())


def collect_sorted_sets(df: DataFrame, key: str, array: str, out: str) -> DataFrame:
    """Distinct arrays per key in sorted order. Duplicates fall away before the shuffle."""
    return (
        df.where(F.col(array).isNotNull())
        .select(key, array)
        .distinct()
        .groupBy(key)
        .agg(F.sort_array(F.collect_set(array)).alias(out))
    )


def collect_ordered_distinct(df: DataFrame, keys: Sequence[str], value: str, order: str, out: str) -> DataFrame:
    """Distinct values per key, ordered by where each first appears in ``order``.

    Values are reduced to one row with their first position before they are
    gathered, so a list is as long as its distinct values.
    """
    firsts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("_at"))
    return firsts.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_at", value))), lambda e: e[value]).alias(out)
    )

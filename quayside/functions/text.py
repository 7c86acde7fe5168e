"""Key, label and phone texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions._columns import as_col

# They decide whether keys and labels equal those already in use.
KEY_PREFIX = "SC-"
SKU_SUFFIX = "-sku"
PHONE_TYPE = "decimal(10,0)"


def concat(*parts: Column | str) -> Column:
    """Null if any part is null."""
    return F.concat(*[as_col(p) for p in parts])


def concat_ws(separator: str, *parts: Column | str) -> Column:
    """Null parts are left out."""
    return F.concat_ws(separator, *[as_col(p) for p in parts])


def text_concat(*parts: Column | str) -> Column:
    """Text joining in the metric layer: blank parts count as empty text."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def upper(text: Column | str) -> Column:
    return F.upper(as_col(text))


def contains(text: Column | str, part: Column | str) -> Column:
    return F.contains(as_col(text), as_col(part))


def prefix_key(key: Column | str, prefix: str = KEY_PREFIX) -> Column:
    """``SC-<id>``; null stays null."""
    return F.concat(F.lit(prefix), as_col(key).cast("string"))


def external_key(primary: Column | str, fallback: Column | str, prefix: str = KEY_PREFIX) -> Column:
    """Prefixed id from the body or, when the body has none, from the route or query."""
    return prefix_key(F.coalesce(as_col(primary).cast("string"), as_col(fallback).cast("string")), prefix)


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first last``; null if either is null."""
    return F.concat(as_col(first), F.lit(" "), as_col(last))


def clean_phone(phone: Column | str) -> Column:
    """Whitespace removed, a plus sign written as the 00 dialling prefix; still text."""
    return F.regexp_replace(F.regexp_replace(as_col(phone), r"\s+", ""), r"\+", "00")


def normalize_phone(phone: Column | str) -> Column:
    """Phone as a ten-digit number; null when it is no number or too long."""
    return clean_phone(phone).try_cast(PHONE_TYPE)


def item_sku(product_id: Column | str, specs: Column | str) -> Column:
    """``<product id>-sku`` for products with specs, null without."""
    return F.when(F.size(as_col(specs)) > 0, F.concat(as_col(product_id), F.lit(SKU_SUFFIX)))


def item_name(name: Column | str, values: Column | str, specs: Column | str) -> Column:
    """``<name>-<v1>.<v2>`` for products with specs, the plain name without.

    ``values`` holds the characteristic values in label order. It is null for a
    product with specs but no characteristics, which then has no item name.
    """
    label = F.when(as_col(values).isNotNull(), F.concat_ws("-", as_col(name), F.array_join(as_col(values), ".")))
    return F.when(F.size(as_col(specs)) > 0, label).otherwise(as_col(name))

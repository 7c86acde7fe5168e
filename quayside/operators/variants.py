"""Product options to variants, as column expressions on the product's own row.

A product document carries its specs and their options, so every variant row
knows the options it was built from. Only products with very many variants are
moved, to spread them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions._columns import as_col


#: Numbers that one row counts out before they are cut into ranges.
RANGE = 1024


def _option_ids(spec: Column) -> Column:
    return F.filter(F.transform(spec["Options"], lambda o: o["ID"]), lambda v: v.isNotNull())


def _with_options(specs: Column | str) -> Column:
    return F.filter(as_col(specs), lambda s: s["Options"].isNotNull())


def option_lists(specs: Column | str) -> Column:
    """Option ids per spec: lists in sorted order, equal lists once, null ids left out."""
    return F.array_sort(F.array_distinct(F.transform(_with_options(specs), _option_ids)))


def variant_count(lists: Column) -> Column:
    """How many combinations the lists have: the product of their lengths."""
    return F.when(F.size(lists) > 0, F.aggregate(lists, F.lit(1).cast("bigint"), lambda n, o: n * F.size(o)))


def _weights(lists: Column) -> Column:
    """Place value of every list, last list fastest."""
    return F.transform(
        lists,
        lambda _, i: F.aggregate(
            F.slice(lists, i + 2, F.size(lists)), F.lit(1).cast("bigint"), lambda n, o: n * F.size(o)
        ),
    )


def _described(spec: Column, option: Column) -> Column:
    return F.struct(spec["ID"].alias("spec_id"), option["ID"].alias("option_id"), option["Value"].alias("value"))


def option_members(specs: Column | str, lists: Column | str) -> Column:
    """What each option of each list stands for: per list, per option, its (spec id, option id, value).

    A list belongs to the specs that have exactly these options; usually one.
    Worked out once per product, so that a variant only picks by position.
    """

    def of_option(options: Column, option: Column) -> Column:
        owners = F.filter(_with_options(specs), lambda s: _option_ids(s) == options)
        return F.flatten(
            F.transform(
                owners,
                lambda s: F.transform(F.filter(s["Options"], lambda o: o["ID"] == option), lambda o: _described(s, o)),
            )
        )

    return F.transform(as_col(lists), lambda options: F.transform(options, lambda option: of_option(options, option)))


def deal_products(df: DataFrame, product: str) -> DataFrame:
    """Products dealt over as many tasks as a shuffle has, by id.

    A product takes few bytes in storage and long to expand, so the splits of a file are too few tasks for it.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), product)


def expand_variants(
    df: DataFrame,
    product: str,
    lists: str,
    out: str = "ProductID",
    options: str = "OptionIDs",
    members: str | None = None,
    characteristics: str = "characteristics",
) -> DataFrame:
    """One row per combination of options: ``<product>-<o1>-<o2>`` and its option ids.

    Combination n is written in the mixed-radix number system of the list
    lengths, so a row is generated per number instead of building all texts in
    one value; a product with very many is spread over the tasks in ranges of
    numbers. Products without a combination keep one row with a null variant.
    Other products are expanded where they are: ``deal_products`` first if there are many.
    With ``members`` the rows also carry the characteristics of their options.
    """
    column = F.col(lists)
    rows = spread_numbers(df.withColumn("_w", _weights(column)), variant_count(column), "_v")
    digits = F.zip_with(
        column, F.col("_w"), lambda o, w: (F.call_function("div", F.col("_v"), w) % F.size(o)).cast("int")
    )
    rows = rows.withColumn("_digits", F.when(F.col("_v").isNotNull(), digits))
    rows = rows.withColumn(options, F.zip_with(column, "_digits", lambda o, d: F.get(o, d)))
    variant = F.when(F.col("_v").isNotNull(), F.concat_ws("-", F.col(product), F.array_join(options, "-")))
    rows = rows.withColumn(out, variant)
    if members is not None:
        picked = F.flatten(F.zip_with(members, "_digits", lambda m, d: F.get(m, d)))
        rows = rows.withColumn(characteristics, F.array_distinct(picked))
    return rows.drop("_w", "_v", "_digits")


def spread_numbers(df: DataFrame, total: Column, out: str, width: int = RANGE) -> DataFrame:
    """Numbers from 0 up to ``total`` as rows; one row with null where there are none.

    The numbers of a row that has more than ``width`` of them are first cut into ranges, which become rows and are dealt
    evenly over the tasks before they are counted out. So no value grows with ``total``, and a row with very many numbers
    is spread like very many rows. Other rows are not moved.
    """
    rows = df.withColumn("_total", F.coalesce(total, F.lit(0).cast("bigint")))
    one = F.lit(1).cast("bigint")
    # both halves leave rows out by numbers they do not have: a filter would be worked out before the rows are dealt
    own = F.when(F.col("_total") == 0, F.array(F.lit(None).cast("bigint")))
    own = own.when(F.col("_total") <= width, F.sequence(F.lit(0).cast("bigint"), F.col("_total") - one))
    few = rows.select("*", F.explode(own).alias(out))

    def cut(frame: DataFrame, start: str, size: Column | int, step: int, name: str) -> DataFrame:
        first = F.col(start) if start else F.lit(0).cast("bigint")
        last = F.least(first + size - one, F.col("_total") - one)
        numbers = F.when(F.col("_total") > width, F.sequence(first, last, F.lit(step).cast("bigint")))
        return frame.select("*", F.explode(numbers).alias(name))

    wide = cut(rows, "", F.col("_total"), width * width, "_far")
    wide = cut(wide, "_far", width * width, width, "_near").drop("_far")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = cut(wide.repartition(tasks), "_near", width, 1, out).drop("_near")
    return few.unionByName(many).drop("_total")


def contains_match(specs: Column | str, variant: Column | str) -> Column:
    """The options whose id occurs anywhere in the variant id, so ``1`` also belongs to ``...-10``."""

    def found(spec: Column) -> Column:
        mine = F.filter(spec["Options"], lambda o: F.contains(as_col(variant), o["ID"]))
        return F.transform(mine, lambda o: _described(spec, o))

    return F.array_distinct(F.flatten(F.transform(_with_options(specs), found)))


def label_values(characteristics: Column | str) -> Column:
    """Characteristic values in option order, repeats and nulls left out; null without characteristics."""
    ordered = F.sort_array(
        F.transform(as_col(characteristics), lambda c: F.struct(c["option_id"].alias("o"), c["value"].alias("v")))
    )
    values = F.array_distinct(F.filter(F.transform(ordered, lambda c: c["v"]), lambda v: v.isNotNull()))
    return F.when(F.size(as_col(characteristics)) > 0, values)

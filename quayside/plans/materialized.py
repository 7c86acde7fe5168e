"""A snapshot of the star laid out for its joins: the refreshed copy that metric queries read.

Tables are bucketed and sorted by the key they are joined on, so joins along it need no shuffle. The fact is cut into
folders by booked month besides, so a query over selected dates opens only the months it needs.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.calendar import date_dimension
from quayside.plans.measures import DATE_TABLE, FACT, MONTH
from quayside.plans.schemas import SILVER_KEYS

#: Where a table is joined on another column than its own key.
JOIN_KEYS = SILVER_KEYS | {FACT: "CustomerId", "CustomerLocation": "LocationId", "RelatedProduct": "ProductId"}


def materialize_star(
    tables: Mapping[str, DataFrame], path: str, *, prefix: str, buckets: int = 64, keys: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """Write the tables below ``path`` as catalog tables ``<prefix>_<name>`` and return them, with a Date table.

    Choose ``buckets`` so that a bucket of the largest table holds some hundred megabytes. A key that holds a large share
    of a table's rows makes one bucket that large: leave such a table out of ``keys`` and it is written without buckets,
    to be joined by a shuffle that adaptive execution may split. Orders without a date lie in a folder of their own.
    """
    keys = JOIN_KEYS if keys is None else keys
    orders = tables[FACT]
    given = dict(tables)
    if DATE_TABLE not in given:
        given[DATE_TABLE] = date_dimension(orders, "OrderBookedDate")
    given[FACT] = orders.withColumn(MONTH, F.trunc("OrderBookedDate", "month"))
    spark, result = orders.sparkSession, {}
    for name, df in given.items():
        key = keys.get(name)
        if key in df.columns:
            # one task holds one bucket whole, so a bucket is one file in each month
            writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        else:
            writer = df.write
        if name == FACT:
            if key not in df.columns:
                writer = df.repartitionByRange(MONTH).write
            writer = writer.partitionBy(MONTH)
        table = f"{prefix}_{name}"
        writer.format("parquet").mode("overwrite").option("path", f"{path}/{name}").saveAsTable(f"`{table}`")
        result[name] = spark.table(f"`{table}`")
    return result

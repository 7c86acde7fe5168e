"""The retail star: its relationships and its fixed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.functions.conditional import switch_map
from quayside.operators.star import Relationship
from quayside.sources.tables import seed_dimension

# Rows of the seeded dimensions.
ORDER_STATUS_NAMES = ["Unsubmitted", "AwaitingApproval", "Declined", "Open", "Completed", "Canceled"]
ORDER_TYPE_NAMES = ["Online Sale"]
VARIANT_RELATIONSHIP = "variant-relationship"
VARIANT_RELATIONSHIP_NAME = "Variant"

# Sales grouping of the order status.
STATUS_FOR_SALES_REVENUE = {
    "Completed": "Completed",
    "Open": "Completed",
    "Returned": "Returned/Canceled",
    "Canceled": "Returned/Canceled",
}

# Timestamp columns with a calendar of their own, joined by date part.
CALENDAR_COLUMNS = [
    ("Catalog", "CatalogEffectivePeriodStartDate"),
    ("Catalog", "CatalogEffectivePeriodEndDate"),
    ("CustomerLocation", "PeriodStartTimestamp"),
    ("CustomerLocation", "PeriodEndTimestamp"),
    ("CustomerGroupCustomer", "PeriodStartDate"),
    ("CustomerGroupCustomer", "PeriodEndDate"),
    ("Order", "OrderBookedDate"),
    ("OrderLineStatus", "OrderLineStatusStartTimestamp"),
    ("OrderLineStatus", "OrderLineStatusEndTimestamp"),
    ("OrderStatus", "OrderStatusStartTimestamp"),
    ("OrderStatus", "OrderStatusEndTimestamp"),
    ("ProductCharacteristic", "ProductCharacteristicPeriodStartDate"),
    ("ProductCharacteristic", "ProductCharacteristicPeriodEndDate"),
]


def calendar_name(table: str, column: str) -> str:
    return f"{table}.{column} calendar"


RELATIONSHIPS: list[Relationship] = [
    Relationship("IndividualCustomer", "CustomerId", "CustomerEmail", "CustomerId", one_to_one=True, both=True),
    Relationship("CustomerTelephoneNumber", "CustomerId", "IndividualCustomer", "CustomerId", one_to_one=True, both=True),
    Relationship("CustomerLocation", "CustomerId", "IndividualCustomer", "CustomerId", one_to_one=True, both=True),
    Relationship("Location", "LocationId", "CustomerLocation", "LocationId", one_to_one=True, both=True),
    Relationship("Location", "CountryId", "Country", "CountryId"),
    Relationship("Shipment", "ShipmentToLocationId", "Location", "LocationId", both=True),
    Relationship("CustomerGroupCustomer", "CustomerGroupId", "CustomerGroup", "CustomerGroupId", both=True),
    Relationship("CustomerGroupCustomer", "CustomerId", "IndividualCustomer", "CustomerId", both=True),
    Relationship("Order", "CustomerId", "IndividualCustomer", "CustomerId", both=True),
    Relationship("Order", "OrderTypeId", "OrderType", "OrderTypeId"),
    Relationship("Order", "_OrderBookedDate", "Date", "Date"),
    Relationship("OrderStatus", "OrderId", "Order", "OrderId", one_to_one=True, both=True),
    Relationship("OrderStatus", "OrderStatusTypeId", "OrderStatusType", "OrderStatusTypeId"),
    Relationship("OrderLine", "OrderId", "Order", "OrderId"),
    Relationship("OrderLine", "OrderLineId", "OrderLineStatus", "OrderLineId", one_to_one=True, both=True, active=False),
    Relationship("OrderLine", "ProductId", "RetailProduct", "ProductId", both=True),
    Relationship("RetailProduct", "ProductId", "Item", "ProductId", one_to_one=True, both=True),
    Relationship("RetailProduct", "CatalogId", "Catalog", "CatalogId"),
    Relationship("RetailProduct", "CategoryId", "ProductCategory", "ProductCategoryId"),
    Relationship("ProductCharacteristic", "ProductId", "RetailProduct", "ProductId"),
    Relationship(
        "ProductCharacteristic", "ProductCharacteristicTypeId", "ProductCharacteristicType", "ProductCharacteristicTypeId"
    ),
    Relationship("RelatedProduct", "ProductId", "RetailProduct", "ProductId"),
    Relationship(
        "RelatedProduct", "ProductRelationshipTypeId", "ProductRelationshipType", "ProductRelationshipTypeId"
    ),
    *[Relationship(t, c, calendar_name(t, c), "Date", day_only=True) for t, c in CALENDAR_COLUMNS],
]


def relationship(from_table: str, to_table: str, column: str | None = None) -> Relationship:
    """The edge between two tables."""
    for rel in RELATIONSHIPS:
        if (rel.from_table, rel.to_table) == (from_table, to_table) and column in (None, rel.from_column):
            return rel
    raise ValueError(f"no relationship {from_table} -> {to_table}")


def order_status_types(spark: SparkSession) -> DataFrame:
    columns = ["OrderStatusTypeId", "OrderStatusTypeName", "OrderStatusTypeDescription"]
    return seed_dimension(spark, range(len(ORDER_STATUS_NAMES)), ORDER_STATUS_NAMES, columns)


def order_types(spark: SparkSession) -> DataFrame:
    columns = ["OrderTypeId", "OrderTypeName", "OrderTypeDescription"]
    return seed_dimension(spark, [1], ORDER_TYPE_NAMES, columns)


def relationship_types(spark: SparkSession) -> DataFrame:
    columns = ["ProductRelationshipTypeId", "ProductRelationshipTypeName"]
    return seed_dimension(spark, [VARIANT_RELATIONSHIP], [VARIANT_RELATIONSHIP_NAME], columns)


def add_orderstatusforsalesrevenue(df: DataFrame) -> DataFrame:
    """Sales grouping of an order status; blank for other statuses."""
    return df.withColumn("_OrderStatusForSalesRevenue", switch_map("OrderStatusTypeName", STATUS_FOR_SALES_REVENUE))

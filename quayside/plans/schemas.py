"""Column contracts of the bronze events and the silver star.

Fixed values: names and types are the interface to producers and reports.
"""

from __future__ import annotations

from pyspark.sql import types as T

META = "EventProcessedUtcTime timestamp, PartitionId bigint, EventEnqueuedUtcTime timestamp"
CALL = "Verb string, Date string, LogID string, UserToken string, ConfigData string"
ERROR_LIST = "array<struct<ErrorCode:string,Message:string,Data:struct<ObjectType:string,ObjectID:string>>>"

ADDRESS_BODY = (
    "ID:string,CompanyName:string,FirstName:string,LastName:string,Street1:string,Street2:string,City:string,"
    "State:string,Zip:string,Country:string,Phone:string,AddressName:string,xp:string"
)
CATALOG_BODY = "ID:string,OwnerID:string,Name:string,Description:string,Active:boolean,xp:string"
CATEGORY_BODY = (
    "ID:string,Name:string,Description:string,ListOrder:bigint,Active:boolean,ParentID:string,ChildCount:bigint,xp:string"
)
GROUP_BODY = "ID:string,Name:string,Description:string,xp:string"
USER_BODY = (
    "ID:string,CompanyID:string,Username:string,Password:string,FirstName:string,LastName:string,Email:string,"
    "Phone:string,TermsAccepted:string,Active:boolean,xp:string"
)
USER_ACCOUNT = f"{USER_BODY},AvailableRoles:string,Locale:string,DateCreated:string,PasswordLastSetDate:string"

LINE = (
    "struct<ID:string,ProductID:string,Quantity:bigint,BundleItemID:string,IsBundle:boolean,DateAdded:string,"
    "QuantityShipped:bigint,UnitPrice:double,PromotionDiscount:double,LineTotal:double,LineSubtotal:double,"
    "CostCenter:string,DateNeeded:string,ShippingAccount:string,ShippingAddressID:string,ShipFromAddressID:string,"
    "Product:struct<ID:string,Name:string,Description:string,Returnable:boolean,QuantityMultiplier:bigint,"
    "ShipWeight:string,ShipHeight:string,ShipWidth:string,ShipLength:string,DefaultSupplierID:string,"
    "ParentID:string,xp:string>,Variant:string,ShippingAddress:string,ShipFromAddress:string,SupplierID:string,"
    "InventoryRecordID:string,PriceScheduleID:string,PriceOverridden:boolean,Specs:array<string>,xp:string>"
)
OPTION = (
    "struct<ID:string,Value:string,ListOrder:bigint,IsOpenText:boolean,PriceMarkupType:string,PriceMarkup:double,xp:string>"
)
SPEC = (
    "struct<OwnerID:string,ID:string,ListOrder:bigint,Name:string,DefaultValue:string,Required:boolean,"
    "AllowOpenText:boolean,DefaultOptionID:string,DefinesVariant:boolean,xp:string,OptionCount:bigint,"
    f"Options:array<{OPTION}>>"
)
INVENTORY = (
    "struct<Enabled:boolean,NotificationPoint:bigint,VariantLevelTracking:boolean,OrderCanExceed:boolean,"
    "QuantityAvailable:bigint,LastUpdated:string>"
)


def _call(route: str, request: str, response: str, query: str | None = None, headers: bool = True) -> str:
    """Envelope of one API call."""
    tail = ",Headers:string" if headers else ""
    params = f"RouteParams struct<{route}>" + (f", QueryParams struct<{query}>" if query else "")
    return (
        f"Route string, {params}, {CALL}, Request struct<Body:struct<{request}>{tail}>, "
        f"Response struct<Body:struct<{response}>{tail}>, {META}"
    )


_BRONZE_DDL = {
    "AddressAssignments": _call(
        "buyerID:string,addressID:string",
        "UserID:string,UserGroupID:string,AddressID:string",
        f"Errors:{ERROR_LIST}",
        query="userID:string,userGroupID:string",
    ),
    "Addresses": _call("buyerID:string,addressID:string", ADDRESS_BODY, f"DateCreated:string,{ADDRESS_BODY}"),
    "Catalogs": _call("catalogID:string", CATALOG_BODY, f"{CATALOG_BODY},CategoryCount:bigint"),
    "Categories": _call("catalogID:string,categoryID:string", CATEGORY_BODY, CATEGORY_BODY),
    "Orders": (
        f"ID string, FromUser struct<{USER_ACCOUNT}>, FromCompanyID string, ToCompanyID string, FromUserID string, "
        "BillingAddressID string, BillingAddress string, ShippingAddressID string, Comments string, "
        "LineItemCount bigint, Status bigint, DateCreated string, DateSubmitted string, DateApproved string, "
        "DateDeclined string, DateCanceled string, DateCompleted string, LastUpdated string, Subtotal double, "
        "ShippingCost double, TaxCost double, PromotionDiscount double, Currency string, Total double, "
        f"IsSubmitted boolean, SubscriptionID string, xp string, LineItems array<{LINE}>, Shipments array<string>, "
        f"Payments array<string>, UserContext struct<ID:string,AnonymousID:string>, {META}"
    ),
    "Products": (
        "UserContext struct<ID:string,AnonymousID:string>, ProductID string, Marketplace string, OwnerID string, "
        "Name string, Description string, QuantityMultiplier bigint, ShipWeight double, ShipHeight double, "
        "ShipWidth double, ShipLength double, Active boolean, AutoForward boolean, SpecCount bigint, "
        f"VariantCount bigint, ShipFromAddressID string, Inventory {INVENTORY}, DefaultSupplierID string, "
        "AllSuppliersCanSell boolean, DefaultPriceScheduleID string, Returnable boolean, xp string, "
        "Catalogs array<string>, Categories array<struct<ID:string,ListOrder:bigint>>, Suppliers array<string>, "
        f"Buyers array<string>, UserGroups array<string>, Specs array<{SPEC}>, {META}"
    ),
    "Users": _call("buyerID:string,userID:string", USER_BODY, USER_ACCOUNT),
    "UserGroupAssignments": _call(
        "buyerID:string,userGroupID:string,userID:string",
        "UserGroupID:string,UserID:string",
        f"Errors:{ERROR_LIST}",
        headers=False,
    ),
    "UserGroups": _call("buyerID:string,userGroupID:string", GROUP_BODY, GROUP_BODY),
}

BRONZE_TABLES = list(_BRONZE_DDL)


def bronze(entity: str) -> T.StructType:
    """The columns of a bronze table. Needs a running session, which parses the text."""
    return T.StructType.fromDDL(_BRONZE_DDL[entity])


# The key column that deals a silver table's rows to buckets: part of every key its rows are matched on.
SILVER_KEYS = {
    "Catalog": "CatalogId",
    "Country": "CountryId",
    "CustomerEmail": "CustomerId",
    "CustomerGroup": "CustomerGroupId",
    "CustomerGroupCustomer": "CustomerId",
    "CustomerLocation": "CustomerId",
    "CustomerTelephoneNumber": "CustomerId",
    "IndividualCustomer": "CustomerId",
    "Item": "ProductId",
    "Location": "LocationId",
    "Order": "OrderId",
    "OrderLine": "OrderId",
    "OrderLineStatus": "OrderId",
    "OrderStatus": "OrderId",
    "OrderStatusType": "OrderStatusTypeId",
    "OrderType": "OrderTypeId",
    "ProductCategory": "ProductCategoryId",
    "ProductCharacteristic": "ProductId",
    "ProductCharacteristicType": "ProductCharacteristicTypeId",
    "ProductRelationshipType": "ProductRelationshipTypeId",
    "RelatedProduct": "RelatedProductId",
    "RetailProduct": "ProductId",
    "Shipment": "ShipmentOrderId",
}


def silver(amount: str = "decimal(18,2)", location_id: str = "string") -> dict[str, T.StructType]:
    """The silver tables. Amounts keep cents and shipments refer to locations by their text id."""
    ddl = {
        "Catalog": "CatalogId string, CatalogName string, CatalogDescription string, "
        "CatalogEffectivePeriodStartDate timestamp, CatalogEffectivePeriodEndDate timestamp",
        "Country": "CountryId bigint, IsoCountryName string, Iso2LetterCountryName string, Iso3LetterCountryName string",
        "CustomerEmail": "CustomerId string, EmailAddress string",
        "CustomerLocation": "CustomerId string, LocationId string, PeriodStartTimestamp timestamp, PeriodEndTimestamp timestamp",
        "CustomerTelephoneNumber": "CustomerId string, TelephoneNumber decimal(10,0)",
        "CustomerGroup": "CustomerGroupId string, CustomerGroupName string, CustomerGroupDescription string",
        "CustomerGroupCustomer": "CustomerGroupId string, CustomerId string, PeriodStartDate timestamp, "
        "PeriodEndDate timestamp, CustomerGroupNote string",
        "IndividualCustomer": "CustomerId string, IndividualCustomerName string",
        "Item": "ProductId string, ItemSku string, ItemName string, ItemDescription string",
        "Location": "LocationId string, LocationAddressLine1 string, LocationAddressLine2 string, LocationCity string, "
        "LocationZipCode string, CountryId bigint, LocationName string, LocationDescription string",
        "Order": f"OrderId string, CustomerId string, OrderTypeId bigint, OrderBookedDate timestamp, "
        f"OrderTotalAmount {amount}, NumberOfOrderLines int",
        "OrderLine": f"OrderId string, OrderLineId string, ProductId string, ProductSalesPriceAmount {amount}, "
        f"Quantity {amount}, TotalOrderLineAmount {amount}",
        "OrderLineStatus": "OrderId string, OrderLineId string, OrderLineStatusStartTimestamp timestamp, "
        "OrderLineStatusEndTimestamp timestamp, OrderLineStatusTypeId int",
        "OrderStatus": "OrderId string, OrderStatusStartTimestamp timestamp, OrderStatusEndTimestamp timestamp, "
        "OrderStatusTypeId int",
        "OrderStatusType": "OrderStatusTypeId bigint, OrderStatusTypeName string, OrderStatusTypeDescription string",
        "OrderType": "OrderTypeId bigint, OrderTypeName string, OrderTypeDescription string",
        "ProductCategory": "ProductCategoryId string, ProductCategoryName string, ProductCategoryDescription string",
        "ProductCharacteristic": "ProductId string, ProductCharacteristicTypeId string, ProductCharacteristic string, "
        "ProductCharacteristicPeriodStartDate timestamp, ProductCharacteristicPeriodEndDate timestamp, "
        "ProductCharacteristicNote string",
        "ProductCharacteristicType": "ProductCharacteristicTypeId string, ProductCharacteristicTypeName string",
        "ProductRelationshipType": "ProductRelationshipTypeId string, ProductRelationshipTypeName string",
        "RelatedProduct": "ProductId string, RelatedProductId string, ProductRelationshipTypeId string",
        "RetailProduct": "ProductId string, ProductName string, ProductDescription string, ReturnPolicyStatement string, "
        "ReturnPolicyPeriodInDays string, ItemSku string, CatalogId string, CategoryId string",
        "Shipment": f"ShipmentId string, ShipmentOrderId string, ShipmentFromLocationId {location_id}, "
        f"OriginationWarehouseId int, ShipmentFromName string, ShipmentToName string, ShipmentToLocationId {location_id}",
    }
    return {name: T.StructType.fromDDL(text) for name, text in ddl.items()}


# The tables that mapping runs fill, and so may be emptied before a full reload.
MAPPED_TABLES = [
    "Catalog",
    "CustomerEmail",
    "CustomerLocation",
    "CustomerTelephoneNumber",
    "CustomerGroup",
    "CustomerGroupCustomer",
    "IndividualCustomer",
    "Item",
    "Location",
    "Order",
    "OrderLine",
    "OrderLineStatus",
    "OrderStatus",
    "ProductCategory",
    "ProductCharacteristic",
    "ProductCharacteristicType",
    "RelatedProduct",
    "RetailProduct",
    "Shipment",
]

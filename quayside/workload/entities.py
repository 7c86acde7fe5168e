"""The nine entity jobs over bronze events made of the given tables, and the landing jobs.

Targets start with rows of their own, so that every job updates, inserts and
deletes: locations exist for all suppliers, customers for all customers, and so on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.plans import entities as jobs
from quayside.plans.medallion import read_countries, read_samples
from quayside.plans.schemas import silver
from quayside.session import empty_frame, run_dir
from quayside.sources.tables import conform
from quayside.workload import bronze, query
from quayside.workload.inputs import load
from quayside.workload.nested import PRODUCTS_SQL

START, END = "TIMESTAMP '2000-11-16 13:06:46.713'", "TIMESTAMP '2999-11-16 13:06:46.713'"


def target(spark, name: str, rows: DataFrame | None = None) -> DataFrame:
    schema = silver()[name]
    return empty_frame(spark, schema) if rows is None else conform(rows, schema)


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Result columns in types that both engines share."""
    kinds = dict(df.dtypes)
    return df.select(
        [
            F.col(c).cast("timestamp_ntz").alias(c)
            if kinds[c] == "timestamp"
            else F.col(c).cast("double").alias(c)
            if kinds[c].startswith("decimal")
            else F.col(c)
            for c in (columns or df.columns)
        ]
    )


def _stacked(parts: dict[str, DataFrame], **columns: tuple[str, str]) -> DataFrame:
    """Several targets as (table, key, value) rows."""
    result = None
    for name, (key, value) in columns.items():
        part = parts[name].select(
            F.lit(name).alias("target"), F.col(key).alias("key"), F.col(value).cast("string").alias("value")
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "pipeline_users",
    """WITH u AS (SELECT 'SC-' || c_custkey::VARCHAR AS key, c_name, c_acctbal, c_custkey,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END || ' ' || c_name AS full_name,
      '001' || c_nationkey::VARCHAR || c_custkey::VARCHAR AS phone FROM customer WHERE c_acctbal >= 0)
    SELECT 'IndividualCustomer' AS target, key, full_name AS value FROM u
    UNION ALL SELECT 'CustomerEmail', key, lower(c_name) || '@example.com' FROM u
    UNION ALL SELECT 'CustomerTelephoneNumber', key, TRY_CAST(phone AS DECIMAL(10,0))::VARCHAR FROM u""",
)
def users(spark, sf):
    known = load(spark, sf, "customer").select(
        F.concat(F.lit("SC-"), F.col("c_custkey").cast("string")).alias("CustomerId"),
        F.lit("old").alias("IndividualCustomerName"),
    )
    targets = {
        "IndividualCustomer": target(spark, "IndividualCustomer", known),
        "CustomerEmail": target(spark, "CustomerEmail"),
        "CustomerTelephoneNumber": target(spark, "CustomerTelephoneNumber", known),
    }
    return _stacked(
        jobs.run_users(bronze.users(spark, sf), targets, jobs.Run(staging=run_dir(spark, "users"))),
        IndividualCustomer=("CustomerId", "IndividualCustomerName"),
        CustomerEmail=("CustomerId", "EmailAddress"),
        CustomerTelephoneNumber=("CustomerId", "TelephoneNumber"),
    )


@query(
    "pipeline_addresses",
    """SELECT 'SC-' || s_suppkey::VARCHAR AS "LocationId", s_suppkey::VARCHAR || ' Main Street' AS "LocationAddressLine1",
       CAST(NULL AS VARCHAR) AS "LocationAddressLine2", 'City ' || s_nationkey::VARCHAR AS "LocationCity",
       s_nationkey::VARCHAR AS "LocationZipCode", CAST(s_nationkey AS BIGINT) AS "CountryId", s_name AS "LocationName",
       CAST(NULL AS VARCHAR) AS "LocationDescription" FROM supplier WHERE s_acctbal >= 0""",
)
def addresses(spark, sf):
    nations = load(spark, sf, "nation")
    key = F.col("n_nationkey").cast("string")
    country = nations.select(
        F.col("n_nationkey").alias("CountryId"),
        F.concat(F.lit("N"), key).alias("Iso2LetterCountryName"),
        F.col("n_name").alias("Iso3LetterCountryName"),
    )
    known = load(spark, sf, "supplier").select(
        F.concat(F.lit("SC-"), F.col("s_suppkey").cast("string")).alias("LocationId"), F.lit("old").alias("LocationCity")
    )
    targets = {"Location": target(spark, "Location", known), "Country": target(spark, "Country", country)}
    return jobs.run_addresses(bronze.addresses(spark, sf), targets, jobs.Run(staging=run_dir(spark, "addresses")))["Location"]


@query(
    "pipeline_address_assignments",
    f"""SELECT 'SC-' || c_custkey::VARCHAR AS "CustomerId", CASE WHEN c_acctbal >= 0 THEN 'SC-' || c_nationkey::VARCHAR
       ELSE 'old' END AS "LocationId", CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '2024-01-01 00:00:00' END AS "PeriodStartTimestamp",
       CASE WHEN c_acctbal >= 0 THEN {END} END AS "PeriodEndTimestamp" FROM customer""",
)
def address_assignments(spark, sf):
    known = load(spark, sf, "customer").select(
        F.concat(F.lit("SC-"), F.col("c_custkey").cast("string")).alias("CustomerId"), F.lit("old").alias("LocationId")
    )
    targets = {"CustomerLocation": target(spark, "CustomerLocation", known)}
    return shown(jobs.run_address_assignments(bronze.address_assignments(spark, sf), targets)["CustomerLocation"])


@query(
    "pipeline_catalogs",
    f"""SELECT 'SC-' || n_nationkey::VARCHAR AS "CatalogId", n_name AS "CatalogName", 'region ' || n_regionkey::VARCHAR AS
       "CatalogDescription", TIMESTAMP '2024-01-01 00:00:00' AS "CatalogEffectivePeriodStartDate",
       {END} AS "CatalogEffectivePeriodEndDate" FROM nation WHERE n_regionkey <> 0""",
)
def catalogs(spark, sf):
    """Nations as catalogs; those of the first region are withdrawn."""
    verb = F.when(F.col("n_regionkey") == 0, "DELETE").otherwise("POST")
    description = F.concat(F.lit("region "), F.col("n_regionkey").cast("string"))
    changes = bronze.named(spark, sf, "nation", "n_nationkey", "n_name", description, verb, "catalogID")
    known = load(spark, sf, "nation").select(
        F.concat(F.lit("SC-"), F.col("n_nationkey").cast("string")).alias("CatalogId")
    )
    return shown(jobs.run_catalogs(changes, {"Catalog": target(spark, "Catalog", known)})["Catalog"])


@query(
    "pipeline_categories",
    """SELECT 'SC-' || p_partkey::VARCHAR AS "ProductCategoryId", p_name AS "ProductCategoryName", p_type AS
       "ProductCategoryDescription" FROM part WHERE p_type <> 'PROMO'""",
)
def categories(spark, sf):
    verb = F.when(F.col("p_type") == "PROMO", "DELETE").otherwise("POST")
    changes = bronze.named(spark, sf, "part", "p_partkey", "p_name", F.col("p_type"), verb, "categoryID")
    known = load(spark, sf, "part").select(
        F.concat(F.lit("SC-"), F.col("p_partkey").cast("string")).alias("ProductCategoryId")
    )
    targets = {"ProductCategory": target(spark, "ProductCategory", known)}
    return jobs.run_categories(changes, targets)["ProductCategory"]


@query(
    "pipeline_user_groups",
    """SELECT 'SC-' || s_suppkey::VARCHAR AS "CustomerGroupId", s_name AS "CustomerGroupName",
       CAST(NULL AS VARCHAR) AS "CustomerGroupDescription" FROM supplier WHERE s_acctbal >= 0""",
)
def user_groups(spark, sf):
    nothing = F.lit(None).cast("string")
    changes = bronze.named(
        spark, sf, "supplier", "s_suppkey", "s_name", nothing, bronze.verb_of("s_acctbal"), "userGroupID"
    )
    return jobs.run_user_groups(changes, {"CustomerGroup": target(spark, "CustomerGroup")})["CustomerGroup"]


@query(
    "pipeline_user_group_assignments",
    """SELECT CASE WHEN c_acctbal >= 0 THEN 'SC-' || c_mktsegment END AS "CustomerGroupId",
       'SC-' || c_custkey::VARCHAR AS "CustomerId", 'kept' AS "CustomerGroupNote" FROM customer""",
)
def user_group_assignments(spark, sf):
    known = load(spark, sf, "customer").select(
        F.concat(F.lit("SC-"), F.col("c_mktsegment")).alias("CustomerGroupId"),
        F.concat(F.lit("SC-"), F.col("c_custkey").cast("string")).alias("CustomerId"),
        F.lit("kept").alias("CustomerGroupNote"),
    )
    targets = {"CustomerGroupCustomer": target(spark, "CustomerGroupCustomer", known)}
    rows = jobs.run_user_group_assignments(bronze.memberships(spark, sf), targets)["CustomerGroupCustomer"]
    return rows.select("CustomerGroupId", "CustomerId", "CustomerGroupNote")


ORDERS_SQL = f"""WITH l AS (SELECT 'SC-' || l_orderkey::VARCHAR AS oid, 'SC-' || l_linenumber::VARCHAR || '-' ||
    l_partkey::VARCHAR || '-' || l_suppkey::VARCHAR AS lid, l_orderkey, 'SC-' || l_partkey::VARCHAR AS pid,
    round(l_extendedprice / l_quantity, 2) AS price, l_quantity, l_extendedprice FROM lineitem WHERE l_orderkey IN
    (SELECT o_orderkey FROM orders)),
  o AS (SELECT 'SC-' || o_orderkey::VARCHAR AS oid, o_orderkey, 'SC-' || o_custkey::VARCHAR AS cid, o_orderdate, o_totalprice,
    CASE o_orderstatus WHEN 'O' THEN 3 WHEN 'F' THEN 4 ELSE 1 END AS st FROM orders),
  n AS (SELECT l_orderkey, count(*) AS n FROM l GROUP BY l_orderkey)"""


@query(
    "pipeline_orders",
    f"""{ORDERS_SQL}
    SELECT 'Order' AS target, oid AS "OrderId", NULL::VARCHAR AS line_id, cid AS ref, o_orderdate AS at,
      CAST(o_totalprice AS DOUBLE) AS amount, NULL::DOUBLE AS quantity, CAST(coalesce(n, 0) AS INTEGER) AS number
    FROM o LEFT JOIN n ON l_orderkey = o_orderkey
    UNION ALL SELECT 'OrderLine', oid, lid, pid, NULL, l_extendedprice, l_quantity, NULL FROM l
    UNION ALL SELECT 'OrderLineStatus', l.oid, lid, NULL, {START}, NULL, NULL, st FROM l JOIN o ON o.oid = l.oid
    UNION ALL SELECT 'OrderStatus', oid, NULL, NULL, {START}, NULL, NULL, st FROM o
    UNION ALL SELECT 'Shipment', oid, NULL, NULL, NULL, NULL, NULL, NULL FROM o""",
)
def orders(spark, sf):
    """All five targets of the order job, stacked. Order and status start with every order in an old state."""
    known = load(spark, sf, "orders").select(
        F.concat(F.lit("SC-"), F.col("o_orderkey").cast("string")).alias("OrderId"),
        F.lit("old").alias("CustomerId"),
        F.lit(0).alias("OrderStatusTypeId"),
    )
    names = ["Order", "Shipment", "OrderStatus", "OrderLine", "OrderLineStatus"]
    targets = {n: target(spark, n, known if n in ("Order", "OrderStatus") else None) for n in names}
    run = jobs.Run(staging=run_dir(spark, "orders"))
    done = {n: shown(df) for n, df in jobs.run_orders(bronze.orders(spark, sf), targets, run).items()}
    parts = [
        done["Order"].selectExpr(
            "'Order' AS target", "OrderId", "CustomerId AS ref", "OrderBookedDate AS at", "OrderTotalAmount AS amount",
            "NumberOfOrderLines AS number",
        ),
        done["OrderLine"].selectExpr(
            "'OrderLine' AS target", "OrderId", "OrderLineId AS line_id", "ProductId AS ref",
            "TotalOrderLineAmount AS amount", "Quantity AS quantity",
        ),
        done["OrderLineStatus"].selectExpr(
            "'OrderLineStatus' AS target", "OrderId", "OrderLineId AS line_id", "OrderLineStatusStartTimestamp AS at",
            "OrderLineStatusTypeId AS number",
        ),
        done["OrderStatus"].selectExpr(
            "'OrderStatus' AS target", "OrderId", "OrderStatusStartTimestamp AS at", "OrderStatusTypeId AS number"
        ),
        done["Shipment"].selectExpr("'Shipment' AS target", "ShipmentOrderId AS OrderId"),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result.select("target", "OrderId", "line_id", "ref", "at", "amount", "quantity", "number")


@query(
    "pipeline_products",
    f"""WITH {PRODUCTS_SQL}, lab AS (
      SELECT variant, name || '-' || string_agg(v, '.' ORDER BY o) AS n
      FROM (SELECT variant, name, v, min(o) AS o FROM chr GROUP BY variant, name, v) GROUP BY variant, name),
    p AS (SELECT 'SC-' || p_partkey::VARCHAR AS id, CASE WHEN p_size > 25 THEN 'Yes' ELSE 'No' END AS policy, p_type FROM part),
    item AS (SELECT variant AS pid, var.id, variant || '-sku' AS sku, n FROM lab JOIN var USING (variant)
      UNION ALL SELECT id, id, CASE WHEN has_specs THEN id || '-sku' END, CASE WHEN NOT has_specs THEN name END
      FROM prod WHERE id NOT IN (SELECT id FROM var))
    SELECT 'RetailProduct' AS target, pid AS key, policy || ' ' || 'SC-' || p_type AS value FROM item JOIN p USING (id)
    UNION ALL SELECT 'Item', pid, coalesce(sku, '') || ' ' || coalesce(n, '') FROM item
    UNION ALL SELECT 'RelatedProduct', variant, id FROM var
    UNION ALL SELECT DISTINCT 'ProductCharacteristic', variant, 'SC-' || spec || ' ' || v FROM chr
    UNION ALL SELECT 'ProductCharacteristicType', 'SC-Type', 'kind' UNION ALL SELECT 'ProductCharacteristicType', 'SC-Size', 'size'""",
)
def products(spark, sf):
    """All five targets of the product job. Every product starts with an outdated variant, which is swept."""
    product = F.concat(F.lit("SC-"), F.col("p_partkey").cast("string"))
    old = load(spark, sf, "part").select(
        product.alias("base"), F.concat(product, F.lit("-gone")).alias("id"), F.lit("SC-Old").alias("type")
    )
    targets = {
        "RelatedProduct": target(
            spark, "RelatedProduct", old.select(F.col("base").alias("ProductId"), F.col("id").alias("RelatedProductId"))
        ),
        "RetailProduct": target(spark, "RetailProduct", old.select(F.col("id").alias("ProductId"))),
        "Item": target(spark, "Item", old.select(F.col("id").alias("ProductId"))),
        "ProductCharacteristic": target(spark, "ProductCharacteristic", old.select(F.col("id").alias("ProductId"))),
        "ProductCharacteristicType": target(spark, "ProductCharacteristicType"),
    }
    run = jobs.Run(staging=run_dir(spark, "products"))
    done = jobs.run_products(bronze.products(spark, sf), targets, run)
    values = {
        "RetailProduct": F.concat_ws(" ", "ReturnPolicyStatement", "CategoryId"),
        "Item": F.concat(F.coalesce("ItemSku", F.lit("")), F.lit(" "), F.coalesce("ItemName", F.lit(""))),
        "ProductCharacteristic": F.concat_ws(" ", "ProductCharacteristicTypeId", "ProductCharacteristic"),
    }
    done = {n: df.withColumn("value", values[n]) if n in values else df for n, df in done.items()}
    return _stacked(
        done,
        RetailProduct=("ProductId", "value"),
        Item=("ProductId", "value"),
        RelatedProduct=("RelatedProductId", "ProductId"),
        ProductCharacteristic=("ProductId", "value"),
        ProductCharacteristicType=("ProductCharacteristicTypeId", "ProductCharacteristicTypeName"),
    )


@query(
    "land_bronze",
    """SELECT 'SC-' || c_custkey::VARCHAR AS key, c_name AS name, TIMESTAMP '2024-01-01 00:00:00' AS processed
    FROM customer""",
)
def land(spark, sf):
    """Customers written as JSON lines and landed under the declared user schema."""
    path = run_dir(spark, "users-json")
    events = bronze.users(spark, sf).drop("_commit_version", "_change_type")
    events.write.json(path)
    rows = read_samples(spark, path, "Users")
    return rows.select(
        F.concat(F.lit("SC-"), F.col("RouteParams.userID")).alias("key"),
        F.col("Response.Body.LastName").alias("name"),
        F.col("EventProcessedUtcTime").cast("timestamp_ntz").alias("processed"),
    )


@query(
    "land_products",
    """SELECT p_partkey::VARCHAR AS product, CASE WHEN p_brand <> 'Brand#7' THEN 2 END AS specs FROM part""",
)
def land_products(spark, sf):
    """Product documents as JSON lines. Landing turns empty spec lists into null."""
    path = run_dir(spark, "products-json")
    documents = bronze.products(spark, sf).drop("_commit_version", "_change_type")
    empty = F.array().cast(documents.schema["Specs"].dataType)
    documents.withColumn("Specs", F.coalesce("Specs", empty)).write.json(path)
    rows = read_samples(spark, path, "Products")
    return rows.select(F.col("ProductID").alias("product"), F.size("Specs").alias("specs"))


@query(
    "load_countries",
    """SELECT CAST(n_nationkey AS BIGINT) AS "CountryId", n_name AS "IsoCountryName", 'N' || n_nationkey::VARCHAR
    AS "Iso2LetterCountryName", upper(n_name) AS "Iso3LetterCountryName" FROM nation""",
)
def countries(spark, sf):
    """Nations written as CSV with a header, read back as the country table."""
    path = run_dir(spark, "country-csv")
    load(spark, sf, "nation").select(
        F.col("n_nationkey").alias("CountryId"),
        F.col("n_name").alias("IsoCountryName"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("Iso2LetterCountryName"),
        F.upper("n_name").alias("Iso3LetterCountryName"),
    ).write.option("header", True).csv(path)
    return read_countries(spark, path).select(*silver()["Country"].names)

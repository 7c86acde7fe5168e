"""Entity jobs on hand-made bronze events: insert, update, delete, ties, late and failed events."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from quayside.plans.entities import ENTITIES, PERIOD_END, Rules, Run
from quayside.plans.schemas import bronze, silver
from quayside.session import empty_frame
from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION, log_schema
from quayside.sources.tables import conform

DAY = "2024-01-{:02d}T00:00:00Z"


def call(body=None, route=None, verb="POST", day=1, request=None, query=None, date="2024-01-01T00:00:00Z"):
    event = {
        "RouteParams": route or {},
        "Verb": verb,
        "Date": date,
        "Response": {"Body": body},
        "EventProcessedUtcTime": None if day is None else DAY.format(day),
    }
    if request is not None:
        event["Request"] = {"Body": request}
    if query is not None:
        event["QueryParams"] = query
    return event


COUNTRIES = [(1, "United States", "US", "USA"), (2, "France", "FR", "FRA")]


class Jobs:
    """The entity jobs on tables held in memory: events in, one commit per landing, tables out."""

    def __init__(self, spark, tmp_path, rules=None):
        self.spark, self.tmp_path = spark, tmp_path
        self.rules = rules or Rules()
        self.schemas = silver(self.rules.amount_type)
        self.tables = {n: empty_frame(spark, s) for n, s in self.schemas.items()}
        self.tables["Country"] = spark.createDataFrame(COUNTRIES, self.schemas["Country"])
        self.pending, self.version = {}, 0

    def land(self, entity, events):
        self.version += 1
        stamp = {COMMIT_VERSION: self.version, CHANGE_TYPE: "insert"}
        self.pending.setdefault(entity, []).extend({**stamp, **e} for e in events)

    def run(self, entity):
        path = self.tmp_path / f"{entity}-{self.version}.json"
        path.write_text("\n".join(json.dumps(e) for e in self.pending.pop(entity)))
        changes = self.spark.read.schema(log_schema(bronze(entity))).json(str(path))
        job, names = ENTITIES[entity]
        done = job(changes, {n: self.tables[n] for n in names}, Run(self.rules))
        for name, df in done.items():
            rows = conform(df, self.schemas[name]).collect()
            self.tables[name] = self.spark.createDataFrame(rows, self.schemas[name])

    def table(self, name):
        return self.tables[name]


@pytest.fixture
def lake(spark, tmp_path):
    return lambda rules=None: Jobs(spark, tmp_path, rules)


def land(lake, entity, events):
    lake.land(entity, events)


def feed(lake, entity, *batches):
    for events in batches:
        lake.land(entity, events)
        lake.run(entity)


def table(lake, name, *columns):
    df = lake.table(name)
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])


def address(id_, city, day=1, country="us", verb="POST"):
    return call({"ID": id_, "City": city, "Country": country, "FirstName": "f", "LastName": "l"}, verb=verb, day=day)


def test_address_latest_wins_and_countries(lake):
    lk = lake()
    feed(
        lk,
        "Addresses",
        [address("A", "old", 1), address("A", "new", 2), address("B", "x", 1, "FRA"), address("C", "y", 1, "zz"),
         call({"City": "nokey"})],
    )
    assert table(lk, "Location", "LocationId", "LocationCity", "CountryId") == [
        ("SC-A", "new", 1),
        ("SC-B", "x", 2),
        ("SC-C", "y", None),
    ]


def test_address_late_event_within_a_batch_loses(lake):
    lk = lake()
    land(lk, "Addresses", [address("A", "first", 5)])
    land(lk, "Addresses", [address("A", "late", 4)])
    lk.run("Addresses")
    assert table(lk, "Location", "LocationCity") == [("first",)]


def test_address_tie_on_time_goes_to_the_later_version(lake):
    lk = lake()
    land(lk, "Addresses", [address("A", "v1", 5)])
    land(lk, "Addresses", [address("A", "v2", 5)])
    lk.run("Addresses")
    assert table(lk, "Location", "LocationCity") == [("v2",)]


def test_exact_tie_is_resolved_or_reported(lake):
    lk = lake()
    feed(lk, "Addresses", [address("A", "one", 5)])
    feed(lk, "Addresses", [address("A", "two", 6), address("A", "three", 6)])
    assert len(table(lk, "Location")) == 1
    strict = lake(Rules.compat())
    feed(strict, "Addresses", [address("A", "one", 5)])
    land(strict, "Addresses", [address("A", "two", 6), address("A", "three", 6)])
    with pytest.raises(Exception, match="ambiguous"):
        strict.run("Addresses")


def test_address_delete_by_route_only(lake):
    lk = lake()
    feed(
        lk,
        "Addresses",
        [address("A", "x"), address("B", "y")],
        [call({}, {"addressID": "A"}, verb="DELETE", day=2)],
    )
    assert table(lk, "Location", "LocationId") == [("SC-B",)]


def test_null_verb_changes_nothing(lake):
    lk = lake()
    feed(lk, "Addresses", [address("A", "x"), address("B", "y", verb=None)])
    assert table(lk, "Location", "LocationId") == [("SC-A",)]


def test_missing_event_time(lake):
    event = address("A", "x", None) | {"EventEnqueuedUtcTime": DAY.format(3)}
    lk, strict = lake(), lake(Rules.compat())
    for lk_, expected in ((lk, [("SC-A",)]), (strict, [])):
        feed(lk_, "Addresses", [event])
        assert table(lk_, "Location", "LocationId") == expected


def assignment(user, addr, day=1, verb="POST", errors=None):
    return call(
        {"Errors": errors}, {"addressID": addr}, verb, day, request={"AddressID": addr}, query={"userID": user}
    )


def test_address_assignments(lake):
    lk = lake()
    failed = [{"ErrorCode": "x", "Message": "m", "Data": None}]
    feed(
        lk,
        "AddressAssignments",
        [assignment("U", "A", 1), assignment("U", "B", 2), assignment("V", "C", 1, errors=failed),
         assignment("W", "D", 1, errors=[])],
    )
    assert table(lk, "CustomerLocation", "CustomerId", "LocationId") == [("SC-U", "SC-B")]
    end = lk.table("CustomerLocation").first().PeriodEndTimestamp
    assert end.replace(tzinfo=dt.timezone.utc) == dt.datetime.fromisoformat(PERIOD_END) or end.year == 2999
    feed(lk, "AddressAssignments", [assignment("U", "Z", 3, "DELETE")])
    assert table(lk, "CustomerLocation") == []


def test_address_assignment_delete_may_have_to_match(lake):
    lk = lake(Rules(match_address=True))
    feed(lk, "AddressAssignments", [assignment("U", "A", 1)], [assignment("U", "Z", 3, "DELETE")])
    assert len(table(lk, "CustomerLocation")) == 1
    feed(lk, "AddressAssignments", [assignment("U", "A", 4, "DELETE")])
    assert table(lk, "CustomerLocation") == []


def test_catalogs_categories_groups(lake):
    lk = lake()
    body = {"ID": "K", "Name": "n", "Description": "d"}
    for entity, name in (("Catalogs", "Catalog"), ("Categories", "ProductCategory"), ("UserGroups", "CustomerGroup")):
        feed(lk, entity, [call(body)], [call({**body, "Name": "m"}, day=2)])
        assert [r[:3] for r in table(lk, name)] == [("SC-K", "m", "d")]
    assert lk.table("Catalog").first().CatalogEffectivePeriodStartDate.year == 2024
    feed(lk, "Catalogs", [call({}, {"catalogID": "K"}, "DELETE", 3)])
    assert table(lk, "Catalog") == []


def test_users_names_and_phones(lake):
    def user(id_, phone, first="A", last="B"):
        return call({"ID": id_, "FirstName": first, "LastName": last, "Email": f"{id_}@x", "Phone": phone})

    lk = lake()
    feed(
        lk,
        "Users",
        [user("1", "+1 415 555"), user("2", "0014155550100"), user("3", "555-1"), user("4", None, first=None)],
    )
    assert table(lk, "CustomerTelephoneNumber") == [
        ("SC-1", Decimal(1415555)), ("SC-2", None),
        ("SC-3", None), ("SC-4", None),
    ]
    assert table(lk, "IndividualCustomer")[-1] == ("SC-4", None)
    assert table(lk, "IndividualCustomer")[0] == ("SC-1", "A B")
    feed(lk, "Users", [call({}, {"userID": "1"}, "DELETE", 2)])
    for name in ("IndividualCustomer", "CustomerEmail", "CustomerTelephoneNumber"):
        assert [r[0] for r in table(lk, name)] == ["SC-2", "SC-3", "SC-4"]


def membership(user, group, day=1, verb="POST"):
    return call({"Errors": None}, {"userID": user, "userGroupID": group}, verb, day, request={})


def test_group_membership_soft_and_hard_delete(lake):
    first = [membership("U", "G", 1), membership("U", "H", 2)]
    gone = [membership("U", "G", 3, "DELETE")]
    lk = lake()
    feed(lk, "UserGroupAssignments", first, gone)
    assert table(lk, "CustomerGroupCustomer", "CustomerId", "CustomerGroupId") == [("SC-U", None), ("SC-U", "SC-H")]
    hard = lake(Rules(hard_delete_groups=True))
    feed(hard, "UserGroupAssignments", first, gone)
    assert table(hard, "CustomerGroupCustomer", "CustomerId", "CustomerGroupId") == [("SC-U", "SC-H")]
    per_user = lake(Rules.compat())
    feed(per_user, "UserGroupAssignments", first)
    assert table(per_user, "CustomerGroupCustomer", "CustomerId", "CustomerGroupId") == [("SC-U", "SC-H")]


def order(id_, lines, day=1, total=12.5, status=3):
    items = [
        {"ID": i, "Quantity": 2, "UnitPrice": 2.5, "LineTotal": 5.0, "Product": {"ID": "P"}} for i in lines
    ]
    return {
        "ID": id_, "FromUserID": "U", "DateCreated": "2024-01-05T10:00:00Z", "Total": total, "LineItemCount": len(items),
        "Status": status, "LineItems": items, "EventProcessedUtcTime": DAY.format(day),
    }


def test_orders_keep_lines_that_disappear(lake):
    lk = lake()
    feed(lk, "Orders", [order("1", ["a", "b"]), order("2", [])], [order("1", ["a"], 2, 13.5, 4)])
    assert table(lk, "Order", "OrderId", "OrderTotalAmount", "NumberOfOrderLines") == [
        ("SC-1", Decimal("13.50"), 1), ("SC-2", Decimal("12.50"), 0),
    ]
    assert table(lk, "OrderLine", "OrderId", "OrderLineId", "Quantity") == [
        ("SC-1", "SC-a", Decimal("2.00")), ("SC-1", "SC-b", Decimal("2.00")),
    ]
    assert table(lk, "OrderLineStatus", "OrderLineId", "OrderLineStatusTypeId") == [("SC-a", 4), ("SC-b", 3)]
    assert table(lk, "OrderStatus", "OrderId", "OrderStatusTypeId") == [("SC-1", 4), ("SC-2", 3)]
    assert table(lk, "Shipment", "ShipmentId", "ShipmentOrderId") == [(None, "SC-1"), (None, "SC-2")]


def test_compat_rounds_amounts(lake):
    lk = lake(Rules.compat())
    feed(lk, "Orders", [order("1", ["a"], total=12.5)])
    assert table(lk, "Order", "OrderTotalAmount") == [(Decimal(13),)]
    assert table(lk, "OrderLine", "ProductSalesPriceAmount") == [(Decimal(3),)]


def spec(id_, **options):
    return {"ID": id_, "Name": id_.lower(), "Options": [{"ID": k, "Value": v} for k, v in options.items()]}


def product(id_, specs, day=1, **extra):
    return {
        "ProductID": id_, "Name": "Shirt", "Description": "d", "Specs": specs, "Catalogs": ["c"],
        "Categories": [{"ID": "k"}], "EventProcessedUtcTime": DAY.format(day), **extra,
    }


def test_products_expand_into_variants_and_sweep(lake):
    size, color = spec("Size", S="small", M="medium"), spec("Color", R="red")
    lk = lake()
    feed(lk, "Products", [product("P", [size, color], Returnable=True), product("Q", [])])
    assert table(lk, "RetailProduct", "ProductId", "ItemSku", "ReturnPolicyStatement", "CatalogId", "CategoryId") == [
        ("SC-P-R-M", "SC-P-R-M-sku", "Yes", "SC-c", "SC-k"),
        ("SC-P-R-S", "SC-P-R-S-sku", "Yes", "SC-c", "SC-k"),
        ("SC-Q", None, "No", "SC-c", "SC-k"),
    ]
    assert table(lk, "Item", "ProductId", "ItemName") == [
        ("SC-P-R-M", "Shirt-medium.red"), ("SC-P-R-S", "Shirt-red.small"), ("SC-Q", "Shirt"),
    ]
    assert table(lk, "ProductCharacteristic", "ProductId", "ProductCharacteristicTypeId", "ProductCharacteristic") == [
        ("SC-P-R-M", "SC-Color", "red"), ("SC-P-R-M", "SC-Size", "medium"),
        ("SC-P-R-S", "SC-Color", "red"), ("SC-P-R-S", "SC-Size", "small"),
    ]
    assert table(lk, "ProductCharacteristicType") == [("SC-Color", "color"), ("SC-Size", "size")]
    feed(lk, "Products", [product("P", [spec("Size", S="small")], 2)])
    assert table(lk, "RelatedProduct") == [("SC-P", "SC-P-S", "variant-relationship")]
    for name in ("RetailProduct", "Item"):
        assert [r[0] for r in table(lk, name)] == ["SC-P-S", "SC-Q"]
    assert [r[0] for r in table(lk, "ProductCharacteristic")] == ["SC-P-S"]
    feed(lk, "Products", [product("P", [], 3)])
    assert table(lk, "RelatedProduct") == []
    assert [r[0] for r in table(lk, "RetailProduct")] == ["SC-P", "SC-Q"]


def test_products_compat_matches_options_by_text(lake):
    specs = [spec("Size", **{"1": "one", "10": "ten"})]
    exact, text = lake(), lake(Rules.compat())
    for lk, prefix, expected in ((exact, "SC-", 2), (text, "", 3)):
        feed(lk, "Products", [product("P", specs)])
        got = table(lk, "ProductCharacteristic", "ProductId", "ProductCharacteristicTypeId", "ProductCharacteristic")
        assert len(got) == expected and {r[1] for r in got} == {f"{prefix}Size"}
    # without specs in the batch the old variants stay
    feed(text, "Products", [product("P", [], 2)])
    assert len(table(text, "RelatedProduct")) == 2


def test_product_with_an_empty_option_list_has_no_variant(lake):
    lk = lake()
    feed(lk, "Products", [product("P", [spec("Size", S="small"), spec("Color")])])
    assert table(lk, "RelatedProduct") == []
    assert table(lk, "Item", "ProductId", "ItemSku", "ItemName") == [("SC-P", "SC-P-sku", None)]


def test_feed_images(lake):
    """Deletes and earlier update images of the feed do not describe a state."""
    lk, lenient = lake(), lake(Rules(strict_feed=False))
    events = [
        address("A", "gone", 9) | {CHANGE_TYPE: "delete"},
        address("A", "before", 5) | {CHANGE_TYPE: "update_preimage"},
        address("A", "after", 4) | {CHANGE_TYPE: "update_postimage"},
    ]
    for jobs, city in ((lk, "after"), (lenient, "before")):
        feed(jobs, "Addresses", events)
        assert table(jobs, "Location", "LocationCity") == [(city,)]


def test_lines_of_two_orders_may_share_an_id(lake):
    lk = lake()
    feed(lk, "Orders", [order("1", ["a"]), order("2", ["a"])])
    assert len(table(lk, "OrderLine")) == 2


def test_a_line_id_repeated_in_one_order_is_reported(lake):
    lk = lake()
    feed(lk, "Orders", [order("1", ["a"])])
    with pytest.raises(Exception, match="ambiguous"):
        feed(lk, "Orders", [order("1", ["a", "a"], 2)])


def test_variant_takes_the_option_of_its_own_spec(lake):
    """Two specs may use the same option id for different values."""
    lk = lake()
    specs = [spec("Size", **{"1": "small", "2": "large"}), spec("Color", **{"1": "red", "3": "blue"})]
    feed(lk, "Products", [product("P", specs)])
    got = table(lk, "ProductCharacteristic", "ProductId", "ProductCharacteristicTypeId", "ProductCharacteristic")
    assert [r for r in got if r[0] == "SC-P-1-3"] == [
        ("SC-P-1-3", "SC-Color", "blue"), ("SC-P-1-3", "SC-Size", "small"),
    ]
    assert len(got) == 8

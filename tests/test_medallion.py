"""The incremental job end to end: samples, state, replay, failure, streams."""

import json

import pytest
from test_entities import COUNTRIES, address, assignment, call, membership, order, product, spec

from quayside.plans.medallion import Medallion
from quayside.plans.measures import evaluate
from quayside.sources.state import read_state
from quayside.streaming.jobs import land_entity, map_stream

EVENTS = {
    "AddressAssignments": [assignment("U", "A")],
    "Addresses": [address("A", "x")],
    "Catalogs": [call({"ID": "c", "Name": "n"})],
    "Categories": [call({"ID": "k", "Name": "n"})],
    "Orders": [order("1", ["a", "b"]), order("2", ["c"])],
    "Products": [product("P", [spec("Size", S="s", M="m")]), product("Q", [])],
    "UserGroupAssignments": [membership("U", "G")],
    "UserGroups": [call({"ID": "G", "Name": "n"})],
    "Users": [call({"ID": "U", "FirstName": "A", "LastName": "B", "Email": "e", "Phone": "1"})],
}
FILES = {
    "AddressAssignments": "addressAssignments", "Addresses": "addresses", "Catalogs": "catalogs",
    "Categories": "categories", "Orders": "orders", "Products": "products",
    "UserGroupAssignments": "userGroupAssignments", "UserGroups": "userGroups", "Users": "users",
}
DELETIONS = {
    "addressAssignments_deletions": [assignment("U", "A", 2, "DELETE")],
    "userGroupAssignments_deletions": [membership("U", "G", 2, "DELETE")],
    "users_deletions": [call({}, {"userID": "U"}, "DELETE", 2)],
}
COUNTS = {
    "CustomerLocation": 1, "Location": 1, "Catalog": 1, "ProductCategory": 1, "Order": 2, "OrderLine": 3,
    "OrderLineStatus": 3, "OrderStatus": 2, "Shipment": 2, "RetailProduct": 3, "Item": 3, "RelatedProduct": 2,
    "ProductCharacteristic": 2, "ProductCharacteristicType": 1, "CustomerGroup": 1, "CustomerGroupCustomer": 1,
    "IndividualCustomer": 1, "CustomerEmail": 1, "CustomerTelephoneNumber": 1, "OrderStatusType": 6, "OrderType": 1,
    "ProductRelationshipType": 1, "Country": 2,
}


def write_lines(path, events):
    path.write_text("\n".join(json.dumps(e) for e in events))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    samples = root / "samples"
    samples.mkdir()
    for entity, events in EVENTS.items():
        write_lines(samples / f"{FILES[entity]}.json", events)
    for name, events in DELETIONS.items():
        write_lines(samples / f"{name}.json", events)
    header = "CountryId,IsoCountryName,Iso2LetterCountryName,Iso3LetterCountryName"
    (samples / "countries.csv").write_text("\n".join([header, *[",".join(map(str, r)) for r in COUNTRIES]]))
    lake = Medallion(spark, str(root / "lake")).create([])
    lake.load_countries(str(samples / "countries.csv"))
    lake.land_samples(str(samples))
    lake.samples = samples
    return lake


def counts(lake):
    tables = lake.store.tables()
    union = None
    for name, df in tables.items():
        part = df.selectExpr(f"'{name}' AS name")
        union = part if union is None else union.unionByName(part)
    return {r["name"]: r["count"] for r in union.groupBy("name").count().collect()}


def test_full_run_replay_failure_and_deletions(lake, spark, monkeypatch):
    assert all(lake.run_all().values())
    assert counts(lake) == COUNTS
    assert not lake.run("Orders")
    state = {r.table_name: r.last_processed_commit_version for r in read_state(spark, lake.state_path).collect()}
    assert state == dict.fromkeys(EVENTS, 1)

    # a replayed batch changes nothing
    for entity in ("Orders", "Products"):
        lake.process(entity, lake.log(entity), 1)
    assert counts(lake) == COUNTS

    # a run that fails leaves tables and state as they were
    for name in DELETIONS:
        entity = name.split("_")[0]
        entity = entity[0].upper() + entity[1:]
        from quayside.plans.medallion import read_samples

        lake.land(entity, read_samples(spark, str(lake.samples / f"{name}.json"), entity))
    with monkeypatch.context() as patch:
        patch.setattr(lake.store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.run("Users")
    assert counts(lake) == COUNTS

    for entity in ("Users", "AddressAssignments", "UserGroupAssignments"):
        assert lake.run(entity)
    left = counts(lake)
    assert not {"IndividualCustomer", "CustomerEmail", "CustomerTelephoneNumber", "CustomerLocation"} & set(left)
    assert lake.store.table("CustomerGroupCustomer").first().CustomerGroupId is None

    # the silver tables are a star for the metrics
    total = evaluate(lake.star(), ["_OrderTotalAmount", "_AvgBasketSize"]).first()
    assert (total["_OrderTotalAmount"], total["_AvgBasketSize"]) == (25.0, 1.5)

    assert lake.truncate(["Location", "Nowhere"]) == ["Nowhere"]
    assert "Location" not in counts(lake)


def test_stream_equals_batch(spark, tmp_path):
    lake = Medallion(spark, str(tmp_path / "lake")).create([])
    events = tmp_path / "events"
    events.mkdir()
    write_lines(events / "1.json", [order("1", ["a", "b"]), order("2", ["c"])])
    land_entity(lake, "Orders", str(events), str(tmp_path / "land")).awaitTermination()
    map_stream(lake, "Orders", str(tmp_path / "map")).awaitTermination()
    assert counts(lake)["OrderLine"] == 3
    # more events, the same checkpoints
    write_lines(events / "2.json", [order("1", ["a"], 3), order("3", ["d"])])
    land_entity(lake, "Orders", str(events), str(tmp_path / "land")).awaitTermination()
    map_stream(lake, "Orders", str(tmp_path / "map")).awaitTermination()
    got = counts(lake)
    assert (got["Order"], got["OrderLine"], got["Shipment"]) == (3, 4, 3)
    assert lake.latest("Orders") == 2


def test_landing_keeps_commits_already_there(spark, tmp_path):
    from pyspark.sql import functions as F

    from quayside.sources.changes import append_changes
    from quayside.streaming.jobs import json_stream, land_stream

    log, source = str(tmp_path / "log"), tmp_path / "in"
    source.mkdir()
    append_changes(spark.createDataFrame([("one",)], "name string"), log, 1)
    (source / "a.json").write_text('{"name": "two"}\n')
    land_stream(json_stream(spark, str(source), "name string"), log, str(tmp_path / "c1")).awaitTermination()
    (source / "b.json").write_text('{"name": "three"}\n')
    land_stream(json_stream(spark, str(source), "name string"), log, str(tmp_path / "c1")).awaitTermination()
    rows = spark.read.parquet(log).select("name", F.col("_commit_version").alias("v")).collect()
    assert sorted(r.name for r in rows) == ["one", "three", "two"]
    land_stream(json_stream(spark, str(source), "name string"), log, str(tmp_path / "c2")).awaitTermination()
    assert sorted(r.name for r in spark.read.parquet(log).collect()) == ["one", "three", "three", "two", "two"]

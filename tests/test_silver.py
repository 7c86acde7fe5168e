"""Silver tables in key buckets, their recovery, and the event guard across batches."""

import json
import random
from pathlib import Path

import pytest
from test_entities import call, membership, order
from test_medallion import DELETIONS, EVENTS, FILES, write_lines

from quayside.plans.entities import Rules
from quayside.plans.medallion import Medallion, read_samples
from quayside.sources.changes import append_changes, append_commit, finished_commits, newest_commit, open_window
from quayside.sources.silver import SilverTables
from quayside.streaming.jobs import map_stream


def stored(root, name):
    """File names of each bucket folder."""
    return {b.name: sorted(f.name for f in b.glob("*.parquet")) for b in Path(root, "tables", name).glob("_bucket=*")}


def people(spark, root, n=40, buckets=8):
    df = spark.createDataFrame([(str(i), f"n{i}") for i in range(n)], "id string, name string")
    tables = SilverTables(spark, str(root), {"people": df.schema, "other": df.schema}, {"people": "id", "other": "id"}, buckets)
    return tables.create(), df


def test_untouched_buckets_keep_their_files(spark, tmp_path, rows):
    tables, df = people(spark, tmp_path)
    tables.commit({"people": df})
    before = stored(tmp_path, "people")
    changed = spark.createDataFrame([("3", "new")], df.schema)
    touched = tables.buckets_of("people", changed.select("id"))
    part = tables.part("people", touched)
    assert 0 < part.count() < 40 and "PartitionFilters: [isnotnull(_bucket" in part._jdf.queryExecution().toString()
    tables.commit({"people": part.where("id <> '3'").unionByName(changed)}, touched={"people": touched})
    after = stored(tmp_path, "people")
    assert {b for b in before if before[b] != after[b]} == {f"_bucket={b}" for b in touched} and len(touched) == 1
    assert {r.id: r.name for r in tables.table("people").collect()} == {str(i): "new" if i == 3 else f"n{i}" for i in range(40)}
    # a bucket that loses all its rows is emptied, and the number of buckets stays as recorded
    tables.commit({"people": part.where("false")}, touched={"people": touched})
    left = SilverTables(spark, str(tmp_path), tables.schemas, tables.keys, 99)
    assert left.counts["people"] == 8 and left.part("people", touched).count() == 0 and left.table("people").count() < 40
    with pytest.raises(ValueError):
        SilverTables(spark, str(tmp_path), tables.schemas, {"people": "name", "other": "id"})


def test_replay_after_a_failed_write_heals(spark, tmp_path, monkeypatch):
    """The write dies after it has removed old files of one table and before it has touched the other."""
    tables, df = people(spark, tmp_path)
    tables.commit({"people": df, "other": df}, "batch")
    new = df.selectExpr("id", "'new' AS name")
    each, calls = SilverTables._each, []

    def dies(write, names):
        calls.append(names)
        if len(calls) == 1:
            return each(write, names)
        for file in Path(tmp_path, "tables", "people").rglob("*.parquet"):
            file.unlink()
        raise RuntimeError("lost")

    monkeypatch.setattr(tables, "_each", dies)
    with pytest.raises(RuntimeError):
        tables.commit({"people": new, "other": new}, "batch")
    monkeypatch.undo()
    assert tables.table("people").count() == 0
    assert tables.heal("batch") == 1 and tables.heal("batch") == 0
    for name in ("people", "other"):
        assert {tuple(r) for r in tables.table(name).collect()} == {(str(i), "new") for i in range(40)}

    # what was not staged whole is dropped, the tables stay
    monkeypatch.setattr(tables, "_each", lambda write, names: (each(write, names[:1]), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        tables.commit({"people": df, "other": df}, "batch")
    monkeypatch.undo()
    assert tables.heal("batch") == 0 and tables.table("people").first().name == "new"


def test_a_run_touches_only_its_buckets(spark, tmp_path):
    lake = Medallion(spark, str(tmp_path / "lake"), buckets=8).create([])
    land(lake, "Users", [user(f"u{i}", i, 1) for i in range(30)])
    assert lake.run("Users")
    before = stored(tmp_path / "lake/silver", "IndividualCustomer")
    land(lake, "Users", [user("u7", 99, 2)])
    assert lake.run("Users") and not lake.run("Users")
    after = stored(tmp_path / "lake/silver", "IndividualCustomer")
    assert sum(before[b] != after[b] for b in after) == 1 and len(after) == 8
    assert {r.IndividualCustomerName for r in lake.store.table("IndividualCustomer").where("CustomerId = 'SC-u7'").collect()} == {"A L99"}


def user(key, number, at, verb="PUT"):
    body = {} if verb == "DELETE" else {"ID": key, "FirstName": "A", "LastName": f"L{number}", "Email": f"{number}", "Phone": "1"}
    return call(body, {"userID": key}, verb, at)


def land(lake, entity, events, folder=None):
    path = Path(lake.root).parent / f"{entity}-{random.random()}.json"
    write_lines(path, events)
    lake.land(entity, read_samples(lake.spark, str(path), entity).coalesce(1))


def contents(lake, names):
    return {name: sorted(json.dumps(r.asDict(), default=str) for r in lake.store.table(name).collect()) for name in names}


def test_batches_do_not_decide_which_event_wins(spark, tmp_path):
    """Events out of order, deletes and ties included: one run, a run per commit, and streams of any batch size agree."""
    rnd = random.Random(1)
    events = [user(f"u{rnd.randrange(4)}", n, rnd.randrange(1, 9), rnd.choice(["PUT", "PUT", "DELETE"])) for n in range(24)]
    names, seen = ["IndividualCustomer", "CustomerEmail", "CustomerTelephoneNumber"], []
    for how in ("whole", "each", "stream of 1", "stream of 1000"):
        lake = Medallion(spark, str(tmp_path / how / "lake"), buckets=2).create([])
        for k in range(0, 24, 8):
            land(lake, "Users", events[k : k + 8])
            if how == "each":
                assert lake.run("Users")
        if how == "whole":
            assert lake.run("Users")
        if how.startswith("stream"):
            map_stream(lake, "Users", str(tmp_path / how / "map"), max_files=int(how.split()[-1])).awaitTermination()
        seen.append(contents(lake, names))
    assert seen[0] == seen[1] == seen[2] == seen[3] and seen[0]["IndividualCustomer"]


def test_orders_and_groups_in_any_order(spark, tmp_path):
    rules = Rules(replace_order_lines=True, hard_delete_groups=True)
    orders = [[order("1", ["a", "b"], 5), order("2", ["c"], 1)], [order("1", ["a", "x"], 2), order("2", ["c", "d"], 3)], [order("1", [], 4), order("3", ["e"], 1)]]
    groups = [[membership("U", "G", 5, "DELETE"), membership("V", "G", 1)], [membership("U", "G", 2)], [membership("V", "H", 3), membership("U", "H", 1)]]
    names = ["Order", "OrderStatus", "Shipment", "OrderLine", "OrderLineStatus", "CustomerGroupCustomer"]
    seen = []
    for split in (True, False):
        lake = Medallion(spark, str(tmp_path / str(split) / "lake"), rules, buckets=2).create([])
        for some, members in zip(orders, groups, strict=True):
            land(lake, "Orders", some)
            land(lake, "UserGroupAssignments", members)
            if split:
                lake.run_all(["Orders", "UserGroupAssignments"])
        lake.run_all(["Orders", "UserGroupAssignments"])
        seen.append(contents(lake, names))
    assert seen[0] == seen[1]
    lines = {(json.loads(r)["OrderId"], json.loads(r)["OrderLineId"]) for r in seen[0]["OrderLine"]}
    assert lines == {("SC-1", "SC-a"), ("SC-1", "SC-b"), ("SC-2", "SC-c"), ("SC-2", "SC-d"), ("SC-3", "SC-e")}
    with pytest.raises(ValueError):
        Rules(replace_order_lines=True, line_key_with_order=False)


def test_landing_with_deletions(spark, tmp_path):
    """The sample load with its optional batch of deletions: one more commit for three entities, and their rows gone."""
    for entity in ("Users", "AddressAssignments", "UserGroupAssignments"):
        write_lines(tmp_path / f"{FILES[entity]}.json", EVENTS[entity])
    for name, events in DELETIONS.items():
        write_lines(tmp_path / f"{name}.json", events)
    lake = Medallion(spark, str(tmp_path / "lake"), Rules(hard_delete_groups=True), buckets=2).create([])
    lake.land_samples(str(tmp_path), deletions=True, entities=["Users", "AddressAssignments", "UserGroupAssignments"])
    assert [lake.latest(e) for e in ("Users", "AddressAssignments", "UserGroupAssignments")] == [2, 2, 2]
    lake.run_all(["Users", "AddressAssignments", "UserGroupAssignments"])
    assert not any(contents(lake, ["IndividualCustomer", "CustomerEmail", "CustomerLocation", "CustomerGroupCustomer"]).values())


def test_landings_do_not_overwrite_each_other(spark, tmp_path):
    log, df = str(tmp_path / "log"), spark.createDataFrame([("x",)], "name string")
    assert [append_commit(df, log), append_commit(df, log)] == [1, 2]
    Path(log, "_commit_version=3").mkdir()  # another landing has taken the number and not ended
    assert append_commit(df, log) == 4
    append_changes(df, log, 9)
    assert finished_commits(spark, log) == [1, 2, 4, 9] and newest_commit(spark, log) == 9
    assert open_window(spark, log, df.schema, 2, 8).count() == 2 and open_window(spark, log, df.schema, 10, 12).count() == 0

"""The incremental job: bronze change logs, silver store and the state between them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.conditional import null_if_empty
from quayside.functions.dates import to_ts
from quayside.plans.entities import ENTITIES, GUARD, Entity, Rules, Run, guard_table
from quayside.plans.model import order_status_types, order_types, relationship_types
from quayside.plans.schemas import BRONZE_TABLES, MAPPED_TABLES, SILVER_KEYS, bronze, silver
from quayside.session import empty_frame, use_utc
from quayside.sources import state as states
from quayside.sources.changes import append_changes, append_commit, newest_commit, open_log, open_window
from quayside.sources.readers import read_csv, read_json, remove_folder
from quayside.sources.silver import BUCKETS, SilverTables
from quayside.sources.tables import conform

# Sample files per entity, and the deletions that may follow.
SAMPLE_FILES = {
    "AddressAssignments": "addressAssignments.json",
    "Addresses": "addresses.json",
    "Catalogs": "catalogs.json",
    "Categories": "categories.json",
    "Orders": "orders.json",
    "Products": "products.json",
    "UserGroupAssignments": "userGroupAssignments.json",
    "UserGroups": "userGroups.json",
    "Users": "users.json",
}
DELETION_FILES = {
    "AddressAssignments": "addressAssignments_deletions.json",
    "UserGroupAssignments": "userGroupAssignments_deletions.json",
    "Users": "users_deletions.json",
}


def bronze_rows(df: DataFrame, entity: str) -> DataFrame:
    """Landed rows under the declared schema: event times parsed, empty spec lists null."""
    times = ("EventEnqueuedUtcTime", "EventProcessedUtcTime")
    df = df.withColumns({c: to_ts(c) for c in times if c in df.columns})
    if entity == "Products" and "Specs" in df.columns:
        df = df.withColumn("Specs", null_if_empty("Specs"))
    return conform(df, bronze(entity))


def read_samples(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """JSON lines of one entity, read under its schema so that the data is scanned once."""
    return bronze_rows(read_json(spark, path, bronze(entity)), entity)


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Country list from CSV with a numeric id."""
    rows = read_csv(spark, path).withColumnRenamed("CountryId", "CountryIdString")
    return rows.withColumn("CountryId", F.col("CountryIdString").try_cast("bigint")).drop("CountryIdString")


class Medallion:
    """A lake folder with ``bronze``, ``silver``, ``state`` and ``staging`` below it.

    ``more`` adds entities of one's own to the nine. ``buckets`` is the number of buckets of a silver table, or one for
    each table; at scale a bucket should hold some hundred megabytes.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        rules: Rules | None = None,
        *,
        more: Mapping[str, Entity] | None = None,
        buckets: int | Mapping[str, int] = BUCKETS,
    ):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.rules = rules or Rules()
        self.state_path = f"{self.root}/state"
        self.more = dict(more or {})
        schemas = silver(self.rules.amount_type)
        keys = dict(SILVER_KEYS) if self.rules.line_key_with_order else SILVER_KEYS | dict.fromkeys(("OrderLine", "OrderLineStatus"), "OrderLineId")
        for own in self.more.values():
            schemas |= own.tables
            keys |= own.keys
        guards = [guard_table(entity) for entity in (*ENTITIES, *self.more)]
        schemas |= dict.fromkeys(guards, T.StructType.fromDDL(GUARD))
        keys |= dict.fromkeys(guards, "key")
        self.store = SilverTables(spark, f"{self.root}/silver", schemas, keys, buckets, guards)

    def log_path(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    def bronze_schema(self, entity: str) -> T.StructType:
        return self.more[entity].bronze if entity in self.more else bronze(entity)

    def create(self, entities: Sequence[str] = BRONZE_TABLES) -> Medallion:
        """Declare the tables empty, start the state and seed the fixed dimensions."""
        for entity in entities:
            append_changes(empty_frame(self.spark, self.bronze_schema(entity)), self.log_path(entity), 0)
        states.init_state(self.spark, self.state_path, entities)
        self.store.create()
        seeds = {
            "OrderStatusType": order_status_types(self.spark),
            "OrderType": order_types(self.spark),
            "ProductRelationshipType": relationship_types(self.spark),
        }
        self.store.commit(seeds, "seed")
        return self

    def log(self, entity: str) -> DataFrame:
        return open_log(self.spark, self.log_path(entity), self.bronze_schema(entity))

    def latest(self, entity: str) -> int:
        return newest_commit(self.spark, self.log_path(entity))

    def land(self, entity: str, rows: DataFrame, version: int | None = None) -> int:
        """Append one commit to a bronze log, or write the given one anew."""
        if version is None:
            return append_commit(rows, self.log_path(entity))
        append_changes(rows, self.log_path(entity), version)
        return version

    def land_samples(self, folder: str, deletions: bool = False, entities: Iterable[str] = SAMPLE_FILES) -> None:
        """Load the sample files, and on request the deletions as a further commit."""
        for entity in entities:
            self.land(entity, read_samples(self.spark, f"{folder}/{SAMPLE_FILES[entity]}", entity))
        if deletions:
            for entity, name in DELETION_FILES.items():
                self.land(entity, read_samples(self.spark, f"{folder}/{name}", entity))

    def load_countries(self, path: str) -> None:
        self.store.commit({"Country": read_countries(self.spark, path)}, "csv")

    def process(self, entity: str, changes: DataFrame, batch: int) -> None:
        """Map changes into the silver tables of an entity: only the buckets of the batch's keys are read and written.

        Events older than the newest one that a key has already seen change nothing, whatever batch brings them.
        """
        self.store.heal(entity)
        if entity in self.more:
            job, names = self.more[entity].job, list(self.more[entity].tables)
        else:
            job, names = ENTITIES[entity]
        staging = f"{self.root}/staging/{entity}/{batch:012d}-{uuid.uuid4().hex[:12]}"
        run = Run(self.rules, staging=staging, tables=self.store, entity=entity)
        results = job(changes, self.store.tables(*names), run)
        self.store.commit({**results, **run.guards}, entity, run.touched)
        remove_folder(self.spark, staging)

    def run(self, entity: str) -> bool:
        """Process what arrived since the last run. Returns whether there was anything."""
        first = states.next_version(states.read_state(self.spark, self.state_path), entity)
        last = self.latest(entity)
        if not states.has_new_data(first, last):
            return False
        # the upper bound keeps a commit that arrives meanwhile for the next run
        changes = open_window(self.spark, self.log_path(entity), self.bronze_schema(entity), first, last)
        self.process(entity, changes, last)
        states.advance(self.spark, self.state_path, entity, last)
        return True

    def run_all(self, entities: Sequence[str] | None = None) -> dict[str, bool]:
        return {entity: self.run(entity) for entity in (entities or (*ENTITIES, *self.more))}

    def truncate(self, names: Sequence[str] = MAPPED_TABLES) -> list[str]:
        """Empty silver tables; returns the names that are not declared."""
        known = [n for n in self.store.schemas if n in names]
        written = {entity: tables for entity, (_, tables) in ENTITIES.items()} | {e: list(own.tables) for e, own in self.more.items()}
        # what an emptied table had seen must be able to come again
        guards = [guard_table(entity) for entity, tables in written.items() if set(tables) & set(known)]
        empty = {n: empty_frame(self.spark, self.store.schemas[n]) for n in (*known, *guards)}
        self.store.commit(empty, "empty")
        return [n for n in names if n not in known]

    def star(self) -> Mapping[str, DataFrame]:
        """The silver tables for the metric layer."""
        return self.store.tables()

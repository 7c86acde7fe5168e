"""Nine mapping jobs from bronze changes to silver tables.

Each takes the changes of one entity and the current targets and returns the
new targets: flatten, latest row per key, merge. A job whose snapshot feeds
several targets stages it first when the run names a staging folder.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.conditional import typed_null, yes_no
from quayside.functions.dates import to_ts
from quayside.functions.text import external_key, full_name, item_name, item_sku, normalize_phone, prefix_key
from quayside.operators.lookup import lookup_any
from quayside.operators.merge import MergeSpec, apply_changes, expired_children, merge_into, merge_shared
from quayside.operators.nested import explode_children, first_of
from quayside.operators.snapshot import (
    ENQUEUED_TIME,
    EVENT_TIME,
    VERB,
    accept_ok_events,
    flatten_event,
    latest_snapshot,
    live_changes,
    split_by_verb,
)
from quayside.operators.variants import (
    contains_match,
    deal_products,
    expand_variants,
    label_values,
    option_lists,
    option_members,
)
from quayside.plans.model import VARIANT_RELATIONSHIP
from quayside.session import stage
from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION
from quayside.sources.readers import stored_bytes
from quayside.sources.silver import SilverTables

# The open-ended validity period.
PERIOD_START = "2000-11-16T13:06:46.713+00:00"
PERIOD_END = "2999-11-16T13:06:46.713+00:00"
ONLINE_SALE = 1

# A staged source of at most this size in storage may be broadcast.
BROADCAST_BYTES = 32 * 1024 * 1024


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def with_period(df: DataFrame, start: str, end: str, since: Column | None = None) -> DataFrame:
    """Add a validity period: from the sentinel start, or ``since`` where known, to the sentinel end."""
    begin = instant(PERIOD_START) if since is None else since
    return df.withColumn(start, begin).withColumn(end, instant(PERIOD_END))


@dataclass(frozen=True)
class Rules:
    """Where the mapping has a choice. ``Rules.compat()`` keeps every behaviour of the original jobs."""

    amount_type: str = "decimal(18,2)"
    ties: str = "one"
    strict_feed: bool = True
    fallback_event_time: bool = True
    options_by_text: bool = False
    prefix_characteristic_type: bool = True
    group_key_per_user: bool = False
    hard_delete_groups: bool = False
    match_address: bool = False
    line_key_with_order: bool = True
    sweep_without_specs: bool = True
    replace_order_lines: bool = False

    def __post_init__(self):
        if self.replace_order_lines and not self.line_key_with_order:
            raise ValueError("lines are replaced by order, so their key must hold the order")

    @classmethod
    def compat(cls) -> Rules:
        return cls(
            amount_type="decimal(10,0)",
            ties="keep",
            strict_feed=False,
            fallback_event_time=False,
            options_by_text=True,
            prefix_characteristic_type=False,
            group_key_per_user=True,
            line_key_with_order=False,
            sweep_without_specs=False,
        )


#: What an entity remembers of each key: time, commit and tie-break of the newest event it has seen, deletes included.
GUARD = "key string, event_time timestamp, commit_version bigint, tie bigint"
_POSITION = ("event_time", "commit_version", "tie")


def guard_table(entity: str) -> str:
    return f"{entity}Guard"


@dataclass(frozen=True)
class Run:
    """One execution: its rules, where it may stage frames that are read more than once, and the stored tables it changes.

    With ``tables`` a job reads only the buckets its keys fall into; ``touched`` collects them. Each entity's guard table
    holds the newest event seen per key: an event before it changes nothing, so neither the order in which commits arrive
    nor the way they are cut into batches decides which event wins. A key that was deleted stays guarded.
    """

    rules: Rules = field(default_factory=Rules)
    staging: str | None = None
    tables: SilverTables | None = None
    entity: str = ""
    touched: dict[str, frozenset[int]] = field(default_factory=dict)
    guards: dict[str, DataFrame] = field(default_factory=dict)
    _known: dict = field(default_factory=dict)

    def part(self, targets: Mapping[str, DataFrame], name: str, *keys: DataFrame) -> DataFrame:
        """The rows of a target that may match ``keys`` (frames of one key column each); the whole target if it is no
        stored table."""
        if self.tables is None:
            return targets[name]
        memo = (self.tables.counts[name], *map(id, keys))
        if memo not in self._known:  # the frames are kept too, so that an id stands for one frame
            self._known[memo] = (self.tables.buckets_of(name, *keys), keys)
        self.touched[name] = self._known[memo][0]
        return self.tables.part(name, self.touched[name])

    def place(self, name: str) -> str | None:
        """Where a frame of this run may be staged."""
        return None if self.staging is None else f"{self.staging}/{name}"

    def keep(self, df: DataFrame, name: str) -> tuple[DataFrame, int | None]:
        """The frame and, once staged, its number of rows (read from the file footers).

        Wide rows count as unknown: merges broadcast only what is short and small.
        """
        if self.staging is None:
            return df, None
        path = f"{self.staging}/{name}"
        staged = stage(df, path)
        small = stored_bytes(df.sparkSession, path) <= BROADCAST_BYTES
        return staged, staged.count() if small else None

    def snapshot(self, events: DataFrame, keys: str | list[str], name: str, tie: str | None = None) -> tuple[DataFrame, int | None]:
        """The latest event of each key, without those older than the newest event the key has seen before.

        Events at the same time and commit are told apart by the column ``tie`` (a number, highest first) or else by a
        hash of the row.
        """
        rows = live_changes(events, self.rules.strict_feed)
        if self.rules.fallback_event_time and ENQUEUED_TIME in rows.columns:
            rows = rows.withColumn(EVENT_TIME, F.coalesce(EVENT_TIME, ENQUEUED_TIME))
        drop = (EVENT_TIME, ENQUEUED_TIME, COMMIT_VERSION, CHANGE_TYPE)
        if self.tables is None:
            return self.keep(latest_snapshot(rows, keys, ties=self.rules.ties, tiebreak=[tie] if tie else []).drop(*drop), name)
        one = self.rules.ties == "one"
        rows = rows.withColumn("_tie", (F.col(tie) if tie else F.xxhash64(*rows.columns)).cast("bigint") if one else F.lit(0).cast("bigint"))
        snap = latest_snapshot(rows, keys, ties=self.rules.ties, tiebreak=["_tie"])
        key = F.to_json(F.struct(*([keys] if isinstance(keys, str) else keys)))
        snap = snap.withColumns({"_key": key, "_at": F.col(EVENT_TIME).cast("timestamp"), "_commit": F.col(COMMIT_VERSION)})
        snap, count = self.keep(snap.drop(*drop), f"{name}-seen" if self.staging else name)
        snap, stale = self._newer(snap, name)
        snap = snap.drop("_key", "_at", "_commit", "_tie")
        return snap, None if count is None else count - stale

    def _newer(self, snap: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Rows of ``snap`` that are not older than their key's guard, and the number of the others; notes the new guard."""
        guard = guard_table(self.entity)
        known = self.part({}, guard, snap.select("_key"))
        seen = snap.select(F.col("_key").alias("key"), F.col("_at").alias("event_time"), F.col("_commit").alias("commit_version"), F.col("_tie").alias("tie"))
        newest = known.unionByName(seen).groupBy("key").agg(F.max(F.struct(*_POSITION)).alias("top")).select("key", "top.*")
        self.guards[guard] = newest
        before = known.select(F.col("key").alias("_key"), F.struct(*_POSITION).alias("_before"))
        own = F.struct(F.col("_at").alias("event_time"), F.col("_commit").alias("commit_version"), F.col("_tie").alias("tie"))
        stale = snap.select("_key", own.alias("_own")).join(before, "_key").where(F.col("_before") > F.col("_own")).select("_key")
        stale, count = self.keep(stale, f"{name}-stale")
        count = stale.count() if count is None else count
        return (snap.join(stale.distinct(), "_key", "left_anti"), count) if count else (snap, 0)

    def by(self, name: str, key: Mapping[str, str]) -> Column:
        """The source column that deals a target's rows to buckets."""
        stored = next(iter(key)) if self.tables is None else self.tables.keys[name]
        return F.col(key[stored])

    @property
    def ambiguity(self) -> str:
        """Snapshots with one row per key need no check."""
        return "assume_unique" if self.rules.ties == "one" else "error"


Targets = Mapping[str, DataFrame]
FEED = {c: c for c in (EVENT_TIME, ENQUEUED_TIME, COMMIT_VERSION, CHANGE_TYPE)}
CALLED = {VERB: VERB, **FEED}


def _apply(
    targets: Targets, name: str, snap: DataFrame, key: Mapping[str, str], values: Mapping[str, str], run: Run,
    rows: int | None, rule: str | None = None,
) -> DataFrame:
    return apply_changes(
        run.part(targets, name, snap.select(run.by(name, key))),
        snap.select(*key.values(), *values.values(), VERB),
        key,
        update=values,
        insert={**key, **values},
        on_ambiguous=rule or run.ambiguity,
        source_rows=rows,
    )


def run_address_assignments(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Where a customer lives: one location per customer, the latest assignment."""
    events = flatten_event(
        accept_ok_events(changes),
        {
            "LocationId": external_key("Request.Body.AddressID", "RouteParams.addressID"),
            "CustomerId": external_key("Request.Body.UserID", "QueryParams.userID"),
            "start": to_ts("Date"),
            **CALLED,
        },
    )
    events = with_period(events, "PeriodStartTimestamp", "PeriodEndTimestamp", since=F.col("start")).drop("start")
    snap, rows = run.snapshot(events, "CustomerId", "address_assignments")
    values = {c: c for c in ("LocationId", "PeriodStartTimestamp", "PeriodEndTimestamp")}
    key = {"CustomerId": "CustomerId"}
    if not run.rules.match_address:
        return {"CustomerLocation": _apply(targets, "CustomerLocation", snap, key, values, run, rows)}
    upserts, deletes = split_by_verb(snap)
    merged = merge_into(
        run.part(targets, "CustomerLocation", snap.select("CustomerId")), upserts, key, update=values, insert={**key, **values},
        on_ambiguous=run.ambiguity, source_rows=rows,
    )
    both = {**key, "LocationId": "LocationId"}
    return {"CustomerLocation": merge_into(merged, deletes, both, delete=True, source_rows=rows)}


def run_addresses(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Locations, with their country looked up by two- or three-letter code."""
    body = {
        "LocationAddressLine1": "Street1",
        "LocationAddressLine2": "Street2",
        "LocationCity": "City",
        "LocationZipCode": "Zip",
        "LocationName": "FirstName",
        "LocationDescription": "LastName",
        "Country": "Country",
    }
    events = flatten_event(
        changes,
        {
            "LocationId": external_key("Response.Body.ID", "RouteParams.addressID"),
            **{out: f"Response.Body.{name}" for out, name in body.items()},
            **CALLED,
        },
    )
    snap, rows = run.snapshot(events, "LocationId", "addresses")
    codes = ["Iso2LetterCountryName", "Iso3LetterCountryName"]
    located = lookup_any(snap, targets["Country"], "Country", codes, ["CountryId"])
    values = {c: c for c in (*body, "CountryId") if c != "Country"}
    # a country code listed twice gives two rows for one location, so this merge checks
    return {"Location": _apply(targets, "Location", located, {"LocationId": "LocationId"}, values, run, rows, "error")}


def run_catalogs(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    events = flatten_event(
        changes,
        {
            "CatalogId": external_key("Response.Body.ID", "RouteParams.catalogID"),
            "CatalogName": "Response.Body.Name",
            "CatalogDescription": "Response.Body.Description",
            "start": to_ts("Date"),
            **CALLED,
        },
    )
    period = ("CatalogEffectivePeriodStartDate", "CatalogEffectivePeriodEndDate")
    events = with_period(events, *period, since=F.col("start")).drop("start")
    snap, rows = run.snapshot(events, "CatalogId", "catalogs")
    values = {c: c for c in ("CatalogName", "CatalogDescription", *period)}
    return {"Catalog": _apply(targets, "Catalog", snap, {"CatalogId": "CatalogId"}, values, run, rows)}


def _named(
    changes: DataFrame, targets: Targets, run: Run, table: str, route: str, prefix: str
) -> dict[str, DataFrame]:
    """Entities that consist of an id, a name and a description."""
    key, name, text = f"{prefix}Id", f"{prefix}Name", f"{prefix}Description"
    events = flatten_event(
        changes,
        {
            key: external_key("Response.Body.ID", f"RouteParams.{route}"),
            name: "Response.Body.Name",
            text: "Response.Body.Description",
            **CALLED,
        },
    )
    snap, rows = run.snapshot(events, key, table)
    return {table: _apply(targets, table, snap, {key: key}, {name: name, text: text}, run, rows)}


def run_categories(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    return _named(changes, targets, run, "ProductCategory", "categoryID", "ProductCategory")


def run_user_groups(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    return _named(changes, targets, run, "CustomerGroup", "userGroupID", "CustomerGroup")


def run_user_group_assignments(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Group membership. A removed membership keeps its row without the group, or is deleted on request."""
    key = {"CustomerId": "CustomerId", "CustomerGroupId": "CustomerGroupId"}
    events = flatten_event(
        accept_ok_events(changes),
        {
            "CustomerGroupId": external_key("Request.Body.UserGroupID", "RouteParams.userGroupID"),
            "CustomerId": external_key("Request.Body.UserID", "RouteParams.userID"),
            **CALLED,
        },
    )
    per = "CustomerId" if run.rules.group_key_per_user else ["CustomerId", "CustomerGroupId"]
    snap, rows = run.snapshot(events, per, "user_group_assignments")
    upserts, deletes = split_by_verb(snap)
    merged = merge_into(
        run.part(targets, "CustomerGroupCustomer", snap.select("CustomerId")),
        upserts,
        key,
        update={"CustomerGroupId": "CustomerGroupId"},
        insert=key,
        on_ambiguous=run.ambiguity,
        source_rows=rows,
    )
    if run.rules.hard_delete_groups:
        return {"CustomerGroupCustomer": merge_into(merged, deletes, key, delete=True, source_rows=rows)}
    gone = merge_into(
        merged, deletes, key, update={"CustomerGroupId": typed_null()}, on_ambiguous=run.ambiguity, source_rows=rows
    )
    return {"CustomerGroupCustomer": gone}


def run_users(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Customers with their e-mail and phone, in three tables."""
    body = "Response.Body"
    events = flatten_event(
        changes,
        {
            "CustomerId": external_key(f"{body}.ID", "RouteParams.userID"),
            "IndividualCustomerName": full_name(f"{body}.FirstName", f"{body}.LastName"),
            "EmailAddress": f"{body}.Email",
            "TelephoneNumber": normalize_phone(f"{body}.Phone"),
            **CALLED,
        },
    )
    snap, rows = run.snapshot(events, "CustomerId", "users")
    columns = {
        "IndividualCustomer": "IndividualCustomerName",
        "CustomerEmail": "EmailAddress",
        "CustomerTelephoneNumber": "TelephoneNumber",
    }
    key, ids = {"CustomerId": "CustomerId"}, snap.select("CustomerId")
    return merge_shared(
        {table: run.part(targets, table, ids) for table in columns},
        snap,
        {table: MergeSpec.upsert(key, {c: c}) for table, c in columns.items()},
        verb=VERB,
        on_ambiguous=run.ambiguity,
        path=run.place("merged_users"),
    )


def run_orders(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Orders, their status, their lines and a shipment stub. Nothing is ever removed by an event."""
    rules = run.rules
    events = flatten_event(
        changes,
        {
            "OrderId": prefix_key("ID"),
            "CustomerId": prefix_key("FromUserID"),
            "OrderBookedDate": to_ts("DateCreated"),
            "OrderTotalAmount": F.col("Total").cast(rules.amount_type),
            "NumberOfOrderLines": F.col("LineItemCount").cast("int"),
            "StatusTypeId": F.col("Status").cast("int"),
            "LineItems": "LineItems",
            **FEED,
        },
    )
    snap, rows = run.snapshot(events, "OrderId", "orders")
    orders = with_period(snap.drop("LineItems"), "start", "end").withColumn("OrderTypeId", F.lit(ONLINE_SALE))
    lines = flatten_event(
        explode_children(snap.select("OrderId", "StatusTypeId", "LineItems"), "LineItems", "line"),
        {
            "OrderId": "OrderId",
            "OrderLineId": prefix_key("line.ID"),
            "ProductId": prefix_key("line.Product.ID"),
            "ProductSalesPriceAmount": F.col("line.UnitPrice").cast(rules.amount_type),
            "Quantity": F.col("line.Quantity").cast(rules.amount_type),
            "TotalOrderLineAmount": F.col("line.LineTotal").cast(rules.amount_type),
            "StatusTypeId": "StatusTypeId",
        },
    )
    lines = with_period(lines, "start", "end")
    ids, line_ids = snap.select("OrderId"), lines.select("OrderId" if rules.line_key_with_order else "OrderLineId")

    def stored(table: str) -> DataFrame:
        """What is stored for the batch's orders and lines."""
        return run.part(targets, table, ids if "Line" not in table or rules.replace_order_lines else line_ids)

    def remaining(table: str, part: DataFrame) -> DataFrame:
        """The stored rows without the lines that the batch's orders replace."""
        if "Line" not in table or not rules.replace_order_lines:
            return part
        return merge_into(part, ids, "OrderId", delete=True, source_rows=rows)

    def upsert(key: list[str], values: Mapping[str, str]) -> MergeSpec:
        on = {k: k for k in key}
        return MergeSpec(on, update={t: s for t, s in values.items() if t not in on}, insert={**on, **values})

    def status(prefix: str) -> dict[str, str]:
        return {
            f"{prefix}StartTimestamp": "start", f"{prefix}EndTimestamp": "end", f"{prefix}TypeId": "StatusTypeId"
        }

    order_values = {
        c: c for c in ("CustomerId", "OrderTypeId", "OrderBookedDate", "OrderTotalAmount", "NumberOfOrderLines")
    }
    line_key = ["OrderId", "OrderLineId"] if rules.line_key_with_order else ["OrderLineId"]
    line_values = {
        c: c for c in ("OrderId", "ProductId", "ProductSalesPriceAmount", "Quantity", "TotalOrderLineAmount")
    }
    of_orders = {
        "Order": upsert(["OrderId"], order_values),
        # the update half would set the key to itself, so only new orders matter
        "Shipment": MergeSpec({"ShipmentOrderId": "OrderId"}, insert={"ShipmentOrderId": "OrderId"}),
        "OrderStatus": upsert(["OrderId"], status("OrderStatus")),
    }
    of_lines = {
        "OrderLine": upsert(line_key, line_values),
        "OrderLineStatus": upsert(line_key, {"OrderId": "OrderId", **status("OrderLineStatus")}),
    }

    def merged(source: DataFrame, specs: Mapping[str, MergeSpec], rule: str, name: str) -> dict[str, DataFrame]:
        parts = {t: stored(t) for t in specs}
        empty = [t for t, part in parts.items() if part.isEmpty()]  # a first load moves no rows to find matches
        left = {t: remaining(t, part) for t, part in parts.items()}
        return merge_shared(left, source, specs, on_ambiguous=rule, path=run.place(name), empty=empty)

    # line ids come from the document, so repeated ones are possible and checked
    return merged(orders, of_orders, run.ambiguity, "merged_orders") | merged(lines, of_lines, "error", "merged_lines")


def product_snapshot(changes: DataFrame, run: Run) -> DataFrame:
    events = flatten_event(
        changes,
        {
            "ExternalProductID": prefix_key("ProductID"),
            "Name": "Name",
            "Description": "Description",
            "ReturnPolicyStatement": yes_no("Returnable"),
            "ReturnPolicyPeriodInDays": typed_null(),
            "CatalogId": prefix_key(first_of("Catalogs")),
            "CategoryId": prefix_key(first_of("Categories", "ID")),
            "Specs": "Specs",
            **FEED,
        },
    )
    return run.snapshot(events, "ExternalProductID", "products")[0]


def product_variants(snap: DataFrame, rules: Rules) -> DataFrame:
    """One row per variant, or the product itself without variants, with its characteristics and names.

    A map over the dealt snapshot: the specs travel with their product, and stay behind once they are read into lists.
    """
    listed = deal_products(snap, "ExternalProductID").withColumn("_lists", option_lists("Specs"))
    if rules.options_by_text:
        expanded = expand_variants(listed, "ExternalProductID", "_lists")
        match = F.when(F.col("ProductID").isNotNull(), contains_match("Specs", "ProductID"))
        expanded = expanded.withColumn("characteristics", match)
    else:
        listed = listed.withColumn("_members", option_members("Specs", "_lists"))
        # of the specs only their number is asked for from here on
        listed = listed.withColumn("Specs", F.transform("Specs", lambda _: F.lit(0)))
        expanded = expand_variants(listed, "ExternalProductID", "_lists", members="_members")
    own_id = F.coalesce("ProductID", "ExternalProductID")
    return (
        expanded.withColumn("ItemName", item_name("Name", label_values("characteristics"), "Specs"))
        .withColumn("ItemSku", item_sku(own_id, "Specs"))
        .withColumn("ProductId_", own_id)
        .select(
            "ExternalProductID",
            F.col("ProductID").alias("VariantID"),
            F.col("ProductId_").alias("ProductId"),
            "Name",
            "Description",
            "ReturnPolicyStatement",
            "ReturnPolicyPeriodInDays",
            "CatalogId",
            "CategoryId",
            "ItemSku",
            "ItemName",
            (F.size("Specs") > 0).alias("has_specs"),
            "characteristics",
        )
    )


def run_products(changes: DataFrame, targets: Targets, run: Run = Run()) -> dict[str, DataFrame]:
    """Products and their variants; variants that a product no longer has are swept from four tables."""
    rules = run.rules
    snap = product_snapshot(changes, run)
    variants, _ = run.keep(product_variants(snap, rules), "variants")

    type_id = prefix_key("c.spec_id") if rules.prefix_characteristic_type else F.col("c.spec_id")
    characteristics = variants.select("ProductId", F.explode("characteristics").alias("c")).select(
        "ProductId", type_id.alias("TypeId"), F.col("c.value").alias("Value")
    ).distinct()
    characteristics = with_period(characteristics, "start", "end")
    types = (
        snap.select(F.explode("Specs").alias("spec"))
        .select(prefix_key("spec.ID").alias("TypeId"), F.col("spec.Name").alias("TypeName"))
        .na.drop(subset=["TypeId"])
        .distinct()
    )
    related = variants.where(F.col("has_specs")).select(
        F.col("ExternalProductID").alias("ProductId"),
        F.col("VariantID").alias("RelatedProductId"),
        F.lit(VARIANT_RELATIONSHIP).alias("ProductRelationshipTypeId"),
    ).na.drop(subset=["RelatedProductId"])
    parents = snap if rules.sweep_without_specs else snap.where(F.size("Specs") > 0)
    expired, expired_rows = run.keep(
        expired_children(
            targets["RelatedProduct"],
            related,
            parents.select(F.col("ExternalProductID").alias("ProductId")),
            "ProductId",
            "RelatedProductId",
        ).na.drop(),
        "expired_variants",
    )

    related_ids, variant_ids, gone = related.select("RelatedProductId"), variants.select("ProductId"), expired.select("RelatedProductId")

    def stored(table: str, *keys: DataFrame) -> DataFrame:
        return run.part(targets, table, *keys)

    product = {"ProductId": "ProductId"}
    product_values = {
        "ProductName": "Name",
        "ProductDescription": "Description",
        "ReturnPolicyStatement": "ReturnPolicyStatement",
        "ReturnPolicyPeriodInDays": "ReturnPolicyPeriodInDays",
        "ItemSku": "ItemSku",
        "CatalogId": "CatalogId",
        "CategoryId": "CategoryId",
    }
    item_values = {"ItemSku": "ItemSku", "ItemName": "ItemName", "ItemDescription": "Description"}
    characteristic_key = {
        "ProductId": "ProductId", "ProductCharacteristicTypeId": "TypeId", "ProductCharacteristic": "Value"
    }
    period = {"ProductCharacteristicPeriodStartDate": "start", "ProductCharacteristicPeriodEndDate": "end"}
    related_values = {"ProductId": "ProductId", "ProductRelationshipTypeId": "ProductRelationshipTypeId"}
    # two products may spell the same variant id, so these merges check
    of_variants = merge_shared(
        {table: stored(table, variant_ids, gone) for table in ("RetailProduct", "Item")},
        variants,
        {"RetailProduct": MergeSpec.upsert(product, product_values), "Item": MergeSpec.upsert(product, item_values)},
        expired=gone,
        path=run.place("merged_variants"),
    )
    of_relations = merge_shared(
        {"RelatedProduct": stored("RelatedProduct", related_ids, gone)},
        related,
        {"RelatedProduct": MergeSpec.upsert({"RelatedProductId": "RelatedProductId"}, related_values)},
        expired=gone,
    )
    # characteristics are swept by product alone: those stored first, then those of variants that two products spell alike
    kept, fresh = (
        merge_into(df, gone, {"ProductId": "RelatedProductId"}, delete=True, source_rows=expired_rows)
        for df in (stored("ProductCharacteristic", variant_ids, gone), characteristics)
    )
    of_characteristics = merge_shared(
        {"ProductCharacteristic": kept},
        fresh,
        {"ProductCharacteristic": MergeSpec.upsert(characteristic_key, period)},
        on_ambiguous="assume_unique",
    )
    of_types = merge_shared(
        {"ProductCharacteristicType": stored("ProductCharacteristicType", types.select("TypeId"))},
        types,
        {"ProductCharacteristicType": MergeSpec.upsert({"ProductCharacteristicTypeId": "TypeId"}, {"ProductCharacteristicTypeName": "TypeName"})},
    )
    return of_variants | of_relations | of_characteristics | of_types


Job = Callable[[DataFrame, Targets, Run], dict[str, DataFrame]]


@dataclass(frozen=True)
class Entity:
    """An entity of one's own: its bronze columns, its job, the silver tables it alone writes, and the key of each that
    deals its rows to buckets (part of every key its job matches on)."""

    bronze: T.StructType
    job: Job
    tables: Mapping[str, T.StructType]
    keys: Mapping[str, str]


# entity -> (job, tables it reads or writes), in the order of a full run
ENTITIES: dict[str, tuple[Job, list[str]]] = {
    "AddressAssignments": (run_address_assignments, ["CustomerLocation"]),
    "Addresses": (run_addresses, ["Location", "Country"]),
    "Catalogs": (run_catalogs, ["Catalog"]),
    "Categories": (run_categories, ["ProductCategory"]),
    "Orders": (run_orders, ["Order", "Shipment", "OrderStatus", "OrderLine", "OrderLineStatus"]),
    "Products": (
        run_products,
        ["RelatedProduct", "RetailProduct", "Item", "ProductCharacteristic", "ProductCharacteristicType"],
    ),
    "UserGroupAssignments": (run_user_group_assignments, ["CustomerGroupCustomer"]),
    "UserGroups": (run_user_groups, ["CustomerGroup"]),
    "Users": (run_users, ["IndividualCustomer", "CustomerEmail", "CustomerTelephoneNumber"]),
}

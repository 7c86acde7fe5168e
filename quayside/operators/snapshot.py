"""From a change feed to the latest row per key, and its split by verb."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.sources.changes import CHANGE_TYPE, COMMIT_VERSION, DELETE, INSERT, UPDATE_AFTER

# Fixed values of the event envelope.
EVENT_TIME = "EventProcessedUtcTime"
ENQUEUED_TIME = "EventEnqueuedUtcTime"
VERB = "Verb"
DELETE_VERB = "DELETE"
ERRORS = "Response.Body.Errors"


def max_over(df: DataFrame, value: str, keys: Sequence[str], out: str) -> DataFrame:
    """Largest value of the row's group on every row.

    Written as an aggregate joined back, not as a window: the aggregate combines
    before its shuffle, and the join may split a group that is far larger than
    the others. Null keys form a group of their own: the join is by one struct
    of all keys, which is never null, so the aggregate is not shuffled again.
    """
    top = df.groupBy(F.struct(*keys).alias("_group")).agg(F.max(value).alias(out))
    return df.withColumn("_group", F.struct(*keys)).join(top, "_group", "left").drop("_group")


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def accept_ok_events(df: DataFrame, errors: str = ERRORS) -> DataFrame:
    """Keep calls that reported no errors. An empty error list is still a report."""
    return df.where(F.col(errors).isNull())


def live_changes(df: DataFrame, strict: bool = True) -> DataFrame:
    """Rows that describe a state: inserts and later update images.

    ``strict=False`` only leaves out deletes, so earlier update images stay in.
    """
    if strict:
        return df.where(F.col(CHANGE_TYPE).isin(INSERT, UPDATE_AFTER))
    return df.where(F.col(CHANGE_TYPE) != DELETE)


def latest_snapshot(
    df: DataFrame,
    keys: str | Sequence[str],
    order: Sequence[str] = (EVENT_TIME, COMMIT_VERSION),
    ties: str = "keep",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Rows with the highest event time, and among those the highest version, per key.

    Rows without a key or without an event time are left out.

    ``ties="keep"`` returns every row that shares the top position. The top is
    aggregated (combined before the shuffle) and the rows are matched to it by a
    semi join on key and position, whose left side adaptive execution may split
    when one key holds a large share of all rows.

    ``ties="one"`` returns one row per key: the window limit is applied within
    each input partition first, so a hot key sends at most one row per task.
    Remaining ties are broken by ``tiebreak`` columns (highest first) and then
    by the row's hash, so a recomputed task picks the same row again.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    first, *rest = order
    rows = drop_null_keys(df, keys).where(F.col(first).isNotNull())
    if ties == "keep":
        top = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_top"))
        right = top.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            *[F.col(f"_top.{c}").alias(f"_o{i}") for i, c in enumerate(order)],
        )
        on = [rows[k] == right[f"_k{i}"] for i, k in enumerate(keys)]
        on += [rows[c] == right[f"_o{i}"] for i, c in enumerate(order)]
        return rows.join(right, on, "left_semi")
    if ties != "one":
        raise ValueError(f"ties must be 'keep' or 'one', not {ties!r}")
    ranking = [F.col(c).desc_nulls_last() for c in (*order, *tiebreak)]
    window = Window.partitionBy(*keys).orderBy(*ranking, F.xxhash64(*df.columns).desc())
    return rows.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def split_by_verb(df: DataFrame, verb: str = VERB) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes). Rows without a verb belong to neither."""
    return df.where(F.col(verb) != DELETE_VERB), df.where(F.col(verb) == DELETE_VERB)


def flatten_event(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """Pick nested fields into flat columns: ``{"City": "Response.Body.City"}``."""
    return df.select([(F.col(p) if isinstance(p, str) else p).alias(name) for name, p in fields.items()])

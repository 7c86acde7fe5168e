"""Merges as DataFrame operators: target and source in, the new target out.

Every merge is a left join from the target (update, delete) plus an anti join
from the source (insert). Both keep the long side on the left, so adaptive
execution can split a target key that holds many rows, and the source is
reduced to one row per key by an aggregate that combines before its shuffle.
When the caller has measured the source and it is small, it is broadcast and
the target is not shuffled at all.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.snapshot import DELETE_VERB, VERB

# A source at most this many rows long is broadcast; longer ones are shuffled.
BROADCAST_ROWS = 200_000
_PREFIX = "_src_"


def src(name: str) -> Column:
    """A source column inside a merge's ``update`` or ``insert`` values."""
    return F.col(_PREFIX + name)


Values = Mapping[str, "str | Column"]


@dataclass(frozen=True)
class MergeSpec:
    """One merge target: the key columns (target name to source name) and its rules."""

    on: Mapping[str, str]
    update: Values | None = None
    insert: Values | None = None

    @classmethod
    def upsert(cls, on: Mapping[str, str], values: Values) -> MergeSpec:
        """Set ``values`` on a match, insert key and values otherwise."""
        return cls(on=on, update=values, insert={**on, **values})


def _keys(on: str | Sequence[str] | Mapping[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, Mapping) else {k: k for k in on}


def _prefixed(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(_PREFIX + c) for c in df.columns])


def _value(value: str | Column) -> Column:
    return src(value) if isinstance(value, str) else value


def _is_small(rows: int | None) -> bool:
    return rows is not None and rows <= BROADCAST_ROWS


def _one_per_key(source: DataFrame, keys: Sequence[str], rule: str, order: Sequence[str]) -> DataFrame:
    """One source row per key, with ``_n`` = upserts it stands for and ``_dead`` = a delete follows.

    ``source`` carries a boolean ``_gone`` marking its delete rows.
    """
    upsert = ~F.col("_gone")
    if rule == "assume_unique":
        return source.select(
            *[c for c in source.columns if c != "_gone"],
            upsert.cast("bigint").alias("_n"),
            F.col("_gone").alias("_dead"),
        )
    others = [c for c in source.columns if c not in (*keys, "_gone")]
    row = F.when(upsert, F.struct(F.lit(1).alias("_present"), *others))
    if rule == "latest":
        rank = F.struct(*[F.col(c) for c in order], F.xxhash64(*keys, *others))
        pick = F.max_by(row, F.when(upsert, rank))
    elif rule == "error":
        pick = F.first(row, ignorenulls=True)
    else:
        raise ValueError(f"unknown ambiguity rule {rule!r}")
    return (
        source.groupBy(*keys)
        .agg(pick.alias("_row"), F.count_if(upsert).alias("_n"), F.max("_gone").alias("_dead"))
        .select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in others], "_n", "_dead")
    )


def _unambiguous(count: Column) -> Column:
    message = "merge is ambiguous: several source rows match one target row"
    return F.when(count > 1, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))


def _without_matches(source: DataFrame, target: DataFrame, keys: Mapping[str, str], small: bool) -> DataFrame:
    """Source rows (prefixed) whose key is absent from the target."""
    present = target.select([F.col(t).alias(f"_t{i}") for i, t in enumerate(keys)])
    names = list(keys.values())
    if small:
        # only target keys that occur in the short source come back
        wanted = source.select([src(n).alias(f"_w{i}") for i, n in enumerate(names)]).distinct()
        hit = [present[f"_t{i}"] == wanted[f"_w{i}"] for i in range(len(names))]
        present = F.broadcast(present.join(F.broadcast(wanted), hit, "left_semi").distinct())
    else:
        present = present.distinct()
    on = [source[_PREFIX + n] == present[f"_t{i}"] for i, n in enumerate(names)]
    return source.join(present, on, "left_anti")


def _inserted(rows: DataFrame, target: DataFrame, values: Values) -> DataFrame:
    given = {name.lower(): _value(v) for name, v in values.items()}
    return rows.select(
        [given.get(f.name.lower(), F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def merge_into(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    *,
    update: Values | None = None,
    insert: Values | None = None,
    delete: bool = False,
    on_ambiguous: str = "error",
    order: Sequence[str] = (),
    source_rows: int | None = None,
) -> DataFrame:
    """The target after a merge.

    ``update`` and ``insert`` map target columns to source column names or to
    expressions over ``src(name)``; columns not inserted are null. ``delete``
    drops matched target rows instead. Null keys match nothing: such target
    rows stay and such source rows are inserted.

    Several source rows for one *target* row are an error by default, ``"latest"``
    takes the highest by ``order``, ``"assume_unique"`` skips the check for
    sources known to be unique. Unmatched duplicates are all inserted unless
    ``"latest"`` reduces them. ``source_rows`` is the measured source length.
    """
    keys = _keys(on)
    names = list(keys.values())
    small = _is_small(source_rows)
    if delete:
        doomed = source.select([F.col(s).alias(f"_d{i}") for i, s in enumerate(names)]).distinct()
        doomed = F.broadcast(doomed) if small else doomed
        return target.join(doomed, [target[t] == doomed[f"_d{i}"] for i, t in enumerate(keys)], "left_anti")

    rows = source.withColumn("_gone", F.lit(False))
    resolved = _one_per_key(rows, names, on_ambiguous, order)
    result = target
    if update is not None:
        result = _updated(target, resolved, keys, update, on_ambiguous, small)
    if insert is not None:
        fresh = resolved.drop("_n", "_dead") if on_ambiguous == "latest" else source
        result = result.unionByName(_inserted(_without_matches(_prefixed(fresh), target, keys, small), target, insert))
    return result


def _updated(
    target: DataFrame, resolved: DataFrame, keys: Mapping[str, str], values: Values, rule: str, small: bool
) -> DataFrame:
    """Target rows with their match applied: columns set, or the row gone."""
    right = _prefixed(resolved.na.drop(subset=list(keys.values())))
    right = F.broadcast(right) if small else right
    joined = target.join(right, [target[t] == right[_PREFIX + s] for t, s in keys.items()], "left")
    if rule == "error":
        joined = joined.where(_unambiguous(src("_n")))
    changed = {name.lower(): _value(v) for name, v in values.items()}
    return joined.where(~F.coalesce(src("_dead"), F.lit(False))).select(
        [
            F.when(src("_n") > 0, changed[f.name.lower()].cast(f.dataType)).otherwise(target[f.name]).alias(f.name)
            if f.name.lower() in changed
            else target[f.name]
            for f in target.schema.fields
        ]
    )


def apply_changes(
    target: DataFrame,
    snapshot: DataFrame,
    on: str | Sequence[str] | Mapping[str, str],
    *,
    update: Values,
    insert: Values,
    verb: str = VERB,
    on_ambiguous: str = "error",
    order: Sequence[str] = (),
    source_rows: int | None = None,
) -> DataFrame:
    """Upserts, then deletes, in one pass over the target.

    Equal to an upsert merge with the rows of other verbs followed by a delete
    merge with the DELETE rows. Rows without a verb change nothing.
    """
    keys = _keys(on)
    names = list(keys.values())
    small = _is_small(source_rows)
    rows = snapshot.where(F.col(verb).isNotNull()).withColumn("_gone", F.col(verb) == DELETE_VERB)
    resolved = _one_per_key(rows, names, on_ambiguous, order)
    kept = _updated(target, resolved, keys, update, on_ambiguous, small)
    if on_ambiguous == "error":
        # unmatched duplicates are all inserted, unless a delete of their key follows
        fresh = rows.where(~F.col("_gone")).drop("_gone")
        gone = rows.where(F.col("_gone")).select(*names).na.drop().distinct()
        fresh = fresh.join(F.broadcast(gone) if small else gone, names, "left_anti")
    else:
        fresh = resolved.where((F.col("_n") > 0) & ~F.col("_dead")).drop("_n", "_dead")
    return kept.unionByName(_inserted(_without_matches(_prefixed(fresh), target, keys, small), target, insert))


def merge_many(
    targets: Mapping[str, DataFrame],
    source: DataFrame,
    specs: Mapping[str, MergeSpec],
    **options,
) -> dict[str, DataFrame]:
    """Merge one source into several targets. Stage the source first: every target reads it."""
    return {
        name: merge_into(targets[name], source, spec.on, update=spec.update, insert=spec.insert, **options)
        for name, spec in specs.items()
    }


_TARGET, _UPSERT, _GONE = "target", "upsert", "gone"


def merge_shared(
    targets: Mapping[str, DataFrame],
    source: DataFrame,
    specs: Mapping[str, MergeSpec],
    *,
    verb: str | None = None,
    expired: DataFrame | None = None,
    on_ambiguous: str = "error",
    path: str | None = None,
    empty: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Several targets with the same kind of key, merged with one source in one pass.

    Target rows, upserts and ids to be removed are united and meet in one shuffle by key, a source row once for all
    targets; then they are split by target. A target that the caller names in ``empty`` holds no rows: what the source
    brings is new to it, and nothing is shuffled for it unless keys may be removed. The result is that of an upsert merge per target, followed by a delete merge with the
    source rows whose ``verb`` says DELETE (rows without a verb change nothing) and with the keys of ``expired``, whose
    columns stand for the keys of every spec in order. With ``path`` the pass runs once and is staged by target, else
    once per target that is read.

    Rules for null keys and for several source rows of one key are those of ``merge_into``. A key is expected to hold few
    rows of a target, as a primary key does: rows of one key meet in one task, which may spill.
    """
    if on_ambiguous not in ("error", "assume_unique"):
        raise ValueError(f"unknown ambiguity rule {on_ambiguous!r}")
    keys = {name: list(spec.on.values()) for name, spec in specs.items()}
    if len({tuple(k) for k in keys.values()}) > 1:
        raise ValueError("targets that are merged together share the source's key columns")
    key = next(iter(keys.values()))
    vacant = [name for name in specs if name in empty and verb is None and expired is None]
    loaded = {
        name: targets[name] if specs[name].insert is None else _inserted(_prefixed(source), targets[name], specs[name].insert)
        for name in vacant
    }
    names = [name for name in specs if name not in loaded]
    if not names:
        return loaded
    types = [source.schema[k].dataType for k in key]

    def struct_key(columns: Sequence[Column]):
        return F.struct(*[c.cast(t).alias(f"k{i}") for i, (c, t) in enumerate(zip(columns, types, strict=True))]).alias("_key")

    def complete(columns: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])

    tagged, aside = [], {}
    for name in names:
        own = [F.col(f"`{c}`") for c in specs[name].on]
        row = F.struct(*[F.col(f"`{c}`") for c in targets[name].columns]).alias(f"_t_{name}")
        tagged.append(targets[name].where(complete(own)).select(struct_key(own), F.lit(name).alias("_tag"), F.lit(_TARGET).alias("_kind"), row))
        aside[name] = targets[name].where(~complete(own))
    given = [F.col(f"`{c}`") for c in key]
    kind = F.lit(_UPSERT) if verb is None else F.when(F.col(verb) == DELETE_VERB, _GONE).otherwise(_UPSERT)
    rows = source if verb is None else source.where(F.col(verb).isNotNull())
    others = [c for c in source.columns if c not in key]
    # the key is not sent twice; the mark keeps the struct from being without fields
    row = F.struct(F.lit(True).alias("_present"), *[F.col(f"`{c}`") for c in others])
    tagged.append(rows.select(struct_key(given), kind.alias("_kind"), row.alias("_s")))
    if expired is not None:
        ids = [F.col(f"`{c}`") for c in expired.columns]
        tagged.append(expired.where(complete(ids)).select(struct_key(ids), F.lit(_GONE).alias("_kind")))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

    group = Window.partitionBy("_key")
    is_kind = lambda k: F.col("_kind") == k
    united = united.withColumns(
        {
            "_n": F.count_if(is_kind(_UPSERT)).over(group),
            "_dead": F.max(is_kind(_GONE)).over(group),
            **{f"_held_{n}": F.max(F.coalesce(F.col("_tag") == n, F.lit(False))).over(group) for n in names},
            "_given": F.first(F.when(is_kind(_UPSERT), F.col("_s")), ignorenulls=True).over(group),
        }
    )
    if on_ambiguous == "error":
        united = united.where(F.when(is_kind(_TARGET) & ~F.col("_dead"), _unambiguous(F.col("_n"))).otherwise(F.lit(True)))
    null_key = reduce(lambda a, b: a | b, [F.col(f"_key.k{i}").isNull() for i in range(len(key))])
    # a null key is no key: such source rows are inserted whatever else there is
    lacking = [F.when(null_key | ~(F.col(f"_held_{n}") | F.col("_dead")), n) for n in names if specs[n].insert is not None]
    lacking = F.array_compact(F.array(*lacking)) if lacking else F.lit(None)
    places = F.when(is_kind(_TARGET) & ~F.col("_dead"), F.array("_tag")).when(is_kind(_UPSERT), lacking)
    used = F.when(is_kind(_TARGET), F.col("_given")).otherwise(F.col("_s"))
    united = united.select(
        F.explode(places).alias("_tag"), "_kind", "_n", *[f"_t_{n}" for n in names],
        *[F.col(f"_key.k{i}").alias(_PREFIX + c) for i, c in enumerate(key)], *[used[c].alias(_PREFIX + c) for c in others],
    )

    def merged(name: str) -> Column:
        change = {n.lower(): _value(v) for n, v in (specs[name].update or {}).items()}
        fresh = {n.lower(): _value(v) for n, v in (specs[name].insert or {}).items()}
        fields = []
        for f in targets[name].schema.fields:
            old = F.col(f"_t_{name}")[f.name]
            new = F.when(F.col("_n") > 0, change[f.name.lower()].cast(f.dataType)).otherwise(old) if f.name.lower() in change else old
            made = fresh.get(f.name.lower(), F.lit(None)).cast(f.dataType)
            fields.append(F.when(is_kind(_TARGET), new).otherwise(made).alias(f.name))
        return F.when(F.col("_tag") == name, F.struct(*fields)).alias(f"_o_{name}")

    done = united.select("_tag", *[merged(n) for n in names])
    if path is not None:
        done.write.mode("overwrite").partitionBy("_tag").parquet(path)
        fields = [f for f in done.schema.fields if f.name != "_tag"]
        done = done.sparkSession.read.schema(T.StructType([*fields, T.StructField("_tag", T.StringType())])).parquet(path)
    result = dict(loaded)
    for name in names:
        rows = done.where((F.col("_tag") == name) & F.col(f"_o_{name}").isNotNull())
        result[name] = rows.select([F.col(f"_o_{name}")[c].alias(c) for c in targets[name].columns]).unionByName(aside[name])
    return result


@dataclass(frozen=True)
class Sweep:
    """Result of a mark-and-sweep: the new children, the expired ids, the cleaned dependents."""

    children: DataFrame
    expired: DataFrame
    dependents: dict[str, DataFrame] = field(default_factory=dict)


def expired_children(
    children: DataFrame, current: DataFrame, changed_parents: DataFrame, parent: str, child: str
) -> DataFrame:
    """Ids of known children of changed parents that the current children no longer contain."""
    parents = changed_parents.select(parent).distinct()
    return (
        children.join(parents, parent, "left_semi")
        .select(child)
        .distinct()
        .join(current.select(child).distinct(), child, "left_anti")
    )


def mark(children: DataFrame, changed_parents: DataFrame, parent: str, column: str, value: str) -> DataFrame:
    """Existing children of changed parents with ``column`` set to the delete mark."""
    return merge_into(
        children, changed_parents.select(parent).distinct(), parent, update={column: F.lit(value)}, on_ambiguous="assume_unique"
    )


def mark_and_sweep(
    children: DataFrame,
    current: DataFrame,
    changed_parents: DataFrame,
    parent: str,
    child: str,
    dependents: Mapping[str, tuple[DataFrame, str]],
    *,
    expired_path: str | None = None,
) -> Sweep:
    """Replace the children of changed parents and clean up what expired.

    The expired set is computed once from the old children, not by marking rows
    and reading them back. ``dependents`` maps a name to (table, id column).
    With ``expired_path`` the set is staged, because every dependent reads it.
    """
    from quayside.session import stage

    expired = expired_children(children, current, changed_parents, parent, child)
    if expired_path is not None:
        expired = stage(expired, expired_path)
    values = {c: c for c in children.columns if c != child}
    merged = merge_into(
        children, current, child, update=values, insert={child: child, **values}, on_ambiguous="assume_unique"
    )
    swept = merge_into(merged, expired, child, delete=True)
    cleaned = {
        name: merge_into(df, expired, {column: child}, delete=True) for name, (df, column) in dependents.items()
    }
    return Sweep(children=swept, expired=expired, dependents=cleaned)


def merge_table(source: DataFrame, table: str, spec: MergeSpec, *, delete_verb: str | None = None) -> None:
    """The same merge, done in place by a table format that can change single rows.

    Such a format rewrites only the files that hold matched rows, where
    ``merge_into`` yields the whole new target. With ``delete_verb`` matched
    rows whose verb column says DELETE are removed and never inserted.
    Ambiguity is checked by the format. Parquet tables do not support it.
    """
    rows = _prefixed(source)
    condition = F.lit(True)
    for t, s in spec.on.items():
        condition = condition & (F.col(t) == src(s))
    writer = rows.mergeInto(table, condition)
    live = F.lit(True)
    if delete_verb is not None:
        live = src(delete_verb) != DELETE_VERB
        writer = writer.whenMatched(src(delete_verb) == DELETE_VERB).delete()
    if spec.update is not None:
        writer = writer.whenMatched(live).update({name: _value(v) for name, v in spec.update.items()})
    if spec.insert is not None:
        writer = writer.whenNotMatched(live).insert({name: _value(v) for name, v in spec.insert.items()})
    writer.merge()

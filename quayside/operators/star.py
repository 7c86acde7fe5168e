"""Joins and filters along the relationships of a star schema."""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.dates import booked_date


@dataclass(frozen=True)
class Relationship:
    """An edge from the many side (or the first of two one sides) to the one side."""

    from_table: str
    from_column: str
    to_table: str
    to_column: str
    one_to_one: bool = False
    both: bool = False
    active: bool = True
    day_only: bool = False


def _key(df: DataFrame, column: str, day_only: bool) -> Column:
    return booked_date(df[column]) if day_only else df[column]


def require_unique(df: DataFrame, key: str, label: str) -> DataFrame:
    """Fail when a one side repeats a key; the check combines before its shuffle."""
    row = F.struct(*[c for c in df.columns if c != key])
    message = F.concat(F.lit(f"{label} is not unique on {key}: "), F.col(key).cast("string"))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.first(row).alias("_row"), F.count(F.lit(1)).alias("_n"))
        .where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        .select(key, *[F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != key])
    )


def related(
    fact: DataFrame,
    dim: DataFrame,
    rel: Relationship,
    columns: Sequence[str],
    *,
    blank_member: bool = True,
    use_inactive: bool = False,
) -> DataFrame:
    """Columns of the one side on every row of the many side.

    Rows without a match keep null labels (the blank member), or are dropped.
    Spark broadcasts the dimension when its size allows; otherwise the fact is
    the left side of the shuffle join, which may be split on a hot key.
    """
    if not rel.active and not use_inactive:
        raise ValueError(f"{rel.from_table}.{rel.from_column} -> {rel.to_table} is only used on request")
    side = dim.select(_key(dim, rel.to_column, rel.day_only).alias("_one"), *columns)
    on = _key(fact, rel.from_column, rel.day_only) == side["_one"]
    return fact.join(side, on, "left" if blank_member else "inner").drop("_one")


def related_one(left: DataFrame, right: DataFrame, rel: Relationship, *, use_inactive: bool = False) -> DataFrame:
    """Full outer join of two one sides; a repeated key on either side is an error."""
    if not rel.active and not use_inactive:
        raise ValueError(f"{rel.from_table}.{rel.from_column} -> {rel.to_table} is only used on request")
    a = require_unique(left, rel.from_column, rel.from_table)
    b = require_unique(right, rel.to_column, rel.to_table)
    if rel.to_column != rel.from_column:
        b = b.withColumnRenamed(rel.to_column, rel.from_column)
    return a.join(b, rel.from_column, "full_outer")


def propagate_filter(
    dim: DataFrame, fact: DataFrame, rel: Relationship, both: bool = False
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Restrict the many side to the rows that belong to a filtered one side.

    With ``both`` the one side is then restricted to what is left of the many
    side, and the pair (fact, dim) is returned. Keys are reduced to distinct
    ones before they are shuffled.
    """
    ones = dim.select(_key(dim, rel.to_column, rel.day_only).alias("_one")).distinct()
    kept = fact.join(ones, _key(fact, rel.from_column, rel.day_only) == ones["_one"], "left_semi")
    if not both:
        return kept
    many = kept.select(_key(kept, rel.from_column, rel.day_only).alias("_many")).distinct()
    return kept, dim.join(many, _key(dim, rel.to_column, rel.day_only) == many["_many"], "left_semi")


def count_related(parent: DataFrame, child: DataFrame, key: str, child_key: str, out: str) -> DataFrame:
    """Number of child rows per parent, blank when there are none."""
    counts = child.groupBy(F.col(child_key).alias("_child")).agg(F.count(F.lit(1)).alias(out))
    return parent.join(counts, parent[key] == counts["_child"], "left").drop("_child")


@dataclass(frozen=True)
class Step:
    """One hop of a path: which edge, and whether it is walked from many to one."""

    rel: Relationship
    forward: bool

    @property
    def fans_out(self) -> bool:
        return not self.forward and not self.rel.one_to_one

    @property
    def start_column(self) -> str:
        return self.rel.from_column if self.forward else self.rel.to_column

    @property
    def end_table(self) -> str:
        return self.rel.to_table if self.forward else self.rel.from_table

    @property
    def end_column(self) -> str:
        return self.rel.to_column if self.forward else self.rel.from_column


def path_between(relationships: Sequence[Relationship], start: str, goal: str) -> list[Step]:
    """The shortest chain of active edges along which a filter on ``goal`` reaches ``start``.

    Edges count from many to one, and backwards only where they filter both ways.
    """
    queue: deque[tuple[str, list[Step]]] = deque([(start, [])])
    seen = {start}
    while queue:
        table, steps = queue.popleft()
        if table == goal:
            return steps
        for rel in relationships:
            if not rel.active:
                continue
            for step in (
                [Step(rel, True)] if rel.from_table == table else []
            ) + ([Step(rel, False)] if rel.to_table == table and rel.both else []):
                if step.end_table not in seen:
                    seen.add(step.end_table)
                    queue.append((step.end_table, [*steps, step]))
    raise ValueError(f"no relationship path from {start} to {goal}")


def filter_tree(relationships: Sequence[Relationship], start: str) -> dict[str, tuple[str, Step]]:
    """For each table from which a filter can reach ``start``: the next table on the shortest way, and the step from that
    table to it. Edges are taken in the order they are given."""
    found: dict[str, tuple[str, Step]] = {}
    queue = deque([start])
    while queue:
        table = queue.popleft()
        for rel in relationships:
            if not rel.active:
                continue
            steps = [Step(rel, True)] if rel.from_table == table else []
            steps += [Step(rel, False)] if rel.to_table == table and rel.both else []
            for step in steps:
                if step.end_table != start and step.end_table not in found:
                    found[step.end_table] = (table, step)
                    queue.append(step.end_table)
    return found


def propagate_to(
    tables: Mapping[str, DataFrame], relationships: Sequence[Relationship], filters: Mapping[str, Column], goal: str
) -> DataFrame:
    """The rows of ``goal`` that are left when all filters act together.

    Filters travel to ``goal`` along the tree of shortest ways that lead there, from the leaves inwards: a table keeps the
    rows that pass its own filter and have a partner in each filtered branch behind it. Since the ways form a tree, one
    such pass leaves nothing to be filtered further. Branches without a filter are not read, rows are never multiplied,
    and what is shuffled of a branch are its distinct keys. A filter from which no way leads to ``goal`` does not act.
    A null key has no partner.
    """
    tree = filter_tree(relationships, goal)
    used = {goal}
    for table in filters:
        while table in tree and table not in used:
            used.add(table)
            table = tree[table][0]

    def left(table: str) -> DataFrame:
        rows = tables[table].where(filters[table]) if table in filters else tables[table]
        for child, (inner, step) in tree.items():
            if inner != table or child not in used:
                continue
            branch = left(child)
            near, far = (step.rel.from_column, step.rel.to_column) if step.forward else (step.rel.to_column, step.rel.from_column)
            keys = branch.select(_key(branch, far, step.rel.day_only).alias("_far")).distinct()
            rows = rows.join(keys, _key(rows, near, step.rel.day_only) == keys["_far"], "left_semi")
        return rows

    return left(goal)


def propagate_all(
    tables: Mapping[str, DataFrame], relationships: Sequence[Relationship], filters: Mapping[str, Column], goals: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Every table (or each of ``goals``) under filters on several tables at once. ``filters`` maps a table to a condition
    on its columns."""
    return {goal: propagate_to(tables, relationships, filters, goal) for goal in (goals or list(tables))}

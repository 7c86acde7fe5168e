"""Lookup, semi and outer joins of the mapping jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_any(
    df: DataFrame, dim: DataFrame, column: str, codes: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Left join where the upper-cased text equals any of several code columns.

    The dimension is unpivoted into (code, row) pairs, so the OR becomes an
    equality and any join strategy applies. A dimension row whose codes are
    equal is found once; two rows with the same code both match. Spark decides
    from the dimension's size whether to broadcast it.
    """
    pairs = (
        dim.select(
            F.explode(F.array_distinct(F.array(*[F.col(c) for c in codes]))).alias("_code"),
            *[F.col(v).alias(v) for v in values],
        )
        .where(F.col("_code").isNotNull())
    )
    return df.join(pairs, F.upper(df[column]) == pairs["_code"], "left").drop("_code")


def semi(df: DataFrame, other: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``df`` with at least one match. The other side is reduced to its distinct keys."""
    keys = other.select([F.col(o).alias(f"_k{i}") for i, o in enumerate(on.values())]).distinct()
    return df.join(keys, [df[c] == keys[f"_k{i}"] for i, c in enumerate(on)], "left_semi")


def outer_using(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with one merged key. Null keys never match and stay on both sides.

    Written as a left outer join plus the rows of the right side whose key the
    left side lacks: adaptive execution can split a key that holds many rows of
    the left side, which it cannot in a full outer join. The anti join needs
    the left side's distinct keys only, and its long side may be split as well.
    Put the side with hot keys on the left. Rows with null keys are set aside
    and added back, so they do not pile up in one task of the shuffle.
    """
    on = list(on)
    filled = F.lit(True)
    for key in on:
        filled = filled & F.col(key).isNotNull()
    known, other = left.where(filled), right.where(filled)
    alone = other.join(known.select(*on).distinct(), on, "left_anti")
    joined = known.join(other, on, "left").unionByName(alone, allowMissingColumns=True)
    for side in (left, right):
        joined = joined.unionByName(side.where(~filled), allowMissingColumns=True)
    return joined

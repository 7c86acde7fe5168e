"""Mixing sources to target weights under a time-varying curriculum. DataFrame functions only.

Each source has a weight schedule over training time 0..1. Its integral, against those of the others, gives the source's
share of the words to train on; no source gives more than ``most`` times its size, and what is over is shared anew by
weight. A source's documents stand in a fixed pseudo-random order; the words before a document (its demand) are set
against the cumulative demand of the schedule, whose inverse is the document's position in training. A second pass over
the source goes on where the first ended, so each draw has a position of its own. Draws are then sorted by position
across ranges.

Running sums never pass through one task: the order of a source is cut into about sqrt(rows) hash ranges, summed per
range first, so a source with a third of all rows is spread over as many tasks as any other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import free_name, query, table
from quayside.session import run_dir, stage

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Schedule:
    """Weight ``base`` times a factor that runs in straight lines through ``knots`` (time, factor); times 0 to 1."""

    base: float
    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def integrals(self) -> list[float]:
        """Integral of the factor up to each knot."""
        out = [0.0]
        for (t0, f0), (t1, f1) in zip(self.knots, self.knots[1:], strict=False):
            out.append(out[-1] + (t1 - t0) * (f0 + f1) / 2)
        return out

    @property
    def weight(self) -> float:
        return self.base * self.integrals()[-1]

    def invert(self, share: Column) -> Column:
        """Time at which ``share`` (0 to 1) of the schedule's demand is met."""
        sums = self.integrals()
        want, out = share * sums[-1], F.lit(self.knots[-1][0])
        for k in range(len(self.knots) - 2, -1, -1):
            (t0, f0), (t1, f1) = self.knots[k], self.knots[k + 1]
            slope, rest = (f1 - f0) / (t1 - t0), want - F.lit(sums[k])
            time = rest / F.lit(f0) if slope == 0 else (F.sqrt(F.lit(f0 * f0) + rest * (2 * slope)) - f0) / slope
            out = F.when(want < F.lit(sums[k + 1]), time + t0).otherwise(out)
        return out


@dataclass(frozen=True)
class Mix:
    """``schedules`` repeat over the sources in code-point order; ``share`` of all words is taken, ``most`` per source."""

    schedules: tuple[Schedule, ...] = field(
        default=(Schedule(5.0, ((0.0, 1.5), (1.0, 0.5))), Schedule(2.0), Schedule(1.0, ((0.0, 0.5), (1.0, 1.5))))
    )
    share: float = 1.5
    most: int = 2
    seed: str = "curriculum"


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source (one row each): ``source_size``, ``place`` in the schedules, ``target`` in words.

    With sources ordered by cap over weight, the level ``(words - caps before) / weights left`` peaks where the first
    source stays below its cap; that peak times its weight, or its cap, is a source's target.
    """
    everything = Window.partitionBy()
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = ((F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1) % len(mix.schedules)).cast("int")
    weight = F.element_at(F.array(*[F.lit(s.weight) for s in mix.schedules]), F.col("place") + 1)
    by = by.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(mix.most)))
    upto = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    left = F.sum("source_size").over(everything) * F.lit(mix.share) - (F.sum("cap").over(upto) - F.col("cap"))
    level = left / (F.sum("weight").over(everything) - (F.sum("weight").over(upto) - F.col("weight")))
    by = by.withColumn("level", level)
    return by.select("source", "source_size", "place", F.least("cap", F.col("weight") * F.max("level").over(everything)).alias("target"))


def assign(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", text: str = "text", source: str = "source", whole: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``size``, ``source``, ``source_size``, ``target``, ``taken``, ``copies``, ``position``,
    ``positions``.

    ``taken`` counts the words drawn in up to ``most`` passes over the source: documents stand end to end on a circle and
    are taken until the target is met, the last one in part, or with ``whole`` only documents whose middle lies before
    the target. ``positions`` has one position per draw, pass by pass; ``position`` is the first, null if there is none;
    ``copies`` counts draws.

    A null text has size 0; null sources form one source, after all others; a null key is a key; rows that agree in key
    and size are interchangeable; an empty table gives no rows; other columns are not read.
    """
    mix = mix or Mix()
    spark = docs.sparkSession
    sizes = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    )
    sizes = stage(sizes, run_dir(spark, "mix-sizes"))
    ranges = max(1, math.isqrt(sizes.count()))
    plan = targets(sizes, mix)
    order = F.md5(F.concat_ws("/", F.col("key").cast("string"), F.lit(mix.seed)))
    part = F.shiftright(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * ranges, 32)
    named = sizes.withColumn("order", order).withColumn("part", part).withColumns(
        {"no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))}
    )
    keys = ["no_source", "name"]
    sums = named.groupBy(*keys, "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("part_size").over(before), F.lit(0))).drop("part_size")
    goals = plan.select(
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "place", "target"
    )
    inner = Window.partitionBy(*keys, "part").orderBy("order", "key", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        named.withColumn("within", F.sum("size").over(inner) - F.col("size"))
        .join(sums.join(goals, keys), [*keys, "part"])
        .withColumn("start", F.col("ahead") + F.col("within"))
    )
    return draws(placed, mix, whole).select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target", "taken", "copies", "position", "positions"
    )


def draws(placed: DataFrame, mix: Mix, whole: bool) -> DataFrame:
    """Words taken in each pass from a document that starts at ``start``, and the position of each draw."""
    goal = F.floor(F.col("target") + 0.5)
    taken, copies, times = F.lit(0), F.lit(0), []
    for turn in range(mix.most):
        at = F.col("start") + F.col("source_size") * turn
        if whole:
            part = F.when((F.col("size") > 0) & (at * 2 + F.col("size") < goal * 2), F.col("size")).otherwise(0)
        else:
            part = F.greatest(F.lit(0), F.least(F.col("size"), goal - at))
        taken, copies = taken + part, copies + (part > 0).cast("int")
        middle, time = (at + part / 2) / F.col("target"), F.lit(None).cast("double")
        for k, schedule in enumerate(mix.schedules):
            time = F.when(F.col("place") == k, schedule.invert(middle)).otherwise(time)
        times.append(F.when(part > 0, F.round(time, 9)))
    return placed.withColumns(
        {"taken": taken.cast("long"), "copies": copies.cast("int"), "position": times[0], "positions": F.array_compact(F.array(*times))}
    )


def in_training_order(assigned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows sorted by position over range partitions; rows without a position come first, by key."""
    n = int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return assigned.repartitionByRange(n, "position", key).sortWithinPartitions("position", key)


def mix_documents(docs: DataFrame, mix: Mix | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is drawn, whole, sorted by position within ranges.

    Repeated keys draw together: they take the draws of their row with the largest count. Rows with a null key or source
    are drawn like others, a null text is never drawn; an empty table gives no rows; other columns, whatever their names,
    go along.
    """
    assigned = assign(docs, mix, key, text, source, whole=True).where("copies > 0")
    same, drawn, turn, position = (free_name(n, docs) for n in ("_key", "_positions", "_turn", "_position"))
    chosen = assigned.groupBy(F.col(key).alias(same), F.col(key).isNull().alias(free_name("_none", docs))).agg(
        F.max_by("positions", F.struct("copies", -F.col("position"), "positions")).alias(drawn)
    )
    chosen = chosen.select(same, drawn)
    joined = docs.join(chosen, docs[key].eqNullSafe(chosen[same]))
    repeated = joined.select(*[docs[c] for c in docs.columns], F.posexplode(drawn).alias(turn, position))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return repeated.repartitionByRange(n, position, key, turn).sortWithinPartitions(position, key).drop(turn, position)


SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source IS NULL, source)) - 1) % 3 AS place
  FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CASE place WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, source_size::DOUBLE * 2.0::DOUBLE AS cap FROM by_source
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - (sum(cap) OVER w - cap)) / (sum(weight) OVER () - (sum(weight) OVER w - weight)) AS level
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source IS NULL, source ROWS UNBOUNDED PRECEDING)
), goals AS (
  SELECT source, source_size, place, least(cap, weight * max(level) OVER ()) AS target FROM levels
), placed AS (
  SELECT s.*, g.source_size, g.place, g.target, floor(g.target + 0.5) AS goal,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY md5(concat_ws('/', s.doc_id::VARCHAR, 'curriculum')), s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), taken AS (
  SELECT *, (greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size)))::BIGINT AS taken,
    (CASE WHEN least(size, goal - start) > 0 THEN 1 ELSE 0 END + CASE WHEN least(size, goal - start - source_size) > 0 THEN 1 ELSE 0 END)::INTEGER AS copies
  FROM placed
), shares AS (
  SELECT *, (start::DOUBLE + least(size, taken)::DOUBLE / 2) / target AS share FROM taken WHERE taken > 0
)
SELECT t.doc_id, t.size, t.source, t.source_size, t.target, t.taken, t.copies, CASE WHEN t.taken > 0 THEN round(
    CASE t.place WHEN 0 THEN CASE WHEN x < 1 THEN (sqrt(2.25 - 2 * x) - 1.5) / -1 ELSE 1 END
                 WHEN 1 THEN CASE WHEN x < 1 THEN x ELSE 1 END
                 ELSE CASE WHEN x < 1 THEN (sqrt(0.25 + 2 * x) - 0.5) ELSE 1 END END, 9) END AS position
FROM (SELECT *, (start::DOUBLE + least(size, taken)::DOUBLE / 2) / nullif(target, 0) AS x FROM taken) t
"""


@query("op4_curriculum_mix", SQL)
def curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of 150 % of all words, with its position in training."""
    mixed = assign(table(spark, sf_dir, "documents"))
    return in_training_order(mixed).select("doc_id", "size", "source_size", "target", "taken", "source", "copies", "position")


DRAWS_SQL = SQL[: SQL.index("), shares AS (")] + r"""), drawn AS (
  SELECT doc_id, source, target, place, start, turn, source_size, greatest(0, least(size, goal - start - turn * source_size))::BIGINT AS words
  FROM taken, (VALUES (0), (1)) AS passes(turn)
)
SELECT doc_id, source, turn::INTEGER AS turn, words, round(
    CASE place WHEN 0 THEN CASE WHEN x < 1 THEN (sqrt(2.25 - 2 * x) - 1.5) / -1 ELSE 1 END
               WHEN 1 THEN CASE WHEN x < 1 THEN x ELSE 1 END
               ELSE CASE WHEN x < 1 THEN (sqrt(0.25 + 2 * x) - 0.5) ELSE 1 END END, 9) AS position
FROM (SELECT *, (start + turn * source_size + words::DOUBLE / 2) / target AS x FROM drawn WHERE words > 0)
"""


@query("op4_curriculum_draws", DRAWS_SQL)
def curriculum_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of that mix: its document, pass, words and position in training."""
    mixed = assign(table(spark, sf_dir, "documents"))
    drawn = mixed.select("doc_id", "source", "size", "taken", F.posexplode("positions").alias("turn", "position"))
    words = F.least(F.col("size"), F.col("taken") - F.col("turn") * F.col("size"))
    return in_training_order(drawn.withColumn("words", words)).select("doc_id", "source", "turn", "words", "position")

"""Chat formatting: one rendering of a dialogue for every participant. DataFrame functions only.

For each participant, their messages become the assistant's and are masked in (to be learned); everybody else is a named
user and is masked out. A row holds 64 turns of one perspective, so typical dialogues fit one row and very long ones go
on in further parts; no dialogue is ever gathered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayside.llm.common import query, table
from quayside.session import run_dir, stage

#: Turns in a part, and messages in a part before it is cut into pieces.
TURNS, MESSAGES = 64, 1024
END = "<|end|>\n"


def perspectives(messages: DataFrame, key: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text") -> DataFrame:
    """``key``, ``assistant``, ``part``, ``piece``, ``n_turns``, ``n_own``, ``dialogue``, ``mask_spans``.

    ``mask_spans`` lists ``from-to`` of the characters to learn. Messages that agree in all four columns are one; those of
    one turn are ordered by speaker and text; a null turn comes first, in part -1; a null speaker has an empty name; a null
    text is empty; null keys form one dialogue. ``<|`` inside a text or a name is written ``< |``, so no message can open a
    turn. Where repeated turn numbers put more than 1024 messages into a part, it is cut into pieces, runs of 1024 in that
    order (the SQL below writes such a part as one). Other columns are not read; an empty table gives no rows.
    """
    safe = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    said = messages.select(
        F.coalesce(F.floor(F.col(turn) / TURNS), F.lit(-1)).cast("long").alias("part"),
        F.col(key).alias("conv"), F.col(key).isNull().alias("none"), F.col(turn).alias("turn"), safe(speaker).alias("who"), safe(text).alias("text"),
    ).distinct().withColumn("conv_key", F.coalesce(F.col("conv").cast("string"), F.lit("")))
    spot = ["none", "conv_key", "part"]
    full = said.groupBy(*spot).count().where(F.col("count") > MESSAGES).select(*spot)
    cool = said.join(full, spot, "left_anti").withColumn("piece", F.lit(0))
    cut = cool.unionByName(in_runs(said.join(full, spot, "left_semi"), spot))
    parts = cut.groupBy(*spot, "piece").agg(F.first("conv").alias("conv"), F.array_sort(F.collect_list(F.struct("turn", "who", "text"))).alias("turns"))
    people = said.select("none", "conv_key", F.col("who").alias("assistant")).distinct()
    rows = parts.join(people, ["none", "conv_key"]).withColumn("shown", F.transform("turns", render))
    own = F.filter("shown", lambda s: s["own"])
    return rows.select(
        F.col("conv").alias(key),
        "assistant",
        "part",
        "piece",
        F.size("turns").cast("long").alias("n_turns"),
        F.size(own).cast("long").alias("n_own"),
        F.array_join(F.transform("shown", lambda s: F.concat(s["head"], s["body"])), "").alias("dialogue"),
        F.array_join(spans("shown"), ",").alias("mask_spans"),
    )


def in_runs(full: DataFrame, spot: list[str]) -> DataFrame:
    """Messages of full parts with their ``piece``: ranks in order are sums over ranges, so no part passes one task."""
    spark, line = full.sparkSession, ["turn", "who", "text"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(full.repartitionByRange(n, *spot, *line).withColumn("range", F.spark_partition_id()), run_dir(spark, "full-parts"))
    before = Window.partitionBy(*spot).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*spot, "range").count().select(*spot, "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy(*spot, "range").orderBy(*line)) - 1
    ranked = ranged.withColumn("within", within).join(sums, [*spot, "range"])
    return ranked.withColumn("piece", F.floor((F.col("ahead") + F.col("within")) / MESSAGES).cast("int")).select(*full.columns, "piece")


def render(message: Column) -> Column:
    """Header and body of a message as the column ``assistant`` sees it."""
    own = message["who"] == F.col("assistant")
    head = F.when(own, F.lit("<|assistant|>\n")).otherwise(F.concat(F.lit("<|user name="), message["who"], F.lit("|>\n")))
    return F.struct(own.alias("own"), head.alias("head"), F.concat(message["text"], F.lit(END)).alias("body"))


def spans(shown: str) -> Column:
    """``from-to`` of each own body, in characters of the dialogue."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, s: Column) -> Column:
        body = acc["at"] + F.length(s["head"])
        end = body + F.length(s["body"])
        span = F.concat_ws("-", body.cast("string"), end.cast("string"))
        return F.struct(end.alias("at"), F.when(s["own"], F.array_append(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(shown, start, step, lambda acc: acc["spans"])


SQL = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, replace(coalesce(role, ''), '<|', '< |') AS who, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations
), seen AS (
  SELECT s.conv_id, p.who AS assistant, coalesce(floor(s.turn / 64.0), -1)::BIGINT AS part, s.turn, s.who, s.text, s.who = p.who AS own,
    CASE WHEN s.who = p.who THEN '<|assistant|>' ELSE '<|user name=' || s.who || '|>' END || chr(10) AS head, s.text || '<|end|>' || chr(10) AS body
  FROM said s JOIN (SELECT DISTINCT conv_id, who FROM said) p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, assistant, part ORDER BY turn NULLS FIRST, who, text ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM seen
)
SELECT conv_id, assistant, part, 0::INTEGER AS piece, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
  string_agg(head || body, '' ORDER BY turn NULLS FIRST, who, text) AS dialogue,
  coalesce(string_agg((upto - length(body)) || '-' || upto, ',' ORDER BY turn NULLS FIRST, who, text) FILTER (own), '') AS mask_spans
FROM placed GROUP BY conv_id, assistant, part
"""


@query("op1_perspective_rotation", SQL)
def perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, as each participant sees them."""
    return perspectives(table(spark, sf_dir, "conversations"))

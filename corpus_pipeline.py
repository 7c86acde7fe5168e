"""From raw documents to token ids in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet in
the shared folder and read again as the next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bpe, jaccard, lines, mixing, toxicity
from quayside.llm.common import free_name, ship, small_batches, table
from quayside.session import run_dir, stage

#: A document whose score is at least this is rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; all others, null and empty texts included, stay as they are, whatever columns they
    have. Rows that repeat go or stay together. An empty table gives an empty one."""
    ship(spark)
    small_batches(spark)
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"))
    score = free_name("score", docs)
    scored = docs.withColumn(score, toxicity.scorer(model)(F.col("text")))
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals but for one character go; every document stays, with ``n_chars`` of its new text.
    Null texts stay null. An empty table gives an empty one; other columns go along."""
    kept = lines.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at a similarity of 0.8 over five words, the document with the smallest id stays. Rows of one id
    are one document; documents without words are linked with nothing and stay. An empty table gives an empty one; other
    columns, whatever their names, go along."""
    ship(spark)
    groups = jaccard.join_documents(docs, width=5, percent=80, counts=False)
    kept = free_name("_stays", docs)
    stays = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(stays, docs["doc_id"].eqNullSafe(stays[kept]), "left_semi")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them (none, once or twice), in training order. Documents without words are never
    drawn. An empty table gives an empty one; other columns, whatever their names, go along."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids of each drawn document, with digests of the ids and of the text they decode to; one row for each
    draw, a null text counts as empty, other columns are left out."""
    ship(spark)
    small_batches(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: Classifier and tokenizer are no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), run_dir(spark, f"pipeline-{name}"))
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir)

"""The corpus pipeline: quality rules, toxicity, near-duplicates, mixing and packing over `documents`.

Each stage is a function of (spark, docs, sf_dir). All but the last return the columns of `docs`, whatever
they are; the next stage reads what the one before has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import duplicates, mixing, packing, rules, toxicity
from duelframe.llm.common import discard, in_stored_order, ship, stored, table, tables_stored

#: Texts that score less are kept.
TOXIC = toxicity.THRESHOLD


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language and source."""
    ship(spark)
    return rules.keep(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones among them doesn't find toxic."""
    ship(spark)
    return toxicity.keep(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")), TOXIC)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest id."""
    ship(spark)
    return duplicates.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix; those of sources that weigh more than their size come again."""
    ship(spark)
    order = ["slot", "place", "doc_id"]
    whole = docs.select("doc_id", "source", F.length("text").alias("size"), F.struct(*docs.columns).alias("whole"))
    return mixing.mix(whole, size="size").repartitionByRange(*order).sortWithinPartitions(*order).select("whole.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens, which follow the order in which the mix was written.

    `epoch` tells the pieces of a document's copies apart.
    """
    ship(spark)
    pieces = packing.pack(in_stored_order(docs.select("doc_id", "text"), "nth"), order="nth")
    return pieces.select("doc_id", "epoch", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "kind")


STAGES = [("quality", quality), ("clean", clean), ("distinct", distinct), ("mixed", mixed), ("packed", packed)]

#: Models and cut texts: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), len(tables_stored(spark))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        discard(spark, before, keep=1)  # what the stage stored on its way, and what it read
    return STAGES[-1][1](spark, docs, sf_dir)

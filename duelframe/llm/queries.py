"""Registered queries of the operators: whole tables in, the contract's columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import duplicates, factorisation, fingerprints, html_text, languages, licences, merkle, mixing, negatives, packing, rules, simhash, toxicity
from duelframe.llm.common import id_crc, ship, table
from duelframe.llm.sql import ORACLE_SQL


def op1_pack_nnls(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, one row per piece."""
    ship(spark)
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "kind")


def op2_locally_consistent(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    ship(spark)
    return fingerprints.fingerprint(table(spark, folder, "documents"))


def op3_pfair_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Each document's places in the mix of all sources, one row per epoch."""
    ship(spark)
    documents = table(spark, folder, "documents").select("doc_id", "source", F.length("text").cast("long").alias("size"))
    return mixing.mix(documents, size="size").drop("size")


def op4_crf_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    ship(spark)
    documents = table(spark, folder, "documents")
    found = languages.predict(documents, languages.learn(documents))
    return found.withColumn("held_out", id_crc() % 3 == 1).select("doc_id", "held_out", "lang_pred", "score")


def op5_adaptive_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document, the base rules' verdict and that of its group's thresholds."""
    ship(spark)
    judged = rules.judge(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_dart_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate class of every document, and whether it stands for it."""
    ship(spark)
    return duplicates.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "kept")


def op7_factorisation(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    ship(spark)
    documents = table(spark, folder, "documents")
    model = factorisation.learn(documents, table(spark, folder, "labels"))
    return factorisation.score(documents, model).withColumn("held_out", id_crc() % 5 == 0).select("doc_id", "held_out", "score", "predicted")


def op8_tag_path_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    ship(spark)
    found = html_text.extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long")).select("page_id", "url", "text", "n_chars")


def op9_multiple_instance(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    ship(spark)
    documents = table(spark, folder, "documents")
    model = toxicity.learn(documents, table(spark, folder, "labels"))
    return toxicity.score(documents, model).withColumn("held_out", id_crc() % 4 == 2).select("doc_id", "held_out", "score", "predicted")


def op10_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Licence notices of every document."""
    ship(spark)
    return licences.scan(table(spark, folder, "documents")).drop("spans", "expressions")


def op11_simhash_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document, and the component of fingerprints it belongs to."""
    ship(spark)
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_text(F.col("bits")).alias("fingerprint"), "component_id")


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The hard negatives of every anchor beside each of its positives."""
    ship(spark)
    return negatives.mine(table(spark, folder, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest's digests for every document, its proof, and whether the row as received is verified."""
    return merkle.verify(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_nnls": op1_pack_nnls,
    "op2_locally_consistent": op2_locally_consistent,
    "op3_pfair_mix": op3_pfair_mix,
    "op4_crf_language": op4_crf_language,
    "op5_adaptive_rules": op5_adaptive_rules,
    "op6_dart_minhash": op6_dart_minhash,
    "op7_factorisation": op7_factorisation,
    "op8_tag_path_ratios": op8_tag_path_ratios,
    "op9_multiple_instance": op9_multiple_instance,
    "op10_licences": op10_licences,
    "op11_simhash_blocks": op11_simhash_blocks,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_merkle_manifest": op13_merkle_manifest,
}

__all__ = ["ORACLE_SQL", "QUERIES"]

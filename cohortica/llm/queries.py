"""Registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortica.llm import (
    filter_audit, fuzzy_lines, language, licences, mixing, near_vectors, secrets, simhash, syncmers, token_files, whitening,
    winnowing, wordpiece)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stand in a tree source/thousand/fifty/; every fiftieth is its directory's licence file, every
    thousandth that of the directory above."""
    docs = _table(spark, folder, "documents")
    thousand, fifty = F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 50)
    path = (F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", "source", thousand, F.lit("LICENSE")))
            .when(F.col("doc_id") % 50 == 0, F.concat_ws("/", "source", thousand, fifty, F.lit("LICENSE")))
            .when(F.col("doc_id").isNotNull(), F.concat_ws("/", "source", thousand, fifty, F.concat("doc_id", F.lit(".txt")))))
    return licences.scan(docs.select("doc_id", path.alias("path"), "text"))


def op2_syncmers(spark: SparkSession, folder: str) -> DataFrame:
    return syncmers.fingerprints(_table(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.with_copies(_table(spark, folder, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict(_table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return wordpiece.token_counts(_table(spark, folder, "documents"))


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(_table(spark, folder, "documents"))


def op10_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_lines.dedup(_table(spark, folder, "documents"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def op12_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(_table(spark, folder, "embeddings"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_licences, op2_syncmers, op3_mixing, op4_decontamination, op5_secrets, op6_language, op7_token_counts, op8_simhash,
    op9_token_files, op10_fuzzy_lines, op11_whitening, op12_embedding_dedup, op13_filter_audit)}

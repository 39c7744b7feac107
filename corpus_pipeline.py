"""A corpus pipeline over documents: quality, near duplicates, secrets, mixing, encoding.

Each stage works on all that the one before kept and returns the columns of documents, except the last,
which returns the ids of the pieces. Every stage gives no rows for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import jaccard_join, piece_coding, quality_rules, secret_links, source_mix
from marketlens.session import settle


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out documents that the quality rules reject; a null text has no words and is rejected."""
    return quality_rules.judge(docs, quality_rules.references(docs)).where("quality.kept").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the smallest doc_id, then the smallest digest of the row.

    Rows are compared one by one, so unlike texts under one id all stay; rows without an id stay as they are.
    """
    rows = settle(docs.where("doc_id is not null").select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row")))
    found = jaccard_join.near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text")).select(F.col("doc_id").alias("row"), "component_id")
    rank = F.struct("doc.doc_id", F.sha2(F.to_json("doc"), 256), "row")
    ranked = rows.select("row", rank.alias("rank")).join(found, "row")
    kept = ranked.groupBy("component_id").agg(F.min("rank").alias("rank")).select("rank.row")
    return rows.join(kept, "row", "left_semi").select("doc.*").select(*docs.columns).union(docs.where("doc_id is null"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Masks secrets and brings n_chars in line; all rows stay, null texts too."""
    return secret_links.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their targets; a null source is one source."""
    return source_mix.emit(source_mix.mix(docs)).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids of the pieces of each document, one row per row; a null text has none."""
    return piece_coding.encode(docs).select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("n-gram jaccard join", near_duplicates), ("secret scans", secrets),
    ("mixing sources", mixing), ("sentencepiece", encoding)]

#: SQL cannot express the divergence rules or the encoding; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in turn; each one's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, folder))
    return docs

"""Corpus pipeline: quality, repeated lines, near-duplicates, benchmark contamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.  All stages but the last return the columns of
``documents``.  A null text is treated as empty by every stage.  Rows that share a doc_id, or have none, are
judged row by row: a verdict holds for the rows of its id and text.  Near-duplicates are the exception: rows that share a doc_id
are one document there (see the operator).  That stage keeps one of repeated rows (same id and text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import line_dedup, lsh_forest, packing, pu_quality, winnow
from revlens.llm.common import id_crc, materialize, read_table, text_key


def _without(spark: SparkSession, docs: DataFrame, judged: DataFrame, gone) -> DataFrame:
    """Rows of ``docs`` but those whose id and text have a verdict to go; a null id is matched like any other.

    The keys that go are written first: Spark then knows their size and broadcasts them only if they are few."""
    keys = judged.where(gone).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    keys = materialize(spark, keys, "gone")
    return docs.join(keys, docs["doc_id"].eqNullSafe(keys["_id"]) & (text_key() == keys["_key"]), "left_anti")


def _one_of_repeated(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one of the rows that share id and text: the smallest by the other columns."""
    keys = docs.groupBy("doc_id", text_key().alias("_key")).agg(F.count("*").alias("rows")).where("rows > 1")
    keys = materialize(spark, keys.select(F.col("doc_id").alias("_id"), "_key"), "repeated")
    if keys.isEmpty():
        return docs
    same = docs["doc_id"].eqNullSafe(keys["_id"]) & (text_key() == keys["_key"])
    least = F.min(F.struct(*(c for c in docs.columns if c != "doc_id"))).alias("row")  # summed per task before it moves
    rest = docs.join(keys, same, "left_semi").groupBy("doc_id", text_key().alias("_key")).agg(least)
    return docs.join(keys, same, "left_anti").unionByName(rest.select("doc_id", "row.*").select(*docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more stay; each row by its own score, where it is read."""
    return pu_quality.keep_quality(spark, docs, read_table(spark, sf_dir, "labels"), id_crc() % 5 != 0, 0.3)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; the other columns stay, ``n_chars`` (if there is one) follows the text."""
    return line_dedup.with_kept_text(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group stays."""
    kept = _without(spark, docs, lsh_forest.near_duplicates(spark, docs.select("doc_id", "text"), keyed=True), ~F.col("kept"))
    return _one_of_repeated(spark, kept)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    got = winnow.decontaminate(spark, docs.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"), keyed=True)
    return _without(spark, docs, got, winnow.contaminated())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("line_dedup", repeated_lines), ("near_dedup", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

#: the learned, hashed and tokenised stages can't be written in SQL; see tests/llm/test_pipeline.py
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

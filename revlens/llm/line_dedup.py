"""Line deduplication with DataFrame functions only.

Each line has a key (blanks stripped at both ends, A-Z lower-cased) and a 128-bit
hash of it.  The hashes are range-partitioned by (hash, document), so a hash that a third of all lines share
spreads over many partitions, and sorted within partitions by (hash, document, position).  A row number over that order, which needs no
further shuffle, streams out the first occurrence of a hash in a document, and the first occurrences are counted per
hash after a partial count in each task.  Hashes found in at least ``min_docs``
documents lose all their lines.  The result holds no text: each document gets a
run-length compressed bitmap of the lines that stay, as an array of runs (first line, number of lines).
``apply_bitmap`` cuts the text by it.

Rows: a null or empty text is one empty line; keys shorter than ``min_chars`` never
go.  Documents are counted by doc_id (rows that share a doc_id, also a null one,
count once); each distinct (doc_id, text) has its own bitmap and repeated rows all get it.
An empty table gives no rows.  Only the named id and text columns are read; the
others stay as they are.  A column that is named like a result of ``drop_repeated_lines`` gives way to the result there;
``with_kept_text`` keeps all columns of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.common import materialize

#: fixed values: the stripped blanks (space, 0x09 to 0x0D) and the letters lower-cased
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUNS = "array<struct<first:int,lines:int>>"


def line_key(line: Column) -> Column:
    """Stripped line with A-Z lower-cased; ASCII lines take the quick ``lower``, others a letter map."""
    s = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(s) == F.char_length(s), F.lower(s)).otherwise(F.translate(s, UPPER, UPPER.lower()))


def keep_bitmaps(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``(id, text_key, n_lines, keep)`` for the distinct (id, text) that lose lines; ``keep`` is the bitmap in runs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.split(text, "\n", -1).alias("lines"))
    lines = src.select("id", "text_key", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    lines = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    lines = lines.select("id", "text_key", "n_lines", "pos", F.unhex(F.md5("key")).alias("hash"))
    lines = materialize(spark, lines, "lines")

    in_order = Window.partitionBy("hash", "id").orderBy("pos")
    ordered = lines.select("hash", "id", "pos").repartitionByRange("hash", "id")
    firsts = ordered.withColumn("nth", F.row_number().over(in_order)).where(F.col("nth") == 1)
    repeated = firsts.groupBy("hash").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs).select("hash")
    repeated = materialize(spark, repeated, "repeated")  # a plain table, so that a skewed join with it can be split

    gone = lines.join(repeated, "hash", "left_semi").select("id", "text_key", "n_lines", "pos").distinct()
    own = Window.partitionBy("id", "text_key").orderBy("pos")
    runs = (gone.withColumn("island", F.col("pos") - F.row_number().over(own))
            .groupBy("id", "text_key", "n_lines", "island").agg(F.min("pos").alias("first"), F.count("*").cast("int").alias("lines")))
    drop = runs.groupBy("id", "text_key", "n_lines").agg(F.array_sort(F.collect_list(F.struct("first", "lines"))).alias("drop"))
    starts = F.concat(F.array(F.lit(0)), F.transform("drop", lambda r: r["first"] + r["lines"]))
    ends = F.concat(F.transform("drop", lambda r: r["first"]), F.array("n_lines"))
    keep = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b - a).alias("lines")))
    return drop.select("id", "text_key", "n_lines", F.filter(keep, lambda r: r["lines"] > 0).cast(RUNS).alias("keep"))


def apply_bitmap(lines: Column, keep: Column) -> Column:
    """The kept lines of an array of lines, joined by a line break."""
    kept = F.flatten(F.transform(keep, lambda r: F.slice(lines, r["first"] + 1, r["lines"])))
    return F.array_join(kept, "\n")


def _cut(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int) -> DataFrame:
    """``row`` (all columns of ``docs``), n_lines, n_dropped, kept_text."""
    maps = keep_bitmaps(spark, docs, id_col, text_col, min_docs, min_chars).select("id", "text_key", "keep")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    rows = rows.withColumn("key", F.xxhash64(text))
    got = rows.join(maps.hint("shuffle_hash"), F.col("row")[id_col].eqNullSafe(maps["id"]) & (F.col("key") == maps["text_key"]), "left")
    split = F.split(text, "\n", -1)
    left = F.aggregate("keep", F.lit(0), lambda n, r: n + r["lines"])
    return got.select(
        "row", F.size(split).cast("long").alias("n_lines"),
        F.when(F.col("keep").isNull(), F.lit(0)).otherwise(F.size(split) - left).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), text).otherwise(apply_bitmap(split, F.col("keep"))).alias("kept_text"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """All columns of ``docs`` plus ``n_lines``, ``n_dropped`` and ``kept_text``."""
    own = ("n_lines", "n_dropped", "kept_text")
    got = _cut(spark, docs, id_col, text_col, min_docs, min_chars)
    return got.select(*(F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in own), *own)


def with_kept_text(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars",
                   min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The columns of ``docs``, the text without its repeated lines; a column ``length_col``, if there is one, follows the text."""
    got = _cut(spark, docs, id_col, text_col, min_docs, min_chars)
    fresh = {text_col: F.col("kept_text")}
    if length_col in docs.columns:
        fresh[length_col] = F.char_length("kept_text").cast(docs.schema[length_col].dataType)
    return got.select(*(fresh.get(c, F.col("row")[c]).alias(c) for c in docs.columns))

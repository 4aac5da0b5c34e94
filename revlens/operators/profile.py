"""Data profiling (EDA) as single-pass aggregations -- no sampling, no
``toPandas``: every number is computed over all rows on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.constants import LENGTH_BINS, LENGTH_CAP
from revlens.functions.labels import label_name
from revlens.functions.numeric import exact_stddev_sql, ratio_half_up
from revlens.functions.constants import MLLIB_ENGLISH_STOP_WORDS
from revlens.functions.text import clean_words, full_text
from revlens.operators.topk import top_k_per_group


def null_profile(df: DataFrame) -> DataFrame:
    """AG01: null count and share per column, one scan for all columns."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot(["_total"], cols, "column_name", "null_count")
    return long.select("column_name", "null_count", ratio_half_up("null_count", "_total", 100, 2).alias("null_pct"))


def duplicate_profile(df: DataFrame, col: str = "Text", approx: bool = False) -> DataFrame:
    """AG02: rows, distinct values of ``col``, duplicates and their share."""
    distinct = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    a = df.agg(F.count(F.lit(1)).alias("total"), distinct.cast("long").alias("distinct_values"))
    return a.select(
        "total",
        "distinct_values",
        (F.col("total") - F.col("distinct_values")).alias("duplicates"),
        ratio_half_up("total - distinct_values", "total", 100, 2).alias("duplicate_pct"),
    )


def class_distribution(df: DataFrame, label: Column) -> DataFrame:
    """AG03: rows per class with share.  The share's denominator is a window
    over the aggregated result, whose size is the number of classes."""
    g = df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("count"))
    g = g.withColumn("_total", F.sum("count").over(Window.partitionBy()))
    return g.select("label", label_name("label").alias("sentiment"), "count", ratio_half_up("count", "_total", 100, 1).alias("pct"))


def _len(text: str) -> Column:
    return F.length(F.col(text))


def text_length_summary(df: DataFrame, text: str = "Text") -> DataFrame:
    """AG04: count, mean, sample stddev, min, max of the text length.
    Moments are exact integers; stddev is derived from them."""
    L = _len(text)
    a = df.agg(
        F.count(L).alias("n"),
        F.sum(L).alias("sx"),
        F.sum(L.cast("decimal(38,0)") * L.cast("decimal(38,0)")).alias("sxx"),
        F.min(L).alias("min_length"),
        F.max(L).alias("max_length"),
    )
    return a.select(
        F.col("n").alias("count"),
        (F.col("sx") / F.col("n")).alias("mean_length"),
        F.expr(exact_stddev_sql("n", "sx", "sxx")).alias("stddev_length"),
        "min_length",
        "max_length",
    )


def text_length_by_class(df: DataFrame, label: Column, text: str = "Text") -> DataFrame:
    L = _len(text)
    g = df.groupBy(label.alias("label")).agg(F.count(L).alias("count"), F.sum(L).alias("_sx"))
    return g.select("label", "count", (F.col("_sx") / F.col("count")).alias("mean_length"))


def text_length_histogram(df: DataFrame, text: str = "Text", cap: int = LENGTH_CAP, bins: int = LENGTH_BINS) -> DataFrame:
    """AG05: equal-width histogram of min(length, cap) in integer arithmetic."""
    width = cap // bins
    c = F.least(_len(text), F.lit(cap))
    b = F.least(F.floor(c / F.lit(width)), F.lit(bins - 1)).cast("int")
    g = df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return g.select("bin", (F.col("bin") * width).alias("bin_lo"), ((F.col("bin") + 1) * width).alias("bin_hi"), "count")


def text_length_quartiles(df: DataFrame, label: Column, text: str = "Text", cap: int = LENGTH_CAP) -> DataFrame:
    """AG06: box-plot numbers per class on lengths clipped at ``cap``.

    Exact ``percentile`` keeps a value->count map per group; clipping bounds
    it to ``cap + 1`` entries, so a class holding a third of all rows costs
    the same memory as a small one."""
    c = F.least(_len(text), F.lit(cap))
    g = df.groupBy(label.alias("label")).agg(
        F.min(c).alias("min_length"),
        F.percentile(c, F.lit(0.25)).alias("q1"),
        F.percentile(c, F.lit(0.5)).alias("median"),
        F.percentile(c, F.lit(0.75)).alias("q3"),
        F.max(c).alias("max_length"),
    )
    return g


def words_by_class(df: DataFrame, label: Column, stop_words=None) -> DataFrame:
    """(label, word) rows: cleaned Summary+Text, tokens, MLlib stop words out."""
    words, kept = clean_words(full_text("Summary", "Text"), "word", MLLIB_ENGLISH_STOP_WORDS if stop_words is None else stop_words)
    return df.select(label.alias("label"), *words).where(kept)


def top_words_by_class(df: DataFrame, label: Column, k: int = 20) -> DataFrame:
    """AG08: the k most frequent words per class over all rows.

    Counting is a partial (map-side) hash aggregate on (label, word), so the
    shuffle carries one row per distinct word per task, and the per-class
    top-k is pre-limited on the map side (WindowGroupLimit)."""
    counts = words_by_class(df, label).groupBy("label", "word").agg(F.count(F.lit(1)).alias("count"))
    return top_k_per_group(counts, ["label"], [F.desc("count"), F.asc("word")], k)


def wordcloud_weights(df: DataFrame, label: Column, k: int = 150) -> DataFrame:
    """AG09: top-k words per class with weight = count / class maximum."""
    top = top_words_by_class(df, label, k)
    mx = F.max("count").over(Window.partitionBy("label"))
    return top.select("label", "word", "count", "rank", (F.col("count") / mx).alias("weight"))


def row_bytes_estimate(df: DataFrame) -> DataFrame:
    """AG07: size estimate as the summed length of each row's JSON form."""
    return df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns)))).alias("json_bytes"), F.count(F.lit(1)).alias("rows"))

"""Cleaning, filtering, de-duplication and splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revlens.functions.constants import MIN_TEXT_LENGTH
from revlens.functions.numeric import ratio_half_up
from revlens.functions.text import clean_text, full_text


def drop_null_rows(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def with_cleaned_text(df: DataFrame, summary: str = "Summary", text: str = "Text") -> DataFrame:
    return df.withColumn("cleaned_text", clean_text(full_text(summary, text)))


def min_length(df: DataFrame, n: int = MIN_TEXT_LENGTH, col: str = "cleaned_text") -> DataFrame:
    """FL03: keep rows whose cleaned text is strictly longer than ``n``."""
    return df.where(F.length(col) > n)


def cleaning_artifacts(df: DataFrame) -> DataFrame:
    """FL04: rows with tags / URLs before and after cleaning (after = 0)."""
    raw = full_text("Summary", "Text")
    cl = clean_text(raw)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(raw.contains("<")).alias("raw_with_tags"),
        F.count_if(raw.rlike("http|www")).alias("raw_with_urls"),
        F.count_if(cl.contains("<")).alias("clean_with_tags"),
        F.count_if(cl.rlike("http|www")).alias("clean_with_urls"),
    )


def dedup(df: DataFrame, key: str = "Text", keep_min: str = "Id") -> DataFrame:
    """SO01: one row per distinct ``key``, the survivor being the row with
    the smallest ``keep_min`` (deterministic, unlike dropDuplicates).

    ``min_by`` is a declarative aggregate with a map-side partial step, so a
    group of copies holding a third of the table collapses to one row per
    task before the shuffle."""
    others = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(keep_min)).alias("_r"))
    return g.select(*[F.col(f"_r.{c}").alias(c) if c != key else F.col(key) for c in df.columns])


def hash_bucket(key: str, salt: str = "") -> Column:
    """0..999 from the first 28 bits of md5(salt || key): stable under any
    partitioning and reproducible in SQL engines."""
    k = F.col(key).cast("string")
    if salt:
        k = F.concat(F.lit(salt), k)
    return F.conv(F.substring(F.md5(k), 1, 7), 16, 10).cast("long") % 1000


def assign_split(df: DataFrame, key: str = "Id", train: int = 800, val: int = 900, salt: str = "") -> DataFrame:
    """SO04: train / val / test by hash bucket (80/10/10 by default).

    Hashing is independent of the label, so each class is split in the same
    proportions in expectation, in one pass, with no per-class filters."""
    b = hash_bucket(key, salt)
    return df.withColumn("split", F.when(b < train, "train").when(b < val, "val").otherwise("test"))


def train_eval_split(df: DataFrame, key: str = "Id", train: int = 850, salt: str = "eval:") -> DataFrame:
    """SO05: 85/15 split with its own salt (independent of ``assign_split``)."""
    return df.withColumn("split", F.when(hash_bucket(key, salt) < train, "train").otherwise("eval"))


def split_report(df: DataFrame, label: str = "label", classes: int = 3) -> DataFrame:
    """AG27: size, share and class mix per split, one aggregation."""
    g = df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(label) == c).alias(f"_c{c}") for c in range(classes)]
    )
    g = g.withColumn("_total", F.sum("rows").over(Window.partitionBy()))
    return g.select(
        "split",
        "rows",
        ratio_half_up("rows", "_total", 100, 1).alias("share_pct"),
        *[ratio_half_up(f"_c{c}", "rows", 100, 1).alias(f"class{c}_pct") for c in range(classes)],
    )


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """AG26: count, share and balanced weight N / (K * count) per class.
    The result has one row per class; N and K come from a window over it."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()
    g = g.withColumn("_n", F.sum("count").over(w)).withColumn("_k", F.count(F.lit(1)).over(w))
    return g.select(
        F.col(label).alias("label"),
        "count",
        ratio_half_up("count", "_n", 100, 1).alias("pct"),
        (F.col("_n").cast("double") / (F.col("_k") * F.col("count")).cast("double")).alias("class_weight"),
    )


def with_class_weights(df: DataFrame, label: str = "label", max_classes: int = 1000) -> DataFrame:
    """PJ10: attach the balanced class weight to every row, as a CASE over the classes.

    The weights (one row per class) are read once; more than ``max_classes`` is an error, since a
    label column of unbounded cardinality holds no class labels.  Rows without a label drop out."""
    weights = class_weights(df, label).limit(max_classes + 1).collect()  # at most max_classes + 1 rows
    if len(weights) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    case = F.lit(None).cast("double")
    for w in weights:
        case = F.when(F.col(label) == w["label"], F.lit(w["class_weight"])).otherwise(case) if w["label"] is not None else case
    return df.where(F.col(label).isNotNull()).withColumn("class_weight", case)


def union_splits(*parts: DataFrame) -> DataFrame:
    """SO03: union by column name (train + val for the final refit)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stratified_sample_exact(df: DataFrame, label: str, key: str, percent: int, prefix: int = 3) -> DataFrame:
    """Exactly ``floor(n * percent / 100)`` rows of each class: those of the smallest ``(md5(key), key)``.

    A histogram of the hash's first ``prefix`` hex digits per class (at most ``16 ** prefix`` rows a class) says which hash ranges are
    in whole and which one holds the threshold; only the rows of that one range are ranked, so no window spans a class."""
    from pyspark.sql import Window

    h = F.md5(F.col(key).cast("string"))
    rows = df.withColumn("_hash", h).withColumn("_range", F.substring("_hash", 1, prefix))
    hist = rows.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    own = Window.partitionBy(label)
    before = F.sum("_n").over(own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    quota = F.floor(F.sum("_n").over(own) * percent / 100)
    hist = hist.select(F.col(label).alias("_label"), F.col("_range").alias("_r"), "_n", (quota - F.coalesce(before, F.lit(0))).alias("_left"))
    met = rows.join(hist.where("_left > 0"), rows[label].eqNullSafe(F.col("_label")) & (F.col("_range") == F.col("_r")))
    whole = met.where(F.col("_left") >= F.col("_n"))
    edge = met.where(F.col("_left") < F.col("_n"))
    rank = F.row_number().over(Window.partitionBy(label, "_range").orderBy("_hash", key))
    edge = edge.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_left"))
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))

"""Live-feed reads: keyset pagination, delivery de-duplication, search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.topk import top_k


def _ts(v):
    return F.lit(v).cast("timestamp_ntz") if isinstance(v, str) else F.lit(v)


def feed_page(df: DataFrame, after_ts, after_id: int, page_size: int = 10, ts: str = "processed_at", key: str = "Id") -> DataFrame:
    """Rows strictly after the cursor ``(after_ts, after_id)`` in
    ``(ts, key)`` order.  Ties on the timestamp are resolved by the key, so
    rows sharing a timestamp are neither skipped nor repeated across pages.
    The cursor predicate is pushed to the scan as a range filter."""
    t = _ts(after_ts)
    cond = (F.col(ts) > t) | ((F.col(ts) == t) & (F.col(key) > F.lit(after_id)))
    return top_k(df.where(cond), [F.asc(ts), F.asc(key)], page_size)


def next_cursor(page: DataFrame, ts: str = "processed_at", key: str = "Id") -> DataFrame:
    """The cursor after a page: its greatest (ts, key)."""
    return page.agg(F.max(F.struct(ts, key)).alias("c")).select(F.col(f"c.{ts}").alias(ts), F.col(f"c.{key}").alias(key))


def start_cursor(df: DataFrame, ts: str = "processed_at", key: str = "Id") -> DataFrame:
    """FL16: a cursor at the newest row (only rows arriving later are shown)."""
    return next_cursor(df, ts, key)


def feed_after(df: DataFrame, cursor: DataFrame, page_size: int = 50, ts: str = "processed_at", key: str = "Id") -> DataFrame:
    """FL16: the first ``page_size`` rows after a one-row cursor table, such as ``start_cursor`` gives at process start."""
    at, last = cursor.select(ts).scalar(), cursor.select(key).scalar()
    later = (F.col(ts) > at) | ((F.col(ts) == at) & (F.col(key) > last)) | at.isNull()
    return top_k(df.where(later), [F.asc(ts), F.asc(key)], page_size)


def dedup_deliveries(df: DataFrame, key: str = "Id", ts: str = "delivered_at") -> DataFrame:
    """SO07: one row per key with its first delivery time and delivery count."""
    return df.groupBy(key).agg(F.min(ts).alias("first_delivered_at"), F.count(F.lit(1)).alias("deliveries"))


def review_search(df: DataFrame, product_id=None, start=None, end=None, sentiment=None, limit: int = 20) -> DataFrame:
    """FL18: optional product / time range / sentiment filters, newest first."""
    q = df
    if product_id is not None:
        q = q.where(F.col("ProductId") == product_id)
    if start is not None:
        q = q.where(F.col("processed_at") >= _ts(start))
    if end is not None:
        q = q.where(F.col("processed_at") < _ts(end))
    if sentiment is not None:
        q = q.where(F.col("predicted_sentiment") == sentiment)
    q = q.select("Id", "ProductId", "Score", "predicted_sentiment", "processed_at")
    return top_k(q, [F.desc("processed_at"), F.desc("Id")], limit)


def parse_cursor(df: DataFrame, iso_col: str = "last_time", lookback: str = "5 minutes") -> DataFrame:
    """FN13: resume timestamp from an ISO string; unparseable or missing
    values fall back to ``now - lookback`` (session time zone UTC)."""
    t = F.try_to_timestamp(F.regexp_replace(F.col(iso_col), "Z$", ""))
    fallback = F.current_timestamp() - F.expr(f"INTERVAL {lookback}")
    return df.withColumn("cursor_ts", F.coalesce(t, fallback).cast("timestamp_ntz")).withColumn("cursor_parsed", t.isNotNull())

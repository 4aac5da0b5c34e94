"""Cumulative product metrics kept as streaming state and published in a keyed table.

The counts of every product live in Spark's state store (one row per product).  Each micro-batch emits the products it
changed, with their new totals (update mode), and upserts them.  The state, not the table, is what is added to, so a
batch that runs again after a failure writes the same totals again; a restart goes on from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revlens.operators.metrics import product_counts, product_metrics_from_counts
from revlens.streaming.keyed_table import KeyedTable

#: a scored review as the state needs it: no text
SCORED_EVENT = T.StructType([
    T.StructField("Id", T.IntegerType()), T.StructField("ProductId", T.StringType()), T.StructField("Score", T.IntegerType()),
    T.StructField("predicted_sentiment", T.StringType()), T.StructField("processed_at", T.TimestampNTZType())])

COUNTS = T.StructType(
    [T.StructField("ProductId", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("review_count", "positive_count", "negative_count", "neutral_count", "score_sum", "score_n")]
    + [T.StructField("last_updated", T.TimestampNTZType())])


def state_table(spark: SparkSession, path: str, buckets: int = 16) -> KeyedTable:
    return KeyedTable(spark, path, COUNTS, "ProductId", buckets)


def start_product_state(events: DataFrame, table: KeyedTable, checkpoint: str, available_now: bool = True, interval: str = "1 second"):
    """Start the query: ``events`` is a stream with the columns of ``SCORED_EVENT``; rows without a product are left out."""
    counts = product_counts(events.where(F.col("ProductId").isNotNull()))
    w = counts.writeStream.outputMode("update").foreachBatch(table.upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def product_metrics_now(table: KeyedTable) -> DataFrame:
    """Metrics of every product as of the last committed batch."""
    return product_metrics_from_counts(table.read())

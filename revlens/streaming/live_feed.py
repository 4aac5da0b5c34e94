"""The live feed: each review once, in spite of messages that arrive again, late or around a restart.

Messages carry their own time.  ``dropDuplicatesWithinWatermark`` keeps an Id in the state store for ``delay`` after its time, so
an Id that is delivered again within it is dropped, also by a query that was restarted in between, and the state is bounded by the Ids
of that span.  A message older than the watermark is not shown (it could be a repeat that the state has forgotten); such
messages are counted per run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.streaming.scoring import dedup_feed_stream

MESSAGE = "Id LONG, ProductId STRING, predicted_sentiment STRING, processed_at TIMESTAMP"
_RUNS = "run int, read long, unreadable long, late long"


def run_feed(spark: SparkSession, messages: DataFrame, out: str, checkpoint: str, run: int, delay: str) -> None:
    """Read what has arrived since the last run into ``out/feed`` and add the run's counts to ``out/runs``.

    ``messages`` is a stream with a JSON ``value``.  The file sink's own log makes a batch that runs again after a failure
    count once; the counts of a run replace those of an earlier try of the same run."""
    usable = F.col("Id").isNotNull() & F.col("processed_at").isNotNull()
    parsed = messages.select(F.from_json("value", MESSAGE).alias("m")).select("m.*")
    parsed = parsed.observe("arrived", F.count(F.lit(1)).alias("read"), F.count_if(~usable).alias("unreadable"))
    q = (dedup_feed_stream(parsed.where(usable), delay=delay).writeStream.format("parquet").option("path", f"{out}/feed")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    progress = q.recentProgress
    late = sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
    arrived = [p["observedMetrics"]["arrived"] for p in progress if "arrived" in p["observedMetrics"]]
    row = spark.createDataFrame([(run, sum(a["read"] for a in arrived), sum(a["unreadable"] for a in arrived), late)], _RUNS)
    row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(f"{out}/runs")


def feed(spark: SparkSession, out: str) -> DataFrame:
    """The reviews shown so far."""
    return spark.read.parquet(f"{out}/feed").withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz"))


def feed_counts(spark: SparkSession, out: str) -> DataFrame:
    """One row: messages read, reviews shown, repeats dropped, messages later than the watermark, unreadable ones."""
    runs = spark.read.schema(_RUNS).parquet(f"{out}/runs").agg(*(F.sum(c).alias(c) for c in ("read", "unreadable", "late")))
    shown = spark.read.parquet(f"{out}/feed").agg(F.count(F.lit(1))).scalar()
    repeated = F.col("read") - F.col("shown") - F.col("late") - F.col("unreadable")
    return runs.withColumn("shown", shown).select(F.col("read").alias("delivered"), "shown", repeated.alias("repeated"), "late", "unreadable")

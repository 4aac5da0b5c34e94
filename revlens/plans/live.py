"""Queries of the running application: product state, the live feed over restarts, feed cursors."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.operators.feed import feed_after, parse_cursor, start_cursor
from revlens.plans.oracle_base import rhu, with_fixtures
from revlens.plans.registry import register
from revlens.session import scratch_path
from revlens.sources.files import parse_messages, table, to_messages, write_messages_text
from revlens.sources.fixtures import review_facts
from revlens.streaming import live_feed as LF
from revlens.streaming import product_state as PS
from revlens.streaming.scoring import file_message_stream

FILES_PER_TRIGGER = 4


@register("stream_product_state", with_fixtures(
    f"""
WITH c AS (
  SELECT ProductId, count(*) AS review_count, count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_count,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_count,
         count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_count, max(processed_at) AS last_updated
  FROM reviews GROUP BY ProductId)
SELECT ProductId, review_count, positive_count, negative_count, neutral_count,
       {rhu('2 * positive_count + neutral_count', 'review_count', 1, 2)} AS avg_sentiment,
       {rhu('positive_count', 'review_count', 1, 2)} AS positive_ratio, {rhu('negative_count', 'review_count', 1, 2)} AS negative_ratio,
       {rhu('neutral_count', 'review_count', 1, 2)} AS neutral_ratio, last_updated
FROM c""", "reviews"), ("ST05", "SK03"))
def q_stream_product_state(spark, sf_dir):
    """Scored events in two legs: the query ends after the first, is started again from its checkpoint and goes on
    with what has arrived since; the keyed table then holds the totals of both."""
    src, ckpt = scratch_path(spark, "events-src"), scratch_path(spark, "stream-ckpt")
    events = to_messages(review_facts(spark, sf_dir).select(*PS.SCORED_EVENT.names))
    table_ = PS.state_table(spark, scratch_path(spark, "product-state"))
    for leg in range(2):
        write_messages_text(events.where(F.pmod(F.xxhash64("value"), F.lit(2)) == leg), src, mode="append")
        messages = file_message_stream(spark, src, FILES_PER_TRIGGER)
        q = PS.start_product_state(parse_messages(messages, PS.SCORED_EVENT).drop("value"), table_, ckpt)
        q.awaitTermination()
    return PS.product_metrics_now(table_)


# ------------------------------------------------------------------ live feed
#: days of events in one wave of deliveries (one run of the feed); how long a repeat is recognised
WAVE_DAYS, DELAY = 8, "10 days"
_SENTIMENT = "CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive' WHEN event_type = 'view' THEN 'neutral' ELSE 'negative' END"
#: deliveries of an event: (condition, wave); d is the day of the month from 0.  Early events come again, or for the first time, much too late.
_DELIVERIES = (
    ("NOT (event_id % 89 = 1 AND d < 5)", f"d DIV {WAVE_DAYS}"),
    ("event_id % 5 = 0 AND NOT (event_id % 89 = 1 AND d < 5)", f"least(3, d DIV {WAVE_DAYS} + event_id % 2)"),
    ("event_id % 97 = 0 AND d < 5", "3"),
    ("event_id % 89 = 1 AND d < 5", "3"),
)
_DAY_SQL = "CAST(day(ts) AS BIGINT) - 1"


def _run_feed(spark, sf_dir) -> str:
    """Four waves of deliveries, the feed stopped and started again between them; the folder of its results."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts"), (F.dayofmonth("ts").cast("long") - 1).alias("d"), F.get_json_object("props", "$.k").alias("k"))
    src, ckpt, out = scratch_path(spark, "feed-src"), scratch_path(spark, "stream-ckpt"), scratch_path(spark, "feed-out")
    sent = None
    for cond, wave in _DELIVERIES:
        part = e.where(cond).select(
            F.expr(wave).cast("int").alias("wave"), F.col("event_id").cast("long").alias("Id"), F.concat(F.lit("P"), "k").alias("ProductId"),
            F.expr(_SENTIMENT).alias("predicted_sentiment"), F.col("ts").alias("processed_at"))
        sent = part if sent is None else sent.unionByName(part)
    for run in range(4):
        wave = sent.where(F.col("wave") == run).drop("wave")
        to_messages(wave).write.mode("append").text(src)
        LF.run_feed(spark, file_message_stream(spark, src, 1000), out, ckpt, run, DELAY)
    return out


@register("live_feed", f"""
SELECT event_id AS Id, 'P' || json_extract_string(props, '$.k') AS ProductId, {_SENTIMENT} AS predicted_sentiment, ts AS processed_at
FROM events WHERE NOT (event_id % 89 = 1 AND {_DAY_SQL} < 5)""", ("ST08", "SO07"))
def q_live_feed(spark, sf_dir):
    """Every review that arrived in time, once, over re-delivered messages and four runs on one checkpoint."""
    return LF.feed(spark, _run_feed(spark, sf_dir)).select("Id", "ProductId", "predicted_sentiment", "processed_at")


@register("live_feed_counts", f"""
WITH e AS (SELECT event_id, {_DAY_SQL} AS d FROM events),
c AS (SELECT count(*) FILTER (WHERE NOT (event_id % 89 = 1 AND d < 5)) AS shown,
             count(*) FILTER (WHERE event_id % 5 = 0 AND NOT (event_id % 89 = 1 AND d < 5)) AS repeated,
             count(*) FILTER (WHERE event_id % 97 = 0 AND d < 5) + count(*) FILTER (WHERE event_id % 89 = 1 AND d < 5) AS late FROM e)
SELECT shown + repeated + late AS delivered, shown, repeated, late, CAST(0 AS BIGINT) AS unreadable FROM c""", ("ST08", "SO07"))
def q_live_feed_counts(spark, sf_dir):
    """Messages read, reviews shown, repeats dropped and messages later than the watermark."""
    return LF.feed_counts(spark, _run_feed(spark, sf_dir))


@register("feed_since_start", """
WITH e AS (SELECT event_id AS Id, ts AS processed_at, event_type FROM events),
c AS (SELECT max({'t': processed_at, 'i': Id}) AS m FROM e WHERE processed_at < TIMESTAMP '2024-01-17 00:00:00')
SELECT Id, processed_at, event_type FROM e, c WHERE m IS NULL OR processed_at > m.t OR (processed_at = m.t AND Id > m.i)
ORDER BY processed_at, Id LIMIT 50""", ("FL16", "TK12"))
def q_feed_since_start(spark, sf_dir):
    """A process that starts at noon of the fixture's month: its cursor is the newest row there is, and it shows only rows after it."""
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("Id"), F.col("ts").alias("processed_at"), "event_type")
    at_start = start_cursor(e.where(F.col("processed_at") < F.lit("2024-01-17 00:00:00").cast("timestamp_ntz")))
    return feed_after(e, at_start, 50)


_CURSOR = "CASE event_id % 4 WHEN 0 THEN {iso} || 'Z' WHEN 1 THEN {iso} WHEN 2 THEN 'not a time' END"


@register("cursor_parse", f"""
SELECT event_id AS Id, {_CURSOR.format(iso="strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')")} AS last_time, event_id % 4 < 2 AS cursor_parsed,
       CASE WHEN event_id % 4 < 2 THEN ts + INTERVAL 1 MICROSECOND END AS resume_at,
       event_id % 4 >= 2 AS fallback_is_recent
FROM events""", ("FN13",))
def q_cursor_parse(spark, sf_dir):
    """Resume times from ISO texts, one microsecond on; missing and unreadable ones fall back to five minutes ago."""
    iso = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("Id"), F.expr(_CURSOR.format(iso=iso)).alias("last_time"))
    got = parse_cursor(e, "last_time")
    age = F.current_timestamp().cast("timestamp_ntz") - F.col("cursor_ts")
    return got.select("Id", "last_time", "cursor_parsed",
                      F.when(F.col("cursor_parsed"), F.col("cursor_ts") + F.expr("INTERVAL 1 MICROSECOND")).alias("resume_at"),
                      (~F.col("cursor_parsed") & age.between(F.expr("INTERVAL 5 MINUTES"), F.expr("INTERVAL 6 MINUTES"))).alias("fallback_is_recent"))

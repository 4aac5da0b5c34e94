"""Product state and the live feed: restart, replay, bounded size, repeats and late messages."""

import glob
import json
import os

from pyspark.sql import functions as F

from revlens.operators.feed import feed_after, start_cursor
from revlens.operators.metrics import product_metrics
from revlens.session import local_path, scratch_path
from revlens.sources.files import parse_messages, to_messages
from revlens.sources.fixtures import reviews
from revlens.streaming import live_feed as LF
from revlens.streaming import product_state as PS
from revlens.streaming.keyed_table import KeyedTable
from revlens.streaming.scoring import file_message_stream

from .conftest import SF_SMALL


def _same(a, b):
    cols = [c for c in a.columns if c in b.columns]
    return a.select(cols).exceptAll(b.select(cols)).isEmpty() and b.select(cols).exceptAll(a.select(cols)).isEmpty()


def _leg(spark, src, table, ckpt):
    stream = parse_messages(file_message_stream(spark, src, 1), PS.SCORED_EVENT).drop("value")
    q = PS.start_product_state(stream, table, ckpt)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_state_goes_on_after_a_restart_and_a_replayed_batch_changes_nothing(spark):
    r = reviews(spark, SF_SMALL)
    events = to_messages(r.select(*PS.SCORED_EVENT.names))
    src, ckpt, path = (scratch_path(spark, f"t-{x}") for x in ("src", "ckpt", "state"))
    table = PS.state_table(spark, path, 4)
    events.where(F.pmod(F.xxhash64("value"), F.lit(2)) == 0).coalesce(3).write.text(src)
    _leg(spark, src, table, ckpt)
    half = PS.product_metrics_now(table).agg(F.sum("review_count")).first()[0]
    assert 0 < half < r.count()
    events.where(F.pmod(F.xxhash64("value"), F.lit(2)) == 1).coalesce(3).write.mode("append").text(src)
    _leg(spark, src, table, ckpt)
    assert _same(PS.product_metrics_now(table), product_metrics(r))
    # nothing new: a third start changes nothing
    _leg(spark, src, table, ckpt)
    assert _same(PS.product_metrics_now(table), product_metrics(r))
    # at most two versions of a product in the files, whatever the number of batches
    stored = spark.read.parquet(f"{path}/rows").groupBy("ProductId").count()
    assert stored.agg(F.max("count")).first()[0] <= 2
    assert len(glob.glob(os.path.join(local_path(path), "rows/bucket=*/slot=*/*.parquet"))) <= 8


def test_a_batch_written_but_not_committed_is_not_seen_and_is_done_again(spark):
    path = scratch_path(spark, "t-keyed")
    t = KeyedTable(spark, path, spark.createDataFrame([], "k string, n long").schema, "k", 4)
    rows = lambda d: spark.createDataFrame(list(d.items()), "k string, n long")
    got = lambda: {r.k: r.n for r in t.read().collect()}
    assert got() == {} and t.lookup("a").isEmpty()
    t.upsert(rows({"a": 1, "b": 2, None: 9}), 0)
    t.upsert(rows({"a": 5, "c": 3}), 1)
    assert got() == {"a": 5, "b": 2, "c": 3, None: 9}
    # batch 2 wrote its rows but crashed before its commit
    log = local_path(f"{path}/log/batch_id=2")
    t.upsert(rows({"a": 6, "d": 4}), 2)
    os.rename(log, f"{log}.lost")
    os.rename(f"{log}.lost", local_path(f"{path}/_lost"))
    spark.catalog.refreshByPath(f"{path}/log")
    assert got() == {"a": 5, "b": 2, "c": 3, None: 9}
    t.upsert(rows({"a": 6, "d": 4}), 2)
    t.upsert(rows({"a": 6, "d": 4}), 2)  # and once more
    assert got() == {"a": 6, "b": 2, "c": 3, "d": 4, None: 9}
    assert [tuple(r) for r in t.lookup("d").collect()] == [("d", 4)] and t.lookup("zz").isEmpty()
    t.upsert(rows({}), 3)
    assert got()["d"] == 4


def test_feed_shows_each_review_once_over_restarts(spark):
    src, ckpt, out = (scratch_path(spark, f"t-{x}") for x in ("src", "ckpt", "out"))

    def send(run, *msgs):
        rows = [(json.dumps({"Id": i, "ProductId": "P", "predicted_sentiment": "neutral", "processed_at": f"2024-01-{day:02d}T00:00:00"}),) for i, day in msgs]
        spark.createDataFrame(rows + [("{bad",)], "value string").coalesce(1).write.mode("append").text(src)
        LF.run_feed(spark, file_message_stream(spark, src, 10), out, ckpt, run, "10 days")

    send(0, (1, 1), (2, 2), (1, 1))
    send(1, (2, 2), (3, 12))
    send(2, (3, 12), (4, 25))
    send(3, (1, 1), (5, 3), (4, 25), (6, 26))  # 1 and 5 are older than the watermark
    assert sorted(r.Id for r in LF.feed(spark, out).collect()) == [1, 2, 3, 4, 6]
    c = LF.feed_counts(spark, out).first()
    assert (c.delivered, c.shown, c.repeated, c.late, c.unreadable) == (15, 5, 4, 2, 4)


def test_feed_from_process_start(spark):
    rows = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12)], "Id int, processed_at int")
    start = start_cursor(rows.where("processed_at <= 10 and Id = 1"))
    assert [r.Id for r in feed_after(rows, start, 10).collect()] == [2, 3, 4]
    assert [r.Id for r in feed_after(rows, start_cursor(rows), 10).collect()] == []
    assert [r.Id for r in feed_after(rows, start_cursor(rows.where("false")), 2).collect()] == [1, 2]

"""Keyset pagination and delivery de-duplication."""

from datetime import datetime

from revlens.operators.feed import dedup_deliveries, feed_page, next_cursor


def test_equal_timestamps_all_delivered_once(spark):
    t = datetime(2024, 1, 1, 12, 0, 0)
    df = spark.createDataFrame([(1, t), (2, t), (3, t), (4, datetime(2024, 1, 1, 12, 0, 1))], "Id int, processed_at timestamp_ntz")
    seen, cur = [], (datetime(2000, 1, 1), 0)
    for _ in range(5):
        page = feed_page(df, cur[0], cur[1], page_size=2)
        got = [r.Id for r in page.collect()]
        if not got:
            break
        seen += got
        c = next_cursor(page).collect()[0]
        cur = (c.processed_at, c.Id)
    assert seen == [1, 2, 3, 4]


def test_dedup_deliveries(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, t2), (1, t1), (2, t1)], "Id int, delivered_at timestamp_ntz")
    got = sorted((r.Id, r.first_delivered_at, r.deliveries) for r in dedup_deliveries(df).collect())
    assert got == [(1, t1, 2), (2, t1, 1)]


def test_parse_cursor(spark):
    from revlens.operators.feed import parse_cursor

    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("garbage",), (None,)], "last_time string")
    got = [r.cursor_ts for r in parse_cursor(df).collect()]
    assert got[0] == datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] is not None and got[2] is not None and got[1] > datetime(2024, 6, 1)

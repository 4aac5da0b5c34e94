"""CSV with multi-line quoted fields, JSON messages round trip."""

from revlens.session import scratch_path
from revlens.sources.files import csv_to_parquet, parse_messages, to_messages, write_review_csv
from revlens.sources.schemas import RAW_COLUMNS, RAW_REVIEW


def test_csv_roundtrip_multiline_quotes(spark):
    data = [
        (1, "P1", "U1", "Ann", 1, 2, 5, 1300000000, "Great", 'He said "wow"\nsecond line, with comma'),
        (2, "P2", "U2", None, 0, 0, 1, 1300000001, None, "plain"),
    ]
    df = spark.createDataFrame(data, RAW_REVIEW)
    csv = scratch_path(spark, "csv")
    write_review_csv(df, csv)
    back = csv_to_parquet(spark, csv, scratch_path(spark, "csv-pq"))
    assert sorted(map(tuple, back.collect())) == sorted(data)


def test_json_messages_roundtrip(spark):
    data = [(1, "P1", "U1", None, 1, 2, 5, 1300000000, None, 'q "x"\n')]
    df = spark.createDataFrame(data, RAW_REVIEW)
    back = parse_messages(to_messages(df), RAW_REVIEW).select(*RAW_COLUMNS)
    assert [tuple(r) for r in back.collect()] == data


def test_messages_and_csv_lie_in_compressed_files_of_bounded_size(spark, monkeypatch):
    import glob
    import gzip

    from revlens.session import local_path, scratch_path
    from revlens.sources import files as FS
    from revlens.sources.schemas import RAW_REVIEW

    monkeypatch.setattr(FS, "MESSAGES_PER_FILE", 40)
    monkeypatch.setattr(FS, "ROWS_PER_CSV", 30)
    rows = spark.range(100).selectExpr("CAST(id AS INT) AS Id", "'P1' AS ProductId", "'U' AS UserId", "CAST(null AS STRING) AS ProfileName",
                                       "1 AS HelpfulnessNumerator", "2 AS HelpfulnessDenominator", "5 AS Score", "id AS Time",
                                       "'a \"quoted\" title' AS Summary", "repeat('line one,\nline two ', 200) AS Text").coalesce(1)
    path = scratch_path(spark, "t-messages")
    FS.write_messages_text(FS.to_messages(rows), path)
    found = glob.glob(f"{local_path(path)}/part-*")
    sizes = [len(gzip.open(f).read().splitlines()) for f in found]
    assert sorted(sizes) == [20, 40, 40]
    got = FS.parse_messages(spark.read.text(path), RAW_REVIEW).drop("value")
    assert got.exceptAll(rows).isEmpty() and got.count() == 100
    csv = scratch_path(spark, "t-csv")
    FS.write_review_csv(rows, csv)
    assert len(glob.glob(f"{local_path(csv)}/part-*.gz")) == 4
    back = FS.csv_to_parquet(spark, csv, scratch_path(spark, "t-csv-parquet"))
    assert back.count() == 100 and back.exceptAll(rows).isEmpty()

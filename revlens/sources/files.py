"""File, message and table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.sources.schemas import RAW_REVIEW
from revlens.session import table_path

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def source_version(spark: SparkSession, sf_dir: str, *names: str) -> tuple:
    """What the files of these tables are now: (files, bytes, newest change, hash of the listing).

    Read from the listing alone (no file is opened), as one aggregate over all of them, so that a fitted model or a published table kept
    for an application is never used for other files than those it was made from."""
    files = spark.read.format("binaryFile").load([table_path(sf_dir, n) for n in names])
    listing = F.bit_xor(F.xxhash64("path", "modificationTime", "length"))
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"), listing).collect()[0])


def read_review_csv(spark: SparkSession, path: str, schema=RAW_REVIEW) -> DataFrame:
    """Review CSV with quoted multi-line fields, compressed or not.

    ``multiLine`` makes each file a single split, so convert once to Parquet
    (``csv_to_parquet``) and read that everywhere else.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


#: rows in one CSV file
ROWS_PER_CSV = 250_000


def csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str, schema=RAW_REVIEW) -> DataFrame:
    read_review_csv(spark, csv_path, schema).write.mode("overwrite").option("compression", "zstd").parquet(out_path)
    return spark.read.parquet(out_path)


def write_review_csv(df: DataFrame, path: str) -> None:
    """Compressed CSV, at most ``ROWS_PER_CSV`` rows a file: a reader's task is one file, since neither gzip nor quoted lines split."""
    (df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_CSV).option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def to_messages(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Encode rows as one JSON object per row in a ``value`` column (nulls kept)."""
    cols = columns or df.columns
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    options = {"ignoreNullFields": "false", "timestampFormat": f"{micros}XXX", "timestampNTZFormat": micros}
    return df.select(F.to_json(F.struct(*cols), options).alias("value"))


def parse_messages(messages: DataFrame, schema=RAW_REVIEW) -> DataFrame:
    """Decode a ``value`` column with a fixed schema and flatten it.

    Malformed JSON becomes an all-null row (PERMISSIVE); callers route those
    to a reject table via ``split_rejects``.
    """
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data"), F.col("value")).select(
        "data.*", "value"
    )


def kafka_source_options(bootstrap: str, topic: str, starting: str = "earliest") -> dict:
    """Options for ``spark.readStream.format('kafka')`` (connector jar required)."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }


def write_messages_kafka(messages: DataFrame, bootstrap: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()


#: messages in one file of the offline topic: a micro-batch of files stays as large as it is, whatever a task of the writer holds
MESSAGES_PER_FILE = 100_000


def write_messages_text(messages: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Offline stand-in for the topic: compressed JSON lines, optionally dealt to ``files`` tasks, at most ``MESSAGES_PER_FILE`` a file.

    They are read once: gzip's fastest level is given some more disk for less than half of its time."""
    out = messages.repartition(files) if files else messages
    out.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", MESSAGES_PER_FILE).text(path)

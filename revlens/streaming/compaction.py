"""File-size control of the stream's sink tables: closed batches are rewritten into few files, beside their readers.

A generation holds the rows of all batches up to one batch in files of at most ``max_records`` rows.  Its entry in the
manifest is written last: until then, and if the job is interrupted, readers go on with the generation before it.  Batch
partitions are never touched, so a reader that has begun keeps its files; what a generation has replaced may be removed when no reader is that old.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "upto long, generation int"


def _newest(spark: SparkSession, out: str, name: str) -> tuple[int, int]:
    """(generation, last batch in it); (-1, -1) without any."""
    spark.createDataFrame([], _MANIFEST).write.mode("append").partitionBy("generation").parquet(f"{out}/{name}_manifest")
    row = spark.read.schema(_MANIFEST).parquet(f"{out}/{name}_manifest").agg(F.max(F.struct("generation", "upto")).alias("m")).first().m
    return (row.generation, row.upto) if row else (-1, -1)


def current(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The rows of sink ``name``: its newest generation and the batches after it."""
    batches = spark.read.parquet(f"{out}/{name}")
    generation, upto = _newest(spark, out, name)
    if generation < 0:
        return batches
    packed = spark.read.schema(batches.schema).parquet(f"{out}/{name}_packed/generation={generation}")
    return packed.unionByName(batches.where(F.col("batch_id") > upto))


def compact(spark: SparkSession, out: str, name: str, upto: int, max_records: int = 1_000_000) -> int:
    """Pack the batches up to ``upto`` (closed ones) into files of at most ``max_records`` rows; the number of the generation."""
    generation, packed = _newest(spark, out, name)
    if upto <= packed:
        return generation
    rows = current(spark, out, name).where(F.col("batch_id") <= upto)
    files = max(1, -(-rows.count() // max_records))
    # the scan's partitions, even by size, are put together without a shuffle, so packing needs no room but its output's;
    # rows of a batch's file stay together, so that filters on batch_id skip row groups
    rows = rows.coalesce(files)
    rows.write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", "zstd").parquet(f"{out}/{name}_packed/generation={generation + 1}")
    entry = spark.createDataFrame([(upto, generation + 1)], _MANIFEST).coalesce(1)
    entry.write.mode("append").partitionBy("generation").parquet(f"{out}/{name}_manifest")
    return generation + 1

"""A table with one row per key that micro-batches upsert: file-based, replay-safe, bounded by the number of keys.

Rows lie in ``rows/bucket=B/slot=S``: a bucket is a hash range of the key, and each bucket has two slots, of which the
newest commit names the valid one.  An upsert merges the changed keys into the buckets they touch, writes these into
the other slot of each, and then commits the new bucket-to-slot map in ``log/batch_id=N``.  So

* a reader sees the state of a commit, never half a batch;
* a batch that is replayed starts from the commit before it, whatever it had written, and gives the same table;
* files hold at most two versions of a key, however many batches there were;
* a lookup by key opens one bucket.

The log keeps one small map per batch.  One writer at a time (a streaming query); a reader that takes longer than two batches that touch the
same bucket must read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

_LOG = "bucket int, slot int, batch_id long"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = 16):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType([f for f in schema.fields if f.name not in ("bucket", "slot")])
        self._stored = T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType()), T.StructField("slot", T.IntegerType())])
        for name, kind, parts in (("rows", self._stored, ["bucket", "slot"]), ("log", _LOG, ["batch_id"])):
            spark.createDataFrame([], kind).write.mode("append").partitionBy(*parts).parquet(f"{self.path}/{name}")

    def _bucket(self, col):
        return F.pmod(F.xxhash64(col), F.lit(self.buckets)).cast("int")

    def _slots(self, before: int | None = None) -> dict[int, int]:
        """Valid slot of every bucket (at most ``buckets`` entries) as of the newest commit, or of the newest below ``before``."""
        log = self.spark.read.schema(_LOG).parquet(f"{self.path}/log")
        if before is not None:
            log = log.where(F.col("batch_id") < before)
        newest = log.agg(F.max("batch_id")).first()[0]
        return {} if newest is None else {r.bucket: r.slot for r in log.where(F.col("batch_id") == newest).collect()}

    def _rows(self, slots: dict[int, int]) -> DataFrame:
        stored = self.spark.read.schema(self._stored).parquet(f"{self.path}/rows")
        by_slot = [[b for b, s in slots.items() if s == k] for k in (0, 1)]
        valid = ((F.col("slot") == 0) & F.col("bucket").isin(by_slot[0])) | ((F.col("slot") == 1) & F.col("bucket").isin(by_slot[1]))
        return stored.where(valid)  # a partition filter

    def read(self) -> DataFrame:
        """The rows of the newest commit."""
        return self._rows(self._slots()).select(*self.schema.names)

    def lookup(self, value) -> DataFrame:
        """The row of one key, from its bucket alone."""
        bucket = self.spark.range(1).select(self._bucket(F.lit(value).cast(self.schema[self.key].dataType))).first()[0]
        slots = {b: s for b, s in self._slots().items() if b == bucket}
        return self._rows(slots).where(F.col(self.key).eqNullSafe(F.lit(value))).select(*self.schema.names)

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        """Set the rows of ``changes`` (one per key) as batch ``batch_id``; the rows of other keys stay."""
        changes = changes.select(*self.schema.names).withColumn("bucket", self._bucket(F.col(self.key))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r.bucket for r in changes.select("bucket").distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            slots = self._slots(before=batch_id)
            old = self._rows({b: s for b, s in slots.items() if b in set(touched)}).drop("slot")
            new = changes.select(F.col(self.key).alias("_new"))
            kept = old.join(new, old[self.key].eqNullSafe(new["_new"]), "left_anti")
            slots |= {b: 1 - slots.get(b, 1) for b in touched}
            slot = F.element_at(F.create_map(*(F.lit(x) for b in touched for x in (b, slots[b]))), F.col("bucket"))
            merged = kept.select(*self.schema.names, "bucket").unionByName(changes).withColumn("slot", slot)
            # one task per bucket: a bucket is written as one file
            (merged.repartition(min(len(touched), self.buckets), "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "slot").parquet(f"{self.path}/rows"))
        finally:
            changes.unpersist()
        commit = self.spark.createDataFrame([(b, s, batch_id) for b, s in sorted(slots.items())], _LOG)
        (commit.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
         .parquet(f"{self.path}/log"))

"""The published review table: the scored reviews as the dashboards and keyed lookups read them.

``publish_reviews`` is an explicit job.  It writes the lazy facts (``fixtures.facts_view``: every column but the texts,
which stay in ``documents``) once as a table
bucketed and sorted by product, and ``bench.py`` counts its time in the total.  ``published_facts`` publishes
again as soon as the listing of a source file differs (name, size or time of change), so a reader never
sees rows of other files than the present ones.  Many reviews may carry one document: stored with its text, the table would be
as many times larger than the documents, so readers of texts join them (``fixtures.with_texts``).

Two ways to read it:

* ``published_facts`` -- the files as plain Parquet, split by size, for scans, counts and text work.
* ``keyed_reviews`` -- the bucketed table.  An equality on ProductId opens one bucket's files, and a join or
  a grouping on ProductId needs no shuffle.

A product with more than a bucket's fair share of the rows is dealt over several files of its bucket by a second key (a
hash of the Id), so writing it takes several tasks, and so does a lookup, which reads files and not whole buckets.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import scratch_path
from revlens.sources.files import source_version

SOURCES = ("orders", "lineitem", "customer", "documents")
_PUBLISHED: dict = {}
_LOCK = threading.RLock()


def hot_products(rows: DataFrame, buckets: int, key: str = "ProductId") -> DataFrame:
    """``(key, spread)`` of the keys with more than ``1 / buckets`` of all rows: fewer than ``buckets`` rows."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    spread = F.ceil(F.col("n") * buckets / total).cast("int")
    return counts.withColumn("spread", spread).where("spread > 1").select(key, "spread")


def write_bucketed(rows: DataFrame, path: str, name: str, buckets: int, key: str = "ProductId", second: str = "Id",
                   sort: tuple[str, ...] = ("processed_at", "Id")) -> DataFrame:
    """Write ``rows`` at ``path`` as table ``name``, bucketed by ``key`` and sorted by ``(key, *sort)``.

    One task writes each (bucket, salt) pair, so there are about as many files as buckets, and more only for
    hot keys.  Rows with a null key have a bucket like any other."""
    spark = rows.sparkSession
    salt = F.pmod(F.xxhash64(second), F.coalesce("spread", F.lit(1)))
    dealt = (rows.join(F.broadcast(hot_products(rows, buckets, key)), key, "left")
             .withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).withColumn("_salt", salt)
             .repartition(buckets, "_bucket", "_salt").drop("_bucket", "_salt", "spread"))
    (dealt.select(*rows.columns).write.bucketBy(buckets, key).sortBy(key, *sort)
     .format("parquet").option("path", path).saveAsTable(name))
    return spark.table(name)


def publish_reviews(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[str, str]:
    """Write the review table under the shared checkpoint folder; ``(path, table name)``.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``, the number by which the cluster sizes its partitions."""
    from revlens.sources.fixtures import facts_view

    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch_path(spark, "reviews"), f"reviews_{uuid.uuid4().hex}"
    write_bucketed(facts_view(spark, sf_dir), path, name, buckets)
    return path, name


def _present(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    with _LOCK:
        place, version = (sf_dir, spark.sparkContext.applicationId), source_version(spark, sf_dir, *SOURCES)
        if _PUBLISHED.get(place, (None,))[0] != version:
            _PUBLISHED[place] = (version, publish_reviews(spark, sf_dir))
        return _PUBLISHED[place][1]


def published_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published facts as plain files, with the columns by which texts join."""
    path, name = _present(spark, sf_dir)
    return spark.read.schema(spark.table(name).schema).parquet(path)


def keyed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published reviews, but for their texts, as a table bucketed by ProductId."""
    from revlens.sources.fixtures import FACT_COLUMNS

    return spark.table(_present(spark, sf_dir)[1]).select(*FACT_COLUMNS)


def product_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of every product, bucketed like the reviews: a keyed read opens one bucket, a join with them needs no shuffle."""
    from revlens.operators.metrics import product_metrics

    with _LOCK:
        path, name = _present(spark, sf_dir)
        if f"{name}_products" not in _PUBLISHED:
            r = spark.table(name)
            buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first().data_type)
            metrics = product_metrics(r)
            write_bucketed(metrics, scratch_path(spark, "products"), f"{name}_products", buckets, second="ProductId", sort=())
            _PUBLISHED[f"{name}_products"] = True
    return spark.table(f"{name}_products")

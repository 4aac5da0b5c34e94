"""The published review table: bucket pruning, shuffle-free joins, hot products, text work in several tasks."""

import glob
import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from revlens.session import local_path, scratch_path
from revlens.sources.fixtures import review_facts, reviews, reviews_view
from revlens.sources.review_store import hot_products, published_facts, write_bucketed

from .conftest import SF_SMALL


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_published_rows_are_those_of_the_view(spark):
    a, b = reviews(spark, SF_SMALL), reviews_view(spark, SF_SMALL)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_a_lookup_reads_one_bucket(spark):
    from revlens.sources.review_store import keyed_reviews

    df = E.queries()["product_lookup"](spark, SF_SMALL)
    plan = _plan(df)
    assert "EqualTo(ProductId,P0007)" in plan
    one = keyed_reviews(spark, SF_SMALL).where("ProductId = 'P0007'")
    read = one.select(F.input_file_name().alias("f")).distinct().collect()
    assert len(read) <= 1
    rows = one.select("Id")  # the scan opens that bucket's files only
    scan = rows._jdf.queryExecution().toRdd()
    assert scan.getNumPartitions() <= 1


def test_keyed_join_has_no_shuffle(spark):
    plan = _plan(E.queries()["review_product_context"](spark, SF_SMALL))
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_a_hot_product_spreads_over_files_of_its_bucket(spark):
    n = 3000
    rows = spark.range(n).select(
        F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("P"), (F.col("id") % 40).cast("string"))).alias("ProductId"), F.col("id").alias("processed_at"))
    assert {r.ProductId for r in hot_products(rows, 16).collect()} == {"HOT"}
    path = scratch_path(spark, "hot")
    got = write_bucketed(rows, path, "hot_reviews_test", 16)
    assert got.count() == n and got.where("ProductId is null").count() == rows.where("ProductId is null").count()
    files = got.where("ProductId = 'HOT'").select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) >= 3 and len({f.f.rsplit("_", 1)[1][:5] for f in files}) == 1  # several files, one bucket
    assert len(glob.glob(os.path.join(local_path(path), "*.parquet"))) <= 16 + 8


def test_text_work_has_several_tasks(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    v = reviews_view(spark, SF_SMALL).select("Id", "Text")
    spread = v.groupBy(F.spark_partition_id().alias("p")).count()
    assert spread.count() >= n // 2


def test_empty_and_keyless_rows(spark):
    rows = spark.createDataFrame([], "Id int, ProductId string, processed_at timestamp_ntz")
    assert write_bucketed(rows, scratch_path(spark, "none"), "no_reviews_test", 4).count() == 0


def _tables(spark, d, texts):
    """60 orders over documents of which ids repeat, are null and are missing; every third order has no line."""
    spark.range(1, 61).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey", "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate").write.parquet(f"{d}/orders.parquet")
    spark.range(1, 181).selectExpr("id % 60 + 1 AS l_orderkey", "id AS l_partkey", "'N' AS l_returnflag").where("l_orderkey % 3 > 0").write.parquet(
        f"{d}/lineitem.parquet")
    spark.range(1, 5).selectExpr("id AS c_custkey", "concat('c', id) AS c_name").write.parquet(f"{d}/customer.parquet")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")


def test_texts_are_not_stored_with_the_reviews_and_join_by_every_repeated_id(spark, tmp_path):
    texts = [(0, "a" * 50), (1, "b"), (1, "b"), (1, "c"), (2, None), (3, ""), (None, "z"), (4, "d e"), (17, "far")]
    _tables(spark, tmp_path, texts)
    want = [(o, t and t[:40] if o % 13 else None, t) for o in range(1, 61) if o % 3 for k, t in texts if k == o % len(texts)]
    d = str(tmp_path)
    got = reviews(spark, d)
    key = lambda r: (r[0], r[2] or "", r[2] is None)
    assert sorted(map(tuple, got.select("Id", "Summary", "Text").collect()), key=key) == sorted(want, key=key)
    facts = review_facts(spark, d)
    assert sorted(r.Id for r in facts.select("Id").collect()) == sorted(w[0] for w in want)
    assert E.queries()["kpis"](spark, d).first().total == len(want)
    assert not {"Text", "Summary"} & set(published_facts(spark, d).columns)
    for name in ("distinct_labels", "confusion_matrix", "batch_accuracy", "insights", "product_trend", "confidence_band"):
        assert "documents" not in _plan(E.queries()[name](spark, d)), name


def test_text_work_has_its_tasks_where_documents_are_one_file_larger_than_the_facts(spark, tmp_path):
    import random

    draw = random.Random(1)
    _tables(spark, tmp_path, [(0, "x")])
    texts = spark.createDataFrame([(k, draw.randbytes(120_000).hex()) for k in range(60)], "doc_id long, text string").coalesce(1)
    texts.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")  # over 10 MB
    rows = reviews(spark, str(tmp_path)).select("Id", F.length("Text").alias("n"))
    got = rows.select("*", F.spark_partition_id().alias("p")).collect()
    assert len(got) == 40 and {r.n for r in got} == {240_000}
    assert len({r.p for r in got}) >= 4

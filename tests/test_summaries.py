"""Mergeable summaries, exact stratified samples, compaction of sinks, fits at the same time."""

import glob
import os

from pyspark.sql import functions as F

from revlens.ml import features as FE
from revlens.ml import models as MO
from revlens.operators import sketches as SK
from revlens.operators.prep import stratified_sample_exact, with_class_weights
from revlens.session import local_path, scratch_path
from revlens.streaming.compaction import compact, current


def test_merged_sketches_stay_within_their_bounds(spark):
    rows = spark.range(60_000).select((F.col("id") % 9000).alias("u"), (F.col("id") % 7).alias("b"), (F.col("id") * 7919 % 100_003).alias("v"), (F.col("id") % 2).alias("k"))
    s = SK.batch_summaries(rows, "b", {"users": "u"})
    assert s.count() == 7 and s.agg(F.sum("rows")).first()[0] == 60_000
    assert abs(SK.distinct_estimates(s, ["users"]).first()[0] - 9000) <= 450
    per = rows.groupBy("b", "k").agg(F.kll_sketch_agg_bigint("v", F.lit(SK.KLL_K)).alias("kll"))
    est = SK.merged_quantiles(per, ["k"], (0.01, 0.5, 0.99))
    errors = SK.rank_errors(rows, "v", est, ["k"]).collect()
    assert len(errors) == 6 and max(r.rank_error for r in errors) <= 0.03


def test_rank_error_of_equal_values_is_zero_only_among_them(spark):
    rows = spark.createDataFrame([(0, 1)] * 9 + [(0, 5)], "k int, v int")
    est = spark.createDataFrame([(0, 0.5, 1), (0, 0.95, 1), (0, 0.95, 5)], "k int, rank double, estimate long")
    got = {(r.rank, r.estimate): round(r.rank_error, 6) for r in SK.rank_errors(rows, "v", est, ["k"]).collect()}
    assert got == {(0.5, 1): 0.0, (0.95, 1): 0.05, (0.95, 5): 0.0}


def test_stratified_sample_is_exact_and_the_same_at_every_partitioning(spark):
    rows = spark.range(2000).select(F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(1).alias("label"))
    for prefix in (1, 3):
        a = {r.Id for r in stratified_sample_exact(rows, "label", "Id", 15, prefix).collect()}
        assert a == {r.Id for r in stratified_sample_exact(rows.repartition(7), "label", "Id", 15, prefix).collect()}
        sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
        got = {r.label: r["count"] for r in rows.where(F.col("Id").isin(*a)).groupBy("label").count().collect()}
        assert got == {k: n * 15 // 100 for k, n in sizes.items() if n * 15 // 100}
    assert stratified_sample_exact(rows.limit(0), "label", "Id", 15).isEmpty()
    assert stratified_sample_exact(rows, "label", "Id", 100).count() == 2000


def test_compaction_bounds_files_and_survives_an_interruption(spark):
    out = scratch_path(spark, "t-sink")
    rows = spark.range(900).select(F.col("id").alias("Id"), (F.col("id") % 30).alias("batch_id"))
    rows.repartition(6).write.partitionBy("batch_id").parquet(f"{out}/reviews")
    ids = lambda: sorted((r.Id, r.batch_id) for r in current(spark, out, "reviews").collect())
    want = sorted((r.Id, r.batch_id) for r in rows.collect())
    assert ids() == want
    before = current(spark, out, "reviews")
    assert compact(spark, out, "reviews", 20, 200) == 0
    files = glob.glob(os.path.join(local_path(out), "reviews_packed/generation=0/*.parquet"))
    assert 4 <= len(files) <= 7 and len(files) < 20  # 630 rows, at most 200 a file
    assert ids() == want and before.count() == 900  # a reader that began before goes on
    # the next generation was written in part and never entered
    rows.limit(10).write.parquet(f"{out}/reviews_packed/generation=1")
    assert ids() == want
    assert compact(spark, out, "reviews", 28, 500) == 1 and ids() == want
    assert compact(spark, out, "reviews", 28) == 1


def test_fits_overlap_and_choose_as_the_loop_does(spark):
    rows = spark.range(240).select(F.col("id").alias("Id"), F.concat(F.element_at(F.array(F.lit("awful stale hate"), F.lit("okay average fine"), F.lit("great tasty love")), (F.col("id") % 3 + 1).cast("int")),
                                   F.lit(" batch"), (F.col("id") % 11).cast("string"), F.when(F.col("id") % 13 == 0, " great awful").otherwise("")).alias("cleaned_text"), (F.col("id") % 3).cast("int").alias("label"))
    fz = FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(rows)
    feats = FE.with_label_index(fz.transform(rows)).select("Id", "label", "label_idx", "features").checkpoint()
    train, val = with_class_weights(feats.where("Id % 4 <> 0"), "label"), feats.where("Id % 4 = 0")
    grid = ((5, 0.5), (5, 0.1), (20, 0.01))
    side = MO.tune(train, val, grid, parallelism=3)
    spans = MO.tune.spans
    assert max(b for b, _ in spans) < min(e for _, e in spans)  # all three were under way at once
    loop = MO.tune(train, val, grid, parallelism=1)
    assert MO.best_params(side) == MO.best_params(loop)
    assert side.drop("fit_seconds").exceptAll(loop.drop("fit_seconds")).isEmpty()
    cv = MO.cross_validate(train, grid, folds=2)
    assert cv.count() == 3 and cv.where("f1_mean between 0 and 1").count() == 3


def test_packing_moves_no_row_through_a_shuffle(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    out, plans, write = scratch_path(spark, "t-pack"), [], DataFrameWriter.parquet

    def seen(self, path, *args, **kw):
        if "_packed" in path:
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kw)

    spark.range(500).selectExpr("id AS Id", "id % 10 AS batch_id").repartition(3).write.partitionBy("batch_id").parquet(f"{out}/reviews")
    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    assert compact(spark, out, "reviews", 8, 100) == 0
    assert len(plans) == 1 and "Exchange" not in plans[0]
    assert current(spark, out, "reviews").count() == 500

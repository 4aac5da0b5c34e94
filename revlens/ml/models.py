"""Classifiers, comparison, tuning, final refit, threshold and scoring.

Models are MLlib estimators (distributed optimisers); evaluation uses the
single-pass SQL metrics of ``revlens.operators.evaluate``.  Loops over a
handful of candidate models run on the driver, but every fit and every
metric is a distributed job; only scalars (fit seconds) come back.
"""

from __future__ import annotations

import time

from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.constants import NEGATIVE_THRESHOLD
from revlens.functions.labels import label_name
from revlens.ml import features as FE
from revlens.operators.evaluate import eval_metrics

# --- fixed values: the tuning grid of (maxIter, regParam) pairs.
PARAM_GRID = ((30, 0.10), (30, 0.05), (50, 0.05), (50, 0.01), (100, 0.05), (100, 0.01))


def logistic_regression(max_iter: int = 30, reg: float = 0.05, weighted: bool = True) -> LogisticRegression:
    kw = {"weightCol": "class_weight"} if weighted else {}
    return LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=max_iter, regParam=reg,
                              elasticNetParam=0.0, family="multinomial", **kw)


def naive_bayes(weighted: bool = False) -> NaiveBayes:
    kw = {"weightCol": "class_weight"} if weighted else {}
    return NaiveBayes(featuresCol="features", labelCol="label_idx", smoothing=1.0, modelType="multinomial", **kw)


def random_forest(num_trees: int = 50, max_depth: int = 10, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label_idx", weightCol="class_weight",
                                  numTrees=num_trees, maxDepth=max_depth, seed=seed)


def in_small_tasks(train: DataFrame, rows: int = 4000) -> DataFrame:
    """``train`` in at least a partition per ``rows`` rows, for the forest: MLlib keeps a bin number per feature of each row, zero or not
    (80 KB a row at 20,000 features), so a partition that is small as a file is some hundred times larger there."""
    tasks = -(-train.count() // rows)
    return train if train.rdd.getNumPartitions() >= tasks else train.repartition(tasks, "Id")


def predictions(model, df: DataFrame) -> DataFrame:
    """Id, label, prediction, probability array, confidence."""
    p = model.transform(df)
    prob = vector_to_array("probability")
    cols = [c for c in ("Id", "label") if c in p.columns]
    return p.select(*cols, F.col("prediction").cast("int").alias("prediction"), prob.alias("prob")).withColumn(
        "confidence", F.array_max("prob")
    )


def evaluate(model, df: DataFrame) -> DataFrame:
    return eval_metrics(predictions(model, df), "label", "prediction")


def fit_timed(estimator, df: DataFrame):
    t0 = time.time()
    m = estimator.fit(df)
    return m, time.time() - t0


def compare_models(train: DataFrame, val: DataFrame, rf_trees: int = 50, rf_depth: int = 10) -> DataFrame:
    """ML12: fit LR, NB and RF on ``train``; metrics on ``val``."""
    rows = []
    for name, est in (
        ("logistic_regression", logistic_regression(30, 0.05)),
        ("naive_bayes", naive_bayes(False)),
        ("random_forest", random_forest(rf_trees, rf_depth)),
    ):
        m, secs = fit_timed(est, in_small_tasks(train) if name == "random_forest" else train)
        rows.append(evaluate(m, val).select(F.lit(name).alias("model"), "*", F.lit(round(secs, 3)).alias("fit_seconds")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def tune(train: DataFrame, val: DataFrame, grid=PARAM_GRID, parallelism: int = 3) -> DataFrame:
    """ML13: one row per (maxIter, regParam) with validation metrics.

    ``parallelism`` fits are under way at once, each a thread that waits for its own Spark jobs, so one fit's
    small late iterations don't leave the cluster idle.  The training rows are read from their files by each."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    def one(pair):
        began = time.time()
        m, secs = fit_timed(logistic_regression(*pair), train)
        row = evaluate(m, val).collect()[0]
        return pair, row, round(secs, 3), began, time.time()

    pool = ThreadPool(min(parallelism, len(grid)))
    try:
        done = pool.map(inheritable_thread_target(train.sparkSession)(one), grid, chunksize=1)
    finally:
        pool.close()
    tune.spans = [d[3:] for d in done]  # when each fit began and ended, of the last call
    rows = [(int(it), float(reg), *row, secs) for (it, reg), row, secs, *_ in done]
    names = ["max_iter", "reg_param", *done[0][1].__fields__, "fit_seconds"]
    return train.sparkSession.createDataFrame(rows, names).withColumn("max_iter", F.col("max_iter").cast("int"))


def cross_validate(rows: DataFrame, grid=PARAM_GRID, folds: int = 3, parallelism: int = 3) -> DataFrame:
    """Mean F1 of each grid point over ``folds`` folds that a hash of the Id deals, by MLlib's CrossValidator."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    lr = logistic_regression()
    points = [{lr.maxIter: it, lr.regParam: reg} for it, reg in grid]
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64("Id"), F.lit(folds)).cast("int"))
    score = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName="f1")
    model = CrossValidator(estimator=lr, estimatorParamMaps=points, evaluator=score, numFolds=folds, foldCol="fold", parallelism=parallelism).fit(dealt)
    got = [(int(it), float(reg), float(f1), float(sd)) for (it, reg), f1, sd in zip(grid, model.avgMetrics, model.stdMetrics, strict=True)]
    return rows.sparkSession.createDataFrame(got, "max_iter int, reg_param double, f1_mean double, f1_stddev double")


def best_params(tuning: DataFrame) -> tuple[tuple[int, float], float]:
    """TK10: arg-max of validation F1 (ties: fewer iterations, then larger reg), and that F1."""
    r = tuning.orderBy(F.desc("f1_weighted"), F.asc("max_iter"), F.desc("reg_param")).limit(1).collect()[0]
    return (int(r["max_iter"]), float(r["reg_param"])), float(r["f1_weighted"])


def loss_history(model) -> DataFrame:
    """ML14: the optimiser's objective per iteration (bounded by maxIter)."""
    spark = model.summary.predictions.sparkSession
    hist = list(model.summary.objectiveHistory)
    return spark.range(len(hist)).select(F.col("id").cast("int").alias("iteration"),
                                         F.element_at(F.array(*[F.lit(float(v)) for v in hist]), F.col("id").cast("int") + 1).alias("loss"))


def apply_negative_threshold(pred: DataFrame, threshold: float | None = NEGATIVE_THRESHOLD) -> DataFrame:
    """ML17: predict negative whenever P(negative) >= threshold, else keep
    the arg-max.  ``threshold=None`` disables the override."""
    if threshold is None:
        return pred.withColumn("adjusted_prediction", F.col("prediction"))
    return pred.withColumn(
        "adjusted_prediction", F.when(F.element_at("prob", 1) >= threshold, F.lit(0)).otherwise(F.col("prediction"))
    )


def score(featurizer, model, df: DataFrame, threshold: float | None = None) -> DataFrame:
    """ML18: sentiment + confidence for rows with ``cleaned_text``."""
    p = model.transform(FE.transform(featurizer, df))
    prob = vector_to_array("probability")
    pred = F.col("prediction").cast("int")
    if threshold is not None:
        pred = F.when(F.element_at(prob, 1) >= threshold, F.lit(0)).otherwise(pred)
    drop = [c for c in ("words_raw", "words_filtered", "bigrams", "tf_unigram", "tf_bigram", "tfidf_unigram", "tfidf_bigram",
                        "features", "rawPrediction", "probability", "prediction") if c in p.columns]
    return p.withColumn("predicted_sentiment", label_name(pred)).withColumn(
        "confidence", F.array_max(prob)
    ).drop(*drop)


def overfit_check(val_metrics: DataFrame, test_metrics: DataFrame, max_gap: float = 0.02) -> DataFrame:
    """ML23/FN16: |test F1 - val F1| below ``max_gap`` (one comparison row)."""
    t = test_metrics.select(F.col("f1_weighted").alias("test_f1")).scalar()
    return with_gap(val_metrics.select(F.col("f1_weighted").alias("val_f1"), t.alias("test_f1")), max_gap)


def with_gap(scores: DataFrame, max_gap: float = 0.02) -> DataFrame:
    """Adds gap and ok to ``val_f1`` and ``test_f1``."""
    gap = F.abs(F.col("test_f1") - F.col("val_f1"))
    return scores.select("val_f1", "test_f1", gap.alias("gap"), (gap < max_gap).alias("ok"))

"""Featurisation, model and lifecycle queries (rows-only checks).

The featurised splits are written as a Parquet table partitioned by ``split``
under ``spark.checkpoint.dir`` and read back: model fits and evaluations then
start from files, not from the cleaning lineage.  They are kept, like the fitted
models, for as long as the source files stay what they were.
"""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from revlens.functions.labels import label_name, score_label, sentiment_index
from revlens.ml import bayes as NB
from revlens.ml import features as FE
from revlens.ml import lifecycle as LC
from revlens.ml import models as MO
from revlens.ml.run_log import RunLog, nightly, record_scores
from revlens.operators import evaluate as EV
from revlens.operators import prep as PR
from revlens.plans.oracle_base import MLLIB_STOP_SQL, clean, full_text, index_of, label_of, name_of, split_of, with_fixtures
from revlens.plans.registry import register
from revlens.session import scratch_path
from revlens.sources.files import source_version
from revlens.sources.fixtures import review_facts, review_text, reviews
from revlens.sources.schemas import MODEL_RUNS

_FITTED: dict = {}
_LOCK = threading.RLock()


def _once(spark, sf_dir, name, fit):
    """A fitted object, kept for the application and the present files of its two source tables."""
    with _LOCK:
        key = (name, sf_dir, spark.sparkContext.applicationId, source_version(spark, sf_dir, "documents", "labels"))
        if key not in _FITTED:
            for old in [k for k in _FITTED if k[:3] == key[:3]]:
                del _FITTED[old]
            _FITTED[key] = fit()
        return _FITTED[key]


def prepared(spark, sf_dir):
    """Cleaned, length-filtered, labelled, split review_text.

    Every fit and every scoring reads these rows several times, and cleaning costs far more than the rest, so the cleaned text
    of the labelled rows is written once.  The length filter follows the read: before it, Spark would push it below the join
    with the labels and clean every document there, labelled or not, and the labelled ones again above."""

    def store():
        path = scratch_path(spark, "prepared")
        rows = PR.with_cleaned_text(review_text(spark, sf_dir)).select("Id", "cleaned_text", "label")
        rows.write.option("compression", "zstd").parquet(path)
        return path

    return PR.assign_split(PR.min_length(spark.read.parquet(_once(spark, sf_dir, "prepared", store))))


def featurised(spark, sf_dir):
    """(featuriser model, path of the featurised split table)."""

    def fit():
        rows = prepared(spark, sf_dir)
        fz = FE.fit(FE.feature_pipeline(), rows.where(F.col("split") == "train"))
        path = scratch_path(spark, "features")
        FE.with_counts(fz, FE.with_label_index(FE.transform(fz, rows))).select(
            "Id", "label", "label_idx", "split", "features", "dimension", "non_zeros").write.partitionBy("split").parquet(path)
        return fz, path

    return _once(spark, sf_dir, "features", fit)


def splits(spark, sf_dir):
    fz, path = featurised(spark, sf_dir)
    t = spark.read.parquet(path)
    train = PR.with_class_weights(t.where(F.col("split") == "train"), "label")
    return fz, train, t.where(F.col("split") == "val"), t.where(F.col("split") == "test")


def _lr(spark, sf_dir):
    return _once(spark, sf_dir, "lr", lambda: MO.logistic_regression(30, 0.05).fit(splits(spark, sf_dir)[1]))


def _tuned(spark, sf_dir):
    """((maxIter, regParam), validation F1) of the grid's winner."""
    return _once(spark, sf_dir, "tuned", lambda: MO.best_params(q_tuning(spark, sf_dir)))


def _final(spark, sf_dir):
    """Refit on train + val with the grid's winner and weights of the union."""
    def fit():
        _, train, val, _ = splits(spark, sf_dir)
        full = PR.with_class_weights(PR.union_splits(train.drop("class_weight"), val), "label")
        return MO.logistic_regression(*_tuned(spark, sf_dir)[0]).fit(full)

    return _once(spark, sf_dir, "final", fit)


_FEATURES_SQL = f"""
WITH c AS (SELECT Id, label, {clean(full_text())} AS t, {split_of()} AS split FROM review_text),
r AS (SELECT * FROM c WHERE length(t) > 10),
tok AS (SELECT Id, split, unnest(string_split(t, ' ')) AS term, unnest(range(len(string_split(t, ' ')))) AS p FROM r),
uni AS (SELECT Id, split, term, p FROM tok WHERE term <> '' AND NOT list_contains({MLLIB_STOP_SQL}, term)),
pair AS (SELECT Id, split, term || ' ' || lead(term) OVER (PARTITION BY Id ORDER BY p) AS term FROM uni),
terms AS (SELECT 'u' AS kind, Id, split, term FROM uni UNION ALL SELECT 'b', Id, split, term FROM pair WHERE term IS NOT NULL),
df AS (SELECT kind, term, count(DISTINCT Id) AS df, count(*) AS tf FROM terms WHERE split = 'train' GROUP BY kind, term),
vocab AS (SELECT kind, term, df, tf, row_number() OVER (PARTITION BY kind ORDER BY tf DESC, term) AS place FROM df WHERE df >= 5
          QUALIFY place <= 10000),
m AS (SELECT count(*) AS m FROM r WHERE split = 'train'),
nz AS (SELECT t.Id, count(DISTINCT t.kind || t.term) AS non_zeros
       FROM terms t JOIN vocab v ON t.kind = v.kind AND t.term = v.term WHERE v.df < (SELECT m FROM m) GROUP BY t.Id),
feat AS (SELECT r.Id, r.split, CAST(r.label AS DOUBLE) AS label_idx, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS dimension,
         CAST(coalesce(nz.non_zeros, 0) AS INTEGER) AS non_zeros FROM r LEFT JOIN nz ON r.Id = nz.Id)
"""


@register("tfidf_features", with_fixtures(_FEATURES_SQL + "SELECT * FROM feat", "review_text"),
          ("ML08", "ML06", "ML07", "SK05", "FN19", "UD04"))
def q_tfidf(spark, sf_dir):
    """Dimension and non-zeros of each feature vector, which stays sparse: an in-vocabulary term is
    non-zero unless its IDF is 0, so distinct terms with a weight are counted, not vector slots."""
    _, path = featurised(spark, sf_dir)
    return spark.read.parquet(path).select("Id", "split", "label_idx", "dimension", "non_zeros")


_BAD = " OR ".join(f"contains(term, '{a}')" for a in FE.ARTIFACTS)


@register("feature_checks", with_fixtures(_FEATURES_SQL + f""",
k AS (SELECT count(*) AS dim, count(*) FILTER (WHERE kind = 'u') AS uni, count(*) FILTER (WHERE kind = 'b') AS bi,
             count(*) FILTER (WHERE kind = 'u' AND place <= 200 AND ({_BAD})) AS bad FROM vocab),
l AS (SELECT count(DISTINCT label_idx) AS n, min(label_idx) AS lo, max(label_idx) AS hi, count(*) FILTER (WHERE non_zeros = 0) AS none FROM feat)
SELECT 'feature_dimension' AS "check", CAST(dim AS DOUBLE) AS value, dim BETWEEN 15000 AND 25000 AS ok FROM k
UNION ALL SELECT 'unigram_vocabulary', uni, uni > 0 FROM k UNION ALL SELECT 'bigram_vocabulary', bi, bi > 0 FROM k
UNION ALL SELECT 'artifact_terms_top200', bad, bad = 0 FROM k
UNION ALL SELECT 'label_classes', n, n = 3 AND lo = 0 AND hi = 2 FROM l UNION ALL SELECT 'empty_vectors', none, none = 0 FROM l""",
    "review_text"), ("ML16",))
def q_feature_checks(spark, sf_dir):
    fz, path = featurised(spark, sf_dir)
    return FE.feature_checks(fz, spark.read.parquet(path))


@register("lr_predictions", None, ("ML09",))
def q_lr(spark, sf_dir):
    _, _, _, test = splits(spark, sf_dir)
    return MO.predictions(_lr(spark, sf_dir), test)


@register("nb_predictions", None, ("ML10",))
def q_nb(spark, sf_dir):
    _, train, _, test = splits(spark, sf_dir)
    return MO.predictions(MO.naive_bayes().fit(train), test)


_BAYES_SQL = _FEATURES_SQL + """,
val AS (SELECT t.kind, t.Id, t.term, count(*) * any_value(ln((SELECT m + 1 FROM m) / (v.df + 1))) AS v
        FROM terms t JOIN vocab v ON t.kind = v.kind AND t.term = v.term GROUP BY t.kind, t.Id, t.term),
cls AS (SELECT k AS label, (SELECT count(*) FROM r WHERE split = 'train' AND r.label = k) AS n FROM (VALUES (0), (1), (2)) x(k)),
prior AS (SELECT label, ln(n + 1.0) - ln((SELECT sum(n) FROM cls) + 3.0) AS lp FROM cls),
sums AS (SELECT vocab.kind, vocab.term, cls.label, coalesce(any_value(s.v), 0.0) AS v FROM vocab CROSS JOIN cls
         LEFT JOIN (SELECT val.kind, val.term, r.label, sum(val.v) AS v FROM val JOIN r ON r.Id = val.Id WHERE r.split = 'train' GROUP BY ALL) s
         ON s.kind = vocab.kind AND s.term = vocab.term AND s.label = cls.label GROUP BY ALL),
tot AS (SELECT label, sum(v) + count(*) AS z FROM sums GROUP BY label),
ll AS (SELECT kind, term, sums.label, ln(v + 1.0) - ln(z) AS l FROM sums JOIN tot ON tot.label = sums.label),
part AS (SELECT val.Id, ll.label, sum(val.v * ll.l) AS s FROM val JOIN ll ON ll.kind = val.kind AND ll.term = val.term GROUP BY ALL),
sc AS (SELECT r.Id, r.split, r.label, p.label AS k, coalesce(part.s, 0.0) + p.lp AS s FROM r CROSS JOIN prior p
       LEFT JOIN part ON part.Id = r.Id AND part.label = p.label),
scored AS (SELECT Id, any_value(split) AS split, any_value(label) AS label, CAST(arg_max(k, s) AS INTEGER) AS prediction,
       max(s) FILTER (WHERE k = 0) AS s0, max(s) FILTER (WHERE k = 1) AS s1, max(s) FILTER (WHERE k = 2) AS s2, max(s) AS top
       FROM sc GROUP BY Id)
"""
_TOTAL = "(exp(s0 - top) + exp(s1 - top) + exp(s2 - top))"


def _bayes(spark, sf_dir):
    """(rows with terms and split, the relational model learned from the training rows)."""
    rows = NB.with_terms(prepared(spark, sf_dir))
    train = rows.where(F.col("split") == "train")
    return rows, NB.fit(train, NB.weighted_vocabulary(train))


@register("nb_relational", with_fixtures(_BAYES_SQL + """
SELECT Id, label, prediction, round(s0, 4) AS log_score_0, round(s1, 4) AS log_score_1, round(s2, 4) AS log_score_2
FROM scored WHERE split = 'test'""", "review_text"), ("ML10",))
def q_nb_relational(spark, sf_dir):
    """Naive Bayes learned and applied as relations, over the test rows."""
    rows, model = _bayes(spark, sf_dir)
    got = NB.predict(rows.where(F.col("split") == "test"), *model)
    return got.select("Id", "label", "prediction", *(F.round(f"log_score_{k}", 4).alias(f"log_score_{k}") for k in NB.LABELS))


@register("nb_threshold_override", with_fixtures(_BAYES_SQL + f"""
SELECT Id, label, prediction, round(exp(s0 - top) / {_TOTAL}, 4) AS p_negative, round(1 / {_TOTAL}, 4) AS confidence,
       CASE WHEN exp(s0 - top) / {_TOTAL} >= 0.35 THEN 0 ELSE prediction END AS adjusted_prediction
FROM scored WHERE split = 'test'""", "review_text"), ("ML17", "FN18", "UD02"))
def q_nb_threshold(spark, sf_dir):
    """Class probabilities of the test rows and the predictions after the negative threshold."""
    rows, model = _bayes(spark, sf_dir)
    got = MO.apply_negative_threshold(NB.predict(rows.where(F.col("split") == "test"), *model), 0.35)
    return got.select("Id", "label", "prediction", F.round(F.element_at("prob", 1), 4).alias("p_negative"),
                      F.round("confidence", 4).alias("confidence"), "adjusted_prediction")


_NB_CELLS = ", ".join(f"count(*) FILTER (WHERE label = {i} AND prediction = {j}) AS c{i}{j}" for i in range(3) for j in range(3))


def _f1_sql(i):
    said = " + ".join(f"c{j}{i}" for j in range(3))
    had = " + ".join(f"c{i}{j}" for j in range(3))
    return had, f"(CASE WHEN {said} + {had} = 0 THEN 0.0 ELSE CAST(2 * c{i}{i} AS DOUBLE) / ({said} + {had}) END)"


_NB_METRICS = f"""
cells AS (SELECT split, count(*) AS n, {_NB_CELLS} FROM scored GROUP BY split),
f AS (SELECT split, n, CAST(c00 + c11 + c22 AS DOUBLE) / n AS accuracy,
      ({" + ".join(f"({h}) * {f}" for h, f in map(_f1_sql, range(3)))}) / n AS f1_weighted,
      ({" + ".join(f for _, f in map(_f1_sql, range(3)))}) / 3.0 AS f1_macro FROM cells)
"""


@register("nb_split_metrics", with_fixtures(_BAYES_SQL + "," + _NB_METRICS + """
SELECT split, n, round(accuracy, 8) AS accuracy, round(f1_weighted, 8) AS f1_weighted, round(f1_macro, 8) AS f1_macro FROM f""", "review_text"),
          ("ML15", "ML20"))
def q_nb_split_metrics(spark, sf_dir):
    """Scores of the relational model on each part; one row a part."""
    rows, model = _bayes(spark, sf_dir)
    scored = NB.predict(rows, *model, keep=("label", "split"))
    return EV.eval_metrics(scored, by=("split",)).select("split", "n", *(F.round(c, 8).alias(c) for c in ("accuracy", "f1_weighted", "f1_macro")))


@register("nb_overfit_check", with_fixtures(_BAYES_SQL + "," + _NB_METRICS + """,
g AS (SELECT max(f1_weighted) FILTER (WHERE split = 'val') AS val_f1, max(f1_weighted) FILTER (WHERE split = 'test') AS test_f1 FROM f)
SELECT round(val_f1, 8) AS val_f1, round(test_f1, 8) AS test_f1, round(abs(test_f1 - val_f1), 8) AS gap, abs(test_f1 - val_f1) < 0.02 AS ok FROM g
""", "review_text"), ("ML23", "FN16"))
def q_nb_overfit(spark, sf_dir):
    """Validation F1 against test F1 of the relational model, both from one pass over the two parts."""
    rows, model = _bayes(spark, sf_dir)
    scored = NB.predict(rows.where(F.col("split").isin("val", "test")), *model, keep=("label", "split"))
    f1 = EV.eval_metrics(scored, by=("split",)).agg(*(F.max(F.when(F.col("split") == p, F.col("f1_weighted"))).alias(f"{p}_f1") for p in ("val", "test")))
    return MO.with_gap(f1).select(*(F.round(c, 8).alias(c) for c in ("val_f1", "test_f1", "gap")), "ok")


@register("nb_scored_reviews", with_fixtures(_BAYES_SQL + f""",
vt AS (SELECT Id, {clean(full_text())} AS t FROM reviews),
vtok AS (SELECT Id, unnest(string_split(t, ' ')) AS term, unnest(range(len(string_split(t, ' ')))) AS p FROM vt),
vuni AS (SELECT Id, term, p FROM vtok WHERE term <> '' AND NOT list_contains({MLLIB_STOP_SQL}, term)),
vpair AS (SELECT Id, term || ' ' || lead(term) OVER (PARTITION BY Id ORDER BY p) AS term FROM vuni),
vterms AS (SELECT 'u' AS kind, Id, term FROM vuni UNION ALL SELECT 'b', Id, term FROM vpair WHERE term IS NOT NULL),
vmet AS (SELECT t.Id, ll.label, ln((SELECT m + 1 FROM m) / (v.df + 1)) * ll.l AS x FROM vterms t JOIN vocab v ON t.kind = v.kind AND t.term = v.term
         JOIN ll ON ll.kind = v.kind AND ll.term = v.term LIMIT 9223372036854775807),
vpart AS (SELECT Id, label, sum(x) AS s FROM vmet GROUP BY ALL),
vsc AS (SELECT vt.Id, p.label AS k, coalesce(vpart.s, 0.0) + p.lp AS s FROM vt CROSS JOIN prior p
        LEFT JOIN vpart ON vpart.Id = vt.Id AND vpart.label = p.label LIMIT 9223372036854775807),
vs AS (SELECT Id, arg_max(k, s) AS best, max(s) AS top,
       max(s) FILTER (WHERE k = 0) AS s0, max(s) FILTER (WHERE k = 1) AS s1, max(s) FILTER (WHERE k = 2) AS s2 FROM vsc GROUP BY Id)
SELECT Id, {name_of("best")} AS predicted_sentiment, round(1 / {_TOTAL}, 4) AS confidence, round(exp(s0 - top) / {_TOTAL}, 4) AS p_negative FROM vs""", "review_text", "reviews"),
          ("ML18", "PJ07", "FN18", "UD02"))
def q_nb_scored_reviews(spark, sf_dir):
    """Every stored review scored by the relational model: sentiment name, confidence and probability of negative."""
    _, model = _bayes(spark, sf_dir)
    rows = NB.with_terms(PR.with_cleaned_text(reviews(spark, sf_dir).select("Id", "Summary", "Text")))
    got = NB.predict(rows, *model, keep=())
    return got.select("Id", label_name("prediction").alias("predicted_sentiment"), F.round("confidence", 4).alias("confidence"),
                      F.round(F.element_at("prob", 1), 4).alias("p_negative"))


@register("rf_predictions", None, ("ML11",))
def q_rf(spark, sf_dir):
    _, train, _, test = splits(spark, sf_dir)
    return MO.predictions(MO.random_forest(50, 10).fit(MO.in_small_tasks(train)), test)


@register("model_comparison", None, ("ML12",))
def q_compare(spark, sf_dir):
    _, train, val, _ = splits(spark, sf_dir)
    return MO.compare_models(train, val, rf_trees=50, rf_depth=10)


@register("tuning_results", None, ("ML13", "TK10"))
def q_tuning(spark, sf_dir):
    _, train, val, _ = splits(spark, sf_dir)
    return MO.tune(train, val)


@register("cross_validation", None, ("ML13",))
def q_cross_validation(spark, sf_dir):
    """The grid over three hash folds of the training part."""
    return MO.cross_validate(splits(spark, sf_dir)[1])


@register("loss_history", None, ("ML14",))
def q_loss(spark, sf_dir):
    """Objective per iteration of the final refit."""
    return MO.loss_history(_final(spark, sf_dir))


@register("final_model_card", None, ("ML14", "TK10"))
def q_final_model(spark, sf_dir):
    """One row: the winner's parameters, its validation F1, and the final model's test scores."""
    _, _, _, test = splits(spark, sf_dir)
    (it, reg), val_f1 = _tuned(spark, sf_dir)
    return MO.evaluate(_final(spark, sf_dir), test).select(
        F.lit(it).alias("max_iter"), F.lit(reg).alias("reg_param"), F.lit(val_f1).alias("val_f1"), F.col("n").alias("n_test"),
        F.col("accuracy").alias("test_accuracy"), F.col("f1_weighted").alias("test_f1"), F.col("f1_macro").alias("test_f1_macro"))


@register("threshold_override", None, ("ML17",))
def q_threshold(spark, sf_dir):
    _, _, _, test = splits(spark, sf_dir)
    return MO.apply_negative_threshold(MO.predictions(_lr(spark, sf_dir), test), 0.35)


@register("scored_reviews", None, ("ML18", "UD02"))
def q_scored(spark, sf_dir):
    """Score the stored reviews with the featuriser + LR trained on review_text."""
    fz, _ = featurised(spark, sf_dir)
    r = PR.with_cleaned_text(reviews(spark, sf_dir).select("Id", "ProductId", "Score", "Summary", "Text"))
    return MO.score(fz, _lr(spark, sf_dir), r).select("Id", "ProductId", "Score", "predicted_sentiment", "confidence")


_CHECKED_SQL = with_fixtures(f"""
WITH r AS (SELECT Id, label FROM review_text WHERE length({clean(full_text())}) > 10 AND {split_of()} = 'test')
SELECT m.model, r.Id, r.label, true AS one_of_three, true AS sums_to_one, true AS agrees, true AS in_range
FROM r, (VALUES ('logistic_regression'), ('naive_bayes'), ('random_forest')) m(model)""", "review_text")


@register("prediction_checks", _CHECKED_SQL, ("ML09", "ML10", "ML11", "FN18", "UD02"))
def q_prediction_checks(spark, sf_dir):
    """For each classifier and test row: three probabilities that sum to one, the prediction at the
    largest of them, and the confidence equal to it."""
    _, train, _, test = splits(spark, sf_dir)
    fitted = {"logistic_regression": _lr(spark, sf_dir), "naive_bayes": MO.naive_bayes().fit(train),
              "random_forest": MO.random_forest(50, 10).fit(MO.in_small_tasks(train))}
    p = PR.union_splits(*(MO.predictions(m, test).withColumn("model", F.lit(k)) for k, m in fitted.items()))
    total = F.aggregate("prob", F.lit(0.0), lambda a, x: a + x)
    return p.select(
        "model", "Id", "label", ((F.size("prob") == 3) & F.col("prediction").isin(0, 1, 2)).alias("one_of_three"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (F.element_at("prob", F.col("prediction") + 1) == F.col("confidence")).alias("agrees"),
        F.col("confidence").between(1 / 3 - 1e-9, 1 + 1e-9).alias("in_range"))


@register("scored_review_checks", with_fixtures("""
SELECT Id, true AS named, true AS in_range FROM reviews""", "reviews"), ("ML18", "PJ07", "FN18"))
def q_scored_checks(spark, sf_dir):
    """Every stored review is scored once, with a named sentiment and a confidence of at least a third."""
    return q_scored(spark, sf_dir).select("Id", F.col("predicted_sentiment").isin("negative", "neutral", "positive").alias("named"),
                                          F.col("confidence").between(1 / 3 - 1e-9, 1 + 1e-9).alias("in_range"))


@register("retrain_metrics", None, ("ML20", "ML22"))
def q_retrain(spark, sf_dir):
    fz, _ = featurised(spark, sf_dir)
    rows = prepared(spark, sf_dir).drop("split")
    _, metrics = LC.retrain(rows, fz)
    return metrics


@register("retrain_run", None, ("ML20", "ML21", "ML22", "SK04", "SK06", "SK07"))
def q_retrain_run(spark, sf_dir):
    """The nightly job from the stored featuriser to the recorded decision; the ``type = retraining`` row."""
    fz, _ = featurised(spark, sf_dir)
    stored = LC.load_pipeline(LC.save_model(fz, scratch_path(spark, "featuriser"), "v1"))
    rows = prepared(spark, sf_dir).drop("split")
    runs = spark.createDataFrame([], MODEL_RUNS)
    _, record = LC.retrain_run(rows, stored, runs, scratch_path(spark, "models"), "nightly")
    return record


@register("overfit_check", None, ("ML23", "FN16"))
def q_overfit(spark, sf_dir):
    """The winner's validation F1 against the final model's test F1."""
    _, _, _, test = splits(spark, sf_dir)
    _, val_f1 = _tuned(spark, sf_dir)
    return MO.overfit_check(spark.range(1).select(F.lit(val_f1).alias("f1_weighted")), MO.evaluate(_final(spark, sf_dir), test))


@register("model_runs_history", None, ("ML21", "ML22", "SK06", "SK07", "SC10"))
def q_model_runs(spark, sf_dir):
    """The lifecycle over the tuning grid: each grid point is a retraining that is gated against the stored run log, saved and
    stored; the current model is resolved from the log and loaded again.  All read the features stored once."""
    fz, path = featurised(spark, sf_dir)
    rows = spark.read.parquet(path).select("Id", "label", "features")
    log = RunLog(spark, scratch_path(spark, "run-log"))
    for it, reg in MO.PARAM_GRID:
        nightly(log, rows, fz, f"lr_it{it}_reg{reg}", f"lr_it{it}_reg{reg}", it, reg)
    for best in log.current().collect():  # one row, none below the sample gate
        if LC.load_classifier(best.model_path).numClasses < 2:
            raise ValueError(f"{best.model_path} holds no classifier")
    return LC.model_history(log.read())


# ------------------------------------------- stored run log, one run a year of reviews
def _class(i, n):
    tp, wrong = f"c{i}{i}", " + ".join([f"c{i}{j}" for j in range(3) if j != i] + [f"c{j}{i}" for j in range(3) if j != i])
    return (f"CASE WHEN {tp} + {wrong} = 0 THEN 0.0 ELSE CAST(2 * {tp} AS DOUBLE) / (2 * {tp} + {wrong}) END AS f1_{n}",
            f"CASE WHEN s{i} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / s{i} END AS recall_{n}")


_RUNS_SQL = with_fixtures(f"""
WITH p AS (SELECT *, {label_of()} AS label, {index_of()} AS pred, year(processed_at) AS yr FROM reviews),
g AS (SELECT yr, count(*) AS n, max(processed_at) AS start_time,
  {", ".join(f"count(*) FILTER (WHERE label = {i}) AS s{i}" for i in range(3))},
  {", ".join(f"count(*) FILTER (WHERE label = {i} AND pred = {j}) AS c{i}{j}" for i in range(3) for j in range(3))}
  FROM p GROUP BY yr),
e AS (SELECT *, {", ".join(x for i, c in enumerate(("negative", "neutral", "positive")) for x in _class(i, c))},
  CAST(c00 + c11 + c22 AS DOUBLE) / n AS accuracy FROM g),
w AS (SELECT *, (s0 * f1_negative + s1 * f1_neutral + s2 * f1_positive) / n AS f1 FROM e),
o AS (SELECT *, row_number() OVER (ORDER BY yr) AS rn FROM w),
gate AS (SELECT rn, true AS promoted, CAST(NULL AS DOUBLE) AS prev, f1 AS best FROM o WHERE rn = 1
         UNION ALL SELECT o.rn, o.f1 > gate.best + 0.015, gate.best, CASE WHEN o.f1 > gate.best + 0.015 THEN o.f1 ELSE gate.best END
         FROM gate JOIN o ON o.rn = gate.rn + 1),
runs AS (SELECT 'run-' || yr AS run_id, start_time, n AS n_samples, f1, accuracy, recall_negative, f1_negative, prev, promoted
         FROM o JOIN gate USING (rn))
""", "reviews").replace("WITH ", "WITH RECURSIVE ", 1)


def yearly_scores(spark, sf_dir):
    """One row a year of reviews: the scores of that year's predictions, from its confusion counts."""
    r = review_facts(spark, sf_dir).select("processed_at", score_label("Score").alias("label"), sentiment_index("predicted_sentiment").alias("pred"))
    cells = {f"c{i}{j}": F.count_if((F.col("label") == i) & (F.col("pred") == j)) for i in range(3) for j in range(3)}
    g = r.groupBy(F.year("processed_at").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.max("processed_at").alias("start_time"),
        *(F.count_if(F.col("label") == i).alias(f"s{i}") for i in range(3)), *(c.alias(k) for k, c in cells.items()))
    div = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)
    c = F.col
    f1, recall = [], []
    for i in range(3):
        said = sum((c(f"c{j}{i}") for j in range(3)), F.lit(0))
        had = sum((c(f"c{i}{j}") for j in range(3)), F.lit(0))
        f1.append(div(2 * c(f"c{i}{i}"), said + had))
        recall.append(div(c(f"c{i}{i}"), c(f"s{i}")))
    score = sum((c(f"s{i}") * f1[i] for i in range(1, 3)), c("s0") * f1[0]) / c("n")
    return g.select("year", "n", "start_time", score.alias("f1_weighted"), f1[0].alias("f1_negative"), recall[0].alias("recall_negative"),
                    ((c("c00") + c("c11") + c("c22")).cast("double") / c("n")).alias("accuracy"))


def stored_runs(spark, sf_dir) -> RunLog:
    """A run log in storage: each year's predictions are a run that is gated against the runs stored before it."""
    log = RunLog(spark, scratch_path(spark, "run-log"))
    for r in yearly_scores(spark, sf_dir).orderBy("year").collect():  # one row a year
        scores = {k: r[k] for k in ("f1_weighted", "accuracy", "recall_negative", "f1_negative")}
        record_scores(log, f"run-{r.year}", "yearly", r.start_time, scores, {"n_samples": r.n})
    return log


def _wall_clock(runs):
    return runs.withColumn("start_time", F.col("start_time").cast("timestamp_ntz"))


@register("model_history", _RUNS_SQL + """
SELECT run_id, 'yearly' AS run_name, start_time, round(f1 * 100, 2) AS f1_weighted_pct, round(accuracy * 100, 2) AS accuracy_pct,
       round(recall_negative * 100, 2) AS recall_negative_pct, round(f1_negative * 100, 2) AS f1_negative_pct,
       CASE WHEN prev > 0 THEN round(prev * 100, 2) END AS previous_f1_pct,
       CASE WHEN prev > 0 THEN round((f1 - prev) / prev * 100, 2) END AS improvement_pct, promoted,
       CASE WHEN promoted THEN 'PROMOTED' ELSE 'REJECTED' END AS decision, CAST(NULL AS DOUBLE) AS train_time_seconds,
       'TRAINED' AS status, n_samples
FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 20""", ("ML22", "TK08", "PJ17"))
def q_model_history(spark, sf_dir):
    return _wall_clock(LC.model_history(stored_runs(spark, sf_dir).read()))


@register("run_search", _RUNS_SQL + """
SELECT run_id, start_time, f1 AS f1_weighted FROM runs WHERE promoted ORDER BY f1 DESC, run_id LIMIT 20""", ("SC09", "FL15"))
def q_run_search(spark, sf_dir):
    found = LC.run_search(stored_runs(spark, sf_dir).read(), order_by="f1_weighted")
    return _wall_clock(found).select("run_id", "start_time", F.col("metrics")["f1_weighted"].alias("f1_weighted"))


@register("current_model", _RUNS_SQL + """
SELECT run_id, 'models/' || run_id AS model_path, (SELECT max(f1) FROM runs WHERE promoted) AS best_promoted_f1
FROM runs ORDER BY promoted DESC, start_time DESC, run_id DESC LIMIT 1""", ("TK07", "TK09"))
def q_current_model(spark, sf_dir):
    """Resolved from the stored log; the path is relative to it."""
    log = stored_runs(spark, sf_dir)
    runs = log.read()
    return log.current().select("run_id", "model_path", LC.best_promoted_f1(runs).scalar().alias("best_promoted_f1"))

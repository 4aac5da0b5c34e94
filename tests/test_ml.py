"""Featuriser / model checks on hand-made separable text."""

from pyspark.sql import functions as F

from revlens.ml import features as FE
from revlens.ml import models as MO
from revlens.operators import evaluate as E
from revlens.operators.prep import with_class_weights
from revlens.operators.words import term_arrays

from .conftest import SF_SMALL


def _toy(spark):
    pos = ["great tasty coffee love it", "love this great tea", "excellent tasty snack love", "great value love flavor"]
    neg = ["awful stale coffee hate it", "terrible bitter tea hate", "stale awful snack refund", "hate terrible flavor awful"]
    neu = ["okay coffee average taste", "average tea nothing special", "okay snack average price", "average flavor okay fine"]
    rows = []
    i = 0
    for rep in range(6):
        for lab, texts in ((2, pos), (0, neg), (1, neu)):
            for t in texts:
                rows.append((i, t + f" batch{rep}", lab))
                i += 1
    return spark.createDataFrame(rows, "Id int, cleaned_text string, label int")


def test_regex_tokenizer_matches_sql_tokens(spark):
    df = spark.createDataFrame([(1, None, "Hello,  World!! the tea <b>x</b>"), (2, "", "")], "Id int, Summary string, Text string")
    arrays = {r.Id: (r.words_raw, r.words_filtered) for r in term_arrays(df).collect()}
    from revlens.operators.prep import with_cleaned_text

    fz = FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(with_cleaned_text(df))
    t = {r.Id: (r.words_raw, r.words_filtered) for r in fz.transform(with_cleaned_text(df)).collect()}
    assert arrays == t


def test_weighted_lr_beats_majority_and_is_deterministic(spark):
    df = FE.with_label_index(_toy(spark))
    fz = FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(df)
    feats = with_class_weights(fz.transform(df), "label")
    m1 = MO.logistic_regression(50, 0.01).fit(feats)
    m2 = MO.logistic_regression(50, 0.01).fit(feats)
    e = MO.evaluate(m1, feats).collect()[0]
    assert e.f1_macro > 0.9  # majority class would give macro F1 = 1/6
    p1 = [r.prediction for r in MO.predictions(m1, feats).orderBy("Id").collect()]
    p2 = [r.prediction for r in MO.predictions(m2, feats).orderBy("Id").collect()]
    assert p1 == p2


def test_lr_stands_at_the_optimum_of_its_weighted_regularised_risk(spark):
    """The gradient is written out in numpy: weighted log loss, ridge on standardised coefficients, free intercepts."""
    import numpy as np

    reg = 0.05
    rows = _toy(spark).where("label <> 1 or Id % 3 = 0")  # unequal classes, so that the weights matter
    df = FE.with_label_index(rows)
    feats = with_class_weights(FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(df).transform(df), "label").cache()
    model = MO.logistic_regression(300, reg).setTol(1e-10).fit(feats)
    got = feats.select("Id", "features", "label", "class_weight").orderBy("Id").collect()
    x = np.stack([r.features.toArray() for r in got])
    y = np.eye(3)[[r.label for r in got]]
    w = np.array([r.class_weight for r in got])
    beta, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    mean = w @ x / w.sum()
    var = w @ (x - mean) ** 2 / (w.sum() - (w ** 2).sum() / w.sum())

    def gradient(b, c):
        z = x @ b.T + c
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        rest = (p - y) * w[:, None] / w.sum()
        return p, rest.T @ x + reg * var * b, rest.sum(axis=0)

    prob, slope, level = gradient(beta, bias)
    start = gradient(np.zeros_like(beta), np.log(w @ y / w.sum()))[1]
    assert len(set(np.round(w, 6))) > 1 and np.abs(slope).max() < 1e-4 * np.abs(start).max() and np.abs(level).max() < 1e-6
    assert np.abs(gradient(beta, bias + [0.1, 0, 0])[2]).max() > 1e-3  # the check sees a model that is off
    for r, p in zip(MO.predictions(model, feats).orderBy("Id").collect(), prob, strict=True):
        assert np.abs(np.array(r.prob) - p).max() < 1e-9 and r.prediction == p.argmax() and r.confidence == max(r.prob)


def test_forest_probability_is_the_mean_vote_of_its_trees(spark):
    import numpy as np
    from pyspark.ml.functions import vector_to_array

    df = FE.with_label_index(_toy(spark))
    feats = with_class_weights(FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(df).transform(df), "label").cache()
    model = MO.random_forest(7, 4).fit(feats)
    votes = np.zeros((feats.count(), 3))
    for tree in model.trees:
        raw = tree.transform(feats).orderBy("Id").select(vector_to_array("rawPrediction").alias("raw")).collect()
        leaf = np.array([r.raw for r in raw])
        votes += leaf / leaf.sum(axis=1, keepdims=True)
    got = MO.predictions(model, feats).orderBy("Id").collect()
    assert len(model.trees) == 7 and max(t.depth for t in model.trees) <= 4
    for r, v in zip(got, votes / 7, strict=True):
        assert np.abs(np.array(r.prob) - v).max() < 1e-9 and r.prediction == v.argmax()
    assert MO.evaluate(model, feats).collect()[0].f1_macro > 0.5


def test_model_comparison_and_grid_equal_metrics_of_each_model_alone(spark):
    """Each row's metrics come from counts of that model's own predictions, written out in Python."""
    df = FE.with_label_index(_toy(spark))
    feats = with_class_weights(FE.feature_pipeline(min_df=1, min_doc_freq=0).fit(df).transform(df), "label").cache()
    train, val = feats.where("Id % 3 <> 0"), feats.where("Id % 3 = 0")

    def alone(estimator):
        got = [(r.label, r.prediction) for r in MO.predictions(estimator.fit(train), val).collect()]
        f1 = []
        for k in range(3):
            hit, said, real = sum(a == b == k for a, b in got), sum(b == k for _, b in got), sum(a == k for a, _ in got)
            f1.append((2 * hit / (said + real) if said + real else 0.0, real))
        return sum(a == b for a, b in got) / len(got), sum(f * n for f, n in f1) / len(got)

    want = {"logistic_regression": alone(MO.logistic_regression(30, 0.05)), "naive_bayes": alone(MO.naive_bayes(False)),
            "random_forest": alone(MO.random_forest(5, 4))}
    for r in MO.compare_models(train, val, 5, 4).collect():
        assert abs(r.accuracy - want[r.model][0]) < 1e-4 and abs(r.f1_weighted - want[r.model][1]) < 1e-4
    for r in MO.tune(train, val, ((5, 0.5), (20, 0.01))).collect():
        acc, f1 = alone(MO.logistic_regression(r.max_iter, r.reg_param))
        assert abs(r.accuracy - acc) < 1e-4 and abs(r.f1_weighted - f1) < 1e-4


def test_threshold_override(spark):
    df = spark.createDataFrame([([0.4, 0.1, 0.5], 2), ([0.3, 0.1, 0.6], 2)], "prob array<double>, prediction int")
    got = [r.adjusted_prediction for r in MO.apply_negative_threshold(df, 0.35).collect()]
    assert got == [0, 2]
    assert [r.adjusted_prediction for r in MO.apply_negative_threshold(df, None).collect()] == [2, 2]


def test_relational_bayes_agrees_with_the_estimator_on_every_row(spark):
    from pyspark.ml.functions import vector_to_array

    from revlens.ml import bayes as NB

    rows = _toy(spark)
    train, test = rows.where("Id % 4 <> 0"), rows.where("Id % 4 = 0").unionByName(
        spark.createDataFrame([(900, "unseen words only", 1), (901, "great great great awful", 2)], rows.schema))
    fz = FE.feature_pipeline(min_df=2, min_doc_freq=2).fit(train)
    model = MO.naive_bayes().fit(FE.with_label_index(fz.transform(train)))
    want = {r.Id: (int(r.prediction), r.raw, r.prob) for r in model.transform(FE.with_label_index(fz.transform(test))).select(
        "Id", "prediction", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("prob")).collect()}
    seen = NB.with_terms(train)
    vocab = NB.weighted_vocabulary(seen, 2)
    got = NB.predict(NB.with_terms(test), *NB.fit(seen, vocab)).collect()
    assert len(got) == len(want)
    for r in got:
        label, raw, prob = want[r.Id]
        assert r.prediction == label and max(abs(r[f"log_score_{k}"] - raw[k]) for k in range(3)) < 1e-9
        assert max(abs(a - b) for a, b in zip(r.prob, prob, strict=True)) < 1e-9 and r.confidence == max(r.prob)


def test_bayes_probabilities_of_far_apart_scores_and_metrics_by_part(spark):
    """Scores that differ by thousands don't overflow; metrics by part equal those of each part alone."""
    from revlens.ml import bayes as NB

    rows = spark.createDataFrame([(1, "x", ["bad"] * 3000, []), (2, "x", [], []), (3, "y", None, None)],
                                 "Id long, part string, words_filtered array<string>, bigrams array<string>")
    priors = spark.createDataFrame([(-1.0, -2.0, -3.0)], "prior_0 double, prior_1 double, prior_2 double")
    like = spark.createDataFrame([("u", "bad", 2.0, -0.1, -9.0, -9.0)], "kind string, term string, idf double, like_0 double, like_1 double, like_2 double")
    got = {r.Id: r for r in NB.predict(rows, priors, like, keep=("part",)).collect()}
    assert got[1].prob == [1.0, 0.0, 0.0] and got[1].confidence == 1.0 and got[1].prediction == 0
    assert got[2].prob == got[3].prob and abs(sum(got[2].prob) - 1) < 1e-12 and got[3].part == "y"
    cells = spark.createDataFrame([("a", 0, 0), ("a", 1, 2), ("b", 2, 2), ("b", 0, 1), (None, 1, 1)], "part string, label int, prediction int")
    whole = {r.part: tuple(r)[1:] for r in E.eval_metrics(cells, by=("part",)).collect()}
    for part in ("a", "b", None):
        alone = E.eval_metrics(cells.where(F.col("part").eqNullSafe(F.lit(part)))).first()
        assert whole[part] == tuple(alone)


def test_texts_are_cleaned_once_for_every_fit(spark):
    from revlens.operators import prep as PR
    from revlens.plans.ml_plans import prepared
    from revlens.sources.fixtures import review_text

    rows = prepared(spark, SF_SMALL)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "regexp_replace" not in plan and "documents.parquet" not in plan and "Join" not in plan
    fresh = PR.assign_split(PR.min_length(PR.with_cleaned_text(review_text(spark, SF_SMALL))).select("Id", "cleaned_text", "label"))
    assert rows.columns == fresh.columns and rows.count() == fresh.count() > 0
    assert rows.exceptAll(fresh).isEmpty()


def test_the_forest_is_fitted_in_tasks_of_bounded_rows(spark):
    rows = spark.range(1000).withColumnRenamed("id", "Id").coalesce(2)
    small = MO.in_small_tasks(rows, 100)
    sizes = [r["count"] for r in small.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert small.rdd.getNumPartitions() == 10 and max(sizes) < 200 and sum(sizes) == 1000
    assert MO.in_small_tasks(rows, 600) is rows


def test_words_meet_the_bayes_model_where_they_are_read(spark):
    """Without a size to go by (as in a large run) no word is moved to meet the model, and the texts are read once for words and pairs."""
    from revlens.ml import bayes as NB

    rows = NB.with_terms(_toy(spark))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        vocab = NB.weighted_vocabulary(rows, 2)
        terms = NB.document_terms(rows, vocab)
        plan = terms._jdf.queryExecution().executedPlan().toString()
        words = plan[:plan.index("BroadcastExchange")]  # above the vocabulary's own plan
        assert "BroadcastHashJoin" in words and "SortMergeJoin" not in words and "Exchange" not in words
        got = {tuple(r) for r in terms.groupBy("Id", "kind", "term").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    known = {(r.kind, r.term) for r in vocab.collect()}
    want = {}
    for r in rows.collect():
        for kind, found in (("u", r.words_filtered), ("b", r.bigrams)):
            for t in found:
                if (kind, t) in known:
                    want[r.Id, kind, t] = want.get((r.Id, kind, t), 0) + 1
    assert got == {(*k, n) for k, n in want.items()} and {k for _, k, _ in want} == {"u", "b"}


def test_scoring_makes_words_and_pairs_as_expressions(spark):
    """The same features as the fitted pipeline's, fitted or applied, with no function over Java strings but the vectorisers."""
    rows = _toy(spark)
    fz = FE.fit(FE.feature_pipeline(min_df=2, min_doc_freq=2), rows)
    own = FE.feature_pipeline(min_df=2, min_doc_freq=2).fit(rows)
    for a, b in zip(fz.stages, own.stages, strict=True):
        assert type(a) is type(b) and (not hasattr(a, "vocabulary") or sorted(a.vocabulary) == sorted(b.vocabulary))
    odd = spark.createDataFrame([(900, "", 1), (901, "great", 2), (902, "the the of", 0), (903, "good good tea the good", 0)], rows.schema)
    both = rows.unionByName(odd)
    columns = ["Id", "words_raw", "words_filtered", "bigrams", "features"]
    a, b = ({r.Id: tuple(r) for r in x.select(*columns).collect()} for x in (FE.transform(fz, both), fz.transform(both)))
    assert a == b and len(a) == both.count()
    lr = MO.logistic_regression(5, 0.1, weighted=False).fit(FE.with_label_index(fz.transform(rows)))
    plan = MO.score(fz, lr, both)._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(cleaned_text" not in plan and "UDF(words_raw" not in plan and plan.count("UDF(words_filtered") == 1

"""Evaluation of stored predictions against star labels (reviews view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions.labels import score_label, sentiment_index
from revlens.operators import evaluate as E
from revlens.plans.oracle_base import index_of, label_of, name_of, with_fixtures
from revlens.plans.registry import register
from revlens.sources.fixtures import review_facts


def _pairs(spark, sf_dir):
    r = review_facts(spark, sf_dir)
    return r.select(score_label("Score").alias("label"), sentiment_index("predicted_sentiment").alias("prediction"))


_CELLS = "SELECT count(*) AS n, " + ", ".join(
    f"count(*) FILTER (WHERE label = {i} AND prediction = {j}) AS c{i}{j}" for i in range(3) for j in range(3)
) + f" FROM (SELECT {label_of()} AS label, {index_of()} AS prediction FROM reviews)"


def _cls(i):
    tp = f"c{i}{i}"
    fp = "(" + " + ".join(f"c{j}{i}" for j in range(3) if j != i) + ")"
    fn = "(" + " + ".join(f"c{i}{j}" for j in range(3) if j != i) + ")"
    return dict(
        tp=tp, fp=fp, fn=fn, support=f"({tp} + {fn})",
        precision=f"CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fp} AS DOUBLE) END",
        recall=f"CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fn} AS DOUBLE) END",
        f1=f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE CAST(2 * {tp} AS DOUBLE) / CAST(2 * {tp} + {fp} + {fn} AS DOUBLE) END",
    )


@register("confusion_matrix", with_fixtures(
    f"WITH a AS ({_CELLS})\n" + "\nUNION ALL ".join(
        f"SELECT {i} AS label, {j} AS prediction, CAST(c{i}{j} AS BIGINT) AS count FROM a" for i in range(3) for j in range(3)
    ), "reviews"), ("AG15", "FL07"))
def q_confusion(spark, sf_dir):
    return E.confusion_matrix(_pairs(spark, sf_dir))


@register("confusion_normalized", with_fixtures(
    f"WITH a AS ({_CELLS})\n" + "\nUNION ALL ".join(
        f"SELECT {i} AS label, {j} AS prediction, CAST(c{i}{j} AS BIGINT) AS count, "
        f"CASE WHEN (c{i}0 + c{i}1 + c{i}2) = 0 THEN NULL ELSE CAST(c{i}{j} AS DOUBLE) / CAST(c{i}0 + c{i}1 + c{i}2 AS DOUBLE) END AS rate FROM a"
        for i in range(3) for j in range(3)
    ), "reviews"), ("AG16",))
def q_confusion_norm(spark, sf_dir):
    return E.confusion_normalized(_pairs(spark, sf_dir))


@register("error_patterns", with_fixtures(
    f"""
WITH p AS (SELECT {label_of()} AS label, {index_of()} AS prediction FROM reviews)
SELECT label, prediction, {name_of('label')} AS true_sentiment, {name_of('prediction')} AS predicted_sentiment, count(*) AS count
FROM p WHERE label <> prediction GROUP BY label, prediction""", "reviews"), ("AG17", "FL08"))
def q_error_patterns(spark, sf_dir):
    return E.error_patterns(_pairs(spark, sf_dir))


@register("per_class_prf", with_fixtures(
    f"WITH a AS ({_CELLS})\n" + "\nUNION ALL ".join(
        "SELECT {i} AS label, CAST({tp} AS BIGINT) AS tp, CAST({fp} AS BIGINT) AS fp, CAST({fn} AS BIGINT) AS fn, "
        "CAST({support} AS BIGINT) AS support, {precision} AS precision, {recall} AS recall, {f1} AS f1 FROM a".format(i=i, **_cls(i))
        for i in range(3)
    ), "reviews"), ("AG18",))
def q_prf(spark, sf_dir):
    return E.per_class_prf(_pairs(spark, sf_dir))


def _weighted(m):
    return "(" + " + ".join(f"CAST({_cls(i)['support']} AS DOUBLE) * ({_cls(i)[m]})" for i in range(3)) + ") / CAST(n AS DOUBLE)"


@register("eval_metrics", with_fixtures(
    f"""WITH a AS ({_CELLS})
SELECT n, CAST(c00 + c11 + c22 AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy,
       {_weighted('f1')} AS f1_weighted,
       ({' + '.join(f"({_cls(i)['f1']})" for i in range(3))}) / 3.0 AS f1_macro,
       {_weighted('precision')} AS precision_weighted,
       {_weighted('recall')} AS recall_weighted
FROM a""", "reviews"), ("ML15",))
def q_eval_metrics(spark, sf_dir):
    return E.eval_metrics(_pairs(spark, sf_dir))

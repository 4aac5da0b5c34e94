"""Classifier evaluation in one aggregation.

All k*k confusion cells are counted in a single pass (conditional counts);
every metric is then arithmetic on that one row, so precision / recall / F1
for all classes cost one job instead of one count job per number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.labels import label_name

K = 3


def confusion_row(df: DataFrame, label: str = "label", prediction: str = "prediction", k: int = K, by: tuple[str, ...] = ()) -> DataFrame:
    """All cells in one row, or in one row for each value of ``by``."""
    lab, pred = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if((lab == i) & (pred == j)).alias(f"c{i}{j}") for i in range(k) for j in range(k)],
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction", k: int = K) -> DataFrame:
    """AG15: all k*k cells including zeros (no skeleton join needed)."""
    row = confusion_row(df, label, prediction, k)
    stack = ", ".join(f"{i}, {j}, c{i}{j}" for i in range(k) for j in range(k))
    return row.selectExpr(f"stack({k * k}, {stack}) AS (label, prediction, count)").select(
        F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("count").cast("long")
    )


def confusion_normalized(df: DataFrame, label: str = "label", prediction: str = "prediction", k: int = K) -> DataFrame:
    """AG16: each cell divided by its true-class row total."""
    row = confusion_row(df, label, prediction, k)
    tot = {i: "(" + " + ".join(f"c{i}{j}" for j in range(k)) + ")" for i in range(k)}
    stack = ", ".join(
        f"{i}, {j}, c{i}{j}, CASE WHEN {tot[i]} = 0 THEN NULL ELSE CAST(c{i}{j} AS DOUBLE) / CAST({tot[i]} AS DOUBLE) END"
        for i in range(k)
        for j in range(k)
    )
    return row.selectExpr(f"stack({k * k}, {stack}) AS (label, prediction, count, rate)").select(
        F.col("label").cast("int"), F.col("prediction").cast("int"), F.col("count").cast("long"), "rate"
    )


def error_patterns(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """AG17: mispredictions grouped by (true, predicted), most frequent first."""
    e = df.where(F.col(label) != F.col(prediction))
    g = e.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )
    return g.select(
        "label", "prediction", label_name("label").alias("true_sentiment"), label_name("prediction").alias("predicted_sentiment"), "count"
    ).orderBy(F.desc("count"), "label", "prediction")


def _class_exprs(i: int, k: int) -> dict[str, str]:
    tp = f"c{i}{i}"
    fp = "(" + " + ".join(f"c{j}{i}" for j in range(k) if j != i) + ")"
    fn = "(" + " + ".join(f"c{i}{j}" for j in range(k) if j != i) + ")"
    return {
        "tp": tp,
        "fp": fp,
        "fn": fn,
        "support": f"({tp} + {fn})",
        "precision": f"CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fp} AS DOUBLE) END",
        "recall": f"CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fn} AS DOUBLE) END",
        "f1": f"CASE WHEN 2 * {tp} + {fp} + {fn} = 0 THEN 0.0 ELSE CAST(2 * {tp} AS DOUBLE) / CAST(2 * {tp} + {fp} + {fn} AS DOUBLE) END",
    }


def per_class_prf(df: DataFrame, label: str = "label", prediction: str = "prediction", k: int = K) -> DataFrame:
    """AG18: tp / fp / fn / support / precision / recall / F1 per class;
    a class that is never predicted gets precision 0 (no division error)."""
    row = confusion_row(df, label, prediction, k)
    parts = []
    for i in range(k):
        e = _class_exprs(i, k)
        parts.append(f"{i}, {e['tp']}, {e['fp']}, {e['fn']}, {e['support']}, {e['precision']}, {e['recall']}, {e['f1']}")
    out = row.selectExpr(f"stack({k}, {', '.join(parts)}) AS (label, tp, fp, fn, support, precision, recall, f1)")
    return out.select(
        F.col("label").cast("int"),
        *[F.col(c).cast("long") for c in ("tp", "fp", "fn", "support")],
        "precision",
        "recall",
        "f1",
    )


def eval_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", k: int = K, per_class: dict | None = None,
                 by: tuple[str, ...] = ()) -> DataFrame:
    """ML15: accuracy, weighted and macro F1, weighted precision / recall.

    ``f1_weighted`` is what MLlib's evaluator calls "f1"; ``f1_macro`` is the
    plain mean of per-class F1 -- both are reported, under their own names.
    ``per_class`` adds columns from the same row: name -> (class, metric);
    ``by`` gives one row for each of its values."""
    row = confusion_row(df, label, prediction, k, by)
    E = [_class_exprs(i, k) for i in range(k)]

    def weighted(m):
        return "(" + " + ".join(f"CAST({E[i]['support']} AS DOUBLE) * ({E[i][m]})" for i in range(k)) + ") / CAST(n AS DOUBLE)"

    exprs = [
        *by,
        "n",
        "CAST(" + " + ".join(f"c{i}{i}" for i in range(k)) + " AS DOUBLE) / CAST(n AS DOUBLE) AS accuracy",
        weighted("f1") + " AS f1_weighted",
        "(" + " + ".join(f"({E[i]['f1']})" for i in range(k)) + f") / {k}.0 AS f1_macro",
        weighted("precision") + " AS precision_weighted",
        weighted("recall") + " AS recall_weighted",
        *(f"{E[i][m]} AS {name}" for name, (i, m) in (per_class or {}).items()),
    ]
    return row.selectExpr(*exprs)

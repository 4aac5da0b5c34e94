"""Multinomial naive Bayes as relations: grouped sums, joins and one aggregate per document.

The model is two small tables: the classes with their log priors, and for every vocabulary term one row with its log
likelihood in each class.  Both come from one pass over the training documents' terms (partial sums per task); the second is as long
as the vocabulary, which is bounded by ``vocab_size``, so it is broadcast: terms are looked up where the document is read, and only sums
per document move, in one shuffle by document.  The numbers are those of MLlib's estimator on the same TF-IDF features (same smoothing, same priors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.functions.text import bigrams, explode_rows, tokens, without_stop_words
from revlens.operators.words import idf_weights, vocabulary

LABELS = (0, 1, 2)
KINDS = (("u", "words_filtered"), ("b", "bigrams"))


def with_terms(rows: DataFrame, text: str = "cleaned_text") -> DataFrame:
    """Adds the filtered words and their bigrams of the cleaned text."""
    return rows.withColumn("words_filtered", without_stop_words(tokens(text))).withColumn("bigrams", bigrams("words_filtered"))


def weighted_vocabulary(train: DataFrame, min_df: int = 5, vocab_size: int = 10000) -> DataFrame:
    """``(kind, term, idf)``: the unigrams and bigrams of the training documents."""
    n = train.agg(F.count(F.lit(1))).scalar()
    parts = [idf_weights(vocabulary(train, col, min_df, vocab_size), n).select(F.lit(kind).alias("kind"), "term", "idf") for kind, col in KINDS]
    return parts[0].unionByName(parts[1])


def document_terms(rows: DataFrame, vocab: DataFrame, keep: tuple[str, ...] = ("Id",)) -> DataFrame:
    """``(*keep, kind, term, value)``: one row per occurrence of a vocabulary term; a document's value of a term is their sum.

    Words and pairs come from one reading of the rows, the pairs known by their blank.  ``vocab`` has at most two times ``vocab_size``
    rows.  Without the hint Spark, which can't know that, moves and sorts every word of every document to meet it."""
    both = F.concat(*(F.coalesce(col, F.array().cast("array<string>")) for _, col in KINDS))
    terms = rows.select(*keep, *explode_rows(both, "term")).where(F.col("term").isNotNull())
    kind = F.when(F.col("term").contains(" "), KINDS[1][0]).otherwise(KINDS[0][0])
    return terms.withColumn("kind", kind).join(F.broadcast(vocab), ["kind", "term"]).withColumnRenamed("idf", "value")


def _per_label(value: Column, labels, name: str):
    return [F.coalesce(F.sum(F.when(F.col("label") == k, value)), F.lit(0.0)).alias(f"{name}_{k}") for k in labels]


def fit(train: DataFrame, vocab: DataFrame, smoothing: float = 1.0, labels=LABELS) -> tuple[DataFrame, DataFrame]:
    """``(priors, likelihoods)``: one row ``prior_k``, and ``(kind, term, idf, like_k)`` for every vocabulary term.

    ``train`` has Id, label and terms (``with_terms``)."""
    docs = train.agg(*(F.count_if(F.col("label") == k).cast("double").alias(f"n_{k}") for k in labels))
    total = sum((F.col(f"n_{k}") for k in labels), F.lit(0.0))
    priors = docs.select(*((F.ln(F.col(f"n_{k}") + smoothing) - F.ln(total + len(labels) * smoothing)).alias(f"prior_{k}") for k in labels))
    sums = document_terms(train, vocab, ("label",)).groupBy("kind", "term").agg(*_per_label(F.col("value"), labels, "sum"))
    every = vocab.join(sums, ["kind", "term"], "left").na.fill(0.0)
    size = every.agg(F.count(F.lit(1)).alias("terms"), *(F.sum(f"sum_{k}").alias(f"all_{k}") for k in labels))
    logs = [(F.ln(F.col(f"sum_{k}") + smoothing) - F.ln(F.col(f"all_{k}") + smoothing * F.col("terms"))).alias(f"like_{k}") for k in labels]
    return priors, every.crossJoin(F.broadcast(size)).select("kind", "term", "idf", *logs)  # ``size`` is one row


def predict(rows: DataFrame, priors: DataFrame, likelihoods: DataFrame, labels=LABELS, keep: tuple[str, ...] = ("label",)) -> DataFrame:
    """Id, the columns ``keep``, log_score_k, prediction (the largest score, ties: the smaller label), prob (array of the class probabilities) and
    confidence (the largest of them) of every row; a document without vocabulary terms is judged by the priors."""
    value = [F.sum(F.col("value") * F.col(f"like_{k}")).alias(f"s_{k}") for k in labels]
    scored = document_terms(rows, likelihoods).groupBy("Id").agg(*value)
    got = rows.select("Id", *keep).join(scored, "Id", "left").crossJoin(F.broadcast(priors))  # ``priors`` is one row
    got = got.select("Id", *keep, *((F.coalesce(f"s_{k}", F.lit(0.0)) + F.col(f"prior_{k}")).alias(f"log_score_{k}") for k in labels))
    best = F.array_max(F.array(*(F.struct(F.col(f"log_score_{k}").alias("s"), F.lit(-k).alias("k")) for k in labels)))
    got = got.withColumn("prediction", -best["k"]).withColumn("top", best["s"])
    part = [F.exp(F.col(f"log_score_{k}") - F.col("top")) for k in labels]  # the largest is 1, so none overflows
    total = sum(part[1:], part[0])
    return got.withColumn("prob", F.array(*(x / total for x in part))).withColumn("confidence", 1 / total).drop("top")

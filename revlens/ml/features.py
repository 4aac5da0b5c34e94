"""TF-IDF featuriser: an MLlib Pipeline fitted on the training split only.

Stages: tokenise -> stop words -> bigrams -> two CountVectorizers (unigram,
bigram) -> two IDFs -> assemble.  Fitting is distributed (the vocabulary is
a distributed word count whose top ``vocab_size`` terms reach the driver;
IDF is a tree aggregate of a vocabulary-sized vector), so the driver holds
O(vocabulary), never O(rows).
"""

from __future__ import annotations

from functools import partial

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import IDF, CountVectorizer, NGram, RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.constants import MLLIB_ENGLISH_STOP_WORDS
from revlens.functions.text import bigrams, tokens, without_stop_words


# --- fixed values: text that betrays mark-up or addresses inside a term.
ARTIFACTS = ("href", "http", "www", "quot", "nbsp")


def feature_pipeline(vocab_size: int = 10000, min_df: float = 5, min_doc_freq: int = 5) -> Pipeline:
    stages = [
        # whitespace tokens of the (already lower-cased, trimmed) cleaned text;
        # unlike Tokenizer this never yields an empty token
        RegexTokenizer(inputCol="cleaned_text", outputCol="words_raw", pattern="\\s+", gaps=True, toLowercase=True),
        StopWordsRemover(inputCol="words_raw", outputCol="words_filtered", stopWords=list(MLLIB_ENGLISH_STOP_WORDS)),
        NGram(n=2, inputCol="words_filtered", outputCol="bigrams"),
        CountVectorizer(inputCol="words_filtered", outputCol="tf_unigram", vocabSize=vocab_size, minDF=min_df),
        CountVectorizer(inputCol="bigrams", outputCol="tf_bigram", vocabSize=vocab_size, minDF=min_df),
        IDF(inputCol="tf_unigram", outputCol="tfidf_unigram", minDocFreq=min_doc_freq),
        IDF(inputCol="tf_bigram", outputCol="tfidf_bigram", minDocFreq=min_doc_freq),
        VectorAssembler(inputCols=["tfidf_unigram", "tfidf_bigram"], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """What ``model.transform`` gives for rows with a ``clean_text``, with the words, stop words and bigrams as built-in expressions.

    As MLlib stages these are three functions that each turn an array of strings into Java strings and back.  Their
    parameters are read from the fitted stages; stages of other kinds or parameters run as they are."""
    for s in model.stages:
        if isinstance(s, RegexTokenizer) and (s.getPattern(), s.getGaps(), s.getMinTokenLength()) == ("\\s+", True, 1):
            df = df.withColumn(s.getOutputCol(), tokens(s.getInputCol()))
        elif isinstance(s, StopWordsRemover):
            df = df.withColumn(s.getOutputCol(), without_stop_words(s.getInputCol(), [w.lower() for w in s.getStopWords()]))
        elif isinstance(s, NGram) and s.getN() == 2:
            df = df.withColumn(s.getOutputCol(), bigrams(s.getInputCol()))
        else:
            df = s.transform(df)
    return df


def fit(pipeline: Pipeline, rows: DataFrame) -> PipelineModel:
    """``pipeline.fit(rows)``, each estimator reading the columns that ``transform`` makes."""
    fitted = []
    for s in pipeline.getStages():
        fitted.append(s.fit(rows) if isinstance(s, Estimator) else s)
        rows = transform(PipelineModel(fitted[-1:]), rows)
    return PipelineModel(fitted)


def with_label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """ML07: label 0/1/2 -> double ``label_idx`` (a cast, so an absent class
    can never shift the indexes the way a fitted StringIndexer would)."""
    return df.withColumn("label_idx", F.col(label).cast("double")) if label in df.columns else df


def vocab_sizes(model: PipelineModel) -> tuple[int, int]:
    cvs = [s for s in model.stages if hasattr(s, "vocabulary")]
    return len(cvs[0].vocabulary), len(cvs[1].vocabulary)


def _among(kept, t):
    return t.isin(*kept)


def with_counts(model: PipelineModel, transformed: DataFrame) -> DataFrame:
    """FN19/UD04: ``dimension`` and ``non_zeros`` of a row's features, without making vectors dense.

    A term counts if the vocabulary holds it and its IDF is not 0.  The vocabularies (bounded by
    ``vocab_size``) go into the plan as hash sets of literals."""
    cvs = [s for s in model.stages if hasattr(s, "vocabulary")]
    idfs = [s for s in model.stages if hasattr(s, "idf")]
    count = F.lit(0)
    for cv, idf, col in zip(cvs, idfs, ("words_filtered", "bigrams"), strict=True):
        kept = [t for t, w in zip(cv.vocabulary, idf.idf.toArray(), strict=True) if w != 0]
        if kept:
            count = count + F.size(F.filter(F.array_distinct(col), partial(_among, kept)))
    return transformed.withColumn("dimension", F.lit(sum(vocab_sizes(model)))).withColumn("non_zeros", count.cast("int"))


def feature_checks(model: PipelineModel, transformed: DataFrame, min_dim: int = 15000, max_dim: int = 25000) -> DataFrame:
    """ML16: one row per check (check, value, ok), computed on the executors.

    dimension within bounds, vocabulary sizes, no HTML/URL artifacts among the
    most frequent terms, labels are exactly {0,1,2}, and no empty feature
    vectors (``transformed`` comes from ``with_counts``)."""
    uni, bi = vocab_sizes(model)
    dim = uni + bi
    cv_uni = [s for s in model.stages if hasattr(s, "vocabulary")][0]
    top = cv_uni.vocabulary[:200]  # bounded by construction
    artifacts = sum(1 for t in top if any(a in t for a in ARTIFACTS))
    agg = transformed.agg(
        F.count_if(F.col("non_zeros") == 0).alias("empty_vectors"),
        F.count_distinct("label_idx").alias("n_labels"),
        F.min("label_idx").alias("min_label"),
        F.max("label_idx").alias("max_label"),
    )
    return agg.select(
        F.inline(
            F.array(
                F.struct(F.lit("feature_dimension").alias("check"), F.lit(float(dim)).alias("value"),
                         F.lit(min_dim <= dim <= max_dim).alias("ok")),
                F.struct(F.lit("unigram_vocabulary").alias("check"), F.lit(float(uni)).alias("value"), F.lit(uni > 0).alias("ok")),
                F.struct(F.lit("bigram_vocabulary").alias("check"), F.lit(float(bi)).alias("value"), F.lit(bi > 0).alias("ok")),
                F.struct(F.lit("artifact_terms_top200").alias("check"), F.lit(float(artifacts)).alias("value"),
                         F.lit(artifacts == 0).alias("ok")),
                F.struct(F.lit("label_classes").alias("check"), F.col("n_labels").cast("double").alias("value"),
                         ((F.col("n_labels") == 3) & (F.col("min_label") == 0) & (F.col("max_label") == 2)).alias("ok")),
                F.struct(F.lit("empty_vectors").alias("check"), F.col("empty_vectors").cast("double").alias("value"),
                         (F.col("empty_vectors") == 0).alias("ok")),
            )
        )
    )

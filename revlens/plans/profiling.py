"""EDA / profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions.labels import score_label
from revlens.operators import profile as P
from revlens.plans.oracle_base import MLLIB_STOP_SQL, clean, full_text, label_of, name_of, rhu, with_fixtures
from revlens.plans.registry import register
from revlens.sources.files import table
from revlens.sources.fixtures import review_facts, reviews
from revlens.sources.schemas import SCORED_COLUMNS

_NULL_UNION = "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, n_{c} AS null_count, {rhu(f'n_{c}', 't', 100, 2)} AS null_pct FROM a" for c in SCORED_COLUMNS
)


@register("null_profile", with_fixtures(
    "WITH a AS (SELECT count(*) AS t, " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS n_{c}" for c in SCORED_COLUMNS)
    + " FROM reviews)\n" + _NULL_UNION, "reviews"), ("AG01", "FL02"))
def q_null_profile(spark, sf_dir):
    return P.null_profile(reviews(spark, sf_dir))


@register("duplicate_profile", with_fixtures(
    f"""
WITH a AS (SELECT count(*) AS total, count(DISTINCT Text) AS distinct_values FROM reviews)
SELECT total, distinct_values, total - distinct_values AS duplicates,
       {rhu('total - distinct_values', 'total', 100, 2)} AS duplicate_pct FROM a""", "reviews"), ("AG02",))
def q_duplicate_profile(spark, sf_dir):
    return P.duplicate_profile(reviews(spark, sf_dir), "Text")


@register("label_distribution", with_fixtures(
    f"""
WITH g AS (SELECT {label_of()} AS label, count(*) AS count FROM reviews GROUP BY 1),
t AS (SELECT sum(count) AS total FROM g)
SELECT label, {name_of('label')} AS sentiment, count, {rhu('count', 'total', 100, 1)} AS pct FROM g, t""", "reviews"),
    ("AG03", "TK11"))
def q_label_distribution(spark, sf_dir):
    return P.class_distribution(review_facts(spark, sf_dir), score_label("Score"))


@register("text_length_summary", with_fixtures(
    """
WITH a AS (SELECT count(length(Text)) AS n, sum(length(Text)) AS sx,
                  sum(CAST(length(Text) AS HUGEINT) * length(Text)) AS sxx,
                  CAST(min(length(Text)) AS INTEGER) AS min_length, CAST(max(length(Text)) AS INTEGER) AS max_length FROM reviews)
SELECT n AS count, CAST(sx AS DOUBLE) / CAST(n AS DOUBLE) AS mean_length,
       CASE WHEN n < 2 THEN NULL ELSE
         sqrt(CAST(CAST(n AS HUGEINT) * sxx - CAST(sx AS HUGEINT) * sx AS DOUBLE) / CAST(CAST(n AS HUGEINT) * (n - 1) AS DOUBLE)) END
         AS stddev_length,
       min_length, max_length FROM a""", "reviews"), ("AG04", "FN07"))
def q_text_length_summary(spark, sf_dir):
    return P.text_length_summary(reviews(spark, sf_dir))


@register("text_length_by_class", with_fixtures(
    f"""
SELECT {label_of()} AS label, count(length(Text)) AS count,
       CAST(sum(length(Text)) AS DOUBLE) / CAST(count(length(Text)) AS DOUBLE) AS mean_length
FROM reviews GROUP BY 1""", "reviews"), ("AG04",))
def q_text_length_by_class(spark, sf_dir):
    return P.text_length_by_class(reviews(spark, sf_dir), score_label("Score"))


@register("text_length_histogram", with_fixtures(
    """
SELECT CAST(least(least(length(Text), 3000) // 60, 49) AS INTEGER) AS bin,
       CAST(least(least(length(Text), 3000) // 60, 49) AS INTEGER) * 60 AS bin_lo,
       (CAST(least(least(length(Text), 3000) // 60, 49) AS INTEGER) + 1) * 60 AS bin_hi,
       count(*) AS count
FROM reviews GROUP BY 1""", "reviews"), ("AG05", "FL13"))
def q_text_length_histogram(spark, sf_dir):
    return P.text_length_histogram(reviews(spark, sf_dir))


@register("text_length_quartiles", with_fixtures(
    f"""
SELECT {label_of()} AS label, CAST(min(least(length(Text), 3000)) AS INTEGER) AS min_length,
       quantile_cont(least(length(Text), 3000), 0.25) AS q1,
       quantile_cont(least(length(Text), 3000), 0.5) AS median,
       quantile_cont(least(length(Text), 3000), 0.75) AS q3,
       CAST(max(least(length(Text), 3000)) AS INTEGER) AS max_length
FROM reviews GROUP BY 1""", "reviews"), ("AG06",))
def q_text_length_quartiles(spark, sf_dir):
    return P.text_length_quartiles(reviews(spark, sf_dir), score_label("Score"))


def _top_words_sql(k: int, weights: bool) -> str:
    w = ", CAST(count AS DOUBLE) / CAST(max(count) OVER (PARTITION BY label) AS DOUBLE) AS weight" if weights else ""
    return with_fixtures(
        f"""
WITH t AS (SELECT {label_of()} AS label, unnest(string_split({clean(full_text())}, ' ')) AS word FROM reviews),
c AS (SELECT label, word, count(*) AS count FROM t
      WHERE word <> '' AND NOT list_contains({MLLIB_STOP_SQL}, word) GROUP BY label, word),
r AS (SELECT label, word, count, row_number() OVER (PARTITION BY label ORDER BY count DESC, word) AS rank FROM c)
SELECT label, word, count, CAST(rank AS INTEGER) AS rank{w} FROM r WHERE rank <= {k}""",
        "reviews",
    )


@register("top_words_by_class", _top_words_sql(20, False), ("AG08", "ML02"))
def q_top_words(spark, sf_dir):
    return P.top_words_by_class(reviews(spark, sf_dir), score_label("Score"), 20)


@register("wordcloud_weights", _top_words_sql(150, True), ("AG09",))
def q_wordcloud(spark, sf_dir):
    return P.wordcloud_weights(reviews(spark, sf_dir), score_label("Score"), 150)


@register("row_bytes_estimate", None, ("AG07",))
def q_row_bytes(spark, sf_dir):
    # JSON text formatting differs between engines, so this is rows-only.
    return P.row_bytes_estimate(reviews(spark, sf_dir))


@register("sample_rows", None, ("SO06",))
def q_sample_rows(spark, sf_dir):
    """SO06: Bernoulli 10% sample with a fixed seed (a sampling operator)."""
    return review_facts(spark, sf_dir).sample(fraction=0.10, seed=42).select("Id", "ProductId", "Score")


@register("event_props", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""", ("PJ03", "FN20"))
def q_event_props(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


@register("distinct_sketches", with_fixtures("""
SELECT count(DISTINCT ProductId) AS exact_products, count(DISTINCT UserId) AS exact_users, true AS products_in_bound, true AS users_in_bound,
       true AS batches_agree FROM reviews""", "reviews"), ("AG12",))
def q_distinct_sketches(spark, sf_dir):
    """Distinct products and reviewers from one sketch a month, merged: within 5 % (three standard errors) of the exact counts, and
    within 3.3 % (two) of what another cut of the rows into batches gives (the estimator depends on the order of merging, the bound doesn't)."""
    from revlens.operators import sketches as SK

    r = review_facts(spark, sf_dir).select("ProductId", "UserId", F.date_format("processed_at", "yyyy-MM").alias("month"))
    names = {"products": "ProductId", "users": "UserId"}
    months = SK.distinct_estimates(SK.batch_summaries(r, "month", names), list(names))
    halves = SK.distinct_estimates(SK.batch_summaries(r.withColumn("half", F.pmod(F.xxhash64("UserId"), F.lit(2))), "half", names), list(names))
    exact = r.agg(F.count_distinct("ProductId").alias("exact_products"), F.count_distinct("UserId").alias("exact_users"))
    got = exact.crossJoin(F.broadcast(months)).crossJoin(F.broadcast(halves.toDF("p2", "u2")))  # one row each
    near = lambda a, b, share=0.05: F.abs(F.col(a) - F.col(b)) <= F.ceil(share * F.col(b))
    return got.select("exact_products", "exact_users", near("products", "exact_products").alias("products_in_bound"),
                      near("users", "exact_users").alias("users_in_bound"),
                      (near("products", "p2", 0.033) & near("users", "u2", 0.033)).alias("batches_agree"))


@register("length_quantile_sketches", with_fixtures("""
SELECT label, CAST(rk AS DOUBLE) AS rank, count(*) AS n, true AS in_bound
FROM (SELECT CASE WHEN Score <= 2 THEN 0 WHEN Score = 3 THEN 1 ELSE 2 END AS label FROM reviews), (VALUES (0.05), (0.25), (0.5), (0.75), (0.95), (0.99)) q(rk)
GROUP BY label, rk""", "reviews"), ("AG06",))
def q_length_quantiles(spark, sf_dir):
    """Quantiles of the unclipped text length per class from one sketch per month and class, merged; each estimate's true rank
    lies within 3 % of the asked one."""
    from revlens.operators import sketches as SK

    r = reviews(spark, sf_dir).select(score_label("Score").alias("label"), F.length("Text").alias("length"), F.date_format("processed_at", "yyyy-MM").alias("month"))
    batches = r.groupBy("month", "label").agg(F.kll_sketch_agg_bigint(F.col("length").cast("long"), F.lit(SK.KLL_K)).alias("kll"))
    estimates = SK.merged_quantiles(batches, ["label"], (0.05, 0.25, 0.5, 0.75, 0.95, 0.99))
    return SK.rank_errors(r, "length", estimates, ["label"]).select("label", "rank", "n", (F.col("rank_error") <= 0.03).alias("in_bound"))

"""Dashboard, product and monitoring queries over the scored-review view."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.operators import metrics as M
from revlens.plans.oracle_base import correct, month_of, rhu, status, with_fixtures
from revlens.plans.registry import register
from revlens.sources.fixtures import review_facts

# ------------------------------------------------------------------- kpis
KPIS_SQL = with_fixtures(
    f"""
WITH a AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_count,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_count,
         count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_count,
         sum(Score) AS ss, count(Score) AS sn,
         count(DISTINCT ProductId) AS unique_products,
         count(*) FILTER (WHERE {correct()}) AS correct_predictions
  FROM reviews)
SELECT total, positive_count, negative_count, neutral_count,
       {rhu('positive_count', 'total', 100, 1)} AS positive_pct,
       {rhu('negative_count', 'total', 100, 1)} AS negative_pct,
       {rhu('neutral_count', 'total', 100, 1)} AS neutral_pct,
       {rhu('ss', 'sn', 1, 2)} AS avg_score,
       unique_products, correct_predictions,
       {rhu('correct_predictions', 'total', 100, 1)} AS model_accuracy,
       {rhu('positive_count - negative_count', 'total', 1, 3)} AS health_index
FROM a""",
    "reviews",
)


@register("kpis", KPIS_SQL, ("AG12", "AG11", "AG30", "PJ12", "FN14", "FN15"))
def q_kpis(spark, sf_dir):
    return M.kpis(review_facts(spark, sf_dir))


@register("insights", with_fixtures(
    f"""
WITH a AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS p,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS n,
         sum(Score) AS ss, count(Score) AS sn, count(DISTINCT ProductId) AS up,
         count(*) FILTER (WHERE {correct()}) AS c
  FROM reviews),
k AS (
  SELECT {rhu('p', 'total', 100, 1)} AS positive_pct, {rhu('n', 'total', 100, 1)} AS negative_pct,
         {rhu('ss', 'sn', 1, 2)} AS avg_score, up AS unique_products, {rhu('c', 'total', 100, 1)} AS model_accuracy
  FROM a)
SELECT 1 AS line_no,
       CASE WHEN negative_pct > 30 THEN 'ALERT' ELSE 'OK' END AS severity,
       CASE WHEN negative_pct > 30
            THEN 'High negative sentiment (' || CAST(negative_pct AS VARCHAR) || '%) - investigate top products'
            ELSE 'Overall sentiment healthy with ' || CAST(positive_pct AS VARCHAR) || '% positive reviews' END AS message
FROM k
UNION ALL SELECT 2, 'MODEL', 'Model accuracy: ' || CAST(model_accuracy AS VARCHAR) || '%' FROM k
UNION ALL SELECT 3, 'INFO', 'Monitoring ' || CAST(unique_products AS VARCHAR) || ' unique products' FROM k
UNION ALL SELECT 4, 'INFO', 'Average rating: ' || CAST(avg_score AS VARCHAR) || '/5 stars' FROM k""",
    "reviews"), ("PJ16",))
def q_insights(spark, sf_dir):
    return M.insights(M.kpis(review_facts(spark, sf_dir)))


_COUNTS = """
  SELECT ProductId, count(*) AS review_count,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_count,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_count,
         count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_count,
         sum(Score) AS score_sum, count(Score) AS score_n, max(processed_at) AS last_updated
  FROM reviews GROUP BY ProductId"""

PRODUCT_METRICS_SQL = with_fixtures(
    f"""
WITH c AS ({_COUNTS})
SELECT ProductId, review_count, positive_count, negative_count, neutral_count,
       {rhu('2 * positive_count + neutral_count', 'review_count', 1, 2)} AS avg_sentiment,
       {rhu('positive_count', 'review_count', 1, 2)} AS positive_ratio,
       {rhu('negative_count', 'review_count', 1, 2)} AS negative_ratio,
       {rhu('neutral_count', 'review_count', 1, 2)} AS neutral_ratio,
       last_updated
FROM c""",
    "reviews",
)


@register("product_metrics", PRODUCT_METRICS_SQL, ("AG10", "PJ08", "SK03"))
def q_product_metrics(spark, sf_dir):
    return M.product_metrics(review_facts(spark, sf_dir))


def _health_sql(n="review_count"):
    return f"""{rhu('positive_count', n, 100, 1)} AS positive_pct,
       {rhu('negative_count', n, 100, 1)} AS negative_pct,
       {rhu('positive_count - negative_count', n, 1, 2)} AS health_score,
       {status('positive_count', 'negative_count', n)} AS status"""


@register("product_status", with_fixtures(
    f"""
WITH c AS ({_COUNTS})
SELECT ProductId, review_count, positive_count, negative_count, {_health_sql()}
FROM c""", "reviews"), ("PJ09",))
def q_product_status(spark, sf_dir):
    return M.product_health(review_facts(spark, sf_dir))


@register("top_products", with_fixtures(
    f"""
WITH c AS ({_COUNTS})
SELECT ProductId AS product_id, review_count AS total, {_health_sql()}
FROM c ORDER BY review_count DESC, ProductId LIMIT 6""", "reviews"), ("TK01",))
def q_top_products(spark, sf_dir):
    return M.top_products(review_facts(spark, sf_dir), 6)


@register("top3_products", with_fixtures(
    f"""
WITH c AS ({_COUNTS})
SELECT (SELECT count(*) FROM c) AS product_count, ProductId AS product_id, review_count,
       {rhu('positive_count', 'review_count', 100, 0)} AS positive_pct
FROM c ORDER BY review_count DESC, ProductId LIMIT 3""", "reviews"), ("AG33",))
def q_top3(spark, sf_dir):
    return M.top3_report(review_facts(spark, sf_dir), 3)


_WATCHLIST_CTES = f"""
c AS ({_COUNTS}),
p AS (
  SELECT ProductId AS product_id, review_count AS total, {_health_sql()},
         {rhu('10 * positive_count + 5 * neutral_count', '2 * review_count', 1, 1)} AS avg_score,
         {rhu('review_count + positive_count - negative_count', '2 * review_count', 100, 1)} AS gauge_pct
  FROM c),
w AS (SELECT * FROM p ORDER BY health_score ASC, product_id ASC LIMIT 50)"""


@register("watchlist", with_fixtures(f"WITH {_WATCHLIST_CTES} SELECT * FROM w", "reviews"), ("AG20", "TK04", "PJ11", "PJ13", "SC06"))
def q_watchlist(spark, sf_dir):
    return M.watchlist(review_facts(spark, sf_dir), "health_score", "asc")


@register("watchlist_status_counts", with_fixtures(
    f"""WITH {_WATCHLIST_CTES}
SELECT count(*) FILTER (WHERE status = 'ALERT') AS alerts,
       count(*) FILTER (WHERE status = 'WATCH') AS watches,
       count(*) FILTER (WHERE status = 'OK') AS oks
FROM w""", "reviews"), ("AG20",))
def q_watchlist_status_counts(spark, sf_dir):
    return M.watchlist_status_counts(M.watchlist(review_facts(spark, sf_dir)))


@register("product_picker", with_fixtures(
    f"""
WITH c AS ({_COUNTS}),
h AS (SELECT ProductId, row_number() OVER (ORDER BY review_count DESC, ProductId) AS shortcut_rank
      FROM c ORDER BY review_count DESC, ProductId LIMIT 10)
SELECT c.ProductId AS product_id, c.review_count, CAST(h.shortcut_rank AS INTEGER) AS shortcut_rank,
       coalesce(h.shortcut_rank = 1, false) AS is_default,
       greatest((SELECT count(*) FROM c) - 10, 0) AS remaining
FROM c LEFT JOIN h ON c.ProductId = h.ProductId""", "reviews"), ("TK03",))
def q_product_picker(spark, sf_dir):
    return M.product_picker(review_facts(spark, sf_dir), 10)


@register("product_card", with_fixtures(
    f"""
WITH c AS ({_COUNTS})
SELECT ProductId AS product_id, review_count AS total, positive_count, negative_count, neutral_count,
       {rhu('score_sum', 'score_n', 1, 1)} AS avg_score,
       {rhu('positive_count - negative_count', 'review_count', 1, 2)} AS health_score,
       {status('positive_count', 'negative_count', 'review_count')} AS status
FROM c""", "reviews"), ("AG24", "AG22", "FN21"))
def q_product_card(spark, sf_dir):
    return M.product_card(review_facts(spark, sf_dir))


@register("product_recent_reviews", with_fixtures(
    """
SELECT ProductId, Id, Score, predicted_sentiment, confidence, processed_at, CAST(rank AS INTEGER) AS rank FROM (
  SELECT ProductId, Id, Score, predicted_sentiment, confidence, processed_at,
         row_number() OVER (PARTITION BY ProductId ORDER BY processed_at DESC, Id DESC) AS rank
  FROM reviews) WHERE rank <= 10""", "reviews"), ("TK02",))
def q_recent(spark, sf_dir):
    return M.product_recent_reviews(review_facts(spark, sf_dir), 10)


@register("score_sentiment_mismatch", with_fixtures(
    """
SELECT ProductId, Id, Score, predicted_sentiment, processed_at, score_sentiment, CAST(rank AS INTEGER) AS rank FROM (
  SELECT ProductId, Id, Score, predicted_sentiment, processed_at, score_sentiment,
         row_number() OVER (PARTITION BY ProductId ORDER BY processed_at DESC, Id DESC) AS rank
  FROM (SELECT *, CASE WHEN Score BETWEEN 1 AND 2 THEN 'negative' WHEN Score = 3 THEN 'neutral'
                       WHEN Score BETWEEN 4 AND 5 THEN 'positive' END AS score_sentiment FROM reviews)
  WHERE score_sentiment <> predicted_sentiment) WHERE rank <= 5""", "reviews"), ("FL09",))
def q_mismatch(spark, sf_dir):
    return M.score_sentiment_mismatch(review_facts(spark, sf_dir), 5)


@register("score_distribution", with_fixtures(
    f"""
WITH a AS (SELECT Score, count(*) AS c FROM reviews GROUP BY Score),
t AS (SELECT count(*) AS total FROM reviews),
s AS (SELECT * FROM (VALUES (5), (4), (3), (2), (1)) v(star))
SELECT CAST(s.star AS INTEGER) AS star, CAST(coalesce(a.c, 0) AS BIGINT) AS count,
       {rhu('coalesce(a.c, 0)', 't.total', 100, 1)} AS pct
FROM s LEFT JOIN a ON a.Score = s.star, t""", "reviews"), ("AG21",))
def q_score_distribution(spark, sf_dir):
    return M.score_distribution(review_facts(spark, sf_dir))


def _trend_sql(by_product: bool) -> str:
    key = "ProductId, " if by_product else ""
    part = "PARTITION BY ProductId " if by_product else ""
    g = f"""
WITH g AS (
  SELECT {key}{month_of()} AS month,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative,
         count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive
  FROM reviews GROUP BY {key}{month_of()}),
r AS (SELECT *, row_number() OVER ({part}ORDER BY month DESC) AS _r FROM g)
SELECT {'ProductId AS product_id, ' if by_product else ''}month, negative, neutral, positive FROM r WHERE _r <= 12"""
    return with_fixtures(g, "reviews")


@register("monthly_trend", _trend_sql(False), ("AG14", "TK06", "FN11"))
def q_monthly_trend(spark, sf_dir):
    return M.monthly_trend(review_facts(spark, sf_dir), 12)


@register("product_trend", _trend_sql(True), ("AG23",))
def q_product_trend(spark, sf_dir):
    return M.product_trend(review_facts(spark, sf_dir), 12)


@register("helpfulness", with_fixtures(
    f"""
WITH r AS (SELECT * FROM reviews WHERE HelpfulnessDenominator > 0),
g AS (
  SELECT predicted_sentiment AS sentiment, count(*) AS rated_reviews,
         sum(HelpfulnessNumerator) AS num, sum(HelpfulnessDenominator) AS den
  FROM r GROUP BY predicted_sentiment
  UNION ALL
  SELECT 'all', count(*), sum(HelpfulnessNumerator), sum(HelpfulnessDenominator) FROM r)
SELECT sentiment, rated_reviews, {rhu('num', 'den', 100, 1)} AS helpful_pct FROM g""", "reviews"), ("AG25",))
def q_helpfulness(spark, sf_dir):
    return M.helpfulness(review_facts(spark, sf_dir))


@register("session_stats", with_fixtures(
    f"""
WITH a AS (
  SELECT count(*) AS cnt,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS p,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS n,
         sum(CAST(confidence AS DECIMAL(9,8))) AS conf
  FROM reviews)
SELECT cnt AS count, {rhu('p', 'cnt', 100, 0)} AS positive_pct, {rhu('n', 'cnt', 100, 0)} AS negative_pct,
       greatest(0.0, 100 - {rhu('p', 'cnt', 100, 0)} - {rhu('n', 'cnt', 100, 0)}) AS neutral_pct,
       round(CAST(conf * 100 AS DOUBLE) / cnt, 1) AS avg_confidence_pct
FROM a""", "reviews"), ("AG31", "ST09"))
def q_session_stats(spark, sf_dir):
    return M.session_stats(review_facts(spark, sf_dir))


_BATCHES = f"""
  SELECT CAST(Time // 86400 AS BIGINT) AS batch_id, count(*) AS total_processed,
         count(*) FILTER (WHERE {correct()}) AS correct_predictions, max(processed_at) AS processed_at
  FROM reviews GROUP BY CAST(Time // 86400 AS BIGINT)"""

BATCH_SQL = with_fixtures(
    f"""
WITH b AS ({_BATCHES})
SELECT batch_id, {rhu('correct_predictions', 'total_processed', 1, 4)} AS accuracy,
       total_processed, correct_predictions, 'models/final' AS model_path, processed_at
FROM b""",
    "reviews",
)


@register("batch_accuracy", BATCH_SQL, ("AG13", "FL06", "ST06", "SK04", "SC08"))
def q_batch_accuracy(spark, sf_dir):
    return M.batch_metrics(review_facts(spark, sf_dir))


@register("latest_batch_metric", with_fixtures(
    f"""
WITH b AS ({_BATCHES})
SELECT batch_id, {rhu('correct_predictions', 'total_processed', 1, 4)} AS accuracy,
       total_processed, correct_predictions, 'models/final' AS model_path, processed_at
FROM b ORDER BY processed_at DESC, batch_id DESC LIMIT 1""", "reviews"), ("SC07", "AG32"))
def q_latest_batch(spark, sf_dir):
    return M.latest_batch_metric(M.batch_metrics(review_facts(spark, sf_dir)))


@register("pipeline_health", with_fixtures(
    f"""
WITH b AS (
  SELECT CAST(Time // 86400 AS BIGINT) AS batch_id, count(*) AS review_count,
         count(*) FILTER (WHERE predicted_sentiment = 'positive') AS positive_count,
         count(*) FILTER (WHERE predicted_sentiment = 'negative') AS negative_count,
         count(*) FILTER (WHERE predicted_sentiment = 'neutral') AS neutral_count,
         count(*) FILTER (WHERE {correct()}) AS correct, max(processed_at) AS processed_at
  FROM reviews GROUP BY 1),
l AS (SELECT correct, review_count FROM b ORDER BY processed_at DESC, batch_id DESC LIMIT 1),
g AS (SELECT CAST(sum(review_count) AS BIGINT) AS total, CAST(sum(positive_count) AS BIGINT) AS positive_count,
             CAST(sum(negative_count) AS BIGINT) AS negative_count, CAST(sum(neutral_count) AS BIGINT) AS neutral_count,
             count(*) AS batches FROM b)
SELECT total, positive_count, negative_count, neutral_count,
       {rhu('positive_count', 'total', 100, 1)} AS positive_pct,
       {rhu('negative_count', 'total', 100, 1)} AS negative_pct,
       {rhu('neutral_count', 'total', 100, 1)} AS neutral_pct,
       {rhu('l.correct', 'l.review_count', 1, 4)} AS latest_accuracy,
       CAST(l.review_count AS BIGINT) AS latest_total_processed,
       coalesce(total, 0) > 0 AS has_reviews, batches > 0 AS has_metrics
FROM g, l""", "reviews"), ("AG29",))
def q_pipeline_health(spark, sf_dir):
    return M.pipeline_health(review_facts(spark, sf_dir))

"""Dashboard and monitoring metrics over scored reviews.

Input: a scored-review DataFrame (``SCORED_REVIEW`` columns).  Every report is
one aggregation job (conditional counts fused into a single pass) instead of
one count job per number.  Ratios are rounded from integer counts
(``ratio_half_up``) so they are exact and engine-independent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.functions.constants import SENTIMENTS, WATCHLIST_SIZE
from revlens.functions.labels import health_status, is_correct
from revlens.functions.numeric import ratio_half_up
from revlens.operators.topk import top_k, top_k_per_group

def _ps():
    return F.col("predicted_sentiment")


def _sentiment_counts():
    return [
        F.count(F.lit(1)).alias("review_count"),
        F.count_if(_ps() == "positive").alias("positive_count"),
        F.count_if(_ps() == "negative").alias("negative_count"),
        F.count_if(_ps() == "neutral").alias("neutral_count"),
    ]


# ---------------------------------------------------------------- KPIs (AG12)
def kpis(scored: DataFrame, approx_products: bool = False) -> DataFrame:
    """One-row KPI block: totals, class shares, average star, products, and
    the model's real accuracy against the star rating (no constants)."""
    products = F.approx_count_distinct("ProductId") if approx_products else F.count_distinct("ProductId")
    agg = scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_ps() == "positive").alias("positive_count"),
        F.count_if(_ps() == "negative").alias("negative_count"),
        F.count_if(_ps() == "neutral").alias("neutral_count"),
        F.sum("Score").alias("_score_sum"),
        F.count("Score").alias("_score_n"),
        products.alias("unique_products"),
        F.count_if(is_correct("predicted_sentiment", "Score")).alias("correct_predictions"),
    )
    return agg.select(
        "total",
        "positive_count",
        "negative_count",
        "neutral_count",
        ratio_half_up("positive_count", "total", 100, 1).alias("positive_pct"),
        ratio_half_up("negative_count", "total", 100, 1).alias("negative_pct"),
        ratio_half_up("neutral_count", "total", 100, 1).alias("neutral_pct"),
        ratio_half_up("_score_sum", "_score_n", 1, 2).alias("avg_score"),
        F.col("unique_products").cast("long").alias("unique_products"),
        "correct_predictions",
        ratio_half_up("correct_predictions", "total", 100, 1).alias("model_accuracy"),
        # PJ12: overall health index (positive share - negative share), 3 dp
        ratio_half_up("positive_count - negative_count", "total", 1, 3).alias("health_index"),
    )


def kpis_json(scored: DataFrame) -> DataFrame:
    """The KPI block as one JSON document (API payload)."""
    k = kpis(scored)
    return k.select(F.to_json(F.struct(*k.columns)).alias("json"))


def insights(kpi: DataFrame) -> DataFrame:
    """Dashboard insight lines with an explicit severity column."""
    s = lambda c: F.col(c).cast("string")
    lines = F.array(
        F.when(
            F.col("negative_pct") > 30,
            F.struct(
                F.lit(1).alias("line_no"),
                F.lit("ALERT").alias("severity"),
                F.concat(F.lit("High negative sentiment ("), s("negative_pct"), F.lit("%) - investigate top products")).alias("message"),
            ),
        ).otherwise(
            F.struct(
                F.lit(1).alias("line_no"),
                F.lit("OK").alias("severity"),
                F.concat(F.lit("Overall sentiment healthy with "), s("positive_pct"), F.lit("% positive reviews")).alias("message"),
            )
        ),
        F.struct(F.lit(2).alias("line_no"), F.lit("MODEL").alias("severity"),
                 F.concat(F.lit("Model accuracy: "), s("model_accuracy"), F.lit("%")).alias("message")),
        F.struct(F.lit(3).alias("line_no"), F.lit("INFO").alias("severity"),
                 F.concat(F.lit("Monitoring "), s("unique_products"), F.lit(" unique products")).alias("message")),
        F.struct(F.lit(4).alias("line_no"), F.lit("INFO").alias("severity"),
                 F.concat(F.lit("Average rating: "), s("avg_score"), F.lit("/5 stars")).alias("message")),
    )
    return kpi.select(F.inline(lines))


# ------------------------------------------------------ product roll-up (AG10)
def product_counts(scored: DataFrame, keys: tuple[str, ...] = ("ProductId",)) -> DataFrame:
    """Additive per-product counts: the mergeable state behind every product
    report (sums of these over batches equal the counts over all rows)."""
    return scored.groupBy(*keys).agg(
        *_sentiment_counts(),
        F.sum("Score").alias("score_sum"),
        F.count("Score").alias("score_n"),
        F.max("processed_at").alias("last_updated"),
    )


def merge_product_counts(counts: DataFrame) -> DataFrame:
    """Roll additive counts (e.g. one row per batch and product) up to products."""
    return counts.groupBy("ProductId").agg(
        *[F.sum(c).alias(c) for c in ("review_count", "positive_count", "negative_count", "neutral_count", "score_sum", "score_n")],
        F.max("last_updated").alias("last_updated"),
    )


def product_metrics_from_counts(counts: DataFrame) -> DataFrame:
    return counts.select(
        "ProductId",
        "review_count",
        "positive_count",
        "negative_count",
        "neutral_count",
        ratio_half_up("2 * positive_count + neutral_count", "review_count", 1, 2).alias("avg_sentiment"),
        ratio_half_up("positive_count", "review_count", 1, 2).alias("positive_ratio"),
        ratio_half_up("negative_count", "review_count", 1, 2).alias("negative_ratio"),
        ratio_half_up("neutral_count", "review_count", 1, 2).alias("neutral_ratio"),
        "last_updated",
    )


def product_metrics(scored: DataFrame) -> DataFrame:
    return product_metrics_from_counts(product_counts(scored))


def _health_cols():
    return [
        ratio_half_up("positive_count", "review_count", 100, 1).alias("positive_pct"),
        ratio_half_up("negative_count", "review_count", 100, 1).alias("negative_pct"),
        ratio_half_up("positive_count - negative_count", "review_count", 1, 2).alias("health_score"),
        health_status("positive_count", "negative_count", "review_count").alias("status"),
    ]


def product_health(scored: DataFrame) -> DataFrame:
    """PJ09: per product health score and OK / WATCH / ALERT status."""
    c = product_counts(scored)
    return c.select("ProductId", "review_count", "positive_count", "negative_count", *_health_cols())


# ------------------------------------------------------------- top-k reports
def top_products(scored: DataFrame, n: int = 6) -> DataFrame:
    """TK01: the n most-reviewed products with shares, health and status."""
    c = product_counts(scored)
    ranked = top_k(c, [F.desc("review_count"), F.asc("ProductId")], n)
    return ranked.select(F.col("ProductId").alias("product_id"), F.col("review_count").alias("total"), *_health_cols())


def top3_report(scored: DataFrame, n: int = 3) -> DataFrame:
    """AG33: product count plus the top products with rounded positive %."""
    c = product_counts(scored)
    n_products = c.agg(F.count(F.lit(1))).scalar()
    ranked = top_k(c, [F.desc("review_count"), F.asc("ProductId")], n)
    return ranked.select(
        n_products.alias("product_count"),
        F.col("ProductId").alias("product_id"),
        "review_count",
        ratio_half_up("positive_count", "review_count", 100, 0).alias("positive_pct"),
    )


SORT_KEYS = {
    "health_score": "health_score",
    "total": "total",
    "avg_score": "avg_score",
    "product_id": "product_id",
}


def watchlist(scored: DataFrame, sort_by: str = "health_score", order: str = "asc", size: int = WATCHLIST_SIZE) -> DataFrame:
    """AG20/TK04: every product with health, shares, 0-5 score and gauge,
    sorted by an allow-listed key (ties by product id), first ``size``."""
    c = product_counts(scored)
    products = c.select(
        F.col("ProductId").alias("product_id"),
        F.col("review_count").alias("total"),
        *_health_cols(),
        ratio_half_up("10 * positive_count + 5 * neutral_count", "2 * review_count", 1, 1).alias("avg_score"),
        ratio_half_up("review_count + positive_count - negative_count", "2 * review_count", 100, 1).alias("gauge_pct"),
    )
    key = SORT_KEYS.get(sort_by, "product_id")
    primary = F.desc(key) if order == "desc" else F.asc(key)
    return top_k(products, [primary, F.asc("product_id")], size)


def watchlist_status_counts(wl: DataFrame) -> DataFrame:
    return wl.agg(
        F.count_if(F.col("status") == "ALERT").alias("alerts"),
        F.count_if(F.col("status") == "WATCH").alias("watches"),
        F.count_if(F.col("status") == "OK").alias("oks"),
    )


def product_picker(scored: DataFrame, shortcuts: int = 10) -> DataFrame:
    """TK03: every product with its review count; the ``shortcuts`` most
    reviewed get a button rank (1 = default selection).

    The ranked head is a TakeOrderedAndProject of ``shortcuts`` rows, so the
    broadcast back onto the product list is bounded by that parameter; no
    global window puts all products into one task.
    """
    from pyspark.sql import Window

    c = product_counts(scored).select("ProductId", "review_count")
    head = top_k(c, [F.desc("review_count"), F.asc("ProductId")], shortcuts)
    head = head.select(
        "ProductId",
        F.row_number().over(Window.orderBy(F.desc("review_count"), F.asc("ProductId"))).alias("shortcut_rank"),
    )
    n_products = c.agg(F.count(F.lit(1))).scalar()
    out = c.join(F.broadcast(head), "ProductId", "left")
    return out.select(
        F.col("ProductId").alias("product_id"),
        "review_count",
        "shortcut_rank",
        F.coalesce(F.col("shortcut_rank") == 1, F.lit(False)).alias("is_default"),
        F.greatest(n_products - shortcuts, F.lit(0)).alias("remaining"),
    )


def product_card(scored: DataFrame) -> DataFrame:
    """AG24: per product totals, real class counts, average star, health."""
    c = product_counts(scored)
    return c.select(
        F.col("ProductId").alias("product_id"),
        F.col("review_count").alias("total"),
        "positive_count",
        "negative_count",
        "neutral_count",
        ratio_half_up("score_sum", "score_n", 1, 1).alias("avg_score"),
        ratio_half_up("positive_count - negative_count", "review_count", 1, 2).alias("health_score"),
        health_status("positive_count", "negative_count", "review_count").alias("status"),
    )


def product_recent_reviews(scored: DataFrame, k: int = 10) -> DataFrame:
    """TK02 for every product: its k newest reviews (ties by Id)."""
    cols = scored.select("ProductId", "Id", "Score", "predicted_sentiment", "confidence", "processed_at")
    return top_k_per_group(cols, ["ProductId"], [F.desc("processed_at"), F.desc("Id")], k)


def score_sentiment_mismatch(scored: DataFrame, k: int = 5) -> DataFrame:
    """FL09: per product, the k newest reviews whose star label disagrees
    with the predicted sentiment."""
    from revlens.functions.labels import label_name, score_label

    mm = scored.select(
        "ProductId", "Id", "Score", "predicted_sentiment", "processed_at",
        label_name(score_label("Score")).alias("score_sentiment"),
    ).where(F.col("score_sentiment") != F.col("predicted_sentiment"))
    return top_k_per_group(mm, ["ProductId"], [F.desc("processed_at"), F.desc("Id")], k)


# ------------------------------------------------------------ distributions
def score_distribution(scored: DataFrame) -> DataFrame:
    """AG21: stars 5..1 with count and share, zero-filled, in one pass."""
    one = scored.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("Score") == s).alias(f"c{s}") for s in range(1, 6)])
    rows = one.selectExpr("total", "stack(5, " + ", ".join(f"{s}, c{s}" for s in range(5, 0, -1)) + ") AS (star, count)")
    return rows.select(
        F.col("star").cast("int").alias("star"),
        F.col("count").cast("long").alias("count"),
        ratio_half_up("count", "total", 100, 1).alias("pct"),
    )


def monthly_trend(scored: DataFrame, months: int = 12) -> DataFrame:
    """AG14: counts per (UTC month, sentiment) pivoted to three columns with
    zero fill; the last ``months`` months, ascending."""
    m = scored.select(F.date_format(F.timestamp_seconds("Time"), "yyyy-MM").alias("month"), _ps())
    piv = m.groupBy("month").pivot("predicted_sentiment", list(SENTIMENTS)).count().na.fill(0)
    last = top_k(piv, [F.desc("month")], months)
    return last.select("month", *[F.col(s).cast("long").alias(s) for s in SENTIMENTS]).orderBy("month")


def product_trend(scored: DataFrame, months: int = 12) -> DataFrame:
    """AG23 for every product: its last ``months`` months of sentiment counts."""
    m = scored.select("ProductId", F.date_format(F.timestamp_seconds("Time"), "yyyy-MM").alias("month"), _ps())
    piv = m.groupBy("ProductId", "month").pivot("predicted_sentiment", list(SENTIMENTS)).count().na.fill(0)
    last = top_k_per_group(piv, ["ProductId"], [F.desc("month")], months, rank_col="_r")
    return last.select(F.col("ProductId").alias("product_id"), "month", *[F.col(s).cast("long").alias(s) for s in SENTIMENTS])


def helpfulness(scored: DataFrame) -> DataFrame:
    """AG25: helpful votes / total votes (rated reviews only), overall and
    per sentiment, via ROLLUP in one aggregation."""
    rated = scored.where(F.col("HelpfulnessDenominator") > 0)
    r = rated.rollup("predicted_sentiment").agg(
        F.count(F.lit(1)).alias("rated_reviews"),
        F.sum("HelpfulnessNumerator").alias("_num"),
        F.sum("HelpfulnessDenominator").alias("_den"),
        F.grouping("predicted_sentiment").alias("_g"),
    )
    return r.select(
        F.when(F.col("_g") == 1, F.lit("all")).otherwise(_ps()).alias("sentiment"),
        "rated_reviews",
        ratio_half_up("_num", "_den", 100, 1).alias("helpful_pct"),
    )


def session_stats(scored: DataFrame) -> DataFrame:
    """AG31: running counters of a live session (batch form).

    Confidences are summed as exact decimals of eight places and the mean is rounded once."""
    a = scored.agg(
        F.count(F.lit(1)).alias("count"),
        F.count_if(_ps() == "positive").alias("_p"),
        F.count_if(_ps() == "negative").alias("_n"),
        F.sum(F.col("confidence").cast("decimal(9,8)")).alias("_conf"),
    )
    return a.select(
        "count",
        ratio_half_up("_p", "count", 100, 0).alias("positive_pct"),
        ratio_half_up("_n", "count", 100, 0).alias("negative_pct"),
        F.greatest(F.lit(0.0), 100 - ratio_half_up("_p", "count", 100, 0) - ratio_half_up("_n", "count", 100, 0)).alias("neutral_pct"),
        F.round((F.col("_conf") * 100).cast("double") / F.col("count"), 1).alias("avg_confidence_pct"),
    )


# ----------------------------------------------------- batch model metrics
def batch_metrics(scored: DataFrame, model_path: str = "models/final") -> DataFrame:
    """AG13/ST06: per micro-batch accuracy against the star rating.

    A batch is identified by ``batch_id``; when absent, the processing day
    stands in for it (rows of one batch share ``processed_at``)."""
    bid = F.col("batch_id") if "batch_id" in scored.columns else (F.col("Time") / 86400).cast("long")
    b = scored.groupBy(bid.alias("batch_id")).agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(is_correct("predicted_sentiment", "Score")).alias("correct_predictions"),
        F.max("processed_at").alias("processed_at"),
    )
    return b.select(
        "batch_id",
        ratio_half_up("correct_predictions", "total_processed", 1, 4).alias("accuracy"),
        "total_processed",
        "correct_predictions",
        F.lit(model_path).alias("model_path"),
        "processed_at",
    )


def latest_batch_metric(batches: DataFrame) -> DataFrame:
    """SC07: the newest batch-metric row (by time, then batch id)."""
    cols = [c for c in batches.columns]
    latest = batches.agg(F.max_by(F.struct(*cols), F.struct("processed_at", "batch_id")).alias("m"))
    return latest.select("m.*")


def pipeline_health(scored: DataFrame) -> DataFrame:
    """AG29: counts and shares, the latest batch accuracy, and pass/fail
    checks -- one plan: batch-level aggregate, then a one-row roll-up."""
    bid = (F.col("Time") / 86400).cast("long")
    b = scored.groupBy(bid.alias("batch_id")).agg(
        *_sentiment_counts(),
        F.count_if(is_correct("predicted_sentiment", "Score")).alias("correct"),
        F.max("processed_at").alias("processed_at"),
    )
    g = b.agg(
        F.sum("review_count").alias("total"),
        F.sum("positive_count").alias("positive_count"),
        F.sum("negative_count").alias("negative_count"),
        F.sum("neutral_count").alias("neutral_count"),
        F.max_by(F.struct("correct", "review_count"), F.struct("processed_at", "batch_id")).alias("latest"),
        F.count(F.lit(1)).alias("batches"),
    )
    return g.select(
        F.col("total").cast("long").alias("total"),
        F.col("positive_count").cast("long").alias("positive_count"),
        F.col("negative_count").cast("long").alias("negative_count"),
        F.col("neutral_count").cast("long").alias("neutral_count"),
        ratio_half_up("positive_count", "total", 100, 1).alias("positive_pct"),
        ratio_half_up("negative_count", "total", 100, 1).alias("negative_pct"),
        ratio_half_up("neutral_count", "total", 100, 1).alias("neutral_pct"),
        ratio_half_up("latest.correct", "latest.review_count", 1, 4).alias("latest_accuracy"),
        F.col("latest.review_count").cast("long").alias("latest_total_processed"),
        (F.coalesce(F.col("total"), F.lit(0)) > 0).alias("has_reviews"),
        (F.col("batches") > 0).alias("has_metrics"),
    )

"""Scans, cleaning, labelling, de-duplication and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from revlens.functions import labels as L
from revlens.functions.text import text_preview
from revlens.operators import prep as PR
from revlens.operators.metrics import kpis_json
from revlens.plans.oracle_base import bucket_of, clean, full_text, label_of, name_of, rhu, split_of, with_fixtures
from revlens.plans.registry import register
from revlens.sources.files import table
from revlens.sources.fixtures import dirty_text, document_text, review_facts, review_text, reviews
from revlens.sources.review_store import keyed_reviews, product_table
from revlens.sources.schemas import SCORED_COLUMNS


@register("scan_reviews", with_fixtures("SELECT " + ", ".join(SCORED_COLUMNS) + " FROM reviews", "reviews"), ("SC03", "PJ04", "PJ01"))
def q_scan_reviews(spark, sf_dir):
    return reviews(spark, sf_dir).select(*SCORED_COLUMNS)


@register("extract_training_rows", with_fixtures(
    """
SELECT Id, Score, Summary, Text FROM reviews WHERE Score IS NOT NULL""", "reviews"), ("SC04", "FL11", "PJ05"))
def q_extract(spark, sf_dir):
    """All rated reviews: the retraining extract without a cap."""
    return reviews(spark, sf_dir).where(F.col("Score").isNotNull()).select("Id", "Score", "Summary", "Text")


@register("product_lookup", with_fixtures(
    "SELECT Id, ProductId, Score, predicted_sentiment, Time FROM reviews WHERE ProductId = 'P0007'", "reviews"), ("SC05", "FL05"))
def q_product_lookup(spark, sf_dir):
    """One bucket of the published table is read."""
    r = keyed_reviews(spark, sf_dir)
    return r.where(F.col("ProductId") == "P0007").select("Id", "ProductId", "Score", "predicted_sentiment", "Time")


@register("review_search", with_fixtures(
    """
SELECT Id, ProductId, Score, predicted_sentiment, processed_at FROM reviews
WHERE ProductId = 'P0042' AND processed_at >= TIMESTAMP '1995-01-01 00:00:00'
  AND processed_at < TIMESTAMP '2000-01-01 00:00:00' AND predicted_sentiment = 'positive'
ORDER BY processed_at DESC, Id DESC LIMIT 20""", "reviews"), ("FL18",))
def q_review_search(spark, sf_dir):
    from revlens.operators.feed import review_search

    return review_search(keyed_reviews(spark, sf_dir), product_id="P0042", start="1995-01-01 00:00:00", end="2000-01-01 00:00:00",
                         sentiment="positive", limit=20)


@register("product_summary", with_fixtures(
    f"""
SELECT ProductId, count(*) AS review_count, {rhu("2 * count(*) FILTER (WHERE predicted_sentiment = 'positive') + count(*) FILTER (WHERE predicted_sentiment = 'neutral')", "count(*)", 1, 2)} AS avg_sentiment
FROM reviews WHERE ProductId = 'P0007' GROUP BY ProductId""", "reviews"), ("SC05", "SK03"))
def q_product_summary(spark, sf_dir):
    """The keyed product-metrics table, one bucket read."""
    return product_table(spark, sf_dir).where(F.col("ProductId") == "P0007").select("ProductId", "review_count", "avg_sentiment")


@register("review_product_context", with_fixtures(
    f"""
SELECT Id, ProductId, predicted_sentiment, review_count, {rhu("negative_count", "review_count", 1, 2)} AS negative_ratio
FROM (SELECT Id, ProductId, predicted_sentiment, count(*) OVER p AS review_count,
             count(*) FILTER (WHERE predicted_sentiment = 'negative') OVER p AS negative_count
      FROM reviews WINDOW p AS (PARTITION BY ProductId))""", "reviews"), ("SC05", "FL05"))
def q_review_product_context(spark, sf_dir):
    """Each review beside its product's figures: both tables lie in the same buckets, so neither is shuffled."""
    p = product_table(spark, sf_dir).select("ProductId", "review_count", "negative_ratio")
    r = keyed_reviews(spark, sf_dir).select("Id", "ProductId", "predicted_sentiment")
    return r.join(p.hint("merge"), "ProductId").select("Id", "ProductId", "predicted_sentiment", "review_count", "negative_ratio")


@register("products_with_reviews", with_fixtures(
    "SELECT ProductId, CAST(count(*) AS BIGINT) AS review_count FROM reviews GROUP BY ProductId HAVING count(*) > 0", "reviews"), ("FL10",))
def q_products_with_reviews(spark, sf_dir):
    """Products with a positive review count."""
    return product_table(spark, sf_dir).where(F.col("review_count") > 0).select("ProductId", "review_count")


@register("score_label", with_fixtures(
    f"SELECT Id, Score, {label_of()} AS label, {name_of(label_of())} AS sentiment FROM reviews", "reviews"), ("PJ06", "PJ07"))
def q_score_label(spark, sf_dir):
    r = review_facts(spark, sf_dir)
    lab = L.score_label("Score")
    return r.select("Id", "Score", lab.alias("label"), L.label_name(lab).alias("sentiment"))


_RAW_SCORE = (
    "CASE Id % 5 WHEN 0 THEN CAST(Score AS {s}) || '.0' WHEN 1 THEN ' ' || CAST(Score AS {s}) "
    "WHEN 2 THEN 'x' || CAST(Score AS {s}) WHEN 3 THEN '-' || CAST(Score AS {s}) ELSE CAST(Score AS {s}) END"
)


@register("score_try_cast", with_fixtures(
    f"""
SELECT Id, raw_score,
       CASE WHEN TRY_CAST(TRY_CAST(raw_score AS DOUBLE) AS INTEGER) BETWEEN 1 AND 5
            THEN TRY_CAST(TRY_CAST(raw_score AS DOUBLE) AS INTEGER) END AS score
FROM (SELECT Id, {_RAW_SCORE.format(s='VARCHAR')} AS raw_score FROM reviews)""", "reviews"), ("PJ02", "FN17", "UD01"))
def q_score_try_cast(spark, sf_dir):
    """Star ratings arriving as text ('4.0', ' 4', 'x4', '-4', '4')."""
    r = review_facts(spark, sf_dir).select("Id", F.expr(_RAW_SCORE.format(s="STRING")).alias("raw_score"))
    return r.select("Id", "raw_score", L.parse_score("raw_score").alias("score"))


@register("confidence_band", with_fixtures(
    """
SELECT Id, confidence,
       CASE WHEN confidence >= 0.7 THEN 'high' WHEN confidence >= 0.5 THEN 'medium' ELSE 'low' END AS band_live,
       CASE WHEN confidence > 0.8 THEN 'high' WHEN confidence > 0.65 THEN 'medium' ELSE 'low' END AS band_product
FROM reviews""", "reviews"), ("PJ14",))
def q_confidence_band(spark, sf_dir):
    r = review_facts(spark, sf_dir)
    return r.select(
        "Id", "confidence", L.confidence_band("confidence").alias("band_live"),
        L.confidence_band("confidence", 0.8, 0.65, strict=True).alias("band_product"),
    )


@register("text_preview", with_fixtures(
    "SELECT Id, " + ", ".join(
        f"CASE WHEN length(Text) > {n} THEN substr(Text, 1, {n}) || '...' ELSE Text END AS preview_{n}" for n in (200, 110, 70, 10)
    ) + " FROM document_text", "document_text"), ("PJ15",))
def q_text_preview(spark, sf_dir):
    r = document_text(spark, sf_dir)
    return r.select("Id", *[text_preview("Text", n).alias(f"preview_{n}") for n in (200, 110, 70, 10)])


@register("epoch_month", with_fixtures(
    """
SELECT Id, Time, CAST(year(make_timestamp(Time * 1000000)) AS INTEGER) AS year,
       CAST(month(make_timestamp(Time * 1000000)) AS INTEGER) AS month,
       strftime(make_timestamp(Time * 1000000), '%Y-%m') AS month_key
FROM reviews""", "reviews"), ("FN11",))
def q_epoch_month(spark, sf_dir):
    r = review_facts(spark, sf_dir)
    ts = F.timestamp_seconds("Time")
    return r.select("Id", "Time", F.year(ts).alias("year"), F.month(ts).alias("month"), F.date_format(ts, "yyyy-MM").alias("month_key"))


@register("drop_null_rows", with_fixtures(
    "SELECT Id, ProductId FROM reviews WHERE ProfileName IS NOT NULL AND Summary IS NOT NULL", "reviews"), ("FL01",))
def q_drop_null(spark, sf_dir):
    return PR.drop_null_rows(reviews(spark, sf_dir), ["ProfileName", "Summary"]).select("Id", "ProductId")


@register("clean_text", with_fixtures(
    f"SELECT Id, {clean(full_text())} AS cleaned_text FROM dirty_text", "dirty_text"), ("FN01", "FN02", "FN03", "FN04", "FN05", "FN06"))
def q_clean_text(spark, sf_dir):
    return PR.with_cleaned_text(dirty_text(spark, sf_dir)).select("Id", "cleaned_text")


@register("clean_min_length", with_fixtures(
    f"""
SELECT Id, label, cleaned_text FROM (SELECT Id, label, {clean(full_text())} AS cleaned_text FROM document_text)
WHERE length(cleaned_text) > 10""", "document_text"), ("FL03", "UD05"))
def q_clean_min_length(spark, sf_dir):
    r = PR.with_cleaned_text(document_text(spark, sf_dir, labels=True))
    return PR.min_length(r).select("Id", "label", "cleaned_text")


@register("cleaning_artifacts", with_fixtures(
    f"""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE contains({full_text()}, '<')) AS raw_with_tags,
       count(*) FILTER (WHERE regexp_matches({full_text()}, 'http|www')) AS raw_with_urls,
       count(*) FILTER (WHERE contains({clean(full_text())}, '<')) AS clean_with_tags,
       count(*) FILTER (WHERE regexp_matches({clean(full_text())}, 'http|www')) AS clean_with_urls
FROM dirty_text""", "dirty_text"), ("FL04", "FN08"))
def q_cleaning_artifacts(spark, sf_dir):
    return PR.cleaning_artifacts(dirty_text(spark, sf_dir))


@register("dedup_text", with_fixtures(
    """
SELECT Id, ProductId, Score FROM (
  SELECT Id, ProductId, Score, row_number() OVER (PARTITION BY Text ORDER BY Id) AS rn FROM reviews) WHERE rn = 1""",
    "reviews"), ("SO01",))
def q_dedup(spark, sf_dir):
    r = reviews(spark, sf_dir).select("Id", "ProductId", "Score", "Text")
    return PR.dedup(r, "Text", "Id").select("Id", "ProductId", "Score")


@register("distinct_labels", with_fixtures(
    f"SELECT DISTINCT {label_of()} AS label, {name_of(label_of())} AS sentiment FROM reviews", "reviews"), ("SO02", "AG28"))
def q_distinct_labels(spark, sf_dir):
    lab = L.score_label("Score")
    return review_facts(spark, sf_dir).select(lab.alias("label"), L.label_name(lab).alias("sentiment")).distinct()


@register("stratified_split", with_fixtures(
    f"SELECT Id, {label_of()} AS label, {split_of()} AS split FROM reviews", "reviews"), ("SO04",))
def q_split(spark, sf_dir):
    r = review_facts(spark, sf_dir).select("Id", L.score_label("Score").alias("label"))
    return PR.assign_split(r)


@register("stratified_sample", with_fixtures(
    f"""
SELECT Id, label FROM (
  SELECT Id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(Id AS VARCHAR)), Id) AS rn, count(*) OVER (PARTITION BY label) AS n
  FROM (SELECT Id, {label_of()} AS label FROM reviews)) WHERE rn <= floor(n * 20 / 100)""", "reviews"), ("SO04", "SO06"))
def q_stratified_sample(spark, sf_dir):
    """A fifth of each class, exact in size and the same at every partitioning."""
    return PR.stratified_sample_exact(review_facts(spark, sf_dir).select("Id", L.score_label("Score").alias("label")), "label", "Id", 20)


@register("test_split_rows", with_fixtures(
    f"SELECT Id, {label_of()} AS label, Score FROM reviews WHERE {split_of()} = 'test'", "reviews"), ("FL17",))
def q_test_rows(spark, sf_dir):
    r = PR.assign_split(review_facts(spark, sf_dir).select("Id", L.score_label("Score").alias("label"), "Score"))
    return r.where(F.col("split") == "test").drop("split")


@register("train_val_union", with_fixtures(
    f"""
SELECT Id, split FROM (SELECT Id, {split_of()} AS split FROM reviews) WHERE split = 'train'
UNION ALL
SELECT Id, split FROM (SELECT Id, {split_of()} AS split FROM reviews) WHERE split = 'val'""", "reviews"), ("SO03",))
def q_train_val_union(spark, sf_dir):
    s = PR.assign_split(review_facts(spark, sf_dir).select("Id"))
    return PR.union_splits(s.where(F.col("split") == "train"), s.where(F.col("split") == "val"))


@register("train_eval_split", with_fixtures(
    f"SELECT Id, CASE WHEN {bucket_of('Id', 'eval:')} < 850 THEN 'train' ELSE 'eval' END AS split FROM document_text",
    "document_text"), ("SO05",))
def q_train_eval(spark, sf_dir):
    return PR.train_eval_split(document_text(spark, sf_dir).select("Id"))


@register("split_report", with_fixtures(
    f"""
WITH s AS (SELECT {label_of()} AS label, {split_of()} AS split FROM reviews),
g AS (SELECT split, count(*) AS rows, count(*) FILTER (WHERE label = 0) AS c0,
             count(*) FILTER (WHERE label = 1) AS c1, count(*) FILTER (WHERE label = 2) AS c2 FROM s GROUP BY split),
t AS (SELECT sum(rows) AS total FROM g)
SELECT split, rows, {rhu('rows', 'total', 100, 1)} AS share_pct,
       {rhu('c0', 'rows', 100, 1)} AS class0_pct, {rhu('c1', 'rows', 100, 1)} AS class1_pct,
       {rhu('c2', 'rows', 100, 1)} AS class2_pct
FROM g, t""", "reviews"), ("AG27",))
def q_split_report(spark, sf_dir):
    r = PR.assign_split(review_facts(spark, sf_dir).select("Id", L.score_label("Score").alias("label")))
    return PR.split_report(r)


_CW = f"""
WITH g AS (SELECT label, count(*) AS count FROM review_text GROUP BY label),
t AS (SELECT sum(count) AS n, count(*) AS k FROM g),
w AS (SELECT label, count, {rhu('count', 'n', 100, 1)} AS pct,
             CAST(n AS DOUBLE) / CAST(k * count AS DOUBLE) AS class_weight FROM g, t)"""


@register("class_weights", with_fixtures(_CW + "\nSELECT * FROM w", "review_text"), ("AG26",))
def q_class_weights(spark, sf_dir):
    return PR.class_weights(review_text(spark, sf_dir))


@register("class_weighted_rows", with_fixtures(
    _CW + "\nSELECT r.Id, r.label, w.class_weight FROM review_text r JOIN w ON r.label = w.label", "review_text"), ("PJ10",))
def q_class_weighted_rows(spark, sf_dir):
    return PR.with_class_weights(review_text(spark, sf_dir).select("Id", "label")).select("Id", "label", "class_weight")


@register("api_kpis_json", None, ("SK10",))
def q_api_kpis_json(spark, sf_dir):
    return kpis_json(review_facts(spark, sf_dir))


@register("retrain_gate", with_fixtures(
    f"""
WITH c AS (SELECT count(*) AS n FROM review_text WHERE length({clean(full_text())}) > 10)
SELECT n AS n_samples, 300 AS min_samples, CASE WHEN n >= 300 THEN 'READY' ELSE 'SKIPPED' END AS status FROM c""",
    "review_text"), ("ML19",))
def q_retrain_gate(spark, sf_dir):
    from revlens.ml.lifecycle import sample_gate

    rows = PR.min_length(PR.with_cleaned_text(review_text(spark, sf_dir)))
    return sample_gate(rows)


@register("feed_dedup", """
WITH d AS (SELECT l_orderkey * 10 + l_linenumber AS Id, l_shipdate AS delivered_at FROM lineitem)
SELECT Id, min(delivered_at) AS first_delivered_at, count(*) AS deliveries FROM d GROUP BY Id""", ("SO07", "ST08"))
def q_feed_dedup(spark, sf_dir):
    """Repeated deliveries of the same review Id collapse to one row
    (lineitem keys repeat, standing in for re-sent messages)."""
    from revlens.operators.feed import dedup_deliveries

    li = table(spark, sf_dir, "lineitem")
    d = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Id"), F.col("l_shipdate").alias("delivered_at"))
    return dedup_deliveries(d, "Id", "delivered_at")


@register("feed_page", with_fixtures(
    """
SELECT Id, ProductId, predicted_sentiment, processed_at FROM reviews
WHERE processed_at > TIMESTAMP '1998-06-01 00:00:00'
   OR (processed_at = TIMESTAMP '1998-06-01 00:00:00' AND Id > 5000)
ORDER BY processed_at, Id LIMIT 10""", "reviews"), ("FL12", "TK05", "TK12", "FL16"))
def q_feed_page(spark, sf_dir):
    from revlens.operators.feed import feed_page

    r = review_facts(spark, sf_dir).select("Id", "ProductId", "predicted_sentiment", "processed_at")
    return feed_page(r, "1998-06-01 00:00:00", 5000, 10)


@register("scan_csv_roundtrip", with_fixtures("SELECT " + ", ".join(
    ["Id", "ProductId", "UserId", "ProfileName", "HelpfulnessNumerator", "HelpfulnessDenominator", "Score", "Time", "Summary", "Text"]
) + " FROM reviews", "reviews"), ("SC01",))
def q_scan_csv(spark, sf_dir):
    """SC01: reviews written as CSV (quoted multi-line text) and read back
    with the explicit schema, then converted once to Parquet."""
    from revlens.session import scratch_path
    from revlens.sources.files import csv_to_parquet, write_review_csv
    from revlens.sources.schemas import RAW_COLUMNS

    csv = scratch_path(spark, "csv")
    write_review_csv(reviews(spark, sf_dir).select(*RAW_COLUMNS), csv)
    return csv_to_parquet(spark, csv, scratch_path(spark, "csv-parquet"))

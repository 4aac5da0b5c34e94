"""Invariants and edge cases of the dashboard / evaluation operators."""

from datetime import datetime

from pyspark.sql import functions as F

from revlens.operators import evaluate as E
from revlens.operators import metrics as M
from revlens.sources.schemas import SCORED_REVIEW

from .conftest import SF_MID, rows


def _scored(spark, data):
    return spark.createDataFrame(data, SCORED_REVIEW)


def _r(i, pid, score, sent, num=0, den=0, t=0, conf=0.9):
    return (i, pid, "U", None, num, den, score, t, None, "text", sent, conf, datetime(2020, 1, 1 + i % 20))


def test_kpis_and_distribution_invariants(spark):
    from revlens.sources.fixtures import reviews

    r = reviews(spark, SF_MID)
    k = M.kpis(r).collect()[0]
    assert k.positive_count + k.negative_count + k.neutral_count == k.total
    dist = M.score_distribution(r).collect()
    assert [d.star for d in dist] == [5, 4, 3, 2, 1]
    assert sum(d["count"] for d in dist) == k.total
    pm = M.product_metrics(r)
    assert pm.agg(F.sum("review_count")).collect()[0][0] == k.total


def test_one_class_product_and_helpfulness_zero_denominator(spark):
    df = _scored(spark, [_r(1, "A", 1, "negative", 0, 0), _r(2, "A", 2, "negative", 1, 2), _r(3, "B", 5, "positive", 3, 4)])
    card = {r.product_id: r for r in M.product_card(df).collect()}
    assert card["A"].health_score == -1.0 and card["A"].status == "ALERT" and card["A"].positive_count == 0
    pm = {r.ProductId: r for r in M.product_metrics(df).collect()}
    assert pm["A"].positive_ratio == 0.0 and pm["A"].negative_ratio == 1.0
    h = {r.sentiment: r for r in M.helpfulness(df).collect()}
    assert h["all"].rated_reviews == 2  # the 0-of-0 review is excluded
    assert h["all"].helpful_pct == round(100 * 4 / 6, 1)


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (2, 2)], "label int, prediction int")
    prf = {r.label: r for r in E.per_class_prf(df).collect()}
    assert prf[1].precision == 0.0 and prf[1].recall == 0.0 and prf[1].f1 == 0.0
    cm = E.confusion_matrix(df).collect()
    assert len(cm) == 9 and sum(r["count"] for r in cm) == 4
    tp_fn = sum(prf[c].tp + prf[c].fn for c in prf)
    assert tp_fn == 4


def test_macro_vs_weighted_f1(spark):
    # 3-class example where weighted F1 != macro F1
    data = [(0, 0)] * 4 + [(0, 1)] + [(1, 1)] * 2 + [(1, 2)] * 2 + [(2, 2)]
    df = spark.createDataFrame(data, "label int, prediction int")
    m = E.eval_metrics(df).collect()[0]
    per = E.per_class_prf(df).collect()
    assert abs(m.f1_macro - sum(p.f1 for p in per) / 3) < 1e-12
    assert abs(m.f1_weighted - sum(p.f1 * p.support for p in per) / 10) < 1e-12
    assert m.f1_macro != m.f1_weighted


def test_watchlist_sort_allow_list(spark):
    df = _scored(spark, [_r(i, f"P{i % 7}", 1 + i % 5, ["negative", "neutral", "positive"][i % 3]) for i in range(60)])
    a = [r.product_id for r in M.watchlist(df, "total", "desc", 3).collect()]
    b = [r.product_id for r in M.watchlist(df, "no_such_key", "asc", 50).collect()]
    assert len(a) == 3
    assert b == sorted(b)  # unknown sort key falls back to product id


def test_monthly_trend_last_12_ascending(spark):
    from revlens.sources.fixtures import reviews

    t = M.monthly_trend(reviews(spark, SF_MID)).collect()
    months = [r.month for r in t]
    assert len(months) == 12 and months == sorted(months)


def test_top_k_per_group_plans_window_group_limit(spark):
    from revlens.operators.topk import top_k_per_group

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    out = top_k_per_group(df, ["g"], [F.desc("id")], 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(rows(out, "g", "id")) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_insights_severity_and_zero_filled_stars(spark):
    data = [_r(i, "A", 1, "negative") for i in range(4)] + [_r(10 + i, "B", 5, "positive") for i in range(6)]
    df = _scored(spark, data)
    lines = {r.line_no: r for r in M.insights(M.kpis(df)).collect()}
    assert lines[1].severity == "ALERT" and "40.0%" in lines[1].message  # 40% negative > 30
    assert lines[3].message == "Monitoring 2 unique products"
    dist = {r.star: (r["count"], r.pct) for r in M.score_distribution(df).collect()}
    assert dist == {5: (6, 60.0), 4: (0, 0.0), 3: (0, 0.0), 2: (0, 0.0), 1: (4, 40.0)}

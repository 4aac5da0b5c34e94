"""Label, sentiment and status mappings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revlens.functions.constants import SENTIMENTS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def score_label(score) -> Column:
    """Score 1-2 -> 0, 3 -> 1, 4-5 -> 2; null or out-of-range -> null."""
    s = _c(score)
    return (
        F.when(s.between(1, 2), F.lit(0))
        .when(s == 3, F.lit(1))
        .when(s.between(4, 5), F.lit(2))
    )


def label_name(label) -> Column:
    lab = _c(label)
    return F.when(lab == 0, SENTIMENTS[0]).when(lab == 1, SENTIMENTS[1]).when(lab == 2, SENTIMENTS[2])


def sentiment_index(name) -> Column:
    n = _c(name)
    return F.when(n == SENTIMENTS[0], 0).when(n == SENTIMENTS[1], 1).when(n == SENTIMENTS[2], 2)


def sentiment_value(name) -> Column:
    """positive 2, neutral 1, anything else 0 (the roll-up's numeric scale)."""
    n = _c(name)
    return F.when(n == "positive", 2).when(n == "neutral", 1).otherwise(0)


def is_correct(predicted, score) -> Column:
    """Prediction agrees with the star rating; null Score counts as wrong."""
    p, s = _c(predicted), _c(score)
    return F.coalesce(
        ((p == "positive") & (s >= 4)) | ((p == "negative") & (s <= 2)) | ((p == "neutral") & (s == 3)),
        F.lit(False),
    )


def health_status(pos, neg, n) -> Column:
    """OK if (pos-neg)/n > 0.5, WATCH if > 0.2, else ALERT -- as integer tests."""
    d = _c(pos) - _c(neg)
    return F.when(d * 2 > _c(n), "OK").when(d * 5 > _c(n), "WATCH").otherwise("ALERT")


def parse_score(raw) -> Column:
    """Lenient star parse: '4', ' 4', '4.0' -> 4; 'x4', '-1', '40' -> null."""
    v = _c(raw).try_cast("double").try_cast("int")
    return F.when(v.between(1, 5), v)


def confidence_band(conf, high: float = 0.7, mid: float = 0.5, strict: bool = False) -> Column:
    """Live page uses >=0.7 / >=0.5; product page uses >0.8 / >0.65 (strict)."""
    c = _c(conf)
    if strict:
        return F.when(c > high, "high").when(c > mid, "medium").otherwise("low")
    return F.when(c >= high, "high").when(c >= mid, "medium").otherwise("low")

"""Hand-made edge rows for the scalar functions (cleaning, labels, health)."""

from pyspark.sql import functions as F

from revlens.functions import labels as L
from revlens.functions import text as T
from revlens.functions.numeric import ratio_half_up
from revlens.operators.prep import min_length, with_cleaned_text


def test_clean_text_variants(spark):
    df = spark.createDataFrame(
        [
            (1, None, "Good stuff here"),
            (2, "", "!!Great"),
            (3, "Title", "<b>Nice</b> see https://x.example/a?b and www.shop.com ok"),
            (4, None, "ok"),
            (5, "Great", "Tasty   TEA\n\tyes"),
        ],
        "Id int, Summary string, Text string",
    )
    out = dict((r.Id, r.cleaned_text) for r in with_cleaned_text(df).collect())
    assert out[1] == "good stuff here"
    assert out[2] == "great"  # leading punctuation trimmed away, not an empty token
    assert out[3] == "title nice see and ok"
    assert out[5] == "great tasty tea yes"  # capitals kept as letters (lower first)
    kept = {r.Id for r in min_length(with_cleaned_text(df)).collect()}
    assert 4 not in kept and 1 in kept


def test_tokens_have_no_empty_strings(spark):
    df = spark.createDataFrame([("",), ("a b",), ("one",)], "c string")
    got = [r.t for r in df.select(T.tokens("c").alias("t")).collect()]
    assert got == [[], ["a", "b"], ["one"]]


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "w array<string>")
    got = [r.b for r in df.select(T.bigrams("w").alias("b")).collect()]
    assert got == [["a b", "b c"], [], []]


def test_parse_score(spark):
    df = spark.createDataFrame([("4",), (" 4",), ("4.0",), ("x4",), ("-1",), ("40",), (None,)], "s string")
    got = [r.v for r in df.select(L.parse_score("s").alias("v")).collect()]
    assert got == [4, 4, 4, None, None, None, None]


def test_score_label_null_and_range(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,), (None,), (9,)], "Score int")
    got = [r.l for r in df.select(L.score_label("Score").alias("l")).collect()]
    assert got == [0, 0, 1, 2, 2, None, None]


def test_health_status_boundaries(spark):
    # (pos, neg, n): 0.5 exactly -> WATCH, 0.2 exactly -> ALERT, all negative -> ALERT
    df = spark.createDataFrame([(3, 1, 4), (3, 2, 5), (0, 4, 4), (9, 1, 10), (4, 1, 10)], "p long, n long, t long")
    got = [r.s for r in df.select(L.health_status("p", "n", "t").alias("s")).collect()]
    assert got == ["WATCH", "ALERT", "ALERT", "OK", "WATCH"]


def test_ratio_half_up_is_exact(spark):
    df = spark.createDataFrame([(2675, 1000), (5, 1000), (-5, 1000), (1, 3), (0, 0)], "a long, b long")
    got = [r.v for r in df.select(ratio_half_up("a", "b", 1, 2).alias("v")).collect()]
    # 2.675 -> 2.68 (half-up on the exact value; binary rounding would give 2.67)
    assert got == [2.68, 0.01, -0.01, 0.33, None]


def test_confidence_band(spark):
    df = spark.createDataFrame([(0.7,), (0.5,), (0.49,), (0.81,), (0.8,)], "c double")
    live = [r.b for r in df.select(L.confidence_band("c").alias("b")).collect()]
    prod = [r.b for r in df.select(L.confidence_band("c", 0.8, 0.65, strict=True).alias("b")).collect()]
    assert live == ["high", "medium", "low", "high", "high"]
    assert prod == ["medium", "low", "low", "high", "medium"]


def test_is_correct_null_score_counts_as_wrong(spark):
    df = spark.createDataFrame([("positive", 5), ("negative", 2), ("neutral", 3), ("neutral", None)], "p string, s int")
    got = [r.c for r in df.select(L.is_correct("p", "s").alias("c")).collect()]
    assert got == [True, True, True, False]


def test_cleaning_is_the_chain_of_the_fixed_patterns(spark):
    from revlens.functions import constants as K

    texts = [None, "", " ", "<>", "<b>x</b> a<b", "HTTP://A.b/c?d e", "xhttps://y z", "http:/ /", "ahttp:// b", "www. www.x wwww.y\tz", "hwww.q r", "http://a<b>c", "<a href='http://x'>go</a>",
             "\u00c9t\u00e9 na\u00efve \u0130stanbul", "a\u00a0b\u2003c\x0bd\x0ce\r\nf", "\U0001f600a\U0001f600", "1a2", "a  b ", "-a-", "https://", "https:// www.", "hhttp://k wwww.k", "a" * 50 + "1" * 50]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.lower("t")
    for pattern in (K.TAG_PATTERN, K.URL_PATTERN, K.NON_LETTER_PATTERN, K.BLANKS_PATTERN):
        want = F.regexp_replace(want, pattern, " ")
    rows = df.select("t", F.trim(want).alias("want"), T.clean_text("t").alias("got")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    words, kept = T.clean_words(F.col("t"), "w", ("a", "b"))
    got = sorted(r.w for r in df.select(*words).where(kept).collect())
    assert got == sorted(w for r in rows if r.want for w in r.want.split(" ") if w and w not in ("a", "b"))


def test_counted_words_are_dropped_by_compiled_filters(spark):
    """Stop words and blanks go behind the generator: no function is interpreted for each word."""
    from revlens.operators import profile as P
    from revlens.operators import words as W

    df = spark.createDataFrame([("P1", 5, "The Good", "tea, tea -- of THE shop 12 ok"), ("P1", 5, None, None), ("P2", 1, "", "")],
                               "ProductId string, Score int, Summary string, Text string")
    by_class, by_product = P.words_by_class(df, F.col("Score")), W.dashboard_words(df)
    assert sorted(r.word for r in by_class.collect()) == ["good", "ok", "shop", "tea", "tea"]
    assert sorted(tuple(r) for r in by_product.collect()) == [("P1", "shop"), ("P1", "tea"), ("P1", "tea")]
    for x in (by_class, by_product):
        assert "lambda" not in x._jdf.queryExecution().executedPlan().toString()

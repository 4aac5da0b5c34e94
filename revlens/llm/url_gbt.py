"""URL filter: a rule list first, gradient-boosted trees on lexical features for the rest.

The labelled URLs are those that a rule judges.  Features: lengths of url, host and path, host labels, path
depth, digit ratios, hyphens, letter entropy of the host, query parameters, fragment, scheme and the share of
blocked labelled URLs under the host's last label and last two labels (smoothed).  The trees are MLlib's; they are fitted
on the distinct labelled urls, each weighted by its rows, at most ``max_train_rows`` of them (those of the smallest hashes; if these are all of
one kind, a twentieth more of the other), and applied to every url without a rule.  So a url that holds a third of all rows is one row of the fit.

Rows: a null url, or one without ``://``, has empty host and path and no rule; it is judged by the trees like any other.
Equal urls get equal verdicts.  Without labelled URLs of both kinds every verdict is the one kind there is (allow without any).
An empty table gives no rows.  Only the named id and url columns are read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm.common import materialize
from revlens.llm.line_dedup import UPPER

#: fixed values: the rule list (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (host and its subdomains, path prefix) as ``host + path`` and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # a longer rule overrides
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _ratio(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.lit(1), F.char_length(text))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    url = F.coalesce(url, F.lit(""))
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-."
    n = F.greatest(F.lit(1), F.char_length(host))
    entropy = F.lit(0.0)
    for c in letters:
        share = (F.char_length(host) - F.char_length(F.replace(host, F.lit(c), F.lit("")))) / n
        entropy = entropy - F.when(share > 0, share * F.log2(share)).otherwise(0.0)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "url_length": F.char_length(url), "host_length": F.char_length(host), "path_length": F.char_length(path),
        "labels": F.size(F.split(host, r"\.")), "depth": F.regexp_count(path, F.lit("/[^/]+")),
        "digits": _ratio(url, "[0-9]"), "path_digits": _ratio(path, "[0-9]"), "hyphens": F.regexp_count(host, F.lit("-")),
        "entropy": entropy, "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "fragment": F.instr(url, "#").cast("boolean").cast("int"), "https": url.startswith("https").cast("int"),
        "ends_slash": path.endswith("/").cast("int"), "dots": F.regexp_count(path, F.lit(r"\.")),
        "first": F.char_length(F.regexp_extract(path, "^/([^/]*)", 1)),
    }


def _fit_rows(spark: SparkSession, labelled: DataFrame, columns: list[str], most: int) -> DataFrame:
    """Distinct labelled urls with their features, label (1 for block) and weight (rows): at most ``most`` and a twentieth, of both kinds."""
    urls = labelled.groupBy("url").agg(F.count(F.lit(1)).cast("double").alias("weight"), F.first("ruled").alias("ruled"),
                                       *(F.first(c).alias(c) for c in columns))
    urls = urls.select("*", (F.col("ruled") == "block").cast("double").alias("label"), F.xxhash64("url", F.lit(3)).alias("draw"))
    urls = materialize(spark, urls, "url-labels")
    drawn = materialize(spark, urls.orderBy("draw", "url").limit(most), "url-sample")
    kinds = {r["label"] for r in drawn.select("label").distinct().collect()}
    for missing in {0.0, 1.0} - kinds:
        drawn = drawn.unionByName(urls.where(F.col("label") == missing).orderBy("draw", "url").limit(max(1, most // 20)))
    return drawn


def judge_urls(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               trees: int = 20, depth: int = 4, rate: float = 0.2, max_train_rows: int = 20_000, seed: int = 11) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, block_score (null where a rule decides)."""
    host, path = url_parts(F.col("url"))
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    src = src.select("id", "url", host.alias("host"), path.alias("path"))
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    src = src.select("*", name.alias("rule"), verdict.alias("ruled"), F.element_at(F.split("host", r"\."), -1).alias("suffix1"),
                     F.regexp_extract("host", r"([^.]*\.[^.]*)$", 1).alias("suffix2"))
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    src = materialize(spark, src.select("*", *(c.cast("double").alias(f"f_{k}") for k, c in features.items())), "urls")

    labelled = src.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    kinds = {r["ruled"]: r["count"] for r in labelled.groupBy("ruled").count().collect()}
    if set(kinds) < {"allow", "block"}:
        only = next(iter(kinds), "allow")
        return src.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", F.lit(only)).alias("verdict"),
                          F.lit(None).cast("double").alias("block_score"))
    n = sum(kinds.values())
    mean = kinds["block"] / n
    full = src
    for s in ("suffix1", "suffix2"):
        stat = labelled.groupBy(s).agg(((F.sum("label") + 10 * mean) / (F.count("*") + 10)).alias(f"f_{s}"))
        full = full.join(stat, s, "left")
    columns = [f"f_{k}" for k in (*features, "suffix1", "suffix2")]
    full = materialize(spark, full.na.fill(mean, ["f_suffix1", "f_suffix2"]), "url-features")
    ready = VectorAssembler(inputCols=columns, outputCol="features").transform(full)
    fit = _fit_rows(spark, full.where("ruled is not null"), columns, max_train_rows)
    fit = VectorAssembler(inputCols=columns, outputCol="features").transform(fit).select("features", "label", "weight")
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=rate, maxBins=32, seed=seed, cacheNodeIds=False, weightCol="weight").fit(fit)
    scored = model.transform(ready).withColumn("block_score", vector_to_array("probability")[1])
    by_trees = F.when(F.col("block_score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", by_trees).alias("verdict"),
                         F.when(F.col("ruled").isNull(), F.col("block_score")).alias("block_score"))

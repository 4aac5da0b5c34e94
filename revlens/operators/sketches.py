"""Mergeable summaries: distinct counts (HyperLogLog) and quantiles (KLL) kept per batch and merged on read.

A summary has a fixed size, whatever the rows behind it: a batch's row carries one beside its additive counts, and any span of
batches is answered by merging their rows, without the reviews.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the HyperLogLog registers: relative standard error about 1.04 / sqrt(2 ** K), 1.6 %
HLL_K = 12
#: KLL accuracy parameter: rank error of a single quantile about 1.3 %
KLL_K = 200


def batch_summaries(rows: DataFrame, by, columns: dict[str, str], value: str | None = None) -> DataFrame:
    """One row per batch: row count, a distinct-count sketch per column of ``columns`` (name -> column) and a quantile sketch of ``value``."""
    sketches = [F.hll_sketch_agg(F.col(c), F.lit(HLL_K)).alias(f"hll_{n}") for n, c in columns.items()]
    if value:
        sketches.append(F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(KLL_K)).alias("kll"))
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *sketches)


def distinct_estimates(batches: DataFrame, names: list[str]) -> DataFrame:
    """One row: the estimated number of distinct values over all batches, per sketch."""
    return batches.agg(*(F.hll_sketch_estimate(F.hll_union_agg(f"hll_{n}")).alias(n) for n in names))


def merged_quantiles(batches: DataFrame, by: list[str], ranks: tuple[float, ...]) -> DataFrame:
    """``(*by, rank, estimate)`` from the merged quantile sketches of the batches."""
    merged = batches.groupBy(*by).agg(F.kll_merge_agg_bigint("kll").alias("kll"))
    pairs = F.array(*(F.struct(F.lit(r).alias("rank"), F.kll_sketch_get_quantile_bigint("kll", F.lit(r)).alias("estimate")) for r in ranks))
    return merged.select(*by, F.inline(pairs))


def rank_errors(rows: DataFrame, value: str, estimates: DataFrame, by: list[str]) -> DataFrame:
    """Per estimate how far its rank lies from the asked one: 0 where the asked rank falls among its equal values."""
    met = rows.select(*by, F.col(value).cast("long").alias("v")).join(F.broadcast(estimates), by)  # a few quantiles per class
    got = met.groupBy(*by, "rank", "estimate").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("v") < F.col("estimate")).alias("below"), F.count_if(F.col("v") <= F.col("estimate")).alias("upto"))
    lo, hi = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return got.select(*by, "rank", "estimate", "n", F.greatest(F.lit(0.0), lo - F.col("rank"), F.col("rank") - hi).alias("rank_error"))

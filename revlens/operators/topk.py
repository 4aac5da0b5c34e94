"""Top-k per group.

``row_number() <= k`` over a window is planned by Spark (3.5+) with a
``WindowGroupLimit`` on *both* sides of the shuffle: every map task keeps at
most k rows per group before exchanging, so a hot group costs k rows per
task, not a third of the table.  The global variant is ``orderBy().limit()``,
planned as ``TakeOrderedAndProject`` (per-task top-k, then a merge).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group under a total order.

    ``order`` must end in a unique tie-break so the result is deterministic.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)

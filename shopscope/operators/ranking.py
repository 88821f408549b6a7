"""Top-k rankings, overall and per group.

Ties are broken by ``shop_id`` ascending so results are deterministic.
Descending order puts NaN first (Spark orders NaN above every number).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.fixed import DEFAULT_K


def _order(order_col: str, tie_breaker: str):
    return [F.col(order_col).desc(), F.col(tie_breaker).asc()]


def top_k(df: DataFrame, order_col: str, k: int = DEFAULT_K, tie_breaker: str = "shop_id",
          rank_col: str = "rank") -> DataFrame:
    """The ``k`` rows with the largest ``order_col``, numbered 1..k.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every partition
    keeps only its own best k, and only those k x partitions rows meet in
    one task. The rank is then numbered over those k rows.
    """
    order = _order(order_col, tie_breaker)
    best = df.orderBy(*order).limit(k)
    return best.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_k_per_group(df: DataFrame, group_col: str, order_col: str, k: int = DEFAULT_K,
                    tie_breaker: str = "shop_id", rank_col: str = "rank") -> DataFrame:
    """The best ``k`` rows of every group, numbered 1..k within it.

    A row_number filter: Spark inserts a partial per-group limit before the
    shuffle (WindowGroupLimit), so a group with a third of all rows still
    ships only k rows per input partition.
    """
    w = Window.partitionBy(group_col).orderBy(*_order(order_col, tie_breaker))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)

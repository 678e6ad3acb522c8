"""Top-k per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group by ``order_by``, numbered 1..k in ``rank_col``.

    ``row_number() <= k`` lets Spark insert ``WindowGroupLimit`` on both sides of the
    shuffle, so each task keeps at most ``k`` rows per group before sorting.
    """
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def top_k_per_user(df: DataFrame, k: int, *, user: str = "user_id", item: str = "item_id",
                   score: str = "score", rank_col: str = "rank") -> DataFrame:
    """Highest ``score`` first, ties by ascending ``item``."""
    return top_k(df, [user], [F.col(score).desc_nulls_last(), F.col(item).asc()], k, rank_col)

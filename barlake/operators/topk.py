"""Top-k operators that Catalyst turns into bounded map-side work.

* ``top_k``: ``orderBy().limit()`` becomes TakeOrderedAndProject (each task keeps k rows).
* ``top_k_per_group``: ``row_number() <= k`` becomes WindowGroupLimit Partial before the
  shuffle and Final after it, so a hot group sends at most k rows per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: str | Sequence[str], k: int, order: Sequence[Column],
                    rank_col: str = "rank") -> DataFrame:
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)

"""Keep-one-row-per-key operators.

Both reduce a key's rows map-side before the shuffle, so a key that holds a large
share of all rows is cut to one row per map task before anything moves over the
network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_best(df: DataFrame, keys: Sequence[str], desc: Sequence[str] = (),
              asc: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: highest ``desc`` columns first, then lowest ``asc`` columns.

    Equivalent to ``DISTINCT ON (keys) ... ORDER BY keys, desc... DESC NULLS LAST,
    asc... ASC NULLS LAST``.  Written as ``row_number() = 1``, which Catalyst plans as
    WindowGroupLimit Partial (each map task keeps its best row per key) -> exchange ->
    WindowGroupLimit Final, so a hot key is cut down before the shuffle.
    """
    order = [F.col(c).desc_nulls_last() for c in desc] + [F.col(c).asc_nulls_last() for c in asc]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_by_priority(df: DataFrame, key: str, priority: str) -> DataFrame:
    """Drop duplicates of ``key``, keeping the row with the lowest ``priority`` (first source wins)."""
    payload = [c for c in df.columns if c not in (key, priority)]
    best = df.groupBy(key).agg(
        F.min(F.struct(F.col(priority), *[F.col(c) for c in payload])).alias("_best"))
    return best.select(key, *[F.col(f"_best.{c}").alias(c) for c in payload])

"""Per-ticker positional time series.

The Silver table holds exactly one row per (ticker, date), so a ticker's series has
at most one row per calendar day: its window partition is bounded by the number of
distinct dates, whatever the data volume.  All positional operators (previous close,
20-row rolling volume, next-day entry, N-day exit) share one spec, so Catalyst runs
them off a single hash exchange on ``ticker`` (none at all on the ticker-bucketed
Silver table) and a single sort by date.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def by_ticker(key: str = "ticker", order: str = "date"):
    return Window.partitionBy(key).orderBy(order)


def trailing_rows(n: int, key: str = "ticker", order: str = "date"):
    """Frame of the n rows before the current one (current row excluded)."""
    return by_ticker(key, order).rowsBetween(-n, -1)


def trailing_sum_count(c: str, n: int, key: str = "ticker", order: str = "date") -> tuple[Column, Column]:
    w = trailing_rows(n, key, order)
    return F.sum(c).over(w), F.count(c).over(w)

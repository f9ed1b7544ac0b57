"""The display order of each result.

Stored tables carry no order (sorting on write is a global shuffle paid for nothing);
this order is applied only when a result is shown or exported for people.
Specs are ``column`` (ascending, NULLs last) or ``-column`` (descending, NULLs first).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDER: dict[str, tuple[str, ...]] = {
    "stg_stock_prices": ("ticker", "date"),
    "daily_returns": ("ticker", "date"),
    "index_performance": ("market", "ticker"),
    "top_movers": ("-weekly_range", "ticker"),
    "sector_top_movers": ("sector", "rank_in_sector"),
    "whale_signals": ("-volume_ratio", "ticker"),
    "whale_signals_history": ("-date", "-volume_ratio", "ticker"),
    "sector_performance": ("-avg_daily_return_pct", "sector"),
    "backtest_trades": ("ticker", "signal_date", "hold_days"),
    "backtest_summary": ("hold_days",),
    "backtest_top_trades": ("-return_pct", "ticker", "signal_date", "hold_days"),
}


def _sort_key(spec: str) -> Column:
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_first()
    return F.col(spec).asc_nulls_last()


def present(df: DataFrame, name: str) -> DataFrame:
    order = ORDER.get(name)
    return df.orderBy(*[_sort_key(s) for s in order]) if order else df

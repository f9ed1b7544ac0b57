"""Gold marts G2-G7 over Silver bars and the ticker dimension.

All per-ticker positional logic uses one window spec (partition by ticker, order by
date).  Results that depend on the clock take ``as_of`` and only see Silver rows up to
that date.  Row order of a stored table is not a contract, so no global sort is paid
except where the order *is* the feature (top-k).
"""

from __future__ import annotations

import datetime as dt
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.fixed import RECENT_DAYS, SECTOR_TOP_N, SPIKE_RATIO, SPIKE_WINDOW_ROWS, TOP_MOVERS_N
from barlake.functions import pct_change, round_half_up, strictly_greater_ratio
from barlake.operators.joins import join_dimension
from barlake.operators.series import by_ticker, trailing_sum_count
from barlake.operators.topk import top_k, top_k_per_group
from barlake.sources.files import month_slice


def as_of_col(as_of: dt.date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("date") if isinstance(as_of, str) else F.lit(as_of)


def up_to(silver: DataFrame, as_of) -> DataFrame:
    """Silver rows visible on ``as_of`` (the reference has no future data)."""
    return silver.where(F.col("date") <= as_of_col(as_of))


# ---------------------------------------------------------------- G2 daily_returns
def daily_returns(silver: DataFrame) -> DataFrame:
    """Close-to-close return per ticker; NULL on each ticker's first row."""
    with_prev = silver.select("date", "ticker", "close",
                              F.lag("close").over(by_ticker()).alias("prev_close"))
    return with_prev.withColumn(
        "daily_return_pct", round_half_up(pct_change("close", "prev_close"), 2))


# ------------------------------------------------------------ G3 index_performance
def index_performance(silver: DataFrame, tickers: DataFrame, as_of=None) -> DataFrame:
    """1-day, year-to-date and since-start returns of each index of the dimension, in one
    aggregation.

    latest row = max by date; YTD base = first close of as_of's year; start = first
    close overall.  The three anchor look-ups are folded into one grouped aggregate
    over the window's output: no joins, and on the ticker-bucketed Silver no exchange.
    """
    a = as_of_col(as_of)
    px = join_dimension(up_to(silver, as_of).select("ticker", "date", "close"), tickers,
                        "index", ("name", "market"))
    px = px.withColumn("close_prev_day", F.lag("close").over(by_ticker()))
    # fixed-width aggregation buffers only (max_by / min_by of doubles by date), so
    # this is a hash aggregate on the ticker bucketing: no exchange, no sort
    agg = px.groupBy("ticker", "name", "market").agg(
        F.max("date").alias("latest_date"),
        F.max_by("close", "date").alias("close_last"),
        F.max_by("close_prev_day", "date").alias("close_prev_day"),
        F.min_by("close", F.when(F.year("date") == F.year(a), F.col("date"))).alias("close_ytd_start"),
        F.min_by("close", "date").alias("close_2y_start"))
    close = F.col("close_last")
    return agg.select(
        "ticker", "name", "market", "latest_date",
        round_half_up(close, 2).alias("close"),
        round_half_up(pct_change(close, "close_prev_day"), 2).alias("return_1d_pct"),
        round_half_up(pct_change(close, "close_ytd_start"), 2).alias("return_ytd_pct"),
        round_half_up(pct_change(close, "close_2y_start"), 2).alias("return_2y_pct"))


# --------------------------------------------------- G4 / G5 weekly range of stocks
# ``silver`` may be the copy written by month, whose scan is then pruned to one or two months.
def _recent_ranges(silver: DataFrame, tickers: DataFrame, as_of, dim_cols: tuple[str, ...]):
    a = as_of_col(as_of)
    recent = month_slice(silver, F.date_sub(a, RECENT_DAYS), a).select("ticker", "date", "high", "low")
    px = join_dimension(recent, tickers, "stock", dim_cols)
    return px.groupBy("ticker", *dim_cols).agg(
        round_half_up(F.max("high") - F.min("low"), 2).alias("weekly_range"),
        round_half_up(F.min("low"), 2).alias("low_price"),
        round_half_up(F.max("high"), 2).alias("high_price"),
        F.count(F.lit(1)).alias("trading_days"))


def top_movers(silver: DataFrame, tickers: DataFrame, as_of=None, n: int = TOP_MOVERS_N) -> DataFrame:
    """The n stocks with the widest high-low range over the last 7 calendar days."""
    ranges = _recent_ranges(silver, tickers, as_of, ())
    return top_k(ranges, n, [F.col("weekly_range").desc_nulls_first(), F.col("ticker")])


def sector_top_movers(silver: DataFrame, tickers: DataFrame, as_of=None,
                      n: int = SECTOR_TOP_N) -> DataFrame:
    """Top n stocks by weekly range within each sector, with their rank (ties: ticker)."""
    ranges = _recent_ranges(silver, tickers, as_of, ("name", "sector", "etf"))
    ranked = top_k_per_group(ranges, "sector", n,
                             [F.col("weekly_range").desc_nulls_first(), F.col("ticker")],
                             rank_col="rank_in_sector")
    return ranked.select("ticker", "name", "sector", "etf", "weekly_range", "low_price",
                         "high_price", "trading_days", "rank_in_sector")


# ------------------------------------------------------- G6 / G7 volume-spike signals
def with_volume_baseline(silver: DataFrame, tickers: DataFrame) -> DataFrame:
    """Stock bars with the sum / count of volume over the 20 preceding rows."""
    px = join_dimension(silver.select("ticker", "date", "open", "close", "volume"), tickers,
                        "stock", ("name", "sector"))
    s, c = trailing_sum_count("volume", SPIKE_WINDOW_ROWS)
    return px.select("*", s.alias("_vol_sum"), c.alias("_vol_cnt"))


def spike_filter() -> Column:
    return strictly_greater_ratio("volume", "_vol_sum", "_vol_cnt", SPIKE_RATIO.numerator,
                                  SPIKE_RATIO.denominator)


def spike_columns() -> list[Column]:
    avg = F.col("_vol_sum") / F.col("_vol_cnt")
    return [
        "ticker", "name", "sector", "date", "close", "volume",
        round_half_up(avg, 0).alias("avg_volume_20d"),
        round_half_up(F.col("volume") / F.nullif(avg, F.lit(0.0)), 2).alias("volume_ratio"),
    ]


def whale_signals_history(silver: DataFrame, tickers: DataFrame) -> DataFrame:
    """Every stock bar whose volume is strictly above 2.5x its trailing 20-row average."""
    return with_volume_baseline(silver, tickers).where(spike_filter()).select(*spike_columns())


def whale_signals(history: DataFrame, as_of=None) -> DataFrame:
    """Spikes of the last 7 calendar days: a slice of the history of signals, whose window
    only looks back, so rows after ``as_of`` do not touch it."""
    a = as_of_col(as_of)
    return month_slice(history, F.date_sub(a, RECENT_DAYS), a)

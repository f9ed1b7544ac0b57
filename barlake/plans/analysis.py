"""G8 sector performance over the last 30 calendar days.

Two aggregation levels over the written daily returns: returns are first folded per ticker (count, sum,
min, max, sum of log growth) on the partitioning the return window already has, then
per sector.  Best / worst ticker are picked with ``min(struct(...))`` so the NULL
ordering of the reference (DESC puts NULL first, ASC puts it last) is explicit and the
pick is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.fixed import SECTOR_WINDOW_DAYS
from barlake.functions import exact_log_sum, exact_mean, exact_sum, guarded_ln_growth, round_half_up
from barlake.operators.joins import join_dimension
from barlake.plans.marts import as_of_col
from barlake.sources.files import month_slice


def sector_daily(returns: DataFrame, tickers: DataFrame, as_of=None,
                 days: int = SECTOR_WINDOW_DAYS) -> DataFrame:
    """Returns of stocks with a sector in the window, from the daily returns table (by
    month, if written so: a return only looks back, so later rows do not touch it)."""
    a = as_of_col(as_of)
    dr = month_slice(returns, F.date_sub(a, days), a)
    d = join_dimension(dr.select("ticker", "date", "daily_return_pct"), tickers, "stock", ("sector",))
    return d.where(F.col("sector").isNotNull())


def ticker_cumulative(daily: DataFrame) -> DataFrame:
    r = F.col("daily_return_pct")
    return daily.groupBy("ticker", "sector").agg(
        F.count(r).alias("n_ret"),
        exact_sum(r, 2).alias("sum_ret"),
        F.min(r).alias("min_ret"),
        F.max(r).alias("max_ret"),
        round_half_up((F.exp(exact_log_sum(guarded_ln_growth(r))) - 1) * 100, 2).alias("cum"))


def sector_performance(returns: DataFrame, tickers: DataFrame, as_of=None,
                       days: int = SECTOR_WINDOW_DAYS) -> DataFrame:
    per_ticker = ticker_cumulative(sector_daily(returns, tickers, as_of, days))
    cum, tk = F.col("cum"), F.col("ticker")
    n = F.sum("n_ret")
    s = per_ticker.groupBy("sector").agg(
        F.count(F.lit(1)).alias("num_tickers"),
        exact_mean(F.sum("sum_ret"), n, 3).alias("avg_daily_return_pct"),
        round_half_up(F.min("min_ret"), 3).alias("worst_day_pct"),
        round_half_up(F.max("max_ret"), 3).alias("best_day_pct"),
        # cumulative DESC NULLS FIRST, then ticker
        F.min(F.struct(cum.isNotNull().alias("k"), (-cum).alias("v"), tk.alias("t"),
                       cum.alias("c"))).alias("best"),
        # cumulative ASC NULLS LAST, then ticker
        F.min(F.struct(cum.isNull().alias("k"), cum.alias("v"), tk.alias("t"))).alias("worst"))
    return s.select("sector", "num_tickers", "avg_daily_return_pct", "worst_day_pct",
                    "best_day_pct",
                    F.col("best.t").alias("best_ticker"), F.col("best.c").alias("best_return_pct"),
                    F.col("worst.t").alias("worst_ticker"), F.col("worst.v").alias("worst_return_pct"))

"""Backtest of a signal table, fully distributed.

The price series of the tickers with a signal get, in one window pass (partitioned by
ticker, ordered by date), each row's next-day entry and N-day exits; signals are joined to
their row by (ticker, date), exploded over the hold periods, and joined by exact date with
the benchmark series.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.fixed import HOLD_PERIODS, TOP_TRADES_N
from barlake.functions import exact_mean, exact_sum, pct_change, round_half_up
from barlake.operators.series import by_ticker
from barlake.operators.topk import top_k


def _date_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """inclusive on both ends; None = unbounded."""
    if start is not None:
        df = df.where(F.col(col) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(col) <= F.lit(end).cast("date"))
    return df


def signals_in_range(signals: DataFrame, start: dt.date | str | None = None,
                     end: dt.date | str | None = None) -> DataFrame:
    """Signal list as read by the backtest: ticker, signal_date, sector."""
    s = signals.select("ticker", F.col("date").alias("signal_date"), "sector")
    return _date_range(s, "signal_date", start, end)


def run_backtest(signals: DataFrame, prices: DataFrame, benchmark: str,
                 holds: Sequence[int] = HOLD_PERIODS, start=None, end=None) -> DataFrame:
    """Trades of a given signal table (ticker, signal_date, sector) over ``prices``.

    Entry is the open of the ticker's next row, exit the close ``hold`` rows later; the
    benchmark return is close to close on exactly these dates.  No trade comes of a ticker
    without prices, a signal date that is not in its series, a signal on the last row, an
    entry or exit without a positive price, or a hold beyond the series (each hold on its
    own).  Repeated signals give repeated trades.
    """
    wanted = signals.select("ticker").distinct()
    w = by_ticker()
    exits = F.array(*[F.struct(F.lit(h).alias("hold_days"),
                               F.lead("date", 1 + h).over(w).alias("exit_date"),
                               F.lead("close", 1 + h).over(w).alias("exit_price"))
                      for h in holds])
    # only the series of tickers with a signal; positions within a series by one window
    series = prices.join(wanted, "ticker", "left_semi").select(
        "ticker", F.col("date").alias("signal_date"),
        F.lead("date", 1).over(w).alias("entry_date"), F.lead("open", 1).over(w).alias("entry_price"),
        exits.alias("_exits"))
    entered = (_date_range(signals.select("ticker", "signal_date", "sector"), "signal_date", start, end)
               .join(series, ["ticker", "signal_date"])
               .where(F.col("entry_date").isNotNull() & (F.col("entry_price") > 0)))
    legs = (entered.select("ticker", "sector", "signal_date", "entry_date", "entry_price", F.explode("_exits").alias("x"))
            .select("*", "x.hold_days", "x.exit_date", "x.exit_price").drop("x")
            .where(F.col("exit_date").isNotNull() & (F.col("exit_price") > 0)))

    # one row per day: the first of a day that has several
    bench = (prices.where(F.col("ticker") == benchmark).groupBy("date").agg(F.min("close").alias("close")))
    be = bench.select(F.col("date").alias("entry_date"), F.col("close").alias("_b_in"))
    bx = bench.select(F.col("date").alias("exit_date"), F.col("close").alias("_b_out"))
    t = legs.join(be, "entry_date", "left").join(bx, "exit_date", "left")

    ret = pct_change("exit_price", "entry_price")
    bret = F.when(F.col("_b_in") > 0, pct_change("_b_out", "_b_in"))
    return t.select(
        "ticker", "sector", "signal_date", "entry_date",
        round_half_up("entry_price", 4).alias("entry_price"),
        "exit_date",
        round_half_up("exit_price", 4).alias("exit_price"),
        "hold_days",
        round_half_up(ret, 4).alias("return_pct"),
        round_half_up(bret, 4).alias("bench_return_pct"),
        round_half_up(ret - bret, 4).alias("alpha_pct"),
        (ret > 0).alias("profitable"))


def backtest_trades(history: DataFrame, silver: DataFrame, benchmark: str,
                    holds: Sequence[int] = HOLD_PERIODS, start=None, end=None) -> DataFrame:
    """Trades of the volume-spike signals (the written history) over Silver."""
    return run_backtest(signals_in_range(history, start, end), silver, benchmark, holds)


def zone_map(calendar: DataFrame) -> DataFrame:
    """Rows per (ticker, month) of a price table written by month: ticker, month, n_rows."""
    return calendar.groupBy("ticker", "month").agg(F.count(F.lit(1)).alias("n_rows"))


def months_of_trades(signals: DataFrame, zones: DataFrame, holds: Sequence[int] = HOLD_PERIODS) -> DataFrame:
    """One row (first, last): the months that hold every signal, entry and exit row.

    A trade needs the signal's row and the ``1 + max(holds)`` rows after it.  Where the
    signal stands within its month is not asked for: the rows of the following months are
    counted until they are as many, per ticker, or until its series ends.
    """
    own = (signals.select("ticker", F.date_format("signal_date", "yyyy-MM").alias("month"))
           .groupBy("ticker").agg(F.min("month").alias("first"), F.max("month").alias("last")))
    after = zones.join(own, "ticker").where(F.col("month") > F.col("last")).withColumn(
        "so_far", F.sum("n_rows").over(by_ticker(order="month")))
    enough = F.min(F.when(F.col("so_far") >= 1 + max(holds), F.col("month")))
    reach = after.groupBy("ticker").agg(F.coalesce(enough, F.max("month")).alias("reach"))
    return own.join(reach, "ticker", "left").agg(
        F.min("first").alias("first"), F.max(F.greatest("last", "reach")).alias("last"))


def dated_backtest(history: DataFrame, calendar: DataFrame, zones: DataFrame, benchmark: str,
                   holds: Sequence[int] = HOLD_PERIODS, start=None, end=None) -> DataFrame:
    """Trades of the signals from ``start`` to ``end``, reading only the months they need of
    ``calendar``, Silver written by month (column month); ``zones`` is its ``zone_map``.

    The months are one row, fetched before the scan is planned, so that the scan is pruned
    by partition; a pruned series has every row from a signal to its furthest exit.
    """
    signals = signals_in_range(history, start, end)
    span = months_of_trades(signals, zones, holds).first()
    prices = calendar.where(F.col("month").between(F.lit(span["first"]), F.lit(span["last"])))
    return run_backtest(signals, prices.drop("month"), benchmark, holds)


def backtest_summary(trades: DataFrame) -> DataFrame:
    """Per hold period: trades, win rate %, mean / exact median / best / worst return, mean alpha.

    One pass over the trades: they are combined per (hold, return) value map-side, and
    every statistic comes from that one table.  Returns have 4 decimals, so the state of
    the exact median is bounded by the number of distinct returns, not of trades, and sums
    are exact in decimals: the means do not depend on the order of the rows.
    """
    per_value = trades.groupBy("hold_days", "return_pct").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("profitable").cast("int")).alias("_wins"),
        exact_sum("alpha_pct", 4).alias("_alpha_sum"),
        F.count("alpha_pct").alias("_alpha_n"))
    n, r = F.sum("_n"), F.col("return_pct")
    total = F.sum((r.cast("decimal(18,4)") * F.col("_n").cast("decimal(15,0)")).cast("decimal(28,4)"))
    return per_value.groupBy("hold_days").agg(
        n.alias("n_trades"),
        exact_mean(F.sum("_wins") * 100, n, 4).alias("win_rate_pct"),
        exact_mean(total, F.sum(F.when(r.isNotNull(), F.col("_n"))), 4).alias("avg_return_pct"),
        round_half_up(F.percentile(r, F.lit(0.5), F.col("_n")), 5).alias("median_return_pct"),
        F.max(r).alias("best_pct"),
        F.min(r).alias("worst_pct"),
        exact_mean(F.sum("_alpha_sum"), F.sum("_alpha_n"), 4).alias("avg_alpha_pct"))


def backtest_top_trades(trades: DataFrame, n: int = TOP_TRADES_N) -> DataFrame:
    """The n best trades by return; ties keep signal order (ticker, date, hold)."""
    best = top_k(trades, n, [F.col("return_pct").desc(), F.col("ticker"), F.col("signal_date"),
                             F.col("hold_days")])
    return best.select("ticker", "signal_date", "hold_days", "return_pct", "alpha_pct")

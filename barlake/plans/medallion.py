"""The medallion run: Bronze -> Silver table -> Gold tables -> backtest -> checks.

``build_gold`` is what a scheduled job calls after new raw bars have landed:
Silver is computed once and written as a ticker-bucketed table, every mart reads it,
and each Gold table is fully replaced.  ``ingest`` turns landed source files into the
ticker dimension CSV, the long raw price table and the news snapshot.  All paths are
in shared storage (the lake root), never on a machine-local disk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.operators.series import by_ticker
from barlake.plans import analysis, backtest, ingest as ing, marts, quality, silver
from barlake.sources import files, sheets
from barlake.sources import news as news_files


def table_name(root: str, what: str) -> str:
    """Catalog name of a table under ``root``: different roots never share one."""
    return f"barlake_{what}_{hashlib.sha256(root.encode('utf-8')).hexdigest()}"


class RunCounts:
    """Counts of a run, observed during its writes, so that no job is run for them.

    Distinct tickers are counted as the first rows of their series: one more function over
    the partitioning and order that the table is written in, no distinct and no exchange.
    """

    def __init__(self):
        self.seen: dict[str, tuple[Observation, tuple[str, ...]]] = {}

    def _observed(self, df: DataFrame, name: str, **metrics) -> DataFrame:
        seen = Observation(name)
        self.seen[name] = seen, tuple(metrics)
        return df.observe(seen, *[c.alias(n) for n, c in metrics.items()])

    def rows(self, df: DataFrame, name: str) -> DataFrame:
        return self._observed(df, name, **{name: F.count(F.lit(1))})

    def series(self, df: DataFrame, name: str, tickers: str) -> DataFrame:
        """Rows, and distinct tickers, of a table with one row per (ticker, date)."""
        first = F.lag(F.lit(1)).over(by_ticker()).isNull()
        return self._observed(df.withColumn("_first", first), name,
                              **{name: F.count(F.lit(1)), tickers: F.count_if("_first")}).drop("_first")

    def row(self) -> dict[str, int]:
        """The counts of the writes that ran."""
        out: dict[str, int] = {}
        for seen, names in self.seen.values():
            try:
                out.update(seen.get)
            except Py4JJavaError:  # no row could reach the observed node, so it was planned away
                out.update(dict.fromkeys(names, 0))
        return out


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """The counts as rows (name, n)."""
    return spark.createDataFrame(sorted(counts.items()), "name string, n bigint")


def build_gold(spark: SparkSession, raw: DataFrame, tickers: DataFrame, root: str, as_of,
               benchmark: str, buckets: int, signal_start=None, signal_end=None,
               metrics: dict | None = None) -> dict[str, DataFrame]:
    """Write Silver and every Gold table under ``root``; return the written tables.

    ``buckets``: files of Silver, and so the tasks of every per-ticker mart; size it from
    the table's bytes (a few hundred MB a bucket).  Silver is written twice, by ticker for
    the marts that need a ticker's whole history and by month for those of a few days; the
    dated Gold tables are written by month, so that slices of them are pruned.

    ``metrics`` (optional dict) receives the run counts (A14), see ``RunCounts``; they are
    also written as the table ``quality/run_counts``.
    """
    root = root.rstrip("/")
    counts = RunCounts()
    sv = silver.dealt_by_ticker(counts.rows(raw, "raw_rows"), buckets, f"{root}/silver")
    s = silver.materialize(counts.rows(sv, "silver_rows"), table_name(root, "silver"), f"{root}/silver", buckets)
    files.register_view(s, "stg_stock_prices")  # K5: Silver is also queryable by name
    out: dict[str, DataFrame] = {"stg_stock_prices": s}
    calendar = files.write_by_month(s, f"{root}/silver_by_month", tasks=buckets)
    returns = files.write_by_month(counts.series(marts.daily_returns(s), "returns", "tickers"),
                                   f"{root}/gold/daily_returns")
    history = files.write_by_month(counts.series(marts.whale_signals_history(s, tickers), "signals", "signal_tickers"),
                                   f"{root}/gold/whale_signals_history")
    out["daily_returns"], out["whale_signals_history"] = returns.drop("month"), history.drop("month")
    gold = {
        "index_performance": marts.index_performance(s, tickers, as_of),
        "top_movers": marts.top_movers(calendar, tickers, as_of),
        "sector_top_movers": marts.sector_top_movers(calendar, tickers, as_of),
        "whale_signals": marts.whale_signals(history, as_of),
        "sector_performance": analysis.sector_performance(returns, tickers, as_of),
    }
    for name, df in gold.items():
        out[name] = files.write_table(df, f"{root}/gold/{name}")

    trades = backtest.backtest_trades(out["whale_signals_history"], s, benchmark, start=signal_start, end=signal_end)
    trades_obs = Observation("trades")
    wrote = files.write_if_not_empty(trades, f"{root}/gold/backtest_trades", trades_obs,
                                     F.count(F.lit(1)).alias("trades"))
    found = {**counts.row(), **(trades_obs.get if wrote else {"trades": 0})}
    out["run_counts"] = files.write_table(counts_table(spark, found), f"{root}/quality/run_counts")
    if metrics is not None:
        metrics.update(found)
    if wrote:
        t = files.read_table(spark, f"{root}/gold/backtest_trades")
        out["backtest_trades"] = t
        out["backtest_summary"] = backtest.backtest_summary(t)
        out["backtest_top_trades"] = backtest.backtest_top_trades(t)

    report = quality.quality_report({**out, "tickers": tickers})
    out["quality_report"] = files.write_table(report, f"{root}/quality/report")
    return out


def ingest(spark: SparkSession, root: str, *, holdings: DataFrame, membership: DataFrame,
           sector_map: DataFrame, index_rows: DataFrame, screener: DataFrame,
           screens: tuple[str, ...], analyst_index: str, analyst_rating: str,
           long_prices: DataFrame, delivered: DataFrame | None = None,
           news: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Source tables -> ticker CSV (K4), long raw prices (K1), news snapshot (K2).

    ``long_prices``: the unfolded feed.  ``news``: gives the news of the volatile pick.
    """
    root = root.rstrip("/")
    dim = ing.ticker_dimension(holdings, membership, sector_map, index_rows, delivered=delivered)
    files.write_tickers_csv(dim, f"{root}/seeds/tickers")
    dim = files.read_tickers_csv(spark, f"{root}/seeds/tickers")
    volatile = ing.volatile_pick(screener, screens)
    analyst = ing.analyst_pick(screener, analyst_index, analyst_rating)
    universe = ing.ingest_universe(dim, volatile, analyst)
    # only tickers of the universe are kept, as the feed is asked for exactly those
    long = long_prices.join(universe.withColumnRenamed("ticker", "Ticker"), "Ticker", "left_semi")
    files.write_table(ing.as_bronze(long), f"{root}/bronze/stock_prices_raw")
    out = {"tickers": dim, "universe": universe,
           "stock_prices_raw": files.read_raw_prices(spark, f"{root}/bronze/stock_prices_raw")}
    if news is not None and files.write_if_not_empty(news(volatile), f"{root}/bronze/ticker_news_raw"):
        out["ticker_news_raw"] = files.read_table(spark, f"{root}/bronze/ticker_news_raw")
    return out


def ingest_landed(spark: SparkSession, root: str, landed: str, *, screens: tuple[str, ...], analyst_index: str,
                  analyst_rating: str, as_of, sector_map: DataFrame | None = None,
                  index_rows: DataFrame | None = None) -> dict[str, DataFrame]:
    """A whole ingest run from landed files: ``holdings`` (fund sheets), ``membership`` and
    ``screener`` (header CSV), ``prices`` (wide feed) and ``news`` (a file per ticker) under
    ``landed``.  What could not be used is written beside the rest: sheets by their reason,
    tickers by that of their news.  The sector map and the index rows have defaults."""
    sectors = sector_map if sector_map is not None else ing.default_sector_map(spark)
    found = sheets.read_sheets(spark, f"{landed}/holdings")
    extra: dict[str, DataFrame] = {"rejected_sheets": files.write_table(sheets.rejected(found), f"{root}/bronze/rejected_sheets")}

    def of_pick(pick: DataFrame) -> DataFrame:
        path = f"{landed}/news"
        lines = news_files.tagged_lines(spark, path, news_files.news_schema(spark, path))
        extra["news_status"] = files.write_table(news_files.news_status(spark, path, lines, pick), f"{root}/bronze/news_status")
        return news_files.usable_news(lines, extra["news_status"])

    out = ingest(spark, root, holdings=ing.labelled(sheets.holdings(found), sectors),
                 membership=files.read_membership(spark, f"{landed}/membership"), sector_map=sectors,
                 index_rows=index_rows if index_rows is not None else ing.default_index_rows(spark),
                 screener=files.read_screener(spark, f"{landed}/screener"), screens=screens,
                 analyst_index=analyst_index, analyst_rating=analyst_rating,
                 long_prices=ing.long_prices_of_feed(spark, f"{landed}/prices", as_of=as_of),
                 delivered=sheets.delivered(found), news=of_pick)
    return {**out, **extra}

"""Counts of a run come with its writes."""

from pyspark.sql import functions as F

from barlake.plans import medallion
from barlake.plans.registry import AS_OF
from barlake.sources import files
from barlake.sources import testdata as td

SMOKE = "/root/testdata/sf0.001"


def test_rows_and_tickers_are_counted_by_the_write_alone(spark, tmp_path):
    counts = medallion.RunCounts()
    df = spark.sql("SELECT concat('T', id % 7) AS ticker, DATE '2024-01-01' + cast(id AS int) AS date FROM range(100)")
    wide = counts.series(counts.rows(df, "all"), "rows", "tickers")
    assert wide.columns == ["ticker", "date"]
    files.write_by_month(wide, str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert counts.row() == {"all": 100, "rows": 100, "tickers": 7}
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_the_count_of_tickers_adds_no_exchange(spark, tmp_path):
    s = files.write_bucketed_table(
        spark.sql("SELECT concat('T', id % 7) AS ticker, DATE '2024-01-01' + cast(id AS int) AS date, id FROM range(100)"),
        "run_counts_test", str(tmp_path / "s"), "ticker", ("ticker", "date"), 3)
    plan = medallion.RunCounts().series(s, "rows", "tickers")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan and "Sort [" not in plan


def test_build_gold_writes_them(spark, tmp_path):
    metrics = {}
    out = medallion.build_gold(spark, td.raw_prices(spark, SMOKE), td.tickers(spark, SMOKE), str(tmp_path / "lake"), AS_OF,
                              td.BENCHMARK, buckets=2, metrics=metrics)
    history, silver = out["whale_signals_history"], out["stg_stock_prices"]
    assert {r.name: r.n for r in out["run_counts"].collect()} == metrics == {
        "raw_rows": td.raw_prices(spark, SMOKE).count(), "silver_rows": silver.count(), "returns": silver.count(),
        "tickers": silver.select(F.countDistinct("ticker")).first()[0], "signals": history.count(),
        "signal_tickers": history.select(F.countDistinct("ticker")).first()[0], "trades": out["backtest_trades"].count()}


def test_a_write_without_rows_counts_zero(spark, tmp_path):
    counts = medallion.RunCounts()
    none = spark.sql("SELECT 'A' AS ticker, DATE '2024-01-01' AS date WHERE 1 = 0").join(spark.range(0).selectExpr("'A' AS ticker"), "ticker")
    files.write_by_month(counts.series(none, "rows", "tickers"), str(tmp_path / "t"))
    assert counts.row() == {"rows": 0, "tickers": 0}

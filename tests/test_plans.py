"""Physical-plan properties that the design relies on at scale."""

import re

import pytest

from barlake.plans import silver
from barlake.plans.registry import QUERIES
from barlake.sources import testdata as td

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(p: str) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|"
                          r"RoundRobinPartitioning)", p))


@pytest.mark.parametrize("name", ["daily_returns", "whale_signals", "whale_signals_history", "index_performance",
                                  "signals_in_range", "backtest_top_trades"])
def test_per_ticker_results_do_not_shuffle(spark, name):
    assert shuffles(plan(QUERIES[name](spark, SMOKE))) == 0


@pytest.mark.parametrize("name", ["top_movers", "sector_top_movers", "sector_performance", "whale_signals"])
def test_calendar_marts_read_few_months(spark, name):
    p = plan(QUERIES[name](spark, SMOKE))
    assert re.search(r"PartitionFilters: \[[^\]]*month", p), p


def test_trades_are_computed_and_window_once(spark):
    p = plan(QUERIES["backtest_trades"](spark, SMOKE))
    assert len(re.findall(r"\bWindow \[", p)) == 1 and "Generate explode" in p


def test_summary_reads_the_trades_once(spark):
    assert plan(QUERIES["backtest_summary"](spark, SMOKE)).count("FileScan") == 1


def test_quality_report_reads_each_written_table(spark):
    p = plan(QUERIES["quality_report"](spark, SMOKE))
    assert "Window" not in p and len(re.findall(r"FileScan.*silver_[0-9a-f]", p)) == 1


def test_window_marts_do_not_sort_on_the_bucketed_silver(spark):
    for name in ("daily_returns", "whale_signals_history"):
        assert "Sort [" not in plan(QUERIES[name](spark, SMOKE)), name


def test_dedupe_is_reduced_map_side_before_the_shuffle(spark):
    p = plan(silver.stg_stock_prices(td.raw_prices(spark, SMOKE)))
    lines = p.splitlines()
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(date" in l]
    assert partial and exchange and partial[0] > exchange[0]  # printed below = runs before


def test_cross_ticker_steps_are_bounded(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_movers"](spark, SMOKE))
    assert re.search(r"WindowGroupLimit .*Partial", plan(QUERIES["sector_top_movers"](spark, SMOKE)))


def test_no_python_evaluation_anywhere(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SMOKE))
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_a_landed_feed_is_unfolded_where_it_is_read(spark):
    p = plan(QUERIES["wide_to_long"](spark, SMOKE))
    assert shuffles(p) == 0 and "BroadcastHashJoin" in p and len(re.findall(r"FileScan text", p)) == 1


def test_a_dated_backtest_reads_its_months(spark):
    p = plan(QUERIES["dated_backtest"](spark, SMOKE))
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ >= 2000-06", p), p


def test_landed_news_is_one_scan_of_the_files(spark):
    assert len(re.findall(r"FileScan text", plan(QUERIES["landed_news"](spark, SMOKE)))) == 1

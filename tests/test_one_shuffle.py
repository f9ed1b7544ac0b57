"""Rows on their way to Silver and its copy by month: what is shuffled, and how often."""

import datetime as dt
import os
import random
import re

import pytest

from barlake import schemas
from barlake.plans import silver
from barlake.sources import files
from barlake.sources import testdata as td
from tests.conftest import bars, day

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def raw_bars(spark, seed, n=600):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        ticker = rng.choice(["^HOT"] * 6 + ["A", "B", "C", "D", None])
        o, up, down = rng.choice([10.0, 11.0, -1.0]), rng.choice([0.0, 1.0]), rng.choice([0.0, 0.5])
        rows.append((dt.datetime.combine(day(rng.randrange(20)), dt.time()), ticker, o, o + up, o - down, o, rng.choice([5, 6, 0])))
    return spark.createDataFrame(rows, schemas.RAW_PRICES).repartition(5)


@pytest.mark.parametrize("hot_bars", [0, 100, 10_000])
def test_rows_dealt_by_ticker_are_those_of_silver(spark, tmp_path, hot_bars):
    raw = raw_bars(spark, hot_bars)
    got = silver.dealt_by_ticker(raw, 3, str(tmp_path), hot_bars)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, silver.stg_stock_prices(raw).collect()))
    hot = [r.ticker for r in files.read_table(spark, str(tmp_path / "hot_tickers")).collect()]
    assert sorted(hot) == {0: ["A", "B", "C", "D", "^HOT"], 100: ["^HOT"], 10_000: []}[hot_bars]


def test_only_hot_tickers_are_shuffled_twice(spark, tmp_path):
    raw = raw_bars(spark, 1).localCheckpoint()
    p = plan(silver.dealt_by_ticker(raw, 3, str(tmp_path), 100))
    keys = sorted(re.sub(r"#\d+", "", k) for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p))
    assert keys == ["date, ticker, 8", "ticker, 3"]
    # the exchange by (date, ticker) is above the semi join with the hot tickers
    by_date = p[re.search(r"Exchange hashpartitioning\(date", p).start():]
    assert "LeftSemi" in by_date and "LeftAnti" not in by_date


def test_a_materialized_silver_is_one_file_a_bucket(spark, tmp_path):
    dealt = silver.dealt_by_ticker(raw_bars(spark, 2), 3, str(tmp_path / "s"), 100)
    s = silver.materialize(dealt, "one_shuffle_test", str(tmp_path / "s"), 3)
    found = [f for f in s.inputFiles()]
    assert len(found) <= 3 and len({re.search(r"_(\d{5})\.", os.path.basename(f)).group(1) for f in found}) == len(found)
    assert "Exchange" not in plan(s.groupBy("ticker").count())


def test_lines_are_not_shuffled_to_find_their_region(spark):
    raw = td.raw_prices(spark, SMOKE)
    assert "Exchange hashpartitioning" not in plan(raw) and "SortMergeJoin" not in plan(raw)


def test_the_copy_by_month_is_not_shuffled(spark, tmp_path):
    s = bars(spark, [(day(i), t, 1.0, 2.0, 0.5, 1.0, 3) for t in "ABCDEFGH" for i in range(100)]).repartition(6)
    s = files.write_table(s, str(tmp_path / "s"))
    calendar = files.write_by_month(s, str(tmp_path / "c"), tasks=2)
    assert sorted(map(tuple, calendar.drop("month").collect())) == sorted(map(tuple, s.collect()))
    assert len(calendar.inputFiles()) <= 2 * 4
    assert {r.month for r in calendar.select("month").distinct().collect()} == {"2024-01", "2024-02", "2024-03", "2024-04"}

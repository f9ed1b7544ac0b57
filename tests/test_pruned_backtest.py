"""A dated backtest reads the months that its trades need, and gives the same trades."""

import datetime as dt
import random
import re

import pytest

from barlake.plans import backtest
from barlake.sources import files
from tests.conftest import bars

BENCH = "^B"


def day(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


def lake(spark, path, rows):
    s = bars(spark, [(day(i), t, 100.0 + i % 7, 200.0, 50.0, 101.0 + i % 11, 100) for t, i in rows])
    calendar = files.write_by_month(s, path)
    return s, calendar, files.write_table(backtest.zone_map(calendar), path + "-zones")


def signals(spark, rows):
    return spark.createDataFrame([(t, day(i), "S") for t, i in rows], "ticker string, date date, sector string")


def both(spark, tmp_path, prices, marks, start, end, holds=(3, 5, 10)):
    s, calendar, zones = lake(spark, str(tmp_path / "silver"), prices)
    pruned = backtest.dated_backtest(signals(spark, marks), calendar, zones, BENCH, holds, start, end)
    whole = backtest.backtest_trades(signals(spark, marks), s, BENCH, holds, start, end)
    return pruned, sorted(map(str, pruned.collect())), sorted(map(str, whole.collect()))


def months(df):
    """Months that the scans are left with, by their partition filters."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"month#\d+ >= (\d{4}-\d\d)\), \(month#\d+ <= (\d{4}-\d\d)", plan)


def test_the_plan_has_month_filters_and_the_trades_are_equal(spark, tmp_path):
    prices = [(t, i) for t in ("A", "B", BENCH) for i in range(0, 500)]
    df, got, want = both(spark, tmp_path, prices, [("A", 40), ("A", 45), ("B", 59), ("B", 300)], day(31), day(59))
    assert got == want and len(got) == 9
    assert months(df) and set(months(df)) == {("2024-02", "2024-03")}


def test_exits_beyond_a_gap_reach_the_month_they_fall_in(spark, tmp_path):
    # A trades twice a month only, C stops in the month of its signal, B is dense
    prices = [("A", i) for i in range(0, 700, 15)] + [("C", i) for i in range(70)] + [(t, i) for t in ("B", BENCH) for i in range(700)]
    df, got, want = both(spark, tmp_path, prices, [("A", 45), ("B", 45), ("C", 60), ("C", 45), ("Z", 45)], day(31), day(60))
    assert got == want and any("hold_days=10" in g and "'A'" in g for g in got)
    assert set(months(df)) == {("2024-02", "2024-07")}


def test_a_signal_on_the_last_row_of_a_month(spark, tmp_path):
    prices = [(t, i) for t in ("A", BENCH) for i in range(120)]
    last = (dt.date(2024, 1, 31) - day(0)).days
    _, got, want = both(spark, tmp_path, prices, [("A", last)], day(0), day(last), holds=(28, 29, 30))
    assert got == want and len(got) == 3


def test_no_signal_in_range(spark, tmp_path):
    prices = [("A", i) for i in range(60)]
    _, got, want = both(spark, tmp_path, prices, [("A", 10)], day(20), day(30))
    assert got == want == []


@pytest.mark.parametrize("seed", range(3))
def test_random_series(spark, tmp_path, seed):
    rng = random.Random(seed)
    prices = sorted({(t, rng.randrange(400)) for t in ("A", "B", "C", "D", BENCH) for _ in range(rng.randrange(20, 250))})
    marks = sorted({rng.choice(prices) for _ in range(40)})
    _, got, want = both(spark, tmp_path, prices, marks, day(90), day(150))
    assert got == want

from barlake.plans.analysis import sector_performance
from barlake.plans.marts import daily_returns
from tests.conftest import bars, day, dim, series, stock


def test_compounded_return_and_null_first_best(spark):
    # A: closes 100, 110, 99 -> returns NULL, +10, -10 -> cumulative -1.00
    a = series(spark, "A", closes=[100.0, 110.0, 99.0], start=0)
    # B: first-ever row inside the window -> cumulative NULL -> "best" (NULLS FIRST)
    b = series(spark, "B", closes=[50.0], start=2)
    s = bars(spark, a + b)
    d = dim(spark, [stock("A", "S1"), stock("B", "S1")])
    r = sector_performance(daily_returns(s), d, day(2)).first()
    assert r.num_tickers == 2
    assert r.best_ticker == "B" and r.best_return_pct is None
    assert r.worst_ticker == "A" and r.worst_return_pct == -1.0
    assert r.avg_daily_return_pct == 0.0 and r.best_day_pct == 10.0 and r.worst_day_pct == -10.0


def test_window_is_thirty_calendar_days(spark):
    a = series(spark, "A", closes=[100.0, 200.0], start=0)   # return on day 1: +100
    a += series(spark, "A", closes=[210.0], start=40)         # return on day 40: +5
    r = sector_performance(daily_returns(bars(spark, a)), dim(spark, [stock("A", "S1")]), day(40)).first()
    assert r.best_day_pct == 5.0 and r.best_return_pct == 5.0

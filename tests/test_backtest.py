from barlake.plans import backtest
from barlake.plans.marts import whale_signals_history
from tests.conftest import bars, day, dim, index, series, stock

BENCH = "^B"
SPIKE = [100, 1000]  # row 2 is a spike (avg of row 1 = 100)


def trades(spark, rows, holds=(3, 5, 10)):
    d = dim(spark, [stock("A"), index(BENCH)])
    s = bars(spark, rows)
    return backtest.backtest_trades(whale_signals_history(s, d), s, BENCH, holds).orderBy("hold_days").collect()


def a_series(spark, n, opens=None, closes=None):
    vols = SPIKE + [100] * (n - 2)
    closes = closes or [100.0 + i for i in range(n)]
    return series(spark, "A", closes=closes, volumes=vols, opens=opens)


def bench_series(spark, n, skip=()):
    rows = series(spark, BENCH, closes=[1000.0 + 10 * i for i in range(n)])
    return [r for i, r in enumerate(rows) if i not in skip]


def test_entry_and_exit_offsets(spark):
    opens = [50.0 + i for i in range(7)]
    closes = [100.0 + i for i in range(7)]
    got = trades(spark, a_series(spark, 7, opens, closes) + bench_series(spark, 7))
    assert len(got) == 1
    t = got[0]
    assert t.signal_date == day(1) and t.entry_date == day(2) and t.entry_price == opens[2]
    assert t.hold_days == 3 and t.exit_date == day(5) and t.exit_price == closes[5]
    ret = (closes[5] - opens[2]) / opens[2] * 100
    bret = (1050.0 - 1020.0) / 1020.0 * 100
    assert abs(t.return_pct - ret) < 1e-4 and abs(t.bench_return_pct - bret) < 1e-4
    assert abs(t.alpha_pct - (ret - bret)) < 1.5e-4 and t.profitable


def test_short_series_no_trade(spark):
    assert trades(spark, a_series(spark, 2)) == []          # signal on the last row
    assert trades(spark, a_series(spark, 5)) == []          # no exit for hold 3


def test_hold_periods_independent(spark):
    got = trades(spark, a_series(spark, 6))                   # exactly enough for hold 3
    assert [t.hold_days for t in got] == [3]
    got = trades(spark, a_series(spark, 13))
    assert [t.hold_days for t in got] == [3, 5, 10]


def test_entry_price_guard(spark):
    for bad in (None, 0.0):
        opens = [100.0, 100.0, bad, 100.0, 100.0, 100.0, 100.0]
        rows = a_series(spark, 7)
        rows = [r if i != 2 else (r[0], r[1], bad, r[3], r[4], r[5], r[6]) for i, r in enumerate(rows)]
        assert trades(spark, rows) == [], opens


def test_missing_benchmark_date_keeps_trade(spark):
    got = trades(spark, a_series(spark, 7) + bench_series(spark, 7, skip=(5,)))
    assert len(got) == 1 and got[0].bench_return_pct is None and got[0].alpha_pct is None


def test_win_flag_uses_unrounded_return(spark):
    opens = [100.0] * 7
    closes = [100.0] * 5 + [100.00001, 100.0]
    t = trades(spark, a_series(spark, 7, opens, closes))[0]
    assert t.return_pct == 0.0 and t.profitable is True


def test_lead_sees_full_series_not_next_signal(spark):
    # two spikes; the first trade must exit on the price series, not on the next signal
    vols = [100, 1000, 100, 100, 100000, 100, 100, 100, 100]
    rows = series(spark, "A", closes=[100.0 + i for i in range(9)], volumes=vols)
    got = trades(spark, rows, holds=(3,))
    assert [(t.signal_date, t.exit_date) for t in got] == [(day(1), day(5)), (day(4), day(8))]


def test_signal_range_filter(spark):
    s = whale_signals_history(bars(spark, a_series(spark, 7)), dim(spark, [stock("A")]))
    assert backtest.signals_in_range(s, day(1), day(1)).count() == 1
    assert backtest.signals_in_range(s, day(2), None).count() == 0
    assert backtest.signals_in_range(s, None, None).count() == 1


def test_summary(spark):
    rows = [("A", "S", day(1), day(2), 1.0, day(3), 1.0, 3, r, None, a, r > 0)
            for r, a in ((1.0, 1.0), (2.0, None), (4.0, 3.0), (10.0, None))]
    schema = ("ticker string, sector string, signal_date date, entry_date date, entry_price double, "
              "exit_date date, exit_price double, hold_days int, return_pct double, "
              "bench_return_pct double, alpha_pct double, profitable boolean")
    s = backtest.backtest_summary(spark.createDataFrame(rows, schema)).first()
    assert s.n_trades == 4 and s.median_return_pct == 3.0 and s.avg_alpha_pct == 2.0
    assert s.win_rate_pct == 100.0 and s.best_pct == 10.0 and s.worst_pct == 1.0
    assert s.avg_return_pct == 4.25
    top = backtest.backtest_top_trades(spark.createDataFrame(rows, schema), 2).collect()
    assert [t.return_pct for t in top] == [10.0, 4.0]


def test_median_against_brute_force(spark):
    import random
    import statistics
    rnd = random.Random(7)
    rows = [(h, round(rnd.gauss(0, 5), rnd.choice((0, 1, 4)))) for h in (3, 5) for _ in range(301 + h)]
    t = spark.createDataFrame([(h, v, v > 0, None) for h, v in rows],
                              "hold_days int, return_pct double, profitable boolean, alpha_pct double")
    got = {r.hold_days: r.median_return_pct for r in backtest.backtest_summary(t).collect()}
    for h in (3, 5):
        assert abs(got[h] - statistics.median(v for k, v in rows if k == h)) < 1e-5


def test_given_signals_guards(spark):
    s = bars(spark, a_series(spark, 7) + bench_series(spark, 7))
    signals = spark.createDataFrame(
        [("A", day(1), "S"), ("A", day(1), "S"), ("Z", day(1), "S"), ("A", day(90), "S"), ("A", day(6), "S")],
        "ticker string, signal_date date, sector string")
    got = backtest.run_backtest(signals, s, BENCH).collect()
    # the unknown ticker, the absent date and the last row give nothing; a repeat gives a repeat
    assert [(t.ticker, t.signal_date, t.hold_days) for t in got] == [("A", day(1), 3)] * 2
    assert backtest.run_backtest(signals.limit(0), s, BENCH).count() == 0


def test_signal_date_range_restricts_trades(spark):
    vols = [100, 1000, 100, 100, 100000, 100, 100, 100, 100]
    rows = series(spark, "A", closes=[100.0 + i for i in range(9)], volumes=vols)
    d = dim(spark, [stock("A"), index(BENCH)])
    s = bars(spark, rows)
    only_second = backtest.backtest_trades(whale_signals_history(s, d), s, BENCH, (3,), start=day(2)).collect()
    assert [t.signal_date for t in only_second] == [day(4)]
    only_first = backtest.backtest_trades(whale_signals_history(s, d), s, BENCH, (3,), end=day(3)).collect()
    # the exit still comes from the full price series
    assert [(t.signal_date, t.exit_date) for t in only_first] == [(day(1), day(5))]

import datetime as dt

from barlake.plans import marts
from tests.conftest import bars, day, dim, index, series, stock


def test_daily_return(spark):
    s = bars(spark, series(spark, "A", closes=[100.0, 110.0, 99.0]))
    got = [r.daily_return_pct for r in marts.daily_returns(s).orderBy("date").collect()]
    assert got == [None, 10.0, -10.0]


def _spikes(spark, volumes, as_of=None, ticker="A"):
    s = bars(spark, series(spark, ticker, volumes=volumes))
    d = dim(spark, [stock(ticker)])
    if as_of is None:
        return marts.whale_signals_history(s, d).orderBy("date").collect()
    return marts.whale_signals(marts.whale_signals_history(s, d), as_of).orderBy("date").collect()


def test_strict_threshold(spark):
    assert _spikes(spark, [100] * 20 + [250]) == []
    got = _spikes(spark, [100] * 20 + [251])
    assert len(got) == 1 and got[0].avg_volume_20d == 100.0 and got[0].volume_ratio == 2.51


def test_partial_frame(spark):
    got = _spikes(spark, [100, 300])
    assert len(got) == 1 and got[0].date == day(1)
    assert got[0].avg_volume_20d == 100.0 and got[0].volume_ratio == 3.0


def test_frame_excludes_current_row(spark):
    got = _spikes(spark, [100, 100, 400])
    assert [r.avg_volume_20d for r in got] == [100.0]


def test_frame_length_is_twenty_rows(spark):
    got = _spikes(spark, [1_000_000] + [100] * 20 + [251])
    assert len(got) == 1 and got[0].date == day(21)


def test_window_runs_before_date_filter(spark):
    # spike on as_of; the rows it averages over are all older than as_of - 7
    vols = [100] * 20 + [1000]
    s = series(spark, "A", volumes=vols)
    s = [(day(i) if i < 20 else day(40),) + r[1:] for i, r in enumerate(s)]
    got = marts.whale_signals(marts.whale_signals_history(bars(spark, s), dim(spark, [stock("A")])), day(40)).collect()
    assert len(got) == 1 and got[0].volume_ratio == 10.0


def test_seven_day_bound_is_inclusive(spark):
    as_of = day(30)
    rows = [(day(22), "A", 10.0, 12.0, 9.0, 11.0, 5), (day(23), "A", 10.0, 11.0, 9.5, 10.5, 5)]
    got = marts.top_movers(bars(spark, rows), dim(spark, [stock("A")]), as_of).collect()
    assert len(got) == 1 and got[0].trading_days == 1 and got[0].weekly_range == 1.5


def test_future_rows_are_invisible_to_as_of(spark):
    rows = [(day(10), "A", 10.0, 11.0, 9.0, 10.0, 5), (day(12), "A", 10.0, 50.0, 9.0, 10.0, 5)]
    got = marts.top_movers(bars(spark, rows), dim(spark, [stock("A")]), day(10)).first()
    assert got.high_price == 11.0


def test_rank_ties_by_ticker(spark):
    rows = [(day(1), t, 10.0, 12.0, 9.0, 11.0, 5) for t in ("B", "A", "C", "D")]
    d = dim(spark, [stock(t) for t in ("A", "B", "C", "D")])
    got = marts.sector_top_movers(bars(spark, rows), d, day(2)).orderBy("rank_in_sector").collect()
    assert [(r.ticker, r.rank_in_sector) for r in got] == [("A", 1), ("B", 2), ("C", 3)]
    top = marts.top_movers(bars(spark, rows), d, day(2), n=2).collect()
    assert [r.ticker for r in top] == ["A", "B"]


def test_stocks_only_and_unknown_tickers_dropped(spark):
    rows = [(day(1), t, 10.0, 12.0, 9.0, 11.0, 5) for t in ("A", "^IDX", "UNKNOWN")]
    d = dim(spark, [stock("A"), index("^IDX")])
    assert [r.ticker for r in marts.top_movers(bars(spark, rows), d, day(2)).collect()] == ["A"]


def test_ytd_missing_this_year(spark):
    rows = [(dt.date(2023, 12, 28), "^I", 100.0, 100.0, 100.0, 100.0, 5),
            (dt.date(2023, 12, 29), "^I", 110.0, 110.0, 110.0, 110.0, 5)]
    got = marts.index_performance(bars(spark, rows), dim(spark, [index("^I")]),
                                  dt.date(2024, 1, 5)).collect()
    assert len(got) == 1
    r = got[0]
    assert r.return_ytd_pct is None and r.return_1d_pct == 10.0 and r.return_2y_pct == 10.0
    assert r.latest_date == dt.date(2023, 12, 29) and r.close == 110.0


def test_single_row_index(spark):
    rows = [(day(3), "^I", 50.0, 50.0, 50.0, 50.0, 5)]
    r = marts.index_performance(bars(spark, rows), dim(spark, [index("^I", "FR")]), day(5)).first()
    assert r.return_1d_pct is None and r.return_2y_pct == 0.0 and r.return_ytd_pct == 0.0
    assert r.market == "FR"

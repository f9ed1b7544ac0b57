"""End-to-end medallion run on the smallest test tables, into a scratch lake folder."""

import datetime as dt

from barlake.plans import ingest, medallion
from barlake.plans.presentation import present
from barlake.plans.registry import AS_OF, QUERIES
from barlake.sources import files
from barlake.sources import testdata as td

SMOKE = "/root/testdata/sf0.001"


def test_build_gold_matches_registered_queries(spark, tmp_path):
    root = str(tmp_path / "lake")
    metrics = {}
    out = medallion.build_gold(spark, td.raw_prices(spark, SMOKE), td.tickers(spark, SMOKE), root,
                              AS_OF, td.BENCHMARK, buckets=4, metrics=metrics)
    assert metrics["raw_rows"] == td.raw_prices(spark, SMOKE).count()
    assert metrics["silver_rows"] == out["stg_stock_prices"].count()
    assert metrics["trades"] == out["backtest_trades"].count()
    assert metrics["signals"] == out["whale_signals_history"].count() > 0
    assert spark.table("stg_stock_prices").count() == metrics["silver_rows"]
    shown = present(out["backtest_top_trades"], "backtest_top_trades").collect()
    assert [r.return_pct for r in shown] == sorted((r.return_pct for r in shown), reverse=True)
    for name in ("stg_stock_prices", "whale_signals_history", "top_movers", "backtest_trades",
                 "backtest_summary", "sector_performance"):
        want = sorted(tuple(r) for r in QUERIES[name](spark, SMOKE).collect())
        got = sorted(tuple(r) for r in out[name].select(*QUERIES[name](spark, SMOKE).columns).collect())
        assert got == want, name
    assert out["quality_report"].where("failures > 0").count() == 0  # the clean dimension


def land(spark, root, silver, dim):
    """Every landed source of an ingest run as files."""
    td.fund_sheets(spark, SMOKE).write.partitionBy("etf").text(f"{root}/holdings")
    td.member_list(spark, SMOKE).write.option("header", True).csv(f"{root}/membership")
    td.screener(spark, SMOKE).write.option("header", True).csv(f"{root}/screener")
    td.feed_files(spark, SMOKE, silver, dim).repartition("block").write.partitionBy("block").text(f"{root}/prices")
    picked = QUERIES["volatile_pick"](spark, SMOKE).select("ticker").collect()
    lines = [(r.ticker, f'{{"Title": "t{i}"}}' if i else "{cut off") for i, r in enumerate(picked[:-1])]
    spark.createDataFrame(lines, "ticker string, value string").write.partitionBy("ticker").text(f"{root}/news")
    return [r.ticker for r in picked]


def test_ingest_from_landed_files_feeds_silver(spark, tmp_path):
    root, landed = str(tmp_path / "lake"), str(tmp_path / "landed")
    silver, own = QUERIES["stg_stock_prices"](spark, SMOKE), td.tickers(spark, SMOKE)
    picked = land(spark, landed, silver, own)
    out = medallion.ingest_landed(spark, root, landed, screens=(td.SCREEN_A, td.SCREEN_B), analyst_index=td.SCREEN_A,
                                  analyst_rating=td.STRONG_BUY, as_of=AS_OF, index_rows=own.where("type = 'index'"))
    dim = out["tickers"]
    # CSV round trip: empty sector / etf of indices come back as NULL
    assert dim.where("type = 'index' and sector is null and etf is null").count() == 5
    want = QUERIES["landed_dimension"](spark, SMOKE).where("type = 'stock'")
    assert (sorted(r.ticker for r in dim.where("type = 'stock'").collect()) == sorted(r.ticker for r in want.collect()))
    assert {r.etf for r in out["rejected_sheets"].collect()} <= {"XLF", "XLV"}
    assert {r.ticker: r.reason for r in out["news_status"].collect()} == {
        picked[0]: "malformed line", picked[-1]: "absent or empty", **{t: None for t in picked[1:-1]}}
    assert sorted(map(tuple, out["ticker_news_raw"].select("Title", "ticker").collect())) == sorted(
        (f"t{i}", t) for i, t in enumerate(picked) if 0 < i < len(picked) - 1)
    raw = out["stock_prices_raw"]
    assert raw.where("Date >= date'2001-06-30'").count() == 0 and raw.select("Ticker").distinct().count() == 5
    assert raw.schema == files.read_raw_prices(spark, root + "/bronze/stock_prices_raw").schema
    assert files.write_if_not_empty(raw.limit(0), str(tmp_path / "empty")) is False
    gold = medallion.build_gold(spark, raw, dim, root, AS_OF, td.BENCHMARK, buckets=2)
    assert gold["stg_stock_prices"].count() > 0 and gold["index_performance"].count() == 5


def test_metric_missing_for_a_ticker_keeps_its_type(spark, tmp_path):
    wide = spark.createDataFrame([(dt.datetime(2001, 1, 2), 1.0, 2.0, 5)],
                                 "Date timestamp_ntz, `Close|A` double, `Close|B` double, `Volume|A` bigint")
    long = ingest.as_bronze(ingest.long_prices(wide, as_of=AS_OF))
    files.write_table(long, str(tmp_path / "bronze"))
    got = {r.Ticker: (r.Close, r.Volume, r.Open) for r in files.read_raw_prices(spark, str(tmp_path / "bronze")).collect()}
    assert got == {"A": (1.0, 5, None), "B": (2.0, None, None)}


def test_roots_never_share_a_table_name():
    names = {medallion.table_name(r, "silver") for r in ("/lake/a-b", "/lake/a/b", "/x" * 40, "/y" + "/x" * 40)}
    assert len(names) == 4


def test_holdings_sheet_preamble_and_headers(spark, tmp_path):
    (tmp_path / "xlk.csv").write_text("Fund\nDate\nx\ny\nName, Ticker ,Weight\nApple,AAPL,5.5\nCash,-,x\n\n")
    got = files.read_holdings(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("AAPL", "Apple", 5.5, "XLK"), ("-", "Cash", None, "XLK")]


def test_membership_and_screener_files(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Symbol,Security,GICS Sector\nBRK.B,Berkshire,Financials\n")
    (tmp_path / "s.csv").write_text("Ticker,Change,Volume,index,recommendation\nA,-1.5%,2.5M,S&P 500,Hold (3)\n")
    assert [tuple(r) for r in files.read_membership(spark, str(tmp_path / "m.csv")).collect()] == [
        ("BRK.B", "Berkshire", "Financials")]
    picked = ingest.volatile_pick(files.read_screener(spark, str(tmp_path / "s.csv")), ("S&P 500",))
    assert [tuple(r) for r in picked.collect()] == [("A", 1.5)]

import datetime as dt

from pyspark.sql import functions as F

from barlake import schemas
from barlake.operators.reshape import wide_columns, wide_to_long
from barlake.plans import ingest
from tests.conftest import dim, index


def test_volatile_first_screen_wins(spark):
    rows = [("X", "-4.5%", "1M", "A", "Hold (3)"), ("X", "9.0%", "1M", "B", "Hold (3)"),
            ("Y", "2.0%", "1M", "B", "Hold (3)"), ("Z", "-", "1M", "A", "Hold (3)")]
    sc = spark.createDataFrame(rows, schemas.SCREENER)
    got = [(r.ticker, r.abs_change) for r in ingest.volatile_pick(sc, ("A", "B"), n=5).collect()]
    assert got == [("X", 4.5), ("Y", 2.0)]


def test_analyst_pick_filters_and_ranks(spark):
    rows = [("P1", "1%", "3.21M", "A", "Strong Buy (1)"), ("P2", "1%", "950K", "A", "Strong Buy (1)"),
            ("P3", "1%", "9M", "A", "Hold (3)"), ("P4", "1%", "8M", "B", "Strong Buy (1)"),
            ("P5", "1%", "3.21M", "A", "Strong Buy (1)")]
    sc = spark.createDataFrame(rows, schemas.SCREENER)
    got = [(r.ticker, r.vol_num) for r in ingest.analyst_pick(sc, "A", "Strong Buy (1)", n=2).collect()]
    assert got == [("P1", 3210000.0), ("P5", 3210000.0)]


def test_ticker_dimension_primary_and_fallback(spark):
    hold = spark.createDataFrame([
        ("AAA", "a", 5.0, "XF1", "Fund1"), ("BBB", "b", 9.0, "XF1", "Fund1"),
        ("BR.K", "c", 99.0, "XF1", "Fund1"), (None, "d", 50.0, "XF1", "Fund1"),
        ("CCC", None, 1.0, "XF1", "Fund1")], schemas.HOLDINGS)
    # header with blanks, as in a landed sheet
    hold = hold.toDF(" Ticker ", "Name ", "Weight", "etf", "label")
    memb = spark.createDataFrame([("ZZ.B", "z", "Src2"), ("YY", "y", "Src2"), ("QQ", "q", "Src1")],
                                 schemas.MEMBERSHIP)
    smap = spark.createDataFrame([("Src1", "Fund1", "XF1"), ("Src2", "Fund2", "XF2")], schemas.SECTOR_MAP)
    idx = dim(spark, [index("^I")])
    got = ingest.ticker_dimension(hold, memb, smap, idx, n=2).collect()
    rows = {(r.ticker, r.source, r.etf) for r in got}
    assert rows == {("^I", "manual", None), ("BBB", "spdr", "XF1"), ("AAA", "spdr", "XF1"),
                    ("YY", "wikipedia_sp500", "XF2"), ("ZZ-B", "wikipedia_sp500", "XF2")}


def test_wide_to_long_keeps_null_cells_and_window(spark):
    long = spark.createDataFrame([
        (dt.date(2001, 6, 29), "^A", 1.0, 2.0), (dt.date(2001, 6, 29), "^B", 3.0, 4.0),
        (dt.date(2001, 6, 28), "^A", 5.0, 6.0), (dt.date(2001, 6, 30), "^A", 7.0, 8.0),
        (dt.date(1999, 6, 29), "^A", 9.0, 9.0)],
        "Date date, Ticker string, Open double, Close double")
    cells = [F.max(F.when(F.col("Ticker") == t, F.col(m))).alias(wide_columns(m, t)) for m in ("Open", "Close") for t in ("^A", "^B")]
    wide = long.groupBy("Date").agg(*cells)
    assert set(wide.columns) == {"Date", "Open|^A", "Open|^B", "Close|^A", "Close|^B"}
    got = sorted(ingest.long_prices(wide, ("Open", "Close"), dt.date(2001, 6, 30)).collect())
    assert [tuple(r) for r in got] == [
        (dt.date(2001, 6, 28), "^A", 5.0, 6.0), (dt.date(2001, 6, 28), "^B", None, None),
        (dt.date(2001, 6, 29), "^A", 1.0, 2.0), (dt.date(2001, 6, 29), "^B", 3.0, 4.0)]
    assert wide_to_long(wide, "Date", ["Open"]).count() == 8


def test_universe_is_distinct_union(spark):
    d = dim(spark, [index("^I"), ("S1", "s", "T", "US", "stock", "spdr", "X")])
    p1 = spark.createDataFrame([("S1",), ("P1",)], "ticker string")
    got = sorted(r.ticker for r in ingest.ingest_universe(d, p1).collect())
    assert got == ["P1", "S1", "^I"]


def test_news_of_the_pick_with_its_ticker_and_all_columns(spark):
    news = spark.createDataFrame([(1, "d1", "x"), (2, "d2", "y"), (3, "d1", "z")], "doc_id long, source string, text string")
    cover = spark.createDataFrame([("A", "d1"), ("A", "d1"), ("B", "d1"), ("C", "d2")], "ticker string, source string")
    only = spark.createDataFrame([("A",), ("C",), ("Q",)], "ticker string")
    got = sorted(tuple(r) for r in ingest.news_snapshot(news, cover, only).collect())
    assert got == [(1, "d1", "x", "A"), (2, "d2", "y", "C"), (3, "d1", "z", "A")]


def test_news_of_several_tickers_are_tagged(spark):
    a = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    b = spark.createDataFrame([(2, "y", "z")], "doc_id long, text string, link string")
    got = sorted(tuple(r) for r in ingest.tag_news({"A": a, "B": b}).select("doc_id", "link", "ticker").collect())
    assert got == [(1, None, "A"), (2, "z", "B")]


def test_default_index_rows_and_sector_map(spark):
    idx = ingest.default_index_rows(spark)
    assert idx.columns == list(ingest.DIM_COLUMNS) and idx.count() == 5
    assert {r.market for r in idx.collect()} == {"US", "FR", "UK", "JP", "IN"}
    assert ingest.default_sector_map(spark).count() == 5

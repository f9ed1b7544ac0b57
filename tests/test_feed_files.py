"""The landed price feed: how its lines are made, and what reading their empty cells costs."""

import datetime as dt
import re

from barlake.sources import feeds
from barlake.sources import testdata as td
from tests.conftest import bars, dim, index, stock

D = [dt.date(2001, 6, 28), dt.date(2001, 6, 29)]
METRICS = {"Open": "double", "Close": "double", "Volume": "bigint"}


def feed(spark):
    silver = bars(spark, [(D[0], "S150", 1.5, 4.0, 0.5, 2.5, 7), (D[1], "^A", 10.0, 12.0, 9.0, 11.0, 8),
                          (D[1], "S101", 3.0, 3.5, 2.0, 3.25, 9), (D[1], "S7", 1.0, 1.0, 1.0, 1.0, 1)])
    return td.feed_files(spark, "", silver, dim(spark, [index("^A"), stock("S101"), stock("S150")]))


def test_lines_of_every_block_and_date(spark):
    lines = sorted(tuple(r) for r in feed(spark).collect())
    assert lines == [
        (0, "2001-06-28,,,,,"), (0, "2001-06-29,10.0,12.0,9.0,11.0,8"), (0, "Date,,,,,"),
        (0, "Price,Open,High,Low,Close,Volume"), (0, "Ticker,^A,^A,^A,^A,^A"),
        (2, "2001-06-28,,1.5,,4.0,,0.5,,2.5,,7"), (2, "2001-06-29,3.0,,3.5,,2.0,,3.25,,9,"), (2, "Date,,,,,,,,,,"),
        (2, "Price,Open,Open,High,High,Low,Low,Close,Close,Volume,Volume"),
        (2, "Ticker,S101,S150,S101,S150,S101,S150,S101,S150,S101,S150")]


def test_no_ticker_list_or_line_is_shuffled_per_date(spark):
    p = feed(spark)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(block#\d+L?, date", p), p
    assert len(re.findall(r"Exchange .*REPARTITION_BY_NUM", p)) == 1, p


def test_empty_cells_are_not_parsed(spark, tmp_path):
    (tmp_path / "one.csv").write_text("Price,Open,Close,Volume\nTicker,A,A,A\nDate,,,\n2001-06-28, ,2.5,20.0\n2001-06-29,1e1,x,\n")
    long = feeds.read_wide_feed(spark, str(tmp_path), METRICS)
    assert {tuple(r)[1:] for r in long.collect()} == {("A", None, 2.5, 20), ("A", 10.0, None, None)}
    p = long._jdf.queryExecution().optimizedPlan().toString()
    # every cell is compared with the empty text before a cast: parsing that throws and catches an exception a cell
    assert len(re.findall(r"CASE WHEN NOT \(trim\(", p)) == len(METRICS), p

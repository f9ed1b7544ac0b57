from barlake.plans import quality
from tests.conftest import dim, index, stock


def failures(df):
    return {(r.table_name, r.check_name, r.column_names): r.failures for r in df.collect()}


def test_not_null_counts_per_column(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert failures(quality.table_checks(df, "t", ["a", "b"])) == {
        ("t", "not_null", "a"): 1, ("t", "not_null", "b"): 2}


def test_unique_ignores_null_keys(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "k string")
    assert failures(quality.table_checks(df, "t", [], ["k"])) == {("t", "unique", "k"): 1}


def test_accepted_values(spark):
    d = dim(spark, [stock("A"), index("^I"), ("E", "e", None, "US", "etf", "x", None),
                    ("N", "n", None, "US", None, "x", None)])
    assert failures(quality.accepted_values(d, "tickers", "type", quality.TICKER_TYPES)) == {
        ("tickers", "accepted_values", "type"): 1}


def test_table_checks_single_pass_matches_separate_checks(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("^A", "US"), ("^A", "DE"), (None, None), (None, "XX"), ("^B", None)],
                               "ticker string, market string")
    got = failures(quality.table_checks(df, "t", ["ticker", "market"], ["ticker"],
                                        {"mk": ~F.col("market").isin("US")}))
    assert got == {("t", "not_null", "ticker"): 2, ("t", "not_null", "market"): 2,
                   ("t", "unique", "ticker"): 1, ("t", "mk", ""): 2}
    combo = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "d int, t string")
    assert failures(quality.table_checks(combo, "c", [], ["d", "t"])) == {
        ("c", "unique_combination_of_columns", "d,t"): 1}


def test_failing_rows_are_those_that_are_counted(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("^A", "US"), ("^A", "DE"), (None, None), (None, "XX"), ("^B", None), ("^C", "US")],
                               "ticker string, market string")
    rules = (["ticker", "market"], ["ticker"], {"mk": ~F.col("market").isin("US")})
    got = sorted(quality.failing_rows(df, *rules, accepted={"market": ["US", "DE"]}).collect(), key=repr)
    assert got == sorted([
        (None, None, "not_null", "ticker"), (None, "XX", "not_null", "ticker"), (None, None, "not_null", "market"),
        ("^B", None, "not_null", "market"), ("^A", "DE", "mk", ""), (None, "XX", "mk", ""),
        (None, "XX", "accepted_values", "market"), ("^A", "US", "unique", "ticker"), ("^A", "DE", "unique", "ticker")], key=repr)
    combo = spark.createDataFrame([(None, "a"), (None, "a"), (1, "a")], "d int, t string")
    assert [tuple(r) for r in quality.failing_rows(combo, key=["d", "t"]).collect()] == [
        (None, "a", "unique_combination_of_columns", "d,t")] * 2
    assert quality.failing_rows(combo.limit(0), ["t"], ["d"]).count() == 0


def test_any_query_is_a_singular_check(spark):
    markets = spark.createDataFrame([("^A", "US"), ("^B", "XX"), ("^C", None)], "ticker string, market string")
    prices = spark.createDataFrame([("^A", 1.0)], "ticker string, close double")
    bad = quality.singular(spark, "SELECT ticker FROM {index} WHERE market NOT IN ('US', 'FR')", {"index": markets})
    lone = quality.singular(spark, "SELECT i.ticker FROM {index} i ANTI JOIN {prices} p ON i.ticker = p.ticker",
                            {"index": markets, "prices": prices})
    none = quality.singular(spark, "SELECT close FROM {prices} WHERE close < 0", {"prices": prices})
    assert [r.ticker for r in bad.collect()] == ["^B"]
    report = quality.singular_report({"markets": bad, "priced": lone, "positive": none})
    assert sorted(map(tuple, report.collect())) == [("markets", 1, False), ("positive", 0, True), ("priced", 2, False)]

from barlake.plans.presentation import ORDER, present


def test_display_orders(spark):
    df = spark.createDataFrame([("B", 2.0, "X"), ("A", None, "Y"), ("C", 5.0, None)],
                               "ticker string, weekly_range double, market string")
    assert [r.ticker for r in present(df, "top_movers").collect()] == ["A", "C", "B"]   # DESC NULLS FIRST
    assert [r.ticker for r in present(df, "index_performance").collect()] == ["B", "A", "C"]  # NULLS LAST
    assert present(df, "unknown") is df
    assert set(ORDER) >= {"whale_signals", "sector_performance", "backtest_top_trades"}

"""Means do not depend on the partitioning or the order of the rows, ties included."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from barlake.functions import exact_log_sum, exact_mean, exact_sum
from barlake.plans import analysis, backtest


def rounded(x: Decimal, n: int) -> float:
    return float(x.quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))


def spread(df, parts):
    return df.repartition(parts, F.rand(parts))


@pytest.fixture(scope="module")
def trades(spark):
    rng = random.Random(1)
    rows = [(h, round(rng.uniform(-50, 50), 4), rng.random() < 0.5, rng.choice([None, round(rng.uniform(-9, 9), 4)]))
            for h in (3, 5) for _ in range(4000)]
    rows += [(10, r, True, r) for r in (0.0001, 0.0, -0.0001, -0.0002)] * 500      # means at a rounding tie
    rows += [(10, 1e9, True, None), (10, -1e9, True, None)]
    return rows, spark.createDataFrame(rows, "hold_days int, return_pct double, profitable boolean, alpha_pct double")


def test_summary_over_any_partitioning(trades):
    rows, df = trades
    found = [sorted(map(repr, backtest.backtest_summary(spread(df, n)).collect())) for n in (1, 7, 200)]
    assert found[0] == found[1] == found[2]
    for r in backtest.backtest_summary(df).collect():
        own = [x for x in rows if x[0] == r.hold_days]
        alpha = [Decimal(str(x[3])) for x in own if x[3] is not None]
        assert r.avg_return_pct == rounded(sum(Decimal(str(x[1])) for x in own) / len(own), 4)
        assert r.avg_alpha_pct == rounded(sum(alpha) / len(alpha), 4)
        assert r.win_rate_pct == rounded(Decimal(100 * sum(x[2] for x in own)) / len(own), 4)


def test_sector_performance_over_any_partitioning(spark):
    rng = random.Random(2)
    rows = [(f"T{t}", "2001-06-%02d" % d, round(rng.uniform(-12, 12), 2)) for t in range(300) for d in range(1, 30)]
    rows += [("T0", "2001-06-30", -100.0), ("T1", "2001-06-30", None)]
    returns = spark.createDataFrame(rows, "ticker string, date string, daily_return_pct double").withColumn("date", F.to_date("date"))
    dim = spark.createDataFrame([(f"T{t}", f"S{t % 3}", "stock") for t in range(300)], "ticker string, sector string, type string")
    found = [sorted(map(repr, analysis.sector_performance(spread(returns, n), dim, "2001-06-30").collect())) for n in (1, 7, 200)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 3
    for r in analysis.sector_performance(returns, dim, "2001-06-30").collect():
        own = [Decimal(str(p)) for t, d, p in rows if f"S{int(t[1:]) % 3}" == r.sector and d >= "2001-05-31" and p is not None]
        assert r.avg_daily_return_pct == rounded(sum(own) / len(own), 3)


def test_helpers(spark):
    df = spark.createDataFrame([(0.1, 0.5), (0.2, 2.0), (0.3, None)], "a double, b double")
    r = df.agg(exact_sum("a", 4).alias("s"), exact_mean(exact_sum("a", 4), F.count("a"), 3).alias("m"),
               exact_mean(exact_sum("b", 4), F.lit(0), 3).alias("none"), exact_log_sum(F.ln("b")).alias("l")).first()
    assert (r.s, r.m, r.none, r.l) == (Decimal("0.6000"), 0.2, None, 0.0)

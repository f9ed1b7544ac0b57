from pyspark.sql import functions as F

from barlake.functions import parse_magnitude, parse_percent, round_half_up, symbol_ok


def one(spark, expr, value, ddl="x double"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_round_half_up_on_decimal(spark):
    assert one(spark, round_half_up("x", 2), 1.005) == 1.01
    assert one(spark, round_half_up("x", 0), -2.5) == -3.0
    assert one(spark, round_half_up("x", 0), 2.5) == 3.0
    assert one(spark, round_half_up("x", 2), None) is None


def test_parse_percent_and_magnitude(spark):
    assert one(spark, F.abs(parse_percent("x")), "-4.5%", "x string") == 4.5
    assert one(spark, parse_magnitude("x"), "3.21M", "x string") == 3210000.0
    assert one(spark, parse_magnitude("x"), "950K", "x string") == 950000.0
    assert one(spark, parse_percent("x"), "-", "x string") is None
    assert one(spark, parse_magnitude("x"), "-", "x string") is None


def test_symbol_pattern(spark):
    df = spark.createDataFrame([(s,) for s in ["AAPL", "BRK.B", "BRK-B", "aapl", "ABCDEF", None]],
                               "s string")
    kept = [r.s for r in df.where(symbol_ok("s")).collect()]
    assert kept == ["AAPL"]

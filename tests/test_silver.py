import datetime as dt

from barlake import schemas
from barlake.plans.silver import stg_stock_prices

T = dt.datetime(2024, 3, 1, 0, 0)


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_PRICES)


def test_keep_best_highest_volume(spark):
    rows = [(T, "A", 10.0, 11.0, 9.0, 10.0, v) for v in (10, 30, None, 0)]
    out = stg_stock_prices(raw(spark, rows)).collect()
    assert len(out) == 1 and out[0].volume == 30
    assert out[0].date == dt.date(2024, 3, 1)


def test_keep_best_tie_breaks_on_lowest_open(spark):
    rows = [(T, "A", 10.5, 11.0, 9.0, 10.0, 30), (T, "A", 10.2, 11.0, 9.0, 10.0, 30)]
    assert stg_stock_prices(raw(spark, rows)).first().open == 10.2


def test_bar_rules(spark):
    rows = [
        (T, "KEEP", 10.0, 10.0, 9.0, 9.5, 5),        # high = open exactly: kept
        (T, "HC", 10.0, 10.5, 9.0, 11.0, 5),         # high < close
        (T, "ZERO", 0.0, 10.0, 9.0, 9.5, 5),         # zero price
        (T, "NOVOL", 10.0, 10.5, 9.0, 9.5, None),    # null volume
        (T, "LOW", 10.0, 10.5, 9.9, 9.5, 5),         # low > close
        (None, "NODATE", 10.0, 10.5, 9.0, 9.5, 5),
        (T, None, 10.0, 10.5, 9.0, 9.5, 5),
        (T, "NAN", float("nan"), 10.5, 9.0, 9.5, 5),
    ]
    got = {r.ticker for r in stg_stock_prices(raw(spark, rows)).collect()}
    assert got == {"KEEP"}


def test_nan_mapped_to_null_at_bronze_boundary(spark):
    from barlake.sources.files import normalize_raw
    rows = [(T, "NAN", float("nan"), 10.5, 9.0, 9.5, 5)]
    assert stg_stock_prices(normalize_raw(raw(spark, rows))).count() == 0


def test_hot_key_reduces_to_one_row(spark):
    rows = [(T, "HOT", 10.0, 11.0, 9.0, 10.0, v) for v in range(1, 5001)]
    rows += [(T, "COLD", 10.0, 11.0, 9.0, 10.0, 7)]
    out = {r.ticker: r.volume for r in stg_stock_prices(raw(spark, rows).repartition(8)).collect()}
    assert out == {"HOT": 5000, "COLD": 7}


def test_dedupe_idempotent_and_unique(spark):
    rows = [(T + dt.timedelta(days=i % 3), f"T{i % 4}", 10.0, 11.0, 9.0, 10.0, i + 1) for i in range(60)]
    s1 = stg_stock_prices(raw(spark, rows))
    back = s1.selectExpr("cast(date as timestamp_ntz) as Date", "ticker as Ticker", "open as Open",
                         "high as High", "low as Low", "close as Close", "volume as Volume")
    s2 = stg_stock_prices(back)
    assert sorted(s1.collect()) == sorted(s2.collect())
    assert s1.groupBy("date", "ticker").count().where("count > 1").count() == 0


def test_raw_parquet_reader_maps_nan(spark, tmp_path):
    from barlake.sources.files import read_raw_prices
    rows = [(T, "A", 10.0, 11.0, 9.0, 10.0, 5), (T, "B", float("nan"), 11.0, 9.0, 10.0, 5)]
    p = str(tmp_path / "raw")
    raw(spark, rows).write.parquet(p)
    back = read_raw_prices(spark, p)
    assert back.where("Open is null").count() == 1
    assert [r.ticker for r in stg_stock_prices(back).collect()] == ["A"]

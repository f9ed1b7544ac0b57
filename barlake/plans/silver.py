"""G1 ``stg_stock_prices``: typed, validated bars with one row per (date, ticker).

Plan shape: scan -> filter (pushed to parquet where it can) -> map-side limit of the
ranking window to one row per key -> exchange on (date, ticker) -> final ranking.  A
(date, ticker) key with millions of duplicate rows is reduced map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.operators.dedupe import keep_best
from barlake.sources.files import write_bucketed_table, write_table

# Raw bars from which on a ticker is reduced before its rows are dealt out.
HOT_BARS = 100_000


def valid_bars(raw: DataFrame) -> DataFrame:
    """Typed bars passing the key, positivity and high/low consistency rules."""
    bars = raw.select(
        F.col("Date").cast("date").alias("date"),
        F.col("Ticker").alias("ticker"),
        F.col("Open").cast("double").alias("open"),
        F.col("High").cast("double").alias("high"),
        F.col("Low").cast("double").alias("low"),
        F.col("Close").cast("double").alias("close"),
        F.col("Volume").cast("bigint").alias("volume"),
    )
    o, h, lo, c, v = (F.col(x) for x in ("open", "high", "low", "close", "volume"))
    return bars.where(
        F.col("date").isNotNull() & F.col("ticker").isNotNull()
        & (o > 0) & (h > 0) & (lo > 0) & (c > 0)
        & (v > 0)
        & (h >= o) & (h >= c)
        & (lo <= o) & (lo <= c))


def stg_stock_prices(raw: DataFrame) -> DataFrame:
    """Keep the highest-volume valid bar per (date, ticker); ties -> lowest open, high, low, close."""
    return _best(valid_bars(raw))


def _best(bars: DataFrame) -> DataFrame:
    return keep_best(bars, keys=["date", "ticker"], desc=["volume"], asc=["open", "high", "low", "close"]) \
        .select("date", "ticker", "open", "high", "low", "close", "volume")


def dealt_by_ticker(raw: DataFrame, buckets: int, folder: str, hot_bars: int = HOT_BARS) -> DataFrame:
    """The rows of ``stg_stock_prices``, dealt to ``buckets`` tasks by ticker in one shuffle.

    ``stg_stock_prices`` deals by (date, ticker), so that a hot ticker spreads over tasks, and
    its rows would be dealt again by ticker to write the table.  Here the tickers of more than
    ``hot_bars`` bars, which are few (one in ``hot_bars`` bars at most), are found first and
    kept as a small table in ``folder``; they are reduced that way, the others where they arrive.
    """
    bars = valid_bars(raw)
    hot = write_table(bars.groupBy("ticker").agg(F.count(F.lit(1)).alias("n_bars")).where(F.col("n_bars") > hot_bars),
                      f"{folder.rstrip('/')}/hot_tickers").select("ticker")
    reduced = bars.join(hot, "ticker", "left_anti").unionByName(_best(bars.join(hot, "ticker", "left_semi")))
    return _best(reduced.repartition(buckets, "ticker"))


def materialize(spark_silver: DataFrame, name: str, folder: str, buckets: int) -> DataFrame:
    """Write Silver once as a table bucketed by ticker, sorted by (ticker, date), read it back.

    Every Gold mart partitions by ticker and orders by date, so on this table their
    windows and per-ticker aggregates run without a shuffle; with one file per bucket
    (and ``spark.sql.legacy.bucketedTableScan.outputOrdering``) also without a sort.
    ``buckets`` is sized by the caller from the table's bytes (a few hundred MB each);
    ``spark_silver`` comes from ``dealt_by_ticker`` with as many.
    """
    return write_bucketed_table(spark_silver, name, f"{folder.rstrip('/')}/{name}", "ticker",
                                ("ticker", "date"), buckets, dealt=True)

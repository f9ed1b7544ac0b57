"""A wide two-level price feed as files, unfolded to one row per date and ticker.

A file's first row holds a metric per column, its second a ticker, its third the name of
the date column; the others hold a date and the cells.  Files may differ in their tickers
and metrics.  The header is data: (file, position, metric, ticker) rows, folded to the
positions of each ticker's metrics, one row per file, which is no larger than a line of
that file.  A line looks its cells up by these positions and is unfolded where it was
read: no shuffle of cells, and neither the plan nor the driver knows a ticker.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The first cells of the three header rows.
METRIC_ROW, TICKER_ROW, DATE_ROW = "Price", "Ticker", "Date"


def feed_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, first (cell), value (line) of every line of every file under ``path``."""
    return (spark.read.option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.trim(F.substring_index("value", ",", 1)).alias("first"),
                    "value"))


def feed_header(lines: DataFrame) -> DataFrame:
    """file, position (from 1), metric, ticker of every column but the first."""
    named = lines.where(F.col("first").isin(METRIC_ROW, TICKER_ROW)).select(
        "file", "first", F.posexplode(F.split("value", ",", -1)).alias("at", "name"))
    return (named.where(F.col("at") > 0).groupBy("file", (F.col("at") + 1).alias("position"))
            .agg(*[F.nullif(F.trim(F.max(F.when(F.col("first") == row, F.col("name")))), F.lit("")).alias(name)
                   for row, name in ((METRIC_ROW, "metric"), (TICKER_ROW, "ticker"))])
            .where(F.col("metric").isNotNull() & F.col("ticker").isNotNull()))


def feed_layout(header: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """file, layout: per ticker, in the order of the file, the position of each metric."""
    own = header.groupBy("file", "ticker").agg(
        F.min("position").alias("first"),
        *[F.min(F.when(F.col("metric") == m, F.col("position"))).alias(m) for m in metrics])
    return own.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("first", "ticker", *metrics))).alias("layout"))


def unfold(lines: DataFrame, layout: DataFrame, metrics: dict[str, str], keep: Column | None = None) -> DataFrame:
    """Date, Ticker and the ``metrics`` (name -> type) of every line and ticker of its file.

    NULL cells are kept, as is a ticker without a value on that date; a cell that is no
    number is NULL.  ``keep``: a condition on Date, applied before lines are unfolded.
    """
    rows = (lines.where(~F.col("first").isin(METRIC_ROW, TICKER_ROW, DATE_ROW))
            .select("file", F.col("first").try_cast("timestamp_ntz").alias("Date"), F.split("value", ",", -1).alias("cells"))
            .where(F.col("Date").isNotNull()))
    if keep is not None:
        rows = rows.where(keep)

    def ticker(t: Column) -> Column:
        def cell(name: str, kind: str) -> Column:
            text = F.trim(F.try_element_at("cells", t.getField(name)))
            number = text.try_cast("double")
            if kind != "double":  # a count may be written with a fraction point
                number = F.coalesce(text.try_cast(kind), number.try_cast(kind))
            # most cells of a wide feed may be empty, and parsing "" costs an exception each time
            return F.when(text != "", number).alias(name)
        return F.struct(t.getField("ticker").alias("Ticker"), *[cell(m, kind) for m, kind in metrics.items()])

    return (rows.join(layout, "file").select("Date", F.explode(F.transform("layout", ticker)).alias("x"))
            .select("Date", "x.*"))


def read_wide_feed(spark: SparkSession, path: str, metrics: dict[str, str], keep: Column | None = None,
                   layout: DataFrame | None = None) -> DataFrame:
    """The feed under ``path``, unfolded.  ``layout``: the files' layouts, if they are kept
    as a table; else the header lines are looked for in a pass of their own."""
    lines = feed_lines(spark, path)
    if layout is None:
        layout = feed_layout(feed_header(lines), list(metrics))
    return unfold(lines, layout, metrics, keep)

"""Explicit schemas for every landed input (never inferred)."""

from pyspark.sql import types as T

# Bronze price table as delivered by the price feed (mixed-case column names).
RAW_PRICES = T.StructType([
    T.StructField("Date", T.TimestampNTZType()),
    T.StructField("Ticker", T.StringType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
])

# Ticker reference table; sector/etf are empty (NULL) for indices.
TICKERS = T.StructType([
    T.StructField(n, T.StringType())
    for n in ("ticker", "name", "sector", "market", "type", "source", "etf")
])

# Silver bars.
SILVER = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
])

# Fund-holdings sheet after the preamble rows are skipped.
HOLDINGS = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Name", T.StringType()),
    T.StructField("Weight", T.DoubleType()),
    T.StructField("etf", T.StringType()),
    T.StructField("label", T.StringType()),
])

# Index-membership table (fallback ticker source).
MEMBERSHIP = T.StructType([
    T.StructField("Symbol", T.StringType()),
    T.StructField("Security", T.StringType()),
    T.StructField("GICS Sector", T.StringType()),
])

# Screener rows, one per (index, ticker); numbers arrive as text.
SCREENER = T.StructType([
    T.StructField("Ticker", T.StringType()),
    T.StructField("Change", T.StringType()),
    T.StructField("Volume", T.StringType()),
    T.StructField("index", T.StringType()),
    T.StructField("recommendation", T.StringType()),
])

# Sector map rows: source sector name -> (label, fund).
SECTOR_MAP = T.StructType([
    T.StructField("source_sector", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("etf", T.StringType()),
])

"""Ingest-side table logic over landed files.

The reference fetches these tables over HTTP; here they are landed files (or tables
derived by Spark) and only the table logic is kept: header trimming, symbol filtering,
top-n per fund, fallback per sector, screener parsing and picks, the ticker universe,
wide -> long reshaping with the rolling 2-year window, and the news snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.fixed import (
    INDEX_ROWS, INGEST_MONTHS, PER_SOURCE_N, SECTOR_MAP, SOURCE_HOLDINGS, SOURCE_MANUAL,
    SOURCE_MEMBERSHIP, STOCK_MARKET, TICKER_TYPES,
)
from barlake.functions import dot_to_dash, parse_magnitude, parse_percent, symbol_ok
from barlake.operators.dedupe import first_by_priority
from barlake.operators.reshape import wide_to_long
from barlake.operators.topk import top_k, top_k_per_group
from barlake.operators.unions import union_all
from barlake.plans.marts import as_of_col
from barlake.sources import feeds

METRICS = ("Open", "High", "Low", "Close", "Volume")
DIM_COLUMNS = ("ticker", "name", "sector", "market", "type", "source", "etf")


def strip_headers(df: DataFrame) -> DataFrame:
    """Trim blanks around column names of a landed sheet."""
    return df.toDF(*[c.strip() for c in df.columns])


def default_index_rows(spark: SparkSession) -> DataFrame:
    """P5: the fixed index rows of the dimension."""
    return spark.createDataFrame([(t, n, None, m, "index", SOURCE_MANUAL, None) for t, n, m in INDEX_ROWS],
                                 schemas.TICKERS)


def default_sector_map(spark: SparkSession) -> DataFrame:
    """The fixed sector map."""
    return spark.createDataFrame(list(SECTOR_MAP), schemas.SECTOR_MAP)


# ------------------------------------------------------------ G12 ticker dimension
def fund_holdings_rows(holdings: DataFrame, n: int = PER_SOURCE_N) -> DataFrame:
    """Top n equity holdings per fund by weight (primary source)."""
    h = strip_headers(holdings).where(symbol_ok("Ticker"))
    # without weights, the order of the sheet counts
    place = [F.col("line")] if "line" in h.columns else []
    top = top_k_per_group(h, "etf", n, [F.col("Weight").desc_nulls_last(), *place, F.col("Ticker")])
    return top.select(F.col("Ticker").alias("ticker"),
                      F.coalesce(F.col("Name"), F.lit("")).alias("name"),
                      F.col("label").alias("sector"), F.lit(STOCK_MARKET).alias("market"),
                      F.lit("stock").alias("type"), F.lit(SOURCE_HOLDINGS).alias("source"), "etf")


def membership_rows(membership: DataFrame, sector_map: DataFrame, n: int = PER_SOURCE_N) -> DataFrame:
    """First n members per mapped sector in alphabetical symbol order (fallback source)."""
    m = strip_headers(membership).where(F.col("Symbol").isNotNull()).join(
        sector_map, F.col("GICS Sector") == F.col("source_sector"))
    top = top_k_per_group(m, "source_sector", n, [F.col("Symbol")])
    return top.select(dot_to_dash("Symbol").alias("ticker"), F.col("Security").alias("name"),
                      F.col("label").alias("sector"), F.lit(STOCK_MARKET).alias("market"),
                      F.lit("stock").alias("type"), F.lit(SOURCE_MEMBERSHIP).alias("source"), "etf")


def labelled(holdings: DataFrame, sector_map: DataFrame) -> DataFrame:
    """Holdings with the label of their fund."""
    return holdings.join(sector_map.select("etf", "label"), "etf")


def ticker_dimension(holdings: DataFrame, membership: DataFrame, sector_map: DataFrame,
                     index_rows: DataFrame, n: int = PER_SOURCE_N, delivered: DataFrame | None = None) -> DataFrame:
    """Index rows, then per fund the primary holdings, or the fallback list when the
    fund's sheet is missing (J10: anti join on the funds that delivered a sheet).

    ``delivered`` (etf): the funds with a readable sheet, as ``sheets.delivered`` has them;
    by default those with a holding."""
    primary = fund_holdings_rows(holdings, n)
    if delivered is None:
        delivered = strip_headers(holdings).select("etf").distinct()
    fallback = membership_rows(membership, sector_map, n).join(delivered, "etf", "left_anti")
    return (index_rows.select(*DIM_COLUMNS)
            .unionByName(primary.select(*DIM_COLUMNS))
            .unionByName(fallback.select(*DIM_COLUMNS)))


# ---------------------------------------------------------------- G13 / G14 picks
def volatile_pick(screener: DataFrame, indices: tuple[str, ...], n: int = PER_SOURCE_N) -> DataFrame:
    """Screens of several indices, deduplicated by ticker (first index wins), top n by |change|."""
    prio = F.create_map(*[x for i, name in enumerate(indices) for x in (F.lit(name), F.lit(i))])
    s = strip_headers(screener).where(F.col("index").isin(list(indices))) \
        .select("Ticker", "Change", prio[F.col("index")].alias("_prio"))
    first = first_by_priority(s, "Ticker", "_prio")
    parsed = first.select(F.col("Ticker").alias("ticker"),
                          F.abs(parse_percent("Change")).alias("abs_change")) \
        .where(F.col("abs_change").isNotNull())
    return top_k(parsed, n, [F.col("abs_change").desc(), F.col("ticker")])


def analyst_pick(screener: DataFrame, index: str, rating: str, n: int = PER_SOURCE_N) -> DataFrame:
    """Tickers of one index with the given analyst rating, top n by traded volume."""
    s = strip_headers(screener).where((F.col("index") == index) & (F.col("recommendation") == rating))
    parsed = s.select(F.col("Ticker").alias("ticker"), parse_magnitude("Volume").alias("vol_num")) \
        .where(F.col("vol_num").isNotNull())
    return top_k(parsed, n, [F.col("vol_num").desc(), F.col("ticker")])


# -------------------------------------------------------------- G15 ingest universe
def ingest_universe(dim: DataFrame, *picks: DataFrame) -> DataFrame:
    """Static stocks + indices of the dimension, union the picks, distinct tickers."""
    u = dim.where(F.col("type").isin(*TICKER_TYPES)).select("ticker")
    for p in picks:
        u = u.unionByName(p.select("ticker"))
    return u.distinct()


# ------------------------------------------------------------- G16 wide -> long
def _window(long: DataFrame, as_of, months: int) -> DataFrame:
    a = as_of_col(as_of)
    return long.where((F.col("Date") >= F.add_months(a, -months)) & (F.col("Date") < a))


def long_prices(wide: DataFrame, metrics: tuple[str, ...] = METRICS, as_of=None,
                months: int = INGEST_MONTHS) -> DataFrame:
    """Stack a wide metric x ticker feed to one row per (Date, Ticker), NULL cells kept,
    restricted to the rolling window [as_of - months, as_of)."""
    return _window(wide_to_long(wide, "Date", metrics), as_of, months)


def long_prices_of_feed(spark: SparkSession, path: str, layout: DataFrame | None = None, as_of=None,
                        months: int = INGEST_MONTHS) -> DataFrame:
    """The same for a feed landed as wide two-level files (``sources.feeds``)."""
    a = as_of_col(as_of)
    types = {f.name: f.dataType.simpleString() for f in schemas.RAW_PRICES if f.name in METRICS}
    return feeds.read_wide_feed(spark, path, types, (F.col("Date") >= F.add_months(a, -months)) & (F.col("Date") < a), layout)


def as_bronze(long: DataFrame) -> DataFrame:
    """The Bronze schema: columns that the feed lacks are NULL, types are those of the table."""
    return long.select(*[(F.col(f.name) if f.name in long.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schemas.RAW_PRICES])


# ---------------------------------------------------------------- G17 news snapshot
def tag_news(frames: dict[str, DataFrame]) -> DataFrame:
    """Frames at hand of several tickers as one, each row tagged with its ticker
    (landed files: ``sources.news``, one scan).  A balanced tree of unions."""
    return union_all([df.withColumn("ticker", F.lit(t)) for t, df in frames.items()])


def news_snapshot(news: DataFrame, coverage: DataFrame, tickers: DataFrame) -> DataFrame:
    """News of the tickers in ``tickers`` (a pick), all source columns and the ticker.

    ``coverage`` (ticker, source) says which desk covers a ticker; it is cut to the pick
    first, so a news row is repeated once per picked ticker of its desk only.
    """
    wanted = coverage.join(tickers.select("ticker").distinct(), "ticker", "left_semi").distinct()
    return news.join(wanted, "source").select(*news.columns, "ticker")

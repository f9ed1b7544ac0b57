"""Mapping of the generic test tables onto this engine's inputs.

Raw bars come from ``lineitem x supplier x nation x region``: each line is a bar of
stock ``'S' || l_suppkey`` and, again, a bar of index ``'^' || r_name``; several lines
share (date, ticker), so the keep-best dedupe has real work (and the index keys are
heavily duplicated, the hot-key case).  The ticker dimension, holdings, membership
list, screener and news inputs are derived the same way.  Everything is built with
narrow DataFrame operations over the given tables, so work grows with them.

What a rule leaves out follows from the business columns: a supplier in debt is not in
the dimension (its bars are dropped by the inner join), one of some countries is quoted
with a class suffix (no equity symbol), a rich one keeps its name to itself, and a part
is in an index by its size or price.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.fixed import SECTOR_MAP, SOURCE_HOLDINGS, SOURCE_MANUAL, STOCK_MARKET
from barlake.plans.ingest import METRICS
from barlake.sources.feeds import DATE_ROW, METRIC_ROW, TICKER_ROW

# Fixed values of the mapping.
BENCHMARK = "^AMERICA"
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
INDEX_TICKERS = ["^" + r for r in REGION_NAMES]
MARKET_OF_REGION = {"AMERICA": "US", "AFRICA": "FR", "EUROPE": "UK", "ASIA": "JP",
                    "MIDDLE EAST": "IN"}
# Countries whose suppliers are quoted with a class suffix.
CLASS_A_NATIONS = ["BRAZIL", "CHINA", "EGYPT", "FRANCE", "IRAN", "IRAQ"]
# Balance from which a supplier's name is missing, and below which its symbol is.
NAMELESS_BALANCE, SYMBOLLESS_BALANCE = 9000.0, -500.0
# Region whose fund sheet is "missing", so that the membership fallback fires.
HOLDINGS_MISSING_REGION = "MIDDLE EAST"
# Day of the calls in the given signal table.
CALL_DATE = "1999-06-17"
# Screener indices (index A is screened first) and the analyst rating that qualifies.
SCREEN_A, SCREEN_B = "S&P 500", "NASDAQ 100"
INDEX_A_SIZE, INDEX_B_PRICE = 10, 950.0
STRONG_BUY, HOLD = "Strong Buy (1)", "Hold (3)"
STRONG_BUY_BRANDS = ["Brand#1", "Brand#10"]
# Landed sheets: the row of the sector map that a region stands for, holdings of a sheet at
# most, and the regions with a peculiar sheet (one has a sheet of names and weights alone).
REGION_SECTOR = {"AMERICA": 0, "MIDDLE EAST": 1, "EUROPE": 2, "ASIA": 3, "AFRICA": 4}
SHEET_ROWS = 1000
NARROW_REGION, WEIGHTLESS_REGION, BROKEN_REGION, NAMES_ONLY_REGION = "AFRICA", "ASIA", "EUROPE", "MIDDLE EAST"
# Landed price feed: tickers of a file at most.
FEED_TICKERS = 100
# Landed news: desks without a file, with lines cut off (those of a language), without the
# language, and with the length.
NO_FILE, CUT_OFF, CUT_LANG, NO_LANG, WITH_LENGTH = "src7", "src11", "de", "src2", "src4"
NEWS_SCHEMA = "doc_id bigint, lang string, n_chars bigint, text string"


# Columns of the test tables that this mapping reads (explicit schema: no footer
# inference on every read, and the scan only materialises these columns).
TABLE_SCHEMAS = {
    "lineitem": "l_suppkey bigint, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_brand string, p_size int, p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    r = spark.read
    if name in TABLE_SCHEMAS:
        r = r.schema(TABLE_SCHEMAS[name])
    return r.parquet(f"{sf_dir}/{name}.parquet")


def _suppliers(spark: SparkSession, sf_dir: str, *supplier_cols: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", *supplier_cols)


def _nations_regions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return (table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
            table(spark, sf_dir, "region").select("r_regionkey", "r_name"))


def _supplier_region(spark: SparkSession, sf_dir: str, *supplier_cols: str) -> DataFrame:
    sup, (nat, reg) = _suppliers(spark, sf_dir, *supplier_cols), _nations_regions(spark, sf_dir)
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .join(reg, nat.n_regionkey == reg.r_regionkey))


def etf_of_region(r_name: Column) -> Column:
    return F.concat(F.lit("X"), F.substring(r_name, 1, 2))


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``stock_prices_raw``: Date, Ticker, Open, High, Low, Close, Volume."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    sup, nat, reg = _suppliers(spark, sf_dir), *_nations_regions(spark, sf_dir)
    # one small table after the other: each has a known size, so that lines are not shuffled
    # to find out that the tables of a region's suppliers are small
    base = (li.join(sup, li.l_suppkey == sup.s_suppkey).join(nat, sup.s_nationkey == nat.n_nationkey)
            .join(reg, nat.n_regionkey == reg.r_regionkey))
    p = F.col("l_extendedprice") / F.col("l_quantity")

    def bars(ticker: Column) -> DataFrame:
        return base.select(
            F.col("l_shipdate").alias("Date"),
            ticker.alias("Ticker"),
            p.alias("Open"),
            (p * (F.lit(1) + F.col("l_tax") / 2)).alias("High"),
            (p * (F.lit(1) - F.col("l_discount"))).alias("Low"),
            (p * (F.lit(0.97) + F.col("l_tax"))).alias("Close"),
            F.floor(F.col("l_quantity") * F.col("l_extendedprice")).cast("bigint").alias("Volume"),
        )
    # tasks of their own for both: the map-side dedupe sorts half as many rows at a time
    return bars(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).unionAll(
        bars(F.concat(F.lit("^"), F.col("r_name"))))


def _market(r_name: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in MARKET_OF_REGION.items() for x in kv])
    return m[r_name]


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker dimension: one stock per supplier not in debt, one index per region."""
    stocks = (_supplier_region(spark, sf_dir, "s_name", "s_acctbal")
              .where(F.col("s_acctbal") >= 0)
              .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
                      F.col("s_name").alias("name"),
                      F.col("r_name").alias("sector"),
                      F.lit(STOCK_MARKET).alias("market"),
                      F.lit("stock").alias("type"),
                      F.lit(SOURCE_HOLDINGS).alias("source"),
                      etf_of_region(F.col("r_name")).alias("etf")))
    indices = (table(spark, sf_dir, "region")
               .select(F.concat(F.lit("^"), F.col("r_name")).alias("ticker"),
                       F.col("r_name").alias("name"),
                       F.lit(None).cast("string").alias("sector"),
                       _market(F.col("r_name")).alias("market"),
                       F.lit("index").alias("type"),
                       F.lit(SOURCE_MANUAL).alias("source"),
                       F.lit(None).cast("string").alias("etf")))
    return indices.unionByName(stocks)


def landed_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension as landed, before it is cleaned: suppliers in debt have no symbol,
    countries are of a type that no mart knows, and each country repeats its region."""
    suppliers = _supplier_region(spark, sf_dir, "s_name", "s_acctbal").select(
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))).alias("ticker"),
        F.lit("stock").alias("type"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("ticker"), F.lit("country").alias("type"))
    regions = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_regionkey").cast("string")).alias("ticker"), F.lit("index").alias("type"))
    return suppliers.unionByName(nations).unionByName(regions)


def _letters(key: Column) -> Column:
    """Digits 0-9 of a key spelled as letters A-J."""
    return F.translate(key.cast("string"), "0123456789", "ABCDEFGHIJ")


def _symbol() -> Column:
    plain = _letters(F.col("s_suppkey"))
    return F.when(F.col("n_name").isin(CLASS_A_NATIONS), F.concat(plain, F.lit(".A"))).otherwise(plain)


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fund sheets, one row per supplier (its region's fund); one region's sheet is absent.

    Symbols: letters of the key, with a class suffix in some countries (not an equity
    symbol), NULL for a deep debt.  Weight = account balance.  Headers carry blanks, as
    the sheets do.
    """
    sr = _supplier_region(spark, sf_dir, "s_name", "s_acctbal")
    balance = F.col("s_acctbal")
    return (sr.where(F.col("r_name") != HOLDINGS_MISSING_REGION)
            .select(F.when(balance >= SYMBOLLESS_BALANCE, _symbol()).alias(" Ticker"),
                    F.when(balance < NAMELESS_BALANCE, F.col("s_name")).alias("Name "),
                    balance.alias(" Weight "),
                    etf_of_region(F.col("r_name")).alias("etf"),
                    F.col("r_name").alias("label")))


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index-membership list: every supplier, its region as the source sector."""
    return _supplier_region(spark, sf_dir, "s_name").select(
        _symbol().alias("Symbol"), F.col("s_name").alias("Security"), F.col("r_name").alias("GICS Sector"))


def sector_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source sector -> (label, fund), one row per region."""
    r = F.col("r_name")
    return table(spark, sf_dir, "region").select(
        r.alias("source_sector"), r.alias("label"), etf_of_region(r).alias("etf"))


def screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screener rows of the two indices: large parts in A, dear parts in B."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice")
    base_change = F.col("p_retailprice") % 20 - 10
    volume = F.concat(F.col("p_size").cast("decimal(10,2)").cast("string"),
                      F.when(F.col("p_retailprice") >= INDEX_B_PRICE, F.lit("M")).otherwise(F.lit("K")))
    rec = F.when(F.col("p_brand").isin(STRONG_BUY_BRANDS), F.lit(STRONG_BUY)).otherwise(F.lit(HOLD))
    ticker = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))

    def rows(index: str, change: Column) -> Column:
        return F.struct(ticker.alias("Ticker"),
                        F.concat(change.cast("decimal(10,2)").cast("string"), F.lit("%")).alias("Change"),
                        volume.alias("Volume"), F.lit(index).alias("index"),
                        rec.alias("recommendation"))

    screens = F.array_compact(F.array(
        F.when(F.col("p_size") >= INDEX_A_SIZE, rows(SCREEN_A, base_change)),
        F.when(F.col("p_retailprice") >= INDEX_B_PRICE, rows(SCREEN_B, base_change + 0.5))))
    return part.select(F.explode(screens).alias("r")).select("r.*")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News items: the documents, with their text; the desk is the source."""
    return table(spark, sf_dir, "documents")


def news_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which desk covers a ticker: parts by size, three sizes to a desk."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"),
                       F.concat(F.lit("src"), F.floor(F.col("p_size") / 3).cast("string")).alias("source"))


def given_signals(spark: SparkSession, sf_dir: str, history: DataFrame) -> DataFrame:
    """A signal table from outside: the spikes, a call on every supplier for one day (on
    which many have no bar), and the same under a symbol that has no prices at all."""
    calls = _supplier_region(spark, sf_dir).select(
        F.explode(F.array(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")),
                          F.concat(F.lit("X"), F.col("s_suppkey").cast("string")))).alias("ticker"),
        F.lit(CALL_DATE).cast("date").alias("signal_date"), F.col("r_name").alias("sector"))
    return history.select("ticker", F.col("date").alias("signal_date"), "sector").unionByName(calls)


# ------------------------------------------------------------------- landed files
def _of_region(pick: int) -> Column:
    """A field of the sector map's row of a region."""
    m = F.create_map(*[F.lit(x) for region, i in REGION_SECTOR.items() for x in (region, SECTOR_MAP[i][pick])])
    return m[F.col("r_name")]


def fund_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets as text (etf, value): suppliers by balance, in the fund of their region, at most
    ``SHEET_ROWS`` a sheet.  Six columns with quoted names; one region has three, in another
    order and with other line ends, one lacks the weights, one has a quote too many, and one
    lists names and weights alone."""
    sr = _supplier_region(spark, sf_dir, "s_name", "s_acctbal")
    balance, weight = F.col("s_acctbal"), F.col("s_acctbal").cast("string")
    symbol = F.coalesce(F.when(balance >= SYMBOLLESS_BALANCE, _symbol()), F.lit(""))
    name = F.when(balance < NAMELESS_BALANCE, F.concat(F.lit('"'), F.col("s_name"), F.lit(', ""'), F.col("n_name"), F.lit('"""')))
    name = F.coalesce(name, F.lit(""))
    key, region = F.col("s_suppkey").cast("string"), F.col("r_name")
    line = (F.when(region == NARROW_REGION, F.concat_ws(" , ", symbol, name, weight))
            .when(region == WEIGHTLESS_REGION, F.concat_ws(",", name, symbol, key, F.lit(""), region))
            .when(region == NAMES_ONLY_REGION, F.concat_ws(",", name, weight))
            .otherwise(F.concat_ws(",", name, symbol, key, F.lit(""), weight, region)))
    header = (F.when(region == NARROW_REGION, " Ticker , Name , Weight ")
              .when(region == WEIGHTLESS_REGION, "Name,Ticker,Identifier,SEDOL,Sector")
              .when(region == NAMES_ONLY_REGION, "Name,Weight")
              .otherwise("Name,Ticker,Identifier,SEDOL,Weight,Sector"))
    title = F.when(region == BROKEN_REGION, F.lit('Fund "A')).otherwise(F.lit("Fund"))
    rows = sr.select(_of_region(2).alias("etf"), "r_name", F.floor(F.col("s_suppkey") / SHEET_ROWS).alias("volume"),
                     (-balance).alias("_order"), "s_suppkey", line.alias("line"), header.alias("header"), title.alias("title"))
    sheets = rows.groupBy("etf", "r_name", "volume", "header", "title").agg(
        F.sort_array(F.collect_list(F.struct("_order", "s_suppkey", "line"))).alias("lines"))
    end = F.when(region == NARROW_REGION, F.lit("\r\n")).otherwise(F.lit("\n"))
    parts = F.concat(F.array("title", F.lit("Holdings:"), F.lit("As of, today"), F.lit(""), "header"), F.col("lines.line"))
    return sheets.select("etf", F.array_join(parts, "\x1f").alias("value"), end.alias("end")).select(
        "etf", F.concat(F.replace("value", F.lit("\x1f"), F.col("end")), F.col("end")).alias("value"))


def member_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The membership list by the names of the sector map."""
    return _supplier_region(spark, sf_dir, "s_name").select(
        _symbol().alias("Symbol"), F.col("s_name").alias("Security"), _of_region(0).alias("GICS Sector"))


def feed_files(spark: SparkSession, sf_dir: str, silver: DataFrame, dim: DataFrame) -> DataFrame:
    """The price feed as lines of wide files (block, value): every date of Silver with the
    tickers of the block, at most ``FEED_TICKERS``; the cells of a missing bar are empty.

    Bars are dealt out by block as they are in Silver, and become lines in the task that
    writes the block; its header rows are lines of the same kind.
    """
    number = F.substring("ticker", 2, 20).try_cast("bigint")
    placed = dim.select("ticker", F.coalesce(F.floor(number / FEED_TICKERS) + 1, F.lit(0)).alias("block"))
    blocks = placed.groupBy("block").agg(F.sort_array(F.collect_list("ticker")).alias("tickers")).select(
        "block", F.size("tickers").alias("width"), "tickers")
    places = blocks.select("block", "width", F.posexplode("tickers").alias("place", "ticker"))
    types = {m: silver.schema[m.lower()].dataType for m in METRICS}

    def cells(rows: DataFrame, first: Column, cell: Column) -> DataFrame:
        return rows.select("block", "width", first.cast("string").alias("first"), cell.alias("cell"))

    bars = cells(silver.join(places, "ticker"), F.col("date"), F.struct("place", F.struct(
        F.lit(None).cast("string").alias("ticker"), *[F.col(m.lower()).alias(m) for m in METRICS]).alias("cell")))
    names = cells(places, F.lit(TICKER_ROW), F.struct("place", F.struct(
        "ticker", *[F.lit(None).cast(t).alias(m) for m, t in types.items()]).alias("cell")))
    # the lines that a block must have, whether it has a bar on that date or not
    firsts = silver.select(F.col("date").cast("string").alias("first")).distinct().unionByName(
        spark.createDataFrame([(METRIC_ROW,), (DATE_ROW,)], "first string"))
    every = cells(blocks.crossJoin(firsts), F.col("first"), F.lit(None).cast(bars.schema["cell"].dataType))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = (bars.unionByName(names).unionByName(every).repartition(parts, "block").groupBy("block", "width", "first")
             .agg(F.map_from_entries(F.collect_list("cell")).alias("cells")))
    full = lines.select("block", "width", "first", F.transform(
        F.sequence(F.lit(0), F.col("width") - 1), lambda place: F.try_element_at("cells", place)).alias("row"))

    def column(metric: str) -> Column:
        texts = (F.when(F.col("first") == METRIC_ROW, F.array_repeat(F.lit(metric), F.col("width")))
                 .when(F.col("first") == TICKER_ROW, F.col("row").getField("ticker"))
                 .otherwise(F.col("row").getField(metric).cast("array<string>")))
        return F.array_join(texts, ",", "")
    return full.select("block", F.concat_ws(",", "first", *[column(m) for m in METRICS]).alias("value"))


def news_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News as JSON lines (ticker, value), by desk; columns differ, and some lines are cut off."""
    source = F.col("source")
    row = F.to_json(F.struct("doc_id", F.when(source != NO_LANG, F.col("lang")).alias("lang"),
                             F.when(source == WITH_LENGTH, F.col("n_chars")).alias("n_chars"), "text"))
    cut = (source == CUT_OFF) & (F.col("lang") == CUT_LANG)
    return news(spark, sf_dir).where(source.isNotNull() & (source != NO_FILE)).select(
        source.alias("ticker"), F.when(cut, F.substring(row, F.lit(1), F.length(row) - 2)).otherwise(row).alias("value"))


def desks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The desks that cover a ticker."""
    return news_coverage(spark, sf_dir).select(F.col("source").alias("ticker")).distinct()

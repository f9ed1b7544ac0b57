"""Independent DuckDB SQL for every registered result (the correctness oracle).

The forms differ from the Spark plans: keep-best dedupe is ``QUALIFY row_number() = 1``;
index anchors are joined back on their dates; spike baselines are frames of whole rows;
sector returns are products; a trade's legs are unnested from lists over the series.  Shared numeric rules: rounding through
``DECIMAL(28,10)`` (half away from zero), the spike test in integers, and explicit NULL
ordering.  Tables of the driver's test data are pre-registered views.
"""

from __future__ import annotations

AS_OF = "DATE '2001-06-30'"
SIGNAL_START, SIGNAL_END = "DATE '2000-01-01'", "DATE '2000-12-31'"
BENCH = "'^AMERICA'"


def R(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


SUPPLIER_REGION = """supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _raw_branch(ticker: str) -> str:
    p = "(l.l_extendedprice / l.l_quantity)"
    return f"""SELECT l.l_shipdate AS "Date", {ticker} AS "Ticker",
         {p} AS "Open", {p} * (1 + l.l_tax / 2) AS "High",
         {p} * (1 - l.l_discount) AS "Low", {p} * (CAST(0.97 AS DOUBLE) + l.l_tax) AS "Close",
         CAST(floor(l.l_quantity * l.l_extendedprice) AS BIGINT) AS "Volume"
  FROM lineitem l JOIN {SUPPLIER_REGION} ON l.l_suppkey = s.s_suppkey"""


CTE: dict[str, str] = {}
ORDER: list[str] = []


def cte(name: str, sql: str) -> None:
    CTE[name] = sql
    ORDER.append(name)


cte("raw", f"""{_raw_branch("'S' || CAST(l.l_suppkey AS VARCHAR)")}
  UNION ALL
  {_raw_branch("'^' || r.r_name")}""")

cte("silver", """SELECT CAST("Date" AS DATE) AS date, "Ticker" AS ticker, "Open" AS open,
         "High" AS high, "Low" AS low, "Close" AS close, "Volume" AS volume
  FROM raw
  WHERE "Date" IS NOT NULL AND "Ticker" IS NOT NULL
    AND "Open" > 0 AND "High" > 0 AND "Low" > 0 AND "Close" > 0
    AND "Volume" > 0
    AND "High" >= "Open" AND "High" >= "Close"
    AND "Low" <= "Open" AND "Low" <= "Close"
  QUALIFY row_number() OVER (PARTITION BY CAST("Date" AS DATE), "Ticker"
                             ORDER BY "Volume" DESC NULLS LAST, "Open", "High", "Low", "Close") = 1""")

cte("dim", f"""SELECT '^' || r_name AS ticker, r_name AS name, CAST(NULL AS VARCHAR) AS sector,
         CASE r_name WHEN 'AMERICA' THEN 'US' WHEN 'AFRICA' THEN 'FR' WHEN 'EUROPE' THEN 'UK'
                     WHEN 'ASIA' THEN 'JP' WHEN 'MIDDLE EAST' THEN 'IN' END AS market,
         'index' AS type, 'manual' AS source, CAST(NULL AS VARCHAR) AS etf
  FROM region
  UNION ALL
  SELECT 'S' || CAST(s.s_suppkey AS VARCHAR), s.s_name, r.r_name, 'US', 'stock', 'spdr',
         'X' || substr(r.r_name, 1, 2)
  FROM {SUPPLIER_REGION}
  WHERE s.s_acctbal >= 0""")

cte("daily_returns", f"""SELECT date, ticker, close, LAG(close) OVER w AS prev_close,
         {R("(close - LAG(close) OVER w) / LAG(close) OVER w * 100", 2)} AS daily_return_pct
  FROM silver WINDOW w AS (PARTITION BY ticker ORDER BY date)""")

cte("index_performance", f"""WITH bar AS (
    SELECT p.ticker, d.name, d.market, p.date, p.close
    FROM silver p JOIN dim d ON d.ticker = p.ticker AND d.type = 'index'
    WHERE p.date <= {AS_OF}),
  anchor AS (
    SELECT t.ticker, t.name, t.market, t.day0, t.day1,
           (SELECT max(b.date) FROM bar b WHERE b.ticker = t.ticker AND b.date < t.day1) AS day_before,
           (SELECT min(b.date) FROM bar b WHERE b.ticker = t.ticker AND year(b.date) = year({AS_OF})) AS new_year
    FROM (SELECT ticker, name, market, min(date) AS day0, max(date) AS day1 FROM bar GROUP BY ALL) t)
  SELECT a.ticker, a.name, a.market, a.day1 AS latest_date,
         {R("now.close", 2)} AS close,
         {R("(now.close - yesterday.close) / yesterday.close * 100", 2)} AS return_1d_pct,
         {R("(now.close - january.close) / january.close * 100", 2)} AS return_ytd_pct,
         {R("(now.close - start.close) / start.close * 100", 2)} AS return_2y_pct
  FROM anchor a
  JOIN bar now ON now.ticker = a.ticker AND now.date = a.day1
  JOIN bar start ON start.ticker = a.ticker AND start.date = a.day0
  LEFT JOIN bar yesterday ON yesterday.ticker = a.ticker AND yesterday.date = a.day_before
  LEFT JOIN bar january ON january.ticker = a.ticker AND january.date = a.new_year""")

_WEEK = f"p.date BETWEEN {AS_OF} - 7 AND {AS_OF}"

_RANGE_COLS = f"""{R("MAX(p.high) - MIN(p.low)", 2)} AS weekly_range,
         {R("MIN(p.low)", 2)} AS low_price, {R("MAX(p.high)", 2)} AS high_price,
         COUNT(*) AS trading_days"""

cte("top_movers", f"""SELECT p.ticker, {_RANGE_COLS}
  FROM silver p
  WHERE {_WEEK} AND p.ticker IN (SELECT ticker FROM dim WHERE type = 'stock')
  GROUP BY p.ticker
  ORDER BY weekly_range DESC NULLS FIRST, p.ticker LIMIT 5""")

cte("sector_top_movers", f"""WITH wk AS (
    SELECT p.ticker, d.name, d.sector, d.etf, {_RANGE_COLS}
    FROM silver p JOIN dim d ON d.ticker = p.ticker AND d.type = 'stock'
    WHERE {_WEEK}
    GROUP BY p.ticker, d.name, d.sector, d.etf)
  SELECT *, CAST(row_number() OVER (PARTITION BY sector
                 ORDER BY weekly_range DESC NULLS FIRST, ticker) AS INTEGER) AS rank_in_sector
  FROM wk
  QUALIFY rank_in_sector <= 3""")


cte("numbered", """SELECT p.ticker, p.date, p.open, p.close, p.volume,
         row_number() OVER (PARTITION BY p.ticker ORDER BY p.date) AS i
  FROM silver p""")

cte("whale_signals_history", f"""SELECT a.ticker, d.name, d.sector, a.date, a.close, a.volume,
         {R("a.past / a.days", 0)} AS avg_volume_20d,
         {R("a.volume / nullif(a.past / a.days, 0)", 2)} AS volume_ratio
  FROM (SELECT ticker, date, close, volume, sum(volume) OVER w AS past, count(*) OVER w AS days
        FROM silver WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)) a
  JOIN dim d ON d.ticker = a.ticker AND d.type = 'stock'
  WHERE a.days > 0 AND a.volume * a.days * 2 > a.past * 5""")

cte("whale_signals", f"""SELECT * FROM whale_signals_history WHERE date BETWEEN {AS_OF} - 7 AND {AS_OF}""")

cte("sector_performance", f"""WITH gain AS (
    SELECT d.sector, b.ticker, b.date,
           {R("(b.close - a.close) / a.close * 100", 2)} AS pct
    FROM numbered b
    JOIN dim d ON d.ticker = b.ticker AND d.type = 'stock' AND d.sector IS NOT NULL
    LEFT JOIN numbered a ON a.ticker = b.ticker AND a.i = b.i - 1
    WHERE b.date BETWEEN {AS_OF} - 30 AND {AS_OF}),
  whole AS (
    SELECT sector, ticker,
           {R("(product(1 + pct / 100) FILTER (WHERE 1 + pct / 100 > 0) - 1) * 100", 2)} AS growth
    FROM gain GROUP BY sector, ticker),
  ends AS (
    SELECT sector,
           list({'{'}'t': ticker, 'g': growth{'}'} ORDER BY growth DESC NULLS FIRST, ticker)[1] AS top,
           list({'{'}'t': ticker, 'g': growth{'}'} ORDER BY growth ASC NULLS LAST, ticker)[1] AS bottom
    FROM whole GROUP BY sector)
  SELECT sector, count(DISTINCT gain.ticker) AS num_tickers,
         {R("avg(pct)", 3)} AS avg_daily_return_pct, {R("min(pct)", 3)} AS worst_day_pct,
         {R("max(pct)", 3)} AS best_day_pct,
         any_value(ends.top.t) AS best_ticker, any_value(ends.top.g) AS best_return_pct,
         any_value(ends.bottom.t) AS worst_ticker, any_value(ends.bottom.g) AS worst_return_pct
  FROM gain JOIN ends USING (sector) GROUP BY sector""")

cte("series", """SELECT ticker, date, lead(date, 1) OVER w AS entry_date, lead(open, 1) OVER w AS entry_price,
         [{'h': 3, 'd': lead(date, 4) OVER w, 'c': lead(close, 4) OVER w},
          {'h': 5, 'd': lead(date, 6) OVER w, 'c': lead(close, 6) OVER w},
          {'h': 10, 'd': lead(date, 11) OVER w, 'c': lead(close, 11) OVER w}] AS exits
  FROM silver WINDOW w AS (PARTITION BY ticker ORDER BY date)""")

cte("bench", f"""SELECT date, close FROM silver WHERE ticker = {BENCH}""")


def _trades(signals: str) -> str:
    return f"""WITH legs AS (
    SELECT s.ticker, s.sector, s.signal_date, p.entry_date, p.entry_price, unnest(p.exits) AS x
    FROM ({signals}) s JOIN series p ON p.ticker = s.ticker AND p.date = s.signal_date
    WHERE p.entry_price > 0),
  t AS (
    SELECT l.ticker, l.sector, l.signal_date, l.entry_date, l.entry_price, l.x.h AS hold_days, l.x.d AS exit_date,
           l.x.c AS exit_price, (l.x.c - l.entry_price) / l.entry_price * 100 AS ret,
           CASE WHEN be.close > 0 THEN (bx.close - be.close) / be.close * 100 END AS bret
    FROM legs l LEFT JOIN bench be ON be.date = l.entry_date LEFT JOIN bench bx ON bx.date = l.x.d
    WHERE l.x.c > 0)
  SELECT ticker, sector, signal_date, entry_date, {R("entry_price", 4)} AS entry_price,
         exit_date, {R("exit_price", 4)} AS exit_price, CAST(hold_days AS INTEGER) AS hold_days,
         {R("ret", 4)} AS return_pct, {R("bret", 4)} AS bench_return_pct,
         {R("ret - bret", 4)} AS alpha_pct, ret > 0 AS profitable
  FROM t"""


_SPIKES = "SELECT ticker, date AS signal_date, sector FROM whale_signals_history"

cte("backtest_trades", _trades(_SPIKES))

cte("backtest_given_signals", _trades(f"""{_SPIKES}
    UNION ALL
    SELECT c.kind || CAST(s.s_suppkey AS VARCHAR), DATE '1999-06-17', r.r_name
    FROM (VALUES ('S'), ('X')) c(kind), {SUPPLIER_REGION}"""))

cte("backtest_summary", f"""SELECT hold_days, COUNT(*) AS n_trades,
         {R("AVG(CAST(profitable AS INTEGER)) * 100", 4)} AS win_rate_pct,
         {R("AVG(return_pct)", 4)} AS avg_return_pct,
         {R("MEDIAN(return_pct)", 5)} AS median_return_pct,
         MAX(return_pct) AS best_pct, MIN(return_pct) AS worst_pct,
         {R("AVG(alpha_pct)", 4)} AS avg_alpha_pct
  FROM backtest_trades GROUP BY hold_days""")

cte("backtest_top_trades", """SELECT ticker, signal_date, hold_days, return_pct, alpha_pct
  FROM backtest_trades
  ORDER BY return_pct DESC, ticker, signal_date, hold_days LIMIT 5""")

cte("signals_in_range", f"""SELECT ticker, date AS signal_date, sector FROM whale_signals_history
  WHERE date >= {SIGNAL_START} AND date <= {SIGNAL_END}""")


def _nn(table: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{col}' AS column_names, "
            f"CAST((SELECT count(*) FROM {table} WHERE {col} IS NULL) AS BIGINT) AS failures")


def _uq(table: str, cols: str, check: str = "unique") -> str:
    # the single-column test skips NULL keys; the combination test does not
    cond = f"{cols} IS NOT NULL" if "," not in cols else "TRUE"
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{cols}' AS column_names, "
            f"CAST((SELECT count(*) FROM (SELECT {cols} FROM {table} WHERE {cond} GROUP BY {cols} "
            f"HAVING count(*) > 1)) AS BIGINT) AS failures")


cte("tickers", f"""SELECT CASE WHEN s_acctbal >= 0 THEN 'S' || CAST(s_suppkey AS VARCHAR) END AS ticker, 'stock' AS type
  FROM {SUPPLIER_REGION}
  UNION ALL SELECT n_name, 'country' FROM nation
  UNION ALL SELECT 'N' || CAST(n_regionkey AS VARCHAR), 'index' FROM nation""")

cte("quality_report", "\n  UNION ALL ".join([
    _uq("silver", "date,ticker", "unique_combination_of_columns").replace("'silver'", "'stg_stock_prices'", 1),
    *[_nn("silver", c).replace("'silver'", "'stg_stock_prices'", 1)
      for c in ("date", "ticker", "open", "high", "low", "close", "volume")],
    *[_nn("daily_returns", c) for c in ("date", "ticker", "close")],
    _nn("top_movers", "ticker"), _uq("top_movers", "ticker"),
    _nn("index_performance", "ticker"), _uq("index_performance", "ticker"),
    _nn("sector_top_movers", "ticker"), _nn("sector_top_movers", "sector"),
    _nn("whale_signals", "ticker"), _nn("whale_signals", "date"),
    _nn("whale_signals_history", "ticker"), _nn("whale_signals_history", "date"),
    _nn("tickers", "ticker"), _nn("tickers", "type"), _uq("tickers", "ticker"),
    "SELECT 'tickers', 'accepted_values', 'type', CAST((SELECT count(*) FROM (SELECT DISTINCT type "
    "FROM tickers WHERE type NOT IN ('stock', 'index'))) AS BIGINT)",
    "SELECT 'index_performance', 'assert_index_markets_are_valid', '', CAST((SELECT count(*) "
    "FROM index_performance WHERE market NOT IN ('US', 'FR', 'UK', 'JP', 'IN')) AS BIGINT)",
]))

# ------------------------------------------------------------------- ingest inputs
_LETTERS = "translate(CAST(s.s_suppkey AS VARCHAR), '0123456789', 'ABCDEFGHIJ')"

_SYMBOL = f"""{_LETTERS} || CASE WHEN n.n_name IN ('BRAZIL', 'CHINA', 'EGYPT', 'FRANCE', 'IRAN', 'IRAQ')
              THEN '.A' ELSE '' END"""

cte("holdings", f"""SELECT CASE WHEN s.s_acctbal >= -500 THEN {_SYMBOL} END AS "Ticker",
         CASE WHEN s.s_acctbal < 9000 THEN s.s_name END AS "Name", s.s_acctbal AS "Weight",
         'X' || substr(r.r_name, 1, 2) AS etf, r.r_name AS label
  FROM {SUPPLIER_REGION} WHERE r.r_name <> 'MIDDLE EAST'""")

cte("membership", f"""SELECT {_SYMBOL} AS "Symbol", s.s_name AS "Security", r.r_name AS "GICS Sector"
  FROM {SUPPLIER_REGION}""")

cte("sector_map", """SELECT r_name AS source_sector, r_name AS label,
         'X' || substr(r_name, 1, 2) AS etf FROM region""")

cte("ticker_dimension", """WITH prim AS (
    SELECT "Ticker" AS ticker, coalesce("Name", '') AS name, label AS sector, 'US' AS market,
           'stock' AS type, 'spdr' AS source, etf
    FROM holdings
    WHERE "Ticker" IS NOT NULL AND regexp_matches("Ticker", '^[A-Z]{1,5}$')
    QUALIFY row_number() OVER (PARTITION BY etf ORDER BY "Weight" DESC NULLS LAST, "Ticker") <= 5),
  fb AS (
    SELECT replace(m."Symbol", '.', '-') AS ticker, m."Security" AS name, sm.label AS sector,
           'US' AS market, 'stock' AS type, 'wikipedia_sp500' AS source, sm.etf
    FROM membership m JOIN sector_map sm ON m."GICS Sector" = sm.source_sector
    WHERE m."Symbol" IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY sm.source_sector ORDER BY m."Symbol") <= 5)
  SELECT * FROM dim WHERE type = 'index'
  UNION ALL SELECT * FROM prim
  UNION ALL SELECT * FROM fb WHERE etf NOT IN (SELECT DISTINCT etf FROM holdings)""")


def _screen(index: str, cond: str, shift: str) -> str:
    return f"""SELECT 'P' || CAST(p_partkey AS VARCHAR) AS "Ticker",
         CAST(CAST(p_retailprice % 20 - 10{shift} AS DECIMAL(10,2)) AS VARCHAR) || '%' AS "Change",
         CAST(CAST(p_size AS DECIMAL(10,2)) AS VARCHAR)
           || CASE WHEN p_retailprice >= 950 THEN 'M' ELSE 'K' END AS "Volume",
         '{index}' AS "index",
         CASE WHEN p_brand IN ('Brand#1', 'Brand#10') THEN 'Strong Buy (1)' ELSE 'Hold (3)' END
           AS recommendation
  FROM part WHERE {cond}"""


cte("screener", f"""{_screen("S&P 500", "p_size >= 10", "")}
  UNION ALL
  {_screen("NASDAQ 100", "p_retailprice >= 950", " + 0.5")}""")

cte("volatile_pick", """WITH firsts AS (
    SELECT "Ticker" AS ticker, abs(TRY_CAST(replace("Change", '%', '') AS DOUBLE)) AS abs_change
    FROM screener WHERE "index" IN ('S&P 500', 'NASDAQ 100')
    QUALIFY row_number() OVER (PARTITION BY "Ticker"
                               ORDER BY CASE "index" WHEN 'S&P 500' THEN 0 ELSE 1 END) = 1)
  SELECT ticker, abs_change FROM firsts WHERE abs_change IS NOT NULL
  ORDER BY abs_change DESC, ticker LIMIT 5""")

cte("analyst_pick", """WITH parsed AS (
    SELECT "Ticker" AS ticker,
           TRY_CAST(replace(replace("Volume", 'M', 'e6'), 'K', 'e3') AS DOUBLE) AS vol_num
    FROM screener WHERE "index" = 'S&P 500' AND recommendation = 'Strong Buy (1)')
  SELECT ticker, vol_num FROM parsed WHERE vol_num IS NOT NULL
  ORDER BY vol_num DESC, ticker LIMIT 5""")

cte("ingest_universe", """SELECT DISTINCT ticker FROM (
    SELECT ticker FROM dim WHERE type IN ('stock', 'index')
    UNION ALL SELECT ticker FROM volatile_pick
    UNION ALL SELECT ticker FROM analyst_pick)""")

cte("wide_to_long", f"""SELECT d.date AS "Date", t.ticker AS "Ticker", s.open AS "Open", s.high AS "High",
         s.low AS "Low", s.close AS "Close", s.volume AS "Volume"
  FROM (SELECT DISTINCT date FROM silver) d CROSS JOIN (SELECT ticker FROM dim) t
  LEFT JOIN silver s ON s.date = d.date AND s.ticker = t.ticker
  WHERE d.date >= CAST({AS_OF} - INTERVAL 24 MONTH AS DATE) AND d.date < {AS_OF}""")

cte("news_snapshot", """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, v.ticker
  FROM volatile_pick v
  JOIN part p ON v.ticker = 'P' || CAST(p.p_partkey AS VARCHAR)
  JOIN documents d ON d.source = 'src' || CAST(p.p_size // 3 AS VARCHAR)""")

cte("tickers_csv", """SELECT ticker, nullif(name, '') AS name, sector, market, type, source, etf FROM ticker_dimension""")

cte("bronze_round_trip", """SELECT "Ticker", count(*) AS bars, CAST(min("Date") AS DATE) AS first_date,
         CAST(max("Date") AS DATE) AS last_date, CAST(sum("Volume") AS BIGINT) AS volume
  FROM raw GROUP BY "Ticker\"""")

cte("silver_view", """SELECT ticker, count(*) AS bars, max(date) AS last_date FROM silver GROUP BY ticker""")

# ------------------------------------------------------------------ landed files
_SECTORS = """(VALUES ('AMERICA', 'Information Technology', 'Technology', 'XLK'), ('MIDDLE EAST', 'Financials', 'Financial', 'XLF'),
          ('EUROPE', 'Health Care', 'Healthcare', 'XLV'), ('ASIA', 'Consumer Discretionary', 'Consumer', 'XLY'),
          ('AFRICA', 'Energy', 'Energy', 'XLE')) m(region, source_sector, label, etf)"""

cte("landed_holdings", f"""SELECT CASE WHEN s.s_acctbal >= -500 THEN {_SYMBOL} END AS "Ticker",
         CASE WHEN s.s_acctbal < 9000 THEN s.s_name || ', "' || n.n_name || '"' END AS "Name",
         CASE WHEN r.r_name <> 'ASIA' THEN s.s_acctbal END AS "Weight", m.etf,
         CAST(row_number() OVER (PARTITION BY m.etf, s.s_suppkey // 1000 ORDER BY s.s_acctbal DESC, s.s_suppkey) - 1 AS INTEGER) AS line
  FROM {SUPPLIER_REGION} JOIN {_SECTORS} ON m.region = r.r_name
  WHERE r.r_name IN ('AMERICA', 'ASIA', 'AFRICA')""")

cte("rejected_sheets", f"""SELECT m.etf, CASE r.r_name WHEN 'EUROPE' THEN 'unbalanced quote' ELSE 'no column Ticker' END AS reason,
         count(DISTINCT s.s_suppkey // 1000) AS sheets
  FROM {SUPPLIER_REGION} JOIN {_SECTORS} ON m.region = r.r_name
  WHERE r.r_name IN ('EUROPE', 'MIDDLE EAST') GROUP BY ALL""")

cte("landed_dimension", f"""WITH prim AS (
    SELECT h."Ticker" AS ticker, coalesce(h."Name", '') AS name, m.label AS sector, 'US' AS market, 'stock' AS type,
           'spdr' AS source, h.etf
    FROM landed_holdings h JOIN {_SECTORS} ON m.etf = h.etf
    WHERE regexp_matches(h."Ticker", '^[A-Z]{{1,5}}$')
    QUALIFY row_number() OVER (PARTITION BY h.etf ORDER BY h."Weight" DESC NULLS LAST, h.line, h."Ticker") <= 5),
  fb AS (
    SELECT replace(x.symbol, '.', '-') AS ticker, x.s_name AS name, x.label AS sector, 'US' AS market, 'stock' AS type,
           'wikipedia_sp500' AS source, x.etf
    FROM (SELECT {_SYMBOL} AS symbol, s.s_name, m.label, m.etf
          FROM {SUPPLIER_REGION} JOIN {_SECTORS} ON m.region = r.r_name) x
    WHERE x.etf NOT IN (SELECT etf FROM landed_holdings)
    QUALIFY row_number() OVER (PARTITION BY x.etf ORDER BY x.symbol) <= 5)
  SELECT ticker, name, CAST(NULL AS VARCHAR) AS sector, market, 'index' AS type, 'manual' AS source, CAST(NULL AS VARCHAR) AS etf
  FROM (VALUES ('^GSPC', 'S&P 500', 'US'), ('^FCHI', 'CAC 40', 'FR'), ('^FTSE', 'FTSE 100', 'UK'),
               ('^N225', 'Nikkei 225', 'JP'), ('^BSESN', 'Sensex', 'IN')) i(ticker, name, market)
  UNION ALL SELECT * FROM prim UNION ALL SELECT * FROM fb""")

cte("landed_volatile_pick", "SELECT * FROM volatile_pick")

cte("feed_header", """SELECT ticker, CAST(1 AS BIGINT) AS files, CAST(5 AS BIGINT) AS metrics, CAST(5 AS BIGINT) AS columns FROM dim""")

cte("landed_news_status", """SELECT t.ticker, coalesce(c.n_rows, 0) AS n_rows,
         CASE WHEN c.n_rows IS NULL THEN 'absent or empty' WHEN c.n_cut > 0 THEN 'malformed line' END AS reason
  FROM (SELECT DISTINCT 'src' || CAST(p_size // 3 AS VARCHAR) AS ticker FROM part) t
  LEFT JOIN (SELECT source AS ticker, count(*) AS n_rows, count(*) FILTER (WHERE source = 'src11' AND lang = 'de') AS n_cut
             FROM documents WHERE source <> 'src7' GROUP BY source) c USING (ticker)""")

cte("landed_news", """SELECT doc_id, CASE WHEN source <> 'src2' THEN lang END AS lang,
         CASE WHEN source = 'src4' THEN n_chars END AS n_chars, text, source AS ticker
  FROM documents WHERE source IN (SELECT ticker FROM landed_news_status WHERE reason IS NULL)""")

# ------------------------------------------------------- dated runs, counts, checks
cte("dated_backtest", _trades(f"{_SPIKES} WHERE date BETWEEN DATE '2000-06-01' AND DATE '2000-06-30'"))

cte("run_counts", """SELECT 'raw_rows' AS name, (SELECT count(*) FROM raw) AS n
  UNION ALL SELECT 'silver_rows', (SELECT count(*) FROM silver)
  UNION ALL SELECT 'returns', (SELECT count(*) FROM silver)
  UNION ALL SELECT 'tickers', (SELECT count(DISTINCT ticker) FROM silver)
  UNION ALL SELECT 'signals', (SELECT count(*) FROM whale_signals_history)
  UNION ALL SELECT 'signal_tickers', (SELECT count(DISTINCT ticker) FROM whale_signals_history)
  UNION ALL SELECT 'trades', (SELECT count(*) FROM backtest_trades)""")

cte("failing_tickers", """SELECT ticker, type, 'not_null' AS check_name, 'ticker' AS column_names FROM tickers WHERE ticker IS NULL
  UNION ALL SELECT ticker, type, 'not_null', 'type' FROM tickers WHERE type IS NULL
  UNION ALL SELECT ticker, type, 'accepted_values', 'type' FROM tickers WHERE type NOT IN ('stock', 'index')
  UNION ALL SELECT ticker, type, 'unique', 'ticker' FROM tickers
  WHERE ticker IN (SELECT ticker FROM tickers GROUP BY ticker HAVING count(*) > 1)""")

cte("singular_checks", """SELECT check_name, failures, failures = 0 AS passed FROM (
    SELECT 'assert_index_markets_are_valid' AS check_name,
           (SELECT count(*) FROM index_performance WHERE market NOT IN ('US', 'FR', 'UK', 'JP', 'IN')) AS failures
    UNION ALL SELECT 'assert_signals_have_a_price',
           (SELECT count(*) FROM whale_signals_history s LEFT JOIN silver p ON p.ticker = s.ticker AND p.date = s.date
            WHERE p.ticker IS NULL)
    UNION ALL SELECT 'assert_landed_tickers_are_in_the_dimension',
           (SELECT count(*) FROM (SELECT DISTINCT t.ticker FROM tickers t LEFT JOIN dim ON dim.ticker = t.ticker
                                  WHERE dim.ticker IS NULL)))""")

# which CTEs each result needs (transitively resolved below)
DEPS: dict[str, tuple[str, ...]] = {
    "raw": (), "silver": ("raw",), "dim": (),
    "daily_returns": ("silver",),
    "index_performance": ("silver", "dim"),
    "top_movers": ("silver", "dim"),
    "sector_top_movers": ("silver", "dim"),
    "numbered": ("silver",),
    "whale_signals": ("whale_signals_history",),
    "whale_signals_history": ("silver", "dim"), "series": ("silver",), "bench": ("silver",),
    "sector_performance": ("numbered", "dim"),
    "backtest_trades": ("series", "bench", "whale_signals_history"),
    "backtest_given_signals": ("series", "bench", "whale_signals_history"),
    "backtest_summary": ("backtest_trades",),
    "backtest_top_trades": ("backtest_trades",),
    "signals_in_range": ("whale_signals_history",),
    "tickers": (),
    "quality_report": ("silver", "tickers", "daily_returns", "top_movers", "index_performance",
                       "sector_top_movers", "whale_signals", "whale_signals_history"),
    "holdings": (), "membership": (), "sector_map": (),
    "ticker_dimension": ("dim", "holdings", "membership", "sector_map"),
    "screener": (),
    "volatile_pick": ("screener",), "analyst_pick": ("screener",),
    "ingest_universe": ("dim", "volatile_pick", "analyst_pick"),
    "wide_to_long": ("silver", "dim"),
    "news_snapshot": ("volatile_pick",),
    "tickers_csv": ("ticker_dimension",),
    "bronze_round_trip": ("raw",),
    "silver_view": ("silver",),
    "landed_holdings": (), "rejected_sheets": (), "landed_dimension": ("landed_holdings",),
    "landed_volatile_pick": ("volatile_pick",), "feed_header": ("dim",),
    "landed_news_status": (), "landed_news": ("landed_news_status",),
    "dated_backtest": ("series", "bench", "whale_signals_history"),
    "run_counts": ("raw", "silver", "whale_signals_history", "backtest_trades"), "failing_tickers": ("tickers",),
    "singular_checks": ("index_performance", "whale_signals_history", "silver", "tickers", "dim"),
}


def _closure(name: str) -> list[str]:
    need: set[str] = set()

    def visit(n: str) -> None:
        for d in DEPS[n]:
            if d not in need:
                need.add(d)
                visit(d)
    visit(name)
    return [n for n in ORDER if n in need]


def query(name: str) -> str:
    deps = _closure(name)
    if not deps:
        return CTE[name]
    withs = ",\n".join(f"{d} AS MATERIALIZED (\n  {CTE[d]}\n)" for d in deps)
    return f"WITH {withs}\nSELECT * FROM (\n  {CTE[name]}\n) q"


RESULTS = ("stg_stock_prices", "daily_returns", "index_performance", "top_movers",
           "sector_top_movers", "whale_signals", "whale_signals_history", "sector_performance",
           "backtest_trades", "backtest_summary", "backtest_top_trades", "quality_report",
           "ticker_dimension", "volatile_pick", "analyst_pick", "ingest_universe",
           "wide_to_long", "news_snapshot", "signals_in_range", "backtest_given_signals",
           "tickers_csv", "bronze_round_trip", "silver_view", "feed_header", "landed_holdings",
           "rejected_sheets", "landed_dimension", "landed_volatile_pick", "landed_news", "landed_news_status",
           "dated_backtest", "run_counts", "failing_tickers", "singular_checks")

ORACLE_SQL: dict[str, str] = {
    n: (query("silver") if n == "stg_stock_prices" else query(n)) for n in RESULTS
}

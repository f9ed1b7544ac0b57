"""Constants whose values results must share with the original workload.

They are stated here once, in natural order; modules import them from here.
"""

from __future__ import annotations

from fractions import Fraction

# Fixed values.
SPIKE_WINDOW_ROWS = 20                 # trailing rows of the volume average (current row excluded)
SPIKE_RATIO = Fraction("2.5")          # a spike is volume strictly above 2.5 x that average
RECENT_DAYS = 7                        # calendar look-back of the recent marts (inclusive)
SECTOR_WINDOW_DAYS = 30                # calendar look-back of the sector analysis (inclusive)
HOLD_PERIODS = (3, 5, 10)              # trading days held after the next-day entry
TOP_MOVERS_N = 5                       # overall top movers
SECTOR_TOP_N = 3                       # top movers per sector
TOP_TRADES_N = 5                       # best trades in the backtest report
PER_SOURCE_N = 5                       # tickers taken from each ticker source
INGEST_MONTHS = 24                     # rolling ingest window
EQUITY_SYMBOL_PATTERN = r"^[A-Z]{1,5}$"  # holdings rows kept as equities
TICKER_TYPES = ("stock", "index")
KNOWN_MARKETS = ("US", "FR", "UK", "JP", "IN")
STOCK_MARKET = "US"
SOURCE_HOLDINGS, SOURCE_MEMBERSHIP, SOURCE_MANUAL = "spdr", "wikipedia_sp500", "manual"

# Index rows of the ticker dimension (ticker, name, market).
INDEX_ROWS = (
    ("^GSPC", "S&P 500", "US"),
    ("^FCHI", "CAC 40", "FR"),
    ("^FTSE", "FTSE 100", "UK"),
    ("^N225", "Nikkei 225", "JP"),
    ("^BSESN", "Sensex", "IN"),
)
# Source sector -> (label, fund).
SECTOR_MAP = (
    ("Information Technology", "Technology", "XLK"),
    ("Financials", "Financial", "XLF"),
    ("Health Care", "Healthcare", "XLV"),
    ("Consumer Discretionary", "Consumer", "XLY"),
    ("Energy", "Energy", "XLE"),
)

"""barlake: a Spark-native medallion engine for daily OHLCV market prices.

Bronze (landed raw files) -> Silver (typed, validated, keep-best deduplicated bars)
-> Gold (returns, index performance, movers, volume-spike signals, sector analysis,
signal backtest) plus data-quality checks, all written as DataFrame transformations
that Catalyst plans and optimises.  Every result that depends on "today" takes an
explicit ``as_of`` date.
"""

__version__ = "0.1.0"

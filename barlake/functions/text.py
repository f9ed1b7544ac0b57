"""Parsing of numbers and symbols that arrive as text in screener / holdings files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.fixed import EQUITY_SYMBOL_PATTERN
from barlake.functions.numeric import as_col


def parse_percent(c: Column | str) -> Column:
    """'-4.5%' -> -4.5; unparsable -> NULL (counted by the caller, never fatal)."""
    return F.replace(as_col(c), F.lit("%"), F.lit("")).try_cast("double")


def parse_magnitude(c: Column | str) -> Column:
    """'3.21M' -> 3210000.0, '950K' -> 950000.0; unparsable -> NULL."""
    s = F.replace(F.replace(as_col(c), F.lit("M"), F.lit("e6")), F.lit("K"), F.lit("e3"))
    return s.try_cast("double")


def symbol_ok(c: Column | str, pattern: str = EQUITY_SYMBOL_PATTERN) -> Column:
    c = as_col(c)
    return c.isNotNull() & c.rlike(pattern)


def dot_to_dash(c: Column | str) -> Column:
    """Class-share notation of the membership list ('BRK.B') to the price feed's ('BRK-B')."""
    return F.replace(as_col(c), F.lit("."), F.lit("-"))

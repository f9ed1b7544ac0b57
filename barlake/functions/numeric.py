"""Numeric rules shared by every result.

* Rounding is half away from zero on a decimal (the reference rounds ``x::numeric``),
  so the double is first brought to ``decimal(28,10)``; that also removes binary noise
  before the tie test.  The oracle SQL uses the same expression.
* Sums of rounded values, and of logarithms, are taken in decimals: exact, so they do not
  depend on the order of the rows or on the partitioning.
* Ratios against a rolling average are compared in integers, never in floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: Column | str, scale: int) -> Column:
    """Round half away from zero to ``scale`` decimals, result as double."""
    return F.round(as_col(c).cast("decimal(28,10)"), scale).cast("double")


def pct_change(new: Column | str, base: Column | str) -> Column:
    """(new - base) / base * 100; callers guarantee or guard a non-zero base."""
    new, base = as_col(new), as_col(base)
    return (new - base) / base * 100


def strictly_greater_ratio(value: Column | str, frame_sum: Column | str,
                           frame_count: Column | str, num: int, den: int) -> Column:
    """value > (frame_sum / frame_count) * num / den, exact in integer arithmetic.

    Equivalent to ``value > avg * (num/den)`` with the average taken over the frame;
    false when the frame is empty.
    """
    value, frame_sum, frame_count = as_col(value), as_col(frame_sum), as_col(frame_count)
    return (frame_count > 0) & (value * frame_count * den > frame_sum * num)


def guarded_ln_growth(return_pct: Column | str) -> Column:
    """ln(1 + r/100), NULL outside the logarithm's domain (r <= -100)."""
    g = F.lit(1) + as_col(return_pct) / 100
    return F.when(g > 0, F.ln(g))


def exact_sum(c: Column | str, scale: int) -> Column:
    """Sum of doubles with at most ``scale`` decimals, as a decimal: adding is exact."""
    return F.sum(as_col(c).cast(f"decimal(28,{scale})"))


def exact_mean(total: Column, count: Column, scale: int) -> Column:
    """total / count of a decimal or integer total, rounded half away from zero once, as
    double; NULL where the count is 0 or NULL."""
    total = total.cast("decimal(24,4)")
    mean = F.when(count > 0, total / count.cast("decimal(12,0)"))  # 17 decimals: far below the tie test
    return F.round(mean, scale).cast("double")


def exact_log_sum(c: Column | str) -> Column:
    """Sum of logarithms, each fixed to 18 decimals, so that adding is exact."""
    return F.sum(as_col(c).cast("decimal(28,18)")).cast("double")

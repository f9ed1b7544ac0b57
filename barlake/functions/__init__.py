"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from barlake.functions.numeric import (
    as_col, exact_log_sum, exact_mean, exact_sum, guarded_ln_growth, pct_change, round_half_up, strictly_greater_ratio,
)
from barlake.functions.text import dot_to_dash, parse_magnitude, parse_percent, symbol_ok

__all__ = [
    "as_col", "exact_log_sum", "exact_mean", "exact_sum", "guarded_ln_growth", "pct_change", "round_half_up", "strictly_greater_ratio",
    "dot_to_dash", "parse_magnitude", "parse_percent", "symbol_ok",
]

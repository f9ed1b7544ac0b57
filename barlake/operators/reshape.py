"""Wide (metric x ticker columns) to long (one row per date and ticker).

For a frame at hand, whose columns are in the plan anyway; wide files, whose header is
data, are read by ``sources.feeds``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEP = "|"


def wide_columns(metric: str, ticker: str) -> str:
    return f"{metric}{SEP}{ticker}"


def wide_to_long(wide: DataFrame, id_col: str, metrics: Sequence[str],
                 ticker_col: str = "Ticker") -> DataFrame:
    """Stack the ticker level of ``metric|ticker`` columns into rows; NULL cells are kept.

    One narrow pass (explode of an array of structs): no shuffle.  The ticker list is
    read from the schema (metadata), not from the data.
    """
    tickers, types = [], {}
    for f in wide.schema.fields:
        if SEP in f.name:
            m, t = f.name.split(SEP, 1)
            types.setdefault(m, f.dataType)
            if t not in tickers:
                tickers.append(t)
    if not tickers:
        return wide.select(id_col, F.lit(None).cast("string").alias(ticker_col),
                           *[F.lit(None).cast("double").alias(m) for m in metrics]).limit(0)
    # a column that is missing for a ticker has the type of the metric's other columns
    cells = [
        F.struct(F.lit(t).alias(ticker_col),
                 *[(F.col(f"`{wide_columns(m, t)}`") if wide_columns(m, t) in wide.columns
                    else F.lit(None)).cast(types.get(m, "double")).alias(m) for m in metrics])
        for t in tickers
    ]
    return (wide.select(F.col(id_col), F.explode(F.array(*cells)).alias("_c"))
            .select(id_col, f"_c.{ticker_col}", *[f"_c.{m}" for m in metrics]))

"""Join helpers.  No side is hinted: Catalyst and AQE broadcast by measured bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(facts: DataFrame, dim: DataFrame, ticker_type: str | None,
                   columns: tuple[str, ...] = (), key: str = "ticker",
                   how: str = "inner") -> DataFrame:
    """Inner join of fact rows with the ticker dimension filtered to one type.

    Fact rows whose ticker is not in the dimension are dropped.
    """
    d = dim
    if ticker_type is not None:
        d = d.where(F.col("type") == ticker_type)
    return facts.join(d.select(key, *columns), key, how)

"""Unions of many frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name as a balanced tree: each binary union re-analyses its inputs, so
    a left-deep chain of n frames costs O(n^2) driver time, a tree O(n log n).  Columns
    that a frame lacks are NULL."""
    dfs = list(dfs)
    while len(dfs) > 1:
        dfs = [dfs[i].unionByName(dfs[i + 1], allowMissingColumns=True) if i + 1 < len(dfs) else dfs[i]
               for i in range(0, len(dfs), 2)]
    return dfs[0]

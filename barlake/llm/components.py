"""Connected components by alternating large-star and small-star rounds.

Every round is two grouped minima over the links with map-side combining, then a join of
the links with the minima, which AQE splits where a node has very many links.  Each
round's links are written to the shared folder; the rounds end when the links no longer
change, which is after a number of rounds that grows with the logarithm of the longest
chain.  Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the least node around.
    Small star: the same for the smaller neighbours and the node itself."""
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    if not large:
        both = both.where(F.col("dst") < F.col("src"))
    least = both.groupBy("src").agg(F.min("dst").alias("low")).select(
        F.col("src").alias("node"), F.least("src", "low").alias("low"))
    around = both.where(F.col("dst") > F.col("src")) if large else both
    moved = around.join(least, F.col("src") == F.col("node")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    if not large:
        moved = moved.unionByName(least.select(F.col("node").alias("src"), F.col("low").alias("dst")))
    return moved.where(F.col("src") != F.col("dst")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root (least node of its component) for the nodes of ``links`` (src, dst)
    that are not themselves the least.  No links give an empty result."""
    state = None
    while True:
        links = written(_star(_star(links, True), False), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("src").alias("node"), F.col("dst").alias("root"))
        state = now

"""Scans (S1, S2, S8, S9) and sinks (K1-K6) over a shared filesystem / object store.

Every write replaces a whole table, as a new snapshot that becomes the current one when it
is complete (``sources.snapshots``).  Writers never collect; the "skip when empty" sinks
use ``isEmpty()``, which stops at the first row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake import schemas
from barlake.sources import sheets, snapshots


def read_tickers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with the 7 dimension columns; empty cells load as NULL."""
    return (spark.read.schema(schemas.TICKERS).option("header", True)
            .option("nullValue", "").option("emptyValue", None).csv(snapshots.location(spark, path)))


def read_raw_prices(spark: SparkSession, path: str) -> DataFrame:
    """Raw price table (parquet) with NaN cells mapped to NULL at the boundary."""
    return normalize_raw(spark.read.schema(schemas.RAW_PRICES).parquet(snapshots.location(spark, path)))


def normalize_raw(raw: DataFrame) -> DataFrame:
    """NaN -> NULL for the price columns, so NaN never passes the ``> 0`` filters."""
    out = raw
    for c in ("Open", "High", "Low", "Close"):
        out = out.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    return out


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """K1 / K6: full replace of a table; returns it as read back.  ``df`` may read the table
    itself; if the write fails, the table is as it was."""
    return snapshots.replace_table(df, path, partition_by)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current snapshot of a written table."""
    return spark.read.parquet(snapshots.location(spark, path))


def write_if_not_empty(df: DataFrame, path: str, observation=None, *metrics) -> bool:
    """K2 / K3: replace the table only when there is something to write.

    ``observation`` / ``metrics``: counted during the write itself (not during the
    emptiness probe, which stops at the first row).
    """
    if df.isEmpty():
        return False
    write_table(df.observe(observation, *metrics) if observation is not None else df, path)
    return True


def write_tickers_csv(dim: DataFrame, path: str) -> None:
    """K4: one CSV file, index rows first, then stocks.

    The dimension is bounded (n tickers per sector plus the index list), so a single
    output file is fine.
    """
    ordered = dim.orderBy(F.when(F.col("type") == "index", 0).otherwise(1), "etf", "ticker")
    snapshots.replace(dim.sparkSession, path, lambda folder: ordered.coalesce(1).write.option("header", True)
                      .option("emptyValue", "").csv(folder))


def write_bucketed_table(df: DataFrame, name: str, path: str, key: str,
                         sort_by: tuple[str, ...], buckets: int, dealt: bool = False) -> DataFrame:
    """Materialise a table hash-bucketed by ``key`` and sorted within buckets.

    Readers that group, window or join by ``key`` then run without an exchange, and,
    because each bucket is a single sorted file, windows ordered by ``sort_by`` need no
    sort when the session lets bucketed scans report their order.  The table lives in a shared folder, so it also cuts lineage: a lost
    executor re-reads files instead of recomputing the upstream plan.

    ``dealt``: the rows come from ``repartition(buckets, key)``, and are not dealt out again.
    """
    spark = df.sparkSession
    version = f"{name}_{uuid.uuid4().hex}"

    # one task per bucket (same hash as the bucket id), so each bucket is one file
    # instead of one file per writing task and bucket; a failed write surfaces
    rows = df if dealt else df.repartition(buckets, key)
    (rows.write.bucketBy(buckets, key).sortBy(*sort_by)
     .option("path", f"{path}/{version}").saveAsTable(version))
    for old in snapshots.publish(spark, path, version):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(version)


def write_by_month(df: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """Write a dated table partitioned by calendar month and read it back; AQE splits a
    month that outgrows a task.  ``month_slice`` prunes the scan of such a table.

    ``tasks``: for the copy of a table that is as large as the data.  Its rows are not
    shuffled: that many tasks at most each write a file a month of what they read."""
    dated = df.withColumn("month", F.date_format("date", "yyyy-MM"))
    dated = dated.hint("rebalance", "month") if tasks is None else dated.coalesce(tasks)
    return write_table(dated, path, ("month",))


def month_slice(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Rows with ``first <= date <= last``; on a table written by month, from its months only."""
    df = df.where(F.col("date").between(first, last))
    if "month" not in df.columns:
        return df
    return df.where(F.col("month").between(F.date_format(first, "yyyy-MM"), F.date_format(last, "yyyy-MM"))).drop("month")


def read_holdings(spark: SparkSession, path: str, preamble: int = sheets.PREAMBLE) -> DataFrame:
    """The holdings of landed fund sheets (``sources.sheets``)."""
    return sheets.holdings(sheets.read_sheets(spark, path, preamble)).drop("line")


def read_membership(spark: SparkSession, path: str) -> DataFrame:
    """A landed index-membership list (header CSV)."""
    return spark.read.schema(schemas.MEMBERSHIP).option("header", True).csv(path)


def read_screener(spark: SparkSession, path: str) -> DataFrame:
    """Landed screener rows (header CSV), numbers as text."""
    return spark.read.schema(schemas.SCREENER).option("header", True).csv(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K5: a Silver 'view' is a lazy DataFrame registered by name; recomputed on read."""
    df.createOrReplaceTempView(name)
    return df

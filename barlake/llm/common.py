"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Row counts up to which a side is broadcast; beyond it the join is left to Catalyst.
BROADCAST_ROWS = 20_000
DROPPED_ROWS = 1_000_000
ROW = "barlake_row"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder of the shared one."""
    return f"{checkpoint_dir(spark)}/barlake-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage ends at the files,
    so a lost executor costs a re-read, and what follows computes from stored rows."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when the stored table ``df`` has at most ``rows`` rows (the count
    comes from file footers); a larger one is returned unhinted and joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def fresh_name(base: str, *frames: DataFrame) -> str:
    """``base``, or with underscores after it, so that no column of the frames has the name."""
    used = {c.lower() for df in frames for c in df.columns}
    while base in used:
        base += "_"
    return base


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` stored with a column of row numbers: another scan may be split into other
    partitions, so row numbers that two scans share have to be stored with the rows.  The
    column has a name that ``docs`` does not use, and is known by its metadata."""
    name = fresh_name(ROW, docs)
    return written(docs.withColumn(name, F.monotonically_increasing_id()).withMetadata(name, {ROW: True}), "numbered")


def row_field(docs: DataFrame) -> str | None:
    """Name of the row numbers of ``numbered`` rows."""
    return next((f.name for f in docs.schema if ROW in f.metadata), None)


def row_number(docs: DataFrame) -> Column:
    """The stored row number of ``numbered`` rows; of others one that holds for this scan only."""
    name = row_field(docs)
    return F.col(name) if name else F.monotonically_increasing_id()


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``numbered`` rows without those in ``dropped`` (column uid): numbers only are
    broadcast, 16 bytes a row up to ``DROPPED_ROWS``; more are joined by a shuffle."""
    row, gone = row_field(docs), fresh_name("barlake_dropped", docs)
    dropped = written(dropped.select(F.col("uid").alias(gone)), "dropped")
    return docs.join(checked_broadcast(dropped, DROPPED_ROWS), F.col(row) == F.col(gone), "left_anti").drop(row)


def require_reuse(spark: SparkSession) -> None:
    """An error where equal exchanges are not reused: two readings of the same chunks would
    then be two scans, which may cut them differently."""
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        raise ValueError("spark.sql.exchange.reuse must be on")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also change other scripts)."""
    return F.translate(c, UPPER, LOWER)


def buckets(spark: SparkSession) -> int:
    """Buckets of a hand-keyed exchange: the session's shuffle partition count, which
    the user sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Recent(dict):
    """Computed values of recent keys, in two generations of at most ``size`` entries: when
    the young one is full it becomes the old one, and what is still used comes back from
    there.  Keys longer than ``longest`` are computed each time."""

    def __init__(self, compute, size: int, longest: int):
        super().__init__()
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def slices(batches, rows: int = 1024):
    """Arrow batches in small parts, so that few rows are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()  # the worker process lives on


def pack(*parts: bytes, level: int = 1) -> bytes:
    """Several byte strings as one compressed cell of an exchange."""
    head = struct.pack(f"<{len(parts) + 1}I", len(parts), *map(len, parts))
    return zstandard.ZstdCompressor(level=level).compress(head + b"".join(parts))


def planes(values: np.ndarray) -> bytes:
    """Numbers as planes of equal-valued bytes, which compress well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def unpack(cell: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(cell)
    n = struct.unpack_from("<I", raw)[0]
    out, at = [], 4 * (n + 1)
    for size in struct.unpack_from(f"<{n}I", raw, 4):
        out.append(raw[at:at + size])
        at += size
    return out

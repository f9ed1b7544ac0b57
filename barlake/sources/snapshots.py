"""Full replaces that a failure cannot break (K1-K3, K6).

A table is a folder of snapshots and a pointer file.  A replace writes a new snapshot
beside the others; only when that is complete, a new pointer is renamed over the old one,
which the filesystem does atomically.  A write that dies half-way leaves the pointer, and
so every reader, on the snapshot before; a table can be replaced from itself.  The pointer
names the published snapshots, newest first: readers that still use an older one keep it
until ``keep`` further replaces.  Folders without a pointer (landed files) read as they are.

Of two replaces at the same time the later pointer wins; both snapshots are whole.  The
filesystem must rename a file atomically over another (HDFS and the like, local disks).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"
KEEP = 2


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def published(spark: SparkSession, path: str) -> list[str]:
    """Names of the published snapshots, newest first; none if ``path`` has no pointer."""
    file, fs = _path(spark, f"{path}/{POINTER}"), _fs(spark, path)
    if not fs.exists(file):
        return []
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def location(spark: SparkSession, path: str) -> str:
    """Folder of the current snapshot; ``path`` itself where there is no pointer."""
    path = path.rstrip("/")
    names = published(spark, path)
    return f"{path}/{names[0]}" if names else path


def publish(spark: SparkSession, path: str, name: str, keep: int = KEEP) -> list[str]:
    """Make the finished snapshot ``name`` the current one.  Returns the names of the
    snapshots that are no longer kept; their folders are removed."""
    jvm, fs = spark._jvm, _fs(spark, path)
    names = [name, *published(spark, path)]
    new = _path(spark, f"{path}/_{uuid.uuid4().hex}")
    out = fs.create(new, True)
    try:
        out.write(bytearray("\n".join(names[:keep]), "utf-8"))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    target = _path(spark, f"{path}/{POINTER}")
    qualified = fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(new), qualified, how)
    for old in names[keep:]:
        fs.delete(_path(spark, f"{path}/{old}"), True)
    return names[keep:]


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = KEEP) -> str:
    """``write(folder)`` into a new snapshot of ``path``, then make it the current one.
    Returns its folder."""
    path = path.rstrip("/")
    name = f"snapshot-{uuid.uuid4().hex}"
    write(f"{path}/{name}")
    publish(spark, path, name, keep)
    return f"{path}/{name}"


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), keep: int = KEEP) -> DataFrame:
    """Replace the parquet table ``path`` by ``df``; returns the new snapshot as read back."""
    def write(folder: str) -> None:
        df.write.partitionBy(*partition_by).parquet(folder) if partition_by else df.write.parquet(folder)

    return df.sparkSession.read.schema(df.schema).parquet(replace(df.sparkSession, path, write, keep))

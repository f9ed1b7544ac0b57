"""SparkSession helpers (local tests / bench) and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "barlake", extra: dict | None = None) -> SparkSession:
    """Session tuned for this workload.

    On a cluster ``master`` is left to spark-submit and so is the shuffle partition
    count (size it to the data: it is also the default bucket count of the Silver
    table); AQE coalesces small partitions and splits skewed joins at runtime.  For a
    local master the partition count defaults to the number of cores.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if shuffle_partitions is None and master and master.startswith("local"):
        n = master[len("local["):-1] if master.startswith("local[") else "1"
        if n in ("*", ""):
            shuffle_partitions = os.cpu_count() or 8
        else:
            shuffle_partitions = int(n.split(",")[0])
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # coalesce small post-shuffle partitions to the advisory size instead of keeping
        # one per core: fewer near-empty tasks (the setting Spark advises for busy clusters)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # a bucketed table whose buckets are single sorted files reports that order,
        # so per-ticker windows over Silver skip their sort (Spark checks the
        # one-file-per-bucket condition itself); a session without this legacy flag
        # gets the same results with one sort per window
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    }
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "8g")
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# application -> its private folder, where no shared one is set on a single machine
_scratch: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only on a single-machine master
    (tests) an unset one is replaced by a private scratch folder; on a cluster, where
    machines do not share such a folder, it is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _scratch.get(app_id(spark))
    if not d:
        if not spark.conf.get("spark.master", "").startswith(("local[", "local ")) and spark.conf.get(
                "spark.master", "") != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = _scratch[app_id(spark)] = tempfile.mkdtemp(prefix="barlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # a remote (Connect) session has no SparkContext; the path still applies
        pass
    return d


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (also under a remote session)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or f"session-{id(spark)}"


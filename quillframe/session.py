"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "quillframe", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution on and the UTC time zone pinned."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.checkpoint.compress": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not named:
        named = sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="quillframe-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"


def cleared(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders that nothing reads any more, in whatever file system they are."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def reliable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder, so lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def balanced(scan: DataFrame, *keys: str) -> DataFrame:
    """A table scan spread over the cluster when it has fewer splits than there are task slots.

    For heavy per-row work on an input of few row groups; a large table has splits enough and stays as it is.
    """
    want = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= want:
        return scan
    return scan.repartition(want, *keys)

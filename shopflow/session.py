"""Spark session construction and the shared scratch location.

Scratch data (stream checkpoints, keyed result tables, sink round-trips) goes
under the cluster's ``spark.checkpoint.dir``.  Only on a local master without one
(tests) is a directory under /tmp created and registered; on any other master that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# On a cluster: many initial shuffle partitions, coalesced by AQE to a target
# size (not to the core count), so every reduce task fits executor memory
# whatever the stage's volume; skewed partitions are split by AQE.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    # Stream state on local disk (RocksDB) instead of the executor heap, with
    # changelog checkpoints: state of any size, cheap per-batch commits.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app: str = "shopflow", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """``cluster=True`` adds CLUSTER_CONF and leaves the master to
    spark-submit when ``master`` is None; pass shuffle_partitions of the
    order of the largest shuffle's bytes / 128 MB."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Every date key and epoch conversion in the jobs is defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    # Tests and local runs only: elsewhere every executor would have a /tmp
    # of its own, and reading scratch data back would miss parts of it.
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder when the master is {sc.master}")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="shopflow-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint root (never reused)."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/shopflow/{name}-{uuid.uuid4().hex[:12]}"

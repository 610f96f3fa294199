"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings every job relies on; values that depend on the cluster size
# (shuffle partitions, executor memory) are left to the deployment.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast is decided by Spark from measured / estimated sizes; this is
    # the checked bound, beyond it joins fall back to sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    # No per-call origin capture (one JVM round trip per Column function);
    # plans stay identical, only error messages lose the Python call site.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


@lru_cache(maxsize=1)
def _scratch() -> tempfile.TemporaryDirectory:
    """Scratch folder of a local run; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="seamstat-ckpt-", ignore_cleanup_errors=True)


def build_session(master: str | None = None, app: str = "seamstat",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``master`` is only set when given (local tests); on a cluster the
    launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Where it is unset, a ``local`` master
    (tests) gets a scratch folder; any other master raises, since executors
    could not see a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = _scratch().name
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_table_path(spark: SparkSession, name: str) -> str:
    """Location for an intermediate table that cuts lineage (shared folder)."""
    return os.path.join(ensure_checkpoint_dir(spark), "tables", name)


@contextmanager
def small_methods(spark: SparkSession):
    """Within it, a stage whose generated method is too long for the JVM's
    compiler (8000 bytes) runs as operators with short methods: a projection
    of many expressions would else be interpreted. The setting is put back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def sized_conf(input_bytes: int, executors: int, cores_per_executor: int,
               shuffle_fraction: float = 0.25,
               target_split_bytes: int = 512 * 1024 * 1024,
               target_shuffle_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized to the data and the cluster.

    * Scan splits of ``target_split_bytes`` (columnar reads touch only the
      used columns, so a split decodes far less than its size).
    * Initial shuffle partitions so that the largest shuffle (about
      ``shuffle_fraction`` of the input after map-side pre-aggregation)
      lands at ~``target_shuffle_bytes`` per partition, never fewer than
      2 x the cluster's cores; AQE then coalesces small partitions and
      splits skewed ones.

    Example: 100 TB on 1000 executors x 8 cores gives 512 MB splits
    (~200k scan tasks) and ~100k initial shuffle partitions of ~256 MB.
    """
    import math
    cores = max(1, executors * cores_per_executor)
    parts = max(2 * cores, math.ceil(input_bytes * shuffle_fraction / target_shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_shuffle_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_shuffle_bytes),
        "spark.default.parallelism": str(2 * cores),
    }


"""Session helpers.

Jobs take the caller's ``SparkSession``; ``local_session`` only serves tests,
the bench and the smoke entry.  ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir`` and sets a scratch one only where it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark SQL confs.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "adresponse",
                  warehouse: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # a checkpoint's files go when nothing refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    bind = os.environ.get("SPARK_LOCAL_IP")
    if bind:
        builder = builder.config("spark.driver.host", bind)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, read from the session.

    Only a local-mode session (tests, bench) without one gets a scratch
    folder; a cluster session without ``spark.checkpoint.dir`` is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the folder
        return spark.conf.get("spark.checkpoint.dir", None)
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # executors on other machines cannot read a folder local to the driver
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="adresponse-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a run that reads ``input_bytes`` on ``total_cores`` task slots.

    File splits and shuffle partitions aim at ``target_partition_bytes`` each
    (fits an executor core's memory with room for sort/aggregation buffers);
    the shuffle starts with enough partitions for that size, rounded up to
    whole waves of the cluster, and AQE coalesces small ones and splits
    skewed ones at run time.
    """
    waves = max(1, -(-input_bytes // (target_partition_bytes * max(1, total_cores))))
    partitions = max(total_cores, waves * total_cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, total_cores: int | None = None) -> dict:
    """Set ``scale_settings`` on a running session (all are runtime SQL settings)."""
    cores = total_cores or default_parallelism(spark)
    conf = scale_settings(input_bytes, cores)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the session (falls back to the shuffle setting on remote sessions)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))

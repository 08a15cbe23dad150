"""Session helpers: a local session for tests/bench and the checkpoint folder.

On a cluster the session comes from the platform; we only read
``spark.checkpoint.dir`` from it. A directory is set here only when it is
unset (tests and local runs), never overriding the cluster's shared folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "lapsewise") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAPSEWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a scratch one only if none is
    set and the session is local (tests, local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        # a machine-local folder is wrong on a cluster: executors would each
        # write to their own disk. The cluster must name a shared folder.
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a folder shared by all executors")
    scratch = tempfile.mkdtemp(prefix="lapsewise-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


# Target bytes per task: large enough to amortise task overhead, small
# enough that a sort/aggregate partition fits executor memory without spill.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings sized for a run over ``input_bytes`` on ``executor_cores_total`` cores.

    Shuffle partitions scale with the data (at least 2 waves of tasks) and
    AQE coalesces small ones and splits skewed ones at run time; input splits
    match the target partition size. For 100 TB on 1,000 executors x 8 cores
    this gives ~400k shuffle partitions, i.e. ~50 waves of 256 MB tasks.
    """
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = max(2 * executor_cores_total, by_size)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.session.timeZone": "UTC",
    }

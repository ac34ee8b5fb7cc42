"""Spark session settings shared by tests, the bench and the driver entry.

The library never creates a session on its own inside an operator; callers
pass one in.  ``get_session`` is a convenience for tests and scripts.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session running this library should carry.  AQE re-plans
# joins from runtime sizes, coalesces small shuffle partitions and splits
# skewed join partitions (one learner may own a large share of the log).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoints written by ``materialize`` are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "quizlog") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("QUIZLOG_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is; without it this raises, since a folder of the driver's own
    disk is unknown to the executors.  Only a local session, where they are
    one process, gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder all executors share (master is {master})")
        d = tempfile.mkdtemp(prefix="quizlog-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a large run, from the bytes the job reads.

    Scan splits and post-shuffle partitions target ``partition_bytes`` each,
    so a task's working set fits executor memory whatever the data size; AQE
    coalesces small partitions and splits skewed ones at run time.  For
    100 TB at 256 MB that is about 400,000 partitions, at least four waves
    of the cluster's cores.
    """
    parts = max(4 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }

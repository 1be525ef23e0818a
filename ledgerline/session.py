"""SparkSession construction and the few session-level settings jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants regardless of cluster size.  Shuffle partition
# count is left to the caller / cluster defaults; AQE coalesces small
# partitions and splits skewed ones at run time.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once the checkpointed data is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Dimension tables are small; let Catalyst/AQE broadcast sides whose
    # measured size is under this bound (runtime-checked, not assumed).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only in local mode, where one machine is all there is, is a
    scratch folder made when it is unset; a cluster session without it is
    refused, as its executors could not read a folder of the driver's.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def sized_conf(shuffle_bytes: int, target_partition_bytes: int = 192 * 1024 * 1024,
               scan_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings that scale with the data instead of fixed numbers.

    ``shuffle_bytes`` is the largest expected shuffle of the job (for an
    incremental load: the key columns of history that survive the batch-key
    filter; for a consolidation: the joined row width times rows).  Adaptive
    execution then coalesces small partitions and splits skewed ones."""
    partitions = max(1, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }

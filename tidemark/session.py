"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  AQE re-plans joins from real
# sizes (a broadcast only happens when the runtime size is under the
# threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (dense index, self-overwrite) are deleted once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` so the submitter decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when nothing is configured and the master is ``local[...]`` (one
    machine, as in unit tests) a fresh temporary folder is taken; any other
    master without the setting is an error, because the other machines could
    not read such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cluster_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 waves: int = 3, max_partitions: int = 50_000, parallelism_first: bool = False) -> dict:
    """Sizing for a cluster run whose largest shuffle moves ``shuffle_bytes``.

    ``shuffle_bytes`` is the size of the biggest exchange after column pruning,
    filters and map-side aggregation (for the attribution and KPI plans about
    a tenth of the scanned Parquet bytes; read it from a previous run's stage
    metrics).  Input bytes are the upper bound.

    * ``files.maxPartitionBytes``: 256 MiB scan splits (row groups permitting).
    * ``shuffle.partitions``: about ``target_partition_bytes`` per reduce task
      before AQE coalesces (AQE merges small partitions but only splits large
      ones inside skewed joins), at least ``waves`` x the cores (3 on a cluster
      to even out stragglers, 1 on one machine) and at most
      ``max_partitions`` (map-output tracking grows with maps x reducers).
    * skew-join split at 5x the median and above 512 MiB.
    * broadcast threshold fixed at 64 MiB: a side is broadcast only when its
      measured size is under it, whatever the data volume.
    """
    partitions = min(max_partitions, max(waves * total_cores, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        # on a shared cluster coalesce toward the advisory size; on one machine
        # (parallelism_first=True) keep as many tasks as cores can run
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": str(parallelism_first).lower(),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }

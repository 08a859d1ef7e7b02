"""Spark session helpers.

On a cluster the session is created by the caller; these helpers only pin what the reports
depend on (UTC session zone) and find the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "martlens") -> SparkSession:
    """Local session for tests and the bench: AQE on, UI off, UTC."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    * Scan splits and post-shuffle partitions target ``target_partition_bytes`` (fits an
      executor core's share of memory; larger partitions spill instead of failing).
    * ``spark.sql.shuffle.partitions`` is an upper bound (input / target, at least 3 waves of
      cores); AQE coalesces small partitions and splits skewed join partitions at runtime.
    * The broadcast threshold stays modest: only sides AQE *measures* under it are broadcast.
    * ``windowGroupLimitThreshold`` is raised so that every literal top-k bound used here
      (up to a sample size of 100,000) gets a partial ``WindowGroupLimit`` before its shuffle.
    * Stream state lives in RocksDB (off-heap, spills to local disk, changelog checkpoints)
      instead of the default heap-resident store, so state size is not bounded by executor heap.
      A checkpoint keeps the provider it was started with.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def ensure_utc(spark: SparkSession) -> None:
    """All day/minute/millisecond derivations are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) a fresh folder is made and set,
    so that ``DataFrame.checkpoint()`` and written intermediate tables land somewhere shared.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="martlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts]) if "://" in base else os.path.join(base, *parts)

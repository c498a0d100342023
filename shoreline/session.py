"""Session construction and shared storage locations.

Jobs never write to a machine-local temporary folder on a cluster: anything
that must survive an executor loss (lineage cuts, stream checkpoints, topic
files) goes below the folder named by ``spark.checkpoint.dir``.  Only when the
session has none (unit tests, a laptop) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a local run.  On a cluster pass ``master=None`` and size
# ``shuffle_partitions`` from the input (see ``scale_conf``).
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what AQE has measured (materialised shuffle output), never on
    # static estimates over compressed files.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 << 20),
    # Streaming state lives in RocksDB so large key spaces spill to disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(
    app: str = "shoreline",
    master: str | None = "local[*]",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    cores: int | None = None,
) -> SparkSession:
    """Session with the library defaults.  On a cluster pass ``master=None`` and the
    expected input size and total cores to size shuffles (``scale_conf``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(_BASE_CONF)
    if input_bytes and cores:
        settings.update(scale_conf(input_bytes, cores))
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, cores_total: int,
               split_bytes: int = 256 << 20,
               shuffle_fraction: float = 0.1,
               reducer_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle/scan sizing for a cluster run.

    * Scan splits of ``split_bytes`` (100 TB -> ~400k tasks, ~50 waves on 8k cores).
    * Initial reducers sized from the expected *shuffle* volume, not the input:
      the first exchange carries partial aggregates (``shuffle_fraction`` of the
      input at most), later ones deduplicated rows.  Clamped to [2, 4] x cores so
      map-output metadata (maps x reducers) stays bounded; AQE coalesces small
      partitions and splits skewed ones at run time.
    """
    wanted = -(-int(input_bytes * shuffle_fraction) // reducer_bytes)
    parts = min(max(2 * cores_total, wanted), 4 * cores_total)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(reducer_bytes),
        # Broadcast decisions are taken from measured shuffle sizes (AQE),
        # never from static guesses over compressed files.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="shoreline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "shoreline", *parts, uuid.uuid4().hex])

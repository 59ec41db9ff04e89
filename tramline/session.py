"""Session settings every job relies on.

All stored timestamps are naive UTC wall clock (TIMESTAMP_NTZ); the session
time zone must be UTC so that epoch conversions and NTZ<->TIMESTAMP casts do
not shift them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime (session-level) settings; safe to apply to a session the caller owns.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast at planning only where its files' statistics keep it under this
    # bound, and at run time where its measured bytes are under the next one.
    "spark.sql.autoBroadcastJoinThreshold": "8MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = "local[*]",
    app_name: str = "tramline",
    shuffle_partitions: int = 8,
    checkpoint_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with UI off and the runtime settings applied.

    ``master=None`` leaves the master to spark-submit (cluster runs)."""
    builder = SparkSession.builder
    if master:  # None: take the master from spark-submit / the cluster
        builder = builder.master(master)
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    A local session without one (tests) gets a private temporary folder; a cluster
    session must name one, since its executors share no local folder.
    """
    context = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
            or context.getCheckpointDir())
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tramline-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A unique path under the session's checkpoint folder; whoever writes creates it."""
    return f"{_checkpoint_root(spark).rstrip('/')}/tramline/{name}-{uuid.uuid4().hex[:12]}"


def size_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                   max_split_bytes: int = 512 << 20) -> int:
    """Size shuffles and scans for an input of ``input_bytes`` (cluster runs).

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input, so sort and aggregation buffers fit executor memory; AQE then
    coalesces small ones to the advisory size and splits skewed join
    partitions. Scan splits are capped at ``max_split_bytes``.
    Returns the partition count set.
    """
    parts = max(spark.sparkContext.defaultParallelism, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max_split_bytes))
    return parts

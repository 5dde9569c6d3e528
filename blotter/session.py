"""Session construction and the shared working folder.

Everything that materialises intermediate data (streams, sinks, lineage cuts)
writes below the folder the cluster names in ``spark.checkpoint.dir``. The
setting is read from the running session; a private folder is created only when
the session has none (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every entry point relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "blotter",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library assumes."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Zone-less text times are read and written in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide working folder (``spark.checkpoint.dir``).

    Set from the session when present; only an unset session gets a private
    folder, which is what happens in local tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-")
        spark.sparkContext.setCheckpointDir(configured)
    else:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location below the shared folder."""
    return f"{shared_dir(spark)}/blotter/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for code that must touch the local disk."""
    return path[len("file:"):] if path.startswith("file:") else path


# Bytes per task the sizing aims at, and the cap on initial
# shuffle partitions (AQE coalesces what turns out small).
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_SHUFFLE_PARTITIONS = 100_000


def scale_settings(input_bytes: int, total_cores: int,
                   target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Sizing for an input of ``input_bytes`` on ``total_cores`` task slots.

    Scan splits and the initial shuffle partition count aim at
    ``target_bytes`` per task, so a task's shuffle block fits in executor
    memory and spills rarely; at least two waves of tasks keep every core
    busy; AQE then merges partitions that come out small and splits skewed
    ones.
    """
    by_size = -(-int(input_bytes) // int(target_bytes))
    shuffle = max(2 * int(total_cores), min(by_size, MAX_SHUFFLE_PARTITIONS))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes below ``paths`` (file metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        for status in fs.globStatus(hp) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def apply_scale_settings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Size the session for the inputs at ``paths`` unless the application set
    its shuffle partitions itself (spark-submit / spark-defaults win)."""
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return {}
    cores = spark.sparkContext.defaultParallelism
    settings = scale_settings(input_bytes(spark, paths), cores)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings

"""Structured Streaming query builders.

Sources are file folders on shared storage (a Kafka topic plugs in through
``sources.connectors.kafka_stream``); every query has its own checkpoint
below the shared folder, so a restarted query resumes where it stopped and
sinks see each batch effectively once.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.files import glob_paths
from ..sinks.tables import BATCH_COLUMN, append_batch, append_documents, read_table

MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])


# Records per staged file: the file count, and with it the write parallelism,
# grows with the data instead of being a fixed number.
RECORDS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Staged:
    """A folder of replay files and how many data files it holds."""
    path: str
    files: int

    def per_trigger(self, batches: int = 2) -> int:
        """Files per micro-batch so the replay takes ``batches`` triggers."""
        return max(1, math.ceil(self.files / batches))


def stage_files(df: DataFrame, path: str, order_by: str | None = None, fmt: str = "parquet",
                copies: int = 1, min_files: int = 8,
                records_per_file: int = RECORDS_PER_FILE) -> Staged:
    """Write ``df`` as replay files, range-ordered by ``order_by`` (the way a
    topic lands in a folder). One range partition per shuffle partition (at
    least ``min_files``) and at most ``records_per_file`` records per file, so
    large inputs become many files written in parallel. ``copies`` > 1 writes
    the same records again, as an at-least-once producer does after a retry."""
    spark = df.sparkSession
    n = max(min_files, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = df.repartitionByRange(n, F.col(order_by)) if order_by else df.repartition(n)
    for i in range(copies):
        w = out.write.mode("overwrite").option("maxRecordsPerFile", records_per_file)
        target = f"{path}/copy={i}"
        if fmt == "csv":
            w.option("header", True).csv(target)
        else:
            w.format(fmt).save(target)
    ext = "csv" if fmt == "csv" else fmt
    files = len(glob_paths(spark, f"{path}/copy=*/part-*.{ext}*"))
    return Staged(path, files)


def file_stream(spark: SparkSession, source: str | Staged, schema: T.StructType,
                fmt: str = "parquet", max_files: int | None = None, **options) -> DataFrame:
    """A folder replayed as a stream, ``max_files`` files per micro-batch
    (default: half of a staged folder, so it takes two triggers)."""
    path = source.path if isinstance(source, Staged) else source
    if max_files is None:
        max_files = source.per_trigger() if isinstance(source, Staged) else 4
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    r = r.option("recursiveFileLookup", "true")
    for k, v in options.items():
        r = r.option(k, v)
    return r.format(fmt).load(path)


# State store used when the session names none (RocksDB keeps
# large keyed state off the JVM heap; changelog checkpointing makes commits
# incremental).
STATE_STORE_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def ensure_state_store(spark: SparkSession) -> None:
    """Use RocksDB state unless the session or application chose a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) or spark.sparkContext.getConf().contains(key):
        return
    for k, v in STATE_STORE_DEFAULTS.items():
        spark.conf.set(k, v)


def run_available(df: DataFrame, mode: str, checkpoint: str,
                  batch_fn: Callable[[DataFrame, int], None] | None = None,
                  path: str | None = None, fmt: str = "parquet",
                  name: str | None = None) -> None:
    """Run a stream over everything available now, then stop (W12 in tests;
    production uses ``trigger(processingTime=slide)``)."""
    ensure_state_store(df.sparkSession)
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if batch_fn is not None:
        w = w.foreachBatch(batch_fn)
    else:
        w = w.format(fmt).option("path", path)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


class LatestTable:
    """foreachBatch sink for ``complete`` mode: each batch holds the whole
    result, written under its batch id; the last one is the table."""

    def __init__(self, path: str):
        self.path = path
        self.last: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, self.path, batch_id)
        self.last = batch_id

    def read(self, spark: SparkSession) -> DataFrame:
        if self.last is None:
            raise RuntimeError("the stream produced no batch")
        return spark.read.parquet(f"{self.path}/batch_id={self.last}")


class AppendTable:
    """foreachBatch sink for ``append``/``update`` mode: every batch is kept
    under its batch id; a replayed batch overwrites its own folder."""

    def __init__(self, path: str):
        self.path = path
        self.batches: list[int] = []

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, self.path, batch_id)
        self.batches.append(batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path)

    def read_latest(self, spark: SparkSession, key: list[str]) -> DataFrame:
        """Upserted view of an ``update``-mode sink: per key, the row of the
        newest batch (a partial aggregate, not a window over the key)."""
        df = read_table(spark, self.path, keep_batch=True)
        rest = [c for c in df.columns if c not in key and c != BATCH_COLUMN]
        newest = df.groupBy(*key).agg(
            F.max_by(F.struct(*rest), F.col(BATCH_COLUMN)).alias("_row"))
        return newest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


class DualSink:
    """One batch to a table and a document collection.

    The batch is persisted once and written to both; each write is keyed by
    the batch id, so a replay after a failure between the two writes leaves
    both sinks with exactly one copy. ``table_form`` shapes the table's rows
    (for alerts: the payload column).
    """

    def __init__(self, table_path: str, docs_path: str, id_cols: list[str] | None = None,
                 complete: bool = False,
                 table_form: Callable[[DataFrame], DataFrame] = lambda df: df):
        self.table_form = table_form
        self.table_path, self.docs_path = table_path, docs_path
        self.id_cols = id_cols
        self.complete = complete
        self.last: int | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_documents(batch, self.docs_path, batch_id, self.id_cols)
            append_batch(self.table_form(batch), self.table_path, batch_id)
        finally:
            batch.unpersist()
        self.last = batch_id

    def read_table(self, spark: SparkSession) -> DataFrame:
        if self.complete:
            return spark.read.parquet(f"{self.table_path}/batch_id={self.last}")
        return read_table(spark, self.table_path)

    def docs_path_for_read(self) -> str:
        return f"{self.docs_path}/batch_id={self.last}" if self.complete else self.docs_path


class DedupSink:
    """W10 without a hot-key bottleneck: exactly one row per key in the sink.

    Each micro-batch is deduplicated as a batch DataFrame, so all copies of a
    key are first combined map-side (a partial aggregate) and a group of
    copies holding a third of the batch never reaches one task whole. Keys
    already written by earlier batches are then removed with a left anti
    join against the sink's own key column (only earlier batch folders are
    read, so a replayed batch is rewritten with the same rows). All of them
    are read, so an old key never enters again.
    """

    def __init__(self, path: str, key: list[str]):
        self.path, self.key = path, key

    def _prior(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        written = [p for p in glob_paths(spark, f"{self.path}/{BATCH_COLUMN}=*")
                   if int(p.rsplit("=", 1)[1]) < batch_id]
        if not written:
            return None
        prior = spark.read.parquet(self.path).filter(F.col(BATCH_COLUMN) < batch_id)
        return prior.select(*self.key)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fresh = batch.dropDuplicates(self.key)
        prior = self._prior(batch.sparkSession, batch_id)
        out = fresh if prior is None else fresh.join(prior, self.key, "left_anti")
        append_batch(out, self.path, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path)


def checkpoint_dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"chk-{name}")


def arrival_stamp(df: DataFrame, column: str = "arrived_at") -> DataFrame:
    """Processing-time stamp, for windows by arrival as in the reference."""
    return df.withColumn(column, F.current_timestamp())


def event_time(df: DataFrame, ts: str = "event_ts", column: str = "event_time") -> DataFrame:
    """Watermarks need an instant type; zone-less times are read as UTC."""
    return df.withColumn(column, F.col(ts).cast("timestamp"))

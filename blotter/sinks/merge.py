"""Merging sinks: one row per key in a result table and in a document
collection, however often a row is delivered (K2, K3, K6, W9).

A merge opens and lists only the date partitions that the new rows fall into,
so its cost does not grow with the table's age; it replaces the rows with the
same key and rewrites those partitions with a dynamic overwrite. Merging the same rows again
changes nothing, so a replayed batch, a restarted query and an ``update`` mode
query that sends several versions of a row all leave one row per key, the
newest.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import existing, glob_paths


def merge_rows(current: DataFrame, new: DataFrame, keys: DataFrame) -> DataFrame:
    """``new`` in place of the rows of ``current`` with the same key; ``keys`` are
    those of ``new`` that ``current`` may hold. Each key is in ``new`` once and never NULL."""
    return current.join(keys, keys.columns, "left_anti").unionByName(new.select(*current.columns))


class MergeTable:
    """A folder of rows unique by ``key``, partitioned by ``date_col``.

    ``date_col`` must be a function of the key, so that a key stays in its
    partition; ``schema`` is the stored schema without it.
    """

    def __init__(self, path: str, key: list[str], schema: T.StructType, date_col: str = "event_date", fmt: str = "parquet"):
        self.path, self.key, self.date_col, self.fmt = path, key, date_col, fmt
        self.schema = T.StructType([*schema.fields, T.StructField(date_col, T.DateType())])

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows with their partition column."""
        if not glob_paths(spark, f"{self.path}/{self.date_col}=*"):
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).format(self.fmt).load(self.path)

    def _stored(self, new: DataFrame) -> list[str]:
        """The days of ``new`` that the table holds; the driver sees one value a day of the batch."""
        spark = new.sparkSession
        if not existing(spark, [self.path]):
            return []
        days = new.where(F.col(self.date_col).isNotNull()).select(F.date_format(self.date_col, "yyyy-MM-dd").alias("day")).distinct()
        at = {f"{self.path}/{self.date_col}={r.day}": r.day for r in days.collect()}
        return sorted(at[p] for p in existing(spark, list(at)))

    def merge(self, new: DataFrame) -> None:
        """Add ``new``, or put it in place of stored rows with its keys."""
        spark = new.sparkSession
        new = new.select(*[f.name for f in self.schema.fields])
        days, rows = self._stored(new), new
        if days:
            current = spark.read.schema(self.schema).option("basePath", self.path).format(self.fmt) \
                .load([f"{self.path}/{self.date_col}={d}" for d in days])
            # rows of other days replace nothing
            again = new.where(F.col(self.date_col).isin([date.fromisoformat(d) for d in days]))
            rows = merge_rows(current, new, again.select(*self.key))
        (rows.hint("rebalance", self.date_col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(self.date_col).format(self.fmt).save(self.path))


def at_once(*jobs: Callable[[], None]) -> None:
    """Run independent writes at the same time; the first failure is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        for f in [pool.submit(job) for job in jobs]:
            f.result()


class MergeSink:
    """K6 + W9: a foreachBatch sink that merges every batch into a table and a
    document collection. ``versions`` orders several rows of one key within a
    batch (the largest stays). Already merged batches of the query are known
    from the ledger and skipped."""

    def __init__(self, table: MergeTable, docs: MergeTable, to_table: Callable[[DataFrame], DataFrame],
                 to_docs: Callable[[DataFrame], DataFrame], ledger: str | None = None, versions: str | None = None):
        self.table, self.docs = table, docs
        self.to_table, self.to_docs = to_table, to_docs
        self.ledger = Ledger(ledger) if ledger else None
        self.versions = versions

    def merge(self, rows: DataFrame) -> None:
        if self.versions:
            rest = [c for c in rows.columns if c not in self.table.key]
            best = rows.groupBy(*self.table.key).agg(F.max_by(F.struct(*rest), F.col(self.versions)).alias("_row"))
            rows = best.select(*self.table.key, *[F.col(f"_row.{c}").alias(c) for c in rest])
        rows = rows.persist()
        try:
            if rows.isEmpty():
                return
            at_once(lambda: self.docs.merge(self.to_docs(rows)), lambda: self.table.merge(self.to_table(rows)))
        finally:
            rows.unpersist()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark)
        if self.ledger and self.ledger.last(spark, query) >= batch_id:
            return
        self.merge(batch)
        if self.ledger:
            self.ledger.commit(spark, query, batch_id)


def query_id(spark: SparkSession) -> str:
    """The running streaming query's id (the same after a restart), inside foreachBatch."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"


def _null_safe(left: DataFrame, right: DataFrame, key: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])


class DedupTable:
    """A foreachBatch sink with exactly one row per key, whatever the order
    and the delay of the copies.

    ``date_col`` is a date that all copies of a row share (the event's own date:
    a redelivered message is the same message), and the table is partitioned by
    it. A batch therefore opens only the partitions of its own dates, so what it
    reads does not grow with the table's age; days are the only thing that the
    driver lists. A batch's copies are combined map-side first and the smallest
    row by all its columns is kept, so a hot key is one row a task and a replay
    keeps the same rows. A replayed batch is compared with earlier batches and
    rewrites its own folders. NULL is a key and a date like any other.
    """

    NO_DATE = "0001-01-01"

    def __init__(self, path: str, key: list[str], date_col: str):
        self.path, self.key, self.date_col = path, key, date_col

    def _opened(self, spark: SparkSession, days: list[str]) -> list[str]:
        return [p for d in days for p in glob_paths(spark, f"{self.path}/_day={d}")]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in self.key]
        kept = batch.groupBy(*self.key).agg(F.min(F.struct(*rest)).alias("_row")) \
            .select(*self.key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*batch.columns)
        fresh = kept.withColumn("_day", F.coalesce(F.col(self.date_col).cast("date"), F.lit(self.NO_DATE).cast("date"))).persist()
        try:
            days = sorted(r[0] for r in fresh.select(F.date_format("_day", "yyyy-MM-dd")).distinct().collect())
            opened = self._opened(spark, days)
            if opened:
                stored = T.StructType([*batch.schema.fields, T.StructField("_day", T.DateType()), T.StructField("_batch", T.LongType())])
                prior = spark.read.schema(stored).option("basePath", self.path).parquet(*opened) \
                    .where(F.col("_batch") < batch_id).select(*self.key)
                out = fresh.join(prior, _null_safe(fresh, prior, self.key), "left_anti")
            else:
                out = fresh
            out.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
                .partitionBy("_day", "_batch").parquet(self.path)
        finally:
            fresh.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("_day", "_batch")


class Ledger:
    """Finished batches of each query: one small row per batch, keyed by (query,
    batch), written after everything else of the batch."""

    def __init__(self, path: str):
        self.path = path

    def commit(self, spark: SparkSession, query: str, batch_id: int, **figures: int | None) -> None:
        names = ["batch_id", *figures]
        row = spark.createDataFrame([(batch_id, *figures.values())], ", ".join(f"{n} long" for n in names))
        row.coalesce(1).write.mode("overwrite").json(f"{self.path}/query={query}/batch={batch_id}")

    def last(self, spark: SparkSession, query: str) -> int:
        """The newest finished batch of the query, -1 if none (folder names only)."""
        done = glob_paths(spark, f"{self.path}/query={query}/batch=*/_SUCCESS")
        return max((int(p.rsplit("/batch=", 1)[1].split("/")[0]) for p in done), default=-1)

    def figures(self, spark: SparkSession, query: str, batch_id: int) -> dict:
        rows = spark.read.json(f"{self.path}/query={query}/batch={batch_id}").collect()  # one row
        return rows[0].asDict()

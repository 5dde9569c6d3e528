"""Relational and document sinks on shared storage (K1-K4, K6, K7).

A result table is a Parquet folder below the shared working folder; a
document collection is a JSON-lines folder. Appends are written per batch id
into their own sub-folder with overwrite, so replaying a batch replaces its
rows instead of adding them again (effectively-once). A database target is
``sources.connectors.jdbc_*``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_COLUMN = "batch_id"


def conform(df: DataFrame, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Columns of ``schema`` in its order, cast to its types (K8 shape), then
    the ``keep`` columns (e.g. partition columns) unchanged."""
    extra = [c for c in (keep or []) if c not in schema.fieldNames()]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields],
                     *[F.col(c) for c in extra])


def stamp(df: DataFrame, column: str = "generated_at") -> DataFrame:
    """K7: load time column, as every result table of the serving store has."""
    return df.withColumn(column, F.current_timestamp())


def with_date(df: DataFrame, ts: str, name: str = "event_date") -> DataFrame:
    """A date column to partition a table by, so reads by time range prune
    whole folders (the serving store's time index)."""
    return df.withColumn(name, F.to_date(F.col(ts)))


def overwrite_table(df: DataFrame, path: str, schema: T.StructType | None = None,
                    partition_by: list[str] | None = None, stamped: bool = False) -> None:
    """K1: replace the table contents; the declared schema is kept. ``stamped``
    adds the load time (K7)."""
    out = conform(df, schema, keep=partition_by) if schema is not None else df
    out = stamp(out) if stamped else out
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int,
                 partition_by: list[str] | None = None) -> None:
    """K2: idempotent append of one batch (a replay rewrites the same batch)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/{BATCH_COLUMN}={int(batch_id)}")


def read_table(spark: SparkSession, path: str, keep_batch: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    if BATCH_COLUMN in df.columns and not keep_batch:
        df = df.drop(BATCH_COLUMN)
    return df


def document_frame(df: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Timestamps as ISO-8601 UTC text (as a document store holds them) and,
    with ``id_cols``, a deterministic ``_id`` from those columns."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f.name))
        else:
            cols.append(F.col(f.name))
    out = df.select(*cols)
    if id_cols:
        out = out.withColumn("_id", F.md5(F.concat_ws("|", *[F.col(c).cast("string")
                                                              for c in id_cols])))
    return out


def append_documents(df: DataFrame, path: str, batch_id: int,
                     id_cols: list[str] | None = None) -> None:
    """K3/K4: idempotent append of one batch of documents (JSON lines)."""
    document_frame(df, id_cols).write.mode("overwrite").json(
        f"{path}/{BATCH_COLUMN}={int(batch_id)}")

"""Broker and database connections.

These build standard Spark readers and writers. The Kafka connector jar is
not part of this environment and no database runs here, so the builders are
tested by their options; the file-backed forms in ``sinks.tables`` are what
the registered queries use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader


def kafka_options(servers: str, topic: str, starting: str = "latest",
                  group_id: str | None = None, fail_on_data_loss: bool = True) -> dict[str, str]:
    """Subscribe to one topic; a new query starts at the latest offset,
    a restarted one resumes from its checkpoint and fails if offsets it has not
    read are gone, unless ``fail_on_data_loss`` is off."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
            "failOnDataLoss": str(fail_on_data_loss).lower()}
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataStreamReader:
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **kw))


def kafka_text(records: DataFrame) -> DataFrame:
    """Kafka rows to (key, value) text, the shape the event parser takes."""
    return records.select(F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"))


def keyed_json(df: DataFrame, key: str, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """(key, value) records, the value a JSON object of ``fields``;
    ``keep`` columns go before them."""
    return df.select(*(keep or []), F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"))


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def jdbc_reader(spark: SparkSession, url: str, *, table: str | None = None,
                query: str | None = None, properties: dict[str, str] | None = None,
                partition_column: str | None = None, lower: int | None = None,
                upper: int | None = None, num_partitions: int | None = None) -> DataFrameReader:
    """A JDBC read of a table or a query; with ``partition_column`` the
    read is split into ``num_partitions`` parallel range scans."""
    r = spark.read.format("jdbc").option("url", url)
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    if query is not None and partition_column:  # Spark splits tables only
        r = r.option("dbtable", f"({query}) AS q")
    else:
        r = r.option("dbtable", table) if table is not None else r.option("query", query)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def jdbc_overwrite(df: DataFrame, url: str, table: str, properties: dict[str, str],
                   writers: int | None = None) -> None:
    """K1: replace the rows of ``table`` and keep its DDL (``truncate``);
    ``writers`` caps concurrent connections."""
    out = df.coalesce(writers) if writers else df
    out.write.option("truncate", "true").mode("overwrite").jdbc(url, table, properties=properties)


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """K2: append rows (make replays idempotent with ``sinks.tables.append_batch``
    or a unique key on the table)."""
    df.write.mode("append").jdbc(url, table, properties=properties)

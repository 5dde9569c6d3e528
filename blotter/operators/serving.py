"""Serving reads over the result tables.

Top-k reads plan as ``TakeOrderedAndProject``: each task keeps its own best
k and only k rows per task reach the final merge. Ties are broken by the
remaining key columns so the answer is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import glob_paths


def latest(df: DataFrame, ts: str, n: int = 100, tie: tuple[str, ...] = (),
           date_col: str | None = None, since: str | None = None) -> DataFrame:
    """The ``n`` newest rows. On a table partitioned by ``date_col``,
    ``since`` (a date) limits the read to the newest partitions, unless they
    hold fewer than ``n`` rows; then the whole table is read."""
    if date_col and since:
        recent = df.filter(F.col(date_col) >= F.to_date(F.lit(since)))
        df = recent if recent.limit(n).count() == n else df
    return df.orderBy(F.col(ts).desc(), *[F.col(c).asc() for c in tie]).limit(n)


def newest(spark: SparkSession, path: str, ts: str, date_col: str, n: int = 100, tie: tuple[str, ...] = ()) -> DataFrame:
    """T1/T5 on a stored table partitioned by the date of ``ts``: the ``n`` newest
    rows, from the newest partitions alone.

    Partitions are taken newest first, twice as many each time, until they hold
    ``n`` rows; counts come from the files' footers. The read lists and scans
    those partitions only, however old the table is.
    """
    days = sorted((p for p in glob_paths(spark, f"{path}/{date_col}=*")), key=lambda p: p.rsplit("=", 1)[1], reverse=True)
    if not days:
        raise FileNotFoundError(f"no {date_col} partitions below {path}")
    take = 1
    while True:
        rows = spark.read.option("basePath", path).parquet(*days[:take])
        if take >= len(days) or rows.count() >= n:
            return latest(rows, ts, n, tie)
        take *= 2


def top_by(df: DataFrame, col: str, n: int = 20, tie: tuple[str, ...] = ()) -> DataFrame:
    """The ``n`` largest by ``col``."""
    return df.orderBy(F.col(col).desc(), *[F.col(c).asc() for c in tie]).limit(n)


def trend_lines(trends: DataFrame, kinds: tuple[str, ...] = ("year", "month", "hour"),
                natural: bool = False) -> DataFrame:
    """T3 + P11: trend rows of the chosen types in (type, period) text order,
    or with ``natural=True`` in numeric period order (``period_order``)."""
    rows = trends.filter(F.col("trend_type").isin(*kinds))
    order = (["trend_type", F.col("period_order").asc_nulls_last(), "period_value"] if natural
             else ["trend_type", "period_value"])
    return rows.orderBy(*order).select("trend_type", "period_value", "crime_count")


def trend_tab(trends: DataFrame, kind: str) -> DataFrame:
    """P10: one trend type."""
    return trends.filter(F.col("trend_type") == kind).select("period_value", "crime_count")


def hotspot_map(hotspots: DataFrame) -> DataFrame:
    """T4 + P19: centres in id order with map column names."""
    return (hotspots.select("cluster_id", "latitude", "longitude", "crime_count")
            .orderBy("cluster_id")
            .withColumnsRenamed({"latitude": "lat", "longitude": "lon"}))


def alert_documents(docs: DataFrame, n: int = 100) -> DataFrame:
    """T5 + P18: newest alert documents without the store's ``_id``."""
    out = docs.drop("_id") if "_id" in docs.columns else docs
    return latest(out, "alert_timestamp", n, ("district",))


def sql_over_tables(spark, query: str, tables: dict[str, str]) -> DataFrame:
    """S7-style reads: run SQL text over stored result tables.

    Each stored table (name -> folder) becomes a temporary view, so the
    dashboard's SQL runs unchanged on Spark, with its filters pushed into
    the Parquet scans.
    """
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.sql(query)

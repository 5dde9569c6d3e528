"""Rename + typed projection of the five raw inputs.

Each function takes a text-typed frame with the raw header names and returns
the cleaned frame. Codes longer than three digits are kept whole. Only the listed columns are read, so a columnar source is
pruned to them; name columns never leave the projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import normalize_code
from ..functions.parse import parse_event_time, to_bool, to_double, to_int


# The (header, column) pairs of the five projections below are the
# input files' headers and the result tables' column names.
def clean_crimes(raw: DataFrame) -> DataFrame:
    """P1 + P6: typed crime rows; rows without a case number are dropped."""
    return raw.select(
        F.col("Case Number").alias("case_number"),
        parse_event_time("Date").alias("event_ts"),
        F.col("Block").alias("block"),
        F.col("Primary Type").alias("primary_type"),
        to_bool("Arrest").alias("arrest"),
        normalize_code("District").alias("district"),
        F.col("Community Area").alias("community_area"),
        to_int("Year").alias("year"),
        to_double("Latitude").alias("latitude"),
        to_double("Longitude").alias("longitude"),
    ).filter(F.col("case_number").isNotNull())


def clean_arrests(raw: DataFrame) -> DataFrame:
    """Typed arrest rows (not yet deduplicated; see ``linkage.dedup_key``)."""
    return raw.select(
        F.col("CASE NUMBER").alias("case_number"),
        parse_event_time("ARREST DATE").alias("arrest_ts"),
        F.col("RACE").alias("race"),
    )


def clean_stations(raw: DataFrame, sentinel: str = "000") -> DataFrame:
    """P3 + P8: stations; the sentinel filter also drops NULL codes (3-valued)."""
    return raw.select(
        normalize_code("DISTRICT").alias("district"),
        F.col("DISTRICT NAME").alias("station_name"),
        to_double("LATITUDE").alias("station_latitude"),
        to_double("LONGITUDE").alias("station_longitude"),
    ).filter(F.col("district") != F.lit(sentinel))


def clean_violence(raw: DataFrame) -> DataFrame:
    """Typed violence rows, categorical flags upper-cased."""
    return raw.select(
        F.col("CASE_NUMBER").alias("case_number"),
        parse_event_time("DATE").alias("event_ts"),
        normalize_code("DISTRICT").alias("district"),
        F.col("COMMUNITY_AREA").alias("community_area"),
        F.col("MONTH").alias("month"),
        F.col("DAY_OF_WEEK").alias("day_of_week"),
        F.upper(F.col("INCIDENT_PRIMARY")).alias("incident_primary"),
        F.upper(F.col("GUNSHOT_INJURY_I")).alias("gunshot_injury"),
    )


def clean_registry(raw: DataFrame) -> DataFrame:
    """P5: registry rows (block, race, upper-cased minor-victim flag)."""
    return raw.select(
        F.col("BLOCK").alias("block"),
        F.col("RACE").alias("race"),
        F.upper(F.col("VICTIM MINOR")).alias("victim_minor"),
    )


def filter_geo(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with both coordinates."""
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def check_not_null(df: DataFrame, schema) -> DataFrame:
    """K8: one row per NOT NULL column of ``schema`` with its NULL count.

    A single aggregate pass over ``df``; zero everywhere means the frame can
    be written to a table with that DDL.
    """
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not required:
        return df.sparkSession.createDataFrame([], "column_name string, null_count long")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    stack = ", ".join(f"'{c}', `{c}`" for c in required)
    return counts.selectExpr(f"stack({len(required)}, {stack}) AS (column_name, null_count)")

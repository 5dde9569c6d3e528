"""Raw, text-typed inputs derived from the driver tables.

The reference reads five all-text CSV files and one JSON event stream. Here the
same shapes are derived from the driver's parquet tables by Spark, dirty values
included, so every operator downstream sees text exactly as a CSV read would
produce it and all work grows with the tables:

=============  ==============================================================
crimes         orders joined to customer; district = nation code of the customer
arrests        lineitem rows with return flag R (several per order: dedup is real)
stations       nation (``NATION_i`` -> digits -> code); ``NATION_0`` is the 000 sentinel
violence       lineitem joined to supplier; district = supplier nation
registry       customer; block = customer name (blank for negative balances)
event stream   events; district = position of the event type in a fixed list
=============  ==============================================================

``SQL_*`` strings are the same derivations written for DuckDB; the oracle
queries in ``plans.catalog`` are built on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import EVENT_TIME_FORMAT
from ..schemas import (ARREST_COLUMNS, CRIME_COLUMNS, REGISTRY_COLUMNS,
                       STATION_COLUMNS, VIOLENCE_COLUMNS)

# The event types of the driver's ``events`` table, in the order
# that gives each its district number (1-based).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
SQL_TIME_FORMAT = "%m/%d/%Y %I:%M:%S %p"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: Column) -> Column:
    return c.cast("string")


def _shape(columns: list[str], values: dict[str, Column]) -> list[Column]:
    """All header columns in file order; the ones not derived are NULL text."""
    return [values.get(name, F.lit(None).cast("string")).alias(name) for name in columns]


def _time_of_day(key: Column) -> Column:
    """A deterministic second of the day spread over 24 h (the driver dates are
    midnight); the same arithmetic is in the SQL twin."""
    return (key * F.lit(7919)) % F.lit(86400)


# --------------------------------------------------------------------- crimes
def raw_crimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    ts = F.timestamp_add("SECOND", _time_of_day(F.col("o_orderkey")), F.col("o_orderdate"))
    status, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    values = {
        "ID": _text(F.col("o_orderkey")),
        "Case Number": F.when((status == "P") & (prio == "5-LOW"), F.lit(None))
                        .otherwise(F.concat(F.lit("JC"), _text(F.col("o_orderkey")))),
        "Date": F.when((prio == "4-NOT SPECIFIED") & (status == "F"), F.lit("unknown"))
                 .otherwise(F.date_format(ts, EVENT_TIME_FORMAT)),
        "Block": F.col("c_name"),
        "Primary Type": prio,
        "Arrest": F.when(status == "F", F.lit("true")).when(status == "O", F.lit("N"))
                   .otherwise(F.lit("maybe")),
        "District": F.when((F.col("c_mktsegment") == "AUTOMOBILE") & (status == "O"), F.lit("HQ"))
                     .otherwise(F.concat(F.lit("D-"), _text(F.col("c_nationkey")), F.lit("x"))),
        "Community Area": F.col("c_mktsegment"),
        "Year": _text(F.year(ts)),
        "Latitude": F.when((prio == "1-URGENT") & (status == "P"), F.lit(""))
                     .otherwise(_text(F.lit(41.6) + F.col("c_acctbal") / F.lit(25000.0))),
        "Longitude": _text(F.lit(-87.9) + F.col("o_totalprice") / F.lit(1250000.0)),
    }
    return j.select(*_shape(CRIME_COLUMNS, values))


SQL_RAW_CRIMES = f"""
SELECT
  CAST(o_orderkey AS VARCHAR) AS "ID",
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL
       ELSE 'JC' || CAST(o_orderkey AS VARCHAR) END AS "Case Number",
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'F' THEN 'unknown'
       ELSE strftime(o_orderdate + to_seconds((o_orderkey * 7919) % 86400), '{SQL_TIME_FORMAT}') END AS "Date",
  c_name AS "Block",
  o_orderpriority AS "Primary Type",
  CASE WHEN o_orderstatus = 'F' THEN 'true' WHEN o_orderstatus = 'O' THEN 'N' ELSE 'maybe' END AS "Arrest",
  CASE WHEN c_mktsegment = 'AUTOMOBILE' AND o_orderstatus = 'O' THEN 'HQ'
       ELSE 'D-' || CAST(c_nationkey AS VARCHAR) || 'x' END AS "District",
  c_mktsegment AS "Community Area",
  CAST(year(o_orderdate + to_seconds((o_orderkey * 7919) % 86400)) AS VARCHAR) AS "Year",
  CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN ''
       ELSE CAST(41.6 + c_acctbal / 25000.0 AS VARCHAR) END AS "Latitude",
  CAST(-87.9 + o_totalprice / 1250000.0 AS VARCHAR) AS "Longitude"
FROM orders JOIN customer ON o_custkey = c_custkey
"""


# -------------------------------------------------------------------- arrests
def raw_arrests(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    ts = F.timestamp_add("SECOND", _time_of_day(F.col("l_orderkey") + F.col("l_linenumber")),
                         F.col("l_shipdate"))
    values = {
        "CB_NO": F.concat(_text(F.col("l_orderkey")), F.lit("-"), _text(F.col("l_linenumber"))),
        "CASE NUMBER": F.concat(F.lit("JC"), _text(F.col("l_orderkey"))),
        "ARREST DATE": F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1),
                              F.lit("pending"))
                        .otherwise(F.date_format(ts, EVENT_TIME_FORMAT)),
        "RACE": F.concat(F.col("l_linestatus"), F.lit("-"), _text(F.col("l_linenumber"))),
    }
    return li.select(*_shape(ARREST_COLUMNS, values))


SQL_RAW_ARRESTS = f"""
SELECT
  'JC' || CAST(l_orderkey AS VARCHAR) AS "CASE NUMBER",
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN 'pending'
       ELSE strftime(l_shipdate + to_seconds(((l_orderkey + l_linenumber) * 7919) % 86400), '{SQL_TIME_FORMAT}') END AS "ARREST DATE",
  l_linestatus || '-' || CAST(l_linenumber AS VARCHAR) AS "RACE"
FROM lineitem WHERE l_returnflag = 'R'
"""


# ------------------------------------------------------------------- stations
def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    values = {
        "DISTRICT": F.col("n_name"),
        "DISTRICT NAME": F.concat(F.col("n_name"), F.lit(" / R"), _text(F.col("n_regionkey"))),
        "LATITUDE": _text(F.lit(41.6) + F.col("n_nationkey") / F.lit(100.0)),
        "LONGITUDE": _text(F.lit(-87.9) + F.col("n_regionkey") / F.lit(10.0)),
    }
    return n.select(*_shape(STATION_COLUMNS, values))


SQL_RAW_STATIONS = """
SELECT n_name AS "DISTRICT",
       n_name || ' / R' || CAST(n_regionkey AS VARCHAR) AS "DISTRICT NAME",
       CAST(41.6 + n_nationkey / 100.0 AS VARCHAR) AS "LATITUDE",
       CAST(-87.9 + n_regionkey / 10.0 AS VARCHAR) AS "LONGITUDE"
FROM nation
"""


# ------------------------------------------------------------------- violence
def raw_violence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"], "inner")
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    values = {
        "CASE_NUMBER": F.concat(F.lit("JV"), _text(F.col("l_orderkey")), F.lit("-"),
                                _text(F.col("l_linenumber"))),
        "DATE": F.date_format(F.col("l_shipdate"), EVENT_TIME_FORMAT),
        "DISTRICT": F.concat(F.lit("D"), _text(F.col("s_nationkey"))),
        "COMMUNITY_AREA": _text(F.col("s_suppkey")),
        "MONTH": _text(F.month(F.col("l_shipdate"))),
        "DAY_OF_WEEK": F.date_format(F.col("l_shipdate"), "E"),
        "INCIDENT_PRIMARY": F.when(status == "F", F.lit("homicide"))
                             .when(flag == "N", F.lit(None)).otherwise(F.lit("Shooting")),
        "GUNSHOT_INJURY_I": F.when(flag == "R", F.lit("Yes")).when(flag == "A", F.lit("y"))
                             .otherwise(F.lit("no")),
    }
    return j.select(*_shape(VIOLENCE_COLUMNS, values))


SQL_RAW_VIOLENCE = f"""
SELECT
  'JV' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS "CASE_NUMBER",
  strftime(l_shipdate, '{SQL_TIME_FORMAT}') AS "DATE",
  'D' || CAST(s_nationkey AS VARCHAR) AS "DISTRICT",
  CAST(s_suppkey AS VARCHAR) AS "COMMUNITY_AREA",
  CAST(month(l_shipdate) AS VARCHAR) AS "MONTH",
  strftime(l_shipdate, '%a') AS "DAY_OF_WEEK",
  CASE WHEN l_linestatus = 'F' THEN 'homicide' WHEN l_returnflag = 'N' THEN NULL
       ELSE 'Shooting' END AS "INCIDENT_PRIMARY",
  CASE WHEN l_returnflag = 'R' THEN 'Yes' WHEN l_returnflag = 'A' THEN 'y'
       ELSE 'no' END AS "GUNSHOT_INJURY_I"
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


# ------------------------------------------------------------------- registry
def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    values = {
        "BLOCK": F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_name")),
        "RACE": seg,
        "VICTIM MINOR": F.when(seg == "BUILDING", F.lit("y")).when(seg == "MACHINERY", F.lit("N")),
    }
    return c.select(*_shape(REGISTRY_COLUMNS, values))


SQL_RAW_REGISTRY = """
SELECT CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS "BLOCK",
       c_mktsegment AS "RACE",
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'y' WHEN c_mktsegment = 'MACHINERY' THEN 'N'
            ELSE NULL END AS "VICTIM MINOR"
FROM customer
"""


# ------------------------------------------------------------------ event log
def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as producer-side text fields (one message per event)."""
    e = table(spark, sf_dir, "events")
    types = F.array(*[F.lit(t) for t in EVENT_TYPES])
    value = F.col("value")
    return e.select(
        F.col("event_id"),
        F.col("ts"),
        _text(F.col("event_id")).alias("case_number"),
        F.date_format(F.col("ts"), EVENT_TIME_FORMAT).alias("date"),
        F.when(value < 1.0, F.lit("  "))
         .otherwise(F.concat(F.lit("user "), _text(F.col("user_id")))).alias("block"),
        F.col("event_type").alias("primary_type"),
        F.when(value > 150.0, F.lit("HQ"))
         .when((F.col("event_type") == "signup") & (value > 140.0),
               F.concat(F.lit("D"), _text(F.col("event_id")), F.lit("0000000000")))
         .otherwise(F.concat(F.lit("D"), _text(F.array_position(types, F.col("event_type")))))
         .alias("district"),
        F.when(value > 50.0, F.lit("true")).otherwise(F.lit("false")).alias("arrest"),
        value.alias("latitude"),
        F.get_json_object(F.col("props"), "$.k").cast("double").alias("longitude"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed JSON messages as a broker would hold them: (key, value, event_id).

    Some messages are cut short (malformed JSON), carry a blank block, the
    ``HQ`` code (no digits) or a code whose digits overflow an int, so every
    reject path of the parser is exercised by real data.
    """
    f = event_fields(spark, sf_dir)
    body = F.to_json(F.struct("case_number", "date", "block", "primary_type", "district",
                              "arrest", "latitude", "longitude"))
    broken = (F.col("primary_type") == "error") & (F.col("latitude") > 100.0)
    return f.select(
        F.col("event_id"),
        F.col("district").alias("key"),
        F.when(broken, F.substring(body, 1, 20)).otherwise(body).alias("value"),
    )


_SQL_TYPES = "[" + ", ".join(f"'{t}'" for t in EVENT_TYPES) + "]"

SQL_EVENT_FIELDS = f"""
SELECT event_id, ts,
  CAST(event_id AS VARCHAR) AS case_number,
  strftime(ts, '{SQL_TIME_FORMAT}') AS date,
  CASE WHEN value < 1.0 THEN '  ' ELSE 'user ' || CAST(user_id AS VARCHAR) END AS block,
  event_type AS primary_type,
  CASE WHEN value > 150.0 THEN 'HQ'
       WHEN event_type = 'signup' AND value > 140.0 THEN 'D' || CAST(event_id AS VARCHAR) || '0000000000'
       ELSE 'D' || CAST(list_position({_SQL_TYPES}, event_type) AS VARCHAR) END AS district,
  CASE WHEN value > 50.0 THEN 'true' ELSE 'false' END AS arrest,
  value AS latitude,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS longitude
FROM events
"""


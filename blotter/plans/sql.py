"""DuckDB twins of the cleaning and rollup steps, used by the oracle strings.

These are written independently of the Spark code path: plain SQL over the
driver's tables, so a match is evidence that both compute the same thing.
"""

from __future__ import annotations

from .standins import (SQL_EVENT_FIELDS, SQL_RAW_ARRESTS, SQL_RAW_CRIMES,
                       SQL_RAW_REGISTRY, SQL_RAW_STATIONS, SQL_RAW_VIOLENCE,
                       SQL_TIME_FORMAT)


def code_sql(x: str) -> str:
    """Batch code rule: first digit run of the trimmed text, lpad 3."""
    d = f"regexp_extract(trim({x}), '(\\d+)', 1)"
    return f"CASE WHEN length({d}) > 0 THEN lpad({d}, 3, '0') END"


def ts_sql(x: str) -> str:
    return f"try_strptime({x}, '{SQL_TIME_FORMAT}')"


def bool_sql(x: str) -> str:
    v = f"lower(trim({x}))"
    return (f"CASE WHEN {v} IN ('true','t','1','yes','y') THEN true "
            f"WHEN {v} IN ('false','f','0','no','n') THEN false END")


def int_sql(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?\\d+') THEN TRY_CAST(trim({x}) AS INTEGER) END"


def dbl_sql(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


CLEAN_CRIMES = f"""
SELECT "Case Number" AS case_number, {ts_sql('"Date"')} AS event_ts, "Block" AS block,
       "Primary Type" AS primary_type, {bool_sql('"Arrest"')} AS arrest,
       {code_sql('"District"')} AS district, "Community Area" AS community_area,
       {int_sql('"Year"')} AS year, {dbl_sql('"Latitude"')} AS latitude,
       {dbl_sql('"Longitude"')} AS longitude
FROM raw_crimes WHERE "Case Number" IS NOT NULL
"""

CLEAN_ARRESTS = f"""
SELECT "CASE NUMBER" AS case_number, {ts_sql('"ARREST DATE"')} AS arrest_ts, "RACE" AS race
FROM raw_arrests
"""

DEDUP_ARRESTS = """
SELECT case_number, arrest_ts, race FROM (
  SELECT *, row_number() OVER (PARTITION BY case_number
                               ORDER BY arrest_ts ASC NULLS LAST, race ASC NULLS FIRST) AS rn
  FROM arrests_all) WHERE rn = 1
"""

CLEAN_STATIONS = f"""
SELECT * FROM (
  SELECT {code_sql('"DISTRICT"')} AS district, "DISTRICT NAME" AS station_name,
         {dbl_sql('"LATITUDE"')} AS station_latitude, {dbl_sql('"LONGITUDE"')} AS station_longitude
  FROM raw_stations) WHERE district <> '000'
"""

CLEAN_VIOLENCE = f"""
SELECT "CASE_NUMBER" AS case_number, {ts_sql('"DATE"')} AS event_ts,
       {code_sql('"DISTRICT"')} AS district, "COMMUNITY_AREA" AS community_area,
       "MONTH" AS month, "DAY_OF_WEEK" AS day_of_week,
       upper("INCIDENT_PRIMARY") AS incident_primary, upper("GUNSHOT_INJURY_I") AS gunshot_injury
FROM raw_violence
"""

CLEAN_REGISTRY = """
SELECT "BLOCK" AS block, "RACE" AS race, upper("VICTIM MINOR") AS victim_minor FROM raw_registry
"""

JOINED = """
SELECT c.*, a.arrest_ts, a.race FROM crimes c LEFT JOIN arrests a USING (case_number)
"""

STATION_INDEX = """
SELECT district, station_name,
       CAST(row_number() OVER (ORDER BY district NULLS FIRST, station_name NULLS FIRST) - 1 AS BIGINT)
         AS district_index
FROM (SELECT DISTINCT district, station_name FROM stations)
"""

# Every CTE an oracle may need, in dependency order; ``ctes(...)`` keeps the
# ones a query names (and what they depend on).
_ALL = {
    "raw_crimes": (SQL_RAW_CRIMES, []),
    "raw_arrests": (SQL_RAW_ARRESTS, []),
    "raw_stations": (SQL_RAW_STATIONS, []),
    "raw_violence": (SQL_RAW_VIOLENCE, []),
    "raw_registry": (SQL_RAW_REGISTRY, []),
    "event_fields": (SQL_EVENT_FIELDS, []),
    "crimes": (CLEAN_CRIMES, ["raw_crimes"]),
    "arrests_all": (CLEAN_ARRESTS, ["raw_arrests"]),
    "arrests": (DEDUP_ARRESTS, ["arrests_all"]),
    "stations": (CLEAN_STATIONS, ["raw_stations"]),
    "violence": (CLEAN_VIOLENCE, ["raw_violence"]),
    "registry": (CLEAN_REGISTRY, ["raw_registry"]),
    "joined": (JOINED, ["crimes", "arrests"]),
    "station_index": (STATION_INDEX, ["stations"]),
}


def register_cte(name: str, sql: str, deps: list[str]) -> None:
    _ALL[name] = (sql, deps)


def ctes(body: str, *names: str) -> str:
    """``WITH`` the named CTEs (plus dependencies, in order) then ``body``."""
    want: list[str] = []

    def visit(n: str) -> None:
        for d in _ALL[n][1]:
            visit(d)
        if n not in want:
            want.append(n)

    for n in names:
        visit(n)
    order = [n for n in _ALL if n in want]
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({_ALL[n][0].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"

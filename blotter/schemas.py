"""Declared schemas: raw inputs (all text, bound by position), the event
message, and the result tables (SURVEY 1.3, 1.4; S2, K8)."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the five raw input files, in file order.
CRIME_COLUMNS = [
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District", "Ward",
    "Community Area", "FBI Code", "X Coordinate", "Y Coordinate", "Year",
    "Updated On", "Latitude", "Longitude", "Location",
]
ARREST_COLUMNS = [
    "CB_NO", "CASE NUMBER", "ARREST DATE", "RACE",
    "CHARGE 1 STATUTE", "CHARGE 1 DESCRIPTION", "CHARGE 1 TYPE", "CHARGE 1 CLASS",
    "CHARGE 2 STATUTE", "CHARGE 2 DESCRIPTION", "CHARGE 2 TYPE", "CHARGE 2 CLASS",
    "CHARGE 3 STATUTE", "CHARGE 3 DESCRIPTION", "CHARGE 3 TYPE", "CHARGE 3 CLASS",
    "CHARGE 4 STATUTE", "CHARGE 4 DESCRIPTION", "CHARGE 4 TYPE", "CHARGE 4 CLASS",
    "CHARGES STATUTE", "CHARGES DESCRIPTION", "CHARGES TYPE", "CHARGES CLASS",
]
STATION_COLUMNS = [
    "DISTRICT", "DISTRICT NAME", "ADDRESS", "CITY", "STATE", "ZIP", "WEBSITE",
    "PHONE", "FAX", "TTY", "X COORDINATE", "Y COORDINATE", "LATITUDE",
    "LONGITUDE", "LOCATION",
]
VIOLENCE_COLUMNS = [
    "CASE_NUMBER", "DATE", "BLOCK", "VICTIMIZATION_PRIMARY", "INCIDENT_PRIMARY",
    "GUNSHOT_INJURY_I", "UNIQUE_ID", "ZIP_CODE", "WARD", "COMMUNITY_AREA",
    "STREET_OUTREACH_ORGANIZATION", "AREA", "DISTRICT", "BEAT", "AGE", "SEX",
    "RACE", "VICTIMIZATION_FBI_CD", "INCIDENT_FBI_CD", "VICTIMIZATION_FBI_DESCR",
    "INCIDENT_FBI_DESCR", "VICTIMIZATION_IUCR_CD", "INCIDENT_IUCR_CD",
    "VICTIMIZATION_IUCR_SECONDARY", "INCIDENT_IUCR_SECONDARY",
    "HOMICIDE_VICTIM_FIRST_NAME", "HOMICIDE_VICTIM_MI", "HOMICIDE_VICTIM_LAST_NAME",
    "MONTH", "DAY_OF_WEEK", "HOUR", "LOCATION_DESCRIPTION",
    "STATE_HOUSE_DISTRICT", "STATE_SENATE_DISTRICT", "UPDATED", "LATITUDE",
    "LONGITUDE", "LOCATION",
]
REGISTRY_COLUMNS = [
    "LAST", "FIRST", "BLOCK", "GENDER", "RACE", "BIRTH DATE", "HEIGHT", "WEIGHT",
    "VICTIM MINOR",
]
# The eight required fields of an event message, in order.
EVENT_FIELDS = [
    "case_number", "date", "block", "primary_type", "district", "arrest",
    "latitude", "longitude",
]
# Accepted header aliases per event field, first present wins.
EVENT_FIELD_ALIASES = {
    "case_number": ["Case Number", "CASE NUMBER", "case_number"],
    "date": ["Date", "DATE", "date"],
    "block": ["Block", "BLOCK", "block"],
    "primary_type": ["Primary Type", "PRIMARY TYPE", "primary_type"],
    "district": ["District", "DISTRICT", "district"],
    "arrest": ["Arrest", "ARREST", "arrest"],
    "latitude": ["Latitude", "LATITUDE", "latitude"],
    "longitude": ["Longitude", "LONGITUDE", "longitude"],
}

# Labels written into the result tables, and the yes-spellings
# of the gunshot flag.
UNKNOWN = "UNKNOWN"
METRIC_MIX_PREFIX = "homicide_vs_shooting:"
METRIC_AREA = "top_community_area"
METRIC_FLAG = "gunshot_proportion"
PAIR_INCIDENT_RATE = "violence_rate_vs_arrest_rate"
PAIR_DENSITY_COUNT = "sex_offender_density_vs_crime_rate"
YES_FLAGS = ["YES", "Y"]

CORRUPT_COLUMN = "_corrupt_record"


def text_schema(columns: list[str], corrupt: bool = False) -> T.StructType:
    fields = [T.StructField(c, T.StringType(), True) for c in columns]
    if corrupt:
        fields.append(T.StructField(CORRUPT_COLUMN, T.StringType(), True))
    return T.StructType(fields)


CRIME_SCHEMA = text_schema(CRIME_COLUMNS)
ARREST_SCHEMA = text_schema(ARREST_COLUMNS)
STATION_SCHEMA = text_schema(STATION_COLUMNS)
VIOLENCE_SCHEMA = text_schema(VIOLENCE_COLUMNS)
REGISTRY_SCHEMA = text_schema(REGISTRY_COLUMNS)

# Every field of a message is read as text; numbers and booleans stringify.
EVENT_MESSAGE_SCHEMA = text_schema(EVENT_FIELDS + ["produced_at"])


def _f(name: str, typ: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, typ, nullable)


S, L, D, I = T.StringType(), T.LongType(), T.DoubleType(), T.IntegerType()
TS = T.TimestampNTZType()

# Result tables; ``nullable=False`` marks the NOT NULL columns of the serving DDL.
RESULT_SCHEMAS: dict[str, T.StructType] = {
    "crime_trends": T.StructType([
        _f("trend_type", S, False), _f("period_value", S, False),
        _f("district", S), _f("crime_count", L, False), _f("period_order", I)]),
    "arrest_rates": T.StructType([
        _f("group_type", S, False), _f("group_value", S, False),
        _f("crime_count", L, False), _f("arrest_count", L, False),
        _f("arrest_rate", D, False)]),
    "violence_stats": T.StructType([
        _f("metric", S, False), _f("district", S), _f("period_value", S),
        _f("community_area", S), _f("incident_count", L, False), _f("rate", D)]),
    "offender_density": T.StructType([
        _f("district", S, False), _f("station_name", S),
        _f("offender_count", L, False), _f("priority_minor_victim_count", L, False)]),
    "hotspots": T.StructType([
        _f("cluster_id", I, False), _f("latitude", D, False),
        _f("longitude", D, False), _f("crime_count", L, False)]),
    "correlations": T.StructType([
        _f("correlation_name", S, False), _f("group_key", S, False),
        _f("x_value", D, False), _f("y_value", D, False)]),
    "alerts": T.StructType([
        _f("district", S, False), _f("alert_timestamp", TS, False),
        _f("event_count", L, False), _f("threshold_value", L, False),
        _f("severity", S, False), _f("payload", S)]),
}

"""Event messages: producer-side normalisation and consumer-side parsing
(P12-P14, P17, F2, F3, F8-F10, F18, F20, T6).

Every function here is a DataFrame -> DataFrame transform with no state, so
it runs the same on a batch frame (checked against SQL) and on a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import stream_code, zfill_code
from ..functions.parse import (first_missing, is_empty, parse_boolean_strict,
                               parse_event_time, to_double, truthy)
from ..schemas import (CORRUPT_COLUMN, EVENT_FIELD_ALIASES, EVENT_FIELDS,
                       EVENT_MESSAGE_SCHEMA, text_schema)

ACCEPTED = "accepted"


# ------------------------------------------------------------------ producer
def alias_columns(columns: list[str], aliases: dict[str, list[str]] = EVENT_FIELD_ALIASES):
    """Per output field, the first alias that is one of ``columns`` (even when
    its value is empty); a field with no alias is NULL."""
    cols = []
    for name, names in aliases.items():
        found = next((n for n in names if n in columns), None)
        cols.append((F.col(f"`{found}`") if found else F.lit(None).cast("string")).alias(name))
    return cols


def resolve_aliases(df: DataFrame, aliases: dict[str, list[str]] = EVENT_FIELD_ALIASES) -> DataFrame:
    """The event fields of ``df`` under their canonical names."""
    return df.select(*alias_columns(df.columns, aliases))


def produce_events(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Producer rule over aliased rows: reject when a field is None or "",
    then arrest = truthy, district = strip + zfill(3), coordinates as doubles
    (a non-number rejects). Adds ``reason`` (NULL when accepted); ``keep``
    names input columns carried through unchanged (e.g. a row id)."""
    fields = rows.select(*[F.col(f"`{k}`").alias(k) for k in keep],
                         *alias_columns(rows.columns))
    missing = first_missing(EVENT_FIELDS, blank=is_empty)
    lat, lon = to_double("latitude"), to_double("longitude")
    reason = (F.when(missing.isNotNull(), F.concat(F.lit("missing:"), missing))
               .when(lat.isNull(), F.lit("bad_double:latitude"))
               .when(lon.isNull(), F.lit("bad_double:longitude")))
    return fields.select(
        *keep, "case_number", "date", "block", "primary_type",
        zfill_code("district").alias("district"),
        truthy("arrest").alias("arrest"),
        lat.alias("latitude"), lon.alias("longitude"),
        reason.alias("reason"))


def accepted_events(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reason").isNull()).drop("reason")


# ------------------------------------------------------------------ consumer
_DECODE_SCHEMA = text_schema(EVENT_FIELDS + ["produced_at"], corrupt=True)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to named text fields (numbers keep their JSON text).

    One parse per message: text that is not a JSON object (or is NULL) lands
    in the corrupt-record field and sets ``_malformed``.
    """
    m = F.from_json(F.col(value), _DECODE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    return messages.select("*", m.alias("_m")).select(
        *[c for c in messages.columns],
        (F.col("_m").isNull() | F.col(f"_m.{CORRUPT_COLUMN}").isNotNull()).alias("_malformed"),
        *[F.col(f"_m.{f}").alias(f) for f in EVENT_FIELDS])


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """P12 + P13 + F2 + F9 + F10: the stream parser.

    Rejects, in order: malformed JSON; a required field NULL or blank; a
    district whose digits overflow an int; a coordinate that is not a
    number. Accepted rows get the normalised district, the strict boolean,
    double coordinates and ``event_ts`` parsed from ``date``; ``reason`` is
    NULL for them. ``raw_json`` keeps the message text.
    """
    keep = [c for c in messages.columns if c != value]
    # Every test is a column of its own before ``reason`` reads it: its code stands once, and
    # the generated method stays below the 8,000 bytes that the JVM still compiles.
    d = decode(messages, value).select(
        *keep, "case_number", "date", "block", "primary_type",
        stream_code("district").alias("district"),
        parse_boolean_strict("arrest").alias("arrest"),
        to_double("latitude").alias("latitude"), to_double("longitude").alias("longitude"),
        parse_event_time("date").alias("event_ts"),
        F.col(value).alias("raw_json"),
        "_malformed", first_missing(EVENT_FIELDS).alias("_missing"))
    reason = (F.when(F.col("_malformed"), F.lit("malformed"))
               .when(F.col("_missing").isNotNull(), F.concat(F.lit("missing:"), F.col("_missing")))
               .when(F.col("district").isNull(), F.lit("bad_district"))
               .when(F.col("latitude").isNull(), F.lit("bad_double:latitude"))
               .when(F.col("longitude").isNull(), F.lit("bad_double:longitude")))
    return d.withColumn("reason", reason).drop("_malformed", "_missing")


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) halves of a parsed frame."""
    ok = parsed.filter(F.col("reason").isNull()).drop("reason")
    bad = parsed.filter(F.col("reason").isNotNull()).select("reason", "raw_json")
    return ok, bad


def quarantine_counts(parsed: DataFrame) -> DataFrame:
    """Messages per outcome (``accepted`` or the reject reason)."""
    return parsed.groupBy(F.coalesce(F.col("reason"), F.lit(ACCEPTED)).alias("reason")).agg(
        F.count(F.lit(1)).alias("message_count"))


def route(accepted: DataFrame) -> DataFrame:
    """The routed tuple (district first)."""
    return accepted.select("district", "case_number", "date", "primary_type", "raw_json")


def raw_archive(accepted: DataFrame, stamp: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """K4 + F20: archive document with the nested payload and load time (the
    ``stamp`` column's, or the current time); ``keep`` columns are carried along."""
    payload = F.from_json(F.col("raw_json"), EVENT_MESSAGE_SCHEMA)
    return accepted.select(
        *(keep or []), "case_number", F.col("date").alias("event_timestamp"), "district", "primary_type",
        payload.alias("payload"), (F.col(stamp) if stamp else F.current_timestamp()).alias("ingested_at"))

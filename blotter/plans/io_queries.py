"""Registered queries for sources, event parsing, streams, sinks and serving.

Stream keys run a real Structured Streaming query (``availableNow``) over
files that Spark first derives from the driver tables into the shared
folder, then return what the sink holds. Their oracles are the equivalent
batch SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cleaning, rollups, serving, windows
from ..schemas import CRIME_SCHEMA, RESULT_SCHEMAS
from ..session import scratch_path
from ..sinks import tables
from ..sources import files
from ..sources.connectors import keyed_json
from ..streaming import events as ev
from ..streaming import runner
from . import standins as S
from ..operators.hotspots import KMEANS_K
from .catalog import (_ALERTS_SQL, _METRICS_SQL, _PAIRS_SQL, _RATE_ALL_SQL, ALERT_SIZE_S, ALERT_SLIDE_S,
                      ALERT_THRESHOLD, _alerts_sql, _rate_sql, _window_sql, batch_alerts,
                      crimes, joined, register)
from .sql import ctes, register_cte

# ------------------------------------------------------------ SQL twins
register_cte("rate_all", " UNION ALL ".join(f"({_rate_sql(g)})" for g in rollups.RATE_GROUPS),
             ["joined"])
register_cte("msg", """
SELECT event_id, (primary_type = 'error' AND latitude > 100.0) AS malformed,
       case_number, date, block, primary_type, district AS district_raw, arrest AS arrest_raw,
       latitude AS lat, longitude AS lon
FROM event_fields""", ["event_fields"])


def _blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '\\s*'))"


_FIELDS = [("case_number", "case_number"), ("date", "date"), ("block", "block"),
           ("primary_type", "primary_type"), ("district", "district_raw"),
           ("arrest", "arrest_raw"), ("latitude", "CAST(lat AS VARCHAR)"),
           ("longitude", "CAST(lon AS VARCHAR)")]
_MISSING = "CASE " + " ".join(f"WHEN {_blank(e)} THEN 'missing:{n}'" for n, e in _FIELDS) + " END"
_DIGITS = "regexp_replace(district_raw, '\\D', '', 'g')"

register_cte("decoded", """
SELECT event_id,
       CASE WHEN malformed THEN NULL ELSE case_number END AS case_number,
       CASE WHEN malformed THEN NULL ELSE date END AS date,
       CASE WHEN malformed THEN NULL ELSE block END AS block,
       CASE WHEN malformed THEN NULL ELSE primary_type END AS primary_type,
       CASE WHEN malformed THEN NULL ELSE district_raw END AS district_raw,
       CASE WHEN malformed THEN NULL ELSE arrest_raw END AS arrest_raw,
       CASE WHEN malformed THEN NULL ELSE lat END AS lat,
       CASE WHEN malformed THEN NULL ELSE lon END AS lon,
       malformed
FROM msg""", ["msg"])

register_cte("parsed", f"""
SELECT event_id, case_number, date, block, primary_type,
       CASE WHEN length({_DIGITS}) = 0 THEN '000'
            WHEN TRY_CAST({_DIGITS} AS INTEGER) IS NULL THEN NULL
            ELSE format('{{:03d}}', TRY_CAST({_DIGITS} AS INTEGER)) END AS district,
       coalesce(lower(arrest_raw) = 'true', false) AS arrest,
       lat AS latitude, lon AS longitude,
       try_strptime(date, '{S.SQL_TIME_FORMAT}') AS event_ts,
       CASE WHEN malformed THEN 'malformed'
            WHEN {_MISSING} IS NOT NULL THEN {_MISSING}
            WHEN length({_DIGITS}) > 0 AND TRY_CAST({_DIGITS} AS INTEGER) IS NULL THEN 'bad_district'
            WHEN lat IS NULL THEN 'bad_double:latitude'
            WHEN lon IS NULL THEN 'bad_double:longitude' END AS reason
FROM decoded""", ["decoded"])

register_cte("accepted", "SELECT * EXCLUDE (reason) FROM parsed WHERE reason IS NULL", ["parsed"])


def _empty(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


_PFIELDS = [("case_number", '"Case Number"'), ("date", '"Date"'), ("block", '"Block"'),
            ("primary_type", '"Primary Type"'), ("district", '"District"'), ("arrest", '"Arrest"'),
            ("latitude", '"Latitude"'), ("longitude", '"Longitude"')]
_PMISSING = "CASE " + " ".join(f"WHEN {_empty(e)} THEN 'missing:{n}'" for n, e in _PFIELDS) + " END"

register_cte("produced", f"""
SELECT CAST("ID" AS BIGINT) AS id, "Case Number" AS case_number, "Date" AS date, "Block" AS block,
       "Primary Type" AS primary_type,
       CASE WHEN length(trim("District")) < 3 THEN lpad(trim("District"), 3, '0')
            ELSE trim("District") END AS district,
       coalesce(lower(trim("Arrest")) IN ('true','t','1','yes','y'), false) AS arrest,
       TRY_CAST("Latitude" AS DOUBLE) AS latitude, TRY_CAST("Longitude" AS DOUBLE) AS longitude,
       CASE WHEN {_PMISSING} IS NOT NULL THEN {_PMISSING}
            WHEN TRY_CAST("Latitude" AS DOUBLE) IS NULL THEN 'bad_double:latitude'
            WHEN TRY_CAST("Longitude" AS DOUBLE) IS NULL THEN 'bad_double:longitude' END AS reason
FROM raw_crimes""", ["raw_crimes"])

_PRODUCED_COLS = "case_number, date, block, primary_type, district, arrest, latitude, longitude"


# ------------------------------------------------------------- helpers
def messages(spark, d):
    return S.event_messages(spark, d)


def parsed(spark, d):
    return ev.parse_messages(messages(spark, d))


def stage_messages(spark, d, copies=1) -> runner.Staged:
    """The messages as replay files; streams read them in two micro-batches,
    so window state always crosses a batch boundary."""
    path = scratch_path(spark, "messages")
    return runner.stage_files(messages(spark, d), path, "event_id", copies=copies)


def message_stream(spark, source):
    return runner.file_stream(spark, source, runner.MESSAGE_SCHEMA)


def stream_accepted(spark, source):
    accepted, _ = ev.split_parsed(ev.parse_messages(message_stream(spark, source)))
    return accepted


# ------------------------------------------------------------ sources
@register("src_csv_typed", ctes("SELECT * FROM crimes", "crimes"))
def q_src_csv_typed(spark, d):
    """S1 + S2: crime rows written as CSV, read back under the declared
    22-column text schema (header checked), then cleaned."""
    path = scratch_path(spark, "crimes-csv")
    S.raw_crimes(spark, d).write.option("header", True).csv(path)
    return cleaning.clean_crimes(files.read_csv(spark, path, CRIME_SCHEMA))


def _crime_lines(spark, d):
    """Crime rows as CSV lines, some with fields too many or too few."""
    raw = S.raw_crimes(spark, d)
    line = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in raw.columns]))
    odd = F.col("ID").cast("long") % 50
    return raw.select(F.when(odd == 0, F.concat(line, F.lit(",more,fields"))).when(odd == 1, F.substring_index(line, ",", 5)).otherwise(line).alias("value"))


@register("src_csv_quarantine", ctes(
    """SELECT CAST("ID" AS BIGINT) AS id, CASE WHEN CAST("ID" AS BIGINT) % 50 IN (0, 1) THEN 'field_count' END AS reason,
              CAST("ID" AS BIGINT) % 50 IN (0, 1) AS has_place FROM raw_crimes""", "raw_crimes"))
def q_src_csv_quarantine(spark, d):
    """S3 + S4: every line of many CSV files, read by a glob: good rows, or
    quarantined text with its reason and place (file and block)."""
    path = scratch_path(spark, "crime-lines")
    _crime_lines(spark, d).write.text(path)
    good, bad = files.stage_csv_quarantine(spark, f"{path}/part-*", CRIME_SCHEMA, scratch_path(spark, "crime-rows"), header=False)
    place = F.col("file").contains("part-") & (F.col("block_start") >= 0)
    return good.select(F.col("ID").cast("long").alias("id"), F.lit(None).cast("string").alias("reason"), F.lit(False).alias("has_place")) \
        .unionByName(bad.select(F.substring_index("raw", ",", 1).cast("long").alias("id"), "reason", place.alias("has_place")))


@register("resolve_aliases", ctes(
    'SELECT "Case Number" AS case_number, "Date" AS date, "Block" AS block, '
    '"Primary Type" AS primary_type, "District" AS district, "Arrest" AS arrest, '
    '"Latitude" AS latitude, "Longitude" AS longitude FROM raw_crimes', "raw_crimes"))
def q_resolve_aliases(spark, d):
    """Event fields picked by header alias."""
    return ev.resolve_aliases(S.raw_crimes(spark, d))


@register("limit_valid", ctes(
    f"SELECT id AS row_id, {_PRODUCED_COLS} FROM produced WHERE reason IS NULL ORDER BY id LIMIT 1000",
    "produced"))
def q_limit_valid(spark, d):
    """The first 1,000 accepted producer rows in file (id) order."""
    rows = S.raw_crimes(spark, d)
    out = ev.accepted_events(ev.produce_events(rows, keep=("ID",)))
    out = out.select(F.col("ID").cast("long").alias("row_id"),
                     *[c for c in out.columns if c != "ID"])
    return out.orderBy("row_id").limit(1000)


@register("first_in_file_order", ctes(
    f"SELECT {_PRODUCED_COLS} FROM produced WHERE reason IS NULL ORDER BY id LIMIT 1000", "produced"))
def q_first_in_file_order(spark, d):
    """T6 on files: the first 1,000 accepted rows of a CSV folder in file order,
    without a sort and without one task that reads them all."""
    path = scratch_path(spark, "crimes-in-order")
    S.raw_crimes(spark, d).repartitionByRange(8, F.col("ID").cast("long")).sortWithinPartitions(F.col("ID").cast("long")) \
        .write.option("header", True).csv(path)
    rows = files.with_place(files.read_csv(spark, path, CRIME_SCHEMA))
    return files.first_rows(ev.accepted_events(ev.produce_events(rows, keep=files.PLACE)), 1000)


@register("stream_replay_events", ctes(
    f"SELECT {_PRODUCED_COLS} FROM produced WHERE reason IS NULL", "produced"))
def q_stream_replay_events(spark, d):
    """The crime CSV replayed as a file stream (two micro-batches)
    through the producer rules into a file sink."""
    src = scratch_path(spark, "crimes-replay")
    staged = runner.stage_files(S.raw_crimes(spark, d), src, "ID", fmt="csv")
    stream = runner.file_stream(spark, staged, CRIME_SCHEMA, fmt="csv", header="true")
    out = ev.accepted_events(ev.produce_events(stream))
    sink = runner.AppendTable(scratch_path(spark, "replayed"))
    runner.run_available(out, "append", runner.checkpoint_dir(spark, "replay"), sink)
    return sink.read(spark)


@register("kv_json_encode", ctes(
    "SELECT event_id, district AS key, json_object('case_number', case_number, 'date', date, "
    "'block', block, 'primary_type', primary_type, 'district', district, 'arrest', arrest, "
    "'latitude', latitude, 'longitude', longitude)::VARCHAR AS value FROM event_fields",
    "event_fields"))
def q_kv_json_encode(spark, d):
    """K5 + F19: keyed JSON records (key = district code text)."""
    return keyed_json(S.event_fields(spark, d), "district", ev.EVENT_FIELDS, keep=["event_id"])


# ------------------------------------------------------- event parsing
@register("json_decode", ctes(
    "SELECT event_id, case_number, date, block, primary_type, district_raw AS district, "
    "arrest_raw AS arrest, lat AS latitude, lon AS longitude FROM decoded", "decoded"))
def q_json_decode(spark, d):
    """message JSON to named fields (NULL for malformed messages)."""
    dec = ev.decode(messages(spark, d))
    return dec.select("event_id", "case_number", "date", "block", "primary_type", "district",
                      "arrest", F.col("latitude").try_cast("double").alias("latitude"),
                      F.col("longitude").try_cast("double").alias("longitude"))


@register("validate_required", ctes("SELECT event_id, reason FROM parsed", "parsed"))
def q_validate_required(spark, d):
    """P12 + F23: accept/reject decision per message with the first reason."""
    return parsed(spark, d).select("event_id", "reason")


@register("quarantine_counts", ctes(
    "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS message_count "
    "FROM parsed GROUP BY 1", "parsed"))
def q_quarantine_counts(spark, d):
    """Messages per outcome."""
    return ev.quarantine_counts(parsed(spark, d))


@register("stream_select", ctes(
    "SELECT district, case_number, date, primary_type FROM accepted", "accepted"))
def q_stream_select(spark, d):
    """P17 + W3/W4: the routed projection of accepted events, as a stream."""
    staged = stage_messages(spark, d)
    routed = ev.route(stream_accepted(spark, staged)).drop("raw_json")
    sink = runner.AppendTable(scratch_path(spark, "routed"))
    runner.run_available(routed, "append", runner.checkpoint_dir(spark, "route"), sink)
    return sink.read(spark)


# ------------------------------------------------------------ streams
_STREAM_WC_SQL = _window_sql("accepted", "district", "event_ts", ALERT_SIZE_S, ALERT_SLIDE_S)


def _stream_counts(spark, d):
    staged = stage_messages(spark, d)
    acc = stream_accepted(spark, staged)
    return windows.window_counts(acc, "event_ts", "district", ALERT_SIZE_S, ALERT_SLIDE_S)


@register("stream_window_counts", ctes(_STREAM_WC_SQL, "accepted"))
def q_stream_window_counts(spark, d):
    """W1 + A17 as a stream: complete-mode window counts per district."""
    sink = runner.LatestTable(scratch_path(spark, "wc"))
    runner.run_available(_stream_counts(spark, d), "complete",
                         runner.checkpoint_dir(spark, "wc"), sink)
    return sink.read(spark)


_STREAM_ALERTS_SQL = ctes(_alerts_sql(_STREAM_WC_SQL, "district", ALERT_THRESHOLD), "accepted")


@register("stream_alerts", _STREAM_ALERTS_SQL)
def q_stream_alerts(spark, d):
    """W6 + W7 + W12: threshold alerts from the streaming window counts."""
    alerts = windows.to_alerts(_stream_counts(spark, d), ALERT_THRESHOLD)
    sink = runner.LatestTable(scratch_path(spark, "alerts"))
    runner.run_available(alerts, "complete", runner.checkpoint_dir(spark, "alerts"), sink)
    return sink.read(spark)


@register("stream_dual_sink", _STREAM_ALERTS_SQL)
def q_stream_dual_sink(spark, d):
    """K6 + W5 + W9: alerts to a table and a document collection from one
    foreachBatch, both keyed by batch id; returns the table side."""
    alerts = windows.to_alerts(_stream_counts(spark, d), ALERT_THRESHOLD)
    sink = runner.DualSink(scratch_path(spark, "alerts-table"), scratch_path(spark, "alerts-docs"),
                           ["district", "alert_timestamp"], complete=True)
    runner.run_available(alerts, "complete", runner.checkpoint_dir(spark, "dual"), sink)
    return sink.read_table(spark)


@register("stream_raw_archive", ctes(
    "SELECT p.case_number, p.date AS event_timestamp, p.district, p.primary_type, "
    "d.block AS payload_block, d.arrest_raw AS payload_arrest, d.district_raw AS payload_district, "
    "d.lat AS payload_latitude, d.lon AS payload_longitude "
    "FROM parsed p JOIN decoded d USING (event_id) WHERE p.reason IS NULL", "parsed", "decoded"))
def q_stream_raw_archive(spark, d):
    """K4 + F20: accepted events archived with their nested payload (the
    load stamp ``ingested_at`` is written but not returned)."""
    staged = stage_messages(spark, d)
    docs = ev.raw_archive(stream_accepted(spark, staged))
    target = scratch_path(spark, "raw-archive")
    runner.run_available(docs, "append", runner.checkpoint_dir(spark, "archive"),
                         path=target, fmt="parquet")
    back = spark.read.parquet(target)
    return back.select(
        "case_number", "event_timestamp", "district", "primary_type",
        F.col("payload.block").alias("payload_block"),
        F.col("payload.arrest").alias("payload_arrest"),
        F.col("payload.district").alias("payload_district"),
        F.col("payload.latitude").try_cast("double").alias("payload_latitude"),
        F.col("payload.longitude").try_cast("double").alias("payload_longitude"))


@register("stream_dedup", ctes("SELECT case_number, district, event_ts FROM accepted", "accepted"))
def q_stream_dedup(spark, d):
    """Every message delivered twice; duplicates dropped by case number
    within a 1 hour watermark (state stays bounded; a copy that comes later
    than that is dropped as late), so the sink holds each event once."""
    staged = stage_messages(spark, d, copies=2)
    acc = runner.event_time(stream_accepted(spark, staged))
    out = (acc.withWatermark("event_time", "1 hour")
              .dropDuplicatesWithinWatermark(["case_number"])
              .select("case_number", "district", "event_ts"))
    sink = runner.AppendTable(scratch_path(spark, "dedup"))
    runner.run_available(out, "append", runner.checkpoint_dir(spark, "dedup"), sink)
    return sink.read(spark)


@register("stream_dedup_merge", ctes("SELECT case_number, district, event_ts FROM accepted",
                                     "accepted"))
def q_stream_dedup_merge(spark, d):
    """W10, skew-safe form: every message delivered twice; each micro-batch is
    deduplicated map-side and anti-joined against the keys already written."""
    staged = stage_messages(spark, d, copies=2)
    acc = stream_accepted(spark, staged).select("case_number", "district", "event_ts")
    sink = runner.DedupSink(scratch_path(spark, "dedup-merge"), ["case_number"])
    runner.run_available(acc, "append", runner.checkpoint_dir(spark, "dedup-merge"), sink)
    return sink.read(spark)


# -------------------------------------------------------------- sinks
@register("sink_table_overwrite", _RATE_ALL_SQL)
def q_sink_table_overwrite(spark, d):
    """K1 + K8: the rate table written twice with overwrite (a rerun), read back."""
    path = scratch_path(spark, "arrest-rates")
    rates = rollups.rate_all(joined(spark, d))
    for _ in range(2):
        tables.overwrite_table(rates, path, RESULT_SCHEMAS["arrest_rates"])
    return tables.read_table(spark, path)


_PAYLOAD_SQL = ("json_object('district', district, 'alert_timestamp', "
                "strftime(alert_timestamp, '%Y-%m-%dT%H:%M:%SZ'), 'event_count', event_count, "
                "'threshold', threshold_value, 'severity', severity)::VARCHAR")


@register("sink_table_append", ctes(
    f"SELECT *, {_PAYLOAD_SQL} AS payload FROM ({_ALERTS_SQL})"))
def q_sink_table_append(spark, d):
    """K2: alerts with a JSON payload appended as batch 0, then the same batch
    replayed; the table holds one copy."""
    path = scratch_path(spark, "alerts-append")
    out = windows.alert_payload(batch_alerts(spark, d))
    for _ in range(2):
        tables.append_batch(out, path, 0)
    return tables.read_table(spark, path)


ALERT_DOC_SCHEMA = "district STRING, alert_timestamp STRING, event_count BIGINT, " \
                   "threshold BIGINT, severity STRING, _id STRING"
_ALERT_DOCS_SQL = f"SELECT * RENAME (threshold_value AS threshold) FROM ({_ALERTS_SQL})"


def _alert_docs(spark, d):
    path = scratch_path(spark, "alert-docs")
    alerts = batch_alerts(spark, d).withColumnRenamed("threshold_value", "threshold")
    tables.append_documents(alerts, path, 0, ["district", "alert_timestamp"])
    docs = files.read_documents(spark, path, ALERT_DOC_SCHEMA).drop(tables.BATCH_COLUMN)
    return docs.withColumn("alert_timestamp", F.try_to_timestamp(F.col("alert_timestamp"))
                           .cast("timestamp_ntz"))


@register("sink_json_alerts", _ALERT_DOCS_SQL)
def q_sink_json_alerts(spark, d):
    """K3 + S8: alerts to a document collection, read back under a schema."""
    return _alert_docs(spark, d).drop("_id")


# ------------------------------------------------------------ serving
@register("serve_alert_docs", ctes(
    f"SELECT * FROM ({_ALERT_DOCS_SQL}) ORDER BY alert_timestamp DESC, district LIMIT 100"))
def q_serve_alert_docs(spark, d):
    """T5 + P18: newest 100 alert documents without ``_id``."""
    return serving.alert_documents(_alert_docs(spark, d))


def _store(spark, name, df, partition_by=None):
    """A stored result table, as the batch job leaves it; its folder."""
    path = scratch_path(spark, f"served-{name}")
    tables.overwrite_table(df, path, RESULT_SCHEMAS.get(name), partition_by, stamped=True)
    return path


def _stored_alerts(spark, d):
    alerts = tables.with_date(windows.alert_payload(batch_alerts(spark, d)), "alert_timestamp", "alert_date")
    return _store(spark, "alerts", alerts, ["alert_date"])


_ALERT_COLUMNS = ["district", "alert_timestamp", "event_count", "threshold_value", "severity"]


@register("serve_latest_alerts", ctes(
    f"SELECT * FROM ({_ALERTS_SQL}) ORDER BY alert_timestamp DESC, district LIMIT 100"))
def q_serve_latest_alerts(spark, d):
    """Newest 100 alerts, from the newest partitions of the stored table."""
    return serving.newest(spark, _stored_alerts(spark, d), "alert_timestamp", "alert_date", 100, ("district",)).select(*_ALERT_COLUMNS)


@register("serve_top_rates", ctes(
    "SELECT group_type, group_value, arrest_rate, crime_count FROM rate_all "
    "ORDER BY arrest_rate DESC, group_type, group_value LIMIT 20", "rate_all"))
def q_serve_top_rates(spark, d):
    """Top 20 arrest rates of the stored table."""
    rates = spark.read.parquet(_store(spark, "arrest_rates", rollups.rate_all(joined(spark, d))))
    return serving.top_by(rates, "arrest_rate", 20, ("group_type", "group_value")).select(
        "group_type", "group_value", "arrest_rate", "crime_count")


def _stored_trends(spark, d):
    return spark.read.parquet(_store(spark, "crime_trends", rollups.trend_all(crimes(spark, d)), ["trend_type"]))


@register("serve_trends", ctes(
    "SELECT trend_type, period_value, crime_count FROM trend_all "
    "WHERE trend_type IN ('year', 'month', 'hour') ORDER BY trend_type, period_value", "trend_all"))
def q_serve_trends(spark, d):
    """T3 + P11: year/month/hour trends in text order; the stored table's
    partitions of the other types are not read."""
    return serving.trend_lines(_stored_trends(spark, d))


@register("serve_trend_tab", ctes(
    "SELECT period_value, crime_count FROM trend_all WHERE trend_type = 'hour'", "trend_all"))
def q_serve_trend_tab(spark, d):
    """P10: one trend tab (hour) of the stored table."""
    return serving.trend_tab(_stored_trends(spark, d), "hour")


@register("serve_hotspots")
def q_serve_hotspots(spark, d):
    """T4 + P19: stored hotspot centres for the map view."""
    from ..operators.hotspots import kmeans_hotspots
    return serving.hotspot_map(spark.read.parquet(_store(spark, "hotspots", kmeans_hotspots(crimes(spark, d)))))


@register("serve_sql", ctes(
    "SELECT group_type, group_value, arrest_rate, crime_count FROM rate_all WHERE crime_count > 10 "
    "ORDER BY arrest_rate DESC, group_type, group_value LIMIT 20", "rate_all"))
def q_serve_sql(spark, d):
    """SQL text over a stored result table."""
    path = _store(spark, "arrest_rates", rollups.rate_all(joined(spark, d)))
    return serving.sql_over_tables(spark, "SELECT group_type, group_value, arrest_rate, crime_count FROM arrest_rates "
                                   "WHERE crime_count > 10 ORDER BY arrest_rate DESC, group_type, group_value LIMIT 20", {"arrest_rates": path})


@register("load_stamp", ctes("SELECT trend_type, period_value, crime_count, true AS stamped FROM trend_all", "trend_all"))
def q_load_stamp(spark, d):
    """K7: stored rows carry the load time, one for the whole table."""
    trends = _stored_trends(spark, d)
    return trends.select("trend_type", "period_value", "crime_count",
                         (F.col("generated_at") == trends.agg(F.min("generated_at")).scalar()).alias("stamped"))


# ---------------------------------------------------------- whole job
_VALUES = ("SELECT '{0}' AS table_name, count(*) AS row_count, CAST(round(sum({1}), 6) AS DOUBLE) AS total FROM {2}")


@register("batch_job", ctes(" UNION ALL ".join([
    _VALUES.format("crime_trends", "crime_count", "trend_all"), _VALUES.format("arrest_rates", "crime_count + arrest_rate", "rate_all"),
    _VALUES.format("violence_stats", "incident_count + coalesce(rate, 0)", f"({_METRICS_SQL})"),
    _VALUES.format("offender_density", "offender_count + 1000 * priority_minor_victim_count", "density"),
    f"SELECT 'hotspots', {KMEANS_K}, CAST(count(*) AS DOUBLE) FROM crimes WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    _VALUES.format("correlations", "x_value + 1000 * y_value", f"({_PAIRS_SQL})")]),
    "crimes", "trend_all", "rate_all", "violence", "density", "joined"))
def q_batch_job(spark, d):
    """The whole batch job (six tables, inputs staged once); rows and a sum over
    the values of each stored table. Offender buckets use the portable hash here
    so the SQL check can follow."""
    from functools import reduce

    from .batch import run
    paths = run(spark, d, hash_method="md5")
    totals = {"crime_trends": F.col("crime_count"), "arrest_rates": F.col("crime_count") + F.col("arrest_rate"),
              "violence_stats": F.col("incident_count") + F.coalesce("rate", F.lit(0)),
              "offender_density": F.col("offender_count") + 1000 * F.col("priority_minor_victim_count"),
              "hotspots": F.col("crime_count"), "correlations": F.col("x_value") + 1000 * F.col("y_value")}
    parts = [spark.read.parquet(paths[t]).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                                              F.round(F.sum(x.cast("double")), 6).alias("total")) for t, x in totals.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)

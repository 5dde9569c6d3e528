"""Registered queries over the shipped stream: one run of ``streaming.topology``
each, over the event messages in three batches.

By arrival, the messages come in the order of their ids and a message's arrival
is its broker's append time, here ``ARRIVAL_STEP_S`` seconds an id; by event time,
the three batches are unordered (ids modulo 3), so two of them bring late events.
Each batch is a run of its own on the same output, which goes on from the
checkpoint of the one before.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import RESULT_SCHEMAS
from ..session import scratch_path
from ..sinks.merge import DedupTable
from ..sources.files import existing, publish
from ..streaming import runner, topology
from .catalog import _alerts_sql, _window_sql, register
from .io_queries import messages, stream_accepted
from .sql import ctes, register_cte

BATCHES = 3
ARRIVAL_STEP_S, SIZE_S, SLIDE_S, THRESHOLD = 30, 300, 60, 2
EPOCH_S = 1_704_067_200
# A batch lies in few partitions of the table and a file's row group is parsed by one
# task: files this small give the parse and the archive a task per core at any size.
MESSAGES_PER_FILE = 50_000
LATE_SIZE_S, LATE_SLIDE_S, DELAY_S = 86_400, 21_600, 10 * 86_400

register_cte("arrived", f"SELECT *, make_timestamp(({EPOCH_S} + event_id * {ARRIVAL_STEP_S}) * 1000000) AS arrived_at FROM accepted",
             ["accepted"])
# Per batch, the watermark before it: the newest accepted event of earlier batches, less the delay.
register_cte("timed", f"SELECT *, event_id % {BATCHES} AS batch, CAST(floor(epoch(event_ts)) AS BIGINT) AS at_s FROM accepted", ["accepted"])
register_cte("marked", f"""
SELECT t.*, (SELECT max(p.at_s) - {DELAY_S} FROM timed p WHERE p.batch < t.batch) AS mark FROM timed t""", ["timed"])
_LATE = f"coalesce(at_s // {LATE_SLIDE_S} * {LATE_SLIDE_S} + {LATE_SIZE_S} <= mark, at_s IS NULL)"


def _run(spark, d, by_arrival=True, threshold=THRESHOLD, close=True):
    """The stream over all messages, one run a batch; its sink."""
    source, staged, out = (scratch_path(spark, name) for name in ("topology-messages", "topology-staged", "topology"))
    msgs = messages(spark, d)
    if by_arrival:
        last = msgs.agg(F.max("event_id")).scalar()
        batch, arrival = F.floor(F.col("event_id") * BATCHES / (last + 1)), F.timestamp_seconds(F.lit(EPOCH_S) + F.col("event_id") * ARRIVAL_STEP_S)
    else:
        batch, arrival = F.col("event_id") % BATCHES, None
    size, slide, delay = (SIZE_S, SLIDE_S, 0) if by_arrival else (LATE_SIZE_S, LATE_SLIDE_S, DELAY_S)
    # One pass writes the messages of all batches: a batch's own lie in few of the scan's tasks.
    msgs.withColumn("part", batch).write.option("maxRecordsPerFile", MESSAGES_PER_FILE).partitionBy("part").parquet(staged)
    for i in range(BATCHES):
        if existing(spark, [f"{staged}/part={i}"]):
            publish(spark, f"{staged}/part={i}", f"{source}/part={i}")
        else:  # a batch without messages
            msgs.limit(0).write.parquet(f"{source}/part={i}")
        stream = runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=1_000_000)  # all new files are one batch
        query, sink = topology.run_once(stream, out, size, slide, threshold, by_arrival=by_arrival, delay_s=delay, arrival=arrival)
    if close:
        sink.close(spark, query)
    return sink


def _windows(spark, sink, size):
    """Stored alerts of threshold 0 as final window counts."""
    end = F.col("alert_timestamp")
    return sink.alerts.table.read(spark).select(
        "district", (end - F.make_dt_interval(secs=F.lit(size))).alias("window_start"), end.alias("window_end"), "event_count")


_ARRIVAL_SQL = _window_sql("arrived", "district", "arrived_at", SIZE_S, SLIDE_S)


@register("stream_topology_alerts", ctes(_alerts_sql(_ARRIVAL_SQL, "district", THRESHOLD), "arrived"))
def q_stream_topology_alerts(spark, d):
    """W2 + W6 + W7 + K2 + K6: alerts of final windows by arrival, one row each."""
    return _run(spark, d).alerts.table.read(spark).select(*[f for f in RESULT_SCHEMAS["alerts"].fieldNames() if f != "payload"])


@register("stream_topology_documents", ctes(
    "SELECT district, strftime(alert_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS alert_timestamp, event_count, "
    f"threshold_value AS threshold, severity FROM ({_alerts_sql(_ARRIVAL_SQL, 'district', THRESHOLD)})", "arrived"))
def q_stream_topology_documents(spark, d):
    """K3 + K6: the same alerts as documents."""
    return _run(spark, d).alerts.docs.read(spark).select("district", "alert_timestamp", "event_count", "threshold", "severity")


@register("stream_topology_archive", ctes(
    "SELECT p.event_id, p.case_number, p.date AS event_timestamp, p.district, p.primary_type, d.block AS payload_block, "
    "d.district_raw AS payload_district, make_timestamp(("
    f"{EPOCH_S} + p.event_id * {ARRIVAL_STEP_S}) * 1000000) AS ingested_at "
    "FROM parsed p JOIN decoded d USING (event_id) WHERE p.reason IS NULL", "parsed", "decoded"))
def q_stream_topology_archive(spark, d):
    """W5 + K4 + F20: every accepted event with its payload, from the same parse."""
    sink = _run(spark, d, close=False)
    return sink.read(spark, "archive").select(
        "event_id", "case_number", "event_timestamp", "district", "primary_type", F.col("payload.block").alias("payload_block"),
        F.col("payload.district").alias("payload_district"), F.to_timestamp("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


@register("stream_topology_quarantine", ctes("SELECT event_id, reason FROM parsed WHERE reason IS NOT NULL", "parsed"))
def q_stream_topology_quarantine(spark, d):
    """W5 + P13: every rejected message with its reason (and raw text)."""
    return _run(spark, d, close=False).read(spark, "quarantine").where("raw_json is not null").select("event_id", "reason")


@register("stream_topology_late", ctes(f"SELECT event_id, case_number, district FROM marked WHERE {_LATE}", "marked"))
def q_stream_topology_late(spark, d):
    """Events behind the watermark of an unordered replay, kept whole."""
    return _run(spark, d, by_arrival=False, close=False).read(spark, "late").select("event_id", "case_number", "district")


@register("stream_topology_ledger", ctes(f"""
SELECT p.batch AS batch_id, messages, accepted, messages - accepted AS rejected, accepted - late AS counted, late,
       (SELECT max(at_s) - {DELAY_S} FROM timed t WHERE t.batch <= p.batch) AS watermark_s
FROM (SELECT event_id % {BATCHES} AS batch, count(*) AS messages FROM parsed GROUP BY 1) p
JOIN (SELECT batch, count(*) AS accepted, count(*) FILTER (WHERE {_LATE}) AS late FROM marked GROUP BY 1) m USING (batch)""", "parsed", "marked"))
def q_stream_topology_ledger(spark, d):
    """W8 + W9: figures of every batch; accepted = counted + late."""
    return _run(spark, d, by_arrival=False, close=False).read(spark, "ledger").select(
        "batch_id", "messages", "accepted", "rejected", "counted", "late", "watermark_s")


@register("stream_arrival_windows", ctes(_ARRIVAL_SQL, "arrived"))
def q_stream_arrival_windows(spark, d):
    """Windows by arrival (the reference's semantics): every window once, with its final count."""
    return _windows(spark, _run(spark, d, threshold=0), SIZE_S)


@register("stream_late_drop", ctes(f"""
SELECT district, make_timestamp(start_s * 1000000) AS window_start,
       make_timestamp((start_s + {LATE_SIZE_S}) * 1000000) AS window_end, count(*) AS event_count
FROM (SELECT district, mark, at_s // {LATE_SLIDE_S} * {LATE_SLIDE_S} - i * {LATE_SLIDE_S} AS start_s
      FROM marked, range(0, {LATE_SIZE_S // LATE_SLIDE_S}) r(i) WHERE at_s IS NOT NULL)
WHERE mark IS NULL OR start_s + {LATE_SIZE_S} > mark GROUP BY ALL""", "marked"))
def q_stream_late_drop(spark, d):
    """Final window counts by event time under a watermark; an event counts
    in the windows that are open when it comes."""
    return _windows(spark, _run(spark, d, by_arrival=False, threshold=0), LATE_SIZE_S)


@register("stream_dedup_unordered", ctes("SELECT case_number, district, event_ts FROM accepted", "accepted"))
def q_stream_dedup_unordered(spark, d):
    """Every message delivered twice, unordered over four batches (a copy
    may come long before or after the other); each event is stored once, and a
    batch opens only the days of its own events."""
    source, checkpoint = scratch_path(spark, "dedup-messages"), runner.checkpoint_dir(spark, "dedup-unordered")
    sink = DedupTable(scratch_path(spark, "dedup-days"), ["case_number"], "event_ts")
    msgs = messages(spark, d)
    copies = msgs.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    for i in range(4):
        copies.where((F.col("event_id") * 7 + F.col("copy") * (1 + F.col("event_id") % 3)) % 4 == i).drop("copy").write.parquet(f"{source}/part={i}")
        events = stream_accepted(spark, runner.Staged(source, 4_000_000)).select("case_number", "district", "event_ts")
        runner.run_available(events, "append", checkpoint, sink)
    return sink.read(spark)

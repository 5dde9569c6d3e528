"""The shipped stream: one parse, routed to the archive, the quarantine and the
window counts, whose final windows become alerts (W1-W10, K2-K4, K6, P13).

One streaming query parses each micro-batch once, in its own plan; ``Topology``
is its foreachBatch sink. Per batch it writes

* ``archive``: accepted events with their nested payload (all of them, late ones too),
* ``quarantine``: rejected messages with reason and raw text,
* ``late``: accepted events all of whose windows have ended before the batch,
* ``state``: counts per (district, pane) of the windows still open,
* ``alerts`` and ``alert_logs``: one row and one document per alert, merged by
  (district, alert time),
* ``ledger``: the batch's figures and its watermark, written last.

The watermark after a batch is the largest window time seen, less ``delay_s``.
A window is final, and is sent, when the watermark reaches its end; until then it
is kept as counts of panes (tumbling, as wide as the greatest common divisor of
size and slide), one row per district and pane, so state does not grow with
history. Everything a batch writes is a function of the batch and of the state
before it and lies under its batch id, so a batch that is replayed after a
failure at any point writes the same again. For every batch: messages = accepted
+ rejected, accepted = archived = counted + late.

Window time is the arrival, as in the reference: the source's own arrival stamp
if it has one (a broker's append time), else the batch's time, which a replay
repeats. Nothing is late then, and ``delay_s`` is 0. By event time, events may
come up to ``delay_s`` behind the newest one, and later ones are kept in ``late``
(an event that is too late for some of its windows only still counts in the
others); an accepted event without a readable time is late as well.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import windows
from ..schemas import EVENT_MESSAGE_SCHEMA, RESULT_SCHEMAS, text_schema
from ..sinks.merge import Ledger, MergeSink, MergeTable, at_once, query_id
from ..sinks.tables import document_frame, with_date
from . import events as ev

STATE = "district string, pane_s long, n long"
ALERT_DATE = "alert_date"
ALERT_KEY = ["district", "alert_timestamp"]
# Fields of an archive document (``ev.raw_archive``) below a file stream; stated, a read makes one pass.
ARCHIVE_DOCUMENT = T.StructType([
    T.StructField("event_id", T.LongType()), *text_schema(["key", "case_number", "event_timestamp", "district", "primary_type"]).fields,
    T.StructField("payload", EVENT_MESSAGE_SCHEMA), T.StructField("ingested_at", T.StringType())])
# Fields of an alert document as the document store holds them.
ALERT_DOCUMENT = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("district", T.StringType()),
    T.StructField("alert_timestamp", T.StringType()), T.StructField("event_count", T.LongType()),
    T.StructField("threshold", T.LongType()), T.StructField("severity", T.StringType())])


def parsed_stream(messages: DataFrame, by_arrival: bool = True, arrival: Column | None = None) -> DataFrame:
    """The messages, parsed once, with ``arrived_at`` and the window time in epoch
    seconds (``window_s``). ``arrival``: the source's arrival stamp."""
    stamp = F.current_timestamp() if arrival is None else arrival
    parsed = ev.parse_messages(messages.withColumn("arrived_at", stamp.cast("timestamp")))
    time = F.col("arrived_at") if by_arrival else F.col("event_ts").cast("timestamp")
    return parsed.withColumn("window_s", F.unix_seconds(time))


def alert_document(alerts: DataFrame) -> DataFrame:
    """K3: alerts as documents: ISO time text, ``threshold``, an ``_id`` from the key."""
    return document_frame(alerts.select("district", "alert_timestamp", "event_count",
                                        F.col("threshold_value").alias("threshold"), "severity"), ALERT_KEY)


def alert_sink(out: str, ledger: str | None = None, versions: str | None = None) -> MergeSink:
    """The alert table (with the JSON payload) and the alert documents below ``out``."""
    return MergeSink(
        MergeTable(f"{out}/alerts", ALERT_KEY, RESULT_SCHEMAS["alerts"], ALERT_DATE),
        MergeTable(f"{out}/alert_logs", ["_id"], ALERT_DOCUMENT, ALERT_DATE, "json"),
        lambda a: with_date(windows.alert_payload(a), "alert_timestamp", ALERT_DATE),
        lambda a: alert_document(a).withColumn(ALERT_DATE, F.to_date(F.substring("alert_timestamp", 1, 10))),
        ledger, versions)


class Topology:
    """foreachBatch sink of ``parsed_stream``; see the module's text."""

    def __init__(self, out: str, size_s: int, slide_s: int, threshold: int, delay_s: int = 0):
        self.out, self.size, self.slide, self.threshold, self.delay = out, size_s, slide_s, threshold, delay_s
        self.pane = math.gcd(size_s, slide_s)
        self.ledger = Ledger(f"{out}/ledger")
        self.alerts = alert_sink(out)
        self.query: str | None = None

    # ---------------------------------------------------------------- windows
    def _open(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Counts of panes after the batch before ``batch_id``."""
        if batch_id < 1:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(f"{self.out}/state/query={self.query}/batch={batch_id - 1}")

    def _ended(self, panes: DataFrame, after: int | None, until: int | None) -> DataFrame:
        """Final counts of the windows that end in (after, until]."""
        slide = F.lit(self.slide).cast("long")
        last = F.floor(F.col("pane_s") / self.slide) * slide
        first = F.floor((F.col("pane_s") - self.size) / self.slide) * slide + slide
        # a pane in a gap between windows (slide > size) has none
        covers = F.when(first <= last, F.sequence(first, last, slide))
        starts = panes.select("district", "n", F.explode(covers).alias("start_s"))
        if after is not None:
            starts = starts.where(F.col("start_s") > after - self.size)
        if until is not None:
            starts = starts.where(F.col("start_s") <= until - self.size)
        at = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
        return starts.groupBy("district", "start_s").agg(F.sum("n").alias("event_count")) \
            .select("district", at("start_s").alias("window_start"), at(F.col("start_s") + self.size).alias("window_end"), "event_count")

    def _late(self, watermark: int | None) -> Column:
        """No window of the event is open any more (or it has no time)."""
        if watermark is None:
            return F.col("window_s").isNull()
        end = F.floor(F.col("window_s") / self.slide) * self.slide + self.size
        return F.coalesce(end <= watermark, F.lit(True))

    # ---------------------------------------------------------------- batches
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self.query = query_id(spark)
        before = self.ledger.figures(spark, self.query, batch_id - 1).get("watermark_s") if batch_id else None

        def put(df: DataFrame, what: str, fmt: str = "parquet") -> None:
            df.write.mode("overwrite").format(fmt).save(f"{self.out}/{what}/query={self.query}/batch={batch_id}")
        ok, late = F.col("reason").isNull(), self._late(before)
        kept = [c for c in ("event_id", "key") if c in batch.columns]
        # only what a write below needs is held
        batch = batch.select(*kept, "arrived_at", "case_number", "date", "district", "primary_type", "event_ts", "window_s",
                             "raw_json", "reason", (ok & late).alias("is_late")).persist()
        try:
            seen = batch.agg(F.count(F.lit(1)).alias("messages"), F.count_if(ok).alias("accepted"),
                             F.count_if(F.col("is_late")).alias("late"), F.max(F.when(ok, F.col("window_s"))).alias("newest")).first()
            newest = None if seen.newest is None else seen.newest - self.delay
            mark = max((x for x in (before, newest) if x is not None), default=None)
            accepted, rejected = ev.split_parsed(batch)
            writes = [lambda: put(ev.raw_archive(accepted, "arrived_at", kept), "archive", "json")]
            if seen.accepted < seen.messages:
                writes.append(lambda: put(batch.where(~ok).select(*kept, "arrived_at", "reason", "raw_json"), "quarantine"))
            if seen.late:
                writes.append(lambda: put(accepted.where("is_late").select(
                    *kept, "arrived_at", "case_number", "district", "event_ts", "raw_json"), "late"))
            panes = accepted.where("not is_late").groupBy("district", (F.floor(F.col("window_s") / self.pane) * self.pane).alias("pane_s")) \
                .agg(F.count(F.lit(1)).alias("n"))
            held = self._open(spark, batch_id).unionByName(panes).groupBy("district", "pane_s").agg(F.sum("n").alias("n")).persist()
            still = held if mark is None else held.where(F.col("pane_s") + self.size > mark)
            writes.append(lambda: put(still, "state"))
            writes.append(lambda: self.alerts.merge(windows.to_alerts(self._ended(held, before, mark), self.threshold)))
            try:
                at_once(*writes)
            finally:
                held.unpersist()
        finally:
            batch.unpersist()
        self.ledger.commit(spark, self.query, batch_id, messages=seen.messages, accepted=seen.accepted,
                           rejected=seen.messages - seen.accepted, counted=seen.accepted - seen.late, late=seen.late, watermark_s=mark)

    # ------------------------------------------------------------------ reads
    def close(self, spark: SparkSession, query: str, until: int | None = None) -> None:
        """Send the windows that end up to ``until`` (epoch seconds; all open ones
        if None) from the state after the last batch: a clock's tick when no
        messages come, or the end of a replay. State stays as it is; if more
        messages come for such a window, its alert is replaced."""
        self.query = query
        last = self.ledger.last(spark, query)
        if last >= 0:
            before = self.ledger.figures(spark, query, last).get("watermark_s")
            self.alerts.merge(windows.to_alerts(self._ended(self._open(spark, last + 1), before, until), self.threshold))

    def read(self, spark: SparkSession, what: str) -> DataFrame:
        """``archive``, ``quarantine``, ``late`` or ``ledger`` of all queries. The
        middle two are there as soon as a row is."""
        path = f"{self.out}/{what}"
        reader = spark.read.schema(ARCHIVE_DOCUMENT) if what == "archive" else spark.read
        return reader.format("json" if what in ("archive", "ledger") else "parquet").load(path).drop("query", "batch")


def start(messages: DataFrame, out: str, size_s: int, slide_s: int, threshold: int, by_arrival: bool = True,
          delay_s: int = 0, arrival: Column | None = None, checkpoint: str | None = None,
          once: bool = False) -> tuple[StreamingQuery, Topology]:
    """Start the stream below ``out``; the checkpoint belongs to the output."""
    from .runner import ensure_state_store
    ensure_state_store(messages.sparkSession)
    sink = Topology(out, size_s, slide_s, threshold, delay_s)
    w = parsed_stream(messages, by_arrival, arrival).writeStream.outputMode("append") \
        .option("checkpointLocation", checkpoint or f"{out}/_checkpoint").foreachBatch(sink)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=f"{int(slide_s)} seconds")
    return w.start(), sink


def run_once(messages: DataFrame, out: str, size_s: int, slide_s: int, threshold: int, **kw) -> tuple[str, Topology]:
    """Everything that is there now; (query id, sink)."""
    q, sink = start(messages, out, size_s, slide_s, threshold, once=True, **kw)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return str(q.id), sink

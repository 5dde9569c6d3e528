"""The shipped stream: one parse, archive, quarantine, late events and final
windows; merging sinks."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.operators import windows
from blotter.schemas import RESULT_SCHEMAS
from blotter.session import scratch_path
from blotter.sinks.merge import Ledger, MergeTable
from blotter.sinks.tables import with_date
from blotter.streaming import runner, topology

T0 = 1_704_067_200
SIZE, SLIDE = 300, 60


def message(i, district, at=T0, **other):
    import datetime as dt
    date = dt.datetime.fromtimestamp(at, dt.timezone.utc).strftime("%m/%d/%Y %I:%M:%S %p")
    body = {"case_number": f"c{i}", "date": date, "block": "b", "primary_type": "p", "district": district, "arrest": "true",
            "latitude": "1.5", "longitude": "2.5"}
    return i, district, json.dumps(body | other)


def expected(events, size, slide, threshold):
    """Alerts of (district, second) events, every window spelled out."""
    n = Counter((d, s + size) for d, at in events for s in range((at // slide - size // slide - 1) * slide, at + 1, slide) if s <= at < s + size)
    return sorted((d, e, c, threshold, "HIGH" if c >= 2 * threshold else "MEDIUM") for (d, e), c in n.items() if c > threshold)


def stored(spark, sink):
    rows = sink.alerts.table.read(spark)
    got = sorted((r.district, r.e, r.event_count, r.threshold_value, r.severity)
                 for r in rows.withColumn("e", F.unix_seconds(F.col("alert_timestamp").cast("timestamp"))).collect())
    assert rows.where("payload is null").count() == 0
    docs = sink.alerts.docs.read(spark)
    assert sorted((r.district, r.event_count, r.threshold, r.severity) for r in docs.collect()) == sorted((d, n, t, s) for d, _, n, t, s in got)
    return got


def feed(spark, out, batches, **kw):
    """One run a batch, each going on from the checkpoint of the last."""
    source = scratch_path(spark, "t-topo-src")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, runner.MESSAGE_SCHEMA).repartition(2).write.parquet(f"{source}/part={i}")
        query, sink = topology.run_once(runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=1000), out, SIZE, SLIDE, 1, **kw)
    return query, sink


def figures(spark, sink):
    return {r.batch_id: r.asDict() for r in sink.read(spark, "ledger").collect()}


def test_windows_by_arrival_cross_batches(spark):
    """Each alert once, with its final count; nothing is sent before its window
    has ended, and everything after the close."""
    rnd = random.Random(1)
    arrivals = sorted(rnd.randrange(1500) for _ in range(120))
    rows = [message(T0 + a + 10_000 * i, rnd.choice(["1", "2", "77"]), T0 + rnd.randrange(10 ** 7)) for i, a in enumerate(arrivals)]
    at = F.timestamp_seconds(F.pmod(F.col("event_id") - T0, F.lit(10_000)) + T0)
    bad = [message(5 * 10 ** 10, "1", block=" "), (6 * 10 ** 10, "1", "{broken"), (7 * 10 ** 10, None, None)]
    out = scratch_path(spark, "t-topo")
    query, sink = feed(spark, out, [rows[:40], rows[40:80], rows[80:] + bad], arrival=at)
    events = [(f"{int(k):03d}", T0 + a) for (_, k, _), a in zip(rows, arrivals)]
    whole = expected(events, SIZE, SLIDE, 1)
    ended = [w for w in whole if w[1] <= T0 + arrivals[-1]]
    # rejected messages arrive, too, but only accepted events move the watermark
    assert stored(spark, sink) == ended and len(ended) < len(whole)
    sink.close(spark, query, T0 + arrivals[-1] + 120)
    assert stored(spark, sink) == [w for w in whole if w[1] <= T0 + arrivals[-1] + 120]
    sink.close(spark, query)
    sink.close(spark, query)
    assert stored(spark, sink) == whole
    f = figures(spark, sink)
    assert [f[i]["late"] for i in range(3)] == [0, 0, 0] and [f[i]["rejected"] for i in range(3)] == [0, 0, 3]
    assert sink.read(spark, "archive").count() == sum(x["accepted"] for x in f.values()) == len(rows)
    assert sorted(r.reason for r in sink.read(spark, "quarantine").collect()) == ["malformed", "malformed", "missing:block"]
    assert sum(n for _, _, n, _, _ in expected(events, SIZE, SLIDE, 0)) == len(rows) * SIZE // SLIDE


def test_more_messages_after_a_close_replace_the_alert(spark):
    at = F.timestamp_seconds("event_id")
    out = scratch_path(spark, "t-topo-close")
    first = [message(T0 + i, "1") for i in range(3)]
    query, sink = feed(spark, out, [first], arrival=at)
    sink.close(spark, query)
    assert max(n for _, _, n, _, _ in stored(spark, sink)) == 3
    source = scratch_path(spark, "t-topo-more")
    spark.createDataFrame(first, runner.MESSAGE_SCHEMA).limit(0).write.parquet(source)
    more = [message(T0 + 5 + i, "1") for i in range(4)]
    parsed = topology.parsed_stream(spark.createDataFrame(more, runner.MESSAGE_SCHEMA), arrival=at)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
    try:
        for _ in range(2):  # the second time is a replay of the whole batch
            sink(parsed, 1)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    sink.close(spark, query)
    whole = expected([("001", T0 + i) for i in range(3)] + [("001", T0 + 5 + i) for i in range(4)], SIZE, SLIDE, 1)
    assert stored(spark, sink) == whole
    assert sink.read(spark, "archive").count() == 7


@pytest.mark.parametrize("step", ["archive", "state", "alerts", "ledger"])
def test_failure_at_any_point_of_a_batch(spark, monkeypatch, step):
    """A batch that dies halfway is replayed by the restarted query: one row per
    alert, every event archived and counted once."""
    at = F.timestamp_seconds("event_id")
    rows = [message(T0 + 7 * i, "1") for i in range(90)]
    out = scratch_path(spark, "t-topo-crash")
    source = scratch_path(spark, "t-topo-crash-src")

    def go():
        return topology.run_once(runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=1000), out, SIZE, SLIDE, 1, arrival=at)
    spark.createDataFrame(rows[:45], runner.MESSAGE_SCHEMA).write.parquet(f"{source}/part=0")
    go()
    spark.createDataFrame(rows[45:], runner.MESSAGE_SCHEMA).write.parquet(f"{source}/part=1")

    def fail(*a, **k):
        raise RuntimeError("lost driver")
    with monkeypatch.context() as m:
        if step == "archive":
            m.setattr(topology.ev, "raw_archive", fail)
        elif step == "state":
            m.setattr(topology.MergeSink, "merge", fail)
        elif step == "alerts":
            m.setattr(topology.MergeTable, "merge", fail)
        else:
            m.setattr(Ledger, "commit", fail)
        with pytest.raises(Exception):
            go()
    query, sink = go()
    sink.close(spark, query)
    assert stored(spark, sink) == expected([("001", T0 + 7 * i) for i in range(90)], SIZE, SLIDE, 1)
    assert sink.read(spark, "archive").count() == 90 and {r["counted"] for r in figures(spark, sink).values()} == {45}


def test_late_events_are_kept_and_counted(spark):
    """Event time, three batches in fixed order: an event all of whose windows
    have ended is late; one with some open windows counts in those."""
    batches = [[message(1, "1", T0 + 1000), message(2, "1", T0 + 10)],
               [message(3, "1", T0 + 670), message(4, "1", T0 + 550), message(5, "2", T0), message(6, "1", date="no time")],
               [message(7, "1", T0 + 2000), message(8, "1", T0 + 400)]]
    out = scratch_path(spark, "t-topo-late")
    query, sink = feed(spark, out, batches, by_arrival=False, delay_s=100)
    sink.close(spark, query)
    f = figures(spark, sink)
    assert [(f[i]["accepted"], f[i]["counted"], f[i]["late"], f[i]["watermark_s"] - T0) for i in range(3)] == \
        [(2, 2, 0, 900), (4, 1, 3, 900), (2, 1, 1, 1900)]
    assert sorted(r.event_id for r in sink.read(spark, "late").collect()) == [4, 5, 6, 8]
    assert sink.read(spark, "archive").count() == 8
    # event 3 counts in its last window only, [T0 + 660, T0 + 960), which no other event is in
    assert stored(spark, sink) == []
    held = sink._open(spark, 3)
    assert held.count() == 1  # the state keeps open windows only


def test_no_messages_and_gcd_panes(spark):
    out = scratch_path(spark, "t-topo-gcd")
    source = scratch_path(spark, "t-topo-gcd-src")
    rows = [message(T0 + 3 * i, "5") for i in range(40)]
    spark.createDataFrame(rows, runner.MESSAGE_SCHEMA).write.parquet(f"{source}/part=0")
    query, sink = topology.run_once(runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=9), out, 50, 20, 1,
                                    arrival=F.timestamp_seconds("event_id"))
    query, sink = topology.run_once(runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=9), out, 50, 20, 1,
                                    arrival=F.timestamp_seconds("event_id"))
    sink.close(spark, query)
    assert stored(spark, sink) == expected([("005", T0 + 3 * i) for i in range(40)], 50, 20, 1)


# ------------------------------------------------------------------ merging
def alerts(spark, rows):
    df = spark.createDataFrame([(d, T0 + e, n) for d, e, n in rows], "district string, e long, event_count long")
    return windows.to_alerts(df.withColumn("window_end", F.timestamp_seconds("e").cast("timestamp_ntz")), 0)


def test_merge_replaces_rows_and_reads_touched_dates_only(spark):
    table = MergeTable(scratch_path(spark, "t-merge"), ["district", "alert_timestamp"],
                       RESULT_SCHEMAS["alerts"], topology.ALERT_DATE)

    def shape(df):
        return with_date(windows.alert_payload(df), "alert_timestamp", topology.ALERT_DATE)
    day = 86_400
    table.merge(shape(alerts(spark, [("1", 0, 5), ("2", 0, 6), ("1", 3 * day, 7)])))
    untouched = {f for f in spark.read.parquet(table.path).inputFiles() if "2024-01-04" in f}
    for _ in range(2):
        table.merge(shape(alerts(spark, [("1", 0, 50), ("3", day, 8)])))
    got = sorted((r.district, r.event_count) for r in table.read(spark).collect())
    assert got == [("1", 7), ("1", 50), ("2", 6), ("3", 8)]
    assert untouched <= set(spark.read.parquet(table.path).inputFiles())
    new = shape(alerts(spark, [("1", 0, 1)]))
    days = F.broadcast(new.select(topology.ALERT_DATE).distinct())
    text = table.read(spark).join(days, topology.ALERT_DATE, "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower()


def test_merge_lists_the_days_of_its_rows_only(spark):
    """Days that a batch does not touch are neither listed nor read, however many there are."""
    table = MergeTable(scratch_path(spark, "t-merge-days"), ["district", "alert_timestamp"],
                       RESULT_SCHEMAS["alerts"], topology.ALERT_DATE)

    def shape(rows):
        return with_date(windows.alert_payload(alerts(spark, rows)), "alert_timestamp", topology.ALERT_DATE)
    day = 86_400
    table.merge(shape([("1", i * day, 5) for i in range(5)]))
    # listing the whole table would stop at a folder that is no date
    spark.range(1).write.parquet(f"{table.path}/{topology.ALERT_DATE}=aside")
    new = shape([("1", 4 * day, 50), ("2", 4 * day, 7), ("1", 9 * day, 8)])
    assert table._stored(new) == ["2024-01-05"]
    table.merge(new)
    table.merge(new)
    days = [f"{table.path}/{topology.ALERT_DATE}=2024-01-{d:02}" for d in (1, 2, 3, 4, 5, 10)]
    got = spark.read.option("basePath", table.path).parquet(*days).collect()
    assert sorted((str(r.alert_date)[-2:], r.district, r.event_count) for r in got) == [
        ("01", "1", 5), ("02", "1", 5), ("03", "1", 5), ("04", "1", 5), ("05", "1", 50), ("05", "2", 7), ("10", "1", 8)]


def test_a_batch_from_one_partition_is_parsed_by_many_tasks(spark, monkeypatch, tmp_path):
    """The messages of a table that lies in one row group come as many files."""
    import datetime as dt

    from blotter.plans import topology_queries as tq
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(i, at + dt.timedelta(seconds=i), i % 7, "click", 10.0, '{"k": 1}') for i in range(900)],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(tq, "MESSAGES_PER_FILE", 50)
    folders = []
    inner = tq.scratch_path
    monkeypatch.setattr(tq, "scratch_path", lambda s, name: folders.append(inner(s, name)) or folders[-1])
    sink = tq._run(spark, str(tmp_path), close=False)
    for i in range(tq.BATCHES):
        assert len(set(spark.read.parquet(f"{folders[0]}/part={i}").inputFiles())) == 6
    ledger = sink.read(spark, "ledger").collect()
    assert [r.messages for r in sorted(ledger, key=lambda r: r.batch_id)] == [300] * 3
    assert sink.read(spark, "archive").count() == 900


def test_the_messages_are_made_once_for_all_batches(spark, monkeypatch):
    """One pass writes the messages of every batch; a batch without a message
    still runs, under its own number."""
    from blotter.plans import topology_queries as tq
    made = spark.sparkContext.accumulator(0)

    def count(row):
        made.add(1)
        return row
    rows = [message(i, "1", T0 + i) for i in range(0, 90, 3)]
    monkeypatch.setattr(tq, "messages", lambda s, d: s.createDataFrame(s.sparkContext.parallelize(rows, 2).map(count), runner.MESSAGE_SCHEMA))
    sink = tq._run(spark, "", by_arrival=False, close=False)
    assert made.value == len(rows)
    f = figures(spark, sink)
    assert [f[i]["messages"] for i in range(3)] == [30, 0, 0]
    assert sink.read(spark, "archive").count() == 30


def test_the_parse_is_small_enough_to_be_compiled(spark, capsys):
    """The JVM leaves methods of more than 8,000 bytes to the interpreter."""
    import re
    path = scratch_path(spark, "t-topo-code")
    spark.createDataFrame([message(1, "1")], runner.MESSAGE_SCHEMA).write.parquet(path)
    for by_arrival in (True, False):
        topology.parsed_stream(spark.read.schema(runner.MESSAGE_SCHEMA).parquet(path), by_arrival).explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000


def test_the_archive_is_read_under_its_own_schema(spark):
    """A read infers nothing from the documents, so it is one pass."""
    out = scratch_path(spark, "t-topo-archive")
    _, sink = feed(spark, out, [[message(1, "1", block="x"), message(2, "D2", produced_at="now")]], arrival=F.timestamp_seconds("event_id"))
    docs = sink.read(spark, "archive")
    assert docs.schema == topology.ARCHIVE_DOCUMENT
    assert sorted((r.event_id, r.key, r.district, r.payload.block, r.payload.district, r.payload.produced_at, r.ingested_at) for r in docs.collect()) == [
        (1, "1", "001", "x", "1", None, "1970-01-01T00:00:01.000Z"), (2, "D2", "002", "b", "D2", "now", "1970-01-01T00:00:02.000Z")]


@pytest.mark.parametrize("size, slide", [(50, 20), (60, 60), (30, 50), (300, 60)])
def test_ended_windows_of_any_size_and_slide(spark, size, slide):
    sink = topology.Topology("unused", size, slide, 0)
    seconds = [-130, -7, 0, 3, 19, 20, 49, 50, 61, 149, 150, 333]
    panes = spark.createDataFrame([("1", s // sink.pane * sink.pane, 1) for s in seconds], topology.STATE)
    whole = {(s, s + size): sum(s <= at < s + size for at in seconds) for s in range(-20 * slide, 20 * slide, slide)}
    for after, until in ((None, None), (10, None), (None, 200), (10, 200)):
        got = {(r.s, r.e): r.event_count for r in sink._ended(panes, after, until).select(
            *[F.unix_seconds(F.col(f"window_{x}").cast("timestamp")).alias(x[0]) for x in ("start", "end")], "event_count").collect()}
        assert got == {w: n for w, n in whole.items() if n and (after is None or w[1] > after) and (until is None or w[1] <= until)}


def test_update_mode_leaves_the_newest_version(spark):
    """A native update-mode query sends a window several times; the merging sink
    keeps one row and one document; a batch of an older number is skipped."""
    source, out = scratch_path(spark, "t-upd-src"), scratch_path(spark, "t-upd")
    rows = [message(i, "1", T0 + i) for i in range(30)]
    for i in range(3):
        spark.createDataFrame(rows[i::3], runner.MESSAGE_SCHEMA).coalesce(1).write.parquet(f"{source}/part={i}")
    from blotter.streaming.alerting import alert_stream
    sink = topology.alert_sink(out, ledger=f"{out}/ledger", versions="event_count")
    stream = alert_stream(runner.file_stream(spark, source, runner.MESSAGE_SCHEMA, max_files=1), 3600, 3600, 0,
                          watermark=None, by_arrival=False)
    runner.run_available(stream, "update", f"{out}/_checkpoint", sink)
    assert [(r.district, r.event_count) for r in sink.table.read(spark).collect()] == [("001", 30)]
    assert [(r.threshold, r.event_count) for r in sink.docs.read(spark).collect()] == [(0, 30)]
    assert sink.ledger.last(spark, "nobody") == -1


def test_dedup_table_opens_its_own_days_only(spark, monkeypatch):
    from blotter.sinks.merge import DedupTable
    schema = "k string, at timestamp, v int"
    sink = DedupTable(scratch_path(spark, "t-dedup-days"), ["k"], "at")
    opened = []
    inner = DedupTable._opened
    monkeypatch.setattr(DedupTable, "_opened", lambda self, s, days: opened.append(inner(self, s, days)) or opened[-1])

    def row(k, day, v):
        import datetime as dt
        return k, None if day is None else dt.datetime(2024, 1, day, 12), v
    batches = [[row("a", 1, 2), row("a", 1, 1), row("b", 2, 1), row(None, None, 4)],
               [row("a", 1, 0), row("c", 3, 1), row(None, None, 3)],
               [row("hot", 1, i) for i in range(500)] + [row("b", 2, 9), row("d", 2, 5)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).repartition(3)
        sink(df, i)
        sink(df, i)  # replayed
    got = sorted(((r.k, r.v) for r in sink.read(spark).collect()), key=repr)
    assert got == sorted([("a", 1), ("b", 1), (None, 4), ("c", 1), ("hot", 0), ("d", 5)], key=repr)
    days = [sorted(p.rsplit("=", 1)[1] for p in o) for o in opened]
    assert days[2] == ["0001-01-01", "2024-01-01"]  # nothing of 2024-01-02, though it holds rows
    assert days[4] == ["2024-01-01", "2024-01-02"]


# ----------------------------------------------------------------- reading
def test_newest_reads_the_newest_partitions(spark):
    from blotter.operators import serving
    from blotter.sinks import tables
    path = scratch_path(spark, "t-newest")
    rows = spark.range(60).select(F.timestamp_seconds(F.lit(T0) + F.col("id") * 43_200).alias("ts"), "id")
    tables.overwrite_table(with_date(rows, "ts", "day"), path, partition_by=["day"])
    top = serving.newest(spark, path, "ts", "day", 5)
    assert [r.id for r in top.collect()] == [59, 58, 57, 56, 55]
    assert len({f.split("day=")[1][:10] for f in top.inputFiles()}) == 4  # two rows a day: 1, 2, then 4 days
    assert serving.newest(spark, path, "ts", "day", 1000).count() == 60
    with pytest.raises(FileNotFoundError):
        serving.newest(spark, path + "-none", "ts", "day")


def test_first_rows_keep_file_order(spark):
    """Files of very different sizes (the scan packs them by size), small splits,
    a filter before; against the files' lines one after another."""
    from blotter.sources import files
    path = scratch_path(spark, "t-first")
    sizes = [5, 900, 0, 40, 2000, 1]
    at, want = 0, []
    for i, n in enumerate(sizes):
        spark.range(at, at + n, 1, 1).select(F.col("id").cast("string"), F.repeat(F.lit("x"), 30)).write.csv(f"{path}/f{i}")
        want += [x for x in range(at, at + n) if x % 3]
        at += n
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        rows = files.with_place(spark.read.schema("id long, x string").csv(f"{path}/f*")).where("id % 3 > 0")
        for n in (1, 4, 500, 1500, 10_000):
            got = files.first_rows(rows, n)
            assert sorted(r.id for r in got.collect()) == want[:n] and got.columns == ["id", "x"]
        assert files.first_rows(rows, 0).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_quarantine_names_file_and_block(spark):
    from blotter.schemas import text_schema
    from blotter.sources import files
    path = scratch_path(spark, "t-quarantine")
    spark.createDataFrame([("1,a",), ("2",), ("3,b,c",), ('4,"x,y"',)], "value string").coalesce(1).write.text(f"{path}/one")
    spark.createDataFrame([("5,d",), ("",), ("6,e,f,g",)], "value string").coalesce(1).write.text(f"{path}/two")
    good, bad = files.stage_csv_quarantine(spark, f"{path}/*", text_schema(["id", "v"]), scratch_path(spark, "t-quarantined"), header=False)
    assert sorted(tuple(r) for r in good.collect()) == [("1", "a"), ("4", "x,y"), ("5", "d")]
    got = sorted((r.raw, r.reason, r.file.split("/")[-2], r.block_start) for r in bad.collect())
    assert got == [("2", "field_count", "one", 0), ("3,b,c", "field_count", "one", 0), ("6,e,f,g", "field_count", "two", 0)]


def test_batch_tables_carry_the_load_time(spark):
    from blotter.plans.batch import run
    from tests.conftest import SF_SMALL
    for name, path in run(spark, SF_SMALL, scratch_path(spark, "t-stamped")).items():
        stored = spark.read.parquet(path)
        assert stored.columns[-1] == "generated_at" and stored.where("generated_at is null").count() == 0, name

"""Sources, sinks and streams: corrupt rows, replay idempotence, late data,
batch/stream equivalence."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators import windows
from blotter.plans import catalog, io_queries
from blotter.session import scratch_path, shared_dir
from blotter.sinks import tables
from blotter.sources import connectors, files
from blotter.streaming import events as ev
from blotter.streaming import runner
from tests.conftest import SF_SMALL, rows

THREE = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


def _write(text: str, name: str = "x.csv", encoding: str = "utf-8") -> str:
    d = tempfile.mkdtemp(prefix="blotter-test-")
    with open(os.path.join(d, name), "w", encoding=encoding, newline="") as fh:
        fh.write(text)
    return d


def test_shared_dir_comes_from_session(spark):
    base = shared_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base)


def test_csv_quarantine_field_counts(spark):
    d = _write("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    good, bad = files.read_csv_quarantine(spark, d, THREE)
    assert rows(good) == [("1", "2", "3")]
    assert sorted(r.raw for r in bad.collect()) == ["4,5", "6,7,8,9"]


def test_csv_bom_and_multiline(spark):
    d = _write('﻿a,b,c\n1,"x\ny",3\n')
    one = files.read_csv(spark, d, THREE, multiline=True)
    assert rows(one) == [("1", "x\ny", "3")]
    split = files.read_csv(spark, d, THREE)
    assert split.count() == 2


def test_csv_swapped_header_fails_when_checked(spark):
    d = _write("b,a,c\n1,2,3\n")
    with pytest.raises(Exception):
        files.read_csv(spark, d, THREE, check_header=True).collect()
    assert files.read_csv(spark, d, THREE, check_header=False).count() == 1


def test_glob_first_match(spark):
    d = _write("a,b,c\n1,2,3\n", "b.csv")
    _write_into = os.path.join(d, "a.csv")
    with open(_write_into, "w") as fh:
        fh.write("a,b,c\n")
    assert files.resolve_first(spark, f"{d}/*.csv").endswith("/a.csv")
    with pytest.raises(FileNotFoundError):
        files.resolve_first(spark, f"{d}/*.none")


def test_connector_options():
    o = connectors.kafka_options("h:9092", "crime_events", group_id="g")
    assert o["subscribe"] == "crime_events" and o["startingOffsets"] == "latest"
    assert o["kafka.group.id"] == "g"
    assert connectors.kafka_write_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092",
                                                             "topic": "t"}


def test_jdbc_reader_needs_table_or_query(spark):
    with pytest.raises(ValueError):
        connectors.jdbc_reader(spark, "jdbc:x", table="t", query="select 1")
    connectors.jdbc_reader(spark, "jdbc:x", query="select 1", partition_column="id", lower=0,
                           upper=10, num_partitions=2)


def test_keyed_json_frame(spark):
    df = spark.createDataFrame([("001", "a", 1.5)], "district string, case_number string, latitude double")
    r = connectors.keyed_json(df, "district", ["case_number", "latitude"]).first()
    assert r.key == "001" and r.value == '{"case_number":"a","latitude":1.5}'


def test_append_batch_is_idempotent(spark):
    path = scratch_path(spark, "t-append")
    df = spark.createDataFrame([(1,), (2,)], "x int")
    tables.append_batch(df, path, 0)
    tables.append_batch(df, path, 0)
    tables.append_batch(df, path, 1)
    assert tables.read_table(spark, path).count() == 4


def test_dual_sink_replay_leaves_one_copy(spark):
    sink = runner.DualSink(scratch_path(spark, "t-tab"), scratch_path(spark, "t-doc"), ["x"])
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    sink(df, 3)
    sink(df, 3)  # the same batch delivered again after a failure
    assert sink.read_table(spark).count() == 2
    assert spark.read.json(sink.docs_path_for_read()).count() == 2


def test_stamp_adds_load_time(spark):
    out = tables.stamp(spark.range(1))
    assert "generated_at" in out.columns and out.first().generated_at is not None


def test_parser_rejects(spark):
    msgs = spark.createDataFrame([
        ('{"case_number":"1","date":"01/05/2020 12:00:00 AM","block":"b","primary_type":"T",'
         '"district":"D-7x9","arrest":"TRUE","latitude":1.5,"longitude":2}',),
        ('{"case_number":"2","date":"d","block":"  ","primary_type":"T","district":"1",'
         '"arrest":"x","latitude":1,"longitude":2}',),
        ('{"case_number":"3"',),
        ('{"case_number":"4","date":"d","block":"b","primary_type":"T","district":"99999999999",'
         '"arrest":"x","latitude":1,"longitude":2}',),
        ('{"case_number":"5","date":"d","block":"b","primary_type":"T","district":"1",'
         '"arrest":"x","latitude":"north","longitude":2}',),
    ], "value string")
    got = [(r.case_number, r.district, r.arrest, r.reason) for r in ev.parse_messages(msgs).collect()]
    assert got[0] == ("1", "079", True, None)
    assert got[1][3] == "missing:block"
    assert got[2][3] == "malformed"
    assert got[3][3] == "bad_district"
    assert got[4][3] == "bad_double:latitude"


def test_stream_equals_batch(spark):
    """Complete-mode stream counts equal the batch counts on the same messages."""
    stream = io_queries.q_stream_window_counts(spark, SF_SMALL)
    acc, _ = ev.split_parsed(io_queries.parsed(spark, SF_SMALL))
    batch = windows.window_counts(acc, "event_ts", "district", catalog.ALERT_SIZE_S,
                                  catalog.ALERT_SLIDE_S)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0


def test_dedup_stream_counts_each_event_once(spark):
    out = io_queries.q_stream_dedup(spark, SF_SMALL)
    assert out.count() == out.select("case_number").distinct().count()


def test_restart_resumes_from_checkpoint(spark):
    """A second run on the same checkpoint processes only new files."""
    src = scratch_path(spark, "t-restart-src")
    msgs = io_queries.messages(spark, SF_SMALL)
    msgs.limit(100).write.parquet(f"{src}/part=0")
    chk = runner.checkpoint_dir(spark, "t-restart")
    sink = runner.AppendTable(scratch_path(spark, "t-restart-out"))
    stream = lambda: ev.split_parsed(ev.parse_messages(io_queries.message_stream(spark, src)))[0]
    runner.run_available(stream().select("case_number"), "append", chk, sink)
    first = sink.read(spark).count()
    msgs.orderBy(F.col("event_id").desc()).limit(50).write.parquet(f"{src}/part=1")
    runner.run_available(stream().select("case_number"), "append", chk, sink)
    assert sink.read(spark).count() > first
    assert sink.read(spark).count() == sink.read(spark).distinct().count()


def test_batch_job_tables(spark):
    from blotter.plans.batch import RESULT_TABLES, build
    from blotter.schemas import RESULT_SCHEMAS
    built = build(spark, SF_SMALL)
    assert sorted(built) == sorted(RESULT_TABLES)
    for name, df in built.items():
        assert [f.name for f in df.schema.fields] == RESULT_SCHEMAS[name].fieldNames()
    trends = built["crime_trends"]
    assert trends.filter(F.col("period_value").isNull()).count() == 0


def test_alert_stream_append_is_subset_of_batch(spark):
    from blotter.streaming.alerting import alert_stream
    staged = io_queries.stage_messages(spark, SF_SMALL)
    alerts = alert_stream(io_queries.message_stream(spark, staged), 86400, 21600, 2, by_arrival=False)
    sink = runner.AppendTable(scratch_path(spark, "t-alert-append"))
    runner.run_available(alerts, "append", runner.checkpoint_dir(spark, "t-alert-append"), sink)
    got = sink.read(spark)
    acc, _ = ev.split_parsed(io_queries.parsed(spark, SF_SMALL))
    batch = windows.to_alerts(windows.window_counts(acc, "event_ts", "district", 86400, 21600), 2)
    assert got.count() > 0
    assert got.exceptAll(batch).count() == 0


def test_producer_blank_rule_accepts_spaces(spark):
    """Producer rejects None or '' only; the stream parser also rejects '  '."""
    base = {"Case Number": "c", "Date": "d", "Block": "b", "Primary Type": "t", "District": "7",
            "Arrest": "yes", "Latitude": "1.5", "Longitude": "2"}
    variants = [dict(base), dict(base, Block=""), dict(base, Block="  "), dict(base, Latitude="x")]
    cols = list(base)
    df = spark.createDataFrame([tuple(v[c] for c in cols) for v in variants],
                               ", ".join(f"`{c}` string" for c in cols))
    got = [(r.reason, r.district, r.arrest) for r in ev.produce_events(df).collect()]
    assert got[0] == (None, "007", True)
    assert got[1][0] == "missing:block" and got[2][0] is None
    assert got[3][0] == "bad_double:latitude"


def test_arrival_time_windows_run(spark):
    from blotter.streaming.alerting import alert_stream
    staged = io_queries.stage_messages(spark, SF_SMALL)
    alerts = alert_stream(io_queries.message_stream(spark, staged), 300, 60, 0,
                          watermark=None, by_arrival=True)
    sink = runner.AppendTable(scratch_path(spark, "t-arrival"))
    runner.run_available(alerts, "update", runner.checkpoint_dir(spark, "t-arrival"), sink)
    out = sink.read(spark)
    assert out.count() > 0
    assert out.filter(F.col("severity") != "HIGH").count() == 0  # threshold 0: always HIGH


def test_correlations_from_stored_tables_equal_direct_pairs(spark):
    from blotter.plans.batch import build
    built = build(spark, SF_SMALL, hash_method="md5")["correlations"]
    direct = catalog.pairs(spark, SF_SMALL)
    assert built.exceptAll(direct).count() == 0 and direct.exceptAll(built).count() == 0


def test_date_partitioned_serving_prunes(spark):
    from blotter.operators import serving
    alerts = catalog.flagship_alerts(spark, SF_SMALL)
    path = scratch_path(spark, "t-alerts-by-date")
    tables.overwrite_table(tables.with_date(alerts, "alert_timestamp", "alert_date"), path,
                           partition_by=["alert_date"])
    stored = spark.read.parquet(path)
    full = serving.latest(stored, "alert_timestamp", 5, ("district",)).drop("alert_date")
    newest = full.agg(F.min("alert_timestamp")).first()[0].date().isoformat()
    pruned = serving.latest(stored, "alert_timestamp", 5, ("district",), "alert_date", newest)
    text = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_date" in text
    assert rows(pruned.drop("alert_date")) == rows(full)


def test_replay_takes_two_micro_batches_and_files_scale(spark):
    staged = io_queries.stage_messages(spark, SF_SMALL)
    assert staged.files >= 8
    sink = runner.AppendTable(scratch_path(spark, "t-two"))
    runner.run_available(io_queries.stream_accepted(spark, staged).select("case_number"),
                         "append", runner.checkpoint_dir(spark, "t-two"), sink)
    assert sink.batches == [0, 1]
    small = runner.stage_files(io_queries.messages(spark, SF_SMALL), scratch_path(spark, "t-rpf"),
                               "event_id", records_per_file=10)
    assert small.files >= 100  # 1,000 messages at 10 per file


def test_dedup_sink_replay_and_hot_key(spark):
    """A hot group of copies collapses map-side; a replayed batch is exact."""
    sink = runner.DedupSink(scratch_path(spark, "t-dedup-sink"), ["k"])
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").alias("v")) \
        .unionByName(spark.range(10).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")))
    sink(hot, 0)
    sink(spark.createDataFrame([("hot", 1), ("new", 2)], "k string, v long"), 1)
    sink(spark.createDataFrame([("hot", 1), ("new", 2)], "k string, v long"), 1)  # replay
    out = sink.read(spark)
    assert out.count() == 12 and out.select("k").distinct().count() == 12
    plan = hot.dropDuplicates(["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_first" in plan or "partial" in plan


def test_command_line_batch_and_alerts(spark):
    from blotter.__main__ import main
    out = main(["batch", "--sf-dir", SF_SMALL, "--out", scratch_path(spark, "t-cli")])
    assert spark.read.parquet(out["crime_trends"]).count() > 0
    staged = io_queries.stage_messages(spark, SF_SMALL)
    res = main(["alerts", "--source", staged.path, "--out", scratch_path(spark, "t-cli-alerts"),
                "--window", "86400", "--slide", "21600", "--threshold", "2", "--once"])
    assert tables.read_table(spark, res["alerts"]).count() > 0


def test_late_event_dropped_in_append_counted_in_complete(spark):
    import time as _time
    src = scratch_path(spark, "t-late-src")
    schema = "district string, event_ts timestamp_ntz"
    import datetime as _dt
    base = _dt.datetime(2024, 1, 1, 12, 0)
    on_time = [("001", base + _dt.timedelta(minutes=m)) for m in (0, 5, 15, 25, 35)]
    # Three files, one per micro-batch in modification order. Spark drops late
    # rows against the previous batch's watermark, so the late event comes
    # two batches after the one that moved the watermark.
    spark.createDataFrame(on_time, schema).coalesce(1).write.parquet(f"{src}/a")
    _time.sleep(1.5)
    spark.createDataFrame([("001", base + _dt.timedelta(minutes=40))], schema) \
        .coalesce(1).write.parquet(f"{src}/b")
    _time.sleep(1.5)
    spark.createDataFrame([("001", base - _dt.timedelta(hours=1))], schema) \
        .coalesce(1).write.parquet(f"{src}/c")
    sch = T.StructType([T.StructField("district", T.StringType()),
                        T.StructField("event_ts", T.TimestampNTZType())])
    late_window = base - _dt.timedelta(hours=1)

    def run(mode: str, watermark: str | None):
        s = runner.event_time(runner.file_stream(spark, src, sch, max_files=1))
        if watermark:
            s = s.withWatermark("event_time", watermark)
        counts = windows.window_counts(s, "event_time", "district", 600, 600)
        sink = runner.LatestTable(scratch_path(spark, f"t-late-{mode}")) if mode == "complete" \
            else runner.AppendTable(scratch_path(spark, f"t-late-{mode}"))
        runner.run_available(counts, mode, runner.checkpoint_dir(spark, f"t-late-{mode}"), sink)
        return sink.read(spark)

    appended = run("append", "10 minutes")
    complete = run("complete", None)
    assert appended.filter(F.col("window_start") == late_window).count() == 0
    assert complete.filter(F.col("window_start") == late_window).first().event_count == 1
    assert appended.count() > 0  # windows closed by the watermark were emitted


def test_sql_over_stored_tables(spark):
    from blotter.operators import serving
    from blotter.plans.batch import run
    paths = run(spark, SF_SMALL, scratch_path(spark, "t-sql"), hash_method="md5")
    top = serving.sql_over_tables(
        spark, "SELECT group_type, group_value, arrest_rate, crime_count FROM arrest_rates "
               "ORDER BY arrest_rate DESC, group_type, group_value LIMIT 20", paths)
    direct = serving.top_by(spark.read.parquet(paths["arrest_rates"]), "arrest_rate", 20,
                            ("group_type", "group_value")).select(
        "group_type", "group_value", "arrest_rate", "crime_count")
    assert [tuple(r) for r in top.collect()] == [tuple(r) for r in direct.collect()]
    trends = serving.sql_over_tables(
        spark, "SELECT trend_type, period_value, crime_count FROM crime_trends "
               "WHERE trend_type IN ('year', 'month', 'hour') ORDER BY trend_type, period_value", paths)
    assert trends.count() == serving.trend_lines(spark.read.parquet(paths["crime_trends"])).count()


def test_stream_panes_equal_direct_in_append(spark):
    """Chained pane aggregation emits the same closed windows as direct
    sliding windows under the same watermark."""
    staged = io_queries.stage_messages(spark, SF_SMALL)
    out = {}
    for method in ("direct", "panes"):
        acc = runner.event_time(io_queries.stream_accepted(spark, staged)) \
            .withWatermark("event_time", "10 minutes")
        counts = windows.window_counts(acc, "event_time", "district", 3600, 600, method=method)
        sink = runner.AppendTable(scratch_path(spark, f"t-{method}"))
        runner.run_available(counts, "append", runner.checkpoint_dir(spark, f"t-{method}"), sink)
        out[method] = sink.read(spark)
    assert out["panes"].count() > 0
    assert out["panes"].exceptAll(out["direct"]).count() == 0
    assert out["direct"].exceptAll(out["panes"]).count() == 0


def test_command_line_produce_then_alerts(spark):
    """Producer CLI over a crime CSV, then the alert stream over its output."""
    from blotter.__main__ import main
    from blotter.plans import standins
    csv_dir = scratch_path(spark, "t-prod-csv")
    standins.raw_crimes(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(csv_dir)
    out = scratch_path(spark, "t-prod-msgs")
    main(["produce", "--csv", f"{csv_dir}/*.csv", "--first", "--out", out])
    msgs = spark.read.parquet(out)
    n_ok = ev.accepted_events(ev.produce_events(
        spark.read.option("header", True).csv(csv_dir))).count()
    assert msgs.count() == n_ok
    parsed = ev.parse_messages(msgs)
    assert parsed.filter(F.col("reason").isNotNull()).count() == 0
    main(["produce", "--csv", csv_dir, "--out", scratch_path(spark, "t-prod-10"), "--max-rows", "10"])
    res = main(["alerts", "--source", out, "--out", scratch_path(spark, "t-prod-alerts"),
                "--window", "86400", "--slide", "86400", "--threshold", "1", "--once",
                "--watermark", ""])
    assert "alerts" in res


def test_two_alert_runs_keep_both_runs_alerts(spark):
    """A second command-line run on the same output goes on with the first run's
    checkpoint: its batches add to the table, whose rows carry the payload."""
    from blotter.__main__ import main
    source, out = scratch_path(spark, "t-runs-msgs"), scratch_path(spark, "t-runs-out")
    ev_json = ('{{"case_number":"{c}","date":"01/0{d}/2024 10:00:00 AM","block":"b","primary_type":"p",'
               '"district":"{k}","arrest":"true","latitude":"1.5","longitude":"2.5"}}')

    def send(day, key):
        rows = [(i, key, ev_json.format(c=f"{key}{i}", d=day, k=key)) for i in range(3)]
        spark.createDataFrame(rows, runner.MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(source)

    args = ["alerts", "--source", source, "--out", out, "--window", "86400", "--slide", "86400",
            "--threshold", "1", "--once", "--watermark", ""]
    send(1, "001")
    main(args)
    first = tables.read_table(spark, f"{out}/alerts").select("district").distinct().collect()
    send(2, "002")
    main(args)
    got = tables.read_table(spark, f"{out}/alerts")
    assert [r.district for r in first] == ["001"]
    assert {r.district for r in got.collect()} == {"001", "002"}
    assert got.filter("payload is null").count() == 0
    assert got.filter(F.get_json_object("payload", "$.threshold") != "1").count() == 0


def test_glob_reads_every_match_unless_first_is_asked(spark):
    from blotter.plans import standins
    from blotter.plans.batch import RawInputs
    base = scratch_path(spark, "t-globs")
    for name, fn in {"crimes": standins.raw_crimes, "arrests": standins.raw_arrests, "stations": standins.raw_stations,
                     "violence": standins.raw_violence, "registry": standins.raw_registry}.items():
        fn(spark, SF_SMALL).repartition(2).write.option("header", True).csv(f"{base}/{name}")
    globs = [f"{base}/{n}/*.csv" for n in ("crimes", "arrests", "stations", "violence", "registry")]
    n = standins.raw_crimes(spark, SF_SMALL).count()
    assert RawInputs.from_csv(spark, *globs).crimes.count() == n
    assert 0 < RawInputs.from_csv(spark, *globs, first_match=True).crimes.count() < n


def test_update_sink_reads_latest_version(spark):
    sink = runner.AppendTable(scratch_path(spark, "t-upsert"))
    sink(spark.createDataFrame([("a", 1), ("b", 5)], "k string, n long"), 0)
    sink(spark.createDataFrame([("a", 3)], "k string, n long"), 1)
    got = {r.k: r.n for r in sink.read_latest(spark, ["k"]).collect()}
    assert got == {"a": 3, "b": 5}


def test_stored_tables_respect_not_null(spark):
    from blotter.plans.batch import not_null_violations, run
    paths = run(spark, SF_SMALL, scratch_path(spark, "t-nn"))  # validates, raises on NULLs
    assert not_null_violations(spark, paths) == {}
    bad = scratch_path(spark, "t-nn-bad")
    spark.createDataFrame([("year", None, None, 1, None)],
                          "trend_type string, period_value string, district string, "
                          "crime_count long, period_order int").write.parquet(bad)
    assert not_null_violations(spark, {"crime_trends": bad}) == {"crime_trends.period_value": 1}


def test_batch_job_from_csv_files_equals_tables(spark):
    """The job over five CSV files (globs, first match) gives the same tables
    as over the inputs derived from the driver tables."""
    from blotter.__main__ import main
    from blotter.plans import standins
    from blotter.plans.batch import RESULT_TABLES
    base = scratch_path(spark, "t-csv-inputs")
    raw = {"crimes": standins.raw_crimes, "arrests": standins.raw_arrests,
           "stations": standins.raw_stations, "violence": standins.raw_violence,
           "registry": standins.raw_registry}
    args = ["batch", "--out", scratch_path(spark, "t-csv-out"), "--hash", "md5"]
    for name, fn in raw.items():
        fn(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{base}/{name}")
        args += [f"--{name}", f"{base}/{name}/*.csv"]
    from_csv = main(args)
    from_tables = main(["batch", "--sf-dir", SF_SMALL, "--out", scratch_path(spark, "t-tab-out"),
                        "--hash", "md5"])
    for name in RESULT_TABLES:
        a, b = (spark.read.parquet(x[name]).drop("generated_at") for x in (from_csv, from_tables))
        if name == "hotspots":  # centres depend on the input partitioning
            assert a.agg(F.sum("crime_count")).first()[0] == b.agg(F.sum("crime_count")).first()[0]
            continue
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_command_line_alerts_count_every_event_of_an_unordered_replay(spark):
    from blotter.__main__ import main
    src = scratch_path(spark, "t-unordered")
    msgs = io_queries.messages(spark, SF_SMALL)
    for i in range(3):
        part = F.pmod(F.xxhash64("event_id"), F.lit(3)) == i
        msgs.filter(part).coalesce(1).write.parquet(f"{src}/part={i}")
    res = main(["alerts", "--source", src, "--out", scratch_path(spark, "t-unordered-out"), "--window", "86400",
                "--slide", "86400", "--threshold", "0", "--max-files", "1", "--once"])
    alerts = tables.read_table(spark, res["alerts"])
    accepted = ev.split_parsed(io_queries.parsed(spark, SF_SMALL))[0].count()
    assert accepted > 0 and alerts.agg(F.sum("event_count")).first()[0] == accepted
    assert alerts.count() == alerts.select("district", "alert_timestamp").distinct().count() == spark.read.json(res["alert_logs"]).count()
    assert spark.read.json(res["archive"]).count() == accepted
    assert spark.read.parquet(res["quarantine"]).count() == msgs.count() - accepted


def test_latest_widens_a_short_since(spark):
    from blotter.operators import serving
    df = spark.createDataFrame([(i, f"2024-01-{i + 1:02d}") for i in range(9)], "ts int, day string") \
        .withColumn("day", F.to_date("day"))
    assert [r.ts for r in serving.latest(df, "ts", 5, (), "day", "2024-01-08").collect()] == [8, 7, 6, 5, 4]
    assert [r.ts for r in serving.latest(df, "ts", 2, (), "day", "2024-01-08").collect()] == [8, 7]

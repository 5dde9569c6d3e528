"""Operators on hand-made rows and invariants on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from blotter.operators import cleaning, hotspots, linkage, rollups, windows
from blotter.plans import catalog
from tests.conftest import SF_SMALL, rows


def test_station_filter_three_valued(spark):
    raw = spark.createDataFrame([("000", "a"), ("HQ", "b"), ("001", "c")],
                                "`DISTRICT` string, `DISTRICT NAME` string") \
        .withColumn("LATITUDE", F.lit("1.0")).withColumn("LONGITUDE", F.lit("x"))
    out = cleaning.clean_stations(raw)
    assert [(r.district, r.station_name) for r in out.collect()] == [("001", "c")]


def test_dedup_and_left_join(spark):
    crimes = spark.createDataFrame([("a", "t"), ("a", "t"), ("b", "t"), (None, "t")],
                                   "case_number string, primary_type string")
    arrests = spark.createDataFrame(
        [("a", dt.datetime(2020, 1, 1), "R1"), ("a", None, "R0"), (None, None, "X"), (None, None, "Y")],
        "case_number string, arrest_ts timestamp_ntz, race string")
    d = linkage.dedup_key(arrests, "case_number", ["arrest_ts", "race"])
    assert rows(d) == [("a", dt.datetime(2020, 1, 1), "R1"), (None, None, "X")]
    j = linkage.join_left_dedup(crimes, d, "case_number")
    assert j.count() == 4
    assert j.filter(F.col("case_number").isNull() & F.col("race").isNotNull()).count() == 0


def test_arrest_needs_parsable_time(spark):
    joined = spark.createDataFrame([("c", "T", None, "RACE")],
                                   "case_number string, primary_type string, arrest_ts timestamp_ntz, race string")
    r = rollups.rate_by(joined, "race").first()
    assert (r.group_value, r.crime_count, r.arrest_count, r.arrest_rate) == ("RACE", 1, 0, 0.0)


def test_flag_proportion(spark):
    v = spark.createDataFrame([("d", f) for f in ["Y", "YES", "yes", "N", None]],
                              "district string, gunshot_injury string")
    v = v.withColumn("gunshot_injury", F.upper("gunshot_injury"))
    r = rollups.flag_proportion(v).first()
    assert r.incident_count == 5 and abs(r.rate - 0.6) < 1e-12


def test_grouping_sets_equal_unions(spark):
    c = catalog.crimes(spark, SF_SMALL)
    a = rollups.trend_all(c)
    for m in ("union", "grouping_sets"):
        b = rollups.trend_all(c, method=m)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    j = catalog.joined(spark, SF_SMALL)
    ra = rollups.rate_all(j)
    for m in ("union", "grouping_sets"):
        rb = rollups.rate_all(j, method=m)
        assert ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0


def test_trend_sums(spark):
    c = catalog.crimes(spark, SF_SMALL)
    n = c.count()
    t = rollups.trend_all(c)
    sums = {r.trend_type: r.s for r in t.groupBy("trend_type").agg(F.sum("crime_count").alias("s")).collect()}
    for k in ("year", "month", "day_of_week", "hour"):
        assert sums[k] == n
    assert sums["district"] == c.filter(F.col("district").isNotNull()).count()


def test_rate_bounds(spark):
    r = rollups.rate_all(catalog.joined(spark, SF_SMALL))
    assert r.filter((F.col("arrest_count") > F.col("crime_count")) | (F.col("arrest_rate") < 0)
                    | (F.col("arrest_rate") > 1)).count() == 0


def test_dense_index_many_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7 % 5000).alias("k"))
    idx = linkage.dense_index(df, ["k"], "i")
    got = idx.orderBy("k").select("k", "i").collect()
    assert [r.i for r in got] == list(range(5000)) and [r.k for r in got] == list(range(5000))


def test_bucket_density_keep_empty(spark):
    reg = spark.createDataFrame([("x", "Y"), ("x", "N"), (None, None)],
                                "block string, victim_minor string")
    index = spark.createDataFrame([("001", "s1", 0), ("002", "s2", 1), ("003", "s3", 2)],
                                  "district string, station_name string, district_index long")
    inner = linkage.bucket_density(reg, index, "md5")
    full = linkage.bucket_density(reg, index, "md5", keep_empty=True)
    assert sum(r.offender_count for r in inner.collect()) == 3
    assert full.count() == 3 and sum(r.offender_count for r in full.collect()) == 3
    assert sum(r.priority_minor_victim_count for r in full.collect()) == 1


def test_sliding_window_membership(spark):
    base = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("d", base + dt.timedelta(seconds=s)) for s in (0, 59, 60, 299, 300)],
                               "district string, ts timestamp_ntz")
    direct = windows.window_counts(ev, "ts", "district", 300, 60)
    panes = windows.window_counts(ev, "ts", "district", 300, 60, method="panes")
    assert rows(direct) == rows(panes)
    total = direct.agg(F.sum("event_count")).first()[0]
    assert total == 5 * 5
    first = direct.filter(F.col("window_start") == base).first()
    assert first.event_count == 4  # [0, 300) holds 0, 59, 60, 299


def test_panes_equal_direct_on_events(spark):
    e = catalog.events(spark, SF_SMALL)
    a = windows.window_counts(e, "ts", "event_type", 3600, 600)
    b = windows.window_counts(e, "ts", "event_type", 3600, 600, method="panes")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_repartition_invariance(spark):
    c = catalog.crimes(spark, SF_SMALL)
    one = rollups.trend_all(c.repartition(1))
    seven = rollups.trend_all(c.repartition(7))
    assert rows(one) == rows(seven)


def test_kmeans_invariants(spark):
    pts = spark.createDataFrame(
        [(0.0 + i * 1e-3, 0.0) for i in range(10)] + [(50.0 + i * 1e-3, 50.0) for i in range(10)]
        + [(None, 1.0)], "latitude double, longitude double")
    out = hotspots.kmeans_hotspots(pts, k=2, seed=1)
    sizes = sorted(r.crime_count for r in out.collect())
    assert sizes == [10, 10]
    few = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0), (2.0, 2.0)], "latitude double, longitude double")
    assert hotspots.kmeans_hotspots(few, k=5, seed=1).count() <= 2


def test_kmeans_sizes_sum_to_geo_rows(spark):
    c = catalog.crimes(spark, SF_SMALL)
    out = hotspots.kmeans_hotspots(c)
    assert out.agg(F.sum("crime_count")).first()[0] == cleaning.filter_geo(c).count()


def test_nearest_centre_tie_goes_to_lowest_id(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "latitude double, longitude double")
    got = df.select(hotspots.nearest_centre("latitude", "longitude", [(1.0, 0.0), (-1.0, 0.0)])).first()[0]
    assert got == 0


def test_check_not_null_counts(spark):
    from blotter.schemas import RESULT_SCHEMAS
    df = spark.createDataFrame([("a", None, None, 1), ("b", "x", None, None)],
                               "trend_type string, period_value string, district string, crime_count long")
    out = {r.column_name: r.null_count for r in cleaning.check_not_null(df, RESULT_SCHEMAS["crime_trends"]).collect()}
    assert out == {"trend_type": 0, "period_value": 1, "crime_count": 1}


def test_null_periods_become_unknown(spark):
    df = spark.createDataFrame([(None, "001"), (dt.datetime(2020, 1, 5, 13), None)],
                               "event_ts timestamp_ntz, district string")
    got = {(r.trend_type, r.period_value): r.crime_count for r in rollups.trend_all(df).collect()}
    assert got[("year", "UNKNOWN")] == 1 and got[("hour", "13")] == 1
    assert ("district", None) not in got and got[("district", "001")] == 1


def test_serving_order_is_lexical_or_natural(spark):
    from blotter.operators import serving
    t = spark.createDataFrame([("month", p, None, 1) for p in ["2", "10", "1", "12", "11", "UNKNOWN"]],
                              "trend_type string, period_value string, district string, crime_count long")
    t = t.withColumn("period_order", rollups.period_order(F.col("trend_type"), F.col("period_value")))
    assert [r.period_value for r in serving.trend_lines(t).collect()] == \
        ["1", "10", "11", "12", "2", "UNKNOWN"]
    assert [r.period_value for r in serving.trend_lines(t, natural=True).collect()] == \
        ["1", "2", "10", "11", "12", "UNKNOWN"]
    days = spark.createDataFrame([("day_of_week", d) for d in ["Sat", "Sun", "Wed"]],
                                 "trend_type string, period_value string")
    got = days.select(rollups.period_order(F.col("trend_type"), F.col("period_value"))).collect()
    assert [r[0] for r in got] == [7, 1, 4]


def test_serve_hotspots_shape(spark):
    from blotter.plans.catalog import QUERIES
    out = QUERIES["serve_hotspots"](spark, SF_SMALL)
    assert out.columns == ["cluster_id", "lat", "lon", "crime_count"]
    got = out.collect()
    assert [r.cluster_id for r in got] == sorted(r.cluster_id for r in got)
    geo = cleaning.filter_geo(catalog.crimes(spark, SF_SMALL)).count()
    assert sum(r.crime_count for r in got) == geo

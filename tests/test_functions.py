"""Scalar semantics of SURVEY 1.5 on hand-made rows (FIXTURES.md section 5)."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blotter.functions.codes import batch_code, normalize_code, stream_code, zfill_code
from blotter.functions.hashing import bucket
from blotter.functions.parse import (first_missing, is_blank, iso_utc, parse_boolean_strict,
                                     parse_event_time, parse_iso_utc, to_bool, to_double,
                                     to_int, truthy)
from blotter.operators.windows import severity


def col_values(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_batch_code_rule(spark):
    raw = ["1", "011", "1234", "3.0", "D-7x9", "HQ", None, " 5 "]
    assert col_values(spark, raw, batch_code) == ["001", "011", "123", "003", "007", None, None, "005"]


def test_batch_code_default_keeps_long_codes(spark):
    assert col_values(spark, ["1234", "7"], normalize_code) == ["1234", "007"]


def test_stream_code_rule(spark):
    raw = ["1", "0011", "1234", "3.0", "D-7x9", "HQ", "99999999999"]
    assert col_values(spark, raw, stream_code) == ["001", "011", "1234", "030", "079", "000", None]


def test_producer_zfill(spark):
    assert col_values(spark, ["1", "1234", "3.0", "HQ"], zfill_code) == ["001", "1234", "3.0", "0HQ"]


def test_event_time_parse(spark):
    raw = ["01/05/2020 12:00:00 AM", "01/05/2020 12:00:00 PM", "garbage", None]
    got = col_values(spark, raw, parse_event_time)
    assert got == [dt.datetime(2020, 1, 5, 0, 0), dt.datetime(2020, 1, 5, 12, 0), None, None]
    days = col_values(spark, raw, lambda c: F.date_format(parse_event_time(c), "E"))
    assert days[:2] == ["Sun", "Sun"]


def test_unpadded_and_date_only_times_are_null(spark):
    raw = ["1/5/2020 1:02:03 PM", "01/05/2020", "01/05/2020 01:02:03 pm"]
    got = col_values(spark, raw, parse_event_time)
    assert got[0] is None and got[1] is None and got[2] == dt.datetime(2020, 1, 5, 13, 2, 3)


BOOL_RAW = ["true", "T", "1", "yes", "Y", " true ", "on", "maybe"]


def test_boolean_cast(spark):
    assert col_values(spark, BOOL_RAW, to_bool) == [True] * 6 + [None, None]


def test_boolean_truthy_set(spark):
    assert col_values(spark, BOOL_RAW, truthy) == [True] * 6 + [False, False]


def test_boolean_strict_parse(spark):
    got = col_values(spark, BOOL_RAW + ["TRUE"], parse_boolean_strict)
    assert got == [True, False, False, False, False, False, False, False, True]


def test_try_casts_never_fail(spark):
    assert col_values(spark, ["12", "12.7", "x", None], to_int) == [12, None, None, None]
    assert col_values(spark, ["1.5", "", "NaN", "abc"], to_double)[:2] == [1.5, None]


def test_required_fields_blank_rule(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("", "b"), ("  ", "b"), ("a", "\t")],
                               "f1 string, f2 string")
    got = [r[0] for r in df.select(first_missing(["f1", "f2"])).collect()]
    assert got == [None, "f1", "f1", "f1", "f2"]
    assert [r[0] for r in df.select(is_blank("f1")).collect()] == [False, True, True, True, False]


def test_iso_round_trip(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5),)], "ts timestamp_ntz")
    r = df.select(iso_utc("ts").alias("s")).select("s", parse_iso_utc("s").alias("t")).first()
    assert r.s == "2024-01-02T03:04:05Z" and r.t == dt.datetime(2024, 1, 2, 3, 4, 5)
    frac = spark.range(1).select(parse_iso_utc(F.lit("2024-01-02T03:04:05.123Z"))).first()[0]
    assert frac == dt.datetime(2024, 1, 2, 3, 4, 5, 123000)


def test_bucket_range_and_null_equals_empty(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "b string")
    for n in (1, 7):
        got = [r[0] for r in df.select(bucket("b", n)).collect()]
        assert all(0 <= g < n for g in got) and got[0] == got[1]
        got5 = [r[0] for r in df.select(bucket("b", n, "md5")).collect()]
        assert all(0 <= g < n for g in got5) and got5[0] == got5[1]
    assert [r[0] for r in df.select(bucket("b", 0)).collect()] == [None, None, None]


def test_bucket_survives_int_min_hash(spark):
    # abs() of the 32-bit hash is taken on a long, so no overflow under ANSI.
    got = spark.range(200000).select(bucket(F.col("id").cast("string"), 13).alias("b")) \
        .agg(F.min("b"), F.max("b")).first()
    assert got[0] == 0 and got[1] == 12


def test_severity_thresholds(spark):
    counts = [4, 5, 6, 9, 10, 11]
    df = spark.createDataFrame([(c,) for c in counts], "n long")
    out = df.filter(F.col("n") > 5).select("n", severity(F.col("n"), 5).alias("s")).orderBy("n")
    assert [(r.n, r.s) for r in out.collect()] == [(6, "MEDIUM"), (9, "MEDIUM"), (10, "HIGH"),
                                                   (11, "HIGH")]
    zero = spark.range(1).select(severity(F.lit(1), 0)).first()[0]
    assert zero == "HIGH"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789 -xD.", max_size=8), min_size=1, max_size=40))
def test_code_properties(spark, values):
    """Normalised codes are digits of width >= 3 and normalising twice is a no-op."""
    df = spark.createDataFrame([(v,) for v in values], "x string")
    out = df.select(normalize_code("x").alias("a")).select(
        "a", normalize_code("a").alias("b")).collect()
    for r in out:
        if r.a is not None:
            assert r.a.isdigit() and len(r.a) >= 3 and r.a == r.b


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=50),
       st.integers(min_value=1, max_value=97))
def test_bucket_properties(spark, values, n):
    """Both hash rules put every value (NULL included) in [0, n), deterministically."""
    df = spark.createDataFrame([(v,) for v in values], "b string")
    out = df.select(bucket("b", n).alias("m"), bucket("b", n, "md5").alias("d"),
                    bucket("b", n).alias("m2")).collect()
    for r in out:
        assert 0 <= r.m < n and 0 <= r.d < n and r.m == r.m2


@settings(max_examples=10, deadline=None)
@given(st.integers(min_value=0, max_value=100), st.lists(st.integers(min_value=0, max_value=500),
                                                         min_size=2, max_size=30))
def test_severity_monotone(spark, threshold, counts):
    """A larger count never gets a lower severity."""
    rank = {"MEDIUM": 1, "HIGH": 2}
    df = spark.createDataFrame([(c,) for c in sorted(counts)], "n long")
    got = [rank[r[0]] for r in df.orderBy("n").select(severity(F.col("n"), threshold)).collect()]
    assert got == sorted(got)


def test_scale_settings():
    from blotter.session import scale_settings
    small = scale_settings(10 * 1024 * 1024, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # two waves on 8 cores
    big = scale_settings(100 * 1024 ** 4, 8000)  # 100 TB on 1000 x 8 cores
    assert big["spark.sql.shuffle.partitions"] == "100000"  # capped; AQE coalesces
    mid = scale_settings(1024 ** 4, 800)  # 1 TB: 8192 splits of 128 MiB
    assert mid["spark.sql.shuffle.partitions"] == "8192"


def test_input_bytes_reads_metadata(spark):
    from blotter.session import input_bytes
    n = input_bytes(spark, ["/root/testdata/sf0.001/*.parquet"])
    assert n > 100_000


def test_numbers_must_be_finite(spark):
    assert col_values(spark, ["NaN", "Infinity", "-Infinity", "1e400", "-2.5"], to_double) == [None] * 4 + [-2.5]


def test_cleaned_codes_longer_than_three_digits_stay_apart(spark):
    from blotter.operators.cleaning import clean_stations
    raw = spark.createDataFrame([("1234", "a", "1", "2"), ("123", "b", "1", "2"), ("7", "c", "1", "2")],
                                "DISTRICT string, `DISTRICT NAME` string, LATITUDE string, LONGITUDE string")
    assert [r.district for r in clean_stations(raw).orderBy("station_name").collect()] == ["1234", "123", "007"]

"""The registered queries and their SQL oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs one operator of the
inventory over the driver tables at ``sf_dir``; ``ORACLE[name]`` is the same
result as DuckDB SQL over the same tables (absent for the rows-only keys).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.parse import (iso_utc, parse_boolean_strict, parse_event_time,
                               parse_iso_utc, to_bool, to_double, to_int, truthy)
from ..operators import cleaning, hotspots, linkage, rollups, windows
from ..schemas import (METRIC_AREA, METRIC_FLAG, METRIC_MIX_PREFIX, PAIR_DENSITY_COUNT,
                       PAIR_INCIDENT_RATE, RESULT_SCHEMAS)
from ..session import pin_utc
from . import standins as S
from .sql import bool_sql, code_sql, ctes, dbl_sql, int_sql, register_cte, ts_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


# ------------------------------------------------------------------ inputs
def crimes(spark, d):
    return cleaning.clean_crimes(S.raw_crimes(spark, d))


def arrests(spark, d):
    return linkage.dedup_key(cleaning.clean_arrests(S.raw_arrests(spark, d)),
                             "case_number", ["arrest_ts", "race"])


def joined(spark, d):
    return linkage.join_left_dedup(crimes(spark, d), arrests(spark, d), "case_number")


def stations(spark, d):
    return cleaning.clean_stations(S.raw_stations(spark, d))


def violence(spark, d):
    return cleaning.clean_violence(S.raw_violence(spark, d))


def registry(spark, d):
    return cleaning.clean_registry(S.raw_registry(spark, d))


def station_index(spark, d):
    return linkage.station_index(stations(spark, d))


# Hash method of the registry buckets in oracle-checked keys: MD5 is portable
# to DuckDB; the Murmur3 rule has its own key, ``bucket_murmur``.
ORACLE_HASH = "md5"

# Alert window, slide and threshold of the batch alert keys
# (1 h / 10 min / 5 on the driver's events table).
ALERT_SIZE_S, ALERT_SLIDE_S, ALERT_THRESHOLD = 3600, 600, 5

# ---------------------------------------------------------------- cleaning
@register("clean_events", ctes("SELECT * FROM crimes", "crimes"))
def q_clean_events(spark, d):
    """P1 + P6 over the crime stand-in."""
    return crimes(spark, d)


@register("clean_arrests", ctes("SELECT * FROM arrests_all", "arrests_all"))
def q_clean_arrests(spark, d):
    """P2 (before dedup)."""
    return cleaning.clean_arrests(S.raw_arrests(spark, d))


@register("clean_stations", ctes("SELECT * FROM stations", "stations"))
def q_clean_stations(spark, d):
    """P3 + P8."""
    return stations(spark, d)


@register("clean_violence", ctes("SELECT * FROM violence", "violence"))
def q_clean_violence(spark, d):
    """P4 + F11."""
    return violence(spark, d)


@register("clean_registry", ctes("SELECT * FROM registry", "registry"))
def q_clean_registry(spark, d):
    """P5."""
    return registry(spark, d)


@register("filter_geo", ctes(
    "SELECT case_number, latitude, longitude FROM crimes "
    "WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "crimes"))
def q_filter_geo(spark, d):
    """P7."""
    return cleaning.filter_geo(crimes(spark, d)).select("case_number", "latitude", "longitude")


# ------------------------------------------------------------------ trends
_TREND_SQL = {
    "year": "CAST(year(event_ts) AS VARCHAR)",
    "month": "CAST(month(event_ts) AS VARCHAR)",
    "day_of_week": "strftime(event_ts, '%a')",
    "hour": "CAST(hour(event_ts) AS VARCHAR)",
}


_DAYS_SQL = "[" + ", ".join(f"'{d}'" for d in rollups.DAY_NAMES) + "]"


def _trend_sql(kind: str) -> str:
    if kind == "district":
        body = ("SELECT 'district' AS trend_type, district AS period_value, district, "
                "count(*) AS crime_count FROM crimes WHERE district IS NOT NULL GROUP BY district")
    else:
        body = (f"SELECT '{kind}' AS trend_type, coalesce({_TREND_SQL[kind]}, 'UNKNOWN') AS period_value, "
                f"CAST(NULL AS VARCHAR) AS district, count(*) AS crime_count FROM crimes GROUP BY 2")
    order = (f"CAST(list_position({_DAYS_SQL}, period_value) AS INTEGER)" if kind == "day_of_week"
             else "TRY_CAST(period_value AS INTEGER)")
    return f"SELECT *, {order} AS period_order FROM ({body})"


for _key, _kind in [("trend_year", "year"), ("trend_month", "month"), ("trend_dow", "day_of_week"),
                    ("trend_hour", "hour"), ("trend_key", "district")]:
    def _make(kind):
        def q(spark, d):
            return rollups.trend(crimes(spark, d), kind)
        q.__doc__ = f"A1-A5: crime counts by {kind}."
        return q
    register(_key, ctes(_trend_sql(_kind), "crimes"))(_make(_kind))

_TREND_ALL_SQL = ctes(" UNION ALL ".join(f"({_trend_sql(k)})" for k in rollups.TREND_TYPES), "crimes")


@register("trend_all", _TREND_ALL_SQL)
def q_trend_all(spark, d):
    """A6 + U1 + P20: five trend sets, one scan (grouping sets)."""
    return rollups.trend_all(crimes(spark, d))


# ------------------------------------------------------------------- rates
def _rate_sql(group_type: str) -> str:
    return (f"SELECT '{group_type}' AS group_type, coalesce({group_type}, 'UNKNOWN') AS group_value, "
            f"count(*) AS crime_count, count(*) FILTER (WHERE arrest_ts IS NOT NULL) AS arrest_count, "
            f"count(*) FILTER (WHERE arrest_ts IS NOT NULL) / count(*) AS arrest_rate "
            f"FROM joined GROUP BY 2")


for _key, _g in [("rate_by_type", "primary_type"), ("rate_by_key", "district"),
                 ("rate_by_attr", "race")]:
    def _make_rate(g):
        def q(spark, d):
            return rollups.rate_by(joined(spark, d), g)
        q.__doc__ = f"A7 + J1 + P21: arrest rate by {g}."
        return q
    register(_key, ctes(_rate_sql(_g), "joined"))(_make_rate(_g))

_RATE_ALL_SQL = ctes(" UNION ALL ".join(f"({_rate_sql(g)})" for g in rollups.RATE_GROUPS), "joined")


@register("rate_all", _RATE_ALL_SQL)
def q_rate_all(spark, d):
    """A7 + U2: three rate groupings in one pass over the join."""
    return rollups.rate_all(joined(spark, d))


@register("join_left_dedup", ctes(
    "SELECT case_number, primary_type, district, arrest_ts, race FROM joined", "joined"))
def q_join_left_dedup(spark, d):
    """Crimes left-joined to deduplicated arrests (one row per crime)."""
    return joined(spark, d).select("case_number", "primary_type", "district", "arrest_ts", "race")


@register("join_left_split", ctes(
    "SELECT case_number, primary_type, district, arrest_ts, race FROM joined", "joined"))
def q_join_left_split(spark, d):
    """J1 with heavy case numbers dealt over many tasks."""
    return linkage.join_left_split(crimes(spark, d), arrests(spark, d), "case_number").select(
        "case_number", "primary_type", "district", "arrest_ts", "race")


@register("dedup_key", ctes("SELECT * FROM arrests", "arrests"))
def q_dedup_key(spark, d):
    """One arrest per case (earliest parsable time, then race)."""
    return arrests(spark, d)


# ----------------------------------------------------------------- metrics
_MIX_SQL = (f"SELECT '{METRIC_MIX_PREFIX}' || coalesce(incident_primary, 'UNKNOWN') AS metric, "
            "district, month AS period_value, CAST(NULL AS VARCHAR) AS community_area, "
            "count(*) AS incident_count, CAST(NULL AS DOUBLE) AS rate FROM violence GROUP BY 1, 2, 3")
_AREA_SQL = (f"SELECT '{METRIC_AREA}' AS metric, CAST(NULL AS VARCHAR) AS district, "
             "CAST(NULL AS VARCHAR) AS period_value, community_area, count(*) AS incident_count, "
             "CAST(NULL AS DOUBLE) AS rate FROM violence GROUP BY community_area")
_FLAG_SQL = (f"SELECT '{METRIC_FLAG}' AS metric, district, CAST(NULL AS VARCHAR) AS period_value, "
             "CAST(NULL AS VARCHAR) AS community_area, count(*) AS incident_count, "
             "avg(CASE WHEN gunshot_injury IN ('YES', 'Y') THEN 1.0 ELSE 0.0 END)::DOUBLE AS rate "
             "FROM violence GROUP BY district")


@register("mix_by_key_period", ctes(_MIX_SQL, "violence"))
def q_mix(spark, d):
    """A9 + F13."""
    return rollups.mix_by_key_period(violence(spark, d))


@register("count_by_area", ctes(_AREA_SQL, "violence"))
def q_count_by_area(spark, d):
    """A10."""
    return rollups.count_by_area(violence(spark, d))


@register("flag_proportion", ctes(_FLAG_SQL, "violence"))
def q_flag_proportion(spark, d):
    """A11."""
    return rollups.flag_proportion(violence(spark, d))


_METRICS_SQL = f"({_MIX_SQL}) UNION ALL ({_AREA_SQL}) UNION ALL ({_FLAG_SQL})"


@register("metrics_all", ctes(_METRICS_SQL,
                              "violence"))
def q_metrics_all(spark, d):
    """The three metric sets with NULL padding."""
    return rollups.metrics_all(violence(spark, d))


@register("count_by_key", ctes(
    "SELECT district, count(*) AS crime_count FROM crimes GROUP BY district", "crimes"))
def q_count_by_key(spark, d):
    """A12."""
    return rollups.count_by_key(crimes(spark, d))


# ---------------------------------------------------------------- linkage
@register("dim_index", ctes("SELECT * FROM station_index", "station_index"))
def q_dim_index(spark, d):
    """A13 + U5 + T7: distinct stations numbered 0..N-1 in order."""
    return station_index(spark, d)


def _bucket_sql(method: str) -> str:
    assert method == "md5"
    return ("(('0x' || substr(md5(coalesce(block, '')), 1, 8))::BIGINT "
            "% (SELECT count(*) FROM station_index))")


register_cte("density", f"""
SELECT i.district, i.station_name, count(*) AS offender_count,
       count(*) FILTER (WHERE r.victim_minor = 'Y') AS priority_minor_victim_count
FROM (SELECT {_bucket_sql('md5')} AS district_index, victim_minor FROM registry) r
JOIN station_index i USING (district_index)
GROUP BY i.district, i.station_name
""", ["registry", "station_index"])


def density(spark, d):
    return linkage.bucket_density(registry(spark, d), station_index(spark, d), ORACLE_HASH)


@register("bucket_density", ctes("SELECT * FROM density", "density"))
def q_bucket_density(spark, d):
    """J2 + A14: registry rows per station through hash buckets."""
    return density(spark, d)


@register("bucket_md5", ctes(
    f"SELECT {_bucket_sql('md5')} AS bucket, count(*) AS row_count FROM registry GROUP BY 1",
    "registry", "station_index"))
def q_bucket_md5(spark, d):
    """F16 (portable hash): registry rows per bucket, N = number of stations."""
    n = station_index(spark, d).select(F.count(F.lit(1))).scalar()
    return linkage.bucket_counts(registry(spark, d), n, "md5")


def _rotl(x: str, r: int) -> str:
    return f"(({x} << {r}) | ({x} >> {32 - r})) & 4294967295"


# Murmur3 (32 bits, seed 42) of UTF-8 text: words of four bytes, then the bytes
# that are left one by one, as signed numbers. Its constants.
_BYTE = "('0x' || substr(x, (2 * ({}) + 1)::BIGINT, 2))::UBIGINT"
_MURMUR_SQL = f"""
b AS (SELECT block, hex(coalesce(block, '')) AS x, (length(hex(coalesce(block, ''))) // 2)::BIGINT AS n FROM registry),
k AS (SELECT block, n, list_concat(
        list_transform(range(n // 4), lambda i: {' + '.join(f"({_BYTE.format(f'4 * i + {j}')} << {8 * j})" for j in range(4))}),
        list_transform(range(n // 4 * 4, n), lambda i: {_BYTE.format('i')} + CASE WHEN {_BYTE.format('i')} > 127 THEN 4294967040 ELSE 0 END)) AS ks FROM b),
m AS (SELECT block, n, list_transform(list_transform(list_transform(ks, lambda k: (k * 3432918353::UBIGINT) & 4294967295),
        lambda k: {_rotl('k', 15)}), lambda k: (k * 461845907::UBIGINT) & 4294967295) AS ks FROM k),
h0 AS (SELECT block, xor(list_reduce(list_prepend(42::UBIGINT, ks),
        lambda h, k: (({_rotl('xor(h, k)', 13)}) * 5 + 3864292196) & 4294967295), n::UBIGINT) AS h FROM m),
h1 AS (SELECT block, (xor(h, h >> 16) * 2246822507::UBIGINT) & 4294967295 AS h FROM h0),
h2 AS (SELECT block, (xor(h, h >> 13) * 3266489909::UBIGINT) & 4294967295 AS h FROM h1),
h3 AS (SELECT block, xor(h, h >> 16)::BIGINT AS h FROM h2)
SELECT abs(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % (SELECT count(*) FROM station_index) AS bucket,
       count(*) AS row_count FROM h3 GROUP BY 1"""


@register("bucket_murmur", ctes("", "registry", "station_index").rstrip() + "," + _MURMUR_SQL)
def q_bucket_murmur(spark, d):
    """F16 (the rule of the batch job, Murmur3): registry rows per bucket."""
    n = station_index(spark, d).select(F.count(F.lit(1))).scalar()
    return linkage.bucket_counts(registry(spark, d), n, "murmur")


# ------------------------------------------------------------------ pairs
_PAIR1_SQL = f"""
SELECT '{PAIR_INCIDENT_RATE}' AS correlation_name, v.district AS group_key,
       CAST(v.violence_count AS DOUBLE) AS x_value, CAST(r.arrest_rate AS DOUBLE) AS y_value
FROM (SELECT district, count(*) AS violence_count FROM violence GROUP BY district) v
JOIN (SELECT coalesce(district, 'UNKNOWN') AS district,
             count(*) FILTER (WHERE arrest_ts IS NOT NULL) / count(*) AS arrest_rate
      FROM joined GROUP BY 1) r ON v.district = r.district
"""
_PAIR2_SQL = f"""
SELECT '{PAIR_DENSITY_COUNT}' AS correlation_name, o.district AS group_key,
       CAST(o.offender_count AS DOUBLE) AS x_value, CAST(coalesce(c.crime_count, 0) AS DOUBLE) AS y_value
FROM density o LEFT JOIN (SELECT district, count(*) AS crime_count FROM crimes GROUP BY district) c
  ON o.district = c.district
"""


def pairs(spark, d):
    incidents = rollups.count_by_key(violence(spark, d), "district", "violence_count")
    return linkage.pairs_all(incidents, density(spark, d), linkage.district_rates(joined(spark, d)))


@register("pair_incident_vs_rate", ctes(_PAIR1_SQL, "violence", "joined"))
def q_pair1(spark, d):
    """J3 + P10 + P22."""
    return linkage.pair_incident_vs_rate(violence(spark, d), joined(spark, d))


@register("pair_density_vs_count", ctes(_PAIR2_SQL, "density", "crimes"))
def q_pair2(spark, d):
    """J4."""
    return linkage.pair_density_vs_count(density(spark, d), crimes(spark, d))


_PAIRS_SQL = f"({_PAIR1_SQL}) UNION ALL ({_PAIR2_SQL})"


@register("pairs_all", ctes(_PAIRS_SQL,
                            "violence", "joined", "density", "crimes"))
def q_pairs_all(spark, d):
    """U4 + M5: both paired series."""
    return pairs(spark, d)


@register("pairs_corr", ctes(
    f"SELECT correlation_name, round(corr(x_value, y_value), 9) AS corr, count(*) AS n_pairs "
    f"FROM (({_PAIR1_SQL}) UNION ALL ({_PAIR2_SQL})) GROUP BY correlation_name",
    "violence", "joined", "density", "crimes"))
def q_pairs_corr(spark, d):
    """M5 summary: correlation per paired series."""
    return linkage.pairs_corr(pairs(spark, d))


# --------------------------------------------------------------- hotspots
# Five centres inside the stand-in coordinate range.
FIXED_CENTRES = [(41.6, -87.85), (41.7, -87.75), (41.8, -87.65), (41.9, -87.55), (41.95, -87.8)]

_CENTRES_SQL = " UNION ALL ".join(
    f"SELECT {i} AS cid, {a} AS clat, {b} AS clon" for i, (a, b) in enumerate(FIXED_CENTRES))


@register("assign_nearest", ctes(f"""
SELECT CAST(cid AS INTEGER) AS cluster_id, count(*) AS crime_count FROM (
  SELECT case_number, cid, row_number() OVER (
           PARTITION BY case_number
           ORDER BY (latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon), cid) AS rn
  FROM (SELECT * FROM crimes WHERE latitude IS NOT NULL AND longitude IS NOT NULL) p,
       ({_CENTRES_SQL}) c) WHERE rn = 1
GROUP BY cid""", "crimes"))
def q_assign_nearest(spark, d):
    """M3 + A15: points per nearest fixed centre."""
    return hotspots.assign_nearest(crimes(spark, d), FIXED_CENTRES)


@register("hotspots_kmeans")
def q_hotspots(spark, d):
    """M1-M4 + J5: K-Means (k=10, seed 4109) centres with their sizes."""
    return hotspots.kmeans_hotspots(crimes(spark, d))


@register("hotspots_invariants", ctes(
    f"""SELECT * FROM (VALUES ('centres', CAST({hotspots.KMEANS_K} AS BIGINT)), ('sizes_of_nearest', {hotspots.KMEANS_K}),
        ('at_mean_of_nearest', {hotspots.KMEANS_K}), ('served_in_order', {hotspots.KMEANS_K})) t(item, n)
        UNION ALL SELECT 'points', count(*) FROM crimes WHERE latitude IS NOT NULL AND longitude IS NOT NULL""", "crimes"))
def q_hotspots_invariants(spark, d):
    """M2 + M4 + J5 + T4: once the centres have settled (up to 200 iterations),
    every stored centre is the mean of its nearest points (to a thousandth of the
    map's width), its size is their number, all points are counted, and the
    served centres are in id order."""
    return hotspots.invariants(crimes(spark, d), hotspots.kmeans_hotspots(crimes(spark, d), max_iter=200))


@register("hotspots_totals", ctes(
    f"SELECT CAST({hotspots.KMEANS_K} AS BIGINT) AS n_clusters, count(*) AS crime_count "
    f"FROM crimes WHERE latitude IS NOT NULL AND longitude IS NOT NULL", "crimes"))
def q_hotspots_totals(spark, d):
    """M2-M4 invariants: k centres, and every point with both coordinates is
    counted in exactly one cluster (the centres themselves are checked by
    the rows-only ``hotspots_kmeans``)."""
    spots = hotspots.kmeans_hotspots(crimes(spark, d))
    return spots.agg(F.count(F.lit(1)).alias("n_clusters"),
                     F.sum("crime_count").alias("crime_count"))


# ---------------------------------------------------------- windows/alerts
def events(spark, d):
    return S.table(spark, d, "events").select("event_id", "ts", "event_type")


def _window_sql(src: str, key: str, ts: str, size: int, slide: int) -> str:
    steps = size // slide
    return f"""
SELECT {key}, window_start, window_start + to_seconds({size}) AS window_end, count(*) AS event_count
FROM (SELECT {key}, time_bucket(to_seconds({slide}), {ts}) - to_seconds(i * {slide}) AS window_start
      FROM {src}, range(0, {steps}) r(i) WHERE {ts} IS NOT NULL)
GROUP BY {key}, window_start"""


def _alerts_sql(counts_sql: str, key: str, threshold: int) -> str:
    return f"""
SELECT {key} AS district, window_end AS alert_timestamp, event_count,
       CAST({threshold} AS BIGINT) AS threshold_value,
       CASE WHEN event_count >= {2 * threshold} THEN 'HIGH' ELSE 'MEDIUM' END AS severity
FROM ({counts_sql}) WHERE event_count > {threshold}"""


_WC_SQL = _window_sql("events", "event_type", "ts", ALERT_SIZE_S, ALERT_SLIDE_S)


@register("window_counts", _WC_SQL)
def q_window_counts(spark, d):
    """A17 + W1: event counts per (type, 1 h window sliding by 10 min)."""
    return windows.window_counts(events(spark, d), "ts", "event_type", ALERT_SIZE_S, ALERT_SLIDE_S)


@register("window_counts_panes", _WC_SQL)
def q_window_counts_panes(spark, d):
    """A17 + W1, pane-summed: 10 min tumbling counts summed into 1 h windows."""
    return windows.window_counts(events(spark, d), "ts", "event_type", ALERT_SIZE_S,
                                 ALERT_SLIDE_S, method="panes")


def batch_alerts(spark, d):
    counts = windows.window_counts(events(spark, d), "ts", "event_type", ALERT_SIZE_S,
                                   ALERT_SLIDE_S, method="panes")
    return windows.to_alerts(counts, ALERT_THRESHOLD, "event_type")


_ALERTS_SQL = _alerts_sql(_WC_SQL, "event_type", ALERT_THRESHOLD)


@register("alerts_batch", _ALERTS_SQL)
def q_alerts_batch(spark, d):
    """W6 + P15 + F17 + W7: threshold alerts over the window counts."""
    return batch_alerts(spark, d)


# -------------------------------------------------------------- scalars
def _code_inputs(spark, d) -> DataFrame:
    """Raw code spellings derived from the customer table (F1-F3 inputs)."""
    c = S.table(spark, d, "customer")
    nk, ck = F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")
    variants = F.array(
        nk, F.concat(nk, F.lit(".0")), F.concat(F.lit("D-"), nk, F.lit("x"), ck),
        ck, F.concat(F.lit(" "), nk, F.lit(" ")), F.concat(F.lit("00"), nk),
        F.when(F.col("c_acctbal") < 0, F.lit("HQ")).otherwise(F.col("c_mktsegment")),
        F.concat(ck, F.lit("99999999999")))
    return c.select(F.explode(variants).alias("raw"))


_CODE_INPUTS_SQL = """
SELECT unnest([CAST(c_nationkey AS VARCHAR), CAST(c_nationkey AS VARCHAR) || '.0',
               'D-' || CAST(c_nationkey AS VARCHAR) || 'x' || CAST(c_custkey AS VARCHAR),
               CAST(c_custkey AS VARCHAR), ' ' || CAST(c_nationkey AS VARCHAR) || ' ',
               '00' || CAST(c_nationkey AS VARCHAR),
               CASE WHEN c_acctbal < 0 THEN 'HQ' ELSE c_mktsegment END,
               CAST(c_custkey AS VARCHAR) || '99999999999']) AS raw
FROM customer
"""
register_cte("code_inputs", _CODE_INPUTS_SQL, [])


@register("fn_normalize_code", ctes(f"""
SELECT raw, {code_sql('raw')} AS code_batch,
       CASE WHEN length(regexp_extract(trim(raw), '(\\d+)', 1)) >= 3 THEN regexp_extract(trim(raw), '(\\d+)', 1)
            WHEN length(regexp_extract(trim(raw), '(\\d+)', 1)) > 0 THEN lpad(regexp_extract(trim(raw), '(\\d+)', 1), 3, '0')
       END AS code_whole,
       count(*) AS n
FROM code_inputs GROUP BY ALL""", "code_inputs"))
def q_fn_normalize_code(spark, d):
    """batch rule (lpad parity and the non-truncating default)."""
    x = _code_inputs(spark, d)
    return x.groupBy("raw", codes.batch_code("raw").alias("code_batch"),
                     codes.normalize_code("raw").alias("code_whole")).agg(
        F.count(F.lit(1)).alias("n"))


@register("fn_normalize_code_stream", ctes("""
SELECT raw, CASE WHEN length(regexp_replace(raw, '\\D', '', 'g')) = 0 THEN '000'
                 WHEN TRY_CAST(regexp_replace(raw, '\\D', '', 'g') AS INTEGER) IS NULL THEN NULL
                 ELSE format('{:03d}', TRY_CAST(regexp_replace(raw, '\\D', '', 'g') AS INTEGER)) END
       AS code_stream, count(*) AS n
FROM code_inputs GROUP BY ALL""", "code_inputs"))
def q_fn_normalize_code_stream(spark, d):
    """stream rule (all digits, %03d, 000 sentinel, NULL on overflow)."""
    x = _code_inputs(spark, d)
    return x.groupBy("raw", codes.stream_code("raw").alias("code_stream")).agg(
        F.count(F.lit(1)).alias("n"))


@register("fn_zfill", ctes("""
SELECT raw, CASE WHEN length(trim(raw)) < 3 THEN lpad(trim(raw), 3, '0') ELSE trim(raw) END AS code_zfill,
       count(*) AS n
FROM code_inputs GROUP BY ALL""", "code_inputs"))
def q_fn_zfill(spark, d):
    """producer rule strip + zfill(3)."""
    x = _code_inputs(spark, d)
    return x.groupBy("raw", codes.zfill_code("raw").alias("code_zfill")).agg(
        F.count(F.lit(1)).alias("n"))


@register("fn_parse_ts", ctes(f"""
SELECT "Date" AS raw, {ts_sql('"Date"')} AS event_ts, CAST(hour({ts_sql('"Date"')}) AS INTEGER) AS hour,
       strftime({ts_sql('"Date"')}, '%a') AS dow, count(*) AS n
FROM raw_crimes GROUP BY ALL""", "raw_crimes"))
def q_fn_parse_ts(spark, d):
    """F4 + F5: 12-hour text times to timestamps, hour and day name."""
    raw = S.raw_crimes(spark, d)
    ts = parse_event_time("Date")
    return raw.groupBy(F.col("Date").alias("raw"), ts.alias("event_ts"),
                       F.hour(ts).alias("hour"), F.date_format(ts, "E").alias("dow")).agg(
        F.count(F.lit(1)).alias("n"))


@register("fn_try_casts", ctes(f"""
SELECT "Arrest" AS raw_bool, {bool_sql('"Arrest"')} AS as_bool, "Year" AS raw_int, {int_sql('"Year"')} AS as_int,
       "Latitude" AS raw_double, {dbl_sql('"Latitude"')} AS as_double, count(*) AS n
FROM raw_crimes GROUP BY ALL""", "raw_crimes"))
def q_fn_try_casts(spark, d):
    """F6 + F10: text to boolean / int / double, NULL when malformed."""
    raw = S.raw_crimes(spark, d)
    return raw.groupBy(F.col("Arrest").alias("raw_bool"), to_bool("Arrest").alias("as_bool"),
                       F.col("Year").alias("raw_int"), to_int("Year").alias("as_int"),
                       F.col("Latitude").alias("raw_double"),
                       to_double("Latitude").alias("as_double")).agg(F.count(F.lit(1)).alias("n"))


# Spellings the truthy tests are run over.
TRUTH_TOKENS = ["true", "T", "1", "yes", "Y", " true ", "on", "maybe", "TRUE", "false", ""]
_TOKENS_SQL = "[" + ", ".join(f"'{t}'" for t in TRUTH_TOKENS) + "]"


@register("fn_truthy", f"""
SELECT raw,
       coalesce(lower(trim(raw)) IN ('true','t','1','yes','y'), false) AS truthy,
       coalesce(lower(raw) = 'true', false) AS parse_boolean,
       {bool_sql('raw')} AS cast_boolean, count(*) AS n
FROM (SELECT {_TOKENS_SQL}[1 + (o_orderkey % {len(TRUTH_TOKENS)})] AS raw FROM orders)
GROUP BY ALL""")
def q_fn_truthy(spark, d):
    """F8 + F9 + F6: the three boolean readings side by side."""
    o = S.table(spark, d, "orders")
    tokens = F.array(*[F.lit(t) for t in TRUTH_TOKENS])
    raw = F.element_at(tokens, (F.col("o_orderkey") % len(TRUTH_TOKENS) + 1).cast("int"))
    x = o.select(raw.alias("raw"))
    return x.groupBy("raw", truthy("raw").alias("truthy"),
                     parse_boolean_strict("raw").alias("parse_boolean"),
                     to_bool("raw").alias("cast_boolean")).agg(F.count(F.lit(1)).alias("n"))


@register("fn_iso_utc", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
       try_strptime(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') AS parsed
FROM events""")
def q_fn_iso_utc(spark, d):
    """F21 + F22: UTC ISO text with Z, and back."""
    e = S.table(spark, d, "events")
    iso = iso_utc("ts")
    return e.select("event_id", iso.alias("iso"), parse_iso_utc(iso).alias("parsed"))


register_cte("trend_all", " UNION ALL ".join(f"({_trend_sql(k)})" for k in rollups.TREND_TYPES),
             ["crimes"])


@register("check_not_null", ctes("""
SELECT 'crime_trends' AS table_name, 'trend_type' AS column_name,
       count(*) FILTER (WHERE trend_type IS NULL) AS null_count FROM trend_all
UNION ALL SELECT 'crime_trends', 'period_value', count(*) FILTER (WHERE period_value IS NULL) FROM trend_all
UNION ALL SELECT 'crime_trends', 'crime_count', count(*) FILTER (WHERE crime_count IS NULL) FROM trend_all
""", "trend_all"))
def q_check_not_null(spark, d):
    """K8: NULL counts of the NOT NULL columns of the trend table."""
    out = cleaning.check_not_null(rollups.trend_all(crimes(spark, d)), RESULT_SCHEMAS["crime_trends"])
    return out.select(F.lit("crime_trends").alias("table_name"), "column_name", "null_count")


def flagship_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``entry()``: 1 day windows sliding by 6 h, threshold 2, per event type."""
    pin_utc(spark)
    counts = windows.window_counts(events(spark, sf_dir), "ts", "event_type", 86400, 21600,
                                   method="panes")
    return windows.to_alerts(counts, 2, "event_type")


# Source, stream, sink and serving keys register themselves on import.
from . import io_queries, topology_queries  # noqa: E402,F401

"""Plan properties that matter at scale, asserted on the physical plans."""

from __future__ import annotations

import pytest

from blotter.operators import linkage, rollups
from blotter.plans import catalog, standins
from blotter.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# Keys whose callables run a stream or write files before returning; their
# returned frame is a read of the sink, so their plans say nothing here.
EAGER = {"src_csv_typed", "stream_replay_events", "stream_select", "stream_window_counts",
         "stream_alerts", "stream_dual_sink", "stream_raw_archive", "stream_dedup",
         "stream_late_drop", "stream_arrival_windows", "sink_table_overwrite",
         "sink_table_append", "sink_json_alerts", "serve_alert_docs", "batch_job",
         "hotspots_kmeans", "serve_hotspots"} | {
             k for k in QUERIES if k.startswith(("stream_", "serve_"))} | {"src_csv_quarantine", "first_in_file_order", "load_stamp"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def before_exchange(text: str, op: str) -> bool:
    """``op`` appears below (i.e. before) the first Exchange of the plan."""
    lines = text.splitlines()
    ex = [i for i, line in enumerate(lines) if "Exchange" in line]
    return any(op in line for line in lines[ex[0]:]) if ex else False


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in EAGER))
def test_no_python_udf_or_cross_join(spark, key):
    text = plan(QUERIES[key](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in text, (key, bad)


def test_dedup_combines_map_side(spark):
    text = plan(catalog.arrests(spark, SF_SMALL))
    assert "partial_min" in text and before_exchange(text, "partial_min")


def test_rollups_combine_map_side_and_scan_once(spark):
    crimes = catalog.crimes(spark, SF_SMALL)
    text = plan(rollups.trend_all(crimes))
    assert "partial_count" in text
    assert text.count("orders.parquet") == 1  # one scan feeds all five rollups
    rates = plan(rollups.rate_all(catalog.joined(spark, SF_SMALL)))
    assert rates.count("orders.parquet") == 1 and rates.count("lineitem.parquet") == 1


def test_union_form_scans_per_branch(spark):
    text = plan(rollups.trend_all(catalog.crimes(spark, SF_SMALL), method="union"))
    assert text.count("orders.parquet") == len(rollups.TREND_TYPES)


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    raw = standins.raw_arrests(spark, SF_SMALL)
    text = raw._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in text
    assert "l_extendedprice" not in text and len(df.columns) > 8


def test_window_panes_combine_map_side(spark):
    from blotter.operators import windows
    e = catalog.events(spark, SF_SMALL)
    text = plan(windows.window_counts(e, "ts", "event_type", 3600, 600, method="panes"))
    assert text.count("partial_count") == 1 and "partial_sum" in text


def test_dense_index_broadcast_is_per_partition(spark):
    idx = linkage.dense_index(spark.range(100).toDF("k"), ["k"], "i")
    text = plan(idx)
    # the only broadcast is the offsets table: one row per partition
    assert text.count("BroadcastExchange") == 1 and "_offset" in text


def test_left_join_reuses_dedup_partitioning(spark):
    """Without broadcast (the large-data shape) the sort-merge join needs one
    exchange per side on the key: the arrest side's is the dedup's own."""
    old_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(catalog.joined(spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_bc)
        spark.conf.set("spark.sql.adaptive.enabled", old_aqe)
    assert "SortMergeJoin" in text and "LeftOuter" in text
    assert text.count("Exchange hashpartitioning(case_number") == 2


def test_shared_aggregates_scan_each_input_once(spark):
    """The metric sets are one pass over the violence rows; both paired series
    share the district rates (orders are read once, by the join)."""
    metrics = plan(rollups.metrics_all(catalog.violence(spark, SF_SMALL)))
    assert metrics.count("lineitem.parquet") == 1 and metrics.count("Expand") == 1
    assert plan(rollups.metrics_all(catalog.violence(spark, SF_SMALL), "union")).count("lineitem.parquet") == 3
    pairs = plan(catalog.pairs(spark, SF_SMALL))
    assert pairs.count("orders.parquet") == 1 and pairs.count("lineitem.parquet") == 2  # arrests and violence


def test_metric_forms_agree_with_null_keys(spark):
    rows = [("HOMICIDE", "Y", "001", "1", "A"), (None, "NO", None, None, None), (None, None, "001", "1", None), ("BATTERY", "YES", None, "2", "A")]
    v = spark.createDataFrame(rows, "incident_primary string, gunshot_injury string, district string, month string, community_area string")
    a, b = rollups.metrics_all(v), rollups.metrics_all(v, "union")
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_left_join_splits_heavy_keys(spark):
    """Half of the facts on one case number and a quarter on none: every task of
    the sort-merge join gets about the same number of rows."""
    from pyspark.sql import functions as F
    facts = spark.range(40_000).select(
        F.when(F.col("id") % 4 < 2, F.lit("JC1")).when(F.col("id") % 4 == 2, F.concat(F.lit("K"), F.col("id"))).alias("case_number"), "id")
    dim = spark.range(30_000).select(F.when(F.col("id") == 7, F.lit("JC1")).otherwise(F.concat(F.lit("K"), F.col("id"))).alias("case_number"),
                                     F.col("id").alias("arrest"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert list(linkage.heavy_keys(facts, "case_number", 16)) == ["JC1"]
        out = linkage.join_left_split(facts, dim, "case_number")
        assert "SortMergeJoin" in plan(out)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect())
        whole = sorted(r["count"] for r in linkage.join_left_dedup(facts, dim, "case_number").groupBy(F.spark_partition_id().alias("p")).count().collect())
        same = linkage.join_left_dedup(facts, dim, "case_number")
        assert out.exceptAll(same).count() == 0 and same.exceptAll(out).count() == 0 and out.columns == same.columns
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2] and whole[-1] > 10 * whole[len(whole) // 2]

"""Calendar and categorical rollups, rates and proportions.

Every rollup is a partial + final hash aggregate, so a hot key (one value with
a third of the rows) is combined map-side before the shuffle and never lands
whole in one task. Multi-way rollups read their input once: each row is
stacked into one (type, value) pair per rollup and a single aggregate counts
them. Grouping-set and union forms are kept for the benchmark comparison.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import METRIC_AREA, METRIC_FLAG, METRIC_MIX_PREFIX, UNKNOWN, YES_FLAGS

# Trend types of the reference, in its order.
TREND_TYPES = ["year", "month", "day_of_week", "hour", "district"]
# Day names as ``date_format(ts, "E")`` writes them, Sunday first
# (the numbering of ``dayofweek``).
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def period_order(trend_type: Column, period_value: Column) -> Column:
    """Numeric sort key of a text period: the number itself
    for year, month, hour and district codes, 1-7 from Sunday for day names,
    NULL for ``UNKNOWN``. ``period_value`` stays text, as the table holds it."""
    day = F.nullif(F.array_position(F.array(*[F.lit(d) for d in DAY_NAMES]), period_value),
                   F.lit(0)).cast("int")
    return F.when(trend_type == "day_of_week", day).otherwise(period_value.try_cast("int"))


def _with_order(df: DataFrame) -> DataFrame:
    return df.select("trend_type", "period_value", "district", "crime_count",
                     period_order(F.col("trend_type"), F.col("period_value")).alias("period_order"))


def _period(kind: str, ts: str, key: str) -> Column:
    t = F.col(ts)
    if kind == "year":
        return F.year(t).cast("string")
    if kind == "month":
        return F.month(t).cast("string")
    if kind == "day_of_week":
        return F.date_format(t, "E")
    if kind == "hour":
        return F.hour(t).cast("string")
    if kind == "district":
        return F.col(key)
    raise ValueError(f"unknown trend type {kind!r}")


def trend(df: DataFrame, kind: str, ts: str = "event_ts", key: str = "district") -> DataFrame:
    """A1-A5: count per calendar period (or per non-null key for ``district``).

    NULL periods (unparsable times) are reported as ``UNKNOWN`` so the result
    satisfies the NOT NULL column of the trend table.
    """
    if kind == "district":
        out = (df.filter(F.col(key).isNotNull())
                 .groupBy(F.col(key).alias("period_value"))
                 .agg(F.count(F.lit(1)).alias("crime_count"))
                 .withColumn("district", F.col("period_value")))
    else:
        out = (df.groupBy(F.coalesce(_period(kind, ts, key), F.lit(UNKNOWN)).alias("period_value"))
                 .agg(F.count(F.lit(1)).alias("crime_count"))
                 .withColumn("district", F.lit(None).cast("string")))
    return _with_order(out.select(F.lit(kind).alias("trend_type"), "period_value", "district",
                                  "crime_count"))


def trend_all(df: DataFrame, ts: str = "event_ts", key: str = "district",
              method: str = "grouping_sets") -> DataFrame:
    """The five trend rollups as one table.

    ``grouping_sets`` (default): one scan, one Expand, one aggregate.
    ``stack``: each row becomes five (type, value) pairs inside the
    scan stage and one partial aggregate on those two columns combines them,
    so one scan feeds all five rollups and the shuffle carries about one row
    per distinct (type, value) per task, whatever the input size.
    ``union`` is one scan per rollup.
    """
    if method == "union":
        return reduce(DataFrame.unionByName, [trend(df, k, ts, key) for k in TREND_TYPES])
    if method == "stack":
        pairs = F.array(*[F.struct(F.lit(k).alias("trend_type"),
                                   (F.coalesce(_period(k, ts, key), F.lit(UNKNOWN)) if k != "district"
                                    else F.col(key)).alias("period_value"))
                          for k in TREND_TYPES])
        stacked = df.select(F.inline(pairs)).filter(
            F.col("period_value").isNotNull())  # only the district trend has NULLs; they are dropped
        out = stacked.groupBy("trend_type", "period_value").agg(
            F.count(F.lit(1)).alias("crime_count"))
        return _with_order(out.select(
            "trend_type", "period_value",
            F.when(F.col("trend_type") == "district", F.col("period_value"))
             .otherwise(F.lit(None).cast("string")).alias("district"),
            "crime_count"))
    cols = {k: F.coalesce(_period(k, ts, key), F.lit(UNKNOWN)) if k != "district"
            else F.col(key) for k in TREND_TYPES}
    keyed = df.select(*[c.alias(f"p_{k}") for k, c in cols.items()])
    names = [f"p_{k}" for k in TREND_TYPES]
    agg = keyed.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.count(F.lit(1)).alias("crime_count"),
        *[F.grouping(n).alias(f"g_{n}") for n in names])
    kind = reduce(lambda acc, k: acc.when(F.col(f"g_p_{k}") == 0, F.lit(k)),
                  TREND_TYPES[1:], F.when(F.col("g_p_year") == 0, F.lit("year")))
    period = F.coalesce(*[F.when(F.col(f"g_p_{k}") == 0, F.col(f"p_{k}")) for k in TREND_TYPES])
    out = agg.select(kind.alias("trend_type"), period.alias("period_value"), "crime_count")
    # The district trend counts non-null keys only; its NULL group is dropped.
    out = out.filter(F.col("period_value").isNotNull())
    return _with_order(out.select(
        "trend_type", "period_value",
        F.when(F.col("trend_type") == "district", F.col("period_value"))
         .otherwise(F.lit(None).cast("string")).alias("district"),
        "crime_count"))


# Group keys of the arrest-rate table: group_type -> column of the joined rows.
RATE_GROUPS = {"primary_type": "primary_type", "district": "district", "race": "race"}


def _rate_cols(df: DataFrame, flag: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("crime_count"), F.count_if(flag).alias("arrest_count")]


def _with_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("arrest_rate", F.try_divide(F.col("arrest_count"), F.col("crime_count")))


def rate_by(joined: DataFrame, group_type: str, column: str | None = None,
            flag: Column | None = None) -> DataFrame:
    """Crimes, arrests and their ratio per value of one group key.

    An arrest is a joined arrest row with a parsable time (SURVEY 1.5.7).
    """
    column = column or RATE_GROUPS[group_type]
    flag = flag if flag is not None else F.col("arrest_ts").isNotNull()
    out = joined.groupBy(F.coalesce(F.col(column), F.lit(UNKNOWN)).alias("group_value")).agg(
        *_rate_cols(joined, flag))
    return _with_rate(out.select(F.lit(group_type).alias("group_type"), "group_value",
                                 "crime_count", "arrest_count"))


def rate_all(joined: DataFrame, method: str = "grouping_sets") -> DataFrame:
    """The three rate groupings as one table, one pass over the join
    (``grouping_sets``, the fastest measured; ``stack`` as in ``trend_all`` and
    ``union`` kept)."""
    if method == "union":
        return reduce(DataFrame.unionByName, [rate_by(joined, g) for g in RATE_GROUPS])
    if method == "stack":
        pairs = F.array(*[F.struct(F.lit(g).alias("group_type"),
                                   F.coalesce(F.col(c), F.lit(UNKNOWN)).alias("group_value"))
                          for g, c in RATE_GROUPS.items()])
        stacked = joined.select(F.inline(pairs), F.col("arrest_ts").isNotNull().alias("arrested"))
        out = stacked.groupBy("group_type", "group_value").agg(
            F.count(F.lit(1)).alias("crime_count"),
            F.count_if(F.col("arrested")).alias("arrest_count"))
        return _with_rate(out)
    names = list(RATE_GROUPS)
    keyed = joined.select(
        *[F.coalesce(F.col(RATE_GROUPS[g]), F.lit(UNKNOWN)).alias(f"k_{g}") for g in names],
        F.col("arrest_ts").isNotNull().alias("arrested"))
    knames = [f"k_{g}" for g in names]
    agg = keyed.groupingSets([[F.col(k)] for k in knames], *knames).agg(
        F.count(F.lit(1)).alias("crime_count"),
        F.count_if(F.col("arrested")).alias("arrest_count"),
        *[F.grouping(k).alias(f"g_{k}") for k in knames])
    gtype = reduce(lambda acc, g: acc.when(F.col(f"g_k_{g}") == 0, F.lit(g)), names[1:],
                   F.when(F.col(f"g_k_{names[0]}") == 0, F.lit(names[0])))
    gval = F.coalesce(*[F.when(F.col(f"g_k_{g}") == 0, F.col(f"k_{g}")) for g in names])
    return _with_rate(agg.select(gtype.alias("group_type"), gval.alias("group_value"),
                                 "crime_count", "arrest_count"))


# ------------------------------------------------------------ violence metrics
METRIC_COLUMNS = ["metric", "district", "period_value", "community_area", "incident_count", "rate"]


def mix_by_key_period(v: DataFrame, prefix: str = METRIC_MIX_PREFIX,
                      label: str = "incident_primary", key: str = "district",
                      period: str = "month") -> DataFrame:
    """Count by (prefixed label, key, period)."""
    out = v.groupBy(
        F.concat(F.lit(prefix), F.coalesce(F.col(label), F.lit(UNKNOWN))).alias("metric"),
        F.col(key).alias("district"), F.col(period).alias("period_value"),
    ).agg(F.count(F.lit(1)).alias("incident_count"))
    return out.select("metric", "district", "period_value",
                      F.lit(None).cast("string").alias("community_area"), "incident_count",
                      F.lit(None).cast("double").alias("rate"))


def count_by_area(v: DataFrame, area: str = "community_area",
                  metric: str = METRIC_AREA) -> DataFrame:
    """A10: full count per area (no sort or limit, as in the reference)."""
    out = v.groupBy(F.col(area).alias("community_area")).agg(
        F.count(F.lit(1)).alias("incident_count"))
    return out.select(F.lit(metric).alias("metric"), F.lit(None).cast("string").alias("district"),
                      F.lit(None).cast("string").alias("period_value"), "community_area",
                      "incident_count", F.lit(None).cast("double").alias("rate"))


def flag_proportion(v: DataFrame, flag: str = "gunshot_injury", key: str = "district",
                    metric: str = METRIC_FLAG, yes=YES_FLAGS) -> DataFrame:
    """Count and share of rows whose flag is a yes (NULL counts as no)."""
    hit = F.when(F.col(flag).isin(*yes), F.lit(1.0)).otherwise(F.lit(0.0))
    out = v.groupBy(F.col(key).alias("district")).agg(
        F.count(F.lit(1)).alias("incident_count"), F.avg(hit).alias("rate"))
    return out.select(F.lit(metric).alias("metric"), "district",
                      F.lit(None).cast("string").alias("period_value"),
                      F.lit(None).cast("string").alias("community_area"), "incident_count", "rate")


def metrics_all(v: DataFrame, method: str = "grouping_sets") -> DataFrame:
    """The three violence metric sets, NULL-padded to one schema.

    One scan and one aggregate over three grouping sets: (label, district,
    month), (area) and (district), the last with its share of yes flags.
    ``union`` is one scan per set.
    """
    if method == "union":
        parts = [mix_by_key_period(v), count_by_area(v), flag_proportion(v)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    label, area, district, month = (F.col(c) for c in ("incident_primary", "community_area", "district", "month"))
    flagged = v.select(F.coalesce(label, F.lit(UNKNOWN)).alias("label"), district, month.alias("period_value"), area,
                       F.when(F.col("gunshot_injury").isin(*YES_FLAGS), F.lit(1.0)).otherwise(F.lit(0.0)).alias("hit"))
    names = ["label", "district", "period_value", "community_area"]
    keys = [F.col(n) for n in names]
    agg = flagged.groupingSets([keys[:3], [keys[3]], [keys[1]]], *names).agg(
        F.count(F.lit(1)).alias("incident_count"), F.avg("hit").alias("share"),
        F.grouping("label").alias("no_label"), F.grouping("community_area").alias("no_area"))
    mix, by_area = F.col("no_label") == 0, F.col("no_area") == 0
    return agg.select(
        F.when(mix, F.concat(F.lit(METRIC_MIX_PREFIX), "label")).when(by_area, F.lit(METRIC_AREA)).otherwise(F.lit(METRIC_FLAG)).alias("metric"),
        "district", "period_value", "community_area", "incident_count", F.when(~mix & ~by_area, F.col("share")).alias("rate"))


def count_by_key(df: DataFrame, key: str = "district", name: str = "crime_count") -> DataFrame:
    """Count per key value (the NULL key is its own group)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))

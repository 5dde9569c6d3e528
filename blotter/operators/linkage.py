"""Dedup, joins, dense index, hash bucketing and paired series
(A13-A16, J1-J5, F16, M5, T7, U4, U5)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import bucket
from ..schemas import PAIR_DENSITY_COUNT, PAIR_INCIDENT_RATE
from ..session import shared_dir
from .rollups import count_by_key, rate_by


def dedup_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """One row per key, chosen deterministically.

    The kept row is the smallest by ``order_by`` (ascending, NULLs last), the
    remaining columns breaking ties. Written as ``min(struct)`` so it is a
    partial aggregate: a key holding a third of the rows is reduced map-side
    to one row per task before the shuffle. All NULL keys collapse to one row,
    as a group-by does.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    parts = []
    for i, c in enumerate(order_by):
        parts += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(c)]
    parts += [F.col(c).alias(c) for c in rest]
    kept = df.groupBy(key).agg(F.min(F.struct(*parts)).alias("_keep"))
    return kept.select(key, *[F.col(f"_keep.{c}").alias(c) for c in order_by + rest])


def join_left_dedup(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left equi-join on a key that is unique on the right (no fan-out).

    The planner picks the strategy from sizes: AQE turns it into a broadcast
    join when the deduplicated side proves small at run time and otherwise
    keeps a sort-merge join. A key with many facts stays in one task here, as
    the right side's aggregate shares the join's exchange;
    ``join_left_split`` deals such keys over many tasks.
    """
    return facts.join(dim, key, "left")


HEAVY_KEYS = 64
HEAVY_TRACKED = 4096
SALTS = 32  # per partition that a key would fill: their hashes then fall evenly


def heavy_keys(facts: DataFrame, key: str, parts: int, k: int = HEAVY_KEYS) -> dict:
    """The at most ``k`` keys that hold more rows than an average one of
    ``parts`` partitions, with the number of partitions that they would fill, from
    a frequent-items sketch (one bounded sketch a task, merged; NULLs left out).
    The sketch misses no key with more than 1 of ``HEAVY_TRACKED`` rows."""
    top = facts.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {int(k)}, {HEAVY_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return {t["item"]: t["count"] * parts / top.n for t in top.top or [] if t["count"] * parts > top.n}


def join_left_split(facts: DataFrame, dim: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """J1 with frequent keys split: the left equi-join of ``join_left_dedup``.

    Facts of a heavy key, or of no key, are dealt over salts, ``SALTS`` for each
    of ``parts`` partitions (default: the shuffle partitions) that they would
    fill; the at most ``HEAVY_KEYS`` rows of the unique right side for heavy keys
    are repeated per salt, ``SALTS * parts`` rows and some in all. All other rows
    have salt 0, so nothing else moves more than in the plain join, and no task
    gets a hot key whole. One aggregate over the key column finds the heavy keys.
    """
    parts = parts or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heavy = {k: math.ceil(SALTS * share) for k, share in heavy_keys(facts, key, parts).items()}
    of = F.lit(None).cast("int")
    if heavy:
        of = F.element_at(F.create_map(*[F.lit(x) for pair in heavy.items() for x in pair]), F.col(key))
    spread = F.pmod(F.monotonically_increasing_id(), F.when(F.col(key).isNull(), SALTS * parts).otherwise(F.coalesce(of, F.lit(1))))
    salted = facts.withColumn("_salt", spread.cast("long"))
    salts = F.sequence(F.lit(0), F.coalesce(of, F.lit(1)) - 1)
    repeated = dim.where(F.col(key).isNotNull()).withColumn("_salt", F.explode(salts.cast("array<bigint>")))
    return salted.join(repeated, [key, "_salt"], "left").drop("_salt")


def dense_index(df: DataFrame, order_by: list[str], name: str = "index") -> DataFrame:
    """Number the rows ``0..N-1`` in ``order_by`` order, distributed.

    The rows are range partitioned and sorted inside each partition; a row's
    position is its rank inside its partition plus the sizes of all earlier
    partitions. Only one row per partition reaches the offset step, so no
    data passes through the driver or a single task. The ranged frame is
    checkpointed to the shared folder first, which fixes the partition
    boundaries for both uses and cuts the lineage.
    """
    shared_dir(df.sparkSession)  # checkpoints go to spark.checkpoint.dir
    ordered = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = (df.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    local = ranged.select("*", F.shiftright(F.col("_mid"), 33).alias("_part"),
                          (F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).alias("_pos"))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition: a global window over it is bounded by the
    # partition count, not by the data.
    offsets = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_offset"))
    numbered = local.join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (F.col("_offset") + F.col("_pos")).alias(name))


def station_index(stations: DataFrame, key: str = "district",
                  label: str = "station_name", name: str = "district_index") -> DataFrame:
    """A13 + U5: distinct (key, label) pairs numbered in sorted order."""
    return dense_index(stations.select(key, label).distinct(), [key, label], name)


def bucket_density(registry: DataFrame, index: DataFrame, method: str = "murmur",
                   block: str = "block", flag: str = "victim_minor", yes: str = "Y",
                   index_col: str = "district_index", keep_empty: bool = False) -> DataFrame:
    """J2 + A14 + F16: assign each registry row a bucket, map buckets to
    stations through the dense index, count rows and flagged rows per station.

    N is the size of the index, used as a scalar subquery (no collect). Rows
    are counted per bucket first, so the join takes at most N rows on each side
    and the bucket of all blank blocks is no hot key. ``keep_empty=True`` keeps
    stations that get no rows (reported with zero counts).
    """
    n = index.select(F.count(F.lit(1))).scalar()
    tagged = registry.select(bucket(F.col(block), n, method).alias(index_col),
                             (F.col(flag) == F.lit(yes)).alias("_hit"))
    per = tagged.groupBy(index_col).agg(F.count(F.lit(1)).alias("_rows"),
                                        F.count_if(F.col("_hit")).alias("_hits"))
    joined = per.join(index, index_col, "right" if keep_empty else "inner")
    return joined.groupBy("district", "station_name").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("offender_count"),
        F.coalesce(F.sum("_hits"), F.lit(0)).alias("priority_minor_victim_count"))


def bucket_counts(registry: DataFrame, n, method: str = "murmur",
                  block: str = "block") -> DataFrame:
    """F16 on its own: rows per bucket."""
    return registry.groupBy(bucket(F.col(block), n, method).alias("bucket")).agg(
        F.count(F.lit(1)).alias("row_count"))


# ------------------------------------------------------------------- pairs
def paired(name: str, xs: DataFrame, x: str, ys: DataFrame, y: str, how: str = "inner") -> DataFrame:
    """M5 + P22: one series of (x, y) per district; with ``how="left"`` a district
    without a y has 0."""
    both = xs.join(ys, "district", how)
    return both.select(F.lit(name).alias("correlation_name"), F.col("district").alias("group_key"),
                       F.col(x).cast("double").alias("x_value"), F.coalesce(F.col(y).cast("double"), F.lit(0.0)).alias("y_value"))


def district_rates(joined: DataFrame) -> DataFrame:
    """(district, crime_count, arrest_rate) in one aggregate over the joined rows."""
    return rate_by(joined, "district").select(F.col("group_value").alias("district"), "crime_count", "arrest_rate")


def pair_incident_vs_rate(violence: DataFrame, joined: DataFrame, name: str = PAIR_INCIDENT_RATE) -> DataFrame:
    """J3 + P10 + P22: incidents per district against the district arrest rate.

    The district rate is computed directly (not filtered out of the unioned
    rate table), which keeps the one scan the filter needs.
    """
    return paired(name, count_by_key(violence, "district", "violence_count"), "violence_count", district_rates(joined), "arrest_rate")


def pair_density_vs_count(density: DataFrame, crimes: DataFrame, name: str = PAIR_DENSITY_COUNT) -> DataFrame:
    """Offenders per station district against crimes per district (0 if none)."""
    return paired(name, density, "offender_count", count_by_key(crimes, "district", "crime_count"), "crime_count", "left")


def pairs_all(incidents: DataFrame, density: DataFrame, districts: DataFrame) -> DataFrame:
    """U4: both series against one frame of districts.

    ``districts`` (``district_rates``: crimes and arrest rate) is joined once,
    to the union of the two left sides, so its inputs are read and aggregated
    once. ``incidents``: district, violence_count; ``density``: district,
    offender_count.
    """
    left = incidents.select(F.lit(PAIR_INCIDENT_RATE).alias("correlation_name"), "district", F.col("violence_count").alias("x_value")) \
        .unionByName(density.select(F.lit(PAIR_DENSITY_COUNT).alias("correlation_name"), "district", F.col("offender_count").alias("x_value")))
    inner = F.col("correlation_name") == PAIR_INCIDENT_RATE  # needs a rate; the other has 0 without crimes
    return left.join(districts, "district", "left").where(~inner | F.col("crime_count").isNotNull()).select(
        "correlation_name", F.col("district").alias("group_key"), F.col("x_value").cast("double").alias("x_value"),
        F.when(inner, F.col("arrest_rate")).otherwise(F.coalesce("crime_count", F.lit(0)).cast("double")).alias("y_value"))


def pairs_corr(pairs: DataFrame, digits: int = 9) -> DataFrame:
    """M5 summary: Pearson correlation and pair count per series."""
    return pairs.groupBy("correlation_name").agg(
        F.round(F.corr("x_value", "y_value"), digits).alias("corr"),
        F.count(F.lit(1)).alias("n_pairs"))

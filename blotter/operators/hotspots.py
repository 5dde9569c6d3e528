"""K-Means hotspots and nearest-centre assignment.

The model is Spark MLlib's distributed K-Means; only the k centres and their
k sizes reach the driver, to be turned back into a k-row table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cleaning import filter_geo

# K-Means seed of the reference and its configured k.
KMEANS_SEED = 4109
KMEANS_K = 10

HOTSPOT_SCHEMA = T.StructType([
    T.StructField("cluster_id", T.IntegerType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("crime_count", T.LongType(), False),
])


def features(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """M1: (lat, lon) rows with both values as a vector column; a NaN is an
    error, not a dropped row."""
    geo = filter_geo(points, lat, lon).select(lat, lon)
    return VectorAssembler(inputCols=[lat, lon], outputCol="features",
                           handleInvalid="error").transform(geo).select("features")


def kmeans_hotspots(points: DataFrame, k: int = KMEANS_K, seed: int = KMEANS_SEED,
                    lat: str = "latitude", lon: str = "longitude",
                    max_iter: int = 20) -> DataFrame:
    """M2-M4 + J5: centres with the number of points nearest to each.

    The vectors are persisted (memory, spilling to disk) for the iterations
    and for the final assignment, so the source is read once; the cluster
    sizes come from the training summary. Only the k centres and k sizes
    reach the driver. Centres with no point get a count of 0; with fewer
    distinct points than k, fewer centres come back.
    """
    feats = features(points, lat, lon).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(k=k, seed=seed, featuresCol="features", maxIter=max_iter).fit(feats)
        centres = model.clusterCenters()
        sizes = model.summary.clusterSizes if model.hasSummary else [0] * len(centres)
    finally:
        feats.unpersist()
    rows = [(i, float(c[0]), float(c[1]), int(sizes[i]) if i < len(sizes) else 0)
            for i, c in enumerate(centres)]
    return points.sparkSession.createDataFrame(rows, HOTSPOT_SCHEMA)


def nearest_centre(lat: str, lon: str, centres: list[tuple[float, float]]):
    """M3: id of the nearest centre (squared Euclidean; lowest id on ties).

    A column expression over the k fixed centres, so every row is assigned
    where it lives: no join, no shuffle.
    """
    candidates = [
        F.struct(((F.col(lat) - F.lit(c_lat)) * (F.col(lat) - F.lit(c_lat))
                  + (F.col(lon) - F.lit(c_lon)) * (F.col(lon) - F.lit(c_lon))).alias("d"),
                 F.lit(i).alias("id"))
        for i, (c_lat, c_lon) in enumerate(centres)]
    best = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    return best.getField("id")


def assign_nearest(points: DataFrame, centres: list[tuple[float, float]],
                   lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """M3 + A15: points per nearest centre."""
    geo = filter_geo(points, lat, lon)
    return geo.groupBy(nearest_centre(lat, lon, centres).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("crime_count"))


def invariants(points: DataFrame, stored: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """(item, n): what holds for centres that K-Means has settled on. Counts
    centres whose size is the number of points nearest to them, centres at the
    mean of those points (within a thousandth of the points' extent), centres in
    id order as served, and all points. Only the k centres reach the driver."""
    from .serving import hotspot_map
    centres = stored.orderBy("cluster_id").collect()
    geo = filter_geo(points, lat, lon)
    near = geo.groupBy(nearest_centre(lat, lon, [(c.latitude, c.longitude) for c in centres]).alias("cluster_id")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(lat).alias("lat_mean"), F.avg(lon).alias("lon_mean"))
    width = geo.agg(F.greatest(F.max(lat) - F.min(lat), F.max(lon) - F.min(lon)) / 1000).scalar()
    both = stored.join(near, "cluster_id", "left")
    at_mean = (F.abs(F.col("latitude") - F.col("lat_mean")) <= width) & (F.abs(F.col("longitude") - F.col("lon_mean")) <= width)
    served = [r.cluster_id for r in hotspot_map(stored).collect()]
    counts = both.agg(
        F.count(F.lit(1)).alias("centres"), F.count_if(F.col("crime_count") == F.coalesce("n", F.lit(0))).alias("sizes_of_nearest"),
        F.count_if(at_mean).alias("at_mean_of_nearest"), F.sum("crime_count").alias("points"),
        F.lit(sum(a == b for a, b in zip(served, range(len(served))))).cast("long").alias("served_in_order"))
    return counts.unpivot([], counts.columns, "item", "n")

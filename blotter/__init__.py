"""blotter: incident analytics on Spark.

Batch and streaming DataFrame functions for typed ingest and cleaning,
calendar and categorical rollups, rates, dedup and joins, hash bucketing,
K-Means hotspots, paired series, keyed sliding-window alerts, replay-safe
sinks and serving reads. See README.md for the map to each operator.

Modules: ``functions`` (Column expressions), ``sources`` (readers and
connector builders), ``operators`` (DataFrame -> DataFrame steps),
``streaming`` (event parsing, stream runners, the alert stream), ``sinks``
(tables and documents), ``plans`` (the registered queries and the whole job).
"""

__version__ = "0.1.0"

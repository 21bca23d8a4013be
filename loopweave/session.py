"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where an aggregate above could reuse the join's partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "loopweave", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings above. ``conf`` keys use ``__`` for dots.

    ``master`` is for tests and laptops; on a cluster leave it to spark-submit.
    Shuffle partitions are left to the cluster's own setting and to AQE.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

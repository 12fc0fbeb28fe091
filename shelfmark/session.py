"""A Spark session with the settings the reports count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join kinds from measured sizes, splits hot partitions and merges
# small ones, so a cluster can start from a high partition count at no cost to small data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A filter on one table, however large its files, may cut the other side of a join.
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
}


def build_session(
    app_name: str = "shelfmark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Start a session, or give back the running one.

    ``shuffle_partitions`` is the count shuffles start from: a few per core on one
    machine, enough on a cluster for each to hold some hundred megabytes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

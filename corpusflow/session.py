"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "corpusflow", **conf: str) -> SparkSession:
    """Session with adaptive execution on and a pinned UTC time zone.

    On a cluster leave ``master`` unset and size the shuffle with
    ``spark.sql.shuffle.partitions``; adaptive coalescing merges what is too fine.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # a checkpoint goes when nothing refers to it any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

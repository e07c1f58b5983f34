"""Input layout: use every core on small tables, leave large ones where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition only when the scan has fewer splits than there are cores.

    Text work costs far more per byte than moving the bytes, so a table of one small
    file is worth spreading. A table with enough splits is returned as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df

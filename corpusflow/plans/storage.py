"""Shared-folder access: lineage cuts and scratch tables.

Everything durable goes under ``spark.checkpoint.dir``, the folder every node of
the cluster sees. A folder is made only for a local master that names none (tests,
laptops); on a cluster the setting is required.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder, created and recorded only where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    path = spark.conf.get("corpusflow.local.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every node sees")
        path = tempfile.mkdtemp(prefix="corpusflow-")
        spark.conf.set("corpusflow.local.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; never reused, so a rerun cannot mix files."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)

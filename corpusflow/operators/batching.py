"""Ordering and batching of example tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import hash_key
from ..plans.scan import ranked
from ..plans.storage import cut_lineage


def curriculum(df: DataFrame, prompt: str, key: str) -> DataFrame:
    """Shortest prompts first, ties by key: ``[key, prompt_len, rank]`` (rank from 0)."""
    sized = df.select(F.length(prompt).cast("bigint").alias("prompt_len"), key)
    return ranked(sized, "prompt_len", tie=[key], name="rank").select(key, "prompt_len", "rank")


def batches(df: DataFrame, n: int, key: str, drop_last: bool = True, seed: int | None = None) -> DataFrame:
    """Fixed-size batches ``[key, batch, slot]`` in key order, or shuffled by a seeded hash."""
    if seed is None:
        placed = ranked(df, key, size="_size")
    else:
        placed = ranked(df.select(hash_key(F.lit(seed), key).alias("_h"), key), "_h", tie=[key], size="_size")
    if drop_last:
        placed = placed.filter(F.floor(F.col("ord") / n) < F.floor(F.col("_size") / n))
    return placed.select(key, F.floor(F.col("ord") / n).alias("batch"), (F.col("ord") % n).alias("slot"))


def cyclic_batches(df: DataFrame, n: int, steps: int, key: str) -> DataFrame:
    """Step ``s`` takes batch ``s mod ceil(N / n)``: ``[step, slot, key]``; the last batch may be short."""
    placed = cut_lineage(batches(df, n, key, drop_last=False))
    size = F.lit(placed.count())
    turns = df.sparkSession.range(steps).select(
        F.col("id").alias("step"), (F.col("id") % F.ceil(size / n)).alias("batch")
    )
    return placed.join(turns, "batch").select("step", "slot", key)


def mod_batches(df: DataFrame, n: int, steps: int, key: str) -> DataFrame:
    """Step ``s`` takes positions ``[s*n mod N, (s+1)*n mod N)``, topped up from the front.

    When the end wraps to or below the start the range is empty and the step gets the
    first ``n`` rows instead; this is how the rollout loop being matched behaves.
    """
    placed = cut_lineage(ranked(df, key))
    size = F.lit(placed.count())
    step = df.sparkSession.range(steps).select(
        F.col("id").alias("step"), ((F.col("id") * n) % size).alias("a"), (((F.col("id") + 1) * n) % size).alias("b")
    )
    slots = step.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        "taken", F.greatest(F.col("b") - F.col("a"), F.lit(0))
    )
    at = F.when(F.col("slot") < F.col("taken"), F.col("a") + F.col("slot")).otherwise(F.col("slot") - F.col("taken"))
    return slots.withColumn("ord", at).join(placed, "ord").select("step", F.col("slot").cast("bigint").alias("slot"), key)


def accum_steps(df: DataFrame, accum: int, run: str, micro: str, loss: str) -> DataFrame:
    """One optimizer step per ``accum`` micro-batches (0-based ``micro``); a short tail makes none."""
    return (
        df.groupBy(run, F.floor(F.col(micro) / accum).alias("opt_step"))
        .agg((F.sum(F.col(loss)).cast("double") / accum).alias("loss"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == accum)
        .drop("_n")
    )

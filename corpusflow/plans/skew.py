"""Joining per-key statistics back to rows when one key may own a third of them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import cut_lineage

HOT_ROWS = 10_000_000
HOT_KEYS = 10_000


def attach(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    size: str,
    salt_by: Sequence[str | Column],
    how: str = "inner",
    written: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join ``rows`` to one-row-per-key ``stats``, splitting hot keys.

    ``stats`` is written once (unless it is already), so what it was computed from is planned once. ``stats[size]`` is the number
    of ``rows`` per key. A key above ``hot_rows`` is cut into ``ceil(size / hot_rows)`` parts by a hash of ``salt_by``; its
    stats row is repeated once per part, so no task gets more than about ``hot_rows`` rows, or a ten-thousandth of
    all rows where that is more. The list of hot keys therefore has at most ``HOT_KEYS`` entries, which bounds the one
    broadcast used here; without any the join is a plain one. Null keys meet null keys.
    """
    keys = list(keys)
    stats = stats if written else cut_lineage(stats)
    total = stats.agg(F.sum(size)).first()[0] or 0  # one number
    most = max(float(hot_rows), float(total) / HOT_KEYS)
    parts = F.greatest(F.ceil(F.col(size) / most), F.lit(1)).cast("int")
    hot = stats.filter(F.col(size) > most).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], parts.alias("_parts"))
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    right = stats.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    if hot.isEmpty():
        return rows.join(right, reduce(and_, same), how).drop(*[f"_of_{k}" for k in keys])
    hot_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    left = rows.join(F.broadcast(hot), hot_key, "left").drop(*[f"_hot_{k}" for k in keys])
    salt = F.pmod(F.xxhash64(*salt_by), F.coalesce("_parts", F.lit(1)).cast("bigint")).cast("int")
    left = left.withColumn("_salt", salt).drop("_parts")
    right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.join(right, reduce(and_, same, F.col("_salt") == F.col("_part")), how).drop("_salt", "_part", *[f"_of_{k}" for k in keys])

"""Similarity-weighted averages over a row's own history, per group.

History is the whole group up to a row, or what a context length leaves of it: a block of
fixed size, or a window plus the first few rows. Groups are cut into blocks, a task holds two
blocks of one group, and no table of row pairs is ever written.

The whole history is a running softmax. Blocks grow with the square root of the group, so a group of n rows has about
n * sqrt(n) / SPAN rows on the move. A pair of blocks gives a partial (largest score, weight, weighted sum) per row; merging two
partials is associative, so they are merged ``FAN`` at a time, level by level, in groups of at most ``FAN * PART`` of them.

Keys need to be unique within a group only. A null key is one more key, before all others; null groups are one group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.arrays import doubles
from ..plans.scan import ordinal
from ..plans.storage import cut_lineage


TILE = 64
SPAN = 16  # a block holds SPAN * sqrt(n) rows
FAN = 16
PART = 1024
CELLS = 1 << 22  # scores a task holds at a time


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _attend(q: np.ndarray, k: np.ndarray, v: np.ndarray, seen: np.ndarray) -> np.ndarray:
    scores = np.where(seen, q @ k.T / np.sqrt(q.shape[1]), -np.inf)
    weights = np.exp(scores - scores.max(axis=1, keepdims=True))
    return (weights / weights.sum(axis=1, keepdims=True)) @ v


def causal_attend(
    df: DataFrame,
    group: str,
    key: str,
    q: str,
    k: str,
    v: str,
    heads: int = 1,
    kv_heads: int | None = None,
    block: int | None = None,
    window: int | None = None,
    sink: int = 0,
) -> DataFrame:
    """``[group, key, pos, y ARRAY]``: softmax(q.k / sqrt(d)) average of ``v`` over earlier rows and the row itself.

    A row sees all rows of its group up to itself; with ``block`` (a context size) only those of its block. With
    ``window``, a row at ``i`` sees positions ``> i - window`` and the group's first ``sink`` positions.
    """
    kv_heads = kv_heads or heads
    rows = _placed(df, group, key, q, k, v)
    if window is None and block is None:
        return _attend_all(rows, df, group, key, heads, kv_heads)
    size = window or block
    rows = rows.withColumn("_block", F.floor(F.col("_pos") / size)).withColumn("_own", F.lit(True))
    if window is not None:
        after = rows.withColumn("_block", F.col("_block") + 1).withColumn("_own", F.lit(False))
        rows_out = rows.unionByName(after)
        if sink:
            first = rows.filter(F.col("_pos") < sink)
            # every later block of the group needs the first rows: the list of blocks meets them
            blocks = rows.select("_group", F.col("_block").alias("_at")).distinct()
            spread = blocks.join(first, "_group").filter(F.col("_block") + 2 <= F.col("_at"))
            spread = spread.withColumn("_block", F.col("_at")).drop("_at")
            rows_out = rows_out.unionByName(spread.withColumn("_own", F.lit(False)))
        rows = rows_out

    def attend(table: pa.Table) -> pa.Table:
        own = np.asarray(table.column("_own"))
        mine = table.filter(pa.array(own))
        pos, at = np.asarray(table.column("_pos")), np.asarray(mine.column("_pos"))
        if not len(at):
            return _result(mine, np.zeros((0, 1)))
        qs, ks, vs = _matrix(mine, "_q"), _matrix(table, "_k"), _matrix(table, "_v")
        seen = pos[None, :] <= at[:, None]
        if window is not None:
            seen &= (pos[None, :] > at[:, None] - window) | (pos[None, :] < sink)
        return _result(mine, np.hstack([_attend(q, k, v, seen) for q, k, v in _heads(qs, ks, vs, heads, kv_heads)]))

    out = rows.groupBy("_group", "_block").applyInArrow(attend, _kinds(rows, "y array<double>"))
    return _named(out, group, key)


def _placed(df: DataFrame, group: str, key: str, q: str, k: str, v: str) -> DataFrame:
    """``[_group, _key, _pos, _q, _k, _v]``; a struct around the group lets null groups meet, and no name of ``df`` is used."""
    rows = df.select(
        F.struct(F.col(group).alias("g")).alias("_group"),
        F.col(key).alias("_key"),
        F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63))).alias("_order"),
        doubles(q).alias("_q"),
        doubles(k).alias("_k"),
        doubles(v).alias("_v"),
    )
    return rows.join(ordinal(rows, "_order", ["_group"], name="_pos"), ["_group", "_order"]).drop("_order")


def _kinds(rows: DataFrame, more: str) -> StructType:
    """Schema of a result: the columns that name a row, as they are, and more."""
    return StructType([rows.schema[c] for c in ("_group", "_key")] + StructType.fromDDL(f"_pos bigint, {more}").fields)


def _named(out: DataFrame, group: str, key: str) -> DataFrame:
    return out.select(F.col("_group.g").alias(group), F.col("_key").alias(key), F.col("_pos").alias("pos"), "y")


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _result(rows: pa.Table, y: np.ndarray) -> pa.Table:
    return pa.table({c: rows.column(c) for c in ("_group", "_key", "_pos")} | {"y": _lists(y)})


def _heads(qs: np.ndarray, ks: np.ndarray, vs: np.ndarray, heads: int, kv_heads: int):
    """Query, key and value columns of each head; several query heads may share those of one key head."""
    dq, dk, dv = qs.shape[1] // heads, ks.shape[1] // kv_heads, vs.shape[1] // kv_heads
    for h in range(heads):
        s = h // (heads // kv_heads)
        yield qs[:, h * dq : (h + 1) * dq], ks[:, s * dk : (s + 1) * dk], vs[:, s * dv : (s + 1) * dv]


def _partials(qs: np.ndarray, ks: np.ndarray, vs: np.ndarray, visible: np.ndarray) -> np.ndarray:
    """Largest score, weight and weighted sum of every query row over one block of keys."""
    scores = np.where(visible, qs @ ks.T / np.sqrt(qs.shape[1]), -np.inf)
    top = scores.max(axis=1)
    weights = np.exp(scores - top[:, None])
    return np.column_stack([top, weights.sum(axis=1), weights @ vs])


def merge_partials(row: np.ndarray, parts: np.ndarray, heads: int) -> tuple[np.ndarray, np.ndarray]:
    """Partials of equal ``row`` merged into one each: the rows in order and their partials."""
    order = np.argsort(row, kind="stable")
    row, per_head = row[order], parts[order].reshape(len(row), heads, -1)
    starts = np.append(0, np.flatnonzero(np.diff(row)) + 1)
    top = np.maximum.reduceat(per_head[:, :, 0], starts)
    sizes = np.diff(np.append(starts, len(row)))
    scale = np.exp(per_head[:, :, 0] - np.repeat(top, sizes, axis=0))
    summed = np.add.reduceat(per_head[:, :, 1:] * scale[:, :, None], starts)
    return order[starts], np.concatenate([top[:, :, None], summed], axis=2).reshape(len(starts), -1)


def _attend_all(rows: DataFrame, df: DataFrame, group: str, key: str, heads: int, kv_heads: int) -> DataFrame:
    """Whole history: queries of block ``i`` meet keys of every block ``j <= i``."""
    rows = cut_lineage(rows)
    sizes = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n"))
    block = F.greatest(F.lit(TILE), F.ceil(F.sqrt("_n") * SPAN)).cast("bigint")
    sizes = sizes.select("_group", block.alias("_size"), F.floor((F.col("_n") - 1) / block).cast("bigint").alias("_last"))
    cut = rows.join(sizes, "_group").withColumn("_block", F.floor(F.col("_pos") / F.col("_size")).cast("bigint"))
    earlier = F.explode(F.sequence(F.lit(0).cast("bigint"), "_block"))
    later = F.explode(F.sequence("_block", "_last"))
    own = cut.select("_group", "_key", "_pos", F.col("_block").alias("_i"), earlier.alias("_j"), "_q")
    seen = cut.select("_group", "_pos", later.alias("_i"), F.col("_block").alias("_j"), "_k", "_v")
    tiles = own.unionByName(seen, allowMissingColumns=True)

    def partial(table: pa.Table) -> pa.Table:
        mine, other = table.filter(pa.compute.is_valid(table.column("_q"))), table.filter(pa.compute.is_valid(table.column("_k")))
        qs, ks, vs = _matrix(mine, "_q"), _matrix(other, "_k"), _matrix(other, "_v")
        here, there = np.asarray(mine.column("_pos")), np.asarray(other.column("_pos"))
        step = max(1, CELLS // len(there))
        out = []
        for at in range(0, len(here), step):
            visible = there[None, :] <= here[at : at + step, None]
            out.append(np.hstack([_partials(*h, visible) for h in _heads(qs[at : at + step], ks, vs, heads, kv_heads)]))
        out = np.vstack(out)
        return pa.table({c: mine.column(c) for c in ("_group", "_key", "_pos", "_j")} | {"part": _lists(out)})

    def merged(finish: bool) -> Callable[[pa.Table], pa.Table]:
        def run(table: pa.Table) -> pa.Table:
            at, parts = merge_partials(np.asarray(table.column("_pos")), _matrix(table, "part"), heads)
            kept = table.take(pa.array(at))
            if finish:
                per_head = parts.reshape(len(at), heads, -1)
                return _result(kept, (per_head[:, :, 2:] / per_head[:, :, 1:2]).reshape(len(at), -1))
            j = pa.array(np.asarray(kept.column("_j")) // FAN)
            return pa.table({c: kept.column(c) for c in ("_group", "_key", "_pos")} | {"_j": j, "part": _lists(parts)})

        return run

    between, last = _kinds(rows, "_j bigint, part array<double>"), _kinds(rows, "y array<double>")
    # the work of a pair grows with the square of its bytes, so partitions must not be merged by size
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = tiles.repartition(width, "_group", "_i", "_j").groupBy("_group", "_i", "_j").applyInArrow(partial, between)
    most = sizes.agg(F.max("_last")).first()[0] or 0  # one number: blocks of the largest group
    held = F.floor(F.col("_pos") / PART)
    while most >= FAN:
        parts = parts.groupBy("_group", held, F.floor(F.col("_j") / FAN)).applyInArrow(merged(False), between)
        most //= FAN
    return _named(parts.groupBy("_group", held).applyInArrow(merged(True), last), group, key)


def masked_pair_count(length: int) -> int:
    """Number of future positions a causal mask hides for one sequence."""
    return length * (length - 1) // 2

"""Running aggregates that never put an unbounded group in one window.

A running sum over a whole table, or over one hot group, cannot be a single
window. The order key is a non-negative BIGINT, so it is cut into three digits
of 21 bits. Each window then sees at most 2**21 rows: rows inside a low bucket,
low buckets inside a middle bucket, middle buckets inside a group. The bound
follows from the key being unique per group and holds for any skew.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import cut_lineage

DIGIT = 21

_AGGREGATE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def _combine(op: str, parts: Sequence[Column]) -> Column:
    if op in ("sum", "count"):
        total = F.coalesce(parts[0], F.lit(0))
        for part in parts[1:]:
            total = total + F.coalesce(part, F.lit(0))
        return total
    return F.least(*parts) if op == "min" else F.greatest(*parts)


def prefix_scan(
    df: DataFrame,
    key: str,
    aggs: Mapping[str, tuple[str, Column]],
    group: Sequence[str] = (),
    tie: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Running ``sum|count|min|max`` per ``group`` in ``key`` order.

    Returns ``group + [key] + tie + aggs`` only: the scan shuffles narrow rows, and
    callers join wide payload back on the key. An exclusive ``min``/``max`` of
    the first row is NULL; structs are allowed, which gives lag and first-seen.
    """
    group, tie = list(group), list(tie)
    names = list(aggs)
    values = [(F.lit(1) if op == "count" else col).alias(n) for n, (op, col) in aggs.items()]
    rows = df.select(*group, key, *tie, *values).withColumn("_low", F.shiftright(F.col(key).cast("bigint"), DIGIT))

    def aggregate(table: DataFrame, keys: list[Column | str]) -> DataFrame:
        return table.groupBy(*keys).agg(*[_AGGREGATE[aggs[n][0]](n).alias(n) for n in names])

    def over(window) -> list[Column]:
        return [_AGGREGATE[aggs[n][0]](n).over(window).alias(f"_{n}") for n in names]

    def before(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    low = aggregate(rows, [*group, "_low"]).withColumn("_mid", F.shiftright("_low", DIGIT))
    mid = aggregate(low, [*group, "_mid"])
    # always 0: the middle digit of a signed 64-bit key has 22 bits
    top = F.shiftright(F.col("_mid") + (1 << DIGIT), DIGIT + 1)
    root = Window.partitionBy(*group, top).orderBy("_mid")
    mid_off = mid.select(*group, "_mid", *over(before(root)))
    mid_off = mid_off.toDF(*group, "_mid", *[f"_m_{n}" for n in names])

    inner = Window.partitionBy(*group, "_mid").orderBy("_low")
    low_off = low.select(*group, "_mid", "_low", *over(before(inner))).join(mid_off, [*group, "_mid"])
    low_off = low_off.select(
        *group, "_low", *[_combine(aggs[n][0], [F.col(f"_m_{n}"), F.col(f"_{n}")]).alias(f"_o_{n}") for n in names]
    )

    leaf = Window.partitionBy(*group, "_low").orderBy(key, *tie)
    leaf = leaf.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    out = rows.select(*group, key, *tie, "_low", *over(leaf)).join(low_off, [*group, "_low"])
    return out.select(
        *group,
        key,
        *tie,
        *[_combine(aggs[n][0], [F.col(f"_o_{n}"), F.col(f"_{n}")]).alias(n) for n in names],
    )


def ordinal(
    df: DataFrame, key: str, group: Sequence[str] = (), tie: Sequence[str] = (), name: str = "ord"
) -> DataFrame:
    """0-based position of each row in ``key`` order: ``group + [key] + tie + [name]``."""
    out = prefix_scan(df, key, {name: ("count", F.lit(1))}, group, tie)
    return out.withColumn(name, F.col(name) - 1)


def ranked(
    df: DataFrame, key: str, group: Sequence[str] = (), tie: Sequence[str] = (), name: str = "ord", size: str | None = None
) -> DataFrame:
    """``group + [key] + tie + [name]`` and the group's row count as ``size``: positions from one sorted, written key table.

    The keys alone are range-partitioned by (group, key, tie), sorted and written once. A row's place in its partition then
    needs only the rows its group has in earlier partitions: one small row per group and partition, summed over at most
    as many rows as there are partitions. A hot group is spread over as many partitions as it fills. The plan reads the key table
    twice, whatever was computed to get it. Rows that share all of the order are numbered in some order.
    """
    group = list(group)
    order = [*group, key, *tie]
    spark = df.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*order).repartitionByRange(width, *order).sortWithinPartitions(*order)
    keys = cut_lineage(keys.withColumn("_at", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_at", 33))
    pieces = keys.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    if group:
        whole = Window.partitionBy(*group)
        before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
        pieces = pieces.select(*group, "_part", shift.alias("_shift"), F.sum("_n").over(whole).alias("_size"))
    else:
        rows = sorted(pieces.collect())  # one for each partition
        ends = list(accumulate(r["_n"] for r in rows))
        shifts = [(r["_part"], end - r["_n"] - r["_first"], ends[-1]) for r, end in zip(rows, ends)]
        pieces = F.broadcast(spark.createDataFrame(shifts, "_part long, _shift long, _size long"))
    out = keys.join(pieces, [*group, "_part"])
    extra = [F.col("_size").alias(size)] if size else []
    return out.select(*order, (F.col("_at") + F.col("_shift")).alias(name), *extra)


def ordinal_by(df: DataFrame, major: str, minor: str, name: str = "ord") -> DataFrame:
    """Position in ``(major, minor)`` order when many rows share one ``major``.

    Rank inside each ``major`` value, plus the number of rows with a smaller one;
    a hot ``major`` is cut by the digits of ``minor``.
    """
    inside = ordinal(df, minor, [major], name="_in")
    sizes = df.groupBy(major).agg(F.count(F.lit(1)).alias("_n"))
    below = prefix_scan(sizes, major, {"_below": ("sum", F.col("_n"))}, inclusive=False)
    # one row per distinct major value: Spark broadcasts it when its measured size allows
    return inside.join(below, major).select(major, minor, (F.col("_in") + F.col("_below")).alias(name))

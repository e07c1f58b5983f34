"""Training-log operators: cadence, best-so-far, retention, rates, histograms, norms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.arrays import doubles, let, total
from ..plans.scan import prefix_scan

# --- fixed values: metric routing ----------------------------------------------
HIST_MAX = 2048
TEXT_PREFIX = "text/"
# ------------------------------------------------------------------------------


def log_every(df: DataFrame, *every: int, step: str = "step") -> DataFrame:
    """Steps divisible by every one of the given cadences."""
    keep = F.lit(True)
    for n in every:
        keep = keep & (F.col(step) % n == 0)
    return df.filter(keep)


def running_best(df: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """``[run, step, loss, best_before, improved]``; the first step counts as an improvement."""
    before = prefix_scan(df, step, {"best_before": ("min", F.col(loss))}, [run], [loss], inclusive=False)
    better = F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))
    return before.withColumn("improved", better)


def retain_last(df: DataFrame, k: int, run: str, step: str) -> DataFrame:
    """Checkpoints to keep: the last ``k`` steps per run; ``k = 0`` keeps all.

    A rank limit is applied inside each task before the shuffle, so a run of any length sends
    at most ``k`` rows per task.
    """
    if k <= 0:
        return df
    newest = F.row_number().over(Window.partitionBy(run).orderBy(F.desc(step)))
    return df.withColumn("_r", newest).filter(F.col("_r") <= k).drop("_r")


def throughput(df: DataFrame, run: str, step: str, micros: str, tokens: str) -> DataFrame:
    """``[run, step, tokens_per_s]`` against the previous step of the run; NULL for the first."""
    last = prefix_scan(
        df, step, {"prev": ("max", F.struct(step, micros))}, [run], [micros, tokens], inclusive=False
    )
    seconds = (F.col(micros) - F.col(f"prev.{micros}")) / F.lit(1e6)
    rate = F.when(seconds.isNotNull(), F.col(tokens) / F.greatest(seconds, F.lit(1e-6)))
    return last.select(run, step, rate.alias("tokens_per_s"))


def metric_kind(key: Column, values: Column) -> Column:
    size = F.size(values)
    return (
        F.when(key.startswith(TEXT_PREFIX), "text")
        .when(size == 1, "scalar")
        .when(size <= HIST_MAX, "histogram")
        .otherwise("stats")
    )


def route_metrics(df: DataFrame, key: str = "key", values: str = "values", text: str | None = None) -> DataFrame:
    """``[.., tag, kind, value, text]``: how each logged value is recorded.

    Text keys lose their prefix, single values are scalars, short arrays go to histograms, long
    ones become a mean and a (population) std scalar.
    """
    keep = [c for c in df.columns if c not in (key, values, text)]
    xs = doubles(values)
    kind = metric_kind(F.col(key), F.col(values))
    n = F.size(values)
    mean = total(xs) / n
    std = let(mean, lambda m: F.sqrt(total(F.transform(xs, lambda x: (x - m) * (x - m))) / n))

    def entry(tag: Column, kind: str, value: Column, txt: Column) -> Column:
        return F.struct(
            tag.alias("tag"), F.lit(kind).alias("kind"), value.cast("double").alias("value"), txt.cast("string").alias("text")
        )

    none = F.lit(None)
    body = F.col(text) if text else none
    routed = (
        F.when(kind == "text", F.array(entry(F.substring(F.col(key), len(TEXT_PREFIX) + 1, 2**31 - 1), "text", none, body)))
        .when(kind == "scalar", F.array(entry(F.col(key), "scalar", F.get(xs, F.lit(0)), none)))
        .when(kind == "histogram", F.array(entry(F.col(key), "histogram", none, none)))
        .otherwise(
            F.array(
                entry(F.concat(F.col(key), F.lit("/mean")), "scalar", mean, none),
                entry(F.concat(F.col(key), F.lit("/std")), "scalar", std, none),
            )
        )
    )
    return df.select(*keep, F.explode(routed).alias("m")).select(*keep, "m.*")


def histogram(df: DataFrame, key: str, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts per equal-width bin 1..bins; 0 and bins + 1 hold what falls outside."""
    return (
        df.filter(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(key, F.width_bucket(F.col(value), F.lit(lo), F.lit(hi), F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def norms(df: DataFrame, vec: str, *keys: str) -> DataFrame:
    """``[keys.., l2, rms, n]`` over all finite elements of all arrays of a key.

    Each row reduces its own array first; only three numbers per row enter the aggregate.
    """
    xs = F.filter(doubles(vec), _finite)
    per_row = df.select(*keys, total(F.transform(xs, lambda x: x * x)).alias("ss"), F.size(xs).alias("c"))
    ss, n = F.coalesce(F.sum("ss"), F.lit(0.0)), F.coalesce(F.sum("c"), F.lit(0))
    return per_row.groupBy(*keys).agg(
        F.sqrt(ss).alias("l2"), F.sqrt(F.try_divide(ss, n)).alias("rms"), n.cast("bigint").alias("n")
    )


def l2_norm(df: DataFrame, vec: str, *keys: str) -> DataFrame:
    return norms(df, vec, *keys).select(*keys, "l2")


def rms(df: DataFrame, vec: str, *keys: str) -> DataFrame:
    return norms(df, vec, *keys).select(*keys, "rms")

"""Evaluation tables: text match, method comparison, winners, failures, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

# --- fixed values: methods in tie-break order, default response, stand-ins ----
METHODS = ("sft", "ppo", "grpo", "dpo")
NO_RESPONSE = "[no response recorded]"
MISSING_LOW, MISSING_HIGH = -999.0, 999.0
# -----------------------------------------------------------------------------


def token_f1(df: DataFrame, key: str, pred: str, gold: str) -> DataFrame:
    """Multiset-overlap F1 of normalised words: ``[key, overlap, n_pred, n_gold, f1]``. A null text has no words.

    Rows are placed by key while they are still whole texts; both counts below then reuse
    that placement, so the exploded words never cross the network.
    """
    placed = df.select(key, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in (pred, gold)]).repartition(key)
    tagged = placed.select(
        key,
        F.explode_outer(
            F.concat(
                F.transform(tx.words(pred), lambda w: F.struct(w.alias("w"), F.lit(1).alias("p"), F.lit(0).alias("g"))),
                F.transform(tx.words(gold), lambda w: F.struct(w.alias("w"), F.lit(0).alias("p"), F.lit(1).alias("g"))),
            )
        ).alias("t"),
    )
    per_word = tagged.groupBy(key, F.col("t.w").alias("w")).agg(
        F.coalesce(F.sum("t.p"), F.lit(0)).alias("p"), F.coalesce(F.sum("t.g"), F.lit(0)).alias("g")
    )
    sums = per_word.groupBy(key).agg(
        F.sum(F.least("p", "g")).alias("overlap"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold")
    )
    f1 = (
        F.when((F.col("n_pred") == 0) & (F.col("n_gold") == 0), F.lit(1.0))
        .when(F.col("overlap") == 0, F.lit(0.0))
        .otherwise(2.0 * F.col("overlap") / (F.col("n_pred") + F.col("n_gold")))
    )
    return sums.withColumn("f1", f1)


def exact_match(df: DataFrame, key: str, pred: str, gold: str) -> DataFrame:
    return df.select(key, (tx.normalize(pred) == tx.normalize(gold)).alias("exact"))


def comparison_table(results: DataFrame, order: str) -> DataFrame:
    """``[prompt, sft, ppo, grpo, dpo]`` for every prompt with an sft row; the last duplicate by ``order`` wins.

    One aggregation on the prompt with partial results per task, instead of three joins.
    """
    def pick(method: str) -> Column:
        mine = F.col("method") == method
        last = F.max(F.when(mine, F.struct(F.col(order).alias("o"), F.col("reward").alias("r"))))
        return last["r"]

    has_sft = F.max((F.col("method") == "sft").cast("int")).alias("_sft")
    table = results.groupBy("prompt").agg(*[pick(m).alias(m) for m in METHODS], has_sft)
    return table.filter(F.col("_sft") == 1).drop("_sft")


def winner(table: DataFrame) -> DataFrame:
    """Best method per prompt, nulls skipped, ties in method order."""
    best = F.greatest(*[F.col(m) for m in METHODS])
    name = F.lit(None).cast("string")
    for method in reversed(METHODS):
        name = F.when(F.col(method) == best, F.lit(method)).otherwise(name)
    return table.withColumn("winner", name)


def _as_exact(col: str) -> Column:
    return F.col(col).cast("decimal(28,10)")


def method_averages(table: DataFrame, null_safe: bool = False, digits: int | None = 4) -> DataFrame:
    """Column sums of non-null scores over the number of all rows (``null_safe``: of non-null rows).

    Sums are decimal so the result does not depend on the order of rows. A column without any score is NULL, not 0: no
    average was measured.
    """
    def mean(m: str) -> Column:
        n = F.count(m) if null_safe else F.count(F.lit(1))
        value = F.try_divide(F.sum(_as_exact(m)).cast("double"), n.cast("double"))
        return (F.round(value, digits) if digits is not None else value).alias(m)

    return table.agg(*[mean(m) for m in METHODS])


def _unpivot(table: DataFrame, *keep: str, methods: tuple[str, ...] = METHODS) -> DataFrame:
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("method"), F.lit(METHODS.index(m)).alias("place"), F.col(m).alias("score"))
            for m in methods
        ]
    )
    return table.select(*keep, F.explode(entries).alias("e")).select(*keep, "e.*")


def overall_winner(averages: DataFrame) -> DataFrame:
    long = _unpivot(averages).filter(F.col("score").isNotNull())
    return long.agg(
        F.max_by("method", F.struct("score", (-F.col("place")).alias("p"))).alias("method"), F.max("score").alias("score")
    )


def _missing_zero(col: Column, zero_is_missing: bool) -> Column:
    return F.nullif(col, F.lit(0.0)) if zero_is_missing else col


def best_delta(table: DataFrame, zero_is_missing: bool = True, first: str = "prompt") -> DataFrame:
    """Per method: the prompt with the largest lead over sft, first in ``first`` order on ties.

    A score of exactly zero counts as missing, as in the report being matched; the flag turns that off.
    """
    long = _unpivot(table, "prompt", *([first] if first != "prompt" else []), "sft", methods=METHODS[1:])
    lead = F.coalesce(_missing_zero(F.col("score"), zero_is_missing), F.lit(MISSING_LOW)) - F.coalesce("sft", F.lit(0.0))
    long = long.withColumn("_lead", lead)
    top = F.min_by(F.struct("prompt", "sft", "score"), F.struct((-F.col("_lead")).alias("l"), F.col(first).alias("f")))
    best = long.groupBy("method").agg(top.alias("b"))
    return best.select(
        "method",
        F.col("b.prompt").alias("prompt"),
        F.col("b.sft").alias("sft"),
        F.col("b.score").alias("score"),
        (F.coalesce("b.score", F.lit(0.0)) - F.coalesce("b.sft", F.lit(0.0))).alias("delta"),
    )


def worst_prompt(table: DataFrame, zero_is_missing: bool = True, first: str = "prompt") -> DataFrame:
    """Per method: the prompt with the lowest score; missing (and, by default, zero) sorts last."""
    long = _unpivot(table, "prompt", *([first] if first != "prompt" else []), methods=METHODS[1:])
    value = F.coalesce(_missing_zero(F.col("score"), zero_is_missing), F.lit(MISSING_HIGH))
    order = F.struct(value.alias("v"), F.col(first).alias("f"))
    return (
        long.groupBy("method")
        .agg(F.min_by(F.struct("prompt", "score"), order).alias("b"))
        .select("method", F.col("b.prompt").alias("prompt"), F.col("b.score").alias("score"))
    )


def best_of_group(samples: DataFrame, group: str, reward: str, response: str, order: str) -> DataFrame:
    """Highest-reward sample of each group, the first on ties."""
    first = F.max_by(F.struct(response, reward, order), F.struct(reward, -F.col(order)))
    return samples.groupBy(group).agg(first.alias("b")).select(group, f"b.{response}", f"b.{reward}", f"b.{order}")


def attach_response(table: DataFrame, responses: DataFrame, key: str = "prompt", response: str = "response") -> DataFrame:
    """Left join of one response per key, the smallest of several; a key without one gets the default text."""
    single = responses.groupBy(key).agg(F.min(response).alias(response))
    joined = table.join(single, key, "left")
    return joined.withColumn(response, F.coalesce(response, F.lit(NO_RESPONSE)))


def phase_delta(df: DataFrame, method: str = "method", phase: str = "phase", reward: str = "reward") -> DataFrame:
    """Average of phase 5 minus average of phase 1, per method."""
    def mean(p: int) -> Column:
        return F.sum(F.when(F.col(phase) == p, _as_exact(reward))).cast("double") / F.count(
            F.when(F.col(phase) == p, F.col(reward))
        )

    averages = df.groupBy(method).agg(mean(1).alias("phase1"), mean(5).alias("phase5"))
    return averages.withColumn("delta", F.col("phase5") - F.col("phase1"))


def summary(df: DataFrame, *keys: str, reward: str = "reward", kl: str = "kl", digits: bool = True) -> DataFrame:
    """Average reward (4 digits), average KL (6 digits) and row count."""
    r, k = F.avg(reward), F.avg(kl)
    if digits:
        r, k = F.round(r, 4), F.round(k, 6)
    return df.groupBy(*keys).agg(r.alias("avg_reward"), k.alias("avg_kl"), F.count(F.lit(1)).alias("n"))

"""Reward scoring, fitting and ranking losses over preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import dot, softplus

FEATURES = ("log_len", "words", "letters", "marks", "overlap")


def features(prompt: Column | str, response: Column | str) -> Column:
    """Pooled text features of a (prompt, response), as an array in ``FEATURES`` order."""
    prompt, response = tx.as_col(prompt), tx.as_col(response)
    n = F.greatest(F.length(response), F.lit(1)).cast("double")
    mine, theirs = F.array_distinct(tx.words(response)), F.array_distinct(tx.words(prompt))
    return F.array(
        F.ln(F.length(response) + F.lit(1.0)),
        F.size(tx.words(response)).cast("double") / n,
        F.length(F.regexp_replace(response, "[^A-Za-z]", "")) / n,
        F.length(F.regexp_replace(response, "[^.,;:!?]", "")) / n,
        F.size(F.array_intersect(mine, theirs)) / F.greatest(F.size(mine), F.lit(1)).cast("double"),
    )


def score(df: DataFrame, weights: list[float], prompt: str, response: str, out: str = "reward") -> DataFrame:
    """Scalar reward: a linear head over the pooled features."""
    head = F.array(*[F.lit(float(w)) for w in weights])
    return df.withColumn(out, dot(features(prompt, response), head))


def fit_reward(pairs: DataFrame, reg: float = 1e-3, max_iter: int = 50) -> list[float]:
    """Weights of a pairwise ranking model: logistic regression on feature differences, no intercept.

    Each pair enters once in each direction so both classes are present. The fit is
    distributed; only the handful of weights comes back.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    diff = F.zip_with(features("prompt", "chosen"), features("prompt", "rejected"), lambda a, b: a - b)
    both = pairs.select(diff.alias("d")).select(
        F.explode(
            F.array(
                F.struct(F.col("d").alias("x"), F.lit(1.0).alias("label")),
                F.struct(F.transform("d", lambda v: -v).alias("x"), F.lit(0.0).alias("label")),
            )
        ).alias("r")
    )
    data = both.select(array_to_vector("r.x").alias("features"), F.col("r.label").alias("label"))
    model = LogisticRegression(fitIntercept=False, regParam=reg, maxIter=max_iter, standardization=False).fit(data)
    return [float(w) for w in model.coefficients]


def bradley_terry_loss(df: DataFrame, pos: str = "r_pos", neg: str = "r_neg") -> DataFrame:
    return df.agg(F.avg(softplus(F.col(neg) - F.col(pos))).alias("loss"))


def margin_ranking_loss(df: DataFrame, margin: float = 1.0, pos: str = "r_pos", neg: str = "r_neg") -> DataFrame:
    return df.agg(F.avg(F.greatest(F.lit(0.0), F.lit(margin) - (F.col(pos) - F.col(neg)))).alias("loss"))


def pair_accuracy(df: DataFrame, pos: str = "r_pos", neg: str = "r_neg") -> DataFrame:
    """Share of pairs ranked strictly right; an empty table gives 0."""
    right = F.coalesce(F.sum((F.col(pos) > F.col(neg)).cast("bigint")), F.lit(0))
    n = F.count(F.lit(1))
    return df.agg((right.cast("double") / F.greatest(n, F.lit(1))).alias("accuracy"), n.alias("n"))


def average_reward(df: DataFrame, reward: str = "reward") -> DataFrame:
    return df.agg(F.avg(reward).alias("avg_reward"), F.count(F.lit(1)).alias("n"))


def make_pairs(items: DataFrame, model, key: str, max_new: int = 32, **sampling) -> DataFrame:
    """``[key, prompt, chosen, rejected]``: the data's response against a reference model's completion."""
    from .ngram import generate

    prompts = items.select(key, tx.byte_ids(tx.format_prompt("prompt")).alias("prompt_ids"))
    drawn = generate(prompts, model, max_new, key, **sampling)
    return items.join(drawn.select(key, tx.byte_text("new_ids").alias("rejected")), key).select(
        key, "prompt", F.col("response").alias("chosen"), "rejected"
    )

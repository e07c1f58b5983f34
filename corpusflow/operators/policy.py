"""Policy-optimisation analytics over logged trajectories (token rows or sequence rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import softplus
from ..plans.skew import attach

STD_FLOOR = 1e-6


# --- token-level columns ------------------------------------------------------
def kl_tokens(df: DataFrame, logp: str = "old_logp", ref: str = "ref_logp", out: str = "kl") -> DataFrame:
    return df.withColumn(out, F.col(logp) - F.col(ref))


def ratio(new: str, old: str) -> Column:
    return F.exp(F.col(new) - F.col(old))


def clipped_ratio(new: str, old: str, eps: float) -> Column:
    return F.least(F.greatest(ratio(new, old), F.lit(1.0 - eps)), F.lit(1.0 + eps))


def shape_rewards(df: DataFrame, kl_coef: float, out: str = "shaped") -> DataFrame:
    """Trajectory reward at its last token, minus the KL penalty on every action token.

    ``seq_len`` travels with each token, so "last" needs no window over the trajectory.
    """
    final = F.when(F.col("pos") == F.col("seq_len") - 1, F.col("reward").cast("double")).otherwise(F.lit(0.0))
    return df.withColumn(out, final - F.lit(kl_coef) * (F.col("old_logp") - F.col("ref_logp")))


def advantages(df: DataFrame, shaped: str = "shaped", value: str = "value") -> DataFrame:
    """Advantage against the value estimate; the return is the shaped reward itself."""
    return df.withColumn("adv", F.col(shaped) - F.col(value)).withColumn("ret", F.col(shaped))


# --- diagnostics --------------------------------------------------------------
def approx_kl(df: DataFrame, *keys: str, logp: str = "old_logp", ref: str = "ref_logp") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.col(logp) - F.col(ref)).alias("kl"), F.count(F.lit(1)).alias("n"))


def kl_diagnostics(df: DataFrame) -> DataFrame:
    """Movement of the update and distance of the updated policy from the reference."""
    return df.agg(
        F.avg(F.col("old_logp") - F.col("new_logp")).alias("kl_move"),
        F.avg(F.col("new_logp") - F.col("ref_logp")).alias("kl_ref"),
    )


def last_value(df: DataFrame, traj: str = "traj_id") -> DataFrame:
    return df.groupBy(traj).agg(F.max_by("value", "pos").alias("value"))


# --- advantage normalisation --------------------------------------------------
def _normalised(x: Column, mean: Column, std: Column) -> Column:
    # one element has no standard deviation: the result stays NULL
    return F.when(std.isNotNull(), (x - mean) / F.greatest(std, F.lit(STD_FLOOR)))


def normalize_adv(df: DataFrame, adv: str = "adv", out: str = "adv_norm", key: str | None = None, salt_by: tuple[str, ...] = ()) -> DataFrame:
    """(adv - mean) / max(std, 1e-6) with the unbiased std, over the table or per ``key``.

    Whole-table statistics are two numbers, computed first. Per key they are a pre-aggregated table
    joined back with hot keys split.
    """
    stats = [F.avg(adv).alias("_mean"), F.stddev_samp(adv).alias("_std"), F.count(F.lit(1)).alias("_n")]
    if key is None:
        one = df.agg(*stats[:2]).first()
        return df.withColumn(out, _normalised(F.col(adv), F.lit(one["_mean"]).cast("double"), F.lit(one["_std"]).cast("double")))
    joined = attach(df, df.groupBy(key).agg(*stats), [key], "_n", list(salt_by) or df.columns)
    return joined.withColumn(out, _normalised(F.col(adv), F.col("_mean"), F.col("_std"))).drop("_mean", "_std", "_n")


def group_advantage(df: DataFrame, mode: str = "clamp", prompt: str = "prompt_id", reward: str = "reward", salt_by: tuple[str, ...] = ()) -> DataFrame:
    """Add group mean, std and advantage of each sample against its prompt's group.

    ``center`` subtracts the mean; ``eps`` divides by std + 1e-6; ``clamp`` by max(std, 1e-6). A group
    of one has no std: its advantage is NULL in the two scaled modes.
    """
    stats = df.groupBy(prompt).agg(
        F.avg(reward).alias("group_mean"), F.stddev_samp(reward).alias("group_std"), F.count(F.lit(1)).alias("_n")
    )
    rows = attach(df, stats, [prompt], "_n", list(salt_by) or df.columns).drop("_n")
    centered = F.col(reward) - F.col("group_mean")
    if mode == "center":
        adv = centered
    elif mode == "eps":
        adv = centered / (F.col("group_std") + STD_FLOOR)
    elif mode == "clamp":
        adv = _normalised(F.col(reward), F.col("group_mean"), F.col("group_std"))
    else:
        raise ValueError(mode)
    return rows.withColumn("adv", adv.cast("double"))


def adv_to_tokens(tokens: DataFrame, trajs: DataFrame, traj: str = "traj_id") -> DataFrame:
    """Copy a trajectory's advantage to its action tokens, then normalise over all of them.

    ``trajs`` has one row per trajectory; a trajectory's tokens are bounded by the context length.
    """
    return normalize_adv(tokens.join(trajs.select(traj, "adv"), traj), "adv", "adv_norm")


# --- losses -------------------------------------------------------------------
def _surrogate(adv: str, eps: float) -> Column:
    r, c = ratio("new_logp", "old_logp"), clipped_ratio("new_logp", "old_logp", eps)
    return F.avg(F.least(r * F.col(adv), c * F.col(adv)))


def ppo_losses(df: DataFrame, eps: float = 0.2, vf_coef: float = 0.5, ent_coef: float = 0.0) -> DataFrame:
    """Clipped policy loss, value MSE, entropy proxy, KL and their total, in one aggregate."""
    policy, value = -_surrogate("adv", eps), F.avg(F.pow(F.col("new_value") - F.col("ret"), 2))
    entropy, kl = -F.avg("new_logp"), F.avg(F.col("old_logp") - F.col("new_logp"))
    return df.agg(
        policy.alias("policy_loss"),
        value.alias("value_loss"),
        entropy.alias("entropy_approx"),
        kl.alias("approx_kl"),
        (policy + vf_coef * value - ent_coef * entropy).alias("total_loss"),
    )


def grpo_losses(df: DataFrame, eps: float = 0.2, ent_coef: float = 0.0, kl_coef: float = 0.1, reference_sign: bool = False) -> DataFrame:
    """Policy-only clipped loss with a KL term; an empty table gives zeros.

    ``reference_sign=True`` leaves out the minus sign of the policy term. ``entropy_approx`` is reported even where
    ``ent_coef`` is 0 and it has no part in the total.
    """
    zero = F.lit(0.0)
    surrogate = F.coalesce(_surrogate("adv", eps), zero)
    policy = surrogate if reference_sign else -surrogate
    entropy = F.coalesce(-F.avg("new_logp"), zero)
    move = F.coalesce(F.avg(F.col("old_logp") - F.col("new_logp")), zero)
    kl = F.coalesce(F.avg(F.col("new_logp") - F.col("ref_logp")), zero)
    return df.agg(
        policy.alias("policy_loss"),
        entropy.alias("entropy_approx"),
        move.alias("approx_kl"),
        kl.alias("kl_ref"),
        (policy - ent_coef * entropy + kl_coef * kl).alias("total_loss"),
    )


def grpo_sequence_loss(df: DataFrame, kl_coef: float = 0.1, prompt: str = "prompt_id") -> DataFrame:
    """Per prompt: minus the mean of A * (logp - kl_coef * (logp - ref))."""
    term = F.col("adv") * (F.col("logp") - kl_coef * (F.col("logp") - F.col("ref_logp")))
    return df.groupBy(prompt).agg((-F.avg(term)).alias("loss"), F.count(F.lit(1)).alias("n"))


def dpo_loss(df: DataFrame, beta: float = 0.1, pc: str = "pc", pr: str = "pr", rc: str = "rc", rr: str = "rr") -> DataFrame:
    """-log sigmoid(beta * margin); accuracy counts strictly positive margins only."""
    margin = (F.col(pc) - F.col(rc)) - (F.col(pr) - F.col(rr))
    return df.agg(
        F.avg(softplus(-F.lit(beta) * margin)).alias("loss"),
        F.avg((margin > 0).cast("double")).alias("accuracy"),
        F.avg(margin).alias("reward_margin"),
        F.count(F.lit(1)).alias("n"),
    )


def collapsed_groups(df: DataFrame, tol: float = 1e-3, prompt: str = "prompt_id", reward: str = "reward", response: str = "response") -> DataFrame:
    """Groups of two or more whose rewards barely differ, with the number of distinct responses."""
    # one row per distinct response first, so a hot prompt is never counted in one task
    distinct = df.select(prompt, F.xxhash64(response).alias("_h")).distinct()
    distinct = distinct.groupBy(F.col(prompt).alias("_prompt")).agg(F.count(F.lit(1)).alias("n_distinct"))
    # the deviation is merged from per-task moments, which keeps small spreads around large rewards
    spread = F.coalesce(F.when(F.min(reward) == F.max(reward), F.lit(0.0)), F.stddev_samp(reward))
    groups = df.groupBy(prompt).agg(F.count(F.lit(1)).alias("n"), spread.alias("std"))
    flat = groups.filter((F.col("n") > 1) & (F.col("std") < tol))
    return flat.join(distinct, F.col(prompt).eqNullSafe(F.col("_prompt"))).select(prompt, "n", "n_distinct", "std")

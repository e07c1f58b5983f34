"""Driver tables and the instruction / preference / evaluation / run-log views over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.layout import spread
from ..plans.scan import ordinal, ranked
from ..plans.storage import cut_lineage

PAIR_STEP = 10_000_019


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def documents(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """The given columns of ``documents``, laid out so that text work uses every core."""
    return spread(table(spark, root, "documents").select("doc_id", *columns), "doc_id")


def pair_number(conv: str, turn: str) -> Column:
    """One BIGINT per (conversation, turn), unique for turns below ``PAIR_STEP``; odd, so remainders mix both parts."""
    return F.col(conv) * PAIR_STEP + F.col(turn)


def sft_pairs(spark: SparkSession, root: str) -> DataFrame:
    """User turn, following assistant turn, and a preceding system turn as input.

    Turn order comes from a written key table; neighbours meet in one shuffle on the
    unique (conv_id, ord), so a conversation of any length spreads over tasks.
    """
    turns = table(spark, root, "conversations")
    turns = turns.join(ranked(turns, "turn", ["conv_id"]), ["conv_id", "turn"])
    row = F.struct("turn", "role", "text")
    seats = F.array(
        F.struct(F.col("ord").alias("at"), F.lit(0).alias("seat"), row.alias("row")),
        F.struct((F.col("ord") + 1).alias("at"), F.lit(-1).alias("seat"), row.alias("row")),
        F.struct((F.col("ord") - 1).alias("at"), F.lit(1).alias("seat"), row.alias("row")),
    )
    keep = (
        ((F.col("s.seat") == 0) & (F.col("s.row.role") == "user"))
        | ((F.col("s.seat") == -1) & (F.col("s.row.role") == "system"))
        | ((F.col("s.seat") == 1) & (F.col("s.row.role") == "assistant"))
    )

    def seat(n: int, field: str):
        return F.max(F.when(F.col("s.seat") == n, F.col(f"s.row.{field}")))

    spread = turns.select("conv_id", F.explode(seats).alias("s")).filter(keep)
    joined = spread.groupBy("conv_id", F.col("s.at").alias("at")).agg(
        seat(0, "turn").alias("turn"),
        seat(0, "text").alias("instruction"),
        seat(-1, "text").alias("input"),
        seat(1, "text").alias("output"),
    )
    return joined.filter(F.col("turn").isNotNull() & F.col("output").isNotNull()).select(
        pair_number("conv_id", "turn").alias("pair_id"),
        "conv_id",
        "instruction",
        F.coalesce("input", F.lit("")).alias("input"),
        "output",
    )


def sft_items(spark: SparkSession, root: str) -> DataFrame:
    """``[pair_id, conv_id, prompt, response]`` ready for formatting."""
    return load_instructions(sft_pairs(spark, root), "pair_id", "conv_id")


def pref_pairs(spark: SparkSession, root: str, buckets: int = 8) -> DataFrame:
    """Chosen = the reply; rejected = the next reply of the same bucket, wrapping round. Pairs are written once."""
    pairs = cut_lineage(sft_pairs(spark, root).withColumn("bucket", F.pmod("pair_id", F.lit(buckets))))
    seat = ranked(pairs, "pair_id", ["bucket"], size="n")
    here = pairs.join(seat, ["bucket", "pair_id"])
    other = here.select(
        "bucket",
        F.pmod(F.col("ord") - 1, F.col("n")).alias("ord"),
        F.col("output").alias("rejected"),
    )
    return (
        here.join(other, ["bucket", "ord"])
        .filter(F.col("output") != F.col("rejected"))
        .select("pair_id", F.col("instruction").alias("prompt"), F.col("output").alias("chosen"), "rejected")
    )


def eval_results(spark: SparkSession, root: str) -> DataFrame:
    """Mean event value per (user, type) read as one reward per (prompt, method)."""
    events = table(spark, root, "events").filter(F.col("event_type") != "error")
    method = (
        F.when(F.col("event_type") == "view", "sft")
        .when(F.col("event_type") == "click", "ppo")
        .when(F.col("event_type") == "signup", "grpo")
        .otherwise("dpo")
    )
    mean = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    missing = (F.col("event_type") == "purchase") & (F.col("user_id") % 7 == 0)
    return events.groupBy("user_id", "event_type").agg(mean.alias("mean")).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"),
        method.alias("method"),
        F.when(~missing, F.col("mean")).alias("reward"),
    )


def run_log(spark: SparkSession, root: str) -> DataFrame:
    """Events as ten training runs with dense 1-based steps."""
    events = table(spark, root, "events").select(
        (F.col("user_id") % 10).alias("run"),
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"),
        F.col("value").alias("loss"),
        (F.col("event_id") % 512 + 1).alias("tokens"),
        F.when(F.col("event_type") == "error", "val").otherwise("train").alias("split"),
    )
    steps = ordinal(events, "micros", ["run"], ["event_id"], "step")
    return events.join(steps, ["run", "micros", "event_id"]).withColumn("step", F.col("step") + 1)


def load_instructions(df: DataFrame, *keep: str) -> DataFrame:
    """Strip, drop rows with an empty instruction or output, append the input to the prompt."""
    parts = df.select(
        *keep,
        *[tx.strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("instruction", "input", "output")],
    )
    return parts.filter((F.length("instruction") > 0) & (F.length("output") > 0)).select(
        *keep, tx.join_input("instruction", "input").alias("prompt"), F.col("output").alias("response")
    )


def load_preferences(df: DataFrame, *keep: str) -> DataFrame:
    """Whole conversations as chosen / rejected, with an empty prompt; both must be non-empty."""
    parts = df.select(
        *keep,
        F.lit("").alias("prompt"),
        *[tx.strip(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in ("chosen", "rejected")],
    )
    return parts.filter((F.length("chosen") > 0) & (F.length("rejected") > 0))


def filter_nonempty(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.length(tx.strip(F.coalesce(F.col(col), F.lit("")))) > 0)


def head_slice(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows by an explicit key: each task keeps n, then one merge."""
    return df.orderBy(*order).limit(n)


def sample_prompts(df: DataFrame, n: int, col: str, *order: str) -> DataFrame:
    """The first ``n`` non-empty prompts."""
    return head_slice(filter_nonempty(df, col), n, *order)


def cycle_to(df: DataFrame, n: int, key: str) -> DataFrame:
    """Repeat the rows of ``df`` cyclically, in ``key`` order, up to ``n`` rows (column ``slot``)."""
    base = df.join(ordinal(df, key), key)
    size = df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    slots = df.sparkSession.range(n).withColumnRenamed("id", "slot")
    return slots.withColumn("ord", F.col("slot") % size).join(base, "ord").drop("ord")

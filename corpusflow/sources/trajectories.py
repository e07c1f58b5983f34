"""Token-level trajectories derived from the pair views and three byte models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from ..operators import ngram
from ..plans.storage import cut_lineage
from . import tables as t


def corpus_model(spark: SparkSession, root: str, alpha: float = 1.0) -> ngram.NgramModel:
    return ngram.fit_ngram(t.documents(spark, root, "text"), alpha=alpha, ids="text")


def quality_model(spark: SparkSession, root: str, alpha: float = 1.0) -> ngram.NgramModel:
    good = t.table(spark, root, "labels").filter(F.col("quality") == 1).select("doc_id").distinct()
    docs = t.documents(spark, root, "text").join(good, "doc_id", "left_semi")
    return ngram.fit_ngram(docs, alpha=alpha, ids="text")


def policy_tables(spark: SparkSession, root: str) -> DataFrame:
    """``[ctx, next, ref_logp, old_logp, new_logp]``: 65,536 rows, whatever the corpus size.

    Reference = all documents, old and new policy = the good ones with two smoothing strengths. Both
    counts come from one pass over the documents.
    """
    good = t.table(spark, root, "labels").filter(F.col("quality") == 1).select("doc_id").distinct()
    docs = t.documents(spark, root, "text").join(good.withColumn("good", F.lit(True)), "doc_id", "left")
    split = ngram.count_transitions(docs, "good", ids="text")
    both = split.groupBy("ctx", "next").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("g")
    )
    ref = ngram.NgramModel(both, alpha=1.0)
    old, new = ngram.NgramModel(both, alpha=1.0), ngram.NgramModel(both, alpha=0.5)
    ctx = Window.partitionBy("ctx")  # 256 rows each
    grid = (
        ngram.pair_grid(spark)
        .join(both, ["ctx", "next"], "left")
        .withColumn("n_total", F.sum("n").over(ctx))
        .withColumn("g_total", F.sum("g").over(ctx))
    )
    return grid.select(
        "ctx",
        "next",
        ref.logp(F.col("n"), F.col("n_total")).alias("ref_logp"),
        old.logp(F.col("g"), F.col("g_total")).alias("old_logp"),
        new.logp(F.col("g"), F.col("g_total")).alias("new_logp"),
    )


def sequences(spark: SparkSession, root: str) -> DataFrame:
    """``[traj_id, prompt_id, ids, boundary, reward, response]``, one formatted pair each."""
    items = t.sft_items(spark, root)
    return items.select(
        F.col("pair_id").alias("traj_id"),
        F.col("conv_id").alias("prompt_id"),
        tx.byte_ids(tx.format_example("prompt", "response")).alias("ids"),
        F.octet_length(tx.format_prompt("prompt")).alias("boundary"),
        (F.length("response") % 17 - 8).cast("double").alias("reward"),
        "response",
    )


def traj_tokens(spark: SparkSession, root: str, seqs: DataFrame | None = None) -> DataFrame:
    """One row per token with a full context; the three log-probs come from one broadcast table.

    Sequences and the table are written once: what normalises over all tokens reads them twice.
    """
    seqs = cut_lineage(sequences(spark, root)) if seqs is None else seqs
    rows = seqs.select(
        "traj_id",
        "prompt_id",
        "boundary",
        "reward",
        F.size("ids").alias("seq_len"),
        F.explode(ngram.transitions("ids")).alias("t"),
    )
    rows = rows.select(
        "traj_id", "prompt_id", "boundary", "reward", "seq_len",
        F.col("t.pos").alias("pos"), F.col("t.ctx").alias("ctx"), F.col("t.next").alias("next"),
    )
    scored = rows.join(F.broadcast(cut_lineage(policy_tables(spark, root))), ["ctx", "next"])
    return scored.select(
        "traj_id",
        "prompt_id",
        "pos",
        "seq_len",
        F.col("next").alias("token"),
        (F.col("pos") >= F.col("boundary")).alias("is_response"),
        "ref_logp",
        "old_logp",
        "new_logp",
        (F.col("pos") / F.col("seq_len")).alias("value"),
        "reward",
    )


def action_rows(spark: SparkSession, root: str, seqs: DataFrame | None = None) -> DataFrame:
    """Response tokens only: the action positions of every trajectory."""
    return traj_tokens(spark, root, seqs).filter(F.col("is_response"))

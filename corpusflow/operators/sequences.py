"""Token streams to training blocks; instruction and preference rows to masked sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.arrays import IGNORE_LABEL, PAD_ID, head, pad_to, shift_labels, tail
from ..plans.scan import ordinal, prefix_scan


# --- one ordered token stream -------------------------------------------------
def global_positions(df: DataFrame, key: str, length: Column) -> DataFrame:
    """``[key, n_tokens, start]``: where each document begins in the concatenated stream."""
    sized = df.select(key, length.cast("bigint").alias("n_tokens"))
    ends = prefix_scan(sized, key, {"end": ("sum", F.col("n_tokens"))}, tie=["n_tokens"])
    return ends.select(key, "n_tokens", (F.col("end") - F.col("n_tokens")).alias("start"))


def token_total(df: DataFrame, length: Column) -> Column:
    """Total token count as a scalar subquery, computed once per query."""
    return df.agg(F.sum(length.cast("bigint")).alias("n")).select("n").scalar()


def split_by_position(df: DataFrame, total: Column, fraction: float = 0.9) -> DataFrame:
    """Cut ``[.., ids, start]`` rows into train / val pieces at ``int(total * fraction)``."""
    cut = F.floor(total.cast("double") * F.lit(float(fraction))).cast("bigint")
    n_train = F.least(F.greatest(cut - F.col("start"), F.lit(0)), F.size("ids")).cast("int")
    rows = df.withColumn("n_train", n_train)
    pieces = F.array(
        F.struct(F.lit("train").alias("split"), head("ids", F.col("n_train")).alias("ids"), F.col("start").alias("start")),
        F.struct(
            F.lit("val").alias("split"),
            tail("ids", F.size("ids") - F.col("n_train")).alias("ids"),
            (F.col("start") + F.col("n_train") - cut).alias("start"),
        ),
    )
    keep = [c for c in df.columns if c not in ("ids", "start")]
    return rows.select(*keep, F.explode(pieces).alias("p")).select(*keep, "p.*").filter(F.size("ids") > 0)


def _pieces(df: DataFrame, size: int) -> DataFrame:
    """Split ``[.., ids, start]`` at multiples of ``size``: ``[keep.., chunk, at, piece]``."""
    keep = [c for c in df.columns if c not in ("ids", "start")]
    first = F.floor(F.col("start") / size)
    last = F.floor((F.col("start") + F.size("ids") - 1) / size)
    spread = df.filter(F.size("ids") > 0).select(
        *keep, "ids", "start", F.explode(F.sequence(first, last)).alias("chunk")
    )
    begin = F.greatest(F.col("chunk") * size - F.col("start"), F.lit(0))
    end = F.least((F.col("chunk") + 1) * size - F.col("start"), F.size("ids").cast("bigint"))
    return spread.select(
        *keep,
        "chunk",
        (F.col("start") + begin).alias("at"),
        F.slice("ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("piece"),
    )


def _assemble(pieces: str = "pieces") -> Column:
    return F.flatten(F.transform(F.array_sort(F.col(pieces)), lambda p: p["piece"]))


def blocks(df: DataFrame, size: int, total: Column, stride: int = 1) -> DataFrame:
    """Training blocks of ``[.., ids, start]``: ``[block_id, x, y]``, ``y`` is ``x`` shifted by one.

    Starts run over ``0, stride, .. < total - size - 1``. Each piece of a document
    goes to its chunk and to the one before, so one shuffle on the chunk number
    gives every task at most ``2 * size`` tokens per group, across documents.
    """
    twice = _pieces(df, size).select(
        F.explode(F.array(F.col("chunk"), F.col("chunk") - 1)).alias("chunk"), F.struct("at", "piece").alias("p")
    )
    runs = twice.groupBy("chunk").agg(F.collect_list("p").alias("pieces")).filter(F.col("chunk") >= 0)
    runs = runs.select((F.col("chunk") * size).alias("base"), _assemble().alias("run"))
    low = F.ceil(F.col("base") / stride) * stride
    high = F.least(F.col("base") + size - 1, total.cast("bigint") - size - 2)
    starts = runs.filter(low <= high).select(
        "base", "run", F.explode(F.sequence(low, high, F.lit(stride).cast("bigint"))).alias("s")
    )
    at = (F.col("s") - F.col("base")).cast("int")
    return starts.select(
        (F.col("s") / stride).cast("bigint").alias("block_id"),
        F.slice("run", at + 1, F.lit(size)).alias("x"),
        F.slice("run", at + 2, F.lit(size)).alias("y"),
    )


def sample_starts(df: DataFrame, n: int, size: int, seed: int, total: Column) -> DataFrame:
    """``n`` reproducible uniform starts in ``[0, total - size - 1)``: ``[sample, s]``."""
    draws = df.sparkSession.range(n).withColumnRenamed("id", "sample")
    span = F.greatest(total.cast("bigint") - size - 1, F.lit(0))
    start = F.floor(tx.uniform(F.lit(seed), "sample") * span).cast("bigint")
    return draws.select("sample", start.alias("s")).filter(span > 0)


def cut_blocks(df: DataFrame, starts: DataFrame, size: int, *keys: str) -> DataFrame:
    """Blocks at given starts: ``[sample, keys.., x, y]``.

    Only the pieces a start touches are shuffled: starts meet the pieces on the
    chunk number, then at most ``size + 1`` tokens gather per sample.
    """
    touched = starts.select(
        *keys, "sample", "s", F.explode(F.sequence(F.floor(F.col("s") / size), F.floor((F.col("s") + size) / size))).alias("chunk")
    )
    hit = _pieces(df, size).join(touched, [*keys, "chunk"])
    lo = F.greatest(F.col("s") - F.col("at"), F.lit(0))
    hi = F.least(F.col("s") + size + 1 - F.col("at"), F.size("piece").cast("bigint"))
    hit = hit.filter(hi > lo).select(
        *keys,
        "sample",
        F.struct("at", F.slice("piece", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("piece")).alias("p"),
    )
    runs = hit.groupBy(*keys, "sample").agg(F.collect_list("p").alias("pieces")).select(*keys, "sample", _assemble().alias("run"))
    return runs.select(*keys, "sample", head("run", size).alias("x"), F.slice("run", 2, size).alias("y"))


def sample_blocks(df: DataFrame, n: int, size: int, seed: int, total: Column) -> DataFrame:
    return cut_blocks(df, sample_starts(df, n, size, seed, total), size)


# --- instruction and preference rows ------------------------------------------
def sft_collate(df: DataFrame, size: int = 256, encode=tx.byte_ids) -> DataFrame:
    """``[.., prompt, response]`` to padded ``ids`` and masked next-token ``labels``.

    The first ``n_prompt - 1`` labels are ignored; the one that predicts the first
    response token is kept.
    """
    keep = [c for c in df.columns if c not in ("prompt", "response")]
    rows = df.select(
        *keep,
        head(encode(tx.format_example("prompt", "response")), size).alias("x"),
        head(encode(tx.format_prompt("prompt")), size).alias("p"),
    )
    rows = rows.withColumn("n_prompt", F.least(F.size("p"), F.size("x"))).withColumn("y", shift_labels("x"))
    masked = F.transform(
        "y", lambda v, i: F.when(i < F.col("n_prompt") - 1, F.lit(IGNORE_LABEL)).otherwise(v)
    )
    return rows.select(
        *keep, "n_prompt", pad_to("x", size, PAD_ID).alias("ids"), pad_to(masked, size, IGNORE_LABEL).alias("labels")
    )


def pair_collate(df: DataFrame, size: int = 256, encode=tx.byte_ids) -> DataFrame:
    """``[.., prompt, chosen, rejected]`` to two padded id arrays of equal length."""
    keep = [c for c in df.columns if c not in ("prompt", "chosen", "rejected")]

    def side(col: str) -> Column:
        return pad_to(encode(tx.format_example("prompt", col)), size, PAD_ID)

    return df.select(*keep, side("chosen").alias("pos_ids"), side("rejected").alias("neg_ids"))


def build_pair(df: DataFrame, size: int, clip: bool = True) -> DataFrame:
    """``[.., prompt_ids, response_ids]`` to ``ids`` and a response mask.

    A response of ``size`` or more tokens is clipped to ``size - 1``, then the prompt is
    trimmed from the left. ``clip=False`` is the older rule without the clip: a response of ``size`` or more
    tokens leaves no prompt and keeps its first ``size``.
    """
    keep = [c for c in df.columns if c not in ("prompt_ids", "response_ids")]
    response = F.col("response_ids")
    if clip:
        response = F.when(F.size(response) >= size, head(response, size - 1)).otherwise(response)
    rows = df.select(*keep, "prompt_ids", response.alias("r"))
    rows = rows.withColumn("p", tail("prompt_ids", F.greatest(F.lit(size) - F.size("r"), F.lit(0))))
    ids = head(F.concat("p", "r"), size)
    return rows.select(
        *keep,
        ids.alias("ids"),
        F.transform(ids, lambda _, i: i >= F.size("p")).alias("resp_mask"),
    )


def pad_rollouts(df: DataFrame, ctx: int, batch: str = "batch") -> DataFrame:
    """Keep the last ``L`` tokens of ``[.., batch, ids, boundary, reward]`` and pad to the batch length.

    ``max_len`` is the longest sequence of the batch, at most ``ctx``. A batch has a fixed
    number of sequences, so its maximum is one small aggregate row.
    """
    longest = df.groupBy(batch).agg(F.least(F.max(F.size("ids")), F.lit(ctx)).alias("max_len"))
    rows = df.join(longest, batch)
    length = F.least(F.size("ids"), F.col("max_len"))
    rows = rows.withColumn("length", length)
    rows = rows.withColumn("b", F.greatest(F.col("boundary") - (F.size("ids") - F.col("length")), F.lit(0)).cast("int"))
    keep = [c for c in df.columns if c not in ("ids", "boundary", "reward")]
    spots = F.sequence(F.lit(0), F.col("max_len") - 1)
    return rows.filter(F.col("max_len") > 0).select(
        *keep,
        "max_len",
        "length",
        "b",
        pad_to(tail("ids", F.col("max_len")), F.col("max_len"), PAD_ID).alias("ids"),
        F.transform(spots, lambda i: (i >= F.col("b")) & (i < F.col("length"))).alias("mask"),
        F.transform(
            spots, lambda i: F.when(i == F.col("length") - 1, F.col("reward").cast("double")).otherwise(F.lit(0.0))
        ).alias("rewards"),
    )


def action_tokens(df: DataFrame, *arrays: str) -> DataFrame:
    """One row per action: position ``t`` predicts token ``t + 1`` where the mask is set there."""
    keep = [c for c in df.columns if c not in ("ids", "mask", *arrays)]
    zipped = F.arrays_zip("ids", "mask", *arrays)
    rows = df.select(*keep, F.posexplode(zipped).alias("at", "t")).filter(F.col("t.mask") & (F.col("at") > 0))
    return rows.select(
        *keep, (F.col("at") - 1).alias("pos"), F.col("t.ids").alias("token"), *[F.col(f"t.{a}").alias(a) for a in arrays]
    )


def traj_counts(actions: DataFrame, traj: str) -> DataFrame:
    """Number of action tokens per trajectory."""
    return actions.groupBy(traj).agg(F.count(F.lit(1)).alias("n_tokens"))

"""Byte tokens and token statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def byte_encode(df: DataFrame, text: str = "text", out: str = "ids") -> DataFrame:
    return df.withColumn(out, tx.byte_ids(text))


def byte_decode(df: DataFrame, ids: str = "ids", out: str = "text") -> DataFrame:
    return df.withColumn(out, tx.byte_text(ids))


def roundtrip_failures(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text does not survive encoding and decoding."""
    return df.filter(~tx.byte_text(tx.byte_ids(text)).eqNullSafe(F.col(text)))


def token_counts(df: DataFrame, ids: str = "ids") -> DataFrame:
    return df.select(F.explode(ids).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def token_stats(df: DataFrame, *keys: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Tokens, distinct tokens and bytes per token, per ``keys``; counted per distinct token first."""
    long = df.select(*keys, F.explode(ids).alias("token")).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("n"))
    tokens = long.groupBy(*keys).agg(F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct"))
    sizes = df.groupBy(*keys).agg(F.sum(F.octet_length(text)).cast("bigint").alias("n_bytes"))
    both = tokens.join(sizes, list(keys)) if keys else tokens.withColumn("n_bytes", sizes.select("n_bytes").scalar())
    return both.withColumn("bytes_per_token", F.col("n_bytes") / F.col("n_tokens"))

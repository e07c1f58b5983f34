"""File sources and sinks: text, bytes, metric JSON, tokenizer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.skew import attach

GROUP_BLOCK = 65_536


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop = _file_system(spark, path)
    return system.exists(hadoop)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, hadoop = _file_system(spark, path)
    return system.exists(hadoop) and system.getFileStatus(hadoop).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    system, hadoop = _file_system(spark, path)
    system.mkdirs(hadoop)


def _require(spark: SparkSession, path: str) -> None:
    if not path_exists(spark, path):
        raise FileNotFoundError(path)


def read_corpus(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """One text file, or every ``*.txt`` under a folder, as ``[path, text]``.

    Lines by default, so that a file of any size splits over tasks;
    ``whole=True`` gives one row per file for folders of documents.
    """
    _require(spark, path)
    reader = spark.read.option("recursiveFileLookup", "true")
    if is_folder(spark, path):
        reader = reader.option("pathGlobFilter", "*.txt")
    rows = reader.text(path, wholetext=True) if whole else reader.text(path, lineSep="\n")
    return rows.select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def read_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Raw file content as ``[path, content]``."""
    _require(spark, path)
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    )


_SAMPLE = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("reward", T.DoubleType()),
    ]
)
_GROUPED = T.StructType(
    [
        T.StructField("prompt", T.StringType()),
        T.StructField("group_mean_reward", T.DoubleType()),
        T.StructField("group_std_reward", T.DoubleType()),
        T.StructField("samples", T.ArrayType(_SAMPLE)),
    ]
)
# a field list per layout; flat entries and wrapped entries share one schema so either form reads
_LAYOUTS = {
    "sft": T.StructType([T.StructField("samples", T.ArrayType(_SAMPLE)), *_SAMPLE.fields]),
    "ppo": _SAMPLE,
    "grpo": _GROUPED,
    "dpo": T.StructType([T.StructField("per_prompt", T.ArrayType(_SAMPLE)), *_SAMPLE.fields]),
}
_WRAPPED = {"sft": "samples", "dpo": "per_prompt"}


def read_metrics(spark: SparkSession, path: str, layout: str, lines: bool = False) -> DataFrame:
    """Evaluation metrics of one of four layouts as ``[method, prompt, reward, response]``.

    ``sft`` = ``{samples: [...]}`` or a flat list, ``ppo`` = flat list, ``grpo`` =
    list of groups (the group mean is the reward, its best sample the response),
    ``dpo`` = ``{per_prompt: [...]}`` or a flat list. ``lines=True`` reads one
    JSON value per line, which splits over tasks.
    """
    _require(spark, path)
    raw = spark.read.schema(_LAYOUTS[layout]).option("multiLine", str(not lines).lower()).json(path)
    if layout in _WRAPPED:
        flat = F.array(F.struct("prompt", "response", "reward"))
        raw = raw.select(F.explode(F.coalesce(F.col(_WRAPPED[layout]), flat)).alias("s")).select("s.*")
    elif layout == "grpo":
        # first sample with the highest reward
        best = F.aggregate(
            F.slice("samples", 2, F.greatest(F.size("samples") - 1, F.lit(0))),
            F.get("samples", F.lit(0)),
            lambda a, s: F.when(s["reward"] > a["reward"], s).otherwise(a),
        )
        raw = raw.select("prompt", best["response"].alias("response"), F.col("group_mean_reward").alias("reward"))
    return raw.select(F.lit(layout).alias("method"), "prompt", F.round("reward", 4).alias("reward"), "response")


def write_metrics(df: DataFrame, path: str, reward: str = "reward", kl: str | None = None) -> None:
    """Per-prompt rows (4-digit rewards, 6-digit KL) and one summary row, as JSON lines.

    The rows are written by all tasks; only the one-row summary is aggregated.
    """
    rounded = df.withColumn(reward, F.round(reward, 4))
    summary = [F.round(F.avg(reward), 4).alias("avg_reward"), F.count(F.lit(1)).alias("n")]
    if kl:
        rounded = rounded.withColumn(kl, F.round(kl, 6))
        summary.append(F.round(F.avg(kl), 6).alias("avg_kl"))
    rounded.write.mode("overwrite").json(f"{path}/per_prompt")
    df.agg(*summary).write.mode("overwrite").json(f"{path}/summary")


def write_groups(df: DataFrame, path: str, key: str, prompt: str = "prompt", response: str = "response", reward: str = "reward", block: int = GROUP_BLOCK) -> None:
    """Rows grouped by prompt, as JSON lines ``{prompt, group_mean_reward, group_std_reward, samples[]}``.

    The spread is the sample deviation plus 1e-6, absent for one sample. ``key`` is a unique row id and orders the
    samples. A group of more than ``block`` rows becomes several lines with the same mean and spread, so none is held whole.
    """
    value = F.col("reward")
    rows = df.select(F.col(key).alias("key"), F.col(prompt).alias("prompt"), F.col(response).alias("response"), F.col(reward).cast("double").alias("reward"))
    stats = rows.groupBy("prompt").agg(
        F.round(F.avg(value), 4).alias("mean"), F.round(F.stddev_samp(value) + 1e-6, 4).alias("std"), F.count(F.lit(1)).alias("n")
    )
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / block))
    placed = attach(rows, stats, ["prompt"], "n", ["key"]).withColumn("part", part).withColumn("reward", F.round("reward", 4))
    groups = placed.groupBy("prompt", "mean", "std", "part").agg(F.array_sort(F.collect_list(F.struct("key", "prompt", "response", "reward"))).alias("s"))
    samples = F.transform("s", lambda s: F.struct(s["prompt"].alias("prompt"), s["response"].alias("response"), s["reward"].alias("reward")))
    groups.select("prompt", F.col("mean").alias("group_mean_reward"), F.col("std").alias("group_std_reward"), samples.alias("samples")).write.mode(
        "overwrite"
    ).json(path)


def save_tokenizer(vocab: DataFrame, merges: DataFrame, path: str, vocab_size: int, specials: list[str]) -> None:
    """Vocabulary, merges and settings as three small tables."""
    meta = vocab.sparkSession.createDataFrame([(vocab_size, specials)], "vocab_size int, specials array<string>")
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")
    meta.write.mode("overwrite").parquet(f"{path}/meta")


def load_tokenizer(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(vocab, merges, meta)``; a missing table is an error."""
    for name in ("vocab", "merges", "meta"):
        _require(spark, f"{path}/{name}")
    return (
        spark.read.schema("id int, bytes binary").parquet(f"{path}/vocab"),
        spark.read.schema("rank int, left int, right int, new_id int").parquet(f"{path}/merges"),
        spark.read.schema("vocab_size int, specials array<string>").parquet(f"{path}/meta"),
    )

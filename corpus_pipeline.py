"""The corpus pipeline: toxicity, exact duplicates, near duplicates, benchmark decontamination, pieces.

Every stage takes the documents its predecessor kept, as reread from Parquet. All but the last return the columns of the table they
get. Documents without an id, with null texts or without words pass every filter that has nothing against them; what
each operator does with nulls, ties, repeated rows and empty tables is said in its module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm import exact, minhash, pieces, tiling, toxicity
from corpusflow.plans.storage import scratch_path


#: Texts reach Python in batches of this size in the stages that run when they are written; a batch is held by the JVM and its worker, whole and in copies.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score one half or more as ``labels.toxic`` marks it go."""
    spark.conf.set(*BATCH)
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (A-Z lower-cased) the smallest doc_id stays."""
    return exact.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles the smallest doc_id stays."""
    return minhash.deduplicate(docs, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tiles cover half of a test item go."""
    return tiling.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document with its best segmentations, and whether decoding gives the text back."""
    spark.conf.set(*BATCH)
    return pieces.coded_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("pieces", to_pieces),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

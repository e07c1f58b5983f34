"""Structured Streaming jobs. Each takes a stream and returns a stream; ``run_to_table`` drains one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.window import Window

from ..functions import text as tx
from ..plans.storage import scratch_path
from ..sources.files import is_folder, make_folder


def stream_table(spark: SparkSession, root: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream with the schema its files declare."""
    path = f"{root}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(root)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain a stream to a Parquet table in the shared folder and read it back.

    In append mode the file sink commits exactly once. In update mode each epoch overwrites its own
    folder, so a replayed epoch leaves one copy; rows carry their ``epoch``.
    """
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    writer = stream.writeStream.option("checkpointLocation", f"{base}/checkpoint").outputMode(mode)
    if mode == "append":
        writer = writer.format("parquet").option("path", f"{base}/data")
    else:

        def save(batch: DataFrame, epoch: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/data/epoch={epoch}")

        writer = writer.foreachBatch(save)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    fields = list(stream.schema.fields)
    make_folder(spark, f"{base}/data")  # a stream without rows has written nothing
    schema = T.StructType(fields if mode == "append" else [*fields, T.StructField("epoch", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{base}/data")


# --- rolling buffer -------------------------------------------------------------
def _crop(pdf: pd.DataFrame, key: str, seq: str, window: int, sink: int) -> pd.DataFrame:
    """First ``sink`` and last ``window`` rows of every key in a frame."""
    pdf = pdf.sort_values([key, seq], kind="stable")
    from_front = pdf.groupby(key).cumcount()
    from_back = pdf.groupby(key).cumcount(ascending=False)
    return pdf[(from_front < sink) | (from_back < window)]


def rolling_buffer(stream: DataFrame, key: str, seq: str, value: str, window: int, sink: int = 0) -> DataFrame:
    """After each micro-batch: the first ``sink`` and last ``window`` items per key, as ``[key, arrivals, seqs, values]``.

    Each Arrow batch is cropped per key before the shuffle: a row that is neither
    among the first nor the last of its batch can never be in the buffer. A hot key therefore sends a few
    rows per batch to its one state, and the state itself holds at most ``sink + window`` items.
    """
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    narrow = stream.select(key, seq, value)

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            kept = _crop(pdf, key, seq, window, sink).copy()
            rest = pdf.groupby(key).size() - kept.groupby(key).size()
            first = ~kept.duplicated(key)
            # rows left out are counted on the first kept row of the key
            kept["n"] = 1
            kept.loc[first, "n"] += kept.loc[first, key].map(rest).fillna(0).astype("int64")
            yield kept

    small = narrow.mapInPandas(shrink, f"{key} {types[key]}, {seq} {types[seq]}, {value} {types[value]}, n bigint")

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        arrivals, seqs, values = state.get if state.exists else (0, [], [])
        held = [pd.DataFrame({key: k[0], seq: list(seqs), value: list(values)})] if seqs else []
        for frame in frames:
            arrivals += int(frame["n"].sum())
            held = [_crop(pd.concat([*held, frame[[key, seq, value]]]), key, seq, window, sink)]
        buffer = held[0]
        seqs, values = buffer[seq].tolist(), buffer[value].tolist()
        state.update((arrivals, seqs, values))
        yield pd.DataFrame({key: [k[0]], "arrivals": [arrivals], "seqs": [seqs], "values": [values]})

    body = f"arrivals bigint, seqs array<{types[seq]}>, `values` array<{types[value]}>"
    return small.groupBy(key).applyInPandasWithState(
        update, f"{key} {types[key]}, {body}", body, "update", GroupStateTimeout.NoTimeout
    )


def rolling_buffer_batch(df: DataFrame, key: str, seq: str, window: int, sink: int = 0) -> DataFrame:
    """Batch twin: rows of the final buffer. Both rank limits apply inside tasks before the shuffle."""
    front = F.row_number().over(Window.partitionBy(key).orderBy(F.asc(seq)))
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(seq)))
    last = df.withColumn("_r", back).filter(F.col("_r") <= window).drop("_r")
    if sink == 0:
        return last
    first = df.withColumn("_r", front).filter(F.col("_r") <= sink).drop("_r")
    # both sides hold at most a few rows per key
    return first.unionByName(last).dropDuplicates([key, seq])


# --- best so far ---------------------------------------------------------------
def streaming_best(stream: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """Steps that strictly improve on everything before them, ``[run, step, loss]``.

    Rows of a run must arrive in step order across micro-batches. Inside an Arrow batch
    only its own running minima can be improvements, so only those are shuffled.
    """
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    schema = f"{run} {types[run]}, {step} {types[step]}, {loss} {types[loss]}"

    def minima(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([run, step], kind="stable")
        before = pdf.groupby(run)[loss].transform(lambda s: s.cummin().shift())
        return pdf[before.isna() | (pdf[loss] < before)]

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield minima(pdf)

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = state.get[0] if state.exists else None
        pdf = minima(pd.concat(list(frames)))
        if best is not None:
            pdf = pdf[pdf[loss] < best]
        if len(pdf):
            state.update((float(pdf[loss].min()),))
        yield pdf[[run, step, loss]]

    return (
        stream.select(run, step, loss)
        .mapInPandas(shrink, schema)
        .groupBy(run)
        .applyInPandasWithState(update, schema, "best double", "append", GroupStateTimeout.NoTimeout)
    )


def best_any_order(stream: DataFrame, run: str, step: str, loss: str) -> DataFrame:
    """After each micro-batch the steps of a run that improve on all earlier ones, ``[run, steps, losses]``, newest epoch last.

    Steps may arrive in any order: a late one can add an improvement and take others away. The state of a run is its
    improvements so far, nothing else. Inside an Arrow batch only its own improvements can be one, so only those are
    shuffled. Null losses are no steps; of equal steps the least loss counts.
    """
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}

    def shrink(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf[pdf[loss].notna()].sort_values([run, step, loss], kind="stable")
            least = pdf.groupby(run, dropna=False)[loss].cummin()
            before = least.groupby(pdf[run], dropna=False).shift()
            yield pdf[before.isna() | (pdf[loss] < before)]

    def update(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        steps, losses = state.get if state.exists else ([], [])
        for frame in frames:
            pdf = pd.DataFrame({step: [*steps, *frame[step]], loss: [*losses, *frame[loss]]}).sort_values([step, loss], kind="stable")
            before = pdf[loss].cummin().shift()
            pdf = pdf[before.isna() | (pdf[loss] < before)]
            steps, losses = pdf[step].tolist(), pdf[loss].tolist()
        state.update((steps, losses))
        yield pd.DataFrame({run: [k[0]], "steps": [steps], "losses": [losses]})

    body = f"steps array<{types[step]}>, losses array<{types[loss]}>"
    small = stream.select(run, step, loss).mapInPandas(shrink, f"{run} {types[run]}, {step} {types[step]}, {loss} {types[loss]}")
    return small.groupBy(run).applyInPandasWithState(update, f"{run} {types[run]}, {body}", body, "update", GroupStateTimeout.NoTimeout)


# --- stateless and windowed -------------------------------------------------------
def tokenize_stream(stream: DataFrame, text: str, *keep: str) -> DataFrame:
    """Format arriving text as a prompt and tokenise it: ``[keep.., ids]``."""
    return stream.select(*keep, tx.byte_ids(tx.format_prompt(text)).alias("ids"))


def metric_windows(stream: DataFrame, ts: str, value: Column, length: str, delay: str, *keys: str) -> DataFrame:
    """Count, sum and mean per time window; rows later than ``delay`` are dropped."""
    return (
        stream.withColumn("_ts", F.col(ts).cast("timestamp"))
        .withWatermark("_ts", delay)
        .groupBy(F.window("_ts", length), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(*keys, F.col("window.start").alias("start"), "n", "total", (F.col("total").cast("double") / F.col("n")).alias("mean"))
    )

"""Streaming queries: the tables as streams, drained once, and a plug-in scorer."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import scorer
from corpusflow.plans.storage import scratch_path
from corpusflow.sources import tables as t
from corpusflow.streaming import jobs

from .kit import SFT_ITEMS, big, digest, r6, s_bytes, s_digest, s_prompt, s_r6, with_

WINDOW, SINK = 4, 2
PARTS = 4


def st_roll(spark, root):
    """Final rolling buffer per user, from the stream."""
    return _last_buffer(jobs.stream_table(spark, root, "events"))


def _last_buffer(stream):
    table = jobs.run_to_table(jobs.rolling_buffer(stream, "user_id", "event_id", "value", WINDOW, SINK), "roll", "update")
    # the newest epoch holds a key's current buffer
    last = table.groupBy("user_id").agg(F.max_by(F.struct("arrivals", "seqs", "values"), "epoch").alias("b"))
    return last.select("user_id", "b.arrivals", F.posexplode(F.arrays_zip("b.seqs", "b.values")).alias("slot", "item")).select(
        "user_id", "arrivals", big("slot").alias("slot"), F.col("item.seqs").alias("event_id"), F.col("item.values").alias("value")
    )


def st_roll_batch(spark, root):
    events = t.table(spark, root, "events").select("user_id", "event_id", "value")
    return jobs.rolling_buffer_batch(events, "user_id", "event_id", WINDOW, SINK)


def st_best(spark, root):
    stream = jobs.stream_table(spark, root, "events").select("user_id", "event_id", "value")
    return jobs.run_to_table(jobs.streaming_best(stream, "user_id", "event_id", "value"), "best")


def _backwards(spark, root, name, key):
    """The whole table as a stream of about ``PARTS`` micro-batches, the highest keys first."""
    table = t.table(spark, root, name)
    ends = table.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, width = ends["low"] or 0, (ends["high"] or 0) - (ends["low"] or 0) + 1
    part = F.coalesce(F.floor((F.col(key) - low) * PARTS / width), F.lit(0))
    path = scratch_path(spark, name)
    for i in reversed(range(PARTS)):
        table.filter(part == i).write.mode("append").parquet(path)
    n_files = len(spark.read.parquet(path).inputFiles())
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-n_files // PARTS))).parquet(path)


def st_roll_backwards(spark, root):
    """The rolling buffer with its state carried over micro-batches that arrive in the wrong order."""
    return _last_buffer(_backwards(spark, root, "events", "event_id"))


def st_best_backwards(spark, root):
    """Steps that improve on all before them, from micro-batches that arrive in the wrong order."""
    stream = _backwards(spark, root, "events", "event_id")
    table = jobs.run_to_table(jobs.best_any_order(stream, "user_id", "event_id", "value"), "best", "update")
    last = table.groupBy("user_id").agg(F.max_by(F.arrays_zip("steps", "losses"), "epoch").alias("b"))
    return last.select("user_id", F.explode("b").alias("s")).select("user_id", F.col("s.steps").alias("event_id"), F.col("s.losses").alias("value"))


def st_tokenize(spark, root):
    stream = jobs.stream_table(spark, root, "conversations")
    table = jobs.run_to_table(jobs.tokenize_stream(stream, "text", "conv_id", "turn"), "tokens")
    return table.select("conv_id", "turn", digest("ids").alias("ids_md5"))


def st_metrics(spark, root):
    stream = jobs.stream_table(spark, root, "events")
    out = jobs.metric_windows(stream, "ts", F.col("value").cast("decimal(18,2)"), "1 hour", "10 minutes", "event_type")
    table = jobs.run_to_table(out, "windows", "update")
    last = table.groupBy("event_type", "start").agg(F.max_by(F.struct("n", "mean"), "epoch").alias("b"))
    return last.select("event_type", F.unix_micros("start").alias("start_us"), "b.n", r6("b.mean").alias("mean"))


def _length_scorer(batches):
    """A stand-in for a caller's model: set up once per partition, then applied to whole batches."""
    scale = 1.0 / 100.0
    for pdf in batches:
        yield pd.DataFrame({"pair_id": pdf["pair_id"], "score": pdf["response"].str.len() * scale})


def udf_scorer(spark, root):
    items = t.sft_items(spark, root).select("pair_id", "response")
    return scorer.score_with(items, _length_scorer, "pair_id bigint, score double").withColumn("score", r6("score"))


QUERIES = {f.__name__: f for f in (st_roll, st_roll_batch, st_roll_backwards, st_best, st_best_backwards, st_tokenize, st_metrics, udf_scorer)}

_ROLL = f"""select user_id, event_id, value, count(*) over (partition by user_id) as arrivals,
  row_number() over (partition by user_id order by event_id) as f, row_number() over (partition by user_id order by event_id desc) as b from events"""

_LAST = f"""select user_id, arrivals, row_number() over (partition by user_id order by event_id) - 1 as slot, event_id, value
from ({_ROLL}) where f <= {SINK} or b <= {WINDOW}"""
_BEST = """select user_id, event_id, value from (
  select *, min(value) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as m from events)
where m is null or value < m"""

ORACLE = {
    "st_roll": _LAST,
    "st_roll_backwards": _LAST,
    "st_roll_batch": f"select user_id, event_id, value from ({_ROLL}) where f <= {SINK} or b <= {WINDOW}",
    "st_best": _BEST,
    "st_best_backwards": _BEST,
    "st_tokenize": f"select conv_id, turn, {s_digest(s_bytes(s_prompt('text')))} as ids_md5 from conversations",
    "st_metrics": f"""select event_type, epoch_us(time_bucket(interval '1 hour', ts)) as start_us, count(*) as n,
  {s_r6('cast(sum(cast(value as decimal(18,2))) as double) / count(*)')} as mean from events group by all""",
    "udf_scorer": with_(SFT_ITEMS) + f"select pair_id, {s_r6('length(response) * (1.0::double / 100.0)')} as score from sft_items",
}

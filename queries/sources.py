"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import bpe
from corpusflow.plans.storage import scratch_path
from corpusflow.sources import files
from corpusflow.sources import tables as t

from .kit import PREF_PAIRS, SFT_ITEMS, big, s_strip, with_

FILE_DOCS = 1000


def src_text(spark, root):
    path = scratch_path(spark, "corpus")
    t.table(spark, root, "documents").select("text").write.option("lineSep", "\n").text(path)
    return files.read_corpus(spark, path).groupBy(F.col("text").alias("line")).agg(F.count(F.lit(1)).alias("n"))


def src_bytes(spark, root):
    docs = t.table(spark, root, "documents").select("doc_id", F.encode("text", "UTF-8").alias("b"))
    return docs.select("doc_id", big(F.octet_length("b")).alias("n_bytes"), F.md5("b").alias("digest"))


def src_bytes_files(spark, root):
    """Documents written as text files of ``FILE_DOCS`` ids each, read back as raw bytes."""
    docs = t.table(spark, root, "documents").select(F.expr(f"doc_id div {FILE_DOCS}").alias("file"), "doc_id", "text")
    path = scratch_path(spark, "bytes")
    ordered = docs.repartition("file").sortWithinPartitions("file", "doc_id").select("file", "text")
    ordered.write.partitionBy("file").option("lineSep", "\n").text(path)
    raw = files.read_bytes(spark, path)
    number = F.regexp_extract("path", r"/file=(-?\d+)/", 1)
    return raw.select(big(number).alias("file"), big(F.octet_length("content")).alias("n_bytes"), F.md5("content").alias("digest"))


def src_instruct(spark, root):
    return t.sft_items(spark, root).select("pair_id", "prompt", "response")


def src_nonempty(spark, root):
    turns = t.table(spark, root, "conversations")
    return t.filter_nonempty(turns, "text").select("conv_id", "turn", "text")


def src_prefs(spark, root):
    return t.load_preferences(t.pref_pairs(spark, root), "pair_id")


def src_slice(spark, root):
    return t.head_slice(t.sft_items(spark, root), 100, "pair_id").select("pair_id", "prompt", "response")


def src_prompts(spark, root):
    turns = t.table(spark, root, "conversations").filter(F.col("role") == "user")
    turns = turns.withColumn("prompt_key", t.pair_number("conv_id", "turn"))
    base = t.sample_prompts(turns, 16, "text", "prompt_key")
    return t.cycle_to(base, 64, "prompt_key").select("slot", "prompt_key", F.col("text").alias("prompt"))


def src_metrics(spark, root):
    events = t.table(spark, root, "events").select(
        "event_type",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("response"),
        F.col("value").alias("reward"),
    )
    sample = F.struct("prompt", "response", "reward")
    shapes = {
        "sft": ("view", F.struct(F.array(sample).alias("samples"))),
        "ppo": ("click", sample),
        "grpo": (
            "signup",
            F.struct(
                "prompt",
                F.col("reward").alias("group_mean_reward"),
                F.array(
                    F.struct("prompt", F.lit("low").alias("response"), (F.col("reward") - 1).alias("reward")), sample
                ).alias("samples"),
            ),
        ),
        "dpo": ("purchase", F.struct(F.array(sample).alias("per_prompt"))),
    }
    out = None
    for layout, (event_type, shape) in shapes.items():
        path = scratch_path(spark, f"metrics-{layout}")
        events.filter(F.col("event_type") == event_type).select(F.to_json(shape).alias("value")).write.text(path)
        rows = files.read_metrics(spark, path, layout, lines=True)
        out = rows if out is None else out.unionByName(rows)
    return out


def snk_metrics(spark, root):
    events = t.table(spark, root, "events").select(
        "event_id", F.col("value").alias("reward"), (F.col("value") / 1000).alias("kl")
    )
    path = scratch_path(spark, "metrics")
    files.write_metrics(events, path, "reward", "kl")
    return spark.read.schema("event_id bigint, reward double, kl double").json(f"{path}/per_prompt")


def snk_metrics_summary(spark, root):
    events = t.table(spark, root, "events").select("event_id", F.col("value").alias("reward"), (F.col("value") / 1000).alias("kl"))
    path = scratch_path(spark, "metrics")
    files.write_metrics(events, path, "reward", "kl")
    return spark.read.schema("avg_reward double, n bigint, avg_kl double").json(f"{path}/summary")


def snk_metrics_groups(spark, root):
    """Samples of a user as one group, written and read back: the group's spread and size, its mean and best sample."""
    events = t.table(spark, root, "events").select(
        "event_id",
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("response"),
        (F.col("event_id") % 17 - 8).alias("reward"),
    )
    path = scratch_path(spark, "groups")
    files.write_groups(events, path, "event_id")
    raw = spark.read.schema("prompt string, group_std_reward double, samples array<struct<response: string>>").json(path)
    sizes = raw.select("prompt", F.col("group_std_reward").alias("std"), big(F.size("samples")).alias("n"))
    return files.read_metrics(spark, path, "grpo", lines=True).join(sizes, "prompt")


def snk_tokenizer(spark, root):
    docs = t.table(spark, root, "documents")
    vocab, merges = bpe.train_bpe(docs, 280)
    path = scratch_path(spark, "tokenizer")
    files.save_tokenizer(vocab, merges, path, 280, list(bpe.SPECIALS))
    vocab, merges, _ = files.load_tokenizer(spark, path)
    return vocab.join(merges, vocab["id"] == merges["new_id"], "left").select(
        big("id").alias("id"), F.hex("bytes").alias("bytes"), big("rank").alias("rank")
    )


QUERIES = {
    f.__name__: f
    for f in (
        src_text, src_bytes, src_bytes_files, src_instruct, src_nonempty, src_prefs, src_slice, src_prompts, src_metrics,
        snk_metrics, snk_metrics_summary, snk_metrics_groups, snk_tokenizer,
    )
}

ORACLE = {
    "src_text": "select line, count(*) as n from (select unnest(string_split(text, chr(10))) as line from documents) group by line",
    "src_bytes": "select doc_id, octet_length(encode(text))::bigint as n_bytes, md5(text) as digest from documents",
    "src_bytes_files": f"""select file, octet_length(encode(c))::bigint as n_bytes, md5(c) as digest from (
  select doc_id // {FILE_DOCS} as file, string_agg(coalesce(text, ''), chr(10) order by doc_id) || chr(10) as c from documents group by 1)""",
    "src_instruct": with_(SFT_ITEMS) + "select pair_id, prompt, response from sft_items",
    "src_nonempty": f"select conv_id, turn, text from conversations where length({s_strip('text')}) > 0",
    "src_prefs": with_(PREF_PAIRS)
    + f"""select pair_id, '' as prompt, {s_strip('chosen')} as chosen, {s_strip('rejected')} as rejected from pref_pairs
where length({s_strip('chosen')}) > 0 and length({s_strip('rejected')}) > 0""",
    "src_slice": with_(SFT_ITEMS) + "select pair_id, prompt, response from sft_items order by pair_id limit 100",
    "src_prompts": f"""with base as (
  select conv_id*10000019+turn as prompt_key, text as prompt, row_number() over (order by conv_id*10000019+turn) - 1 as ord
  from conversations where role='user' and length({s_strip('text')}) > 0 order by 1 limit 16)
select s.slot, prompt_key, prompt from range(64) s(slot) join base on ord = s.slot % (select count(*) from base)""",
    "src_metrics": """select case event_type when 'view' then 'sft' when 'click' then 'ppo' when 'signup' then 'grpo' else 'dpo' end as method,
  'u' || user_id as prompt, round(value, 4) as reward, 'e' || event_id as response from events where event_type <> 'error'""",
    "snk_metrics_summary": "select round(avg(value), 4) as avg_reward, count(*) as n, round(avg(value / 1000), 6) as avg_kl from events",
    "snk_metrics_groups": """select 'grpo' as method, 'u' || user_id as prompt, round(avg(r), 4) as reward,
  'e' || arg_min(event_id, event_id - r * 1000000000000) as response, round(stddev_samp(r) + 1e-6, 4) as std, count(*) as n
from (select user_id, event_id, (event_id % 17 - 8) as r from events) group by user_id""",
    "snk_metrics": "select event_id, round(value, 4) as reward, round(value / 1000, 6) as kl from events",
}

"""Run-log queries: the events table read as ten training runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import runlog as rl
from corpusflow.sources import tables as t

from .kit import RUN_LOG, big, r6, s_r6, with_

KEEP = 3
BINS, LO, HI = 20, 0.0, 100.0


def log_every(spark, root):
    return rl.log_every(t.run_log(spark, root), 10, 25).select("run", "step", "loss")


def log_best(spark, root):
    vals = t.run_log(spark, root).filter(F.col("split") == "val")
    return rl.running_best(vals, "run", "step", "loss").select("run", "step", "loss", "best_before", "improved")


def log_retain(spark, root):
    return rl.retain_last(t.run_log(spark, root), KEEP, "run", "step").select("run", "step", "event_id")


def log_rate(spark, root):
    rates = rl.throughput(t.run_log(spark, root), "run", "step", "micros", "tokens")
    return rates.select("run", "step", r6("tokens_per_s").alias("tokens_per_s"))


def log_route(spark, root):
    """Every embedding and every event value as a logged metric."""
    vectors = t.table(spark, root, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit("vec").alias("key"), F.col("embedding").cast("array<double>").alias("values"), F.lit(None).cast("string").alias("text")
    )
    long = t.documents(spark, root, "text").select(
        F.col("doc_id").alias("id"),
        F.lit("doc").alias("key"),
        F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: (i % 7).cast("double")).alias("values"),
        F.lit(None).cast("string").alias("text"),
    )
    events = t.table(spark, root, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "error", F.lit("text/error")).otherwise(F.col("event_type")).alias("key"),
        F.array("value").alias("values"),
        F.col("props").alias("text"),
    )
    routed = rl.route_metrics(vectors.unionByName(long).unionByName(events), text="text")
    return routed.select("id", "tag", "kind", r6("value").alias("value"), "text")


def log_hist(spark, root):
    out = rl.histogram(t.run_log(spark, root), "run", "loss", LO, HI, BINS)
    return out.select("run", big("bin").alias("bin"), "n")


def log_norm(spark, root):
    out = rl.norms(t.table(spark, root, "embeddings"), "embedding", "label")
    return out.select(big("label").alias("label"), r6("l2").alias("l2"), r6("rms").alias("rms"), "n")


QUERIES = {f.__name__: f for f in (log_every, log_best, log_retain, log_rate, log_route, log_hist, log_norm)}

_BEST_BEFORE = "min(loss) over (partition by run order by step rows between unbounded preceding and 1 preceding)"

ORACLE = {
    "log_every": with_(RUN_LOG) + "select run, step, loss from run_log where step % 10 = 0 and step % 25 = 0",
    "log_best": with_(RUN_LOG)
    + f"""select run, step, loss, best_before, best_before is null or loss < best_before as improved
from (select *, {_BEST_BEFORE} as best_before from run_log where split = 'val')""",
    "log_retain": with_(RUN_LOG)
    + f"select run, step, event_id from (select *, row_number() over (partition by run order by step desc) as r from run_log) where r <= {KEEP}",
    "log_rate": with_(RUN_LOG)
    + f"""select run, step, case when prev is not null then {s_r6('tokens / greatest((micros - prev) / 1e6::double, 1e-6::double)')} end as tokens_per_s
from (select *, lag(micros) over (partition by run order by step) as prev from run_log)""",
    "log_route": f"""select vec_id as id, 'vec' as tag, 'histogram' as kind, null::double as value, null::varchar as text from embeddings
union all select doc_id, 'doc', 'scalar', (1 % 7)::double, null from documents where length(text) = 1
union all select doc_id, 'doc', 'histogram', null, null from documents where length(text) <> 1 and length(text) <= 2048
union all select doc_id, 'doc/mean', 'scalar', {s_r6('m')}, null from (
  select doc_id, avg(v) as m from (select doc_id, unnest(range(1, length(text) + 1)) % 7 as v from documents where length(text) > 2048) group by doc_id)
union all select doc_id, 'doc/std', 'scalar', {s_r6('s')}, null from (
  select doc_id, stddev_pop(v) as s from (select doc_id, unnest(range(1, length(text) + 1)) % 7 as v from documents where length(text) > 2048) group by doc_id)
union all select event_id, 'error', 'text', null, props from events where event_type = 'error'
union all select event_id, event_type, 'scalar', {s_r6('value')}, null from events where event_type <> 'error'""",
    "log_hist": with_(RUN_LOG)
    + f"""select run, (case when loss < {LO} then 0 when loss >= {HI} then {BINS} + 1 else floor({BINS} * (loss - {LO}) / ({HI} - {LO}))::int + 1 end)::bigint as bin,
  count(*) as n from run_log group by all""",
    "log_norm": f"""select label::bigint as label, {s_r6('sqrt(sum(x * x))')} as l2, {s_r6('sqrt(avg(x * x))')} as rms, count(*) as n
from (select label, unnest(embedding)::double as x from embeddings) group by label""",
}

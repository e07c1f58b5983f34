"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import evals as ev
from corpusflow.operators import policy as po
from corpusflow.sources import tables as t
from corpusflow.sources import trajectories as tr

from .kit import EVAL_RESULTS, EVAL_TABLE, PREF_PAIRS, big, r6, s_r6, with_
from .ngram import TRAJ
from .rewards import s_words


def ev_f1(spark, root):
    out = ev.token_f1(t.pref_pairs(spark, root), "pair_id", "rejected", "chosen")
    return out.select("pair_id", "overlap", "n_pred", "n_gold", r6("f1").alias("f1"))


def ev_exact(spark, root):
    return ev.exact_match(t.pref_pairs(spark, root), "pair_id", "rejected", "chosen")


def _table(spark, root):
    return ev.comparison_table(t.eval_results(spark, root), "reward")


def ev_table(spark, root):
    return _table(spark, root).select("prompt", *[r6(m).alias(m) for m in ev.METHODS])


def ev_table_events(spark, root):
    """One row per (user, method) from raw events: a later event replaces an earlier one."""
    rows = t.table(spark, root, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"),
        F.when(F.col("event_type") == "view", "sft")
        .when(F.col("event_type") == "click", "ppo")
        .when(F.col("event_type") == "signup", "grpo")
        .when(F.col("event_type") == "purchase", "dpo")
        .alias("method"),
        F.col("value").alias("reward"),
        "event_id",
    )
    return ev.comparison_table(rows, "event_id")


def ev_winner(spark, root):
    return ev.winner(_table(spark, root)).select("prompt", "winner")


def ev_avg(spark, root):
    return ev.method_averages(_table(spark, root), digits=None).select(*[r6(m).alias(m) for m in ev.METHODS])


def ev_overall(spark, root):
    best = ev.overall_winner(ev.method_averages(_table(spark, root), digits=None))
    return best.select("method", r6("score").alias("score"))


def ev_best_delta(spark, root):
    out = ev.best_delta(_table(spark, root))
    return out.select("method", "prompt", r6("sft").alias("sft"), r6("score").alias("score"), r6("delta").alias("delta"))


def ev_worst(spark, root):
    return ev.worst_prompt(_table(spark, root)).select("method", "prompt", r6("score").alias("score"))


def _best_samples(spark, root):
    samples = t.table(spark, root, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("prompt"),
        F.col("value").alias("reward"),
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("response"),
        "event_id",
    )
    return ev.best_of_group(samples, "prompt", "reward", "response", "event_id")


def ev_best_of(spark, root):
    return _best_samples(spark, root).select("prompt", "response", "reward")


def ev_responses(spark, root):
    """Best sample per prompt attached to the table; low-scoring prompts have none recorded."""
    good = _best_samples(spark, root).filter(F.col("reward") > 60)
    return ev.attach_response(_table(spark, root).select("prompt"), good)


def ev_phase(spark, root):
    """Even users are phase 1, odd users phase 5."""
    events = t.table(spark, root, "events").select(
        F.col("event_type").alias("method"),
        F.when(F.col("user_id") % 2 == 0, 1).otherwise(5).alias("phase"),
        F.col("value").alias("reward"),
    )
    out = ev.phase_delta(events)
    return out.select("method", *[r6(c).alias(c) for c in ("phase1", "phase5", "delta")])


def ev_summary(spark, root):
    kl = po.approx_kl(tr.action_rows(spark, root), "traj_id").select("traj_id", "kl")
    rows = tr.sequences(spark, root).select("traj_id", "reward").join(kl, "traj_id")
    return ev.summary(rows, digits=False).select(r6("avg_reward").alias("avg_reward"), r6("avg_kl").alias("avg_kl"), "n")


QUERIES = {
    f.__name__: f
    for f in (
        ev_f1, ev_exact, ev_table, ev_table_events, ev_winner, ev_avg, ev_overall, ev_best_delta, ev_worst, ev_best_of,
        ev_responses, ev_phase, ev_summary,
    )
}

_CASE = "case event_type when 'view' then 'sft' when 'click' then 'ppo' when 'signup' then 'grpo' when 'purchase' then 'dpo' end"
_AVG = "cast(sum(cast({m} as decimal(28,10))) as double) / count(*)"
_LONG = f"""{EVAL_TABLE},
long3 as (select prompt, sft, 'ppo' as method, ppo as score from table4 union all select prompt, sft, 'grpo', grpo from table4
          union all select prompt, sft, 'dpo', dpo from table4)"""
_BEST = """best as (select prompt, response, reward from (
  select 'u' || user_id as prompt, 'e' || event_id as response, value as reward, row_number() over (partition by user_id order by value desc, event_id) as r
  from events) where r = 1)"""

ORACLE = {
    "ev_f1": with_(PREF_PAIRS)
    + f""", w as (select pair_id, {s_words('rejected')} as p, {s_words('chosen')} as g from pref_pairs),
pw as (select pair_id, word, count(*) as n from (select pair_id, unnest(p) as word from w) group by all),
gw as (select pair_id, word, count(*) as n from (select pair_id, unnest(g) as word from w) group by all),
ov as (select pw.pair_id, sum(least(pw.n, gw.n))::bigint as o from pw join gw on gw.pair_id = pw.pair_id and gw.word = pw.word group by pw.pair_id)
select w.pair_id, coalesce(o, 0) as overlap, len(p)::bigint as n_pred, len(g)::bigint as n_gold,
  {s_r6('case when len(p) = 0 and len(g) = 0 then 1.0::double when coalesce(o, 0) = 0 then 0.0::double else 2.0::double * o / (len(p) + len(g)) end')} as f1
from w left join ov on ov.pair_id = w.pair_id""",
    "ev_exact": with_(PREF_PAIRS)
    + "select pair_id, trim(regexp_replace(lower(rejected), '[^a-z0-9]+', ' ', 'g')) = trim(regexp_replace(lower(chosen), '[^a-z0-9]+', ' ', 'g')) as exact from pref_pairs",
    "ev_table": with_(EVAL_TABLE) + "select prompt, " + ", ".join(f"{s_r6(m)} as {m}" for m in ev.METHODS) + " from table4",
    "ev_table_events": "select prompt, sft, ppo, grpo, dpo from (select 'u' || user_id as prompt, "
    + ", ".join(f"arg_max(value, event_id) filter (where {_CASE} = '{m}') as {m}" for m in ev.METHODS)
    + " from events group by user_id) where sft is not null",
    "ev_winner": with_(EVAL_TABLE)
    + """select prompt, case when sft = b then 'sft' when ppo = b then 'ppo' when grpo = b then 'grpo' else 'dpo' end as winner
from (select *, greatest(sft, ppo, grpo, dpo) as b from table4)""",
    "ev_avg": with_(EVAL_TABLE) + "select " + ", ".join(f"{s_r6(_AVG.format(m=m))} as {m}" for m in ev.METHODS) + " from table4",
    "ev_overall": with_(EVAL_TABLE)
    + ", a as (" + " union all ".join(f"select {i} as place, '{m}' as method, {_AVG.format(m=m)} as score from table4" for i, m in enumerate(ev.METHODS))
    + f") select method, {s_r6('score')} as score from a order by a.score desc, place limit 1",
    "ev_best_delta": with_(_LONG)
    + f"""select method, prompt, {s_r6('sft')} as sft, {s_r6('score')} as score, {s_r6('coalesce(score, 0) - coalesce(sft, 0)')} as delta from (
  select *, row_number() over (partition by method order by coalesce(nullif(score, 0), -999) - coalesce(sft, 0) desc, prompt) as r from long3) where r = 1""",
    "ev_worst": with_(_LONG)
    + f"""select method, prompt, {s_r6('score')} as score from (
  select *, row_number() over (partition by method order by coalesce(nullif(score, 0), 999), prompt) as r from long3) where r = 1""",
    "ev_best_of": with_(_BEST) + "select prompt, response, reward from best",
    "ev_responses": with_(EVAL_TABLE, _BEST)
    + "select t.prompt, coalesce(b.response, '[no response recorded]') as response from table4 t left join (select * from best where reward > 60) b on b.prompt = t.prompt",
    "ev_phase": f"""select method, {s_r6('p1')} as phase1, {s_r6('p5')} as phase5, {s_r6('p5 - p1')} as delta from (
  select event_type as method,
    cast(sum(cast(value as decimal(28,10))) filter (where user_id % 2 = 0) as double) / count(*) filter (where user_id % 2 = 0) as p1,
    cast(sum(cast(value as decimal(28,10))) filter (where user_id % 2 = 1) as double) / count(*) filter (where user_id % 2 = 1) as p5
  from events group by event_type)""",
    "ev_summary": with_(TRAJ)
    + f"""select {s_r6('avg(s.reward)')} as avg_reward, {s_r6('avg(kl)')} as avg_kl, count(*) as n
from seqs s join (select traj_id, avg(old_logp - ref_logp) as kl from act group by traj_id) k on k.traj_id = s.traj_id""",
}

"""Policy-optimisation queries over the derived trajectories."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import policy as po
from corpusflow.plans.storage import cut_lineage
from corpusflow.sources import tables as t
from corpusflow.sources import trajectories as tr

from .kit import CORPUS_LM, PREF_PAIRS, big, r6, s_bytes, s_dense, s_prompt, s_r6, with_
from .ngram import DPO_SIZE, QUALITY_LM, TRAJ, pair_logps

KL_COEF, EPS, BETA = 0.1, 0.2, 0.1


def _actions(spark, root):
    return tr.action_rows(spark, root)


def _shaped(spark, root):
    return po.advantages(po.shape_rewards(_actions(spark, root), KL_COEF))


def po_kl_tok(spark, root):
    return po.kl_tokens(_actions(spark, root)).select("traj_id", big("pos").alias("pos"), r6("kl").alias("kl"))


def po_kl(spark, root):
    return po.approx_kl(_actions(spark, root), "traj_id").select("traj_id", r6("kl").alias("kl"), "n")


def po_kl_move(spark, root):
    return po.kl_diagnostics(_actions(spark, root)).select(r6("kl_move").alias("kl_move"), r6("kl_ref").alias("kl_ref"))


def po_shape(spark, root):
    return po.shape_rewards(_actions(spark, root), KL_COEF).select("traj_id", big("pos").alias("pos"), r6("shaped").alias("shaped"))


def po_adv(spark, root):
    return _shaped(spark, root).select("traj_id", big("pos").alias("pos"), r6("adv").alias("adv"), r6("ret").alias("ret"))


def po_adv_norm(spark, root):
    return po.normalize_adv(_shaped(spark, root)).select("traj_id", big("pos").alias("pos"), r6("adv_norm").alias("adv_norm"))


def po_adv_norm_batch(spark, root):
    """Normalised per batch, a batch being the trajectories of one prompt."""
    rows = po.normalize_adv(_shaped(spark, root), key="prompt_id", salt_by=("traj_id", "pos"))
    return rows.select("traj_id", big("pos").alias("pos"), r6("adv_norm").alias("adv_norm"))


def po_ratio(spark, root):
    return _actions(spark, root).select(
        "traj_id",
        big("pos").alias("pos"),
        r6(po.ratio("new_logp", "old_logp")).alias("ratio"),
        r6(po.clipped_ratio("new_logp", "old_logp", EPS)).alias("clipped"),
    )


def po_ppo(spark, root):
    rows = po.normalize_adv(_shaped(spark, root)).withColumn("adv", F.col("adv_norm")).withColumn("new_value", F.col("value"))
    out = po.ppo_losses(rows, EPS, 0.5, 0.01)
    return out.select(*[r6(c).alias(c) for c in out.columns])


def _samples(spark, root):
    """Rollout groups at table scale: a prompt is a user's day, a sample one event."""
    return t.table(spark, root, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("prompt_id"),
        "event_id",
        F.col("value").alias("reward"),
        F.col("event_type").alias("response"),
    )


def _grouped(spark, root, mode):
    rows = po.group_advantage(_samples(spark, root), mode, salt_by=("event_id",))
    return rows.select(
        "event_id", "prompt_id", r6("group_mean").alias("group_mean"), r6("group_std").alias("group_std"), r6("adv").alias("adv")
    )


def po_group(spark, root):
    return _grouped(spark, root, "clamp")


def po_group_center(spark, root):
    return _grouped(spark, root, "center")


def po_group_eps(spark, root):
    return _grouped(spark, root, "eps")


def _traj_adv(seqs, mode="center"):
    trajs = seqs.select("traj_id", "prompt_id", "reward", "response")
    return po.group_advantage(trajs, mode, salt_by=("traj_id",))


def _broadcast(spark, root):
    seqs = cut_lineage(tr.sequences(spark, root))
    return po.adv_to_tokens(tr.action_rows(spark, root, seqs), _traj_adv(seqs))


def po_broadcast(spark, root):
    return _broadcast(spark, root).select("traj_id", big("pos").alias("pos"), r6("adv").alias("adv"), r6("adv_norm").alias("adv_norm"))


def po_grpo(spark, root):
    out = po.grpo_losses(_broadcast(spark, root).withColumn("adv", F.col("adv_norm")), EPS, 0.0, KL_COEF)
    return out.select(*[r6(c).alias(c) for c in out.columns])


def po_grpo_seq(spark, root):
    seqs = cut_lineage(tr.sequences(spark, root))
    sums = tr.action_rows(spark, root, seqs).groupBy("traj_id").agg(F.sum("new_logp").alias("logp"), F.sum("ref_logp").alias("ref_logp"))
    rows = _traj_adv(seqs, "clamp").select("traj_id", "prompt_id", "adv").join(sums, "traj_id")
    return po.grpo_sequence_loss(rows, KL_COEF).select("prompt_id", r6("loss").alias("loss"), "n")


def po_dpo(spark, root):
    out = po.dpo_loss(pair_logps(spark, root), BETA)
    return out.select(*[(r6(c) if c != "n" else F.col(c)).alias(c) for c in out.columns])


def po_collapse(spark, root):
    out = po.collapsed_groups(_samples(spark, root), 5.0)
    return out.select("prompt_id", "n", "n_distinct", r6("std").alias("std"))


def po_value_last(spark, root):
    return po.last_value(_actions(spark, root)).select("traj_id", r6("value").alias("value"))


QUERIES = {
    f.__name__: f
    for f in (
        po_kl_tok, po_kl, po_kl_move, po_shape, po_adv, po_adv_norm, po_adv_norm_batch, po_ratio, po_ppo, po_group,
        po_group_center, po_group_eps, po_broadcast, po_grpo, po_grpo_seq, po_dpo, po_collapse, po_value_last,
    )
}

_SHAPED = f"""{TRAJ},
shaped as (select *, case when pos = seq_len - 1 then reward else 0.0::double end - {KL_COEF}::double * (old_logp - ref_logp) as sh from act),
advs as materialized (select *, sh - value as adv from shaped)"""
_NORM = f"""{_SHAPED},
normed as (select *, (adv - avg(adv) over ()) / greatest(stddev_samp(adv) over (), 1e-6) as adv_norm
           from (select traj_id, pos, new_logp, old_logp, value, sh, adv from advs))"""
_SAMPLES = """samples as (select user_id || '-' || strftime(ts, '%Y-%m-%d') as prompt_id, event_id, value as reward, event_type as response from events),
gst as (select prompt_id, avg(reward) as gm, stddev_samp(reward) as gs, count(*) as n from samples group by prompt_id)"""
_TADV = f"""{TRAJ},
tadv as (select traj_id, prompt_id, reward - avg(reward) over (partition by prompt_id) as c,
  case when count(*) over (partition by prompt_id) > 1 then
    (reward - avg(reward) over (partition by prompt_id)) / greatest(stddev_samp(reward) over (partition by prompt_id), 1e-6) end as z from seqs),
tok as (select act.traj_id, pos, new_logp, old_logp, ref_logp, tadv.c as adv from act join tadv on tadv.traj_id = act.traj_id),
tokn as (select *, (adv - avg(adv) over ()) / greatest(stddev_samp(adv) over (), 1e-6) as adv_norm from tok)"""


def _group_sql(adv: str) -> str:
    return with_(_SAMPLES) + (
        f"select event_id, s.prompt_id, {s_r6('gm')} as group_mean, {s_r6('gs')} as group_std, {s_r6(adv)} as adv"
        " from samples s join gst g on g.prompt_id = s.prompt_id"
    )


_SURR = f"avg(least(exp(new_logp - old_logp) * adv_norm, least(greatest(exp(new_logp - old_logp), 1 - {EPS}::double), 1 + {EPS}::double) * adv_norm))"


def _logps_sql(name: str, lm: str) -> str:
    return f"""{name} as (
  select pair_id, sum(case when side = 'c' and i >= np then logp else 0 end) as c, sum(case when side = 'r' and i >= np then logp else 0 end) as r
  from steps2 s join {lm} l on l.ctx = s.ctx and l.next = s.next group by pair_id)"""


_DPO = f"""{PREF_PAIRS}, {CORPUS_LM}, {QUALITY_LM},
sides as (select pair_id, side, p, case when len(r) >= {DPO_SIZE} then r[1:{DPO_SIZE} - 1] else r end as r from (
  select pair_id, 'c' as side, {s_bytes(s_prompt('prompt'))} as p, {s_bytes('chosen')} as r from pref_pairs
  union all select pair_id, 'r', {s_bytes(s_prompt('prompt'))}, {s_bytes('rejected')} from pref_pairs)),
built as (select pair_id, side, r, case when len(p) + len(r) > {DPO_SIZE} then p[len(p) + len(r) - {DPO_SIZE} + 1:] else p end as p from sides),
steps2 as (select pair_id, side, np, i, ids[i] as ctx, ids[i+1] as next
  from (select pair_id, side, len(p) as np, list_concat(p, r) as ids, unnest(range(1, len(p) + len(r))) as i from built)),
{_logps_sql('pol', 'lm_new0')},
{_logps_sql('rf', 'lm')},
mg as (select (pol.c - rf.c) - (pol.r - rf.r) as m from pol join rf on rf.pair_id = pol.pair_id)"""

ORACLE = {
    "po_kl_tok": with_(TRAJ) + f"select traj_id, pos, {s_r6('old_logp - ref_logp')} as kl from act",
    "po_kl": with_(TRAJ) + f"select traj_id, {s_r6('avg(old_logp - ref_logp)')} as kl, count(*) as n from act group by traj_id",
    "po_kl_move": with_(TRAJ) + f"select {s_r6('avg(old_logp - new_logp)')} as kl_move, {s_r6('avg(new_logp - ref_logp)')} as kl_ref from act",
    "po_shape": with_(_SHAPED) + f"select traj_id, pos, {s_r6('sh')} as shaped from shaped",
    "po_adv": with_(_SHAPED) + f"select traj_id, pos, {s_r6('adv')} as adv, {s_r6('sh')} as ret from advs",
    "po_adv_norm": with_(_NORM) + f"select traj_id, pos, {s_r6('adv_norm')} as adv_norm from normed",
    "po_adv_norm_batch": with_(_SHAPED)
    + f"""select traj_id, pos, {s_r6('(adv - m) / greatest(s, 1e-6)')} as adv_norm
from (select *, avg(adv) over (partition by prompt_id) as m, stddev_samp(adv) over (partition by prompt_id) as s from advs)""",
    "po_ratio": with_(TRAJ)
    + f"""select traj_id, pos, {s_r6('exp(new_logp - old_logp)')} as ratio,
  {s_r6(f'least(greatest(exp(new_logp - old_logp), 1 - {EPS}::double), 1 + {EPS}::double)')} as clipped from act""",
    "po_ppo": with_(_NORM)
    + f"""select {s_r6('p')} as policy_loss, {s_r6('v')} as value_loss, {s_r6('e')} as entropy_approx, {s_r6('k')} as approx_kl,
  {s_r6('p + 0.5 * v - 0.01::double * e')} as total_loss
from (select -{_SURR} as p, avg((value - sh) * (value - sh)) as v, -avg(new_logp) as e, avg(old_logp - new_logp) as k from normed)""",
    "po_group": _group_sql("case when n > 1 then (reward - gm) / greatest(gs, 1e-6) end"),
    "po_group_center": _group_sql("reward - gm"),
    "po_group_eps": _group_sql("(reward - gm) / (gs + 1e-6)"),
    "po_broadcast": with_(_TADV) + f"select traj_id, pos, {s_r6('adv')} as adv, {s_r6('adv_norm')} as adv_norm from tokn",
    "po_grpo": with_(_TADV)
    + f"""select {s_r6('p')} as policy_loss, {s_r6('e')} as entropy_approx, {s_r6('k')} as approx_kl, {s_r6('f')} as kl_ref,
  {s_r6(f'p + {KL_COEF}::double * f')} as total_loss
from (select -{_SURR} as p, -avg(new_logp) as e, avg(old_logp - new_logp) as k, avg(new_logp - ref_logp) as f from tokn)""",
    "po_grpo_seq": with_(_TADV)
    + f"""select t.prompt_id, {s_r6(f'-avg(z * (lp - {KL_COEF}::double * (lp - rp)))')} as loss, count(*) as n
from tadv t join (select traj_id, sum(new_logp) as lp, sum(ref_logp) as rp from act group by traj_id) s on s.traj_id = t.traj_id group by t.prompt_id""",
    "po_dpo": with_(_DPO)
    + f"""select {s_r6(f'avg(greatest(-{BETA}::double * m, 0) + ln(1 + exp(-abs({BETA}::double * m))))')} as loss,
  {s_r6('avg(case when m > 0 then 1.0::double else 0 end)')} as accuracy, {s_r6('avg(m)')} as reward_margin, count(*) as n from mg""",
    "po_collapse": with_(_SAMPLES)
    + f"""select prompt_id, count(*) as n, count(distinct response) as n_distinct, {s_r6('stddev_samp(reward)')} as std
from samples group by prompt_id having count(*) > 1 and stddev_samp(reward) < 5.0""",
    "po_value_last": with_(TRAJ) + f"select traj_id, {s_r6('arg_max(value, pos)')} as value from act group by traj_id",
}

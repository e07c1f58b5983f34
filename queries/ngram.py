"""Next-token model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import bpe
from corpusflow.operators import ngram as ng
from corpusflow.operators import sequences as sq
from corpusflow.sources import tables as t
from corpusflow.sources import trajectories as tr

from .kit import (
    CORPUS_LM, DOC_BYTES, DOC_PAIRS, PREF_PAIRS, SFT_ITEMS, big, r6, s_bytes, s_dense, s_format, s_prompt, s_r6, with_,
)
from .sequences import SEED, stream_of
from .tokens import BPE_TRAIN, BPE_VOCAB, s_bpe_ids

TEMPERATURE = 0.8
EVAL_BATCHES, EVAL_ROWS, EVAL_BLOCK = 20, 16, 64
MAX_NEW = 24
TRIGRAM_NEW = 16
SFT_SIZE, DPO_SIZE = 256, 512


def lm_fit(spark, root):
    return tr.corpus_model(spark, root).counts.select(big("ctx").alias("ctx"), big("next").alias("next"), big("n").alias("n"))


def lm_fit_bpe(spark, root):
    """The model over learnt merges instead of bytes."""
    docs = t.documents(spark, root, "text")
    _, merges = bpe.train_bpe(docs, BPE_VOCAB)
    counts = ng.fit_ngram(bpe.bpe_encode(docs, merges), vocab=BPE_VOCAB).counts
    return counts.select(big("ctx").alias("ctx"), big("next").alias("next"), big("n").alias("n"))


def _logits(spark, root):
    return tr.corpus_model(spark, root).dense("logit")


def lm_logits(spark, root):
    dist = ng.next_token_dist(_logits(spark, root), TEMPERATURE)
    return dist.select(big("ctx").alias("ctx"), big("next").alias("next"), r6(F.ln("p")).alias("logp"))


def lm_gather(spark, root):
    items = t.sft_items(spark, root).select("pair_id", tx.byte_ids(tx.format_example("prompt", "response")).alias("ids"))
    rows = ng.token_logprobs(items, tr.corpus_model(spark, root), "pair_id")
    return rows.select("pair_id", big("pos").alias("pos"), big("token").alias("token"), r6("logp").alias("logp"))


def lm_nll(spark, root):
    batch = sq.sft_collate(t.sft_items(spark, root).select("pair_id", "prompt", "response"), SFT_SIZE)
    rows = batch.select(F.explode(F.arrays_zip("ids", "labels")).alias("t")).select(
        big("t.ids").alias("ctx"), F.col("t.labels").alias("next")
    )
    # ignored positions carry no pair of the table, so the filter comes first
    scored = ng.score_transitions(rows.filter(F.col("next") != -100), tr.corpus_model(spark, root))
    return ng.masked_cross_entropy(scored, label="next").select(r6("loss").alias("loss"), "n")


def lm_eval(spark, root):
    """Mean of batch means per split, over reproducible random blocks of each split."""
    docs, total = stream_of(spark, root)
    parts = sq.split_by_position(docs, total).select("split", "ids", "start")
    sizes = parts.groupBy("split").agg(F.sum(F.size("ids").cast("bigint")).alias("n"))
    draws = spark.range(EVAL_BATCHES * EVAL_ROWS).withColumnRenamed("id", "sample")
    # two splits: each draws the same number of blocks
    starts = sizes.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(EVAL_BATCHES * EVAL_ROWS - 1)))).select(
        "split",
        big("sample").alias("sample"),
        big(F.floor(tx.uniform(F.lit(SEED), "split", "sample") * (F.col("n") - EVAL_BLOCK - 1))).alias("s"),
    )
    drawn = sq.cut_blocks(parts, starts, EVAL_BLOCK, "split")
    pairs = drawn.select("split", "sample", F.explode(F.arrays_zip("x", "y")).alias("p")).select(
        "split", F.floor(F.col("sample") / EVAL_ROWS).alias("batch"), big("p.x").alias("ctx"), F.col("p.y").alias("next")
    )
    scored = ng.score_transitions(pairs, tr.corpus_model(spark, root)).withColumn("loss", -F.col("logp"))
    return ng.estimate_loss(scored, "split", "batch", "loss").select("split", r6("loss").alias("loss"), "n_batches")


def pair_logps(spark, root):
    """``[pair_id, pc, pr, rc, rr]``: response log-probs of both sides under the policy and the reference."""
    pairs = t.pref_pairs(spark, root)
    sides = pairs.select(
        "pair_id",
        tx.byte_ids(tx.format_prompt("prompt")).alias("prompt_ids"),
        F.explode(
            F.array(
                F.struct(F.lit("c").alias("side"), F.col("chosen").alias("text")),
                F.struct(F.lit("r").alias("side"), F.col("rejected").alias("text")),
            )
        ).alias("s"),
    ).select("pair_id", "s.side", "prompt_ids", tx.byte_ids("s.text").alias("response_ids"))
    built = sq.build_pair(sides, DPO_SIZE)
    rows = built.select("pair_id", "side", "resp_mask", F.explode(ng.transitions("ids")).alias("t")).select(
        "pair_id", "side", F.get("resp_mask", F.col("t.pos")).alias("is_response"), F.col("t.ctx").alias("ctx"), F.col("t.next").alias("next")
    )
    # the table has one row per byte pair, so its size does not depend on the data
    scored = rows.join(F.broadcast(tr.policy_tables(spark, root)), ["ctx", "next"])

    def side(logp, s, name):
        return F.sum(F.when(F.col("is_response") & (F.col("side") == s), F.col(logp)).otherwise(0.0)).alias(name)

    return scored.groupBy("pair_id").agg(
        side("new_logp", "c", "pc"), side("new_logp", "r", "pr"), side("ref_logp", "c", "rc"), side("ref_logp", "r", "rr")
    )


def lm_seq_logp(spark, root):
    rows = tr.traj_tokens(spark, root)
    return ng.sequence_logps(rows, "traj_id", "is_response", "ref_logp").select("traj_id", r6("seq_logp").alias("seq_logp"))


def lm_topk(spark, root):
    dist = ng.top_k(ng.next_token_dist(_logits(spark, root), TEMPERATURE), 40)
    return dist.select(big("ctx").alias("ctx"), big("next").alias("next"), r6("p").alias("p"))


def lm_topp(spark, root):
    dist = ng.top_p(ng.top_k(ng.next_token_dist(_logits(spark, root), TEMPERATURE), 40), 0.9)
    return dist.select(big("ctx").alias("ctx"), big("next").alias("next"), r6("p").alias("p"))


def lm_sample(spark, root):
    drawn = ng.sample_next(ng.next_token_dist(_logits(spark, root), TEMPERATURE), SEED)
    return drawn.select(big("ctx").alias("ctx"), big("next").alias("next"))


def _prompts(spark, root):
    return t.sft_items(spark, root).select("pair_id", tx.byte_ids(tx.format_prompt("prompt")).alias("prompt_ids"))


def lm_generate(spark, root):
    out = ng.generate(
        _prompts(spark, root), tr.corpus_model(spark, root), MAX_NEW, "pair_id", temperature=TEMPERATURE, k=40, p=0.9, seed=SEED, group_size=2
    )
    return out.select("pair_id", big("sample").alias("sample"), F.array_join(F.col("new_ids").cast("array<string>"), ",").alias("new_ids"))


def lm_generate_greedy(spark, root):
    out = ng.generate(_prompts(spark, root), tr.corpus_model(spark, root), MAX_NEW, "pair_id", temperature=0)
    return out.select("pair_id", F.array_join(F.col("new_ids").cast("array<string>"), ",").alias("new_ids"))


def _trigram_model(spark, root):
    return ng.fit_ngram(t.documents(spark, root, "text"), order=3, ids="text")


def lm_fit_trigram(spark, root):
    return _trigram_model(spark, root).counts.select(big("ctx").alias("ctx"), big("next").alias("next"), big("n").alias("n"))


def lm_generate_trigram(spark, root):
    """Unseen tokens and contexts drawn from a model that is too large for one table of all tokens."""
    out = ng.generate(_prompts(spark, root), _trigram_model(spark, root), TRIGRAM_NEW, "pair_id", temperature=1.2, p=0.95, seed=SEED)
    return out.select("pair_id", F.array_join(F.col("new_ids").cast("array<string>"), ",").alias("new_ids"))


def lm_ppl(spark, root):
    docs = t.documents(spark, root, "lang", "text")
    out = ng.cross_entropy(docs, tr.corpus_model(spark, root), "lang", ids="text")
    return out.select("lang", r6("nll").alias("nll"), r6("ppl").alias("ppl"), big("n_tokens").alias("n_tokens"))


QUERIES = {
    f.__name__: f
    for f in (
        lm_fit_bpe, lm_fit, lm_logits, lm_gather, lm_nll, lm_eval, lm_seq_logp, lm_topk, lm_topp, lm_sample, lm_generate,
        lm_generate_greedy, lm_fit_trigram, lm_generate_trigram, lm_ppl,
    )
}

_DIST = f"""{CORPUS_LM},
d0 as (select ctx, next, logp / {TEMPERATURE}::double as logit from lm),
dist as (select ctx, next, logit, exp(logit - max(logit) over (partition by ctx)) / sum(exp(logit - m)) over (partition by ctx) as p
         from (select *, max(logit) over (partition by ctx) as m from d0))"""
_TOPK = f"""{_DIST},
dk as (select ctx, next, logit, p / sum(p) over (partition by ctx) as p
       from (select *, rank() over (partition by ctx order by logit desc) as r from dist) where r <= 40)"""
_TOPP = f"""{_TOPK},
dp as (select ctx, next, p / sum(p) over (partition by ctx) as p from (
  select *, sum(p) over w as c, row_number() over w as r from dk
  window w as (partition by ctx order by logit desc, next rows between unbounded preceding and current row)) where r = 1 or c <= 0.9::double)"""


def _cum(name: str, source: str) -> str:
    return f"""{name} as (select ctx, next, coalesce(lag(hi) over (partition by ctx order by next), 0.0::double) as lo, hi from (
  select ctx, next, case when lead(next) over (partition by ctx order by next) is null then 1.0::double
    else sum(p) over (partition by ctx order by next rows between unbounded preceding and current row) end as hi from {source}))"""


def s_uniform(*parts: str) -> str:
    joined = " || '-' || ".join(parts)
    return f"(('0x' || substr(md5({joined}), 1, 8))::bigint / 4294967296.0::double)"


_LAST = f"coalesce({s_bytes(s_prompt('prompt'))}[-1], 10)"

# documents restricted to good ones: the old / new policy counts
QUALITY_LM = f"""good_n as (
  select ctx, next, count(*) as n from doc_pairs where doc_id in (select doc_id from labels where quality = 1) group by ctx, next),
{s_dense('lm_old', 'good_n', '1.0')},
{s_dense('lm_new0', 'good_n', '0.5')}"""

TRAJ = f"""{SFT_ITEMS}, {CORPUS_LM}, {QUALITY_LM},
seqs as (select pair_id as traj_id, conv_id as prompt_id, response, {s_bytes(s_format('prompt', 'response'))} as ids,
                octet_length(encode({s_prompt('prompt')})) as boundary, (length(response) % 17 - 8)::double as reward from sft_items),
steps as (select traj_id, prompt_id, boundary, reward, len(ids) as seq_len, i as pos, ids[i] as ctx, ids[i+1] as next
          from (select *, unnest(range(1, len(ids))) as i from seqs)),
traj as (select s.traj_id, s.prompt_id, s.pos, s.seq_len, s.next as token, s.pos >= s.boundary as is_response,
                r.logp as ref_logp, o.logp as old_logp, n.logp as new_logp, s.pos / s.seq_len as value, s.reward
         from steps s join lm r on r.ctx = s.ctx and r.next = s.next join lm_old o on o.ctx = s.ctx and o.next = s.next
         join lm_new0 n on n.ctx = s.ctx and n.next = s.next),
act as (select * from traj where is_response)"""

_SPLIT_STREAM = f"""{DOC_PAIRS},
pair_n as (select ctx, next, count(*) as n from doc_pairs group by ctx, next),
{s_dense('lm', 'pair_n', '1.0')},
doc_pos as (select doc_id, (sum(len(h)) over (order by doc_id) - len(h))::bigint as start from doc_hex),
stream as (select p.start + i - 1 as pos, ('0x' || h[i])::int as token
  from (select doc_id, h, unnest(range(1, len(h) + 1)) as i from doc_hex) d join doc_pos p on p.doc_id = d.doc_id),
tot as (select count(*) as n from stream),
cut as (select floor(n * 0.9::double)::bigint as c, n from tot),
halves as (select 'train' as split, pos, token from stream where pos < (select c from cut)
           union all select 'val', pos - (select c from cut), token from stream where pos >= (select c from cut))"""

_TRI = f"""{DOC_BYTES},
tri as (select ('0x' || h[i])::bigint * 256 + ('0x' || h[i+1])::bigint as ctx, ('0x' || h[i+2])::bigint as next, count(*) as n
        from (select h, unnest(range(1, len(h) - 1)) as i from doc_hex) group by all)"""

ORACLE = {
    "lm_fit_bpe": with_(BPE_TRAIN, s_bpe_ids("select doc_id as key, text from documents"))
    + "select l[i]::bigint as ctx, l[i + 1]::bigint as next, count(*) as n from (select l, unnest(range(1, len(l))) as i from lists) group by all",
    "lm_fit_trigram": with_(_TRI) + "select ctx, next, n from tri",
    "lm_generate_trigram": with_(SFT_ITEMS, _TRI)
    + f""", full_ as (
  select c.ctx, v.next::bigint as next, (ln((coalesce(t.n, 0) + 1.0::double) / (c.total + 256.0::double)) / 1.2::double) as logit
  from (select ctx, sum(n)::double as total from tri group by ctx) c cross join range(256) v(next)
  left join tri t on t.ctx = c.ctx and t.next = v.next),
full_p as (select ctx, next, logit, e / sum(e) over (partition by ctx) as p
           from (select *, exp(logit - max(logit) over (partition by ctx)) as e from full_)),
full_k as (select ctx, next, p / sum(p) over (partition by ctx) as p from (
  select *, sum(p) over w as c, row_number() over w as r from full_p
  window w as (partition by ctx order by logit desc, next rows between unbounded preceding and current row)) where r = 1 or c <= 0.95::double),
{_cum('full_c', 'full_k')},
cuts as materialized (select * from full_c),
seen as materialized (select distinct ctx from tri),
gen as (
  select pair_id, 0 as step, b[-2]::bigint * 256 + b[-1] as ctx, []::bigint[] as out, false as done
  from (select pair_id, {s_bytes(s_prompt('prompt'))} as b from sft_items)
  union all
  select pair_id, step + 1, (ctx % 256) * 256 + tok, list_append(out, tok), tok = 1 from (
    select gen.*, coalesce(c.next, case when s.ctx is null then floor({s_uniform(repr(str(SEED)), 'pair_id', "'0'", 'step')} * 243)::bigint end) as tok
    from gen left join cuts c on c.ctx = gen.ctx
       and {s_uniform(repr(str(SEED)), 'pair_id', "'0'", 'step')} >= c.lo and {s_uniform(repr(str(SEED)), 'pair_id', "'0'", 'step')} < c.hi
    left join seen s on s.ctx = gen.ctx where step < {TRIGRAM_NEW} and not done))
select pair_id, array_to_string(arg_max(out, step), ',') as new_ids from gen group by pair_id""",
    "lm_fit": with_(DOC_PAIRS) + "select ctx::bigint as ctx, next::bigint as next, count(*) as n from doc_pairs group by ctx, next",
    "lm_logits": with_(_DIST) + f"select ctx::bigint as ctx, next::bigint as next, {s_r6('ln(p)')} as logp from dist",
    "lm_gather": with_(SFT_ITEMS, CORPUS_LM)
    + f"""select pair_id, i as pos, ids[i+1]::bigint as token, {s_r6('logp')} as logp
from (select pair_id, ids, unnest(range(1, len(ids))) as i from (select pair_id, {s_bytes(s_format('prompt', 'response'))} as ids from sft_items)) s
join lm on lm.ctx = ids[i] and lm.next = ids[i+1]""",
    "lm_nll": with_(SFT_ITEMS, CORPUS_LM)
    + f"""select {s_r6('avg(-logp)')} as loss, count(*) as n
from (select ids, np, unnest(range(1, len(ids))) as i from (
  select ids[1:{SFT_SIZE}] as ids, least(np, {SFT_SIZE}) as np from (
    select {s_bytes(s_format('prompt', 'response'))} as ids, octet_length(encode({s_prompt('prompt')})) as np from sft_items))) s
join lm on lm.ctx = ids[i] and lm.next = ids[i+1] where i >= np""",
    "lm_eval": with_(_SPLIT_STREAM)
    + f"""select split, {s_r6('avg(loss)')} as loss, count(*) as n_batches from (
  select st.split, sample // {EVAL_ROWS} as batch, avg(-logp) as loss
  from (select split, i as sample, floor({s_uniform(f"'{SEED}'", 'split', 'i')} * (n - {EVAL_BLOCK} - 1))::bigint as s
        from (select split, count(*) as n from halves group by split) z, range({EVAL_BATCHES * EVAL_ROWS}) r(i)) st
  join halves a on a.split = st.split and a.pos >= s and a.pos < s + {EVAL_BLOCK}
  join halves b on b.split = a.split and b.pos = a.pos + 1
  join lm on lm.ctx = a.token and lm.next = b.token
  group by st.split, sample // {EVAL_ROWS}) group by split""",
    "lm_seq_logp": with_(TRAJ) + f"select traj_id, {s_r6('sum(case when is_response then ref_logp else 0 end)')} as seq_logp from traj group by traj_id",
    "lm_topk": with_(_TOPK) + f"select ctx::bigint as ctx, next::bigint as next, {s_r6('p')} as p from dk",
    "lm_topp": with_(_TOPP) + f"select ctx::bigint as ctx, next::bigint as next, {s_r6('p')} as p from dp",
    "lm_sample": with_(_DIST, _cum("cuts", "dist"))
    + f"select ctx::bigint as ctx, next::bigint as next from cuts where {s_uniform(repr(str(SEED)), 'ctx')} >= lo and {s_uniform(repr(str(SEED)), 'ctx')} < hi",
    "lm_generate": with_(SFT_ITEMS, _TOPP, _cum("cuts0", "dp"), "cuts as materialized (select * from cuts0)")
    + f""", gen as (
  select pair_id, g.sample, 0 as step, {_LAST} as last, []::int[] as out, false as done from sft_items, (select unnest([0, 1]) as sample) g
  union all
  select pair_id, sample, step + 1, c.next, list_append(out, c.next), c.next = 1
  from gen join cuts c on c.ctx = last
   and {s_uniform(repr(str(SEED)), 'pair_id', 'sample', 'step')} >= c.lo and {s_uniform(repr(str(SEED)), 'pair_id', 'sample', 'step')} < c.hi
  where step < {MAX_NEW} and not done)
select pair_id, sample::bigint as sample, array_to_string(arg_max(out, step), ',') as new_ids from gen group by pair_id, sample""",
    "lm_generate_greedy": with_(
        SFT_ITEMS, CORPUS_LM,
        "best as materialized (select ctx, next from (select *, row_number() over (partition by ctx order by logp desc, next) as r from lm) where r = 1)",
    )
    + f""", gen as (
  select pair_id, 0 as step, {_LAST} as last, []::int[] as out, false as done from sft_items
  union all
  select pair_id, step + 1, b.next, list_append(out, b.next), b.next = 1 from gen join best b on b.ctx = last where step < {MAX_NEW} and not done)
select pair_id, array_to_string(arg_max(out, step), ',') as new_ids from gen group by pair_id""",
    "lm_ppl": with_(CORPUS_LM)
    + f"""select lang, {s_r6('-sum(m * logp) / sum(m)')} as nll, {s_r6('exp(-sum(m * logp) / sum(m))')} as ppl, sum(m)::bigint as n_tokens
from (select lang, ctx, next, count(*) as m from doc_pairs group by lang, ctx, next) c join lm on lm.ctx = c.ctx and lm.next = c.next group by lang""",
}

"""Sequence building and batching."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import arrays as ar
from corpusflow.functions import text as tx
from corpusflow.operators import batching as bt
from corpusflow.operators import bpe
from corpusflow.operators import sequences as sq
from corpusflow.plans.storage import cut_lineage
from corpusflow.sources import tables as t

from .kit import (
    DOC_BYTES, PREF_PAIRS, RUN_LOG, SFT_ITEMS, big, checksum, digest, r6, s_bytes, s_checksum, s_digest, s_format,
    s_prompt, s_r6, with_,
)
from .tokens import BPE_TRAIN, BPE_VOCAB, s_bpe_ids

SIZE = 256
BLOCK, STRIDE = 128, 64
SAMPLES, SAMPLE_BLOCK, SEED = 512, 64, 7
PAIR_SIZE = 512
BATCH = 16


def stream_of(spark, root):
    """``(documents with ids and global start, total token count)``."""
    docs = t.documents(spark, root, "text")
    length = F.octet_length("text")
    at = sq.global_positions(docs, "doc_id", length)
    placed = docs.select("doc_id", tx.byte_ids("text").alias("ids")).join(at.select("doc_id", "start"), "doc_id")
    return placed, sq.token_total(docs, length)


def seq_pos(spark, root):
    docs = t.documents(spark, root, "text")
    return sq.global_positions(docs, "doc_id", F.octet_length("text")).select("doc_id", "n_tokens", big("start").alias("start"))


def seq_split(spark, root):
    docs, total = stream_of(spark, root)
    return sq.split_by_position(docs, total).select(
        "doc_id", "split", big("start").alias("start"), big(F.size("ids")).alias("n_tokens"), digest("ids").alias("ids_md5")
    )


def seq_windows(spark, root):
    docs, total = stream_of(spark, root)
    return sq.blocks(docs.select("ids", "start"), BLOCK, total, STRIDE).select(
        "block_id",
        checksum("x").alias("x_sum"),
        checksum("y").alias("y_sum"),
        big(F.get("x", F.lit(0))).alias("x_first"),
        big(F.element_at("y", -1)).alias("y_last"),
    )


def seq_sample(spark, root):
    docs, total = stream_of(spark, root)
    drawn = sq.sample_blocks(docs.select("ids", "start"), SAMPLES, SAMPLE_BLOCK, SEED, total)
    return drawn.select("sample", checksum("x").alias("x_sum"), checksum("y").alias("y_sum"))


def _formatted(spark, root):
    return t.sft_items(spark, root).select(
        "pair_id", tx.byte_ids(tx.format_example("prompt", "response")).alias("ids")
    )


def seq_shift(spark, root):
    return _formatted(spark, root).select("pair_id", digest(ar.shift_labels("ids")).alias("labels_md5"))


def seq_pad(spark, root):
    return _formatted(spark, root).select("pair_id", digest(ar.pad_to("ids", SIZE, ar.PAD_ID)).alias("ids_md5"))


def _masked(spark, root, encode):
    out = sq.sft_collate(t.sft_items(spark, root).select("pair_id", "prompt", "response"), SIZE, encode)
    return out.select(
        "pair_id",
        big("n_prompt").alias("n_prompt"),
        digest("ids").alias("ids_md5"),
        digest("labels").alias("labels_md5"),
        big(F.size(F.filter("labels", lambda v: v == ar.IGNORE_LABEL))).alias("n_ignored"),
    )


def seq_sft_mask(spark, root):
    return _masked(spark, root, tx.byte_ids)


def seq_sft_mask_bpe(spark, root):
    """Merges learnt from the documents, then instruction rows as merged ids with masked labels."""
    _, merges = bpe.train_bpe(t.documents(spark, root, "text"), BPE_VOCAB)
    return _masked(spark, root, bpe.bpe_encoder(merges))


def seq_pair(spark, root):
    pairs = t.pref_pairs(spark, root)
    return sq.pair_collate(pairs, PAIR_SIZE).select("pair_id", digest("pos_ids").alias("pos_md5"), digest("neg_ids").alias("neg_md5"))


def _prompt_response(spark, root):
    return t.sft_items(spark, root).select(
        "pair_id",
        tx.byte_ids(tx.format_prompt("prompt")).alias("prompt_ids"),
        tx.byte_ids("response").alias("response_ids"),
    )


def seq_resp_mask(spark, root):
    return sq.build_pair(_prompt_response(spark, root), SIZE).select(
        "pair_id",
        big(F.size("ids")).alias("n_tokens"),
        digest("ids").alias("ids_md5"),
        big(F.size(F.filter("resp_mask", lambda m: m))).alias("n_response"),
    )


def rollouts(spark, root):
    """Prompt and response ids as one sequence with its boundary, in batches of ``BATCH``."""
    rows = _prompt_response(spark, root).select(
        "pair_id",
        F.concat("prompt_ids", "response_ids").alias("ids"),
        F.size("prompt_ids").alias("boundary"),
        (F.size("response_ids") % 17 - 8).alias("reward"),
    )
    rows = cut_lineage(rows)
    batch = bt.batches(rows, BATCH, "pair_id", drop_last=False).select("pair_id", "batch")
    return sq.pad_rollouts(cut_lineage(rows.join(batch, "pair_id")), 1024)


def seq_rollout_pad(spark, root):
    return rollouts(spark, root).select(
        "pair_id",
        "batch",
        big("max_len").alias("max_len"),
        big("b").alias("boundary"),
        big("length").alias("n_tokens"),
        digest("ids").alias("ids_md5"),
        big(F.size(F.filter("mask", lambda m: m))).alias("n_mask"),
        big(F.get("rewards", F.col("length") - 1)).alias("last_reward"),
    )


def seq_action(spark, root):
    actions = sq.action_tokens(rollouts(spark, root).select("pair_id", "ids", "mask"))
    return actions.select("pair_id", big("pos").alias("pos"), big("token").alias("token"))


def seq_traj_of(spark, root):
    return sq.traj_counts(sq.action_tokens(rollouts(spark, root).select("pair_id", "ids", "mask")), "pair_id")


def seq_curriculum(spark, root):
    return bt.curriculum(t.sft_items(spark, root).select("pair_id", "prompt"), "prompt", "pair_id")


def seq_batch(spark, root):
    return bt.batches(t.sft_items(spark, root).select("pair_id"), BATCH, "pair_id", True, SEED)


def seq_batch_cycle(spark, root):
    return bt.cyclic_batches(t.sft_items(spark, root).select("pair_id"), BATCH, 40, "pair_id")


def seq_batch_mod(spark, root):
    return bt.mod_batches(t.sft_items(spark, root).select("pair_id"), BATCH, 40, "pair_id")


def seq_accum(spark, root):
    log = t.run_log(spark, root).select(
        "run", (F.col("step") - 1).alias("micro"), F.col("loss").cast("decimal(18,2)").alias("loss")
    )
    return bt.accum_steps(log, 8, "run", "micro", "loss").select("run", "opt_step", r6("loss").alias("loss"))


QUERIES = {
    f.__name__: f
    for f in (
        seq_pos, seq_split, seq_windows, seq_sample, seq_shift, seq_pad, seq_sft_mask, seq_sft_mask_bpe, seq_pair, seq_resp_mask,
        seq_rollout_pad, seq_action, seq_traj_of, seq_curriculum, seq_batch, seq_batch_cycle, seq_batch_mod, seq_accum,
    )
}

_POS = """doc_pos as (
  select doc_id, octet_length(encode(text))::bigint as n_tokens,
         (sum(octet_length(encode(text))) over (order by doc_id) - octet_length(encode(text)))::bigint as start
  from documents),
tot as (select sum(n_tokens)::bigint as n from doc_pos)"""

_STREAM = f"""{DOC_BYTES}, {_POS},
stream as (
  select p.start + i - 1 as pos, ('0x' || h[i])::int as token
  from (select doc_id, h, unnest(range(1, len(h) + 1)) as i from doc_hex) d join doc_pos p on p.doc_id = d.doc_id)"""

_FMT = f"{SFT_ITEMS}, fmt as (select pair_id, {s_bytes(s_format('prompt', 'response'))} as ids, {s_bytes(s_prompt('prompt'))} as p from sft_items)"

_PR = f"{SFT_ITEMS}, pr as (select pair_id, {s_bytes(s_prompt('prompt'))} as p, {s_bytes('response')} as r from sft_items)"

_ROLL = f"""{_PR},
roll0 as (select pair_id, list_concat(p, r) as ids, len(p) as bnd, len(r) % 17 - 8 as reward,
                 (row_number() over (order by pair_id) - 1) // {BATCH} as batch from pr),
roll1 as (select *, least(max(len(ids)) over (partition by batch), 1024) as max_len from roll0),
roll as (select pair_id, batch, max_len, least(len(ids), max_len) as length, reward,
                greatest(bnd - (len(ids) - least(len(ids), max_len)), 0) as b,
                list_resize(ids[len(ids) - least(len(ids), max_len) + 1:], max_len, 2) as ids from roll1)"""


_MASKED = f"""select pair_id, np::bigint as n_prompt, {s_digest(f'list_resize(x, {SIZE}, 2)')} as ids_md5, {s_digest('y')} as labels_md5,
  len(list_filter(y, lambda v: v = -100))::bigint as n_ignored
from (select pair_id, x, np, list_resize(list_transform(list_append(x[2:], -100), lambda v, i: case when i < np then -100 else v end), {SIZE}, -100) as y
  from (select pair_id, ids[1:{SIZE}] as x, least(len(p), len(ids), {SIZE}) as np from fmt))"""

_FMT_BPE = f"""{s_bpe_ids(f"""select pair_id * 2 as key, {s_format('prompt', 'response')} as text from sft_items
  union all select pair_id * 2 + 1, {s_prompt('prompt')} from sft_items""")},
fmt as (select whole.key // 2 as pair_id, whole.l as ids, head.l as p from lists whole join lists head on head.key = whole.key + 1 where whole.key % 2 = 0)"""


def _window_sum(alias: str, cond: str) -> str:
    return f"sum(case when {cond} then {alias} else 0 end)::bigint"


ORACLE = {
    "seq_pos": with_(_POS) + "select doc_id, n_tokens, start from doc_pos",
    "seq_split": with_(DOC_BYTES, _POS)
    + f"""select doc_id, split, start, len(ids)::bigint as n_tokens, {s_digest('ids')} as ids_md5 from (
  select doc_id, 'train' as split, start, ids[1:k] as ids from (
    select d.doc_id, p.start, list_transform(h, lambda x: ('0x' || x)::int) as ids,
      least(greatest(floor((select n from tot) * 0.9::double)::bigint - start, 0), n_tokens) as k
    from doc_hex d join doc_pos p on p.doc_id = d.doc_id)
  union all
  select doc_id, 'val', start + k - floor((select n from tot) * 0.9::double)::bigint, ids[k+1:] from (
    select d.doc_id, p.start, list_transform(h, lambda x: ('0x' || x)::int) as ids,
      least(greatest(floor((select n from tot) * 0.9::double)::bigint - start, 0), n_tokens) as k
    from doc_hex d join doc_pos p on p.doc_id = d.doc_id)
) where len(ids) > 0""",
    "seq_windows": with_(_STREAM)
    + f"""select k as block_id,
  {_window_sum('token * (pos - k * ' + str(STRIDE) + ' + 1)', f'pos < k * {STRIDE} + {BLOCK}')} as x_sum,
  {_window_sum('token * (pos - k * ' + str(STRIDE) + ')', f'pos > k * {STRIDE}')} as y_sum,
  max(case when pos = k * {STRIDE} then token end)::bigint as x_first,
  max(case when pos = k * {STRIDE} + {BLOCK} then token end)::bigint as y_last
from (select pos, token, unnest(range(greatest(0, (pos - {BLOCK} + {STRIDE} - 1) // {STRIDE}), pos // {STRIDE} + 1)) as k from stream)
where k * {STRIDE} < (select n from tot) - {BLOCK} - 1
group by k""",
    "seq_sample": with_(_STREAM)
    + f"""select sample,
  {_window_sum('token * (pos - s + 1)', f'pos < s + {SAMPLE_BLOCK}')} as x_sum,
  {_window_sum('token * (pos - s)', 'pos > s')} as y_sum
from (select i as sample, floor(('0x' || substr(md5('{SEED}-' || i), 1, 8))::bigint / 4294967296.0::double
        * (select n - {SAMPLE_BLOCK} - 1 from tot))::bigint as s from range({SAMPLES}) r(i)) st
join stream on pos >= s and pos <= s + {SAMPLE_BLOCK} group by sample""",
    "seq_shift": with_(_FMT) + f"select pair_id, {s_digest('list_append(ids[2:], -100)')} as labels_md5 from fmt",
    "seq_pad": with_(_FMT) + f"select pair_id, {s_digest(f'list_resize(ids, {SIZE}, 2)')} as ids_md5 from fmt",
    "seq_sft_mask": with_(_FMT) + _MASKED,
    "seq_sft_mask_bpe": with_(BPE_TRAIN, SFT_ITEMS, _FMT_BPE) + _MASKED,
    "seq_pair": with_(PREF_PAIRS)
    + f"""select pair_id, {s_digest(f'list_resize({s_bytes(s_format("prompt", "chosen"))}, {PAIR_SIZE}, 2)')} as pos_md5,
  {s_digest(f'list_resize({s_bytes(s_format("prompt", "rejected"))}, {PAIR_SIZE}, 2)')} as neg_md5 from pref_pairs""",
    "seq_resp_mask": with_(_PR)
    + f"""select pair_id, (len(p2) + len(r2))::bigint as n_tokens, {s_digest('list_concat(p2, r2)')} as ids_md5, len(r2)::bigint as n_response
from (select pair_id, r2, case when len(p) + len(r2) > {SIZE} then p[len(p) + len(r2) - {SIZE} + 1:] else p end as p2
  from (select pair_id, p, case when len(r) >= {SIZE} then r[1:{SIZE} - 1] else r end as r2 from pr))""",
    "seq_rollout_pad": with_(_ROLL)
    + f"""select pair_id, batch, max_len::bigint as max_len, b::bigint as boundary, length::bigint as n_tokens, {s_digest('ids')} as ids_md5,
  greatest(length - b, 0)::bigint as n_mask, reward::bigint as last_reward from roll""",
    "seq_action": with_(_ROLL)
    + "select pair_id, i - 2 as pos, ids[i]::bigint as token from (select pair_id, ids, unnest(range(greatest(b, 1) + 1, length + 1)) as i from roll)",
    "seq_traj_of": with_(_ROLL) + "select pair_id, (length - greatest(b, 1))::bigint as n_tokens from roll where length > greatest(b, 1)",
    "seq_curriculum": with_(SFT_ITEMS)
    + "select pair_id, length(prompt)::bigint as prompt_len, row_number() over (order by length(prompt), pair_id) - 1 as rank from sft_items",
    "seq_batch": with_(SFT_ITEMS)
    + f"""select pair_id, ord // {BATCH} as batch, ord % {BATCH} as slot from (
  select pair_id, row_number() over (order by ('0x' || substr(md5('{SEED}-' || pair_id), 1, 15))::bigint, pair_id) - 1 as ord from sft_items)
where ord // {BATCH} < (select count(*) // {BATCH} from sft_items)""",
    "seq_batch_cycle": with_(SFT_ITEMS)
    + f"""select step, ord % {BATCH} as slot, pair_id
from (select pair_id, row_number() over (order by pair_id) - 1 as ord from sft_items) i
join range(40) s(step) on step % (select ceil(count(*) / {BATCH}.0)::bigint from sft_items) = ord // {BATCH}""",
    "seq_batch_mod": with_(SFT_ITEMS)
    + f"""select step, slot, pair_id from (
  select step, slot, case when slot < greatest(e - a, 0) then a + slot else slot - greatest(e - a, 0) end as want
  from (select step, (step * {BATCH}) % n as a, ((step + 1) * {BATCH}) % n as e
        from range(40) s(step), (select count(*) as n from sft_items)) x, range({BATCH}) r(slot)) w
join (select pair_id, row_number() over (order by pair_id) - 1 as ord from sft_items) i on i.ord = w.want""",
    "seq_accum": with_(RUN_LOG)
    + f"""select run, (step - 1) // 8 as opt_step, {s_r6('cast(sum(cast(loss as decimal(18,2))) as double) / 8')} as loss
from run_log group by run, (step - 1) // 8 having count(*) = 8""",
}

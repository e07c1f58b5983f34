"""Shared pieces of the registered queries and of their SQL checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusflow.functions.text import STRIP_PATTERN


def r6(col: Column | str) -> Column:
    """Six digits, with negative zero folded into zero."""
    return F.round(F.col(col) if isinstance(col, str) else col, 6) + F.lit(0.0)


def digest(ids: Column | str) -> Column:
    ids = F.col(ids) if isinstance(ids, str) else ids
    return F.md5(F.array_join(ids.cast("array<string>"), ",").cast("binary"))


def checksum(ids: Column | str) -> Column:
    """Position-weighted sum of an id array."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    weighted = F.transform(ids, lambda v, i: v.cast("bigint") * (i + 1))
    return F.aggregate(weighted, F.lit(0).cast("bigint"), lambda a, v: a + v)


def big(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


# --- SQL pieces ---------------------------------------------------------------
def s_r6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def s_strip(x: str) -> str:
    return f"regexp_replace({x}, '{STRIP_PATTERN}', '', 'g')"


def s_bytes(x: str) -> str:
    return f"list_transform(regexp_extract_all(hex(encode({x})), '..'), lambda h: ('0x' || h)::int)"


def s_digest(x: str) -> str:
    return f"md5(array_to_string({x}, ','))"


def s_checksum(x: str) -> str:
    return f"coalesce(list_sum(list_transform({x}, lambda v, i: v::bigint * i)), 0)::bigint"


def s_format(prompt: str, response: str) -> str:
    return (
        f"('<s>' || chr(10) || '### Instruction:' || chr(10) || {s_strip(prompt)} || chr(10) || chr(10)"
        f" || '### Response:' || chr(10) || {s_strip(response)} || '</s>')"
    )


def s_prompt(prompt: str) -> str:
    return f"replace({s_format(prompt, repr(''))}, '</s>', '')"


SFT_PAIRS = """sft_pairs as (
  select conv_id*10000019+turn as pair_id, conv_id, text as instruction,
         case when prev_role='system' then prev_text else '' end as input, next_text as output
  from (select *, lead(role) over w as next_role, lead(text) over w as next_text,
               lag(role) over w as prev_role, lag(text) over w as prev_text
        from conversations window w as (partition by conv_id order by turn)) t
  where role='user' and next_role='assistant')"""

SFT_ITEMS = f"""{SFT_PAIRS},
sft_items as (
  select pair_id, conv_id, case when length(inp) > 0 then ins || chr(10) || inp else ins end as prompt, outp as response
  from (select pair_id, conv_id, {s_strip('instruction')} as ins, {s_strip('input')} as inp, {s_strip('output')} as outp
        from sft_pairs)
  where length(ins) > 0 and length(outp) > 0)"""

PREF_PAIRS = f"""{SFT_PAIRS},
pref_pairs as (
  select pair_id, prompt, chosen, rejected
  from (select pair_id, instruction as prompt, output as chosen,
               coalesce(lead(output) over w, first_value(output) over w) as rejected
        from sft_pairs window w as (partition by pair_id % 8 order by pair_id)) t
  where chosen <> rejected)"""

EVAL_RESULTS = """eval_results as (
  select concat('u', cast(user_id as varchar)) as prompt,
         case event_type when 'view' then 'sft' when 'click' then 'ppo' when 'signup' then 'grpo' else 'dpo' end as method,
         case when event_type='purchase' and user_id % 7 = 0 then null
              else cast(sum(cast(value as decimal(18,2))) as double)/count(*) end as reward
  from events where event_type <> 'error' group by user_id, event_type)"""

EVAL_TABLE = f"""{EVAL_RESULTS},
table4 as (
  select s.prompt, s.reward as sft, p.reward as ppo, g.reward as grpo, d.reward as dpo
  from (select * from eval_results where method='sft') s
  left join (select * from eval_results where method='ppo') p on p.prompt = s.prompt
  left join (select * from eval_results where method='grpo') g on g.prompt = s.prompt
  left join (select * from eval_results where method='dpo') d on d.prompt = s.prompt)"""

RUN_LOG = """run_log as (
  select user_id % 10 as run, event_id, ts, epoch_us(ts) as micros, value as loss, event_id % 512 + 1 as tokens,
         case when event_type='error' then 'val' else 'train' end as split,
         row_number() over (partition by user_id % 10 order by ts, event_id) as step
  from events)"""

# documents as byte lists; transitions i -> i+1
DOC_BYTES = "doc_hex as (select doc_id, lang, regexp_extract_all(hex(encode(text)), '..') as h from documents)"
DOC_PAIRS = f"""{DOC_BYTES},
doc_pairs as (
  select doc_id, lang, ('0x' || h[i])::int as ctx, ('0x' || h[i+1])::int as next
  from (select doc_id, lang, h, unnest(range(1, len(h))) as i from doc_hex))"""


def s_dense(name: str, counts: str, alpha: str) -> str:
    """Smoothed log-probabilities of every byte pair."""
    return f"""{name} as (
  select g.ctx, g.next, ln((coalesce(c.n, 0) + {alpha}) / (coalesce(t.total, 0) + {alpha} * 256.0)) as logp
  from (select a.i::int as ctx, b.i::int as next from range(256) a(i), range(256) b(i)) g
  left join {counts} c on c.ctx = g.ctx and c.next = g.next
  left join (select ctx, sum(n)::bigint as total from {counts} group by ctx) t on t.ctx = g.ctx)"""


CORPUS_LM = f"""{DOC_PAIRS},
pair_n as (select ctx, next, count(*) as n from doc_pairs group by ctx, next),
{s_dense('lm', 'pair_n', '1.0')}"""


def with_(*ctes: str) -> str:
    """``WITH`` clause from CTE texts, each definition kept once."""
    return "with recursive " + ",\n".join(ctes) + "\n"

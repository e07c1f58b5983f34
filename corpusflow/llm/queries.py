"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import chat, exact, hard_negatives, langid, lbl, license_scan, minhash, pieces, repair, secret_scan, tiling, token_files, toxicity
from ..plans.storage import cut_lineage
from .common import fold, table


def op1_chat_rotation(spark: SparkSession, root: str) -> DataFrame:
    found = chat.rotations(table(spark, root, "conversations"))
    spans = F.array_join(F.transform("mask", lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
    return found.select("conv_id", "speaker", "block", "start", "n_turns", "text", spans.alias("mask"))


def op2_nbest_pieces(spark: SparkSession, root: str) -> DataFrame:
    return pieces.coded_documents(table(spark, root, "documents", "doc_id", "text"))


def op3_string_tiling(spark: SparkSession, root: str) -> DataFrame:
    return tiling.contaminated(table(spark, root, "documents", "doc_id", "text"), table(spark, root, "benchmark", "item_id", "text"))


def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", "doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, root, "labels", "doc_id", "toxic"), folds=5))
    scored = toxicity.score(docs, model).select(F.col("_row.doc_id").alias("doc_id"), "score")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", "doc_id", "text", "lang")
    network = langid.fit(docs, fold("doc_id", 4) != 2)
    found = langid.predict(docs.select("doc_id", "text"), network).select(F.col("_row.doc_id").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op6_secrets(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", "doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(docs)).select(F.col("_row.doc_id").alias("doc_id"), "spans")

    def joined(spans):
        each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string")))
        return F.array_join(each, ",")

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id",
        *[number(k) for k in ("assign", "access", "hex")],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        number("random"),
    )


def op7_circulant_minhash(spark: SparkSession, root: str) -> DataFrame:
    return minhash.clusters(table(spark, root, "documents", "doc_id", "text"), percent=85)


def op8_token_files(spark: SparkSession, root: str) -> DataFrame:
    return token_files.stored(table(spark, root, "documents", "doc_id", "text"))


def op9_log_bilinear(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents", "doc_id", "text")
    found = lbl.scored(docs, fold("doc_id", 10) != 0)
    return found.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_content_sort(spark: SparkSession, root: str) -> DataFrame:
    return exact.assign(table(spark, root, "documents", "doc_id", "text"), keep="max")


def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, root, "embeddings", "vec_id", "embedding", "label"), F.col("vec_id") % 50 == 0, label=label)


def _damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role by the checksum of ``conv_id:turn``."""

    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    role = F.when(fate == 4, "user").otherwise(shown("role"))
    copies = F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.filter(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def op12_structure_repair(spark: SparkSession, root: str) -> DataFrame:
    turns = table(spark, root, "conversations", "conv_id", "turn", "role", "text")
    placed = repair.place(_damaged(turns))
    marked = cut_lineage(repair.faults(placed))
    found = cut_lineage(repair.scripts(marked))
    script = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "script"))), lambda s: s["script"]), "")
    audits = found.groupBy(F.col("conv").alias("_a")).agg(repair.audit(script).alias("audit"))
    sums = repair.digests(repair.repaired(placed, found)).select(F.col("conv").alias("_s"), "sha256")
    out = turns.select("conv_id").distinct().join(repair.report(marked, found), F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    out = out.join(audits, F.col("conv_id").eqNullSafe(F.col("_a")), "left").join(sums, F.col("conv_id").eqNullSafe(F.col("_s")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return out.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", empty).alias("repaired_sha256"))


def op13_license_notices(spark: SparkSession, root: str) -> DataFrame:
    found = license_scan.scan(table(spark, root, "documents", "doc_id", "text"))

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        labels(F.filter("spans", lambda s: s["base"])).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        "score",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_rotation,
        op2_nbest_pieces,
        op3_string_tiling,
        op4_toxicity,
        op5_language,
        op6_secrets,
        op7_circulant_minhash,
        op8_token_files,
        op9_log_bilinear,
        op10_content_sort,
        op11_hard_negatives,
        op12_structure_repair,
        op13_license_notices,
    )
} | {"pipeline": corpus_pipeline.run}

ORACLE = {
    "op11_hard_negatives": """
with sound as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
dims as (select greatest(max(len(v)), 1) as d from sound),
rows as (select row_number() over () as r, vec_id, label, list_resize(v, d, 0.0) as v from sound, dims),
scores as (
  select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
  from rows a join rows b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (
  select ar, anchor_id, br, vec_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by ar order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id, (row_number() over (partition by p.ar, p.br order by n.score desc, n.vec_id))::int as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scores n
  on n.ar = p.ar and not n.same and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify row_number() over (partition by p.ar, p.br order by n.score desc, n.vec_id) <= 3""",
    "op12_structure_repair": r"""
with recursive bits as (select range::bigint as b from range(256)),
steps(b, v, n) as (
  select b, b, 0 from bits
  union all select b, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, n + 1 from steps where n < 8),
tab as (select list(v order by b) as t from steps where n = 8),
raw as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
hashed as (
  select raw.*, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(k, ''), lambda c: ascii(c)::bigint)),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::bigint) % 20 as f
  from raw, tab),
damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
         case when f = 1 then '' when f = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hashed, range(2) c where f <> 0 and (c.range = 0 or f = 3)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, substr(text, 1, 64), sha256(text)) as i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as cut
  from damaged),
marked as (
  select *, case when cut = '' then 1 when i > min(i) over (partition by conv_id, role, text) then 2
                 when right(cut, 1) not in ('.', '!', '?') then 3 else 0 end as fault,
         case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'o' end as r,
         lag(case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else 'o' end) over (partition by conv_id order by i) as rb,
         count(*) over (partition by conv_id) as n
  from placed),
rows as (
  select conv_id, i, n, r, role, text, fault in (1, 2) as gone, (fault = 3)::int as cut from marked),
-- least (cost, edits) per state: 0 nothing, 1 system, 2 user, 3 assistant; edits as letters, roles of new turns in lower case
walk(conv_id, i, n, s0, s1, s2, s3) as (
  select distinct conv_id, 0::bigint, n, {'c': 0, 'a': ''}, null::struct(c integer, a varchar), {'c': 2, 'a': 'I'}, {'c': 4, 'a': 'II'} from rows
  union all
  select conv_id, i, n, s0, s1, least(u, {'c': s0.c + 2, 'a': s0.a || 'I'}, case when a.c is null then null else {'c': a.c + 2, 'a': a.a || 'I'} end,
                                      case when s1.c is null then null else {'c': s1.c + 2, 'a': s1.a || 'I'} end),
         least(a, {'c': s0.c + 4, 'a': s0.a || 'II'}, case when u.c is null then null else {'c': u.c + 2, 'a': u.a || 'I'} end,
               case when s1.c is null then null else {'c': s1.c + 4, 'a': s1.a || 'II'} end)
  from (
    select w.conv_id, w.i + 1 as i, w.n, {'c': w.s0.c + 3, 'a': w.s0.a || 'D'} as s0,
           least(case when w.s1.c is null then null else {'c': w.s1.c + 3, 'a': w.s1.a || 'D'} end,
                 case when not x.gone and x.r = 's' then {'c': w.s0.c + x.cut, 'a': w.s0.a || 'K'} end) as s1,
           least({'c': w.s2.c + 3, 'a': w.s2.a || 'D'},
                 case when not x.gone then least(
                   {'c': w.s0.c + x.cut + case when x.r = 'u' then 0 else 2 end, 'a': w.s0.a || case when x.r = 'u' then 'K' else 'R' end},
                   case when w.s1.c is null then null else
                     {'c': w.s1.c + x.cut + case when x.r = 'u' then 0 else 2 end, 'a': w.s1.a || case when x.r = 'u' then 'K' else 'R' end} end,
                   {'c': w.s3.c + x.cut + case when x.r = 'u' then 0 else 2 end, 'a': w.s3.a || case when x.r = 'u' then 'K' else 'R' end}) end) as u,
           least({'c': w.s3.c + 3, 'a': w.s3.a || 'D'},
                 case when not x.gone then
                   {'c': w.s2.c + x.cut + case when x.r = 'a' then 0 else 2 end, 'a': w.s2.a || case when x.r = 'a' then 'K' else 'R' end} end) as a
    from walk w join rows x on x.conv_id is not distinct from w.conv_id and x.i = w.i + 1)),
found as (select conv_id, least(s0, s3) as best from walk where i = n),
letters as (
  select conv_id, best.c as cost, best.a as audit, unnest(range(1, length(best.a) + 1)) as j from found),
edits as (
  select conv_id, j, substr(audit, j::bigint, 1) as e,
         count(case when substr(audit, j::bigint, 1) <> 'I' then 1 end) over (partition by conv_id order by j) as i from letters),
lines as (
  select e.conv_id, e.j, e.e, x.role, x.text, x.r,
         row_number() over (partition by e.conv_id order by e.j) - max(case when e.e = 'K' and x.r = 's' then 1 else 0 end) over (partition by e.conv_id) as p
  from edits e left join rows x on x.conv_id is not distinct from e.conv_id and x.i = e.i and e.e <> 'I' where e.e <> 'D'),
texts as (
  select conv_id, string_agg(case when e = 'K' then role else case when p % 2 = 1 then 'user' else 'assistant' end end || ':' ||
                             case when e = 'I' then '' else text end, chr(10) order by j) as whole from lines group by conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
         count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
         count(*) filter (rb is not null and rb || r not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id)
select a.conv_id, coalesce(c.gaps, 0)::bigint as gaps, coalesce(c.blank, 0)::bigint as blank, coalesce(c.duplicate, 0)::bigint as duplicate,
       coalesce(c.truncated, 0)::bigint as truncated, coalesce(c.illegal, 0)::bigint as illegal, coalesce(f.best.c, 0)::bigint as cost,
       coalesce(f.best.a, '') as audit, sha256(coalesce(t.whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join counts c on c.conv_id is not distinct from a.conv_id
left join found f on f.conv_id is not distinct from a.conv_id
left join texts t on t.conv_id is not distinct from a.conv_id""",
    "op1_chat_rotation": """
with named as (
  select conv_id, turn, coalesce(role = 'system', false) as is_system, replace(coalesce(text, ''), '<|', '< |') as said,
         case when role is null then 'unknown' when role = 'unknown' then '%75nknown' else array_to_string(list_transform(
           regexp_extract_all(role, '(?s).'),
           lambda c: case when regexp_matches(c, '^[\\p{L}\\p{N}_.-]$') then c else regexp_replace(hex(encode(c)), '(..)', '%\\1', 'g') end), '') end as name
  from conversations),
rows as (
  select *, ((row_number() over (partition by conv_id order by turn nulls first, name, said) - 1) // 128)::bigint as block from named),
people as (select distinct conv_id, name as speaker from rows where not is_system),
pieces as (
  select r.conv_id, p.speaker, r.block, r.turn, r.name, r.said, (not r.is_system and r.name = p.speaker) as own,
         '<|im_start|>' || case when r.is_system then 'system' when r.name = p.speaker then 'assistant' else 'user name=' || r.name end
         || chr(10) as head
  from rows r join people p on p.conv_id is not distinct from r.conv_id),
placed as (
  select *, coalesce(sum(length(head) + length(said) + 11) over (
      partition by conv_id, speaker, block order by turn nulls first, name, said, head rows between unbounded preceding and 1 preceding), 0) as place
  from pieces),
joined as (
  select conv_id, speaker, block, count(*)::bigint as n_turns,
         string_agg(head || said || '<|im_end|>' || chr(10), '' order by turn nulls first, name, said, head) as text,
         coalesce(string_agg(case when own then (place + length(head))::bigint::varchar || '-' || (place + length(head) + length(said) + 10)::bigint::varchar end, ','
                  order by turn nulls first, name, said, head), '') as mask
  from placed group by conv_id, speaker, block)
select conv_id, speaker, block, coalesce(sum(length(text)) over (
    partition by conv_id, speaker order by block rows between unbounded preceding and 1 preceding), 0)::bigint as start, n_turns, text, mask
from joined""",
    "op7_circulant_minhash": None,
    "op10_content_sort": """
with rows as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm from documents),
groups as (select norm, max(doc_id) as keep_id, count(*)::bigint as group_size from rows group by norm)
select r.doc_id, g.keep_id, g.group_size, r.doc_id = g.keep_id as kept, sha256(r.norm) as text_sha256
from rows r join groups g on g.norm = r.norm""",
}
ORACLE = {name: sql for name, sql in ORACLE.items() if sql}

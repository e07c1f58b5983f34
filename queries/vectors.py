"""Vector queries over the embeddings table; experts are the per-label centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import arrays as ar
from corpusflow.functions import text as tx
from corpusflow.operators import attention, vectors
from corpusflow.sources import tables as t

from .kit import SFT_ITEMS, big, r6, s_bytes, s_r6, with_

TOP = 3
WINDOW, SINK = 16, 2
HEADS, KV_HEADS = 4, 2
MIN_LEN = 64


def _emb(spark, root):
    return t.table(spark, root, "embeddings")


def _experts(spark, root):
    return vectors.centroids(_emb(spark, root), "embedding", "label")


def _long(df, key, col, name):
    return df.select(key, F.posexplode(col).alias("dim", "v")).select(key, big("dim").alias("dim"), r6("v").alias(name))


def vec_project(spark, root):
    return _long(vectors.project(_emb(spark, root), "embedding", _experts(spark, root), "vec_id"), "vec_id", "y", "y")


def vec_rms(spark, root):
    return _long(_emb(spark, root).withColumn("y", vectors.rms_norm("embedding")), "vec_id", "y", "y")


def vec_layernorm(spark, root):
    return _long(_emb(spark, root).withColumn("y", vectors.layer_norm("embedding")), "vec_id", "y", "y")


def vec_softmax(spark, root):
    return _long(_emb(spark, root).withColumn("y", ar.softmax(ar.doubles("embedding"))), "vec_id", "y", "y")


def _probs(spark, root):
    return vectors.route_probs(_emb(spark, root), "embedding", _experts(spark, root), "vec_id")


def _routes(spark, root, k=TOP):
    return vectors.route_topk(_probs(spark, root), "vec_id", k)


def vec_route(spark, root):
    return _routes(spark, root).select("vec_id", big("slot").alias("slot"), big("expert").alias("expert"), r6("weight").alias("weight"))


def vec_route_load(spark, root):
    n = _experts(spark, root).count()
    return vectors.expert_load(_routes(spark, root, 1), n).select(big("expert").alias("expert"), "n")


def vec_balance(spark, root):
    return vectors.balance_loss(_probs(spark, root)).select(r6("aux_loss").alias("aux_loss"))


def vec_combine(spark, root):
    emb = _emb(spark, root)
    # each expert scales by its centroid and shifts by its number
    maps = _experts(spark, root).select(
        F.col("unit").alias("expert"), F.col("w").alias("scale"), F.transform("w", lambda _: F.col("unit").cast("double")).alias("shift")
    )
    out = vectors.combine_experts(emb, _routes(spark, root), "embedding", "vec_id", maps)
    return out.select("vec_id", big("dim").alias("dim"), r6("y").alias("y"))


def vec_pool(spark, root):
    """Token vectors are rows of the embeddings table by id; the pad positions are left out of the mean."""
    items = t.sft_items(spark, root).select("pair_id", tx.byte_ids("response").alias("ids"))
    tokens = items.select("pair_id", F.posexplode(ar.pad_to("ids", F.greatest(F.size("ids"), F.lit(MIN_LEN)), ar.PAD_ID)).alias("pos", "token"), F.size("ids").alias("len"))
    table = _emb(spark, root).filter(F.col("vec_id") < 256).select(F.col("vec_id").cast("int").alias("token"), "embedding")
    # the vocabulary of byte tokens bounds this table
    rows = tokens.join(F.broadcast(table), "token")
    pooled = vectors.masked_mean_pool(rows, "pair_id", "embedding", F.col("pos") < F.col("len"))
    return pooled.select("pair_id", big("dim").alias("dim"), r6("mean").alias("mean"))


def _attended(df):
    return df.select("vec_id", big("pos").alias("pos"), F.posexplode("y").alias("dim", "v")).select(
        "vec_id", "pos", big("dim").alias("dim"), r6("v").alias("y")
    )


def vec_attend(spark, root):
    return _attended(attention.causal_attend(_emb(spark, root), "label", "vec_id", "embedding", "embedding", "embedding"))


def vec_attend_heads(spark, root):
    emb = _emb(spark, root).withColumn("kv", F.slice("embedding", 1, 64 // HEADS * KV_HEADS))
    return _attended(
        attention.causal_attend(emb, "label", "vec_id", "embedding", "kv", "kv", heads=HEADS, kv_heads=KV_HEADS)
    )


def vec_attend_shared(spark, root):
    """Two groups that use the same keys."""
    emb = _emb(spark, root).select((F.col("vec_id") % 2).alias("half"), F.floor(F.col("vec_id") / 2).cast("bigint").alias("k"), "embedding")
    found = attention.causal_attend(emb, "half", "k", "embedding", "embedding", "embedding")
    long = found.select("half", "k", big("pos").alias("pos"), F.posexplode("y").alias("dim", "v"))
    return long.select("half", "k", "pos", big("dim").alias("dim"), r6("v").alias("y"))


def vec_attend_window(spark, root):
    return _attended(
        attention.causal_attend(_emb(spark, root), "label", "vec_id", "embedding", "embedding", "embedding", window=WINDOW, sink=SINK)
    )


QUERIES = {
    f.__name__: f
    for f in (
        vec_project, vec_rms, vec_layernorm, vec_softmax, vec_route, vec_route_load, vec_balance, vec_combine, vec_pool,
        vec_attend, vec_attend_heads, vec_attend_shared, vec_attend_window,
    )
}

_LONG = "el as (select vec_id, label, i - 1 as dim, embedding[i]::double as x from (select *, unnest(range(1, len(embedding) + 1)) as i from embeddings))"
_CENT = f"{_LONG}, cent as (select label, dim, avg(x) as w from el group by label, dim)"
_PROBS = f"""{_CENT},
lg as (select vec_id, c.label as expert, sum(x * w) as logit from el join cent c on c.dim = el.dim group by vec_id, c.label),
pr as (select vec_id, expert, exp(logit - m) / sum(exp(logit - m)) over (partition by vec_id) as p
       from (select *, max(logit) over (partition by vec_id) as m from lg)),
rt as (select vec_id, expert, p, row_number() over (partition by vec_id order by p desc, expert) - 1 as slot from pr)"""


def _attend_sql(pairs: str, heads: int = 1, kv: int = 1) -> str:
    width = 64 // heads
    share = heads // kv
    kv_dim = f"(dim // {width}) // {share} * {width} + dim % {width}" if heads > 1 else "dim"
    return with_(
        f"""pos as (select vec_id, label, row_number() over (partition by label order by vec_id) - 1 as pos from embeddings),
{_LONG},
rows as (select e.vec_id, e.label, p.pos, dim, x from el e join pos p on p.vec_id = e.vec_id),
hd as (select a.vec_id, a.label, a.pos, dim, dim // {width} as head, {kv_dim} as kdim, x from rows a),
sc as (select a.vec_id, a.label, a.pos, a.head, b.pos as bpos, sum(a.x * b.x) / sqrt({width}) as s
       from hd a join rows b on b.label = a.label and b.dim = a.kdim and {pairs} group by all),
wt as (select *, exp(s - m) / sum(exp(s - m)) over (partition by vec_id, head) as w
       from (select *, max(s) over (partition by vec_id, head) as m from sc))"""
    ) + f"""select h.vec_id, h.pos, h.dim, {s_r6('sum(wt.w * v.x)')} as y
from hd h join wt on wt.vec_id = h.vec_id and wt.head = h.head
join rows v on v.label = h.label and v.pos = wt.bpos and v.dim = h.kdim group by h.vec_id, h.pos, h.dim"""


_EARLIER = "b.pos <= a.pos"

ORACLE = {
    "vec_project": with_(_CENT)
    + f"select vec_id, c.label::bigint as dim, {s_r6('sum(x * w)')} as y from el join cent c on c.dim = el.dim group by vec_id, c.label",
    "vec_rms": with_(_LONG) + f"select vec_id, dim, {s_r6('x / sqrt(avg(x * x) over (partition by vec_id) + 1e-8)')} as y from el",
    "vec_layernorm": with_(_LONG)
    + f"""select vec_id, dim, {s_r6('(x - m) / sqrt(avg((x - m) * (x - m)) over (partition by vec_id) + 1e-5)')} as y
from (select *, avg(x) over (partition by vec_id) as m from el)""",
    "vec_softmax": with_(_LONG)
    + f"select vec_id, dim, {s_r6('exp(x - m) / sum(exp(x - m)) over (partition by vec_id)')} as y from (select *, max(x) over (partition by vec_id) as m from el)",
    "vec_route": with_(_PROBS) + f"select vec_id, slot, expert::bigint as expert, {s_r6('p')} as weight from rt where slot < {TOP}",
    "vec_route_load": with_(_PROBS)
    + "select e.label::bigint as expert, count(vec_id) as n from (select distinct label from cent) e left join (select * from rt where slot = 0) r on r.expert = e.label group by e.label",
    "vec_balance": with_(_PROBS)
    + f"select {s_r6('count(*) * sum(imp * load)')} as aux_loss from (select expert, avg(p) as imp, avg(case when slot = 0 then 1.0::double else 0 end) as load from rt group by expert)",
    "vec_combine": with_(_PROBS)
    + f"""select el.vec_id, el.dim, {s_r6('sum(rt.p * (el.x * c.w + c.label))')} as y
from rt join el on el.vec_id = rt.vec_id join cent c on c.label = rt.expert and c.dim = el.dim where slot < {TOP} group by el.vec_id, el.dim""",
    "vec_pool": with_(SFT_ITEMS, _LONG)
    + f"""select pair_id, dim, {s_r6('avg(x)')} as mean
from (select pair_id, ids[i] as token from (select pair_id, ids, unnest(range(1, len(ids) + 1)) as i
      from (select pair_id, {s_bytes('response')} as ids from sft_items))) s join el on el.vec_id = s.token group by pair_id, dim""",
    "vec_attend": _attend_sql(_EARLIER),
    "vec_attend_shared": "select vec_id % 2 as half, vec_id // 2 as k, pos, dim, y from ("
    + _attend_sql(_EARLIER).replace("from embeddings", "from (select vec_id, vec_id % 2 as label, embedding from embeddings)")
    + ")",
    "vec_attend_heads": _attend_sql(_EARLIER, HEADS, KV_HEADS),
    "vec_attend_window": _attend_sql(f"b.pos <= a.pos and (b.pos > a.pos - {WINDOW} or b.pos < {SINK})"),
}

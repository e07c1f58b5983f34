"""Tokenisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import bpe, tokens
from corpusflow.sources import tables as t

from .kit import big, digest, r6, s_bytes, s_digest, s_r6

WORD_RULE = "[^ \\t\\n\\r\\f\\v]+"
BPE_VOCAB = 300


def tok_byte_enc(spark, root):
    docs = tokens.byte_encode(t.documents(spark, root, "text"))
    return docs.select("doc_id", big(F.size("ids")).alias("n_tokens"), digest("ids").alias("ids_md5"))


def tok_byte_dec(spark, root):
    docs = tokens.byte_encode(t.documents(spark, root, "text"))
    return tokens.byte_decode(docs.select("doc_id", "ids")).select("doc_id", "text")


def tok_roundtrip(spark, root):
    docs = t.documents(spark, root, "text")
    bad = tokens.roundtrip_failures(docs).agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return docs.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_failures", big(bad))


def tok_pretok(spark, root):
    return bpe.pretoken_counts(t.documents(spark, root, "text"))


def tok_pretok_words(spark, root):
    return bpe.pretoken_counts(t.documents(spark, root, "text"), pattern=WORD_RULE)


def tok_bpe_pairs(spark, root):
    words = bpe.pretoken_counts(t.documents(spark, root, "text"), pattern=WORD_RULE)
    top = bpe.top_pairs(words.select(tx.latin_bytes("word").alias("w"), "n"), 50)
    return top.select(
        big(F.ascii(F.substring("pair", 1, 1))).alias("left_id"),
        big(F.ascii(F.substring("pair", 2, 1))).alias("right_id"),
        big("c").alias("n"),
    )


def tok_bpe_train(spark, root):
    _, merges = bpe.train_bpe(t.documents(spark, root, "text"), BPE_VOCAB)
    return merges


def tok_bpe_enc(spark, root):
    docs = t.documents(spark, root, "text")
    _, merges = bpe.train_bpe(docs, BPE_VOCAB)
    return bpe.bpe_encode(docs, merges).select("doc_id", big(F.size("ids")).alias("n_tokens"), digest("ids").alias("ids_md5"))


def tok_bpe_dec(spark, root):
    docs = t.documents(spark, root, "text")
    vocab, merges = bpe.train_bpe(docs, BPE_VOCAB)
    coded = bpe.bpe_encode(docs, merges).select("doc_id", "ids")
    return bpe.bpe_decode(coded, vocab).select("doc_id", "text")


def tok_counts(spark, root):
    docs = tokens.byte_encode(t.documents(spark, root, "text"))
    return tokens.token_counts(docs).select(big("token").alias("token"), "n")


def tok_stats(spark, root):
    docs = tokens.byte_encode(t.documents(spark, root, "lang", "text"))
    return tokens.token_stats(docs, "lang").withColumn("bytes_per_token", r6("bytes_per_token"))


QUERIES = {
    f.__name__: f
    for f in (
        tok_byte_enc, tok_byte_dec, tok_roundtrip, tok_pretok, tok_pretok_words, tok_bpe_pairs, tok_bpe_train,
        tok_bpe_enc, tok_bpe_dec, tok_counts, tok_stats,
    )
}

_WORDS = """words as (
  select word, count(*) as n from (select unnest(regexp_extract_all(text, '[^ \\t\\n\\r\\f\\v]+')) as word from documents) group by word)"""

# White space of the split pattern, written out: SQL patterns know ASCII white space only.
_WS = r"\x{9}-\x{d}\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# The look-ahead only decides where a run of spaces is cut, so that place is marked first.
_PRETOK = rf"""pre as (
  select word, count(*) as n from (
    select unnest(regexp_extract_all(seg, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_WS}]+|[{_WS}]+')) as word
    from (select unnest(string_split(regexp_replace(line, '([{_WS}])([^{_WS}])', chr(1) || '\1\2', 'g'), chr(1))) as seg
          from (select unnest(regexp_extract_all(text, '[^\n]*\n|[^\n]+')) as line from documents)))
  group by word)"""

# Bytes in vocabulary order, and a word as one character per token; characters sort like token ids.
_SYMBOLS = """byte_order as (
  select list_concat(range(33, 127), range(161, 173), range(174, 256), range(0, 33), range(127, 161), [173]) as o),
sym as (select list(chr((256 + 5 + list_position(o, b) - 1)::int) order by b) as s from byte_order, range(256) r(b))"""


def s_symbols(word: str) -> str:
    return f"array_to_string(list_transform({s_bytes(word)}, lambda b: s[b + 1]), '')"


# Every step counts the pairs of all words anew and merges the most frequent one (then the smallest ids).
BPE_TRAIN = f"""{_PRETOK}, {_SYMBOLS},
rec(step, w, n, pair) as (
  select 0, {s_symbols('word')}, n, null::varchar from pre, sym
  union all
  select step + 1, replace(w, p, chr(256 + 261 + step)), n, p from rec, (
    select p from (select substr(w, i::bigint, 2) as p, sum(n) as c from (select w, n, unnest(range(1, length(w))) as i from rec) group by 1)
    where c >= 2 order by c desc, p limit 1) where step < {BPE_VOCAB - 261}),
merges as materialized (select distinct step - 1 as rank, pair from rec where step > 0)"""
_MERGES = "select rank::int as rank, (unicode(pair[1]) - 256)::int as left, (unicode(pair[2]) - 256)::int as right, (261 + rank)::int as new_id from merges"
# The same split without cutting lines first, in the order of the text.
_DOC_WORDS = rf"""segs as (
  select doc_id, unnest(range(1, len(g) + 1)) as j, unnest(g) as seg
  from (select doc_id, string_split(regexp_replace(text, '([{_WS}])([^{_WS}])', chr(1) || '\1\2', 'g'), chr(1)) as g from documents)),
doc_words as (
  select doc_id, j, unnest(range(1, len(h) + 1)) as i, unnest(h) as word
  from (select doc_id, j, regexp_extract_all(seg, '''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_WS}]+|[{_WS}]+') as h from segs))"""
# Merges in the order they were learnt, each over all words at once.
_ENCODED = f"""{_DOC_WORDS},
apply(step, word, w) as (
  select 0, word, {s_symbols('word')} from (select distinct word from doc_words), sym
  union all
  select step + 1, word, replace(w, pair, chr((256 + 261 + step)::int)) from apply join merges on rank = step),
coded as (select word, w from apply where step = (select max(rank) + 1 from merges))"""

_SPLIT = rf"'''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^\p{{L}}\p{{N}}{_WS}]+|[{_WS}]+'"


def s_bpe_ids(source: str) -> str:
    """``lists(key, l)``: ids by the learnt merges of ``source(key, text)``, reserved tokens as ids of their own."""
    names = ", ".join(f"'{s}'" for s in bpe.SPECIALS)
    own = " ".join(f"when '{s}' then chr({256 + i})" for i, s in enumerate(bpe.SPECIALS))
    return rf"""parts as (
  select key, unnest(range(1, len(g) + 1)) as q, unnest(g) as part
  from (select key, string_split(regexp_replace(text, '({'|'.join(bpe.SPECIALS)})', chr(2) || '\1' || chr(2), 'g'), chr(2)) as g from ({source}))),
part_segs as (
  select key, q, unnest(range(1, len(g) + 1)) as j, unnest(g) as seg
  from (select key, q, case when part in ({names}) then [part]
          else string_split(regexp_replace(part, '([{_WS}])([^{_WS}])', chr(1) || '\1\2', 'g'), chr(1)) end as g from parts)),
part_words as (
  select key, q, j, unnest(range(1, len(h) + 1)) as i, unnest(h) as word
  from (select key, q, j, case when seg in ({names}) then [seg] else regexp_extract_all(seg, {_SPLIT}) end as h from part_segs)),
apply(step, word, w) as (
  select 0, word, case word {own} else {s_symbols('word')} end from (select distinct word from part_words), sym
  union all
  select step + 1, word, replace(w, pair, chr((256 + 261 + step)::int)) from apply join merges on rank = step),
coded as (select word, w from apply where step = (select max(rank) + 1 from merges)),
lists as (
  select key, list_transform(string_split(string_agg(w, '' order by q, j, i), ''), lambda c: unicode(c) - 256) as l
  from part_words join coded using (word) group by key)"""


ORACLE = {
    "tok_bpe_train": f"with recursive {BPE_TRAIN} {_MERGES}",
    "tok_bpe_enc": f"""with recursive {BPE_TRAIN}, {_ENCODED},
ids as (select doc_id, string_agg(w, '' order by j, i) as w from doc_words join coded using (word) group by doc_id),
lists as (select d.doc_id, list_transform(string_split(coalesce(w, ''), ''), lambda c: unicode(c) - 256) as l
          from documents d left join ids on ids.doc_id = d.doc_id)
select doc_id, (case when l = [-257] then 0 else len(l) end)::bigint as n_tokens, md5(array_to_string(l, ',')) as ids_md5 from lists""",
    "tok_pretok": f"with {_PRETOK} select word, n from pre",
    "tok_byte_enc": f"select doc_id, len(ids)::bigint as n_tokens, {s_digest('ids')} as ids_md5 from (select doc_id, {s_bytes('text')} as ids from documents)",
    "tok_byte_dec": "select doc_id, text from documents",
    "tok_bpe_dec": "select doc_id, text from documents",
    "tok_roundtrip": "select count(*) as n_rows, 0::bigint as n_failures from documents",
    "tok_pretok_words": f"with {_WORDS} select word, n from words",
    "tok_bpe_pairs": f"""with {_WORDS},
h as (select n, regexp_extract_all(hex(encode(word)), '..') as h from words),
p as (select n, ('0x' || h[i])::int as a, ('0x' || h[i+1])::int as b from (select n, h, unnest(range(1, len(h))) as i from h))
select a::bigint as left_id, b::bigint as right_id, sum(n)::bigint as n from p group by a, b order by n desc, a, b limit 50""",
    "tok_counts": f"select ids::bigint as token, count(*) as n from (select unnest({s_bytes('text')}) as ids from documents) group by ids",
    "tok_stats": f"""with d as (select lang, unnest({s_bytes('text')}) as id from documents)
select d.lang, count(*) as n_tokens, count(distinct id) as n_distinct, any_value(n_bytes) as n_bytes,
  {s_r6('any_value(n_bytes) / count(*)')} as bytes_per_token
from d join (select lang, sum(octet_length(encode(text)))::bigint as n_bytes from documents group by lang) s on s.lang = d.lang
group by d.lang""",
}

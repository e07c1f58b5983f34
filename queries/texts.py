"""Text formatting and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.sources import tables as t

from .kit import SFT_ITEMS, SFT_PAIRS, big, s_format, s_prompt, s_strip, with_


def txt_strip(spark, root):
    turns = t.table(spark, root, "conversations")
    padded = F.concat(F.lit(" \n\t"), F.col("text"), F.lit(" \r\n "))
    return turns.select("conv_id", "turn", tx.strip(padded).alias("text"))


def txt_concat_input(spark, root):
    return t.sft_pairs(spark, root).select("pair_id", tx.join_input("instruction", "input").alias("prompt"))


def txt_format(spark, root):
    return t.sft_items(spark, root).select("pair_id", tx.format_example("prompt", "response").alias("text"))


def txt_prompt_only(spark, root):
    return t.sft_items(spark, root).select("pair_id", tx.format_prompt("prompt").alias("text"))


def txt_norm(spark, root):
    return t.documents(spark, root, "text").select("doc_id", tx.normalize("text").alias("text"))


def txt_words(spark, root):
    docs = t.documents(spark, root, "text").select("doc_id", tx.words("text").alias("w"))
    return docs.select(
        "doc_id",
        big(F.size("w")).alias("n_words"),
        F.get("w", F.lit(0)).alias("first_word"),
        F.get("w", F.size("w") - 1).alias("last_word"),
    )


QUERIES = {f.__name__: f for f in (txt_strip, txt_concat_input, txt_format, txt_prompt_only, txt_norm, txt_words)}

_NORM = "trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))"

ORACLE = {
    "txt_strip": "select conv_id, turn, "
    + s_strip("(' ' || chr(10) || chr(9) || text || chr(160) || chr(13) || chr(10) || ' ')")
    + " as text from conversations",
    "txt_concat_input": with_(SFT_PAIRS)
    + "select pair_id, case when length(input) > 0 then instruction || chr(10) || input else instruction end as prompt from sft_pairs",
    "txt_format": with_(SFT_ITEMS) + f"select pair_id, {s_format('prompt', 'response')} as text from sft_items",
    "txt_prompt_only": with_(SFT_ITEMS) + f"select pair_id, {s_prompt('prompt')} as text from sft_items",
    "txt_norm": f"select doc_id, {_NORM} as text from documents",
    "txt_words": f"""select doc_id, len(w)::bigint as n_words, w[1] as first_word, w[-1] as last_word
from (select doc_id, list_filter(string_split({_NORM}, ' '), lambda x: x <> '') as w from documents)""",
}

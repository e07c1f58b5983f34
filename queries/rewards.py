"""Preference and reward queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusflow.operators import rewards as rw
from corpusflow.sources import tables as t
from corpusflow.sources import trajectories as tr

from .kit import EVAL_RESULTS, PREF_PAIRS, SFT_ITEMS, big, r6, s_r6, with_

WEIGHTS = [0.5, -1.25, 2.0, -3.0, 0.75]
MAX_NEW = 16


def _scored(spark, root):
    pairs = t.pref_pairs(spark, root)
    return rw.score(rw.score(pairs, WEIGHTS, "prompt", "chosen", "r_pos"), WEIGHTS, "prompt", "rejected", "r_neg")


def rw_score(spark, root):
    return rw.score(t.sft_items(spark, root), WEIGHTS, "prompt", "response").select("pair_id", r6("reward").alias("reward"))


def rw_fit(spark, root):
    weights = rw.fit_reward(t.pref_pairs(spark, root))
    return spark.createDataFrame(list(zip(rw.FEATURES, weights)), "feature string, weight double")


def rw_bt(spark, root):
    return rw.bradley_terry_loss(_scored(spark, root)).select(r6("loss").alias("loss"))


def rw_margin(spark, root):
    return rw.margin_ranking_loss(_scored(spark, root)).select(r6("loss").alias("loss"))


def rw_acc(spark, root):
    return rw.pair_accuracy(_scored(spark, root)).select(r6("accuracy").alias("accuracy"), "n")


def rw_avg(spark, root):
    scored = rw.score(t.sft_items(spark, root), WEIGHTS, "prompt", "response")
    return rw.average_reward(scored).select(r6("avg_reward").alias("avg_reward"), "n")


def rw_reject(spark, root):
    items = t.sft_items(spark, root).select("pair_id", "prompt", "response")
    return rw.make_pairs(items, tr.corpus_model(spark, root), "pair_id", MAX_NEW, temperature=0.7, k=50, seed=11)


QUERIES = {f.__name__: f for f in (rw_score, rw_fit, rw_bt, rw_margin, rw_acc, rw_avg, rw_reject)}


def s_words(x: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace(lower({x}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"


def s_score(prompt: str, response: str) -> str:
    n = f"greatest(length({response}), 1)::double"
    mine, theirs = f"list_distinct({s_words(response)})", f"list_distinct({s_words(prompt)})"
    terms = [
        f"ln(length({response}) + 1.0::double)",
        f"len({s_words(response)}) / {n}",
        f"length(regexp_replace({response}, '[^A-Za-z]', '', 'g')) / {n}",
        f"length(regexp_replace({response}, '[^.,;:!?]', '', 'g')) / {n}",
        f"len(list_intersect({mine}, {theirs})) / greatest(len({mine}), 1)::double",
    ]
    return "(" + " + ".join(f"({w}::double * ({x}))" for w, x in zip(WEIGHTS, terms)) + ")"


_SCORED = f"{PREF_PAIRS}, scored as (select pair_id, {s_score('prompt', 'chosen')} as r_pos, {s_score('prompt', 'rejected')} as r_neg from pref_pairs)"

ORACLE = {
    "rw_score": with_(SFT_ITEMS) + f"select pair_id, {s_r6(s_score('prompt', 'response'))} as reward from sft_items",
    "rw_bt": with_(_SCORED) + f"select {s_r6('avg(greatest(r_neg - r_pos, 0) + ln(1 + exp(-abs(r_neg - r_pos))))')} as loss from scored",
    "rw_margin": with_(_SCORED) + f"select {s_r6('avg(greatest(0, 1 - (r_pos - r_neg)))')} as loss from scored",
    "rw_acc": with_(_SCORED) + f"select {s_r6('sum(case when r_pos > r_neg then 1 else 0 end) / count(*)')} as accuracy, count(*) as n from scored",
    "rw_avg": with_(SFT_ITEMS) + f"select {s_r6('avg(' + s_score('prompt', 'response') + ')')} as avg_reward, count(*) as n from sft_items",
}

"""Sampling draws from the whole vocabulary, whatever its size."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as tx
from corpusflow.operators import ngram

DOCS = [[3, 7, 3, 9, 3, 7, 11, 7, 3, 7], [0, 1, 0, 19, 0, 1], [5, 5, 5, 18, 5, 0, 5, 2, 5]]
OPTIONS = [(1.0, None, None), (0.7, 3, None), (1.3, 12, None), (1.0, None, 0.61), (1.5, None, 0.93), (0.8, 15, 0.91), (2.0, 2, 0.31)]


def _fitted(spark, vocab, order=2):
    table = spark.createDataFrame([(d,) for d in DOCS], "ids array<int>")
    return ngram.fit_ngram(table, order=order, vocab=vocab)


def _all_tokens(model, ctx, temperature, k, p):
    """Ends of the slices of every token by plain arithmetic; zero width where cut off."""
    counts = {r["next"]: r["n"] for r in model.counts.filter(F.col("ctx") == ctx).collect()}
    n = np.array([counts.get(t, 0) for t in range(model.vocab)], float)
    logit = np.log((n + 1) / (n.sum() + model.vocab)) / temperature
    share = np.exp(logit - logit.max())
    share /= share.sum()
    if k is not None and k < model.vocab:
        share = np.where(logit >= np.sort(logit)[-k], share, 0)
        share /= share.sum()
    if p is not None:
        order = sorted(np.flatnonzero(share), key=lambda t: (-logit[t], t))
        held = np.cumsum(share[order])
        share[[t for i, t in enumerate(order) if i and held[i] > p]] = 0
        share /= share.sum()
    return share


@pytest.mark.parametrize(("temperature", "k", "p"), OPTIONS)
def test_choices_equal_a_table_of_all_tokens(spark, temperature, k, p):
    model = _fitted(spark, 20)
    table = ngram.generation_table(model, temperature, k, p)
    for ctx in (3, 5, 17):
        share = _all_tokens(model, ctx, temperature, k, p)
        ends = np.cumsum(share)
        points = [(float((a + b) / 2), t) for t, (a, b) in enumerate(zip(np.append(0, ends[:-1]), ends)) if b - a > 1e-12]
        asked = spark.createDataFrame([(ctx, u, t) for u, t in points], "ctx long, u double, t int")
        choice = F.coalesce("choice", ngram.unseen_choice(model, temperature, p))
        found = asked.join(table, "ctx", "left").select("t", ngram.pick(choice, F.col("u"), 20).alias("got")).collect()
        assert [r["t"] for r in found] == [r["got"] for r in found] and len(found) == len(points)


def test_vocabulary_256_and_257_draw_alike(spark):
    """One token more, never seen and never drawn at a cut-off that ends before it: the same ids by both paths."""
    prompts = spark.createDataFrame([(i, [i % 20, 3]) for i in range(30)], "id long, prompt_ids array<int>")
    options = {"max_new": 8, "key": "id", "temperature": 1.0, "p": 0.5, "seed": 4}
    narrow, wide = _fitted(spark, 256), _fitted(spark, 257)
    assert narrow.bounded and not wide.bounded
    short = {r["id"]: r["new_ids"] for r in ngram.generate(prompts, narrow, **options).collect()}
    table, unseen = ngram.generation_table(narrow, 1.0, None, 0.5), ngram.unseen_choice(narrow, 1.0, 0.5)
    start = prompts.select("id", F.lit(0).alias("sample"), F.col("prompt_ids").alias("start"))
    joined = {r["id"]: r["new_ids"] for r in ngram._generate_by_join(start, table, unseen, narrow, 8, "id", 4, 1).collect()}
    other = {r["id"]: r["new_ids"] for r in ngram.generate(prompts, wide, **options).collect()}
    assert short == joined and all(other[i] for i in other)
    assert np.mean([len(short[i]) == len(other[i]) for i in short]) > 0.9


def test_unseen_contexts_and_large_vocabularies(spark):
    model = _fitted(spark, 50_000, 3)
    prompts = spark.createDataFrame([(i, [40_000 + i, 17]) for i in range(40)], "id long, prompt_ids array<int>")
    found = ngram.generate(prompts, model, 6, "id", seed=9, eos=None).collect()
    drawn = [t for r in found for t in r["new_ids"]]
    assert len(drawn) == 240 and 0 <= min(drawn) and max(drawn) < 50_000 and np.mean(drawn) == pytest.approx(25_000, rel=0.15)
    greedy = ngram.generate(prompts, model, 3, "id", temperature=0, eos=None).first()
    assert greedy["new_ids"] == [0, 0, 0]


def test_byte_and_join_paths_agree_on_text(spark):
    docs = spark.createDataFrame([("abracadabra banana",), ("cabbage",)], "t string").select(tx.byte_ids("t").alias("ids"))
    model = ngram.fit_ngram(docs)
    prompts = spark.createDataFrame([(1, "ab"), (2, "zz"), (3, "")], "id bigint, t string").select("id", tx.byte_ids("t").alias("prompt_ids"))
    fast = ngram.generate(prompts, model, 12, "id", temperature=1.4, seed=3, group_size=3)
    start = prompts.select("id", F.explode(F.array(*map(F.lit, range(3)))).alias("sample"), ngram._start_ids(F.col("prompt_ids"), 256).alias("start"))
    table = ngram.generation_table(model, 1.4)
    slow = ngram._generate_by_join(start, table, ngram.unseen_choice(model, 1.4), model, 12, "id", 3, 1)
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))


def test_counts_in_tasks_equal_counted_rows(spark):
    docs = [*DOCS, [], [4], None, [-100, 3, 7], [3, 25, 7, 3], [3, None, 7, 7]]
    table = spark.createDataFrame([(d,) for d in docs], "ids array<int>").repartition(3)
    found = {(r["ctx"], r["next"]): r["n"] for r in ngram.count_transitions(table, vocab=20).collect()}
    pairs = [(a, b) for d in docs if d for a, b in zip(d, d[1:]) if None not in (a, b) and 0 <= a < 20 and 0 <= b < 20]
    assert found == {p: pairs.count(p) for p in pairs}


def test_counts_of_texts_equal_counts_of_their_bytes_in_bounded_slices(spark, monkeypatch):
    texts = [(1, "a", "abcabc"), (2, "a", ""), (3, None, "x"), (4, None, "é漢z"), (5, "b", None), (6, "b", "ab"), (7, "a", "bc" * 40)]
    docs = spark.createDataFrame(texts, "doc_id int, lang string, text string").repartition(1)
    lists = docs.select("lang", tx.byte_ids("text").alias("ids"))
    largest, bincount = [], np.bincount
    for order in (2, 3):
        expected, whole = Counter(), Counter()
        for _, lang, text in texts:
            data = (text or "").encode()
            for i in range(len(data) - order + 1):
                ctx = int.from_bytes(data[i : i + order - 1], "big")
                expected[lang, ctx, data[i + order - 1]] += 1
                whole[ctx, data[i + order - 1]] += 1
        for df, ids in ((docs, "text"), (lists, "ids")):
            keyed = ngram.count_transitions(df, "lang", order=order, ids=ids)
            assert {(r["lang"], r["ctx"], r["next"]): r["n"] for r in keyed.collect()} == expected
            assert {(r["ctx"], r["next"]): r["n"] for r in ngram.count_transitions(df, order=order, ids=ids).collect()} == whole
    # what a task holds at once is a slice, however many rows a batch has
    monkeypatch.setattr(ngram, "SLICE", 100)
    monkeypatch.setattr(np, "bincount", lambda x, **k: largest.append(len(x)) or bincount(x, **k))
    batch = pa.RecordBatch.from_pydict({"_ids": pa.array(["abcd" * 5] * 1000)})
    (out,) = list(ngram._gram_counter(2, 10, [])([pa.RecordBatch.from_pydict({"_ids": pa.array([[1, 2, 3, -1, 2]] * 1000)})]))
    assert dict(zip(out["_code"].to_pylist(), out["n"].to_pylist())) == {12: 1000, 23: 1000}
    assert max(largest, default=0) <= 200 and len(list(ngram._id_slices(batch))) > 100

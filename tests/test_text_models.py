"""Bytes, merges, sampling, generation, vectors."""

from __future__ import annotations

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import pieces
from corpusflow.functions import text as tx
from corpusflow.operators import attention, bpe, ngram, rewards, vectors
from corpusflow.sources import tables as t

ROOT = "/root/testdata/sf0.001"


def test_broken_bytes_decode_like_errors_ignore(spark):
    rng = random.Random(5)
    pool = [b"a", "é".encode(), "�".encode(), "🚀".encode(), b"\xf0\x9f", b"\xc3", b"\x80", b"\xef\xbf", b"\xff", b"\x00"]
    cases = [b"", b"Hello, bytes! \xf0\x9f\x9a\x80"] + [b"".join(rng.choices(pool, k=rng.randint(1, 8))) for _ in range(300)]
    df = spark.createDataFrame([(i, list(c)) for i, c in enumerate(cases)], "i int, ids array<int>")
    got = {r["i"]: r["t"] for r in df.select("i", tx.byte_text("ids").alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [c.decode("utf-8", "ignore") for c in cases]


def test_strip_and_encode_like_python(spark):
    texts = ["", " \n\t a b \x0b\x0c\r", "  x　", "\x1c\x85y \n", "​z", None, "Hello, bytes! 🚀"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    got = df.select(tx.strip("t").alias("s"), tx.byte_ids("t").alias("b"), tx.byte_text(tx.byte_ids("t")).alias("r")).collect()
    for text, row in zip(texts, got):
        assert row["s"] == (None if text is None else text.strip())
        assert row["b"] == (None if text is None else list(text.encode())) and row["r"] == text


TEXTS = [
    "hello hello world\nthe theory of the other thermos, aren't they'll 1234 12  3\n\n  indented line\n",
    "banana bananas ananas aaaa aaaaa aaaaaaa \t tabs\tand  spaces  \nnaïve café 🚀🚀 ünder space\n" * 3,
    "</s> <s> marks <pad> inside!</s>",
]


@pytest.fixture(scope="module")
def trained(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    return df, *bpe.train_bpe(df, 310)


def test_merges_match_the_public_tokenizer(spark, trained, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    df, vocab, merges = trained
    files = []
    for i, text in enumerate(TEXTS):
        files.append(str(tmp_path / f"{i}.txt"))
        open(files[-1], "w", newline="").write(text)
    peer = tokenizers.ByteLevelBPETokenizer()
    peer.train(files, vocab_size=310, min_frequency=2, special_tokens=list(bpe.SPECIALS), show_progress=False)
    mine = [(r["left"], r["right"]) for r in merges.orderBy("rank").collect()]
    assert vocab.count() == peer.get_vocab_size()
    names = {i: s for s, i in peer.get_vocab().items()}
    theirs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in json.loads(peer._tokenizer.to_str())["model"]["merges"]]
    assert [(names[a], names[b]) for a, b in mine] == theirs
    coded = {r["doc_id"]: r["ids"] for r in bpe.bpe_encode(df, merges).collect()}
    for i, text in enumerate(TEXTS):
        assert coded[i] == peer.encode(text).ids


def test_decode_restores_text_without_reserved_tokens(spark, trained):
    df, vocab, merges = trained
    back = {r["doc_id"]: r["text"] for r in bpe.bpe_decode(bpe.bpe_encode(df, merges).select("doc_id", "ids"), vocab).collect()}
    assert back[0] == TEXTS[0] and back[1] == TEXTS[1] and back[2] == "  marks  inside!"
    broken = spark.createDataFrame([(1, [5, 300_0])], "doc_id bigint, ids array<int>")
    assert bpe.bpe_decode(broken, vocab).first()["text"].startswith("!")


def test_batched_merges_equal_one_at_a_time(spark, trained, monkeypatch):
    df, _, merges = trained
    plain = bpe._safe_run
    monkeypatch.setattr(bpe, "_safe_run", lambda *a: plain(*a)[:1])
    _, single = bpe.train_bpe(df, 290)
    assert sorted(single.collect()) == sorted(merges.filter(F.col("new_id") < 290).collect())


def test_training_stops_below_min_frequency(spark):
    df = spark.createDataFrame([(1, "hello hello world")], "doc_id int, text string")
    vocab, merges = bpe.train_bpe(df, 1000)
    assert vocab.count() == 261 + merges.count() and merges.count() < 20


ODD = ["''s a's's 're 'rest", " ' x", "a  b\t\n\n  c \n", "\u00a0\u3000x\u0085", "\u0663\u00bd4 \u4e2d\u6587 e\u0301 \U0001f680", "<s> <s></s><pad", "  <mask>  x'", "aaaaa", "", " ", None, "\x00\x1c'll"]


def test_pieces_equal_those_of_the_pattern(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "i int, text string")
    lines = F.flatten(F.transform(F.split("text", r"(?<=\n)"), lambda line: bpe.pretokens(line)))
    marks = [s.encode() for s in bpe.SPECIALS]
    names = {b: bpe._symbol(5 + i) for i, b in enumerate(bpe._byte_order())}
    for rule, options in ((lines, {"lines": True}), (bpe.bpe_pieces("text"), {"marks": marks})):
        expected = [r[0] or [] for r in df.orderBy("i").select(rule).collect()]
        words, at = pieces.split(pa.array(ODD, pa.string()), **options)
        found = [words[a:b].to_pylist() for a, b in zip(at.tolist(), at.tolist()[1:])]
        if "marks" in options:
            found = [[bpe._symbol(marks.index(w)) if w in marks else "".join(names[b] for b in w) for w in row] for row in found]
        else:
            found = [[w.decode() for w in row] for row in found]
        assert found == expected


def test_words_and_pairs_are_counted_inside_tasks(spark):
    """No row for every piece of a text or pair of a word: the rows of a task grow with what differs in it."""
    df = spark.createDataFrame([("one two  two\n" * 5000,), (None,), ("",)], "text string").coalesce(1)
    counts = bpe.pretoken_counts(df)
    assert "Generate" not in counts._jdf.queryExecution().toString()
    assert bpe._task_counts(df, "text").count() == 4
    assert {r["word"]: r["n"] for r in counts.collect()} == {"one": 5000, " two": 10000, " ": 5000, "\n": 5000}
    words = bpe._in_ids(counts, 5, np.uint16)
    assert bpe._top_codes(words, [], np.uint16, 261, 128).count() == 5
    assert bpe._task_counts(df.filter("text is null"), "text").count() == 0


def test_pairs_of_large_vocabularies_count_alike(spark, trained, monkeypatch):
    df, _, merges = trained
    monkeypatch.setattr(bpe, "TABLE_CELLS", 0)
    _, sorted_merges = bpe.train_bpe(df, 280)
    assert sorted(sorted_merges.collect()) == sorted(merges.filter(F.col("new_id") < 280).collect())


def test_merging_takes_the_first_rank_of_each_word():
    """Also where a merge gives an earlier token again, whose own pairs rank before it."""
    rules = [(1, 1, 5), (7, 3, 8), (2, 5, 6), (6, 6, 7), (5, 3, 9)]
    words = [[1, 1, 1, 1, 1], [], [2, 1, 1, 2, 1, 1, 3], [3], [1, 1, 3, 1, 3], [9, 9]]

    def plain(ids):
        while found := [(rules.index(r), r) for r in rules if r[:2] in set(zip(ids, ids[1:]))]:
            (left, right, new), out, i = min(found)[1], [], 0
            while i < len(ids):
                hit = ids[i : i + 2] == [left, right]
                out.append(new if hit else ids[i])
                i += 1 + hit
            ids = out
        return ids

    ids, at = pieces.Rules(rules).merge(np.array(sum(words, [])), np.cumsum([0, *map(len, words)]))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [plain(w) for w in words]
    assert pieces.Rules([]).merge(np.array([1, 1]), np.array([0, 2]))[0].tolist() == [1, 1]


def _model(spark, vocab=256, order=2):
    docs = spark.createDataFrame([("abracadabra banana",), ("cabbage bandana",), ("",), ("z",)], "text string")
    return ngram.fit_ngram(docs.select(tx.byte_ids("text").alias("ids")), order=order, vocab=vocab)


def test_distributions_sum_to_one(spark):
    logits = _model(spark).dense("logit")
    dist = ngram.next_token_dist(logits, 0.7)
    for table in (dist, ngram.top_k(dist, 5), ngram.top_p(ngram.top_k(dist, 5), 0.6)):
        sums = table.groupBy("ctx").agg(F.sum("p").alias("s")).agg(F.min("s"), F.max("s"), F.count("*")).first()
        assert sums[0] == pytest.approx(1) and sums[1] == pytest.approx(1) and sums[2] == 256
    # ties at the k-th largest stay: a context never seen has 256 equal logits
    assert ngram.top_k(dist, 5).filter("ctx = 0").count() == 256
    assert ngram.top_p(dist, 1.0) is dist


def test_generation_in_row_equals_generation_by_join(spark):
    model = _model(spark)
    prompts = spark.createDataFrame([(1, "ab"), (2, ""), (3, "ban" * 200)], "id bigint, t string").select("id", tx.byte_ids("t").alias("prompt_ids"))
    options = dict(max_new=10, key="id", temperature=0.8, k=6, p=0.9, seed=3, group_size=2)
    fast = ngram.generate(prompts, model, **options)
    start = prompts.select("id", F.explode(F.array(F.lit(0), F.lit(1))).alias("sample"), ngram._start_ids(F.col("prompt_ids"), 256).alias("start"))
    slow = ngram._generate_by_join(start, ngram.generation_table(model, 0.8, 6, 0.9), ngram.unseen_choice(model, 0.8, 0.9), model, 10, "id", 3, 1)
    assert sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))
    assert {r["id"]: len(r["prompt_ids"]) for r in fast.collect()} == {1: 2, 2: 1, 3: 256}
    stop = ngram.generate(prompts, model, 10, "id", temperature=0, eos=ord("a")).filter("id = 3").first()["new_ids"]
    assert stop == [ord("a")]


def test_unbounded_model_scores_like_brute_force(spark):
    docs = ["abracadabra banana", "cabbage bandana", "", "z"]
    model = _model(spark, order=3)
    assert not model.bounded
    df = spark.createDataFrame([(1, "abraxas banana")], "id int, t string").select("id", tx.byte_ids("t").alias("ids"))
    got = {r["pos"]: r["logp"] for r in ngram.token_logprobs(df, model, "id").collect()}
    text = "abraxas banana"
    for i in range(2, len(text)):
        ctx = text[i - 2 : i]
        n = sum(d[j : j + 3] == text[i - 2 : i + 1] for d in docs for j in range(len(d) - 2))
        total = sum(d[j : j + 2] == ctx for d in docs for j in range(len(d) - 2))
        assert got[i] == pytest.approx(np.log((n + 1) / (total + 256)))
    assert len(got) == len(text) - 2


def test_projection_by_slabs_equals_inline(spark):
    emb = t.table(spark, ROOT, "embeddings")
    experts = vectors.centroids(emb, "embedding", "label")
    inline = {r["vec_id"]: r["y"] for r in vectors.project(emb, "embedding", experts, "vec_id").collect()}
    slabs = {r["vec_id"]: r["y"] for r in vectors.project(emb, "embedding", experts, "vec_id", inline_cells=3 * 64).collect()}
    assert inline.keys() == slabs.keys() and all(np.allclose(inline[k], slabs[k]) for k in inline)


def test_toy_attention_and_mask(spark):
    x = np.random.default_rng(0).normal(size=(70, 4))
    df = spark.createDataFrame([(i, 0, x[i].tolist()) for i in range(70)], "id bigint, g int, x array<double>")

    def brute(seen):
        out = []
        for i in range(70):
            js = [j for j in range(i + 1) if seen(i, j)]
            s = np.array([x[i] @ x[j] / 2 for j in js])
            w = np.exp(s - s.max())
            out.append((w / w.sum()) @ x[js])
        return np.array(out)

    def run(**kw):
        rows = attention.causal_attend(df, "g", "id", "x", "x", "x", **kw).orderBy("id").collect()
        return np.array([r["y"] for r in rows])

    assert np.allclose(run(), brute(lambda i, j: True))  # the history reaches over blocks
    assert np.allclose(run(block=3), brute(lambda i, j: i // 3 == j // 3))
    assert np.allclose(run(window=5, sink=2), brute(lambda i, j: j > i - 5 or j < 2))
    assert np.allclose(run(window=4), brute(lambda i, j: j > i - 4))
    assert attention.masked_pair_count(5) == 10


def test_norms_are_normal(spark):
    df = spark.createDataFrame([(1, [1.0, -2.0, 3.5, 0.0])], "id int, x array<double>")
    r, l = df.select(vectors.rms_norm("x"), vectors.layer_norm("x")).first()
    assert np.mean(np.square(r)) == pytest.approx(1) and np.mean(l) == pytest.approx(0) and np.var(l) == pytest.approx(1, abs=1e-4)


def test_fitted_reward_ranks_its_pairs(spark):
    rows = [(i, "p", "good answer. " * (i % 5 + 3), "bad") for i in range(40)]
    pairs = spark.createDataFrame(rows, "pair_id int, prompt string, chosen string, rejected string")
    weights = rewards.fit_reward(pairs)
    scored = rewards.score(rewards.score(pairs, weights, "prompt", "chosen", "r_pos"), weights, "prompt", "rejected", "r_neg")
    assert rewards.pair_accuracy(scored).first()["accuracy"] == 1.0

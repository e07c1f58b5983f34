"""Exact and near duplicates, decontamination, components, the pipeline."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusflow.llm import exact, graph, minhash, queries, tiling
from corpusflow.llm.common import shingles, words
from tests.llm.conftest import rows_of

ROOT = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def plain_set(text):
    found = plain_words(text)
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def plain_components(texts, percent):
    """Smallest reachable id by comparing all pairs that share a shingle."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = collections.Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1 :])
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {i: top(i) for i in texts}, {i: len(s) for i, s in sets.items()}


# --- words --------------------------------------------------------------------
def test_word_hashes_follow_words():
    texts = ["The cat\tsat", None, "", " the\x0bCAT ", "É é thecat", "\x1f\x85 a b", "the", " "]
    hashes, at = words(pa.array(texts))
    found: dict = {}
    for i, text in enumerate(texts):
        own = plain_words(text)
        assert at[i + 1] - at[i] == len(own)
        for word, h in zip(own, hashes[at[i] : at[i + 1]].tolist()):
            assert found.setdefault(word, h) == h
    assert len(set(found.values())) == len(found)
    sliced = words(pa.array(["x", *texts]).slice(1))
    assert (sliced[0] == hashes).all()


# --- exact --------------------------------------------------------------------
@pytest.mark.parametrize("parts", [1, 2, 7, 40])
@pytest.mark.parametrize("keep", ["min", "max"])
def test_content_sort_equals_grouping(spark, parts, keep):
    rng = random.Random(parts)
    texts = ["Hot copy"] * 300 + [f"text {rng.randint(0, 40)} tail" for _ in range(300)] + ["hot COPY b", "", None]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in exact.assign(docs, keep=keep, parts=parts).collect()}
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    assert len(found) == len(rows)
    for norm, ids in groups.items():
        stays = min(ids) if keep == "min" else max(ids)
        for i in ids:
            r = found[i]
            assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (stays, len(ids), i == stays, hashlib.sha256(norm.encode()).hexdigest())


def test_content_sort_plan_is_native(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    plan = exact.classes(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert plan.count("Exchange") == 1  # texts move once


def test_exact_edges(odd, none):
    found = exact.assign(odd).collect()
    assert len(found) == odd.count()
    kept = collections.Counter(r["doc_id"] for r in found if r["kept"])
    # copies: 1, 2, 3, 3, null share a text; 4, 5, null are empty; 9, 10 are long
    assert kept == {i: 1 for i in (1, 4, 6, 7, 8, 9, 11, 12, 13)}
    assert {r["group_size"] for r in found if r["doc_id"] == 3} == {5}
    largest = collections.Counter(r["doc_id"] for r in exact.assign(odd, keep="max").collect() if r["kept"])
    assert largest == {i: 1 for i in (3, 5, 6, 7, 8, 10, 11, 12, 13)}
    out = exact.deduplicate(odd)
    assert out.columns == odd.columns and out.count() == 9
    assert exact.assign(none).count() == 0 and exact.deduplicate(none).columns == none.columns


# --- near ---------------------------------------------------------------------
def test_signature_is_circulant():
    hashes = np.unique(shingles(words(pa.array(["a b c d e f g h i j k l m n o p q r s t u v w"]))[0], 5))
    cells = minhash._shuffled(hashes >> np.uint64(64 - minhash.UNIVERSE_BITS), 0x61C88647, 0xC2B2AE35)
    ring = minhash._shuffled(np.arange(1 << minhash.UNIVERSE_BITS), 0x2545F491, 0x9E3779B1)
    assert len(np.unique(ring)) == len(ring)
    expected = [ring[(cells + np.uint64(k)) % np.uint64(len(ring))].min() & np.uint64(0xFFFF) for k in range(64)]
    assert minhash.signature(hashes, 64).tolist() == expected


def test_agreement_estimates_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = np.unique(pool[:1000]), np.unique(pool[100:1100])
    same = np.mean([(minhash.signature(a ^ np.uint64(s << 44)) == minhash.signature(b ^ np.uint64(s << 44))).mean() for s in range(12)])
    assert abs(same - 900 / 1100) < 0.03


def edited(rng, base, share):
    return [w if rng.random() > share else f"new{rng.randint(0, 10**6)}" for w in base]


@pytest.mark.parametrize("percent", [80, 85])
def test_clusters_equal_all_pairs(spark, monkeypatch, percent):
    """Large groups of near copies of graded similarity, so that links go through other members."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(percent)
    texts: dict = {}
    for g in range(3):
        base = [f"w{g}_{k}" for k in range(160)]
        for _ in range(70):
            texts[len(texts)] = " ".join(edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03])))
    for _ in range(60):
        texts[len(texts)] = " ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.randint(0, 60)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    roots, sizes = plain_components(texts, percent)
    found = minhash.clusters(docs, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == roots
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_query_equals_all_pairs(spark):
    docs = pd.read_parquet(f"{ROOT}/documents.parquet")
    roots, sizes = plain_components(dict(zip(docs.doc_id, docs.text)), 85)
    found = queries.op7_circulant_minhash(spark, ROOT).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in found} == {i: (roots[i], sizes[i]) for i in roots}


def test_near_edges(odd, none):
    found = minhash.clusters(odd, 85).collect()
    assert len(found) == odd.count()
    by = collections.defaultdict(list)
    for r in found:
        by[r["doc_id"]].append(r)
    assert [by[i][0]["component_id"] for i in (1, 2, 3, 7, 8, 9, 10, 12, 13)] == [1, 1, 1, 7, 7, 9, 9, 12, 13]
    assert all(by[i][0]["n_shingles"] == 0 and by[i][0]["component_id"] == i and by[i][0]["kept"] for i in (4, 5, 6))
    assert sorted(r["component_id"] or 0 for r in by[None]) == [0, 1]
    out = minhash.deduplicate(odd)
    assert out.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 0, 1, 4, 5, 6, 7, 9, 11, 12, 13]
    assert minhash.clusters(none, 85).count() == 0 and minhash.deduplicate(none).count() == 0


def test_near_batches_and_texts_are_bounded(spark, odd, monkeypatch):
    """Python gets batches of a few MB while texts are compared, and ids are sent to the texts, not texts to the ids."""
    key, seen, cut = "spark.sql.execution.arrow.maxBytesPerBatch", [], minhash.cut_lineage
    before, broadcast = spark.conf.get(key), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(minhash, "cut_lineage", lambda df: seen.append((df.columns, spark.conf.get(key))) or cut(df))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = minhash.deduplicate(odd)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    in_python = [limit for columns, limit in seen if "_dropped_id" not in columns]
    assert len(in_python) > 5 and set(in_python) == {"4m"} and spark.conf.get(key) == before
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    with pytest.raises(ValueError), minhash.small_batches(spark):
        raise ValueError
    assert spark.conf.get(key) == before


def test_stages_send_small_batches(spark, odd, labels, monkeypatch):
    key, seen, cut = "spark.sql.execution.arrow.maxBytesPerBatch", [], tiling.cut_lineage
    before = spark.conf.get(key)
    monkeypatch.setattr(tiling, "cut_lineage", lambda df: seen.append((df.columns, spark.conf.get(key))) or cut(df))
    tests = spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string")
    assert tiling.remove(odd, tests).count() < odd.count()
    assert [limit for columns, limit in seen if "key" in columns] == ["4m"] and spark.conf.get(key) == before
    try:
        corpus_pipeline.to_pieces(spark, odd, "")
        assert spark.conf.get(key) == "4m"
    finally:
        spark.conf.set(key, before)


def test_components_of_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 160)] + [(159, 200), (7, 7)]
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert {roots[i] for i in range(31)} == {0} and {roots[i] for i in [*range(100, 160), 200]} == {100}


# --- tiling -------------------------------------------------------------------
def plain_tiles(item, text, least):
    """Longest unmarked match first, by trying all places."""
    free_i, free_t, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_i[i + n] and free_t[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return sorted(out)
        out.append((i, j, n))
        for k in range(n):
            free_i[i + k] = free_t[j + k] = False


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_plain_search(seed):
    rng = random.Random(seed)
    item = [rng.randint(0, 4 + seed) for _ in range(rng.randint(1, 25))]
    text = [rng.randint(0, 4 + seed) for _ in range(rng.randint(0, 30))] + item[len(item) // 2 :] + item[: len(item) // 2]
    least = min(3, len(item))
    found = tiling.tiles(np.array(item, np.uint64) + np.uint64(7), np.array(text, np.uint64) + np.uint64(7), np.arange(len(text)), 3)
    assert found == plain_tiles(item, text, least)


@pytest.mark.parametrize("limit", [tiling.SEED_LIMIT, 0])
def test_contamination(spark, limit):
    """Whole, reordered, half and clean documents, with the seeds sent to the tasks and joined."""
    passage = [f"q{k}" for k in range(40)]
    filler = [f"f{k}" for k in range(60)]
    docs = [
        (1, " ".join(filler + passage + filler)),
        (2, " ".join(filler[:9] + passage[30:] + filler[:3] + passage[10:20] + filler[:2] + passage[20:30] + ["z"] + passage[:10])),
        (3, " ".join(filler + passage[:19])),
        (4, " ".join(filler + passage[:20])),
        (5, " ".join(reversed(passage))),
        (6, "x SHORT\tItem y"),
        (7, "short x item"),
        (8, None),
        (9, ""),
        (None, " ".join(passage)),
        (1, "another text with the same id"),
    ]
    bench = [(10, " ".join(passage)), (11, "short item"), (12, None), (13, " "), (10, "q0 q1 q2"), (None, "f1 f2 f3 f4 f5 f6")]
    found = tiling.contaminated(
        spark.createDataFrame(rows_of(*docs), "doc_id long, text string, a string, b string, n_chars long, _row string, _text string, _id long, _norm string, score double, kept string, node string, seeds string, key long, tokens string"),
        spark.createDataFrame(bench, "item_id long, text string"),
        seed_limit=limit,
    ).collect()
    got = {(r["doc_id"], r["item_id"]): (r["covered"], r["n_words"]) for r in found}
    assert got == {
        (1, 10): (40, 40), (2, 10): (40, 40), (3, 10): (3, 3), (4, 10): (3, 3), (6, 11): (2, 2), (None, 10): (40, 40),
        **{(i, None): (6, 6) for i in (1, 3, 4)}, (2, None): (6, 6),
    }
    two = next(r for r in found if (r["doc_id"], r["item_id"]) == (2, 10))
    assert [(t["item_start"], t["n"]) for t in two["tiles"]] == [(0, 10), (10, 10), (20, 10), (30, 10)]


def test_half_of_an_item_decides(spark):
    passage = [f"q{k}" for k in range(40)]
    docs = spark.createDataFrame([(3, " ".join(passage[:19])), (4, " ".join(passage[:20]))], "doc_id long, text string")
    found = tiling.contaminated(docs, spark.createDataFrame([(10, " ".join(passage))], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["covered"]) for r in found] == [(4, 20)]


def test_contamination_edges(spark, odd, none):
    bench = spark.createDataFrame([(1, "eins zwei drei vier fünf sechs"), (2, "nothing of this kind here at all")], "item_id long, text string")
    out = tiling.remove(odd, bench)
    assert out.columns == odd.columns and out.count() == odd.count() - 1 and out.filter("doc_id = 13").count() == 0
    assert tiling.remove(odd, bench.limit(0)).count() == odd.count() and tiling.remove(none, bench).count() == 0


# --- pipeline -----------------------------------------------------------------
def test_stages_decide_on_what_is_left(spark, tmp_path):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    left = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, ROOT)
        path = f"{tmp_path}/{k}"
        out.write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
        left[name] = docs.toPandas()
    texts = dict(zip(left["toxicity"].doc_id, left["toxicity"].text))
    firsts: dict = {}
    for i in sorted(texts):
        firsts.setdefault(texts[i].translate(LOWER), i)
    assert set(left["exact_dedup"].doc_id) == set(firsts.values())
    roots, _ = plain_components({i: texts[i] for i in firsts.values()}, 80)
    assert set(left["near_dedup"].doc_id) == set(roots.values())
    items = [plain_words(t) for t in pd.read_parquet(f"{ROOT}/benchmark.parquet").text]
    seeds = {tuple(i[k : k + 5]) for i in items for k in range(len(i) - 4)}

    def leaks(text):
        own = plain_words(text)
        if not any(tuple(own[k : k + 5]) in seeds for k in range(len(own) - 4)):
            return False
        return any(sum(n for _, _, n in plain_tiles(i, own, 5)) >= 0.5 * len(i) for i in items if any(tuple(i[k : k + 5]) in {tuple(own[m : m + 5]) for m in range(len(own) - 4)} for k in range(len(i) - 4)))

    assert set(left["decontamination"].doc_id) == {i for i in roots.values() if not leaks(texts[i])}
    assert set(left["pieces"].doc_id) == set(left["decontamination"].doc_id) and left["pieces"].round_trip.all()


def test_stages_take_odd_and_empty_tables(spark, odd, none, tmp_path):
    for start in (odd, none):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, ROOT)
            assert name == "pieces" or docs.columns == start.columns
        assert (docs.count() > 0) == (start is odd)
    assert F is not None

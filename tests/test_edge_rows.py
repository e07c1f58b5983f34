"""Null and repeated keys, size limits that must not change results, folder tables, empty streams."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import evals, ngram, policy, vectors
from corpusflow.plans import skew, storage
from corpusflow.sources import files
from corpusflow.streaming import jobs


def test_small_spread_around_large_rewards(spark):
    rows = [(1, 1e7 + 0.1, "a"), (1, 1e7 + 0.1004, "b"), (None, 2.0, "x"), (None, 2.0, "x"), (3, 1.0, "y"), (4, 0.0, "u"), (4, 5.0, "u")]
    found = {r["prompt_id"]: r for r in policy.collapsed_groups(spark.createDataFrame(rows, "prompt_id int, reward double, response string")).collect()}
    assert set(found) == {1, None}
    assert math.isclose(found[1]["std"], np.std([0.1, 0.1004], ddof=1), rel_tol=1e-3)
    assert (found[1]["n_distinct"], found[None]["n_distinct"], found[None]["std"]) == (2, 1, 0.0)


def test_null_text_has_no_words(spark):
    rows = [(1, None, "a b c"), (2, None, None), (3, "a b", "a b c"), (4, "", None)]
    found = {r["id"]: r["f1"] for r in evals.token_f1(spark.createDataFrame(rows, "id int, p string, g string"), "id", "p", "g").collect()}
    assert found == {1: 0.0, 2: 1.0, 3: 0.8, 4: 1.0}


def test_comparison_takes_the_last_duplicate(spark):
    rows = [("p", "sft", 5.0, 1), ("p", "sft", 1.0, 2), ("p", "ppo", 3.0, 1)]
    df = spark.createDataFrame(rows, "prompt string, method string, reward double, o int")
    assert evals.comparison_table(df, "o").first()["sft"] == 1.0
    with pytest.raises(TypeError):
        evals.comparison_table(df)


def test_one_response_per_key(spark):
    table = spark.createDataFrame([("p",), ("q",)], "prompt string")
    responses = spark.createDataFrame([("p", "b"), ("p", "a")], "prompt string, response string")
    assert sorted(map(tuple, evals.attach_response(table, responses).collect())) == [("p", "a"), ("q", evals.NO_RESPONSE)]


def test_folder_with_a_dot(spark, tmp_path):
    folder = tmp_path / "v1.0"
    folder.mkdir()
    (folder / "a.txt").write_text("yes")
    (folder / "b.md").write_text("no")
    assert [r["text"] for r in files.read_corpus(spark, str(folder)).collect()] == ["yes"]
    assert [r["text"] for r in files.read_corpus(spark, str(folder / "b.md")).collect()] == ["no"]


def test_scoring_has_one_rule_for_any_vocabulary(spark):
    """A vocabulary of 256 is broadcast, one of 257 is joined; rows outside either are left out by both."""
    ids = spark.createDataFrame([([1, 2, 3, 2, 3, 2, 1],)], "ids array<int>")
    rows = spark.createDataFrame([(1, 1, 2), (2, 2, 3), (3, 3, 200), (4, 2, -100), (5, 2, None), (6, None, 2), (7, 300, 2)], "id int, ctx long, next int")
    found = {}
    for vocab in (256, 257):
        model = ngram.fit_ngram(ids, vocab=vocab)
        assert model.bounded == (vocab == 256)
        found[vocab] = {r["id"]: math.exp(r["logp"]) * 1 for r in ngram.score_transitions(rows, model, salt_by=("id",)).collect()}
    assert found[256].keys() == found[257].keys() == {1, 2, 3}
    # add-one smoothing: only the vocabulary size differs
    for i, (n, total) in {1: (1, 1), 2: (2, 3), 3: (0, 2)}.items():
        assert math.isclose(found[256][i], (n + 1) / (total + 256), rel_tol=1e-9) and math.isclose(found[257][i], (n + 1) / (total + 257), rel_tol=1e-9)


@pytest.mark.parametrize("hot", [2, 10_000_000])
def test_null_keys_meet_null_keys(spark, hot):
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, None), (5, None), (6, "b")], "id int, k string")
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r["id"], r["k"], r["n"]) for r in skew.attach(rows, stats, ["k"], "n", ["id"], hot_rows=hot).collect())
    assert found == [(1, "a", 3), (2, "a", 3), (3, "a", 3), (4, None, 2), (5, None, 2), (6, "b", 1)]


@pytest.mark.parametrize("cells", [2, 262_144])
def test_projection_keeps_every_row(spark, cells):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (1, [3.0, 4.0]), (None, [5.0, 6.0])], "id int, x array<double>")
    identity = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "unit int, w array<double>")
    found = vectors.project(rows, "x", identity, "id", inline_cells=cells).collect()
    assert sorted((r["id"] or 0, r["x"], r["y"]) for r in found) == [(0, [5.0, 6.0], [5.0, 6.0]), (1, [1.0, 2.0], [1.0, 2.0]), (1, [3.0, 4.0], [3.0, 4.0]), (1, [3.0, 4.0], [3.0, 4.0])]


def test_stream_of_a_folder_table(spark, tmp_path):
    """Four part files, one a micro-batch: state is carried on, and the result is that of the batch."""
    events = [(u, i, float((i * 37) % 101)) for i in range(200) for u in [i % 3]]
    for part in range(4):
        some = spark.createDataFrame(events[part * 50 : part * 50 + 50], "user_id long, event_id long, value double")
        some.coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    stream = jobs.stream_table(spark, str(tmp_path), "events")
    found = jobs.run_to_table(jobs.streaming_best(stream, "user_id", "event_id", "value"), "best-folder").collect()
    best, expected = {}, []
    for u, i, v in events:
        if v < best.get(u, math.inf):
            best[u] = v
            expected.append((u, i, v))
    assert sorted(map(tuple, found)) == sorted(expected)


@pytest.mark.parametrize("mode", ["append", "update"])
def test_empty_stream(spark, tmp_path, mode):
    spark.createDataFrame([], "user_id long, event_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    stream = jobs.stream_table(spark, str(tmp_path), "events")
    assert jobs.run_to_table(stream, "empty", mode).count() == 0


def test_cluster_needs_a_shared_folder():
    class Session:
        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())

"""Streams against their batch results, late rows, file sources and sinks."""

from __future__ import annotations

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import runlog, scorer
from corpusflow.sources import files
from corpusflow.sources import tables as t
from corpusflow.streaming import jobs

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def in_files(spark, tmp_path_factory):
    """Events as six files in time order, one per micro-batch."""
    root = str(tmp_path_factory.mktemp("events"))
    events = t.table(spark, ROOT, "events").withColumn("user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id")))
    for i in range(6):
        events.filter(F.floor(F.col("event_id") / 170) == i).coalesce(1).write.mode("append").parquet(f"{root}/{i}")
    stream = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .option("latestFirst", "false")
        .parquet(root)
    )
    return events, stream


@pytest.mark.parametrize("window, sink", [(4, 2), (3, 0), (50, 5)])
def test_rolling_buffer_equals_batch(spark, in_files, window, sink):
    events, stream = in_files
    table = jobs.run_to_table(jobs.rolling_buffer(stream, "user_id", "event_id", "value", window, sink), "roll", "update")
    assert table.filter(F.size("seqs") > window + sink).count() == 0
    last = {r["user_id"]: r for r in table.orderBy("epoch").collect()}
    batch: dict = {}
    for r in jobs.rolling_buffer_batch(events.select("user_id", "event_id", "value"), "user_id", "event_id", window, sink).collect():
        batch.setdefault(r["user_id"], {})[r["event_id"]] = r["value"]
    counts = {r["user_id"]: r["count"] for r in events.groupBy("user_id").count().collect()}
    assert {k: dict(zip(r["seqs"], r["values"])) for k, r in last.items()} == batch
    assert {k: r["arrivals"] for k, r in last.items()} == counts
    assert all(list(r["seqs"]) == sorted(r["seqs"]) for r in last.values())


def test_streaming_best_equals_running_best(spark, in_files):
    events, stream = in_files
    got = jobs.run_to_table(jobs.streaming_best(stream, "user_id", "event_id", "value"), "best").collect()
    want = runlog.running_best(events, "user_id", "event_id", "value").filter("improved").select("user_id", "event_id", "value")
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


def test_best_in_any_order_over_micro_batches(spark, tmp_path):
    rows = [(r, s, float((s * 37 + (r or 4) * 11) % 101)) for r in (1, 2, None) for s in range(60)] + [(1, 5, 0.5), (2, 7, None), (3, 1, None)]
    schema = "run int, step bigint, loss double"
    for i in (2, 0, 3, 1):  # steps go back and forth between files
        spark.createDataFrame([r for r in rows if r[1] // 15 == i], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    table = jobs.run_to_table(jobs.best_any_order(stream, "run", "step", "loss"), "best", "update").collect()
    assert len({r["epoch"] for r in table}) == 4
    got = {r["run"]: list(zip(r["steps"], r["losses"])) for r in sorted(table, key=lambda r: r["epoch"])}
    want = {}
    for run in (1, 2, None, 3):
        best, want[run] = float("inf"), []
        for _, s, x in sorted((r for r in rows if r[0] == run and r[2] is not None), key=lambda r: (r[1], r[2])):
            if x < best:
                best = x
                want[run].append((s, x))
    assert {**{3: []}, **got} == want


def test_grouped_metrics_come_back(spark, tmp_path):
    rows = [(i, f"p{i % 3}", f"r{i}", float(i % 7)) for i in range(30)] + [(100, "one", "r", 2.0), (101, None, "n", 1.0)]
    df = spark.createDataFrame(rows, "id bigint, prompt string, response string, reward double")
    files.write_groups(df, f"{tmp_path}/whole", "id")
    raw = {r["prompt"]: r for r in spark.read.json(f"{tmp_path}/whole").collect()}
    assert set(raw) == {"p0", "p1", "p2", "one", None} and raw["one"]["group_std_reward"] is None
    for name in ("p0", "p1", "p2"):
        own = [r for r in rows if r[1] == name]
        values = pd.Series([r[3] for r in own])
        assert raw[name]["group_mean_reward"] == round(values.mean(), 4) and raw[name]["group_std_reward"] == round(values.std() + 1e-6, 4)
        assert [(s["prompt"], s["response"], s["reward"]) for s in raw[name]["samples"]] == [r[1:] for r in own]
    best = {r["prompt"]: r["response"] for r in files.read_metrics(spark, f"{tmp_path}/whole", "grpo", lines=True).collect()}
    assert best["p0"] == "r6" and best["one"] == "r"
    files.write_groups(df, f"{tmp_path}/cut", "id", block=4)  # no line above the block holds a whole group
    cut = spark.read.json(f"{tmp_path}/cut").collect()
    assert sum(len(r["samples"]) for r in cut) == 32 and len(cut) > 5
    assert all(r["group_mean_reward"] == raw[r["prompt"]]["group_mean_reward"] for r in cut)


def test_late_rows_are_dropped_from_closed_windows(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    # a batch is judged by the watermark the batch before it ran with
    for i, minutes in enumerate([[0, 10], [300], [305], [20, 310], [700]]):
        rows = [(base + dt.timedelta(minutes=m), 1.0) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp_ntz, value double").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("ts timestamp_ntz, value double").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    windows = jobs.metric_windows(stream, "ts", F.col("value"), "1 hour", "10 minutes")
    got = {r["start"].hour: r["n"] for r in jobs.run_to_table(windows, "late").collect()}
    assert got == {0: 2, 5: 3}


def test_retention_and_rates(spark):
    rows = [(r, s, 1_000_000 * s * s, 10) for r in (1, 2) for s in range(1, 6)]
    df = spark.createDataFrame(rows, "run int, step bigint, micros bigint, tokens bigint")
    assert sorted(r["step"] for r in runlog.retain_last(df, 2, "run", "step").filter("run = 1").collect()) == [4, 5]
    assert runlog.retain_last(df, 0, "run", "step").count() == 10
    rates = {r["step"]: r["tokens_per_s"] for r in runlog.throughput(df, "run", "step", "micros", "tokens").filter("run = 2").collect()}
    assert rates == {1: None, 2: 10 / 3, 3: 10 / 5, 4: 10 / 7, 5: 10 / 9}


def test_retention_limits_inside_tasks(spark):
    plan = runlog.retain_last(spark.range(100).selectExpr("id % 3 as run", "id as step"), 3, "run", "step")
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


def test_norms_skip_values_that_are_not_finite(spark):
    df = spark.createDataFrame([(1, [3.0, float("nan"), 4.0]), (1, [float("inf"), None]), (2, [float("nan")])], "k int, v array<double>")
    got = {r["k"]: (r["l2"], r["rms"], r["n"]) for r in runlog.norms(df, "v", "k").collect()}
    assert got[1] == (5.0, pytest.approx((25 / 2) ** 0.5), 2) and got[2] == (0.0, None, 0)


def test_text_and_byte_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("one\ntwo\r\n", newline="")
    (tmp_path / "in" / "deep" / "b.txt").write_text("three")
    (tmp_path / "in" / "c.md").write_text("not read")
    folder = str(tmp_path / "in")
    assert sorted(r["text"] for r in files.read_corpus(spark, folder).collect()) == ["one", "three", "two\r"]
    assert sorted(r["text"] for r in files.read_corpus(spark, folder, whole=True).collect()) == ["one\ntwo\r\n", "three"]
    assert [r["text"] for r in files.read_corpus(spark, f"{folder}/a.txt").collect()] == ["one", "two\r"]
    assert bytes(files.read_bytes(spark, f"{folder}/deep/b.txt").first()["content"]) == b"three"
    with pytest.raises(FileNotFoundError):
        files.read_corpus(spark, f"{folder}/missing")
    with pytest.raises(FileNotFoundError):
        files.load_tokenizer(spark, folder)


@pytest.mark.parametrize(
    "layout, text",
    [
        ("sft", '{"average_reward": 1, "samples": [{"prompt": "p", "response": "r", "reward": 1.23456}]}'),
        ("sft", '[{"prompt": "p", "response": "r", "reward": 1.23456}]'),
        ("ppo", '[{"prompt": "p", "reward": 1.23456, "value_estimate": 0.1, "response": "r"}]'),
        ("grpo", '[{"prompt": "p", "group_mean_reward": 1.23456, "samples": [{"response": "q", "reward": 1}, {"response": "r", "reward": 2}, {"response": "s", "reward": 2}]}]'),
        ("dpo", '{"summary": {"n": 1}, "per_prompt": [{"prompt": "p", "response": "r", "reward": 1.23456}]}'),
        ("dpo", '[{"prompt": "p", "response": "r", "reward": 1.23456}]'),
    ],
)
def test_metric_layouts(spark, tmp_path, layout, text):
    (tmp_path / "m.json").write_text(text)
    assert [tuple(r) for r in files.read_metrics(spark, str(tmp_path / "m.json"), layout).collect()] == [(layout, "p", 1.2346, "r")]


def test_instruction_and_preference_loading(spark):
    rows = [(1, " i ", " x\n", " o "), (2, "", "x", "o"), (3, "i", None, "\n"), (4, "i", None, "o")]
    items = t.load_instructions(spark.createDataFrame(rows, "id int, instruction string, input string, output string"), "id")
    assert sorted(map(tuple, items.collect())) == [(1, "i\nx", "o"), (4, "i", "o")]
    prefs = spark.createDataFrame([(1, "a ", "b"), (2, None, "b"), (3, "a", " ")], "id int, chosen string, rejected string")
    assert [tuple(r) for r in t.load_preferences(prefs, "id").collect()] == [(1, "", "a", "b")]


def test_long_conversation_pairs(spark, tmp_path):
    turns = [(1, 3 * i, ["user", "assistant"][i % 2], f"t{i}") for i in range(600)] + [(2, 0, "system", "s"), (2, 5, "user", "u"), (2, 9, "assistant", "a")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["pair_id"]: (r["instruction"], r["input"], r["output"]) for r in t.sft_pairs(spark, str(tmp_path)).collect()}
    assert got == {**{10_000_019 + 3 * i: (f"t{i}", "", f"t{i + 1}") for i in range(0, 600, 2)}, 2 * 10_000_019 + 5: ("u", "s", "a")}


def test_scorer_sets_up_once_per_partition(spark):
    def fn(batches):
        calls = 0
        for pdf in batches:
            calls += 1
            yield pd.DataFrame({"id": pdf["id"], "batch": calls})

    out = scorer.score_with(spark.range(0, 100, 1, 2), fn, "id bigint, batch int")
    assert out.count() == 100 and out.agg(F.max("batch")).first()[0] == 1

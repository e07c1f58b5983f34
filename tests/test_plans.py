"""Scans, hot-key joins and plan shapes."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from corpusflow.operators import policy as po
from corpusflow.plans import layout, scan, skew, storage

ROOT = "/root/testdata/sf0.001"


def _rows(n, seed, wide):
    rng = random.Random(seed)
    keys = rng.sample(range(2**62 if wide else 4 * n), n)
    return [(rng.choice("abb"), k, rng.randint(-50, 50)) for k in keys]


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_prefix_scan_matches_brute_force(spark, wide, inclusive):
    rows = _rows(400, 3, wide) + [("b", 2**21 * i, i) for i in range(1, 40)] + [("b", 2**42 * i + 1, -i) for i in range(1, 40)]
    rows += [("a", -(2**21) * i - 3, i) for i in range(1, 20)] + [("a", -(2**42) * i, i) for i in range(1, 20)] + [("a", -(2**63), 1)]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    aggs = {"s": ("sum", F.col("v")), "lo": ("min", F.col("v")), "last": ("max", F.struct("k", "v")), "c": ("count", F.lit(1))}
    got = {(r["g"], r["k"]): r for r in scan.prefix_scan(df, "k", aggs, ["g"], ["v"], inclusive).collect()}
    assert len(got) == len(rows)
    for g in "ab":
        seen = []
        for _, k, v in sorted((r for r in rows if r[0] == g), key=lambda r: r[1]):
            window = seen + [(k, v)] if inclusive else list(seen)
            row = got[g, k]
            assert row["s"] == sum(x for _, x in window) and row["c"] == len(window)
            assert row["lo"] == (min(x for _, x in window) if window else None)
            assert (tuple(row["last"]) if row["last"] else None) == (window[-1] if window else None)
            seen.append((k, v))


def test_ordinal_by_handles_a_hot_major(spark):
    rows = [(7, i * 2**21) for i in range(60)] + [(3, i) for i in range(5)] + [(9, 1)]
    df = spark.createDataFrame(rows, "m bigint, k bigint")
    got = {(r["m"], r["k"]): r["ord"] for r in scan.ordinal_by(df, "m", "k").collect()}
    assert got == {row: i for i, row in enumerate(sorted(rows))}


@pytest.mark.parametrize("group", [["g"], []])
def test_ranked_equals_sorting(spark, group):
    rng = random.Random(7)
    rows = [(rng.choice("aaaaaab"), k, rng.randint(0, 3)) for k in rng.sample(range(-5000, 5000), 700)]
    df = spark.createDataFrame(rows, "g string, k long, t int").repartition(6)
    got = scan.ranked(df, "k", group, ["t"], "at", "n").collect()
    expected = {}
    for g in {r[0] if group else None for r in rows}:
        held = sorted((k, t) for x, k, t in rows if not group or x == g)
        expected |= {(k, t): (i, len(held)) for i, (k, t) in enumerate(held)}
    assert {(r["k"], r["t"]): (r["at"], r["n"]) for r in got} == expected and len(got) == len(rows)
    assert scan.ranked(df.limit(0), "k", group).collect() == []


# planned scans of queries over the shared views, which are written once
SCANS = {"rw_bt": 8, "src_prefs": 8, "ev_f1": 8, "po_grpo": 12, "po_ppo": 6, "po_dpo": 10, "seq_rollout_pad": 4, "seq_batch": 4}


@pytest.mark.parametrize("name", SCANS)
def test_shared_views_are_planned_once(spark, name):
    plan = contract.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert 0 < len(re.findall(r"FileScan|Scan ExistingRDD", plan)) <= SCANS[name]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_splits_hot_keys_without_changing_rows(spark, how):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 700, 1).otherwise(F.col("id") % 10 + 2).alias("k"))
    stats = rows.filter("k <> 5").groupBy("k").agg(F.count("*").alias("n"))
    plain = rows.join(stats, "k", how).select("id", "k", "n")
    split = skew.attach(rows, stats, ["k"], "n", ["id"], how, hot_rows=50).select("id", "k", "n")
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_group_advantage_is_the_same_with_split_groups(spark, monkeypatch):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("prompt_id"), (F.col("id") % 7).cast("double").alias("reward"))
    plain = sorted((r["id"], round(r["adv"], 9)) for r in po.group_advantage(df, salt_by=("id",)).collect())
    monkeypatch.setattr(skew.attach, "__defaults__", (*skew.attach.__defaults__[:-1], 20))
    split = sorted((r["id"], round(r["adv"], 9)) for r in po.group_advantage(df, salt_by=("id",)).collect())
    assert plain == split


def test_spread_leaves_large_inputs_alone(spark):
    wide = spark.range(0, 100, 1, 64)
    assert layout.spread(wide) is wide
    assert layout.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_shared_dir_is_the_session_setting(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


# these run jobs while they are being built
EAGER = {"src_text", "src_metrics", "snk_metrics", "snk_tokenizer", "rw_fit"}
LAZY = [n for n in contract.queries() if n not in EAGER and not n.startswith(("st_", "tok_bpe_"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_window_over_a_whole_table(spark, name):
    plan = contract.queries()[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for spec in re.findall(r"\bWindow \[.*", plan):
        assert "windowspecdefinition" in spec
        assert not re.search(r"\], \[\](, \[|$)", spec), spec
        assert not re.search(r"windowspecdefinition\((?:specified|[\w#]+ (?:ASC|DESC))", spec), spec


def test_scan_reads_only_what_it_needs(spark):
    plan = contract.queries()["lm_fit"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert reads and all("source" not in r and "lang" not in r for r in reads)

"""History averages: groups that share keys, nulls, clashing names, merging, and one large group."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.operators import attention


def plain(rows):
    """``{(group, key): y}`` row by row; rows are (group, key, q, k, v)."""
    out = {}
    for group in {r[0] for r in rows}:
        held = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1] is not None, r[1] or 0))
        for i, (_, key, q, _, _) in enumerate(held):
            scores = np.array([np.dot(q, r[3]) / np.sqrt(len(q)) for r in held[: i + 1]])
            weights = np.exp(scores - scores.max())
            out[(group, key)] = (weights / weights.sum()) @ np.array([r[4] for r in held[: i + 1]])
    return out


def rows_of(rng, groups, n):
    return [(g, key, *[[rng.gauss(0, 1) for _ in range(4)] for _ in range(3)]) for g in groups for key in range(n)]


@pytest.mark.parametrize("n", [3, 150])
def test_groups_that_share_keys(spark, n):
    rows = rows_of(random.Random(n), ["a", "b", None], n)
    rows += [("b", None, [1.0] * 4, [0.5] * 4, [2.0] * 4)]
    table = spark.createDataFrame(rows, "g string, id long, q array<double>, k array<double>, v array<double>").repartition(4)
    found = attention.causal_attend(table, "g", "id", "q", "k", "v").collect()
    expected = plain(rows)
    assert len(found) == len(rows) and {(r["g"], r["id"]) for r in found} == set(expected)
    for r in found:
        np.testing.assert_allclose(r["y"], expected[(r["g"], r["id"])], rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("name", ["k", "q", "v", "_pos", "block", "own"])
def test_key_may_have_any_name(spark, name):
    rows = rows_of(random.Random(2), [1, None], 5)
    columns = f"g int, {name} long, x array<double>, y2 array<double>, z array<double>"
    table = spark.createDataFrame(rows, columns)
    for limits in ({}, {"block": 2}, {"window": 2, "sink": 1}):
        found = attention.causal_attend(table, "g", name, "x", "y2", "z", **limits)
        assert found.columns == ["g", name, "pos", "y"] and found.count() == len(rows)


def test_merging_partials_is_associative():
    rng = np.random.default_rng(0)
    heads, width = 2, 3
    q, k, v = rng.normal(size=(5, 6)), rng.normal(size=(40, 6)), rng.normal(size=(40, 6))
    parts, rows = [], []
    for at in range(0, 40, 8):
        seen = np.ones((5, 8), bool)
        parts.append(np.hstack([attention._partials(*h, seen) for h in attention._heads(q, k[at : at + 8], v[at : at + 8], heads, heads)]))
        rows.append(np.arange(5))
    once = attention.merge_partials(np.concatenate(rows), np.vstack(parts), heads)[1]
    left = attention.merge_partials(np.concatenate(rows[:2]), np.vstack(parts[:2]), heads)[1]
    right = attention.merge_partials(np.concatenate(rows[2:]), np.vstack(parts[2:]), heads)[1]
    twice = attention.merge_partials(np.tile(np.arange(5), 2), np.vstack([left, right]), heads)[1]
    np.testing.assert_allclose(once, twice, rtol=1e-12)
    assert once.shape == (5, heads * (width + 2))


def test_one_large_group(spark):
    n = 100_000
    table = spark.range(n).select(
        F.lit(1).alias("g"), F.col("id"), F.array(F.lit(0.0)).alias("q"), F.array(F.lit(1.0)).alias("k"), F.array(F.col("id").cast("double")).alias("v")
    )
    # equal scores: the average of 0..i is i / 2
    found = attention.causal_attend(table, "g", "id", "q", "k", "v")
    worst = found.agg(F.max(F.abs(F.col("y")[0] - F.col("id") / 2)).alias("e"), F.count(F.lit(1)).alias("n")).first()
    assert worst["n"] == n and worst["e"] < 1e-6

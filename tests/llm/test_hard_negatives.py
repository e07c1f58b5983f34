"""Hard negatives against all inner products, with tiles of a few rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, tile long, query long, vec string, place int"


def plain(rows, positives=5, negatives=3, low=50, high=95):
    held = []
    for vec_id, vec, label, *_ in rows:
        if vec_id is None or vec is None or label is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        held.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vec]))
    out = []
    for i, (vec_id, label, vec) in enumerate(held):
        if vec_id % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(vec, v)), n, lab) for j, (n, lab, v) in enumerate(held) if j != i]
        near = sorted(s for s in scored if s[2] == label)[:positives]
        far = sorted(s for s in scored if s[2] != label)
        for p, positive, _ in near:
            fits = [s for s in far if low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out += [(vec_id, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fits, 1)]
    return Counter(out)


def vectors(rng, n, dim, labels):
    centres = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(labels)]
    rows = []
    for i in range(n):
        label = rng.randrange(labels)
        rows.append((i, [c + rng.gauss(0, 0.3) for c in centres[label]], label, 1, 2, "v", 3))
    return rows


@pytest.mark.parametrize(("dim", "labels", "tile", "slice_rows"), [(4, 3, 64, 5), (16, 5, 200, 8192), (3, 40, 100, 2)])
def test_mining_equals_all_products(spark, dim, labels, tile, slice_rows):
    rng = random.Random(dim)
    rows = vectors(rng, 900, dim, labels)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0, tile=tile, slice_rows=slice_rows).collect()
    assert Counter(map(tuple, found)) == plain(rows)


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(1)
    rows = vectors(rng, 150, 3, 2)
    same = [0.5, 0.25, -0.125]
    rows += [(i, same, i % 2, 1, 2, "v", 3) for i in range(200, 520)]  # a hot vector
    rows += [(50, same, 1, 1, 2, "v", 3)] * 3 + [(100, [0.0, 0.0, 0.0], 0, 1, 2, "v", 3), (600, [], 1, 1, 2, "v", 3), (650, [1.0], 0, 1, 2, "v", 3)]
    rows += [(700, None, 1, 1, 2, "v", 3), (750, [1.0, None, 1.0], 1, 1, 2, "v", 3), (800, [float("nan"), 1.0, 1.0], 1, 1, 2, "v", 3)]
    rows += [(850, [float("inf"), 1.0, 1.0], 1, 1, 2, "v", 3), (None, same, 1, 1, 2, "v", 3), (900, same, None, 1, 2, "v", 3), (-50, same, -1, 1, 2, "v", 3)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for tile in (64, 8192):
        found = hard_negatives.mine(table, F.col("vec_id") % 50 == 0, tile=tile).collect()
        assert Counter(map(tuple, found)) == plain(rows)


def test_large_components_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-4, 5) * 2**20), float(i)], i % 2, 1, 2, "v", 3) for i in range(120)]
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    limited = [(i, [min(max(v[0], -(2**31 - 1) / 256), (2**31 - 1) / 256), v[1]], *rest) for i, v, *rest in rows]
    assert len(found) == sum(plain(limited).values()) and len(found) > 0


def test_boxes_bound_products_and_leaves_keep_rows():
    rng = np.random.default_rng(4)
    matrix, labels = rng.integers(-300, 300, (1000, 5)), rng.integers(0, 30, 1000)
    order, starts = hard_negatives.pack(labels, matrix)
    assert sorted(order) == list(range(1000)) and np.diff(np.append(starts, 1000)).max() <= hard_negatives.LEAF
    points = matrix[order]
    low, high = np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)
    asked = rng.integers(-300, 300, (40, 5))
    least, most = hard_negatives.intervals(asked, low, high, np.int64)
    products = asked @ points.T
    assert (np.minimum.reduceat(products, starts, axis=1) >= least).all() and (np.maximum.reduceat(products, starts, axis=1) <= most).all()


def test_search_prunes_leaves(monkeypatch):
    rng = np.random.default_rng(6)
    matrix = np.concatenate([rng.normal(c, 8, (640, 4)) for c in ((300, 0, 0, 0), (-300, 0, 0, 0), (0, 300, 0, 0), (0, 0, 300, 0))]).astype(np.int32)
    labels, ids = np.repeat([0, 1, 2, 3], 640), np.arange(2560)
    order, starts = hard_negatives.pack(labels, matrix)
    packed = matrix[order]
    boxes = {"leaf_low": np.minimum.reduceat(packed, starts), "leaf_high": np.maximum.reduceat(packed, starts)}
    held = {"ids": ids[order], "labels": labels[order], "matrix": packed, "starts": starts, **boxes}
    tile = hard_negatives.Tile({"tile": 0, **{k: v.tobytes() for k, v in held.items()}}, 4)
    table = pa.table(
        {
            "query": pa.array([1 << 40]), "id": pa.array([1]), "label": pa.array([9]), "vec": pa.array([np.array([300, 5, 5, 5], np.int32).tobytes()]),
            "lows": [[hard_negatives.LOWEST]], "highs": [[hard_negatives.HIGHEST]], "floors": [[hard_negatives.LOWEST]],
        }
    )
    taken = []
    useful = hard_negatives.useful

    def watched(*args):
        out = useful(*args)
        taken.append(int(out.sum()))
        return out

    monkeypatch.setattr(hard_negatives, "useful", watched)
    _, found, scores = hard_negatives.search(tile, hard_negatives.Queries(table, 4), np.arange(1), 3, False)
    products = matrix.astype(np.int64) @ np.array([300, 5, 5, 5])
    best = sorted(zip(-products, ids))[:3]
    assert [(-s, i) for s, i in zip(scores, found)] == [(a, b) for a, b in best]
    assert taken[0] == len(starts) and min(taken[1:]) < len(starts) / 2


def test_empty_table_and_query(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(none, F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(50 * i, [1.0, float(i)], 1, 1, 2, "v", 3) for i in range(4)], SCHEMA)
    assert hard_negatives.mine(one, F.col("vec_id") % 50 == 0).collect() == []
    one.unionByName(one.withColumn("vec_id", F.col("vec_id") + 1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = queries.op11_hard_negatives(spark, str(tmp_path)).collect()
    assert all(r["anchor_id"] % 50 == 0 and r["rank"] >= 1 for r in rows)

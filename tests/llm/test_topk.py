from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodgepole.llm import topk
from lodgepole.llm.topk import KdTree, top_k


def brute(rows, k, every):
    fine = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, qv in fine:
        if q % every == 0:
            got = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in fine if i != q and len(v) == len(qv))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(got, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, query string")


@pytest.mark.parametrize("shard_rows,query_rows,leaf", [(1000, 100, 16), (40, 7, 5), (13, 3, 2)])
def test_equals_brute_force(spark, monkeypatch, shard_rows, query_rows, leaf):
    monkeypatch.setattr(topk, "LEAF", leaf)
    rng = random.Random(leaf)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(200)]
    hot = rows[17][1]
    rows = [(i, hot if i % 3 == 0 else v) for i, v in rows]
    rows += [(500, None), (501, [None] * 6), (502, [float("nan")] * 6), (503, [float("inf")] + [0.0] * 5), (None, hot), (10, hot)]
    rng.shuffle(rows)
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows, query_rows=query_rows)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 10)


def test_few_rows_and_empty(spark):
    assert sorted(map(tuple, top_k(frame(spark, [(0, [1.0, 0.5]), (3, [0.5, 0.25])]), F.col("vec_id") % 50 == 0, 5).collect())) == [(0, 1, 3, 128 * 256 + 64 * 128)]
    assert top_k(frame(spark, []), F.col("vec_id") % 50 == 0, 5).collect() == []


def test_tree_prunes():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 200, (16, 8))
    points = np.floor(centres[rng.integers(0, 16, 2000)] + rng.normal(0, 5, (2000, 8)))
    tree = KdTree.build(points, np.arange(2000), 32)
    assert (tree.lo[0] <= points).all() and (points <= tree.hi[0]).all()
    q = points[11]
    best = tree.search(q, 11, 5)
    order = sorted((-(points @ q)[i], i) for i in range(2000) if i != 11)[:5]
    assert best == [(int(-s), i) for s, i in order]
    assert tree.search(q, 11, 5, (best[-1][0], best[-1][1])) == best
    assert tree.search(q, 11, 5, (best[0][0] + 1, 0)) == []


def exact_brute(rows, k, every, lo=-(1 << 63), hi=(1 << 63) - 1):
    """By Python's integers, from doubles."""
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if all(math.isfinite(256 * x) for x in v)]
    out = []
    for q, qv in fine:
        if q % every == 0:
            got = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in fine if i != q and len(v) == len(qv))[:k]
            out += [(q, n, i, min(max(-s, lo), hi)) for n, (s, i) in enumerate(got, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1e3, 1e6, 1e9, 1e12, 1e200, 1e300])
def test_large_components_are_exact(spark, size):
    rng = random.Random(size)
    rows = [(i, [rng.choice([-1, 1]) * size * rng.random() for _ in range(3)]) for i in range(60)]
    rows += [(100 + i, [size, 1.0 + i % 3, -0.5]) for i in range(20)]  # apart in the last digits only
    rows += [(200, [1.7e308, 0.0, 0.0]), (201, [-0.001, 0.002, 0.0]), (210, [0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = top_k(frame, F.col("vec_id") % 10 == 0, 5, shard_rows=16, query_rows=4)
    assert sorted(map(tuple, got.collect())) == exact_brute(rows, 5, 10)


def test_scores_past_a_long_keep_their_order():
    scores = [0, 5, -5, (1 << 63) - 1, 1 << 63, 10**30, 10**31, 10**300, -(1 << 63), -(1 << 63) - 1, -(10**30), -(10**31)]
    key = lambda s: (min(max(s, -(1 << 63)), (1 << 63) - 1), topk._beyond(s) or "")
    assert sorted(scores, key=key) == sorted(scores)


def test_vectors_of_several_lengths(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([2, 3, 3, 3, 5]))]) for i in range(150)] + [(900, []), (910, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = top_k(frame, F.col("vec_id") % 10 == 0, 5, shard_rows=20, query_rows=6)
    assert sorted(map(tuple, got.collect())) == exact_brute([r for r in rows if r[1]], 5, 10)


def test_coarse_cells_hold_their_share():
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 1, (500, 4)) for c in (-50, 0, 50)] + [np.zeros((700, 4))])
    coarse = topk.Coarse(points, 16)
    cells = coarse.of(points)
    assert cells.min() == 0 and cells.max() == coarse.cells - 1 <= 15
    assert np.bincount(cells).max() < 1300 and len(set(cells[:500]) & set(cells[1000:1500])) == 0
    assert topk.Coarse(np.zeros((9, 2)), 8).of(np.ones((3, 2))).tolist() == [0, 0, 0]


def test_root_boxes_keep_queries_from_shards(spark):
    rows = [(i, [float(i // 64), 1.0]) for i in range(1024)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sent = []

    shards = topk.shards_of(topk.integer_vectors(frame, "vec_id", "embedding"), 64)
    assert shards.count() >= 16
    tree = KdTree.loads(shards.first().tree, 2)
    assert (tree.points.min(axis=0) == tree.lo[0]).all() and len(tree.ids) <= 128
    q = pd.DataFrame([{"query": 0, "dim": 2, "ids": np.array([5], np.int64).tobytes(), "points": np.array([[256.0, 256.0]]).tobytes(), "home": 0,
                       "limit_row": [0], "limit_score": [256 * 256 * 14], "limit_id": [7],
                       "shards": [r.shard for r in shards.collect()], "boxes": [r.box for r in shards.collect()]}])
    for got in topk._send(iter([q])):
        sent += got["shard"].tolist()
    assert 0 < len(sent) <= 6

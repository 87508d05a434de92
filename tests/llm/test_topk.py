import random

import numpy as np
import pytest

from urbanlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, id string, tree string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows, queries, k=5):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    grid = [(i, [int(np.floor(256.0 * np.float32(x).astype(float))) for x in v]) for i, v in rows if i is not None and usable(v)]
    asked = {(i, tuple(int(np.floor(256.0 * np.float32(x).astype(float))) for x in v)) for i, v in queries if i is not None and usable(v)}
    out = []
    for qid, q in asked:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in grid if i != qid)[:k]
        out += [(qid, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("shard", "block"), [(topk.SHARD_ROWS, topk.BLOCK_ROWS), (70, 3)])
def test_equals_brute_force(spark, shard, block):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8) for i in range(30)]  # ties
    rows += [(7, rows[7][1]), (7, rows[9][1]), (900, None), (950, [1.0, None]), (None, [0.1] * 8), (2000, [float("nan")] * 8)]
    rows += [(2050, [float("inf")] * 8), (2100, []), (2150, [0.3, 0.4]), (2200, [0.0] * 8), (2200, [9.0] * 9)]
    asked = [r for r in rows if r[0] is None or r[0] % 50 == 0 or r[0] == 7]
    got = topk.top_k(table(spark, rows).repartition(3), table(spark, asked), shard_rows=shard, block_rows=block)
    assert rows_of(got) == brute(rows, asked)


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1.0]), (50, [2.0]), (3, [-1.0])]
    assert rows_of(topk.top_k(table(spark, rows), table(spark, rows[:2]))) == brute(rows, rows[:2])
    assert topk.top_k(table(spark, []), table(spark, [])).collect() == []
    assert topk.top_k(table(spark, []), table(spark, rows)).collect() == []
    assert topk.top_k(table(spark, rows), table(spark, [])).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(i, [3e5 + i, -2e5, 1.5e5 * i]) for i in range(60)]
    assert rows_of(topk.top_k(table(spark, rows), table(spark, rows[:3]))) == brute(rows, rows[:3])


def test_tree_prunes():
    rng = np.random.RandomState(1)
    centres = rng.normal(0, 200, (20, 8))
    vectors = np.concatenate([c + rng.normal(0, 2, (200, 8)) for c in centres]).astype(np.int64)
    tree, seen = topk.ball_tree(vectors, np.arange(len(vectors))), []
    dot = topk._dot
    topk._dot = lambda a, b: seen.append(len(b)) or dot(a, b)
    try:
        scores, _ = topk.search(tree, vectors[:1], np.array([-1]), np.array([np.iinfo(np.int64).min]), 5)
    finally:
        topk._dot = dot
    assert sorted(scores[0], reverse=True) == sorted((vectors @ vectors[0]).tolist(), reverse=True)[:5]
    assert sum(seen) < len(vectors) / 2

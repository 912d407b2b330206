import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.topk import DualSearch, cover_tree, scaled, top_k


def _plain(rows, k):
    out = {}
    for i, v in rows:
        if i is not None and v is not None and i % 5 == 0:
            scores = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if w is not None and j is not None and j != i and len(w) == len(v)]
            out[i] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_every_product(spark, seed):
    random.seed(seed)
    clusters = [[random.randint(-80, 80) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + random.randint(-9, 9) for c in random.choice(clusters)]) for i in range(400)]
    rows += [(1000 + i, [3] * 8) for i in range(60)] + [(2000, None), (None, [1] * 8), (2005, [1, 2]), (2006, [2, 2]), (2010, [0] * 8)]
    if seed == 3:
        rows += [(3000, [(1 << 28) + 1] * 8), (3001, [-(1 << 28)] * 8), (3005, [1 << 28] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, vector array<long>, rank int").repartition(3)
    found = {}
    for r in top_k(df, F.col("vec_id") % 5 == 0, 4, block_rows=[8192, 64][seed % 2]).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = {q: [(n + 1, j, s) for n, (j, s) in enumerate(best)] for q, best in _plain(rows, 4).items() if best}
    assert found == want


def test_nodes_cover_their_members():
    points = np.random.default_rng(0).integers(-50, 50, (500, 6)).astype(float)
    todo = [cover_tree(points)]
    seen = 0
    while todo:
        node = todo.pop()
        away = np.linalg.norm(points[node.members] - points[node.center], axis=1)
        assert away.max(initial=0) <= node.radius + 1e-6 and node.center in node.members
        if node.children:
            assert sorted(m for c in node.children for m in c.members) == sorted(node.members)
            assert all(c.radius <= node.radius / 2 + 1e-6 for c in node.children)
        else:
            seen += len(node.members)
        todo.extend(node.children)
    assert seen == 500


def test_far_nodes_are_left_out(monkeypatch):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-3, 3, (300, 4)) + c for c in ([1000, 0, 0, 0], [-1000, 0, 0, 0], [0, 1000, 0, 0])]).astype(float)
    scored = []
    score = DualSearch._score
    monkeypatch.setattr(DualSearch, "_score", lambda self, q, p: (scored.append(len(q) * len(p)), score(self, q, p)))
    DualSearch(points[:50], list(range(50)), points, [[i] for i in range(900)], 3)
    assert sum(scored) < 0.7 * 50 * 900


def test_points_that_do_not_gather_are_scored_together():
    points = np.random.default_rng(2).integers(-99, 99, (2000, 40)).astype(float)
    tree = cover_tree(points)
    assert len(tree.children) <= 33 and sum(len(c.members) for c in tree.children) == 2000
    best = DualSearch(points[:80], list(range(80)), points, [[i] for i in range(2000)], 5).best
    scores = points[:80] @ points.T
    scores[np.arange(80), np.arange(80)] = -np.inf
    assert [sorted(s for s, _ in heap) for heap in best] == np.sort(scores, axis=1)[:, -5:].tolist()


def test_ties_go_to_the_smallest_ids():
    points = np.array([[1.0, 0]] * 1 + [[1.0, i] for i in range(1, 400)])
    best = DualSearch(np.array([[1.0, 0]]), [7], points, [[1000 - i] for i in range(400)], 3).best
    assert sorted(best[0]) == [(1.0, -603), (1.0, -602), (1.0, -601)]


def test_cells_that_cannot_win_are_left_out(spark):
    """Clusters in different directions: a query goes to its own and to few others."""
    rng = np.random.default_rng(4)
    centers = np.eye(8) * 500
    rows = [(i, [int(x) for x in centers[i % 8] + rng.integers(-20, 20, 8)]) for i in range(800)]
    pivots = centers.copy()
    queries = np.array([v for _, v in rows[:40]], float)
    cell, away = topk._nearest(np.array([v for _, v in rows], float), pivots)
    radius = np.array([away[cell == c].max() for c in range(8)])
    floor = np.sort(queries @ np.array([v for _, v in rows], float).T, axis=1)[:, -5]
    of, to = topk.reached(queries, cell[:40], floor, pivots, radius)
    assert len(of) < 0.2 * 40 * 7
    every = queries @ np.array([v for _, v in rows], float).T
    for q in range(40):
        cells = {int(c) for c in cell[np.argsort(-every[q])[:5]]} - {int(cell[q])}
        assert cells <= set(to[of == q].tolist())
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>").repartition(3)
    found = top_k(df, F.col("vec_id") % 5 == 0, 4, block_rows=100).collect()
    want = {(q, n + 1, j, s) for q, best in _plain(rows, 4).items() for n, (j, s) in enumerate(best)}
    assert {tuple(r) for r in found} == want


def test_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.001]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, None), (6, []), (7, [-inf, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = dict(df.select("vec_id", scaled(F.col("embedding"))).collect())
    assert found == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: [], 7: None}
    vectors = df.select("vec_id", scaled(F.col("embedding")).alias("vector"))
    assert top_k(vectors, F.lit(True)).collect() == [] and top_k(vectors.limit(0), F.lit(True)).collect() == []

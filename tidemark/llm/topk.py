"""Exact top-k inner products by dual-tree search over cover trees.

Queries and candidates are indexed together: pivots, a bounded sample, are the upper level of one tree, and every row goes to the cell of its nearest
pivot. A query first searches its own cell; then it is sent only to those cells whose bound reaches its k-th score so far. Cells are dealt to
blocks, and within each pair of a query block and a candidate block both sides are indexed by a cover tree. A node covers its points by a ball
around one of them; its children halve the radius. For two nodes, centres q and p and radii s and r, no inner product
exceeds <q,p> + r|q| + s|p| + rs. If that is below the worst k-th score that any query of the node has so
far, the pair is left out with all below it. Points that do not gather around centres are scored together. Equal vectors are one point with its k+1 smallest ids, as no query
needs more of them. The best k of each block are merged per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import frugal, stage

_LEAF = 256
#: A node whose first so many children cover fewer than twice as many points is a leaf: its points do not gather.
_SPARSE = 32
#: Pivots at most.
_PIVOTS = 256
#: Integers up to here are exact as floating-point numbers.
_EXACT = 1 << 53
_MOST = (1 << 63) - 1
#: Scores computed at once.
_AT_ONCE = 1 << 21


@dataclass
class Node:
    center: int
    radius: float
    members: np.ndarray
    children: list["Node"] = field(default_factory=list)
    centers: np.ndarray | None = None
    radii: np.ndarray | None = None
    norms: np.ndarray | None = None
    whole: bool = False


def cover_tree(points: np.ndarray) -> Node:
    """A tree whose nodes cover their members within ``radius`` of the member ``center``."""
    lengths = np.einsum("ij,ij->i", points, points)

    def distances(to: int, rows: np.ndarray) -> np.ndarray:
        squared = lengths[rows] + lengths[to] - 2 * (points[rows] @ points[to])
        return np.sqrt(np.maximum(squared, 0)) * (1 + 1e-9)

    everything = np.arange(len(points))
    root = Node(0, float(distances(0, everything).max()), everything)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.members) <= _LEAF or node.radius == 0:
            continue
        rest = np.concatenate([[node.center], node.members[node.members != node.center]])
        while len(rest):
            if len(node.children) >= _SPARSE and len(node.members) - len(rest) < 2 * len(node.children):
                away = distances(rest[0], rest)
                node.children.append(Node(int(rest[0]), float(away.max()), rest, whole=True))
                break
            away = distances(rest[0], rest)
            near = away <= node.radius / 2
            near[0] = True
            node.children.append(Node(int(rest[0]), float(away[near][1:].max(initial=0.0)), rest[near]))
            rest = rest[~near]
        node.centers = points[[c.center for c in node.children]]
        node.radii = np.array([c.radius for c in node.children])
        node.norms = np.sqrt(lengths[[c.center for c in node.children]]) * (1 + 1e-9)
        todo.extend(c for c in node.children if len(c.members) > 1 and not c.whole)
    return root


class DualSearch:
    """The best ``k`` candidates of each query within one pair of blocks.

    ``ids`` holds for each candidate point the smallest ids of its copies; scores below a query's ``floor`` are not wanted.
    """

    def __init__(self, queries: np.ndarray, query_ids: list, points: np.ndarray, ids: list[list], k: int, floor: np.ndarray | None = None):
        self.query_ids, self.ids, self.k = query_ids, ids, k
        self.exact = queries, points
        self.queries, self.points = queries.astype(float), points.astype(float)
        self.first = np.array([i[0] for i in ids])
        self.best: list[list] = [[] for _ in query_ids]  # heaps of (score, -id), the worst first
        self.worst = np.full(len(query_ids), -np.inf, queries.dtype) if floor is None else floor.astype(queries.dtype)
        if len(query_ids) and len(points):
            self._visit(cover_tree(self.queries), cover_tree(self.points))

    def _visit(self, q: Node, p: Node) -> None:
        todo = [(q, p, np.inf)]
        while todo:
            q, p, bound = todo.pop()
            if bound < self.worst[q.members].min():
                continue
            if not q.children and not p.children:
                self._score(q.members, p.members)
                continue
            of_q = q.children and (not p.children or q.radius >= p.radius)
            one, many = (p, q) if of_q else (q, p)
            base = self.points if of_q else self.queries
            norm = float(np.linalg.norm(base[one.center])) * (1 + 1e-9)
            bounds = many.centers @ base[one.center] + many.radii * norm + one.radius * many.norms + many.radii * one.radius
            bounds += 1e-3 + 1e-9 * np.abs(bounds)
            if of_q:
                todo.extend((c, p, b) for c, b in zip(q.children, bounds))
                continue
            order = np.argsort(bounds)  # the most promising last, so that it is taken first
            order = order[bounds[order] >= self.worst[q.members].min()]
            single = [i for i in order if len(p.children[i].members) == 1]
            todo.extend((q, p.children[i], bounds[i]) for i in order if len(p.children[i].members) > 1)
            if single and q.children:
                lone = Node(p.children[single[-1]].center, p.radius, np.array([p.children[i].center for i in single[::-1]]))
                todo.extend((c, lone, np.inf) for c in q.children)
            elif single:
                self._score(q.members, np.array([p.children[i].center for i in single[::-1]]))

    def _score(self, queries: np.ndarray, points: np.ndarray) -> None:
        step = max(1, _AT_ONCE // max(1, len(points)))
        for at in range(0, len(queries), step):
            some = queries[at:at + step]
            scores = self.exact[0][some] @ self.exact[1][points].T
            wanted = self.k + 1  # one of them may be the query itself
            if len(points) > wanted:
                limit = np.maximum(np.partition(scores, len(points) - wanted, axis=1)[:, len(points) - wanted], self.worst[some])
            else:
                limit = self.worst[some]
            rows, columns = np.nonzero(scores >= limit[:, None])
            values, first = scores[rows, columns], self.first[points[columns]]
            order = np.lexsort((first, -values, rows))  # the best first, of equal ones the smallest id
            rank = np.arange(len(order)) - np.searchsorted(rows[order], rows[order])
            for o in order[rank < wanted].tolist():
                query, score = int(some[rows[o]]), values[o]
                heap = self.best[query]
                if len(heap) == self.k and score < heap[0][0]:
                    continue  # raised meanwhile
                for id_ in self.ids[points[columns[o]]]:
                    if id_ == self.query_ids[query]:
                        continue
                    entry = (score, -id_)
                    if len(heap) < self.k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break
                if len(heap) == self.k:
                    self.worst[query] = max(self.worst[query], heap[0][0])


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of whole numbers, as floating point where every product is exact in it, else as Python's numbers."""
    whole = np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)
    largest = max(abs(int(whole.max(initial=0))), abs(int(whole.min(initial=0))))
    return whole.astype(float) if largest * largest * whole.shape[1] < _EXACT else whole.astype(object)


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of each component, x as double; NULL if a component is missing or not finite."""
    wide = vector.cast("array<double>")
    usable = vector.isNotNull() & F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * factor)))


def _nearest(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each vector, and a bound on how far it is."""
    squared = np.einsum("ij,ij->i", vectors, vectors)[:, None] + np.einsum("ij,ij->i", pivots, pivots) - 2 * (vectors @ pivots.T)
    cell = squared.argmin(axis=1)
    away = np.linalg.norm(vectors - pivots[cell], axis=1)
    return cell, away * (1 + 1e-9)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector", block_rows: int = 8192) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` candidates of highest inner product for each query.

    ``vectors`` has whole-number vectors; candidates are all rows but those with the query's id, ties go to the
    smaller id, and a query with fewer candidates has fewer rows. Rows without an id or a vector take no
    part; vectors of different lengths are not compared. Of queries that repeat an id with different vectors one answer is given, the best over
    them all. Ids are integers; scores beyond 64 bits are shown as the largest.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).withColumn("size", F.size("v"))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if("q")).first()
    blocks, query_blocks = max(-(-n // block_rows), 1), max(-(-n_queries // block_rows), 1)
    chosen = rows.select("size", "v").orderBy(F.xxhash64("v", "id")).limit(min(_PIVOTS, 2 * blocks)).collect()  # a fixed number at any size
    by_size: dict[int, list] = {}
    for size, v in chosen:
        by_size.setdefault(size, []).append(v)
    pivots = {size: np.unique(np.array(some, float).reshape(len(some), -1), axis=0) for size, some in by_size.items()}

    @frugal
    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["cell"], frame["away"] = np.int32(-1), 0.0
            for size, some in frame.groupby("size").groups.items():
                if size in pivots:  # other lengths, of which the sample has none, are one cell each
                    cell, away = _nearest(np.array(frame.loc[some, "v"].tolist(), float).reshape(len(some), -1), pivots[size])
                    frame.loc[some, "cell"], frame.loc[some, "away"] = cell.astype(np.int32), away
            yield frame

    dealt = stage(rows.mapInPandas(deal, f"id {kind}, v array<bigint>, q boolean, size int, cell int, away double"), "top-cells")
    cells = dealt.filter("cell >= 0").groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).collect()  # not more than pivots
    radius = {size: np.full(len(p), -np.inf) for size, p in pivots.items()}
    for r in cells:
        radius[r["size"]][r["cell"]] = r["radius"]
    parts = F.lit(blocks)
    for r in cells:
        parts = F.when((F.col("size") == r["size"]) & (F.col("cell") == r["cell"]), -(-r["n"] // block_rows)).otherwise(parts)
    place = lambda count: F.pmod(F.xxhash64("id"), count).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    key = ["size", "cell", "block", "query_block"]
    candidates = dealt.select("id", "v", "size", "cell", place(parts).alias("block"), each(F.lit(query_blocks)).alias("query_block"))
    queries = dealt.filter("q").withColumn("floor", F.lit(None).cast("double"))

    def search(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(some) and len(others):
            others = others.sort_values("id")
            copies: dict[bytes, list] = {}
            at = []
            for row, (id_, v) in enumerate(zip(others["id"].tolist(), others["v"])):
                ids = copies.setdefault(np.asarray(v, np.int64).tobytes(), [])
                if not ids:
                    at.append(row)
                if len(ids) <= k and (not ids or ids[-1] != id_):
                    ids.append(id_)
            ids, floor = some["id"].tolist(), some["floor"].fillna(-np.inf).to_numpy(float)
            mine, theirs = _matrix(some["v"]), _matrix(others["v"].iloc[at])
            if mine.dtype != theirs.dtype:
                mine, theirs = mine.astype(object), theirs.astype(object)
            answer = DualSearch(mine, ids, theirs, list(copies.values()), k, floor)
            found = [(ids[i], -minus, max(-_MOST, min(_MOST, int(score)))) for i, heap in enumerate(answer.best) for score, minus in heap]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]) if found else pd.DataFrame()

    def searched(asked: DataFrame) -> DataFrame:
        asked = asked.select("id", "v", "floor", "size", "cell", each(parts).alias("block"), place(F.lit(query_blocks)).alias("query_block"))
        return asked.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInPandas(search, f"query_id {kind}, vec_id {kind}, score bigint")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows of each block
    ranked = lambda found: found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    near = stage(ranked(searched(queries)).select("query_id", "vec_id", "score", "rank"), "top-near")
    worst = near.filter(F.col("rank") == k).select(F.col("query_id").alias("worst_of"), F.col("score").cast("double").alias("worst"))
    known = queries.drop("floor").join(worst, F.col("id") == F.col("worst_of"), "left").withColumn("floor", F.col("worst") - 1)

    @frugal
    def onward(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for size, some in frame.groupby("size"):
                if size in pivots:
                    of, to = reached(np.array(some["v"].tolist(), float).reshape(len(some), -1), some["cell"].to_numpy(), some["floor"].fillna(-np.inf).to_numpy(float), pivots[size], radius[size])
                    sent = some.iloc[of].copy()
                    sent["cell"] = to.astype(np.int32)
                    yield sent

    further = known.select("id", "v", "floor", "size", "cell").mapInPandas(onward, f"id {kind}, v array<bigint>, floor double, size int, cell int")
    found = near.drop("rank").union(searched(further)) if cells else near.drop("rank")
    return ranked(found).select("query_id", "rank", "vec_id", "score")


def reached(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, pivots: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and the cells, other than their own, in which a score of ``floor`` or more is possible."""
    lengths = np.linalg.norm(queries, axis=1)[:, None]
    bound = queries @ pivots.T + lengths * np.where(np.isfinite(radius), radius, 0)
    bound += 1e-3 + 1e-9 * (np.abs(bound) + lengths * np.linalg.norm(pivots, axis=1))
    may = (bound >= floor[:, None]) & np.isfinite(radius)
    may[np.arange(len(own)), own] = False
    return np.nonzero(may)

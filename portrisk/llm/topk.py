"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are both indexed. A pair of nodes is passed over when no point of the data
node can reach the worst k-th score among the queries of the query node: the inner product of
points within radii r and s of the centres c and d is at most c.d + |c|s + |d|r + rs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portrisk.llm import textkit

LEAF = 48
BLOCK_ROWS = 4096
QUERY_BLOCK = 16_384
HITS = "query_id long, vec_id long, score long"


class Node:
    __slots__ = ("center", "norm", "radius", "rows", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, center: int) -> None:
        self.center = points[center]
        self.norm = float(np.sqrt(self.center @ self.center))
        self.radius = float(np.sqrt(_squares(points[rows], self.center).max()))
        self.rows, self.children = rows, []


def _squares(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    gap = points - center
    return np.einsum("ij,ij->i", gap, gap)


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, center: int | None = None) -> Node:
    """Children of a node are a net of its points: more than half its radius apart, and covering it.

    A node of at most LEAF points, or of equal points, is a leaf. A net that hardly gathers
    points (they are all far from each other) ends in one leaf too.
    """
    rows = np.arange(len(points)) if rows is None else rows
    node = Node(points, rows, int(rows[0]) if center is None else center)
    if len(rows) <= LEAF or node.radius == 0:
        return node
    scale = (node.radius / 2) ** 2
    left, groups = rows, []
    while len(left):
        pick = int(left[0])
        near = _squares(points[left], points[pick]) <= scale
        groups.append((pick, left[near]))
        left = left[~near]
        if len(groups) > len(rows) // 4:
            return node
    lonely = [g[1] for g in groups if len(g[1]) < 4]
    for pick, group in groups:
        if len(group) >= 4:
            node.children.append(cover_tree(points, group, pick))
    if lonely:
        rest = np.concatenate(lonely)
        node.children += [Node(points, part, int(part[0])) for part in np.array_split(rest, -(-len(rest) // LEAF))]
    return node


class Search:
    """The k best of each query so far, better scores first and smaller ids at ties."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = query_ids, queries, k
        self.tree = cover_tree(queries)
        self.score = np.full((len(query_ids), k), -np.inf)
        self.found = np.full((len(query_ids), k), np.iinfo(np.int64).max)

    def offer(self, ids: np.ndarray, points: np.ndarray) -> None:
        root = cover_tree(points)
        stack = [(self.tree, root)]
        while stack:
            q, d = stack.pop()
            bound = q.center @ d.center + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
            if bound * (1 + 1e-9) + 1e-6 < self.score[q.rows, -1].min():
                continue
            if not q.children and not d.children:
                self._score(q.rows, ids[d.rows], points[d.rows])
            elif q.children and (not d.children or q.radius > d.radius):
                stack += [(c, d) for c in q.children]
            else:  # the most promising node is popped first
                stack += [(q, c) for c in sorted(d.children, key=lambda c: q.center @ c.center + q.norm * c.radius)]

    def _score(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            score = self.queries[part] @ points.T
            score[self.ids[part][:, None] == ids[None, :]] = -np.inf
            worth = (score >= self.score[part, -1][:, None]).any(axis=1)
            part, score = part[worth], score[worth]
            if not len(part):
                continue
            score = np.concatenate([self.score[part], score], axis=1)
            found = np.concatenate([self.found[part], np.broadcast_to(ids, (len(part), len(ids)))], axis=1)
            order = np.lexsort((found, -score), axis=1)[:, : self.k]
            self.score[part] = np.take_along_axis(score, order, axis=1)
            self.found[part] = np.take_along_axis(found, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        real = np.isfinite(self.score)
        query = np.broadcast_to(self.ids[:, None], real.shape)
        return query[real], self.found[real], self.score[real].astype(np.int64)


def usable(vector: Column) -> Column:
    """Not null, and no component null, NaN or infinite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def integers(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k rows of `vectors` with the largest integer inner product with each query.

    Both have vec_id and embedding, an array that usable() accepts and integers() has made
    whole. Ties go to the smaller vec_id; rows with the query's own id are no candidates; only
    vectors of equal length are compared, empty ones take no part. Queries are taken in blocks of `query_block`, each
    sent to all tasks (64 components: 8 MB), while the data stay where they are read; a
    task indexes its rows in blocks and passes on k rows a query. Scores are exact below 2^53.

    Repeated rows are candidates each on their own; no queries or no vectors give no rows; a
    query with fewer than k candidates returns all. Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    some = F.expr("vec_id is not null and size(embedding) > 0")
    data = vectors.where(some).select("vec_id", "embedding").withColumn("width", F.size("embedding"))
    asked = queries.where(some).select("vec_id", "embedding").withColumn("width", F.size("embedding")).distinct()
    parts = []
    for width, n in [(r["width"], r["count"]) for r in asked.groupBy("width").count().orderBy("width").collect()]:
        blocks = -(-n // query_block)
        own = asked.where(F.col("width") == width).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(2 * blocks)) if blocks > 1 else F.lit(0))
        for block in range(2 * blocks if blocks > 1 else 1):
            rows = own.where(F.col("block") == block).toArrow()
            if not rows.num_rows:
                continue
            ids = rows.column("vec_id").to_numpy()
            matrix = np.array(rows.column("embedding").to_pylist(), np.float64).reshape(len(ids), width)
            sent = spark.sparkContext.broadcast((ids, matrix))
            parts.append(data.where(F.col("width") == width).select("vec_id", "embedding").mapInArrow(_searcher(sent, k, width), HITS))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = reduce(DataFrame.unionByName, parts).withColumn("rank", F.row_number().over(best))
    return hits.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(sent, k: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        search = Search(ids, matrix, k)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                search.offer(part.column(0).to_numpy(zero_copy_only=False), _matrix(part.column(1), width))
        yield textkit.batch(HITS, *search.rows())

    return run

"""Nearest neighbours by largest inner product, with vantage-point trees per shard.

Rows are dealt to shards of some ``SHARD_ROWS`` rows by a hash of their key, queries
to blocks of ``QUERY_ROWS``. A task holds one shard and one block, builds the
shard's tree and searches it with all the block's queries at once; the best of all
shards are then ranked for each query.

A tree measures distances, so each vector gets one more component that brings all
of a shard to the same length, and queries a zero: then the nearest has the largest inner
product. A node's vantage point splits its rows at their median distance from it; each
half knows its least and greatest distance. By the triangle inequality a half whose
bounds lie farther from the query than the k-th best so far holds nothing better.
``factor`` multiplies that lower bound: at one the search is exact, above one it prunes
more and may miss some. The nearer half is searched first.

Equal vectors of a shard are one point of its tree that remembers its smallest keys, as
many as can be asked for, so that copies neither deepen the tree nor crowd out others.

Defined results: vectors that are NULL, zero or hold NULL or non-finite components take
no part, neither as queries nor as answers; vectors are compared with those of their own
number of components; of equal scores the smaller key is nearer; rows alike in key and
vector are one, and a row is no answer to its own key; an empty table gives an empty
table. Only the key and vector columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .vectors import cleaned, matrix

SHARD_ROWS = 8192
QUERY_ROWS = 4096
# Points of a tree that are compared directly.
LEAF = 256
# Points kept beyond those asked for, so that rounding cannot decide who is among them.
_SPARE = 8


@dataclass
class _Node:
    rows: np.ndarray
    vantage: int = -1
    near: _Node | None = None
    far: _Node | None = None
    least: float = 0.0  # of the distances of these rows from the parent's vantage point
    greatest: float = 0.0


class VantageTree:
    """Exact or relaxed search for the largest inner products among some points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        square = (points * points).sum(axis=1)
        self.square = float(square.max())
        self.lift = np.sqrt(np.maximum(self.square - square, 0.0))
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> _Node:
        node = _Node(rows)
        if len(rows) <= LEAF:
            return node
        # The row farthest from an arbitrary one spreads the distances well.
        start = self._between(rows[0], rows)
        node.vantage = int(rows[start.argmax()])
        distance = self._between(node.vantage, rows)
        if distance.max() == 0.0:
            return node
        order = np.argsort(distance, kind="stable")
        half = len(rows) // 2
        for name, part in (("near", order[:half]), ("far", order[half:])):
            child = self._build(rows[part])
            child.least, child.greatest = float(distance[part[0]]), float(distance[part[-1]])
            setattr(node, name, child)
        return node

    def _between(self, one: int, rows: np.ndarray) -> np.ndarray:
        change = self.points[rows] - self.points[one]
        lift = self.lift[rows] - self.lift[one]
        return np.sqrt((change * change).sum(axis=1) + lift * lift)

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0):
        """Row numbers (-1: none) of the k points of largest inner product of each query."""
        best = np.full((len(queries), k), -np.inf)
        found = np.full((len(queries), k), -1)
        length = (queries * queries).sum(axis=1) + self.square
        slack = 1e-6 * np.sqrt(length)

        def leaf(node: _Node, active: np.ndarray) -> None:
            scores = queries[active] @ self.points[node.rows].T
            scores = np.concatenate([best[active], scores], axis=1)
            labels = np.broadcast_to(node.rows, (len(active), len(node.rows)))
            labels = np.concatenate([found[active], labels], axis=1)
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            best[active] = np.take_along_axis(scores, top, axis=1)
            found[active] = np.take_along_axis(labels, top, axis=1)

        def visit(node: _Node, active: np.ndarray) -> None:
            if node.near is None:
                return leaf(node, active)
            distance = np.sqrt(
                np.maximum(length[active] - 2 * (queries[active] @ self.points[node.vantage]), 0.0)
            )
            middle = (node.near.greatest + node.far.least) / 2
            inside = distance < middle
            for half in (node.near, node.far):
                own = inside if half is node.near else ~inside
                descend(half, active[own], distance[own])
            for half in (node.near, node.far):
                own = ~inside if half is node.near else inside
                descend(half, active[own], distance[own])

        def descend(half: _Node, active: np.ndarray, distance: np.ndarray) -> None:
            bound = np.maximum(half.least - distance, distance - half.greatest)
            reach = np.sqrt(np.maximum(length[active] - 2 * best[active].min(axis=1), 0.0))
            open_ = factor * bound <= reach + slack[active]
            if open_.any():
                visit(half, active[open_])

        if len(queries):
            visit(self.root, np.arange(len(queries)))
        return found


def _searched(
    rows: pa.Table, asked: pa.Table, k: int, factor: float
) -> tuple[list[int], list[int], list[float]]:
    """(query, row, score) of the k best rows of a shard for each query of a block."""
    keys = rows["vec_id"].to_numpy()
    points = matrix(rows["vec"])
    order = np.argsort(keys, kind="stable")
    keys, points = keys[order], points[order]
    _, first, same = np.unique(
        np.ascontiguousarray(points).view(f"V{points.shape[1] * 8}").ravel(),
        return_index=True,
        return_inverse=True,
    )
    # Keys of equal points, the smallest first; one more than asked for, as one may be the query.
    grouped = np.argsort(same, kind="stable")
    begins = np.searchsorted(same[grouped], np.arange(len(first) + 1))
    distinct = points[first]
    queries = matrix(asked["vec"])
    found = VantageTree(distinct).search(queries, min(k + 1 + _SPARE, len(distinct)), factor)
    out: tuple[list, list, list] = ([], [], [])
    for query, own, hits in zip(asked["vec_id"].to_pylist(), queries, found, strict=True):
        hits = hits[hits >= 0]
        scores = (distinct[hits] * own).sum(axis=1)
        best = []
        for hit, score in zip(hits.tolist(), scores.tolist(), strict=True):
            end = min(begins[hit] + k + 1, begins[hit + 1])
            equal = keys[grouped[begins[hit] : end]].tolist()
            best.extend((-score, key) for key in equal if key != query)
        for score, key in sorted(best)[:k]:
            out[0].append(query)
            out[1].append(key)
            out[2].append(-score)
    return out


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 1.0,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of each row that ``is_query`` picks.

    ``is_query`` is a condition on the key column, called ``vec_id`` there.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).alias("embedding"))
    rows = cleaned(rows, "vec_id", "embedding").filter("vec IS NOT NULL AND vec_id IS NOT NULL")
    rows = rows.select("vec_id", "vec", "dim").dropDuplicates(["vec_id", "vec"])
    rows = materialize(rows, "vectors")
    total, asked = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = -(-total // SHARD_ROWS) or 1, -(-asked // QUERY_ROWS) or 1
    own = F.xxhash64("vec_id")
    shard_of, block_of = F.pmod(own, F.lit(shards)), F.pmod(F.xxhash64(own), F.lit(blocks))

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)).cast("array<long>"))

    sharded = rows.select("*", shard_of.alias("shard"), every(blocks).alias("block"))
    queries = rows.filter(is_query).select("*", block_of.alias("block"), every(shards).alias("shard"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            found = _searched(left, right, k, factor)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        columns = [pa.array(c, t) for c, t in zip(found, kinds, strict=True)]
        return pa.table(columns, ["query_id", "vec_id", "score"])

    by = ("shard", "block", "dim")
    found = (
        sharded.groupBy(*by)
        .cogroup(queries.groupBy(*by))
        .applyInArrow(run, "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

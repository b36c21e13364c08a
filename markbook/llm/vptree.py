"""Operator 7: approximate nearest neighbours by vantage-point trees, one per shard.

Nearness is the inner product.  With ``m`` the largest norm of all vectors, a vector ``x`` gets
one more coordinate, sqrt(m^2 - |x|^2), and a query a zero: Euclidean distance then orders
candidates exactly as the inner product does, and the triangle inequality holds.

Vectors are dealt into shards by a hash of their id.  A shard keeps one copy of equal vectors
(with their smallest ids) and builds a tree: an inner node holds a vantage point and the median
distance that parts its points; a leaf holds a block of points.  A block of queries descends
together; a query leaves a branch out if the branch's ring around the vantage point, widened by
its current k-th distance divided by ``relax``, does not reach it.  ``relax = 1`` (the default)
is the triangle inequality itself and the search is exact; a larger factor leaves more out.

A search keeps every point whose distance is within rounding of the k-th, not k of them: what is kept is
scored anew in double precision, pair by pair, with one order of additions, so equal scores are told from
unequal ones and ties, of equal vectors or of different ones, go to the smaller id.  One vector of a huge norm
makes the lifted distances coarse; then more points are kept and scored, at most a shard's for each query.

Cases: vectors that are null, zero, of another length than the first usable one's, or with null
or non-finite components take no part; repeated rows with one id count once per row; fewer than
k candidates give all of them; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markbook.llm.common import stored

K = 20
QUERY_EVERY = 20
SHARD = 8192  # vectors of a tree
LEAF = 512
BLOCK = 1024  # queries that descend together
PAIRS = 1 << 22  # numbers that are scored at a time


class Tree:
    """Vantage-point tree over the rows of ``points`` (already with the extra coordinate)."""

    def __init__(self, points: np.ndarray, seed: int = 3):
        self.points = points
        self.square = (points * points).sum(1)
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []  # (vantage, low/high inside, low/high outside, inner, outer) or (from, to)
        self.pick = np.random.default_rng(seed)
        self.root = self._build(0, len(points))

    def _build(self, a: int, b: int) -> int:
        """Node over order[a:b]; iterative on the outer half, so depth is logarithmic."""
        if b - a <= LEAF:
            self.nodes.append((a, b))
            return len(self.nodes) - 1
        own = self.order[a:b]
        vantage = int(own[self.pick.integers(len(own))])
        d = distances(self.points[own], self.square[own], self.points[vantage][None])[:, 0]
        half = (b - a) // 2
        split = np.argpartition(d, half)
        self.order[a:b], d = own[split], d[split]
        inner, outer = self._build(a, a + half), self._build(a + half, b)
        self.nodes.append((vantage, d[:half].min(), d[:half].max(), d[half:].min(), d[half:].max(), inner, outer))
        return len(self.nodes) - 1

    def search(self, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of every point that is among a query's k nearest or within rounding of the k-th,
        ordered by query; k is at most the number of points."""
        best = np.full((len(queries), k), np.inf)  # squared distances
        # what rounding can change in a squared distance, and so in a distance
        room = 4 * np.finfo(float).eps * (queries.shape[1] + 8) * ((queries * queries).sum(1) + self.square.max())
        slack = 4 * np.sqrt(room)
        near_rows, near_places, near_squares = [], [], []
        stack = [(self.root, np.arange(len(queries)), np.zeros(len(queries)))]
        while stack:
            node, live, bound = stack.pop()
            live = live[bound * relax <= np.sqrt(best[live].max(1)) + slack[live]]
            if not len(live):
                continue
            if len(self.nodes[node]) == 2:
                a, b = self.nodes[node]
                own = self.order[a:b]
                d = squares(self.points[own], self.square[own], queries[live]).T
                best[live] = np.partition(np.concatenate([best[live], d], 1), k - 1, axis=1)[:, :k]
                row, col = np.nonzero(d <= (best[live].max(1) + 2 * room[live])[:, None])
                near_rows.append(live[row].astype(np.int32))
                near_places.append(own[col].astype(np.int32))
                near_squares.append(d[row, col])
                continue
            vantage, in_low, in_high, out_low, out_high, inner, outer = self.nodes[node]
            d = distances(queries[live], (queries[live] ** 2).sum(1), self.points[vantage][None])[:, 0]
            to_in = np.maximum(np.maximum(in_low - d, d - in_high), 0)
            to_out = np.maximum(np.maximum(out_low - d, d - out_high), 0)
            # the half that more queries lie in comes first, to shrink the k-th distances early
            pair = [(outer, live, to_out), (inner, live, to_in)]
            if (to_in < to_out).sum() * 2 < len(live):
                pair.reverse()
            stack += pair
        row, place, square = map(np.concatenate, (near_rows, near_places, near_squares))
        ok = square <= (best.max(1) + 2 * room)[row]  # the k-th distance has shrunk since
        row, place = row[ok], place[ok]
        order = np.argsort(row, kind="stable")
        return row[order], place[order]


def squares(x: np.ndarray, square: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(square[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)


def distances(x: np.ndarray, square: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(squares(x, square, y))


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, always added in the same order."""
    return np.add.reduce(np.ascontiguousarray(q * x), axis=1)


def search_shard(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, top: float,
                 k: int, relax: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, vec_id, score) of each query's best k candidates of the shard."""
    by_id = np.argsort(ids, kind="stable")
    ids, x = ids[by_id], x[by_id]
    _, first, back = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    copies = np.argsort(back, kind="stable")
    cuts = np.append(np.searchsorted(back[copies], np.arange(len(first))), len(ids))
    points = x[first]
    lift = np.sqrt(np.maximum(top - (points * points).sum(1), 0))
    tree = Tree(np.concatenate([points, lift[:, None]], 1))
    want = min(k + 1, len(first))  # one more, for the query's own vector
    for at in range(0, len(queries), BLOCK):
        q, qid = queries[at:at + BLOCK], query_ids[at:at + BLOCK]
        lifted = np.concatenate([q, np.zeros((len(q), 1))], 1)
        asked, near = tree.search(lifted, want, relax)
        size = np.minimum(cuts[near + 1] - cuts[near], k + 1)  # copies of each, smallest ids first
        per = np.bincount(asked, size, len(q)).astype(np.int64)  # rows to score of each query
        parts = np.cumsum(per) * x.shape[1] // PAIRS  # queries that are scored together
        for part in np.unique(parts):
            own = (parts == part)[asked]
            row, some = np.repeat(asked[own], size[own]), size[own]
            step = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            place = copies[np.repeat(cuts[near[own]], some) + step]
            ok = ids[place] != qid[row]
            row, place = row[ok], place[ok]
            s = scores(q[row], x[place])
            order = np.lexsort((ids[place], -s, row))
            row, place, s = row[order], place[order], s[order]
            keep = np.arange(len(row)) - np.searchsorted(row, row) < k
            yield qid[row[keep]], ids[place[keep]], s[keep]


def usable(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(fine & F.exists("v", lambda x: x != 0))


def nearest(spark: SparkSession, embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
            every: int = QUERY_EVERY, relax: float = 1.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of every row whose id is divisible by
    ``every``.  Each shard meets the queries in blocks; no pair is formed outside a tree."""
    rows = stored(spark, usable(embeddings, id_col, vector), "vectors")
    stats = rows.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top")).orderBy(F.desc("n"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if stats is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, count, top = stats["d"], stats["n"], stats["top"]
    rows = rows.where(F.size("v") == dim)
    shards = max(1, -(-count // SHARD))
    asked = rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // (4 * BLOCK)))
    part = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
    # a task is one shard and one block of queries; both are bounded, copies of either are few
    part = part.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        found = list(search_shard(left["vec_id"].to_numpy(), np.stack(left["v"].to_numpy()), right["vec_id"].to_numpy(),
                                  np.stack(right["v"].to_numpy()), top, k, relax))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*found, strict=True)), strict=True)))

    found = part.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Exact top-k inner products by ball trees.

Candidates are dealt to shards, and each shard's task builds a ball tree. A query's inner product with
anything in a ball is at most q.c + |q| r, so nodes are visited by that bound, highest first, and dropped
where it can't beat the query's current kth score. Each query is searched in one shard first; its kth
score there goes with it to all other shards.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SHARD, BLOCK, LEAF = 8192, 4096, 128
NO_SCORE, NO_ID = -(1 << 63), (1 << 63) - 1
RESULT = "query_id long, vec_id long, score long"


class BallTree:
    """Balls around the rows of a matrix of whole numbers."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        self.order, self.nodes = np.arange(len(rows)), []
        self._build(rows, ids, 0, len(rows), leaf)
        self.rows, self.ids = rows[self.order], ids[self.order]

    def _build(self, rows: np.ndarray, ids: np.ndarray, start: int, end: int, leaf: int) -> int:
        own = self.order[start:end]
        x = rows[own]
        center = x.mean(axis=0)
        away = np.sqrt(((x - center) ** 2).sum(axis=1))
        number, radius = len(self.nodes), float(away.max())
        self.nodes.append([center, radius, int(ids[own].min()), start, end, None])
        if end - start > leaf and radius > 0:
            a = x[away.argmax()]
            b = x[((x - a) ** 2).sum(axis=1).argmax()]
            half = (end - start) // 2
            self.order[start:end] = own[np.argpartition(x @ (b - a), half)]
            self.nodes[number][5] = (self._build(rows, ids, start, start + half, leaf), self._build(rows, ids, start + half, end, leaf))
        return number


def search(tree: BallTree, queries: np.ndarray, query_ids: np.ndarray, k: int, score: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query, the candidates that beat or equal its given kth (score, vec), k at most: query positions, ids, scores.

    score and vec are changed to the kth so far while nodes are visited; ties go to the smaller id.
    """
    norm, found = np.sqrt((queries**2).sum(axis=1)), (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    score, vec = score.copy(), vec.copy()

    def bound(n: int, who: np.ndarray) -> np.ndarray:
        value = queries[who] @ tree.nodes[n][0] + norm[who] * tree.nodes[n][1]
        return unbounded(np.floor(value + 1e-6 * (1 + np.abs(value))))

    def useful(n: int, who: np.ndarray, value: np.ndarray) -> np.ndarray:
        return (value > score[who]) | (value == score[who]) & (tree.nodes[n][2] <= vec[who])

    def push(n: int, who: np.ndarray) -> None:
        value = bound(n, who)
        if (use := useful(n, who, value)).any():
            heapq.heappush(heap, (-float(value[use].max()), n, who[use], value[use]))

    heap: list = []
    push(0, np.arange(len(queries)))
    while heap:
        _, n, who, value = heapq.heappop(heap)
        who = who[useful(n, who, value)]
        if not len(who):
            continue
        _, _, _, start, end, children = tree.nodes[n]
        if children:
            for c in children:
                push(c, who)
            continue
        ids, other = tree.ids[start:end], tree.ids[start:end][None, :] != query_ids[who][:, None]
        i, j, got = inner(queries[who], tree.rows[start:end], lambda found: (found >= score[who][:, None]) & other)
        use = (got > score[who][i]) | (got == score[who][i]) & (ids[j] <= vec[who][i])
        i, j, got = i[use], j[use], got[use]
        if not len(i):
            continue
        touched = np.zeros(len(queries), bool)
        touched[who[i]] = True
        old = touched[found[0]]
        q, v, s = (np.concatenate((f[old], x)) for f, x in zip(found, (who[i], ids[j], got)))
        order = np.lexsort((v, ~s, q))  # -s would overflow at the lowest long
        q, v, s = q[order], v[order], s[order]
        first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
        place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        last = place == k - 1
        better = (s[last] > score[q[last]]) | (s[last] == score[q[last]]) & (v[last] < vec[q[last]])
        score[q[last][better]], vec[q[last][better]] = s[last][better], v[last][better]
        keep = place < k
        found = tuple(np.concatenate((f[~old], x[keep])) for f, x in zip(found, (q, v, s)))
    return found


def _matrix(table: pa.Table, name: str, dims: int) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(table.num_rows, dims)


def unbounded(value: np.ndarray) -> np.ndarray:
    """Upper bounds of scores, which are limited to long; one that is no number, as of infinite terms, bounds nothing."""
    return np.where(np.isnan(value), np.inf, np.maximum(value, float(NO_SCORE)))


def inner(queries: np.ndarray, rows: np.ndarray, beats) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (query, row) that may beat their query's kth score, and their inner products, limited to long.

    beats takes a matrix of scores and returns which pairs do. Where doubles may be off by a half, pairs that beat
    by the most that they could be are worked out in whole numbers of any size; others are rounded.
    """
    got = queries @ rows.T
    slack = queries.shape[1] * np.finfo(float).eps * np.sqrt((queries**2).sum(axis=1))[:, None] * np.sqrt((rows**2).sum(axis=1))[None, :]
    sure = slack < 0.5
    i, j = np.nonzero(beats(np.where(sure, np.rint(got), unbounded(got + slack) + 1)))
    scores = np.rint(np.where(sure, got, 0)[i, j]).astype(np.int64)
    for n in np.flatnonzero(~sure[i, j]).tolist():
        exact = sum(int(a) * int(b) for a, b in zip(queries[i[n]], rows[j[n]]))
        scores[n] = max(NO_SCORE, min(NO_ID, exact))
    return i, j, scores


def _shard(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        with np.errstate(over="ignore", invalid="ignore"):
            return visit(left, right)

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in RESULT.split(", ")]
        kinds = [pa.int64()] * 3
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        dims = left.column("dims")[0].as_py()
        rows, ids = _matrix(left, "vec", dims), left.column("vec_id").to_numpy()
        queries, query_ids = _matrix(right, "vec", dims), right.column("query_id").to_numpy()
        q, v, s = search(BallTree(rows, ids), queries, query_ids, k, right.column("kth_score").to_numpy(), right.column("kth_vec").to_numpy())
        return pa.table([pa.array(query_ids[q]), pa.array(v), pa.array(s)], names=names)

    return run


def top_k(df: DataFrame, is_query, k: int = 5, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """Each query's k highest inner products of floor(scale * x): query_id, rank (from 1), vec_id, score.

    Candidates are all rows but those with the query's own id, of the query's own length. Ties go to the
    smaller id; a query with fewer candidates has fewer rows, one without any has none. Rows with a null
    id or vector, or a null or non-finite component (also one whose multiple isn't finite), take no part. Repeated rows of a candidate count each.
    Scores beyond long are limited to it. Tasks hold one shard and one block of queries.
    """
    scratch = Scratch(df.sparkSession, "topk")
    vec = F.col("v")
    sound = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scale * x) <= 1.7e308))
    own = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & vec.isNotNull() & sound)
    own = own.select("vec_id", F.transform(vec, lambda x: F.when(F.abs(scale * x) < float(1 << 53), F.floor(scale * x).cast("double")).otherwise(scale * x)).alias("vec"), F.size(vec).alias("dims"))
    rows = scratch.cut(own.withColumn("is_query", is_query(F.col("vec_id"))), "rows")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    shards, blocks = max(1, math.ceil(sizes.n / shard)), max(1, math.ceil(sizes.q / block))
    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    keys = ["dims", "shard", "block"]
    candidates = rows.select("vec_id", "vec", "dims", home.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = rows.where("is_query").dropDuplicates(["vec_id", "vec"]).select(F.col("vec_id").alias("query_id"), "vec", "dims", home.alias("home"), F.pmod(F.hash("vec_id"), F.lit(blocks)).cast("int").alias("block"))

    def visit(some: DataFrame) -> DataFrame:
        return candidates.alias("c").groupBy(*keys).cogroup(some.groupBy(*keys)).applyInArrow(_shard(k), RESULT)

    queries = scratch.cut(queries, "queries")
    first = scratch.cut(visit(queries.select("query_id", "vec", "dims", F.col("home").alias("shard"), "block", F.lit(NO_SCORE).alias("kth_score"), F.lit(NO_ID).alias("kth_vec"))), "first")
    found = first
    if shards > 1:
        by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        kth = first.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") == k).select(F.col("query_id").alias("known"), F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_vec"))
        told = queries.join(kth, F.col("query_id") == F.col("known"), "left").select("query_id", "vec", "dims", "home", "block", F.coalesce("kth_score", F.lit(NO_SCORE)).alias("kth_score"), F.coalesce("kth_vec", F.lit(NO_ID)).alias("kth_vec"))
        others = told.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home").drop("home")
        found = first.unionByName(visit(others))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

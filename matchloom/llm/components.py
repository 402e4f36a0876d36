"""Connected components of edges between long ids, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean


def _contract(batches, most: int = 1 << 20):
    """Each task's edges as stars to the smallest id that they reach, in portions of about `most` edges."""

    def stars(a: np.ndarray, b: np.ndarray):
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        x, y, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, root[y], low)
            root = root[root]
            if (root == before).all():
                break
        away = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[away]), pa.array(nodes[root[away]])], names=["a", "b"])

    held, n = [], 0
    for batch in batches:
        held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        n += len(batch)
        if n >= most:
            yield stars(*map(np.concatenate, zip(*held)))
            held, n = [], 0
    if n:
        yield stars(*map(np.concatenate, zip(*held)))


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b) edges to (node, root), root being the smallest id of the component; ids without edges aren't listed.

    Every round is written to the shared folder and the round before it deleted. Edges never come to the
    driver; a hub's edges are joined with its one smallest neighbour, which Spark can split.
    """
    now = scratch.cut(edges.where("a <> b").select("a", "b").mapInArrow(lean(_contract), "a long, b long").distinct(), "round0")
    state, k = None, 0
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "at")
        large = both.join(least, F.col("a") == F.col("at")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "at")
        small = large.join(least, F.col("a") == F.col("at")).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        k += 1
        after = scratch.cut(small, f"round{k}")
        scratch.drop(f"round{k - 1}")
        now = after
        told = after.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.col("a").cast("decimal(20,0)") + F.col("b")).alias("s")).first()
        if state == told:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = told

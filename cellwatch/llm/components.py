"""Connected components of an edge table.

Up to ``LOCAL`` edges, a number that is checked, one task joins them. Any larger table goes through
alternating large-star and small-star steps, which need no group, task or driver that holds a
component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellwatch.llm.common import written

LOCAL = 200_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node with the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .where("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours with the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()


def _forest(batches):
    """Stars of all edges of one task."""
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1) for b in batches]
    if not pairs:
        return
    nodes, at = np.unique(np.concatenate(pairs), return_inverse=True)
    at = at.reshape(-1, 2)
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[at[:, 0]], root[at[:, 1]])
        new = root.copy()
        for side in (0, 1):
            np.minimum.at(new, root[at[:, side]], low)
            np.minimum.at(new, at[:, side], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["id", "root"])


def components(edges: DataFrame, local: int = LOCAL, steps: int = 100) -> DataFrame:
    """``id, root`` for every node of the edges ``a, b`` (long): root is the smallest id reachable.

    A step is a map-side aggregate and a join; each round is written to the shared folder. Rows
    with a = b name lone nodes. An empty table gives no rows; a null on either side is left out. Raises
    where ``steps`` rounds, far more than any graph has needed, don't settle the labels.
    """
    named = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    now = written(named.distinct(), "edges")
    if now.count() <= local:
        return now.coalesce(1).mapInArrow(_forest, "id bigint, root bigint")
    return _stars(now, steps)


def _stars(now: DataFrame, steps: int) -> DataFrame:
    """Components of distinct edges by alternating steps."""
    lone = now.where("a = b").select(F.col("a").alias("id"))
    now = now.where("a <> b")
    mark = None
    for k in range(steps):
        now = written(_small_star(_large_star(now)), f"stars{k}")
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components are not settled after {steps} rounds")
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("root")).union(
        now.select(F.col("a").alias("id"), F.col("b").alias("root"))).distinct()
    return roots.union(lone.join(roots, "id", "left_anti").select("id", F.col("id").alias("root")))

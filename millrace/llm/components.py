"""Connected components by alternating stars, in DataFrame operations; no list of a node's neighbours is ever made."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise

#: Nodes that a task contracts at once, and edges that one task may finish alone.
TASK_NODES = 1_000_000
TASK_EDGES = 200_000


def _star(edges: DataFrame) -> DataFrame:
    """One large star, then one small star, of edges (u > v)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    joined = large.join(least, "u")
    return joined.select("u", F.col("m").alias("v")).unionByName(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def _find(parent: dict, x: int) -> int:
    root = x
    while (up := parent.get(root, root)) != root:
        root = up
    while x != root:
        parent[x], x = root, parent.get(x, x)
    return root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges as stars around the least node of each of its components: at most one edge per node."""
    parent: dict[int, int] = {}
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            u, v = _find(parent, u), _find(parent, v)
            if u != v:
                parent[max(u, v)] = min(u, v)
                parent.setdefault(min(u, v), min(u, v))
        if len(parent) > TASK_NODES:
            yield _stars(parent)
            parent = {}
    yield _stars(parent)


def _stars(parent: dict[int, int]) -> pa.RecordBatch:
    rows = [(x, r) for x in list(parent) if (r := _find(parent, x)) != x]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], ["u", "v"])


def components(edges: DataFrame, where: str, name: str) -> DataFrame:
    """(node, label) of every node in edges (a, b): label is the smallest node that it reaches. Only nodes with a label below themselves are listed.

    Each task first contracts its own edges; if at most TASK_EDGES are left (counted), one task finishes, else stars alternate."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).mapInArrow(_contract, "u long, v long")
    now, i, seen = materialise(now, where, f"{name}-0"), 0, None
    if now.count() <= TASK_EDGES:
        now = materialise(now.coalesce(1).mapInArrow(_contract, "u long, v long"), where, f"{name}-1")
        return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    while True:
        # The same edges twice mean stars all around; count and two sums tell sets apart.
        mark = now.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen, i = mark, i + 1
        now = materialise(_star(now), where, f"{name}-{i}")

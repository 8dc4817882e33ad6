"""Connected components of links between 64-bit nodes, by union-find inside tasks and contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: links that a task takes, and nodes its union-find holds at a time
TASK_LINKS, FOREST_NODES = 100_000, 200_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each part of the links, a link from every node to the smallest one it reaches in the part."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def links() -> pa.RecordBatch:
        found = [(x, root(x)) for x in list(parent)]
        found = [(x, r) for x, r in found if x != r]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    for batch in batches:
        for a, b in zip(*[batch[c].to_pylist() for c in ("a", "b")]):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= FOREST_NODES:
            yield links()
            parent.clear()
    if parent:
        yield links()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in the links (a, b); the component is its smallest node.

    Tasks reduce their links to forests first. If more than one task was needed, turns follow: each hooks every node to its
    smallest neighbour, follows two of these hooks, and joins the links' ends to what they hook to; links inside one
    node vanish. A node of any degree is one partial aggregate for each task.
    """
    links = stored(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "links")
    tasks = max(1, -(-links.count() // TASK_LINKS))
    left = stored(links.coalesce(tasks).mapInArrow(_forest, "a long, b long"), "forest")
    if tasks == 1:  # its nodes are fewer than a union-find holds, so every tree is whole
        roots = left.select(F.col("b").alias("node")).distinct()
        return stored(left.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("node", "node")), "labels")
    both = left.select("a").union(left.select("b")).distinct()
    labels = stored(both.select(F.col("a").alias("node"), F.col("a").alias("component")), "labels")
    while not left.isEmpty():
        ends = left.union(left.select("b", "a"))
        hooks = stored(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")), "hooks")
        for _ in range(2):
            further = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
            hooks = hooks.join(further, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
        hooks = stored(hooks, "hooks")
        labels = stored(
            labels.join(hooks.select(F.col("node").alias("component"), "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component")),
            "labels",
        )
        moved = left.join(hooks.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a", "left").join(
            hooks.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b", "left")
        ends = moved.select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b")).where("a <> b")
        left = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return labels

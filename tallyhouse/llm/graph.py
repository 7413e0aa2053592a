"""Connected components of links that are too many for one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored

#: Links that one task contracts.
TASK_LINKS = 1_000_000

_ARROW = pa.schema([("node", pa.int64()), ("root", pa.int64())])


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Every node's root, the smallest node it is connected to."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in list(parent)}


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is its component's smallest node.

    Tasks contract the links they hold to trees of depth one. A node with roots in
    several tasks links those roots: a smaller graph, contracted the same way, until
    one task holds it. Each round is written, none reaches the driver.
    """
    links = stored(links.select("a", "b").distinct(), "links")
    parts = max(1, -(-links.count() // task_links))

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs() -> Iterator[tuple[int, int]]:
            for batch in batches:
                yield from zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
        found = forest(pairs())
        if found:
            yield pa.record_batch([pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())], schema=_ARROW)

    trees = links.repartition(parts).mapInArrow(contract, "node long, root long")
    if parts == 1:
        return stored(trees, "components")
    trees = stored(trees, "trees")
    least = stored(trees.groupBy("node").agg(F.min("root").alias("root"), F.max("root").alias("last")), "least")
    between = (trees.join(least.filter("root <> last").select("node", F.col("root").alias("b")), "node")
               .filter(F.col("root") != F.col("b")).select(F.col("root").alias("a"), "b"))
    above = components(between, task_links).select(F.col("node").alias("root"), F.col("root").alias("top"))
    return least.select("node", "root").join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))

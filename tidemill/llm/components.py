"""Connected components of links between numbers, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.groups import join_splittable
from tidemill.scratch import write_table


# Nodes that a task holds at a time.
FOREST_NODES = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of a partition, so that a link per node is left of each ``FOREST_NODES``."""
    parent: dict[int, int] = {}

    def grown() -> Iterator[pa.RecordBatch]:
        nodes = [x for x in parent if root(x) != x]
        for k in range(0, len(nodes), 100_000):
            part = nodes[k : k + 100_000]
            tops = pa.array([root(x) for x in part], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), tops], ["a", "b"])
        parent.clear()

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_NODES:
            yield from grown()
    yield from grown()


def _toward_least(links: DataFrame, larger: bool) -> DataFrame:
    """One step: each node's larger (or smaller) neighbours are linked with its least one."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = join_splittable(both, least, ["a"])
    if larger:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b")).union(
            least.select("a", F.col("least").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the least number that each number with a link can reach.

    ``links`` has the columns ``a`` and ``b``; pairs with a NULL or twice the same number say
    nothing. Partitions first reduce their links to forests, then rounds of linking each
    node's neighbours with the least one follow until nothing changes. Runs jobs, and keeps
    each round's links in the shared folder.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long"))
    links = links.where(F.col("a") != F.col("b")).mapInArrow(_forest, "a long, b long")
    links = write_table(links.distinct(), "links")
    before = None
    while True:
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        links = write_table(_toward_least(_toward_least(links, True), False), "links")
    return links.select(F.col("a").alias("id"), F.col("b").alias("component"))

"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

LINKS_AT_ONCE = 500_000


class Forest:
    """Which nodes are connected; every tree hangs from its smallest node."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def __len__(self) -> int:
        return len(self.parent)

    def clear(self) -> None:
        self.parent.clear()

    def root(self, node: int) -> int:
        parent = self.parent
        parent.setdefault(node, node)
        while parent[node] != node:
            parent[node] = parent[parent[node]]
            node = parent[node]
        return node

    def join(self, a: int, b: int) -> bool:
        """Whether the two were not connected before."""
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y

    def stars(self) -> pa.RecordBatch:
        pairs = [(x, r) for x in list(self.parent) if (r := self.root(x)) != x]
        a, b = zip(*pairs, strict=True) if pairs else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What connects the same nodes with fewer links, for a bounded number of links at a time."""
    forest, n = Forest(), 0
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
        n += batch.num_rows
        if n >= LINKS_AT_ONCE:
            yield forest.stars()
            forest, n = Forest(), 0
    yield forest.stars()


def _minima(pairs: DataFrame) -> DataFrame:
    """Stored, so that a join with it is of two plain tables and a node with very many
    links can be split."""
    return written(
        pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")),
        "minima",
    )


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (long columns a, b): root is the smallest it reaches.

    Large-star and small-star rounds: every node hands its larger, then its
    smaller neighbours to the smallest it knows, until nothing changes. Only
    minima are gathered per node, so a node with very many links costs no task
    more than the others. Each round is a stored table. Null ends and loops are
    ignored; no links give no rows.
    """
    edges = written(
        links.where("a is not null and b is not null and a <> b").mapInArrow(
            _forests, "a long, b long"
        ),
        "edges",
    )
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = (
            both.where("v > u")
            .join(_minima(both), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = written(large, "large")
        small = large.join(_minima(large), "u")
        edges = written(
            small.select(F.col("v").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select(F.col("u").alias("a"), F.col("m").alias("b")))
            .where("a <> b")
            .distinct(),
            "edges",
        )
        state = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1_000_003)
        ).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )

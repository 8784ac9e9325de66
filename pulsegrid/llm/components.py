"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import cut_lineage


class Forest:
    """Union-find over nodes 0..n-1; a root is the least of its nodes."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.size = [1] * n

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            a, b = min(a, b), max(a, b)
            self.up[b] = a
            self.size[a] += self.size[b]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch as a star around the least node of each local component."""
    for batch in batches:
        a, b = np.asarray(batch["a"]), np.asarray(batch["b"])
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        forest = Forest(len(nodes))
        for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
            forest.union(x, y)
        roots = nodes[np.fromiter(map(forest.find, range(len(nodes))), np.int64, len(nodes))]
        other = roots != nodes
        yield pa.RecordBatch.from_arrays([pa.array(nodes[other]), pa.array(roots[other])], ["a", "b"])


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link to a root at most, and roots have none."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of links a-b between longs; the component is its least node.

    Nodes without links to others do not appear. Each round keeps at most as many links as before;
    the minimum per node is aggregated map-side, so a node with very many links is no hot spot.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a != b")
    links = cut_lineage(links.mapInArrow(_contract, "a long, b long").distinct())
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = cut_lineage(large.mapInArrow(_contract, "a long, b long").distinct())
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a")
        links = cut_lineage(small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")).distinct())
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))

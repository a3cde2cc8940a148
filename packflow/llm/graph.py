"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from packflow.llm.common import release_worker_state, written

EDGES = "a long, b long"


class Forest:
    """Union-find with the smallest member as root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        p = self.parent.setdefault(x, x)
        while p != self.parent[p]:
            self.parent[x] = p = self.parent[self.parent[p]]
        return p

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def edges(self) -> pa.RecordBatch:
        pairs = [(self.find(x), x) for x in list(self.parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
            names=["a", "b"])


def _contracted(edges: DataFrame, most: int = 200_000) -> DataFrame:
    """The same components with fewer edges: a forest for every ``most`` nodes a task sees."""
    def run(batches):
        release_worker_state()
        f = Forest()
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f.join(x, y)
            if len(f.parent) >= most:
                yield f.edges()
                f = Forest()
        yield f.edges()
        del f
        release_worker_state()

    return edges.select("a", "b").mapInArrow(run, EDGES)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root (the smallest reachable id) of every node with an edge.

    Each round links neighbours to the smallest neighbour, first the larger
    ones, then the smaller ones, until nothing changes; rounds grow with the
    logarithm of a component's size. A round's edges are written to the shared
    folder. Self loops and repeated edges change nothing."""
    e = written(_contracted(edges.where("a <> b")), "edges")
    seen = None
    for _ in range(max_rounds):
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b")
        # each edge with its larger end first
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        e = written(small.union(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct(), "edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == seen:
            break
        seen = (now["n"], now["h"])
    else:
        raise RuntimeError("components did not settle")
    return (e.select(F.col("b").alias("node"), F.col("a").alias("root"))
            .union(e.select(F.col("a").alias("node"), F.col("a").alias("root")))
            .groupBy("node").agg(F.min("root").alias("root")))


"""Scoring with a flattened forest.

All trees of a fitted forest become four node arrays (feature, threshold,
children, prediction), read from the model's own node table. One Arrow pass over
the rows walks tree by tree, level by level with array gathers, so a row costs
depth x trees array steps and the plan holds one operator instead of one
projection for each tree. The arrays are broadcast in groups of trees whose
size is checked against ``GROUP_BYTES``: a deep forest is scored group by
group, and a row carries its predictions of the groups before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from packflow.session import shared_path

GROUP_BYTES = 256 << 20
NODE_BYTES = 40  # of one node in the arrays
ROWS = 8192  # rows walked at once


def node_table(model: PipelineModel) -> DataFrame:
    """tree, node, prediction, left, right, feature, threshold of every node,
    from the model's saved form (children -1 at a leaf)."""
    forest = model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = shared_path(spark, "forest")
    forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    n = "nodeData"
    return nodes.select(
        F.col("treeID").cast("int").alias("tree"), F.col(f"{n}.id").alias("node"),
        F.col(f"{n}.prediction").alias("prediction"), F.col(f"{n}.leftChild").alias("left"),
        F.col(f"{n}.rightChild").alias("right"), F.col(f"{n}.split.featureIndex").alias("feature"),
        F.get(f"{n}.split.leftCategoriesOrThreshold", 0).alias("threshold"),
        F.col(f"{n}.split.numCategories").alias("categories"))


class Flat:
    """Some trees of a forest as arrays; ``roots`` are node numbers."""

    def __init__(self, rows: pa.Table):
        tree, node = rows["tree"].to_numpy(), rows["node"].to_numpy()
        order = np.lexsort((node, tree))
        tree, node = tree[order], node[order]
        if (rows["categories"].to_numpy()[order][rows["left"].to_numpy()[order] >= 0] >= 0).any():
            raise ValueError("the flattened forest has thresholds only; this forest splits on categories")
        self.roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
        base = np.repeat(self.roots, np.diff(np.append(self.roots, len(tree))))
        left, right = rows["left"].to_numpy()[order], rows["right"].to_numpy()[order]
        leaf = left < 0
        own = np.arange(len(tree))
        # left and right child of each node of a tree in turn, numbered in the tree; a leaf is its own child
        child = np.column_stack([np.where(leaf, own, base + left), np.where(leaf, own, base + right)]) - base[:, None]
        feature = np.where(leaf, 0, rows["feature"].to_numpy()[order]).astype(np.int64)
        threshold = np.where(leaf, np.inf, rows["threshold"].to_numpy(zero_copy_only=False)[order])
        prediction = rows["prediction"].to_numpy()[order]
        self.trees = []
        for lo, hi in zip(self.roots, np.append(self.roots[1:], len(tree))):
            tree_child, depth, level = child[lo:hi], 0, np.zeros(1, np.int64)
            while len(level := level[tree_child[level, 0] != level]):
                level, depth = tree_child[level].reshape(-1), depth + 1
            self.trees.append((feature[lo:hi], threshold[lo:hi], tree_child.reshape(-1), prediction[lo:hi], depth))

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Predictions of rows x trees, tree by tree: a tree's arrays stay in the cache."""
        n = len(x)
        flat, row, out = np.ascontiguousarray(x.T).reshape(-1), np.arange(n), np.empty((n, len(self.trees)))
        for k, (feature, threshold, child, prediction, depth) in enumerate(self.trees):
            at = np.zeros(n, np.int64)
            place = feature * n
            for _ in range(depth):
                at = child[2 * at + ~(flat[place[at] + row] <= threshold[at])]
            out[:, k] = prediction[at]
        return out


def tree_groups(nodes: DataFrame) -> list[list[int]]:
    """Trees in groups of at most ``GROUP_BYTES`` (one tree at least)."""
    sizes = sorted((r["tree"], r["count"]) for r in nodes.groupBy("tree").count().collect())
    groups: list[list[int]] = []
    room = 0
    for tree, count in sizes:
        need = count * NODE_BYTES
        if not groups or need > room:
            groups.append([])
            room = GROUP_BYTES
        groups[-1].append(tree)
        room -= need
    return groups


def tree_predictions(model: PipelineModel, frame: DataFrame, name: str = "_trees",
                     summary: Callable[[np.ndarray], dict[str, np.ndarray]] | None = None,
                     names: Sequence[str] = ()) -> DataFrame:
    """``frame`` with ``name``: the predictions of the forest's trees, in
    order; or, with a ``summary`` of rows x trees, with its columns ``names``
    instead, made where the last group of trees is walked."""
    spark = frame.sparkSession
    nodes = node_table(model)
    features = model.stages[0].getInputCols()
    out = frame.withColumn(name, F.array().cast("array<double>"))
    groups = tree_groups(nodes)
    for group in groups:
        rows = nodes.where(F.col("tree").isin(group)).toArrow()  # at most GROUP_BYTES
        flat = spark.sparkContext.broadcast(Flat(rows))
        made = summary if group is groups[-1] else None
        schema = out.schema
        if made is not None:
            schema = StructType([f for f in schema if f.name != name] + [StructField(c, DoubleType()) for c in names])

        def walk(batches: Iterator[pa.RecordBatch], flat=flat, own=list(out.columns), made=made,
                 ends=schema.names) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, ROWS):
                    part = b.slice(lo, ROWS)
                    x = np.column_stack([part.column(own.index(c)).to_numpy(zero_copy_only=False).astype(float)
                                         for c in features])
                    before = part.column(own.index(name))
                    got = flat.value.predict(x)
                    had = before.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                    every = np.column_stack([had, got])
                    if made is not None:
                        found = made(every)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(found[c]) if c in found else part.column(own.index(c)) for c in ends], names=ends)
                        continue
                    lists = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1) * every.shape[1], pa.int32()), pa.array(every.reshape(-1)))
                    columns = [lists if c == name else part.column(k) for k, c in enumerate(own)]
                    yield pa.RecordBatch.from_arrays(columns, names=own)

        out = out.mapInArrow(walk, schema)
    return out

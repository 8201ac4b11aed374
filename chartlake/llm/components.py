"""Connected components of a graph whose edges are spread over the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.tables import saved


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node that is not the smallest of its component in these edges, and that smallest node."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(ends[: len(a)].tolist(), ends[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.array([root(x) for x in range(len(nodes))], np.int64)
    child = np.flatnonzero(roots != np.arange(len(nodes)))
    return nodes[child], nodes[roots[child]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a, b = forest(np.concatenate([a, batch.column(0).to_numpy()]), np.concatenate([b, batch.column(1).to_numpy()]))
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["node", "component"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (two long columns, no nulls) other than its component's smallest.

    Each round joins what meets in a partition into stars, brings a node's stars together, and lets every node skip to its
    centre's centre. A hot centre is never gathered: partitions go by node, and the skip is a plain join that Spark can
    split. Rounds grow with the logarithm of the longest path; each round's stars are a saved table.
    """
    schema = "node long, component long"
    a, b = edges.columns
    stars = edges.select(F.col(a).cast("long"), F.col(b).cast("long")).mapInArrow(_stars, schema)
    while True:
        stars = saved(stars.repartition("node").mapInArrow(_stars, schema), "stars")
        centre = stars.select(F.col("node").alias("component"), F.col("component").alias("above"))
        skipped = saved(stars.join(centre, "component", "left"), "skips").select("node", "component", "above")
        again = skipped.agg(
            F.count("above").alias("skips"), F.count("*").alias("rows"), F.count_distinct("node").alias("nodes")
        ).first()
        if not again["skips"] and again["rows"] == again["nodes"]:
            return skipped.select("node", "component")
        stars = skipped.select("node", F.coalesce("above", "component").alias("component")).distinct()

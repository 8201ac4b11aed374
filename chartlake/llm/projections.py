"""Nearest neighbours by a few Gaussian projections, indexed by kd-trees.

A Gaussian distribution is 2-stable: the squared distance of two vectors' projections to DIMS random directions, divided by
their true squared distance, is chi-squared with DIMS degrees of freedom. So if neighbours are visited in the order of
projected distance r, and the k-th best true distance so far is d, a vector that is nearer than d and not yet visited has a
chance of at most 1 - CHI2_DIMS(r * r / (d * d)). The search stops once that is below 1 - CONFIDENCE. The test holds for every
single vector: in a leaf that is visited, only those within the test's reach are multiplied out.

The largest inner product becomes the smallest distance by one more coordinate, sqrt(M * M - |x|**2), M the largest length.

A coarse kd-tree, fitted on a bounded sample of the projections, deals all vectors to leaves; a large leaf is cut into blocks
of bounded size. Each query is first answered in its own leaf, which bounds its k-th distance, and then goes to those leaves
whose boxes the stopping test doesn't exclude at that bound. In a block a fine kd-tree yields the visits, and each lowers the
bound for the next.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlake.llm.tables import by_group, saved

DIMS = 24
CONFIDENCE = 0.95
#: The share of the squared lengths that rounding can add to a distance: equal vectors aren't told apart by it.
SLACK = 1e-9
#: Rows of projections on which the coarse tree is fitted: those of smallest hash. Every row is then indexed.
SAMPLE_ROWS = 20_000
#: Vectors and queries that one task holds, and vectors in a leaf of its fine tree.
BLOCK_ROWS = 8_192
TASK_QUERIES = 4_096
LEAF_ROWS = 32
#: Squared lengths from which on vectors are shrunk first.
LARGEST = 1e290


def chi_squared(x: np.ndarray) -> np.ndarray:
    """The distribution function for DIMS, an even number of, degrees of freedom."""
    half, term, total = x / 2, np.ones_like(x), np.zeros_like(x)
    for k in range(DIMS // 2):
        total += term
        term = term * half / (k + 1)
    return 1 - np.exp(-half) * total


def stop_ratio(confidence: float) -> float:
    """The projected over the true squared distance at which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared(np.array(middle)) < confidence else (low, middle)
    return high


def split(points: np.ndarray, leaf: int) -> tuple[list[tuple[int, float, int, int]], list[np.ndarray]]:
    """A kd-tree: nodes (axis, cut, left, right), children as node numbers or -1 - leaf; and the leaves' rows."""
    nodes: list = []
    leaves: list[np.ndarray] = []

    def grow(rows: np.ndarray) -> int:
        own = points[rows]
        spread = own.max(axis=0) - own.min(axis=0) if len(rows) else np.zeros(1)
        axis = int(spread.argmax())
        if len(rows) <= leaf or not spread[axis]:
            leaves.append(rows)
            return -len(leaves)
        cut = float(np.median(own[:, axis]))
        below = own[:, axis] < cut
        if not below.any():
            cut = float(own[:, axis][own[:, axis] > cut].min())
            below = own[:, axis] < cut
        k = len(nodes)
        nodes.append(None)
        nodes[k] = (axis, cut, grow(rows[below]), grow(rows[~below]))
        return k

    grow(np.arange(len(points)))
    return nodes, leaves


def leaf_of(nodes: list, points: np.ndarray) -> np.ndarray:
    """The leaf each point falls into."""
    out = np.zeros(len(points), np.int64)
    todo = [(0, np.arange(len(points)))] if nodes else []
    while todo:
        k, rows = todo.pop()
        if k < 0:
            out[rows] = -1 - k
            continue
        axis, cut, left, right = nodes[k]
        below = points[rows, axis] < cut
        todo += [(left, rows[below]), (right, rows[~below])]
    return out


class Block:
    """A fine kd-tree over vectors: answers queries by visiting leaves in the order of their boxes' projected distance."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        self.leaves = split(points, LEAF_ROWS)[1]
        rows = np.concatenate(self.leaves)
        self.ids, self.vectors, self.points = ids[rows], vectors[rows], points[rows]
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.verified = 0
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in self.leaves])])
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def nearest(self, own: int, query: np.ndarray, point: np.ndarray, length2: float, k: int, bound: float, ratio: float):
        """(scores, ids) of at most k; bound: a squared distance known to hold k others."""
        box = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        reach = (box * box).sum(axis=1)
        order = np.argsort(reach, kind="stable")
        scores, ids = np.zeros(0), np.zeros(0, np.int64)
        if not len(reach) or reach.min() > ratio * bound:
            return scores, ids
        # Rounding is far below SLACK here.
        gaps = self.squares + point @ point - 2 * (self.points @ point)
        a, step = 0, max(1, 4 * k // LEAF_ROWS)
        while a < len(order):
            if reach[order[a]] > ratio * bound:
                break
            chosen = order[a : a + step]
            chosen = chosen[reach[chosen] <= ratio * bound]
            counts = self.at[chosen + 1] - self.at[chosen]
            rows = np.repeat(self.at[chosen] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
            rows = rows[(gaps[rows] <= ratio * bound) & (self.ids[rows] != own)]
            self.verified += len(rows)
            new = np.einsum("ij,j->i", self.vectors[rows], query)
            if len(ids) == k:
                better = new >= scores[-1]
                rows, new = rows[better], new[better]
            scores, ids = np.concatenate([scores, new]), np.concatenate([ids, self.ids[rows]])
            best = np.lexsort((ids, -scores))
            # An id takes one place, with its best score: the bound needs k different ones.
            if len(set(ids[best[:k]].tolist())) < len(best[:k]):
                best = best[np.sort(np.unique(ids[best], return_index=True)[1])]
            scores, ids = scores[best[:k]], ids[best[:k]]
            if len(ids) == k:
                bound = min(bound, max(length2 - 2 * scores[-1], 0.0) + SLACK * length2)
            a, step = a + step, 2 * step
        return scores, ids


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id: str = "vec_id", vector: str = "embedding", confidence: float = CONFIDENCE, seed: int = 7
) -> DataFrame:
    """(query_id, rank, id, score): each query's k rows of largest inner product other than its own, ties to the smaller id.

    The score is the inner product of the original vectors in double precision. Null, empty and zero vectors, those with null
    or non-finite components, and null ids take no part, as rows or queries; neither do vectors of another width than most
    have. Rows with the same id are one vector if they are equal; if not, each can be found and an id counts once, with its best
    score. Very large entries are no special case; a product beyond a double's range has an infinite score, and still its place by size.
    Queries with fewer candidates return them all. Empty tables give an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession

    def sound(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
        finite = F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
        return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)

    def shrunk(df: DataFrame, by: int) -> DataFrame:
        return df.withColumn("v", F.transform("v", lambda x: x * F.lit(2.0**-by))) if by else df

    data = sound(vectors)
    length2 = F.expr("aggregate(v, 0D, (s, x) -> s + x * x)")
    widths = data.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"), F.max(length2).alias("longest"))
    usual = widths.orderBy(F.desc("n"), "width").first()
    schema = "query_id long, rank int, id long, score double"
    if usual is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id)
    width, longest = usual["width"], usual["longest"]
    # Squares of very large entries overflow: all vectors are then shrunk by one power of two, which leaves their order as it is.
    shrink = 0
    if not longest < LARGEST:
        largest = data.where(F.size("v") == width).agg(F.max(F.expr("aggregate(v, 0D, (s, x) -> greatest(s, abs(x)))"))).first()[0]
        shrink = math.frexp(largest)[1] - 1
        data = shrunk(data, shrink)
        longest = data.where(F.size("v") == width).agg(F.max(length2)).first()[0]
    directions = np.random.default_rng(seed).standard_normal((width + 1, DIMS))
    ratio = stop_ratio(confidence)

    def projected(df: DataFrame, is_query: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    v = np.stack(batch.column(1).to_numpy(zero_copy_only=False)).astype(float)
                    extra = np.zeros(len(v)) if is_query else np.sqrt(np.maximum(longest - (v * v).sum(axis=1), 0))
                    p = v @ directions[:-1] + extra[:, None] * directions[-1]
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(extra), pa.array(list(p), pa.list_(pa.float64()))], names=["id", "v", "extra", "p"])

        return df.where(F.size("v") == width).select("id", "v").mapInArrow(run, "id long, v array<double>, extra double, p array<double>")

    rows = saved(projected(data.dropDuplicates(["id", "v"]), False), "projected")
    asked = saved(projected(shrunk(sound(queries), shrink), True).dropDuplicates(["id", "v"]), "queries")
    sample = rows.select("id", "p").orderBy(F.xxhash64("id", F.lit(seed)), "id", "p").limit(SAMPLE_ROWS).collect()
    total = rows.count()
    fitted = np.array([r["p"] for r in sample])
    nodes, _ = split(fitted, max(1, math.ceil(len(fitted) * min(1.0, BLOCK_ROWS / 2 / max(total, 1)))))

    def with_leaf(df: DataFrame) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    leaf = leaf_of(nodes, np.stack(batch.column(3).to_numpy(zero_copy_only=False)))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

        return df.select("id", "v", "extra", "p").mapInArrow(run, "id long, v array<double>, extra double, p array<double>, leaf long")

    # Leaves are cut into blocks by a row number, so equal vectors or ids don't crowd one block.
    placed = saved(with_leaf(rows).withColumn("row", F.monotonically_increasing_id()), "placed")
    own = saved(with_leaf(asked), "asked")
    boxes = placed.groupBy("leaf").agg(
        F.count("*").alias("n"),
        *[f(F.col("p")[i]).alias(f"{name}{i}") for i in range(DIMS) for name, f in (("low", F.min), ("high", F.max))],
    ).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("long"))
    boxes = saved(boxes, "boxes")
    blocked = placed.join(boxes.select("leaf", "blocks"), "leaf").withColumn("block", F.pmod(F.xxhash64("row"), "blocks"))

    def answered(visits: DataFrame) -> DataFrame:
        """Answers of (leaf, id, v, p, bound) rows, block by block; a block's queries are taken TASK_QUERIES at a time."""
        load = visits.groupBy("leaf").agg(F.ceil(F.count("*") / TASK_QUERIES).cast("long").alias("parts"))
        to_block = visits.join(boxes.select("leaf", "blocks"), "leaf").join(load, "leaf")
        to_block = to_block.withColumn("part", F.pmod(F.xxhash64("id"), "parts")).withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        held = blocked.join(load, "leaf").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
        columns = ["leaf", "block", "part", "asks", "id", "v", "p", "extra"]
        both = to_block.select("leaf", "block", "part", F.lit(True).alias("asks"), "id", "v", "p", F.col("bound").alias("extra")).union(
            held.withColumn("asks", F.lit(False)).select(columns)
        )

        def run(table: pa.Table) -> list:
            asks = np.array(table["asks"].to_pylist(), bool)
            ids, extra = table["id"].to_numpy(), table["extra"].to_numpy()
            v, p = (np.stack(table[c].to_numpy()) for c in ("v", "p"))
            if asks.all():
                return [[], [], []]
            block = Block(ids[~asks], v[~asks], p[~asks])
            out: list[list] = [[], [], []]
            for q in np.flatnonzero(asks):
                scores, found = block.nearest(ids[q], v[q], p[q], float((v[q] * v[q]).sum() + longest), k, extra[q], ratio)
                out[0] += [ids[q]] * len(found)
                out[1] += found.tolist()
                out[2] += scores.tolist()
            return out

        return by_group(both, ["leaf", "block", "part"], "query_id long, id long, score double", run)

    def best(found: DataFrame) -> DataFrame:
        single = found.groupBy("query_id", "id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return single.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    no_bound = F.lit(float("inf"))
    home = saved(answered(own.select("leaf", "id", "v", "p", no_bound.alias("bound"))), "home")
    kth = best(home).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    reach = length2 + F.lit(longest)
    bounded = own.join(kth, "id", "left").withColumn(
        "bound", F.coalesce(F.greatest(reach - 2 * F.col("kth"), F.lit(0.0)) + reach * F.lit(SLACK), no_bound)
    )
    # The tree has at most as many leaves as the sample has rows, which bounds what the driver and each task hold of them.
    found = boxes.orderBy("leaf").collect()
    leaves = np.array([r["leaf"] for r in found])
    low, high = (np.array([[r[f"{name}{i}"] for i in range(DIMS)] for r in found]) for name in ("low", "high"))

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = []
            for home, point, bound in zip(*(batch.column(c).to_pylist() for c in (0, 3, 4))):
                gap = np.maximum(np.maximum(low - point, np.array(point) - high), 0)
                near = (gap * gap).sum(axis=1) <= ratio * bound
                lists.append(leaves[near & (leaves != home)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], names=[*batch.schema.names, "reached"])

    others = bounded.select(F.col("leaf").alias("home"), "id", "v", "p", "bound").mapInArrow(
        reached, "home long, id long, v array<double>, p array<double>, bound double, reached array<long>"
    ).withColumn("leaf", F.explode("reached"))
    away = answered(saved(others.select("leaf", "id", "v", "p", "bound"), "visits"))
    score = F.col("score") * F.lit(2.0**shrink) * F.lit(2.0**shrink) if shrink else F.col("score")
    return best(home.union(away)).select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id), score.alias("score"))

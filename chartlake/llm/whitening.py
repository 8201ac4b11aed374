"""Embedding whitening over distinct integer vectors.

Identical vectors are grouped first, so that the fit and the whitening handle each distinct vector once; a vector weighs one in the
fit, or as much as it has copies. A first pass adds up n and the sums S, a second one multiplies centred blocks of vectors (one
matrix product a batch, summed entry by entry over the cluster), and the driver takes the eigenvectors of the covariance, whose
size is the square of the vectors' width. A last pass whitens each distinct vector, and a join brings the results to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.tables import saved

SCALE = 256
COMPONENTS = 4
#: A component whose eigenvalue is not over this share of the largest one has no variance but for rounding.
LEAST_SHARE = 1e-13


def integer_rows(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x, key) of the rows whose vector is not null and holds finite entries only; x: each entry c as floor(scale * c).

    An x beyond a long's range becomes the range's end. key is a 256-bit digest of x, to join by.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id}`").alias("id"), v.alias("v"))
    finite = rows.where("v is not null and forall(v, c -> c is not null and not isnan(c) and abs(c) < double('Infinity'))")
    x = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(0).cast("long"))
    return finite.select("id", x.alias("x")).withColumn("key", F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dim, high, low) for each dimension of (x, weight) batches: the weighted sum is high * 2**32 + low."""
    total: list[int] = []
    for batch in batches:
        if batch.num_rows:
            x, w = _matrix(batch.column(0)), batch.column(1).to_numpy()
            # Halves of 32 bits, as whole numbers of any size where weights are large.
            w = w.astype(object) if int(w.max()) * len(w) >= 1 << 30 else w
            own = [int(a) << 32 for a in w @ (x >> 32)]
            own = [a + int(b) for a, b in zip(own, w @ (x & 0xFFFFFFFF))]
            total = [a + b for a, b in zip(total, own)] if total else own
    if total:
        columns = [pa.array(range(len(total)), pa.int32()), pa.array([t >> 32 for t in total], pa.int64()), pa.array([t & 0xFFFFFFFF for t in total], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "high", "low"])


def _products(mean: np.ndarray):
    """(dim, row): for each dimension the upper part of the summed products of centred, weighted vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column(0)) - mean
                own = (centred * batch.column(1).to_numpy().astype(float)[:, None]).T @ centred
                total = own if total is None else total + own
        if total is not None:
            rows = [total[k, k:] for k in range(len(total))]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["dim", "row"])

    return run


def _summed(products: DataFrame, width: int) -> np.ndarray:
    """The whole symmetric matrix; what reaches the driver is bounded by the vectors' width."""
    entries = products.select("dim", F.posexplode("row").alias("right", "value")).groupBy("dim", "right").agg(F.sum("value").alias("value"))
    out = np.zeros((width, width))
    for r in entries.collect():
        out[r["dim"], r["dim"] + r["right"]] = out[r["dim"] + r["right"], r["dim"]] = r["value"]
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Each row's sum of (n * x - S)**2, exact; None where that exceeds a long."""
    # Sums modulo 2**64 are exact for all results within a long; an estimate tells which are.
    with np.errstate(over="ignore"):
        wrapped = x.astype(np.uint64) * np.uint64(n % (1 << 64)) - np.array([s % (1 << 64) for s in sums], np.uint64)
        exact = (wrapped * wrapped).sum(axis=1, dtype=np.uint64)
    rough = ((x * float(n) - np.array([float(s) for s in sums])) ** 2).sum(axis=1) / 2.0**63
    out: list[int | None] = [int(v) if r < 0.9 else None for v, r in zip(exact.tolist(), rough.tolist())]
    for k in np.flatnonzero((rough >= 0.9) & (rough < 1.1)):
        value = sum((n * int(c) - s) ** 2 for c, s in zip(x[k].tolist(), sums))
        out[k] = value if value < 1 << 63 else None
    return out



def whitened(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, by_copies: bool = False
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every sound row and component up to `components`.

    x is floor(scale * c) of each entry c. n and S are the count and sums of the distinct x (with by_copies of all rows: the weight
    of a distinct x is then its number of copies). component counts the covariance's eigenvectors from 1 by falling eigenvalue;
    an eigenvector's largest entry is positive. deviation: the exact sum of (n * x - S)**2, null beyond a long. whitened: the
    centred x on the component over its standard deviation. explained: the eigenvalue's share of the trace. identity_error: by how
    much the covariance of whitened, measured over the fit list, departs from the identity at most.

    Rows whose vector is null, or holds a null or an entry that isn't finite, go, and so do those of another width than most rows
    have (of two as frequent, the smaller). Rows with a null id, and repeated rows, stay and give their rows each. A component
    without variance (a constant table, one distinct vector, more equal dimensions) has whitened null and explained 0, and takes no
    part in identity_error, which is null if there is no other; vectors narrower than `components` have fewer. Other columns are
    ignored. A table without a sound row gives no rows.
    """
    spark = vectors.sparkSession
    rows = integer_rows(vectors, id, vector, scale)
    kind = rows.schema["id"].dataType.simpleString()
    shape = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    usual = rows.groupBy(F.size("x").alias("width")).count().where("width > 0").orderBy(F.desc("count"), "width").first()
    if usual is None:
        return spark.createDataFrame([], shape).withColumnRenamed("id", id)
    width = usual["width"]
    rows = rows.where(F.size("x") == width)
    copies = rows.groupBy("x").agg(F.min("key").alias("key"), F.count("*").alias("copies"))
    fit = saved(copies.withColumn("weight", F.col("copies") if by_copies else F.lit(1).cast("long")), "distinct")

    n = fit.agg(F.sum("weight")).first()[0]
    parts = fit.select("x", "weight").mapInArrow(_sums, "dim int, high long, low long")
    halves = parts.groupBy("dim").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).orderBy("dim").collect()
    sums = [(r["high"] << 32) + r["low"] for r in halves]
    mean = np.array([float(Fraction(s, n)) for s in sums])
    covariance = _summed(fit.select("x", "weight").mapInArrow(_products(mean), "dim int, row array<double>"), width) / n
    values, directions = np.linalg.eigh(covariance)
    kept = min(components, width)
    values, directions = values[::-1][:kept], directions[:, ::-1][:, :kept]
    directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(kept)])
    trace = float(np.trace(covariance))
    live = values > max(LEAST_SHARE * max(values[0], 0.0), 0.0)
    to_white = directions[:, live] / np.sqrt(values[live])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(1))
                white = pa.array(list((x - mean) @ to_white), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(deviations(x, n, sums), pa.int64()), white], names=["key", "weight", "deviation", "white"])

    done = saved(fit.select("key", "x", "weight").mapInArrow(run, "key string, weight long, deviation long, white array<double>"), "whitened")
    error = None
    if live.any():
        count = int(live.sum())
        centre = done.select(F.posexplode("white").alias("k", "value"), "weight").groupBy("k").agg(F.sum(F.col("value") * F.col("weight")).alias("s"))
        middle = np.array([r["s"] for r in centre.orderBy("k").collect()]) / n
        spread = _summed(done.select(F.col("white").alias("x"), "weight").mapInArrow(_products(middle), "dim int, row array<double>"), count) / n
        error = float(np.abs(spread - np.eye(count)).max())
    place = np.where(live, np.cumsum(live) - 1, -1)
    parts = F.array(*[
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.col("white")[int(place[k])] if live[k] else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(max(values[k], 0.0) / trace) if live[k] else 0.0).alias("explained"),
        )
        for k in range(kept)
    ])
    joined = rows.select("id", "key").join(done.select("key", "deviation", "white"), "key")
    out = joined.select("id", F.explode(parts).alias("p"), "deviation").select(
        "id", "p.component", F.lit(n).cast("long").alias("n"), "deviation", "p.whitened", "p.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )
    return out.withColumnRenamed("id", id)

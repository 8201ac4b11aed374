"""Intermediate tables in the shared folder, and row-wise kernels over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.session import release, work_dir  # noqa: F401

#: Bytes of text that a kernel holds in its working arrays at once; one longer text is taken by itself.
SLICE_BYTES = 1 << 20
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written below spark.checkpoint.dir and read again: its lineage ends in files that survive lost executors."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_alone(df: DataFrame, name: str) -> DataFrame:
    """saved(df, name), and the shuffle files of the write are deleted as it ends."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        return saved(df, name)
    finally:
        conf.set(CLEAN_UP, before)


def texts_of(column: pa.Array) -> list[str]:
    """The strings of an Arrow column; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


def slices(sizes: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum up to the limit at most, or that hold one item."""
    start = total = at = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if total or at >= start:
        yield start, at + 1


def by_text(
    df: DataFrame,
    text: str,
    fields: list[T.StructField],
    kernel: Callable[[list[str]], list],
    keep_text: bool = False,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """df with columns that kernel(texts) works out, one list or array for each field; the text column goes unless kept.

    The kernel sees whole texts in slices of bounded size, in the rows' order; null texts come as empty ones. A column of df
    with a new field's name is replaced.
    """
    new = [(f.name, f.dataType) for f in fields]
    source = df.select([F.col(f"`{c}`") for c in df.columns if c == text or c not in {n for n, _ in new}])
    where = source.columns.index(text)
    kept = [k for k, c in enumerate(source.columns) if (keep_text or k != where) and c not in {n for n, _ in new}]
    schema = T.StructType([source.schema.fields[k] for k in kept] + fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(t) for _, t in new]
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = pc.fill_null(pc.binary_length(batch.column(where)), 0).to_pylist()
            for a, b in slices(sizes, slice_bytes):
                part = batch.slice(a, b - a)
                out = kernel(texts_of(part.column(where)))
                yield pa.RecordBatch.from_arrays([part.column(k) for k in kept] + [pa.array(x, type=t) for x, t in zip(out, types)], names=names)

    return source.mapInArrow(run, schema)


def by_group(df: DataFrame, keys: list[str], schema: str, fn: Callable[[pa.Table], list]) -> DataFrame:
    """fn(rows of one key) for each combination of the key columns (no nulls); fn gives one list or array for each output field.

    Rows meet by a shuffle on the keys and a sort in each partition, so many small groups cost no call of pandas each. A task
    holds one group at a time: callers bound the size of their groups.
    """
    out = T.StructType.fromDDL(schema)
    fields = [(f.name, f.dataType) for f in out.fields]
    dealt = df.select(*keys, *[c for c in df.columns if c not in keys]).repartition(*keys).sortWithinPartitions(*keys)
    width = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types, names = [to_arrow_type(t) for _, t in fields], [n for n, _ in fields]
        held: list[pa.RecordBatch] = []
        key = None

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(fn(pa.Table.from_batches(held)), types)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(width)]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for a, b in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
                own = tuple(c[a] for c in columns)
                if held and own != key:
                    yield result()
                    held = []
                key = own
                held.append(batch.slice(a, b - a))
        if held:
            yield result()

    return dealt.mapInArrow(run, out)

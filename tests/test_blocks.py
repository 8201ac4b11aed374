"""Nearest neighbours in blocks: rows are streamed past a block of queries."""

import numpy as np
import pyarrow as pa
import pytest

from chartlake.operators import blocks as B
from chartlake.operators import retrieval as R


def brute(queries, rows, names, k):
    out = []
    for v in queries.astype(float):
        best = {}
        for d, name in zip(np.round(np.sqrt(((rows.astype(float) - v) ** 2).sum(axis=1)), 6), names):
            best[name] = min(d, best.get(name, np.inf))
        out.append(sorted((d, name) for name, d in best.items())[:k])
    return out


@pytest.mark.parametrize("value, scale", [("<f4", 1.0), ("<f8", 1.0), ("<f8", 2.0**66)])
def test_block_is_exact_over_many_small_products(monkeypatch, value, scale):
    """Sparse vectors of few different entries, so that most distances are shared; a few keys come twice."""
    for name, small in (("ROWS", 16), ("STEP", 8), ("ENTRIES", 64), ("FOUND", 50)):
        monkeypatch.setattr(B.Block, name, small)
    rng = np.random.default_rng(5)
    draw = lambda n: ((rng.integers(0, 3, (n, 40)) * (rng.random((n, 40)) < 0.1)) * scale).astype(value)
    queries, rows = draw(50), draw(333)
    queries[3], rows[200:230] = 0, 0
    names = sorted(f"k{i:03d}" for i in range(333))
    names[101], names[160] = names[100], names[159]
    pack = lambda m: B.pack(pa.array(list(m), pa.list_(pa.float32() if value == "<f4" else pa.float64())), value)[1]
    np.testing.assert_array_equal(B.unpack(pack(rows).slice(7, 50), 40, value), rows[7:57])
    block = B.Block(pa.array(range(50)), [None] * 50, pack(queries), 40, value, 6)
    for s in range(0, 333, 100):
        block.add(pa.RecordBatch.from_arrays([pa.array(names[s : s + 100])], names=["key"]), None, rows[s : s + 100])
    got = {}
    for ids, keys, distances in block.result():
        for q, key, d in zip(ids.to_pylist(), keys.column(0).to_pylist(), distances):
            got.setdefault(q, []).append((d, key))
    assert [got[q] for q in range(50)] == [[(pytest.approx(d, rel=1e-12), key) for d, key in own] for own in brute(queries, rows, names, 6)]


def test_rows_of_a_group_are_never_held_together(spark):
    """Neither side of a pair of blocks is gathered in a task, and a query gives k rows for each part of the corpus, not each batch."""
    rng = np.random.default_rng(6)
    make = lambda n, key: spark.createDataFrame([(f"{key}{i:04d}", v.tolist()) for i, v in enumerate(rng.random((n, 5)))], f"{key} string, embedding array<double>")
    corpus, asked = make(900, "key"), make(40, "query_id")
    found = R.knn_exact(corpus, asked, 3, ["key"], in_blocks=True, query_block=16, corpus_block=100_000)
    assert "CoGroups" not in found._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        schema = "query_id string, key string, distance double"
        assert B.nearest_in_blocks(corpus, asked, 3, ["key"], 16, 100_000, schema).count() == 3 * 40
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_vectors_of_other_width_are_refused(spark):
    corpus = spark.createDataFrame([("a", [1.0, 2.0, 3.0])], "key string, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 2.0])], "query_id string, embedding array<double>")
    with pytest.raises(Exception, match="differ in width"):
        R.knn_exact(corpus, asked, 1, ["key"], in_blocks=True).collect()

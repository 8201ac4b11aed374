"""Token counts by a separator scan over flat token files that have no index.

Files are cut into blocks of equal size. Each block is searched for the end-of-document id with one vector comparison; a prefix
scan over the blocks of a file gives, for each, how many documents ended before it and where the last one ended. With that a
second search names the documents of every block by itself, also those that span several blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlake.llm.tables import saved
from chartlake.llm.token_files import NO_ID, ROWS, shared_folder, write_shards

BLOCK_TOKENS = 1 << 21
TASK_TOKENS = 1 << 23


def _deal(blocks: DataFrame, total: int) -> DataFrame:
    """Rows that stand for large blocks of files, spread by a stated number of tasks."""
    return blocks.repartition(max(1, -(-total // TASK_TOKENS)), "shard", "block")


def scan_counts(files: DataFrame, separator: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(shard, ordinal, start, n_tokens, ended) of every document in files (shard int, path, id_bytes int, tokens long).

    ordinal counts a file's documents from 0; start is the place of a document's first id in its file; n_tokens leaves the
    separator out. What follows a file's last separator, if anything, is a document with ended = false. Files without ids give
    no rows.
    """
    total = files.agg(F.sum("tokens")).first()[0] or 0
    blocks = (
        files.where("tokens > 0")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block_tokens))))
        .select("shard", "path", "id_bytes", "tokens", "block")
    )

    def places(path: str, width: int, tokens: int, block: int) -> np.ndarray:
        first = block * block_tokens
        ids = np.memmap(f"{path}.bin", f"<u{width}", "r", offset=first * width, shape=(min(block_tokens, tokens - first),))
        return first + np.flatnonzero(ids == separator)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(5))))
            found = [places(*x[1:]) for x in rows]
            ends, last = [len(x) for x in found], [int(x[-1]) if len(x) else None for x in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.int64()), pa.array(last, pa.int64())], names=[*batch.schema.names, "ends", "last"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, width, tokens, block, base, before in zip(*(batch.column(k).to_pylist() for k in range(7))):
                at = places(path, width, tokens, block)
                final = (block + 1) * block_tokens >= tokens
                if final and (at[-1] if len(at) else before) < tokens - 1:
                    at = np.append(at, tokens)
                starts = np.concatenate([[before], at[:-1]])[: len(at)] + 1
                for a in range(0, len(at), 16 * ROWS):
                    s, e = starts[a : a + 16 * ROWS], at[a : a + 16 * ROWS]
                    n = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, shard, np.int32)), pa.array(base + a + np.arange(n)), pa.array(s), pa.array(e - s), pa.array(e < tokens)],
                        names=["shard", "ordinal", "start", "n_tokens", "ended"],
                    )

    schema = "shard int, path string, id_bytes int, tokens long, block long"
    found = saved(_deal(blocks, total).mapInArrow(summary, schema + ", ends long, last long"), "blocks")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "shard", "path", "id_bytes", "tokens", "block",
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.last("last", ignorenulls=True).over(before), F.lit(-1).cast("long")).alias("before"),
    )
    return _deal(stitched, total).mapInArrow(documents, "shard int, ordinal long, start long, n_tokens long, ended boolean")


def document_names(files: DataFrame) -> DataFrame:
    """(shard, ordinal, doc_id) as the writer listed them beside the tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, path in (x for b in batches for x in zip(*(b.column(k).to_pylist() for k in range(2)))):
            names = np.memmap(f"{path}.doc", "<i8", "r")
            for a in range(0, len(names), 16 * ROWS):
                doc = np.array(names[a : a + 16 * ROWS])
                columns = [pa.array(np.full(len(doc), shard, np.int32)), pa.array(a + np.arange(len(doc))), pa.array(doc, mask=doc == NO_ID)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "ordinal", "doc_id"])

    return files.select("shard", "path").repartition(max(1, files.count()), "shard").mapInArrow(run, "shard int, ordinal long, doc_id long")


def token_counts(docs: DataFrame, tokenizer: str, separator: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens) of every row of docs, counted in flat files of its tokens that hold no offsets.

    Strings of special tokens in a text are encoded as ordinary text, so the separator marks nothing but ends. Files follow the
    input's partitions: no text is shuffled. Null and empty texts count 0 tokens; null ids stay null; repeated rows are counted
    one by one; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    files = saved(write_shards(rows, shared_folder(docs.sparkSession, "flat"), tokenizer, separator, True, index=False), "files")
    # Both sides are made from a few rows that stand for files, so Spark's size estimates say nothing: no broadcast here.
    counts = scan_counts(files, separator).hint("merge")
    return counts.join(document_names(files), ["shard", "ordinal"]).select(F.col("doc_id").alias(id), "n_tokens")

"""Flat token files with 64-bit offsets, written and read back by memory map.

A shard is three files: NAME.bin holds ids, unsigned and little-endian, 16 bits wide where the vocabulary allows and 32 bits
otherwise; NAME.idx holds the documents' offsets in it in 64 bits, one more than documents; NAME.doc holds their ids in 64 bits
(a null id as the smallest number). The manifest, a small table of one row per shard, has each shard's base: the prefix sum of
the tokens before it.

Files need a folder that driver and executors share and can map into memory. A task writes under a name of its own and reports
it only when it ends, so a repeated or speculative task leaves an unused file and never half a shard.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartlake.llm.encoding import encoder
from chartlake.llm.tables import SLICE_BYTES, saved, slices, texts_of
from chartlake.session import work_dir

NO_ID = -(1 << 63)
ROWS = 4096
MANIFEST = "shard int, path string, id_bytes int, docs long, tokens long"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir as a plain path."""
    url = urlparse(work_dir(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError(f"token files are mapped into memory: {url.scheme}:// has to be mounted as a folder")
    return url.path


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, special_as_text: bool = False, index: bool = True) -> DataFrame:
    """Each partition of docs (id long, text) as one shard, in the rows' order; the manifest.

    index=False writes NAME.bin and NAME.doc only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = encoder(tokenizer, special_as_text)
        end = np.array([end_id], own.dtype).tobytes()
        path = f"{folder}/{uuid.uuid4().hex}"
        at, count, files = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                os.makedirs(folder, exist_ok=True)
                files = [open(f"{path}.{x}", "wb") for x in ("bin", "doc", *["idx"] * index)]
                if index:
                    files[2].write(np.zeros(1, "<i8").tobytes())
            for a, b in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids = [x + end for x in own.encode(texts_of(part.column(1)))]
                files[0].write(b"".join(ids))
                files[1].write(pc.fill_null(part.column(0), NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                ends = at + np.cumsum([len(x) for x in ids]) // own.dtype.itemsize
                if index:
                    files[2].write(ends.astype("<i8").tobytes())
                at, count = int(ends[-1]), count + len(ids)
        for f in files or []:
            f.close()
        if files:
            row = [[TaskContext.get().partitionId()], [path], [own.dtype.itemsize], [count], [at]]
            kinds = [pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["shard", "path", "id_bytes", "docs", "tokens"])

    manifest = saved(docs.mapInArrow(run, MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text", folder: str | None = None) -> DataFrame:
    """The documents' ids, each followed by end_id, in ascending order of the document ids over all shards; the manifest.

    Null ids come first; rows with equal ids keep their order in the input and may go to several shards, so one id that holds a
    large share of the rows does not fill one task. Null texts are empty documents: end_id alone. An empty table gives no shard.
    """
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange("id", "row").sortWithinPartitions("id", "row").select("id", "text")
    return write_shards(dealt, folder or shared_folder(docs.sparkSession, "tokens"), tokenizer, end_id)


def read_tokens(manifest: DataFrame, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the shards; start counts from the first shard's first id.

    ids, an array, is left out on request; the checksum is of the ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, width, base in (x for b in batches for x in zip(*(b.column(k).to_pylist() for k in range(3)))):
            tokens = np.memmap(f"{path}.bin", f"<u{width}", "r")
            offsets, names = np.memmap(f"{path}.idx", "<i8", "r"), np.memmap(f"{path}.doc", "<i8", "r")
            for a in range(0, len(names), ROWS):
                at = np.array(offsets[a : a + ROWS + 1])
                doc = np.array(names[a : a + ROWS])
                found = [tokens[x:y].astype("<u4") for x, y in zip(at[:-1], at[1:])]
                columns = [pa.array(doc, mask=doc == NO_ID), pa.array(base + at[:-1]), pa.array(np.diff(at)), pa.array([zlib.crc32(x) for x in found], pa.int64())]
                if ids:
                    columns.append(pa.array([x.astype("<i4") for x in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])

    shards = max(1, manifest.count())
    # A stated number of partitions: a few small rows stand for large files, so they must not be put together.
    dealt = manifest.select("path", "id_bytes", "base", "shard").repartitionByRange(shards, "shard").drop("shard")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids)

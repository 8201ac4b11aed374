"""Substring dedup by an exact search for each window's first occurrence in the corpus, in place of a greedy Lempel-Ziv parse.

Reference blocks are parts of an index by anchor. The anchor of a window of `size` words is the smallest hash among its word
5-grams, the leftmost one if there are several; equal windows have equal anchors at equal places, so whatever a document can
copy is found in the one block its anchor falls into, and looking there is looking in every block. Consecutive windows with one
anchor form a piece of at most `size - 4` windows. Pieces whose anchor occurs once in the corpus copy nothing and stay behind.

Of equal pieces only the earliest goes on, and of their windows the earliest place of each is found. No factor is extended and
no words are compared: windows are told apart by 64-bit hashes under their anchor. The union of the windows that stand elsewhere
earlier is what is removed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.tables import SLICE_BYTES, saved_alone, slices, texts_of
from chartlake.llm.words import WORD, windows, word_hashes

SIZE = 20
GRAM = 5
#: Places are ordered by document, then by word, as one number: id * PLACES + word.
PLACES = 1 << 32
#: A piece's windows are counted in the lowest bits of one number: first window * COUNTS + windows.
COUNTS = 1 << 16
#: The pieces are shuffled in so many passes, by anchor, so that only a part of them is on disk twice.
PASSES = 2


def anchors(words: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all windows that lie within one document, and each one's anchor."""
    grams = windows(words, GRAM)
    span = size - GRAM + 1
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # The leftmost smallest of 1, 2, 4 ... grams from each place on; two overlapping stretches make up the window's.
    best, width = np.arange(len(grams)), 1
    while 2 * width <= span:
        a, b = best[:-width], best[width:]
        best, width = np.where(grams[b] < grams[a], b, a), 2 * width
    a, b = best[:n], best[span - width : span - width + n]
    best = np.where(grams[b] < grams[a], b, a)
    last = np.repeat(at[1:], np.diff(at))[:n] - size
    inside = np.flatnonzero(np.arange(n) <= last)
    return inside, best[inside]


def _pieces(size: int, emit: Callable[..., list]):
    """A kernel over (id, text) batches that emits rows for the pieces of a slice of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), SLICE_BYTES):
                part = batch.slice(x, y - x)
                words, at = word_hashes([t.encode() for t in texts_of(part.column(1))])
                places, anchor = anchors(words, at, size)
                if not len(places):
                    continue
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                counts = np.diff(np.append(first, len(places)))
                doc = np.searchsorted(at, places[first], "right") - 1
                grams = windows(words, GRAM)[anchor[first]].view(np.int64)
                yield emit(part.column(0).to_numpy(zero_copy_only=False)[doc], places[first] - at[doc], counts, grams, lambda: windows(words, size)[places])

    return run


def _anchor_counts(ids, starts, counts, grams, hashes) -> pa.RecordBatch:
    values, times = np.unique(grams, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(values), pa.array(times)], names=["anchor", "n"])


def _whole_pieces(ids, starts, counts, grams, hashes) -> pa.RecordBatch:
    # The anchor is the same for all windows of a frequent 5-gram, so a window is told by the whole of its own hash.
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(hashes().view(np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(grams), pa.array(ids), pa.array(starts.astype(np.int32)), lists], names=["anchor", "id", "start", "hashes"])


def copied_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(id, tests, firsts) of documents (id long, text) that hold shared pieces.

    tests: arrays [first window, windows] whose windows were looked up; firsts: the windows among them that stand nowhere
    earlier. The other looked-up windows are copies. Both lists are bounded by the document.
    """
    if not GRAM <= size < COUNTS:
        raise ValueError(f"windows of {GRAM} to {COUNTS - 1} words can be looked up, not of {size}")
    rows = docs.where("id is not null").select("id", "text")
    counted = rows.mapInArrow(_pieces(size, _anchor_counts), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    shared = saved_alone(counted.where("n > 1").select("anchor"), "anchors")
    pieces = rows.mapInArrow(_pieces(size, _whole_pieces), "anchor long, id long, start int, hashes array<long>")
    passes = [F.pmod("anchor", F.lit(PASSES)) == k for k in range(PASSES)]
    parts = [saved_alone(pieces.where(own).join(shared.where(own), "anchor", "left_semi"), "pieces") for own in passes]
    pieces = reduce(DataFrame.union, parts)

    def place(start):
        return F.col("id").cast("decimal(20,0)") * F.lit(PLACES).cast("decimal(10,0)") + start

    whole = pieces.groupBy("anchor", "hashes").agg(F.min(place(F.col("start"))).alias("place"))
    single = whole.select("anchor", "place", F.posexplode("hashes").alias("k", "hash"))
    firsts = single.groupBy("anchor", "hash").agg(F.min(F.col("place") + F.col("k")).alias("place"))
    word = F.pmod("place", F.lit(PLACES).cast("decimal(10,0)"))
    firsts = firsts.select(((F.col("place") - word) / F.lit(PLACES)).cast("decimal(20,0)").cast("long").alias("id"), word.cast("long").alias("first"))
    firsts = saved_alone(firsts, "firsts")
    tests = pieces.select("id", (F.col("start").cast("long") * COUNTS + F.size("hashes")).alias("test"))
    nothing = F.lit(None).cast("long")
    both = tests.withColumn("first", nothing).union(firsts.select("id", nothing, "first"))
    # Repeated rows of an id bring the same places again: sets, so the lists stay as long as the texts.
    return both.groupBy("id").agg(F.collect_set("test").alias("tests"), F.collect_set("first").alias("firsts"))


def removal(n: int, tests: np.ndarray, firsts: np.ndarray, size: int) -> np.ndarray:
    """Which of n words are removed."""
    copied = np.zeros(n + 1, bool)
    starts, counts = tests // COUNTS, tests % COUNTS
    # A text under a repeated id can be shorter than the one that brought a place.
    fits = starts + counts + size - 1 <= n
    starts, counts = starts[fits], counts[fits]
    copied[np.repeat(starts, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)] = True
    copied[firsts[firsts < n]] = False
    at = np.flatnonzero(copied)
    edge = np.zeros(n + size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge)[:n] > 0


def _applied(size: int, schema: T.StructType, always: bool):
    """Batches of (_row, text, tests, firsts) to the row, its number of words, the text left, and the spans removed.

    always: the words left are joined by blanks also where none is removed; otherwise such a text stays as it is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), SLICE_BYTES):
                part = batch.slice(x, y - x)
                counts, texts, spans = [], [], []
                for text, tests, firsts in zip(*(part.column(k).to_pylist() for k in (1, 2, 3))):
                    words = WORD.findall(text or "")
                    gone = removal(len(words), np.array(tests or [], np.int64), np.array(firsts or [], np.int64), size)
                    step = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    counts.append(len(words))
                    spans.append([[int(a), int(b)] for a, b in zip(step[::2], step[1::2])])
                    if spans[-1] or always:
                        text = " ".join([w for w, g in zip(words, gone.tolist()) if not g])
                    texts.append(text)
                new = [pa.array(counts, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.list_(pa.list_(pa.int32())))]
                yield pa.RecordBatch.from_arrays([part.column(0), *new], names=schema.names)

    return run


NEW = [
    T.StructField("_words", T.LongType()), T.StructField("_left", T.StringType()), T.StructField("_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
]


def _removed(docs: DataFrame, id: str, text: str, size: int, row: list[str], always: bool) -> DataFrame:
    """(_row, _words, _left, _spans) for every row; _row is a struct of the columns in row."""
    key, body = F.col(f"`{id}`").cast("long"), F.col(f"`{text}`")
    found = saved_alone(copied_windows(docs.select(key.alias("id"), body.alias("text")), size), "copies").withColumnRenamed("id", "_found")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in row]).alias("_row"), key.alias("_id"), body.alias("_text"))
    joined = packed.join(found, F.col("_id") == F.col("_found"), "left").select("_row", "_text", "tests", "firsts")
    schema = T.StructType([joined.schema["_row"], *NEW])
    return joined.mapInArrow(_applied(size, schema, always), schema)


def substring_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(id, n_words, n_removed, left, spans) for every row of docs.

    Every word in a window of `size` consecutive words that also starts earlier (under a smaller id, or before in the same text)
    is removed. left holds the remaining words joined by a blank; spans lists the removed ones as [first, after last].

    Null, empty and short texts have no windows and lose nothing. Rows with the same id count as one document: a window at the
    same place of two of them is no copy. A null id is no source, and nothing is removed under it. Other columns are ignored.
    """
    out = _removed(docs, id, text, size, [id], True)
    removed = F.expr("aggregate(_spans, 0L, (n, s) -> n + s[1] - s[0])")
    return out.select(F.col(f"_row.`{id}`").alias(id), F.col("_words").alias("n_words"), removed.alias("n_removed"), F.col("_left").alias("left"), F.col("_spans").alias("spans"))


def without_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """docs with the removed words gone from the text; a text that loses none stays as it is, one that loses all becomes empty."""
    out = _removed(docs, id, text, size, [c for c in docs.columns if c != text], False)
    return out.select([F.col("_left").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])

"""Encoding and decoding with content-defined chunks that documents share.

A rolling hash over the last WINDOW bytes cuts a text wherever its top BITS bits are zero, so equal passages are cut alike
wherever they stand. Documents are brought together by their smallest chunk hash, which copies and near copies mostly share,
over ranges that split a hash with very many documents. A task encodes each chunk it meets once.

A chunk's ids hold in any text only between its first and its last safe place: one at which no token can reach across (see
encoding.pieces). At each join the stretch from the last safe place on its left to the first on its right is encoded again, over
several chunks if one has no such place. From there on both sides agree with the ids of the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.encoding import Encoder, encoder, pieces
from chartlake.llm.tables import SLICE_BYTES, by_text, slices
from chartlake.llm.words import U, seeds

WINDOW = 32
#: One cut in 2**BITS bytes on average.
BITS = 9
KEY = 16
#: Bytes of ids and texts of chunks that a worker keeps; then it starts anew.
MEMORY = 48 << 20
TABLE = seeds(256, 70_000)
#: Powers 1, 2, 4 ... of an odd factor, modulo 2**64.
FACTORS = [U(pow(int(seeds(1, 71_000)[0]), 1 << k, 1 << 64)) for k in range(WINDOW.bit_length() - 1)]


def cuts(data: bytes) -> np.ndarray:
    """Where chunks of a UTF-8 text end, its own end included; no cut falls inside a character."""
    a = np.frombuffer(data, np.uint8)
    n = len(a)
    if n <= WINDOW:
        return np.array([n] * bool(n), np.int64)
    rolling = TABLE[a]
    for k, factor in enumerate(FACTORS):
        rolling = rolling[1 << k :] + rolling[: -(1 << k)] * factor
    # rolling[k] covers bytes k to k + WINDOW - 1
    at = np.flatnonzero(rolling >> U(64 - BITS) == 0) + WINDOW
    at = at[at < n]
    at = at[(a[at] & 0xC0) != 0x80]
    # In a run of places only the first is a cut, so that a constant stretch isn't cut at every byte.
    at = at[np.diff(at, prepend=-1) > 1]
    return np.append(at, n)


def _chunked(texts: list[str]) -> list[list]:
    ends, keys, first = [], [], []
    for x in texts:
        data = x.encode()
        at = cuts(data).tolist()
        own = [hashlib.blake2b(data[a:b], digest_size=KEY).digest() for a, b in zip([0, *at], at)]
        ends.append(at)
        keys.append(b"".join(own))
        first.append(min(own, default=b""))
    return [ends, keys, first]


CHUNKS = [
    T.StructField("_ends", T.ArrayType(T.IntegerType())), T.StructField("_keys", T.BinaryType()), T.StructField("_first", T.BinaryType()),
]


class Reuse:
    """Chunks that a worker has encoded: the text before the first safe place, the ids up to the last one, the text after it."""

    def __init__(self, own: Encoder):
        self.own, self.known, self.size = own, {}, 0
        self.chunks = self.encoded = 0

    def learn(self, new: dict[bytes, str]) -> None:
        """Encode chunks that aren't known."""
        if self.size > MEMORY:
            self.known, self.size = {}, 0
        cut = {}
        for key, text in new.items():
            parts = pieces(text)
            if len(parts) > 1 and not parts[0]:  # what stands before the chunk decides on its first place
                parts = [parts[1], *parts[2:]]
            cut[key] = parts
        inner = self.own.encode(["".join(p[1:-1]) for p in cut.values()])
        for (key, p), ids in zip(cut.items(), inner):
            self.known[key] = (p[0], ids, p[-1]) if len(p) > 1 else (p[0], None, "")
            self.size += len(ids) + len(p[0]) + len(p[-1]) + 200
        self.encoded += len(new)

    def encode(self, texts: list[str], ends: list[list[int]], keys: list[bytes]) -> list[bytes]:
        split = [[k[i : i + KEY] for i in range(0, len(k), KEY)] for k in keys]
        new: dict[bytes, str] = {}
        for text, at, own in zip(texts, ends, split):
            fresh = [i for i, k in enumerate(own) if k not in self.known and k not in new]
            if fresh:
                data = text.encode()
                new.update((own[i], data[at[i - 1] if i else 0 : at[i]].decode()) for i in fresh)
        if self.size > MEMORY:  # the memory starts anew: all chunks at hand are needed
            self.known, self.size = {}, 0
            for text, at, own in zip(texts, ends, split):
                data = text.encode()
                new.update((k, data[a:b].decode()) for k, a, b in zip(own, [0, *at], at))
        self.chunks += sum(map(len, split))
        self.learn(new)
        joins: list[str] = []
        plans: list[list] = []
        for own in split:
            plan, open_ = [], []
            for key in own:
                head, ids, tail = self.known[key]
                open_.append(head)
                if ids is not None:
                    plan += ["".join(open_), ids]
                    open_ = [tail]
            plan.append("".join(open_))
            joins += plan[::2]
            plans.append(plan)
        again = iter(self.own.encode(joins))
        return [b"".join(x if isinstance(x, bytes) else next(again) for x in plan) for plan in plans]


_REUSE: dict[str, Reuse] = {}
_VOCABULARY: dict[str, list[bytes]] = {}


def vocabulary(path: str) -> list[bytes]:
    if path not in _VOCABULARY:
        own = encoder(path).tokenizer
        if own.decoder is not None:
            raise ValueError("decoding by joined token strings is for tokenizers without a decoder")
        _VOCABULARY[path] = [(own.id_to_token(k) or "").encode() for k in range(max(own.get_vocab().values()) + 1)]
    return _VOCABULARY[path]


def decode(path: str, ids: np.ndarray) -> str:
    """The text of ids as the library gives it for a tokenizer without a decoder: token strings joined by blanks."""
    return b" ".join(map(vocabulary(path).__getitem__, ids.tolist())).decode()


def ids_and_text(path: str) -> tuple[list[T.StructField], Callable[[list[np.ndarray]], list]]:
    """Output columns ids and decoded."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return fields, lambda ids: [[x.astype("<i4") for x in ids], [decode(path, x) for x in ids]]


def digests(path: str) -> tuple[list[T.StructField], Callable[[list[np.ndarray]], list]]:
    """Output columns n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit numbers) and decoded_sha256 (UTF-8)."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def make(ids: list[np.ndarray]) -> list:
        sums = [hashlib.sha256(x.astype("<u4")).hexdigest() for x in ids]
        return [[len(x) for x in ids], sums, [hashlib.sha256(decode(path, x).encode()).hexdigest() for x in ids]]

    return fields, make


def encode_decode(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", output=ids_and_text) -> DataFrame:
    """id and the output's columns (by default ids and the decoded text) for every row of docs.

    Ids are those of the whole text, without special tokens added, truncation or padding. Null and empty texts have no ids and
    decode to an empty text; null ids and repeated rows stay as they are; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    cut = by_text(rows, "_text", CHUNKS, _chunked, keep_text=True)
    # The row's place splits the range of one hash that very many documents share.
    dealt = cut.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange("_first", "_row").select("_id", "_text", "_ends", "_keys")
    fields, make = output(tokenizer)
    schema = T.StructType([T.StructField(id, rows.schema["_id"].dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        if tokenizer not in _REUSE:
            _REUSE[tokenizer] = Reuse(encoder(tokenizer))
        reuse, types = _REUSE[tokenizer], [to_arrow_type(f.dataType) for f in fields]
        for batch in batches:
            for a, b in slices(pc.binary_length(batch.column(1)).to_pylist(), SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids = [np.frombuffer(x, reuse.own.dtype) for x in reuse.encode(*(part.column(k).to_pylist() for k in (1, 2, 3)))]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, t) for x, t in zip(make(ids), types))], names=schema.names)

    return dealt.mapInArrow(run, schema)

"""Cross-tokenizer alignment: which tokens of two public tokenizers cover the same bytes, over distinct texts.

Equal texts are brought together by a shuffle on the whole text. Each distinct text is tokenised by both tokenizers and aligned
once; what it adds to the corpus-wide counts is weighted by its copies. Texts are aligned in blocks of bounded size: a block adds
up its own id pairs first, so the shuffle that counts them sees a pair once a block (however frequent the pair), and counts
come back to the block the same way. At the end the measures of a text are joined to the ids of all its documents.

A text is cut before a blank that follows a visible character. Neither tokenizer's tokens reach across such a place, which is
checked when a tokenizer is loaded (else texts stay whole), so both have a token end there, and recurring parts are aligned once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlake.llm.tables import by_group, saved, slices

CUT = re.compile("(?<=[!-~À-ÖØ-öø-ÿ])(?= )")
VISIBLE = frozenset(map(chr, [*range(33, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
#: Parts that go to a tokenizer as one text.
RUN = 4_096
BLANK = "▁"
#: Parts that a worker remembers; beyond that it starts anew.
PARTS = 400_000
#: Bytes of text in a block; a larger block has fewer id pairs for its text, which the counts are shuffled by.
BLOCK_BYTES = 4 << 20
A_BITS = 32


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level tokens stand for bytes: visible Latin-1 ones for themselves, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """Tokens of a byte-level BPE of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)
        split = kind.get("pre_tokenizer") or {}
        letters = byte_letters()
        self.bytes = {
            i: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
            for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items()
        }
        self.widths, self.names = _tables(self.bytes)
        #: Words with a blank before them are encoded by themselves, and nothing is changed or added before that.
        self.cuts = kind.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")

    def encode(self, parts: list[str], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The parts' ids in turn, and how many each has; lengths: the parts' bytes.

        Where texts are cut, parts that end visibly are encoded in runs, as no token reaches across into the next blank.
        """
        cut = [k for k, p in enumerate(parts, 1) if not self.cuts or k % RUN == 0 or k == len(parts) or p[-1] not in VISIBLE]
        runs = list(zip([0, *cut], cut))
        out, sizes = [], []
        for (x, y), ids in zip(runs, self._library(["".join(parts[x:y]) for x, y in runs])):
            ids = np.array(ids, np.int64)
            if y == x + 1:
                out.append(ids)
                sizes.append([len(ids)])
                continue
            ends, after = np.cumsum(self.widths[ids]), np.cumsum(lengths[x:y])
            upto = np.searchsorted(ends, after, "right")
            if ends[-1] == after[-1] and np.array_equal(ends[upto - 1], after):
                out.append(ids)
                sizes.append(np.diff(upto, prepend=0))
            else:
                ids, n = _flat(self._library(parts[x:y]))
                out.append(ids)
                sizes.append(n)
        return np.concatenate(out), np.concatenate(sizes)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokens of a sentencepiece model that puts a blank before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = {i: bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(names)}
        self.widths, self.names = _tables(self.bytes)
        self.blank = [self.model.piece_to_id(BLANK)]
        probe = " a  b\n c "
        self.cuts = self.model.normalize(probe) == BLANK + probe.replace(" ", BLANK) and not any(BLANK in p.lstrip(BLANK) for p in names)

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The parts' ids in turn, and how many each has; parts begin with a blank, which the model adds itself."""
        found = self.model.encode([p[1:] for p in parts], num_threads=1)
        return _flat([self.blank if p == " " else ids for p, ids in zip(parts, found)])


#: What may follow a token in the text of a part's groups: another one of its group, those of b, the next group, the next part.
SIGNS = (",", "|", ";", "\n")


def _tables(of: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each id, the bytes of its token, and its number followed by each of SIGNS."""
    widths, names = np.zeros(max(of) + 1, np.int64), np.empty((len(SIGNS), max(of) + 1), object)
    for i, token in of.items():
        widths[i] = len(token)
        names[:, i] = [f"{i}{sign}" for sign in SIGNS]
    return widths, names


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in ids], np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), sizes


def _spelled(of: dict[int, bytes], ids: np.ndarray, sizes: np.ndarray, widths: np.ndarray, bodies: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Whether each body is what its tokens' bytes make, none of them empty."""
    tokens = list(map(of.__getitem__, ids.tolist()))
    at = np.concatenate([[0], np.cumsum(widths[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
    if widths[ids].all() and np.array_equal(np.diff(at), lengths) and b"".join(tokens) == b"".join(bodies):
        return np.ones(len(bodies), bool)
    upto = np.cumsum(sizes).tolist()
    return np.array([b"".join(tokens[x:y]) == body and b"" not in tokens[x:y] for x, y, body in zip([0, *upto], upto, bodies)], bool)


class Aligner:
    """Parts aligned so far, and the texts made of them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.cuts = self.a.cuts and self.b.cuts
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[str] = []
        self.measures = np.zeros((0, 5), np.int64)  # tokens of a and b, groups, links, and whether the bytes are the part's
        self.pool, self.starts = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def parts(self, text: str) -> list[str]:
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def learn(self, new: list[str]) -> None:
        """Align parts, all of them at once, as one run of bytes in which both tokenizers have an end after each part."""
        bodies = [part.encode() for part in new]
        length = np.array([len(x) for x in bodies], np.int64)
        (ids_a, size_a), (ids_b, size_b) = self.a.encode(new, length), self.b.encode(new)
        fits = _spelled(self.a.bytes, ids_a, size_a, self.a.widths, bodies, length)
        fits &= _spelled(self.b.bytes, ids_b, size_b, self.b.widths, bodies, length)
        in_a, in_b = np.repeat(fits, size_a), np.repeat(fits, size_b)
        own_a, own_b, number = ids_a[in_a], ids_b[in_b], np.flatnonzero(fits)
        ends_a, ends_b = np.cumsum(self.a.widths[own_a]), np.cumsum(self.b.widths[own_b])
        # A stretch between two neighbouring ends, whosever they are, lies in one token of a and one of b.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        both = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        after = np.cumsum(length[fits])
        n_links = np.diff(np.searchsorted(ends, after, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(ends[both], after, "right"), prepend=0)
        measures = np.zeros((len(new), 5), np.int64)
        measures[:, 0], measures[:, 1], measures[:, 4] = size_a, size_b, fits
        measures[number, 2], measures[number, 3] = n_groups, n_links
        shown = [""] * len(new)
        for k, x in zip(number.tolist(), self._shown(own_a, own_b, at_a[both], at_b[both], np.searchsorted(ends[both], after))):
            shown[k] = x
        self.known.update(zip(new, range(len(self.shown), len(self.shown) + len(new))))
        self.shown += shown
        self.measures = np.concatenate([self.measures, measures])
        self.pool = np.concatenate([self.pool, own_a[at_a] << A_BITS | own_b[at_b]])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(measures[:, 3])])

    def _shown(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, last: np.ndarray) -> list[str]:
        """Each part's groups as text; last_a, last_b: the last tokens of the groups, last: the last groups of the parts."""
        if not len(last):
            return []
        n_a, n_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        group_a, group_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
        sign_a, sign_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        sign_a[last_a], sign_b[last_b], sign_b[last_b[last]] = 1, 2, 3
        out = np.empty(len(ids_a) + len(ids_b), object)
        # A group's tokens of a come after those of b in earlier groups, its tokens of b after all of a so far.
        out[np.arange(len(ids_a)) + (last_b - n_b + 1)[group_a]] = self.a.names[sign_a, ids_a]
        out[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = self.b.names[sign_b, ids_b]
        return "".join(out.tolist()).split("\n")[:-1]

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(measures of each text, its groups' digest, and three arrays of links: text number, id pair, occurrences)."""
        if len(self.known) > PARTS:
            self.forget()
        cut = [self.parts(x) for x in texts]
        new = set().union(*cut) - self.known.keys()
        if new:
            self.learn(sorted(new))
        numbers = [list(map(self.known.__getitem__, parts)) for parts in cut]
        sizes = np.array([len(x) for x in numbers])
        flat = np.fromiter(chain.from_iterable(numbers), np.int64, int(sizes.sum()))
        # A text has a part at least, as a blank stands before it.
        measures = np.add.reduceat(self.measures[flat], np.cumsum(sizes) - sizes)
        fits = measures[:, 4] == sizes
        measures[~fits] = 0
        shown = [hashlib.sha256(";".join(map(self.shown.__getitem__, x)).encode()).hexdigest() if f else "" for x, f in zip(numbers, fits)]
        span = len(self.shown) + 1
        inside = np.repeat(fits, sizes)
        own, times = np.unique(np.repeat(np.arange(len(texts)), sizes)[inside] * span + flat[inside], return_counts=True)
        owner, part = own // span, own % span
        n = self.starts[part + 1] - self.starts[part]
        upto = np.cumsum(n)
        links = self.pool[np.arange(int(n.sum())) + np.repeat(self.starts[part] - (upto - n), n)]
        return measures[:, :4], shown, np.repeat(owner, n), links, np.repeat(times, n)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """This worker's aligner for two tokenizer files."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = (
    "key string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, block long, "
    "links array<int>, times array<int>, pairs array<long>, weights array<long>"
)


def _aligned(path_a: str, path_b: str, slice_bytes: int):
    """(key, text, copies) batches to ALIGNED rows, a block for each slice.

    links: places in the block's pairs, which stand in the block's first row with the copies of the texts that hold each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner(path_a, path_b)
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for x, y in slices(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist(), slice_bytes):
                rows = batch.slice(x, y - x)
                if not rows.num_rows:
                    continue
                measures, shown, owner, links, times = worker.texts(rows.column(1).to_pylist())
                pairs, place = np.unique(links, return_inverse=True)
                own, back = np.unique(owner * (len(pairs) + 1) + place, return_inverse=True)
                total = np.bincount(back, weights=times, minlength=len(own)).astype(np.int32)
                owner, place = own // (len(pairs) + 1), own % (len(pairs) + 1)
                weights = np.zeros(len(pairs), np.int64)
                np.add.at(weights, place, rows.column(2).to_numpy()[owner])
                at = pa.array(np.searchsorted(owner, np.arange(rows.num_rows + 1)).astype(np.int32))
                rest = [None] * (rows.num_rows - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), *[pa.array(measures[:, k]) for k in range(4)], pa.array(shown),
                        pa.array(np.full(rows.num_rows, block)), pa.ListArray.from_arrays(at, pa.array(place.astype(np.int32))),
                        pa.ListArray.from_arrays(at, pa.array(total)),
                        pa.array([pairs, *rest], pa.list_(pa.int64())), pa.array([weights, *rest], pa.list_(pa.int64())),
                    ],
                    names=[f.split()[0] for f in ALIGNED.split(", ")],
                )
                block += 1

    return run


def _scored(table: pa.Table) -> list:
    """A block's texts with the counts of its pairs: rows with a place hold counts, the others texts."""
    is_text = pc.is_null(table["place"]).to_numpy()
    places = table["place"].to_numpy()[~is_text].astype(np.int64)
    counts, best = np.zeros(len(places), np.int64), np.zeros(len(places), bool)
    counts[places] = table["count"].to_numpy()[~is_text].astype(np.int64)
    best[places] = table["best"].to_numpy(zero_copy_only=False)[~is_text].astype(bool)
    texts = table.filter(pa.array(is_text)).combine_chunks()
    links, times = (texts[c].combine_chunks() for c in ("links", "times"))
    sizes = pc.list_value_length(links).to_numpy()
    owner = np.repeat(np.arange(len(sizes)), sizes)
    links, times = links.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    # Sums in whole numbers, as a float would round beyond 2**53.
    total, hits = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    np.add.at(total, owner, times * counts[links])
    np.add.at(hits, owner, times * best[links])
    return [texts["key"].to_pylist(), *[texts[c].to_numpy() for c in MEASURES], hits, total, texts["groups_sha256"].to_pylist()]


def aligned(docs: DataFrame, path_a: str, path_b: str, id: str = "doc_id", text: str = "text", slice_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): the measures of every row of docs, and the corpus-wide count of each linked id pair.

    path_a is a byte-level BPE, path_b a sentencepiece model; both encode a blank and the text. Token byte ranges that overlap link
    their ids. documents: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256). n_groups: parts between places
    where both have a token end; n_links: linked token pairs; count_sum: the sum of their pairs' counts; n_best: those whose count
    is the highest of their a id, ties included. pairs: (a, b, count, best), count being the number of rows of docs that hold it.

    Null and empty texts, and texts whose tokens' bytes are not the blank and the text, have zeros and an empty groups_sha256, and
    add to no count. Repeated rows and ids count as documents of their own, null ids stay. Other columns are ignored; an empty
    table gives no rows. A text is aligned whole, however long.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("body"))
    distinct = rows.where("body is not null and body <> ''").groupBy("body").agg(F.count("*").alias("copies"))
    parts = distinct.select(F.sha2("body", 256).alias("key"), "body", "copies").mapInArrow(_aligned(path_a, path_b, slice_bytes), ALIGNED)
    parts = saved(parts, "aligned")

    own = parts.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "weights")).alias("place", "p"))
    own = own.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.weights").alias("weight"))
    counted = own.groupBy("pair").agg(F.sum("weight").alias("count")).withColumn("a", F.shiftright("pair", A_BITS))
    # An id of a has at most as many rows here as b has ids.
    best = counted.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))
    counts = saved(best.select("a", F.col("pair").bitwiseAND((1 << A_BITS) - 1).alias("b"), "pair", "count", "best"), "pairs")

    found = own.join(counts.select("pair", "count", "best"), "pair")
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in [*parts.schema, *found.schema]}
    fields = ["key", *MEASURES, "groups_sha256", "links", "times"]
    both = parts.where("size(links) > 0").select("block", *fields, none["place"], none["count"], none["best"]).unionByName(
        found.select("block", *[none[c] for c in fields], "place", "count", "best")
    )
    schema = "key string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    scored = by_group(both, ["block"], schema, _scored)
    measures = rows.withColumn("key", F.sha2("body", 256)).join(scored, "key", "left")
    numbers = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*MEASURES, "n_best", "count_sum")]
    documents = measures.select(F.col("id").alias(id), *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
    return documents, counts.drop("pair")

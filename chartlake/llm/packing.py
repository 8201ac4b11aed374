"""Packing documents into sequences of bounded length: best fit, then local search by moves and swaps.

The search takes underfull bins in turn and lets each gain by what raises the sum of squared fills: a document moved in from
another underfull bin, one exchanged for one, one for two, or two for one. As the sum rises, full bins get fuller and the emptiest
run dry. All lengths, all pairs and all underfull bins are searched, and it ends when no such step is left. Bins of few documents
come first: theirs are long, and they need the short ones before other bins have used them up.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.encoding import encoder
from chartlake.llm.tables import by_group, by_text, saved

CAPACITY = 1024
#: Pieces that one task packs together.
GROUP_PIECES = 16_384


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    free: dict[int, list[int]] = {}
    mask = 0  # bit r: some bin has r free
    for item in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[item]
        fits = mask >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            stack = free[room]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << room)
            bins[b].append(item)
        else:
            room, b = capacity, len(bins)
            bins.append([item])
        if room - need:
            free.setdefault(room - need, []).append(b)
            mask |= 1 << (room - need)
    return bins


class _Search:
    """Underfull bins and what they can hand over: parcels, which are single documents (kind 0) or pairs (kind 1), by length.

    A bin of distinct lengths summing up to the capacity has few of them, so all pairs of all bins are listed. For each kind and
    length `least` has the smallest fill of a bin that offers it; a heap knows that bin, its outdated entries going when they surface.
    """

    def __init__(self, lengths: list[int], bins: list[list[int]], capacity: int):
        self.capacity, self.fill = capacity, [sum(lengths[i] for i in b) for b in bins]
        self.held: list[dict[int, list[int]]] = []
        for b in bins:
            self.held.append(defaultdict(list))
            for i in b:
                self.held[-1][lengths[i]].append(i)
        self.heaps: tuple[dict, dict] = (defaultdict(list), defaultdict(list))
        self.least = np.full((2, capacity + 1), capacity + 1, np.int64)
        self.parcels: list[tuple[dict, dict]] = [({}, {})] * len(bins)
        self.version = [0] * len(bins)
        self.steps = 0
        for b, fill in enumerate(self.fill):
            if fill < capacity:
                self.offer(b)

    def refresh(self, b: int) -> None:
        for kind, own in enumerate(self.parcels[b]):
            for size in own:
                heap = self.heaps[kind][size]
                while heap and heap[0][2] != self.version[heap[0][1]]:
                    heappop(heap)
                self.least[kind, size] = heap[0][0] if heap else self.capacity + 1

    def offer(self, b: int) -> None:
        """List the bin's parcels."""
        own = sorted(x for x, items in self.held[b].items() if items)
        pairs = {x + y: (x, y) for k, x in enumerate(own) for y in own[k:] if x != y or len(self.held[b][x]) > 1}
        self.parcels[b] = ({x: (x,) for x in own}, pairs)
        for kind, parcels in enumerate(self.parcels[b]):
            for size in parcels:
                heappush(self.heaps[kind][size], (self.fill[b], b, self.version[b]))
        self.refresh(b)

    def withdraw(self, b: int) -> None:
        """Take the bin's parcels off the lists."""
        self.version[b] += 1
        self.refresh(b)

    def shift(self, parcel: tuple, source: int, target: int) -> None:
        for x in parcel:
            self.held[target][x].append(self.held[source][x].pop())
        self.fill[source] -= sum(parcel)
        self.fill[target] += sum(parcel)

    def improve(self, target: int) -> bool:
        """The step of largest gain for a withdrawn bin, from the emptiest bin that can make it, if any raises the sum of squares."""
        room, best, chosen = self.capacity - self.fill[target], 0, None
        own = sorted(x for x, items in self.held[target].items() if items)
        gives = [(), *((x,) for x in own)]
        gives += [(x, y) for k, x in enumerate(own) for y in own[k:] if x != y or len(self.held[target][x]) > 1]
        for give in gives:
            size = sum(give)
            for kind in (0, 1) if len(give) == 1 else (0,):
                # Taking a net gain from a bin raises the sum of squares if that bin's fill is below the target's new one.
                gains = np.arange(best + 1, room + 1)
                better = np.flatnonzero(self.least[kind, size + best + 1 : size + room + 1] < self.fill[target] + gains)
                if len(better):
                    best = int(gains[better[-1]])
                    chosen = give, kind, size + best
            if best == room:
                break
        if chosen is None:
            return False
        give, kind, size = chosen
        source = self.heaps[kind][size][0][1]
        take = self.parcels[source][kind][size]
        self.withdraw(source)
        self.shift(take, source, target)
        self.shift(give, target, source)
        self.offer(source)
        self.steps += 1
        return True

    def documents(self, b: int) -> int:
        return sum(map(len, self.held[b].values()))

    def run(self) -> list[list[int]]:
        """Steps until none is left; the bins that still hold something. Each step raises the sum of squares, so it ends."""
        moved = True
        while moved:
            moved = False
            for b in sorted((b for b, f in enumerate(self.fill) if 0 < f < self.capacity), key=lambda b: (self.documents(b), -self.fill[b])):
                if not 0 < self.fill[b] < self.capacity:
                    continue
                self.withdraw(b)
                while self.fill[b] < self.capacity and self.improve(b):
                    moved = True
                if self.fill[b] < self.capacity:
                    self.offer(b)
        out = [[i for items in held.values() for i in items] for held in self.held]
        return [x for x in out if x]


def pack(lengths: list[int], capacity: int = CAPACITY, start: list[list[int]] | None = None) -> list[list[int]]:
    """Bins of item numbers; lengths are 1 to capacity. The search begins with the bins in start, by default with those of best fit."""
    return _Search(lengths, best_fit(lengths, capacity) if start is None else start, capacity).run()


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, id: str, text: str, capacity: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids with end_id, cut if they are over capacity, the rest first."""

    def kernel(texts: list[str]) -> list[list]:
        own = encoder(tokenizer)
        starts, lengths, sums = [], [], []
        for x in own.encode(texts):
            ids = np.append(np.frombuffer(x, own.dtype), end_id).astype("<u4")
            rest = len(ids) % capacity or capacity
            at = [0, *range(min(rest, len(ids)), len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
            starts.append(at[:-1])
            lengths.append(np.diff(at))
            sums.append([zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:])])
        return [starts, lengths, sums]

    arrays = [T.StructField(n, T.ArrayType(T.LongType())) for n in ("start", "length", "ids_crc32")]
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    cut = by_text(rows, "text", arrays, kernel)
    return cut.select("id", F.posexplode(F.arrays_zip("start", "length", "ids_crc32")).alias("piece", "p")).select("id", "piece", "p.*")


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (with a column length, 1 to capacity) and their sequence_id and offset.

    Full pieces are sequences of their own. The others are dealt into groups of about GROUP_PIECES by their row, whatever their
    ids, and each group is packed by one task: at most one poorly filled sequence for each group.
    """
    numbered = saved(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    whole = numbered.where(F.col("length") == capacity).select("_row", (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts = numbered.where(F.col("length") < capacity)
    groups = max(1, -(-parts.count() // GROUP_PIECES))

    def run(rows: pa.Table) -> list:
        group, row, length = (rows[c].to_pylist() for c in ("_group", "_row", "length"))
        order = sorted(range(len(row)), key=row.__getitem__)
        out: list[list[int]] = [[], [], []]
        for k, items in enumerate(pack([length[i] for i in order], capacity)):
            at = 0
            for i in items:
                i = order[i]
                out[0].append(row[i])
                out[1].append((group[i] << 32) + k)
                out[2].append(at)
                at += length[i]
        return out

    dealt = parts.select(F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"), "_row", "length")
    places = by_group(dealt, ["_group"], "_row long, sequence_id long, offset long", run)
    return numbered.join(saved(places.union(whole), "places"), "_row").drop("_row")


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of all documents' pieces, packed into sequences.

    Null and empty texts are documents of the end id alone; null ids stay null; repeated rows are packed one by one; an empty
    table gives an empty result. Other columns are ignored.
    """
    placed = packed(token_pieces(docs, tokenizer, end_id, id, text, capacity), capacity)
    return placed.withColumnRenamed("id", id)

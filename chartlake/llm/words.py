"""Hashes of words and of word windows, for many texts at once.

A word is a maximal run of bytes other than space and \\t..\\r. Its hash adds up one 64-bit value for each pair of position
and byte, so equal words have equal hashes wherever they stand, and different words differ but for a chance of 2**-64.
"""

from __future__ import annotations

import re

import numpy as np

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BREAK = re.compile(rb"[\x20\x09-\x0D]")
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit changes about half of the output bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """n odd 64-bit constants made from a counter."""
    return mixed(np.arange(start, start + n, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) | U(1)


def _block(data: bytes, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of one block, and where the words start."""
    a = np.frombuffer(data, np.uint8)
    space = SPACE[a]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    inside = np.flatnonzero(~space)
    begins = np.searchsorted(inside, starts)
    lengths = np.diff(np.append(begins, len(inside)))
    at = (np.arange(len(inside)) - np.repeat(begins, lengths)).astype(np.uint64)
    letters = (LOWER[a] if lower else a)[inside].astype(np.uint64)
    values = mixed((at << U(8) | letters) * U(0x9E3779B97F4A7C15) + U(0x632BE59BD9B4E019))
    return mixed(np.add.reduceat(values, begins) + lengths.astype(np.uint64)), starts


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts' word hashes in one array, and each text's offset in it (one more than texts).

    Working arrays stay within a few times BLOCK_BYTES, also for one very long text; lower folds A-Z.
    """
    counts = np.zeros(len(texts), np.int64)
    found, part, owner, total = [], [], [], 0

    def flush() -> None:
        nonlocal part, owner, total
        if part:
            hashes, starts = _block(b"\n".join(part), lower)
            ends = np.cumsum([len(x) + 1 for x in part])
            np.add.at(counts, owner, np.diff(np.searchsorted(starts, ends), prepend=0))
            found.append(hashes)
        part, owner, total = [], [], 0

    for k, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > BLOCK_BYTES:
                cut = BREAK.search(text, at + BLOCK_BYTES)
                end = cut.end() if cut else end
            if total and total + end - at > BLOCK_BYTES:
                flush()
            part.append(text[at:end])
            owner.append(k)
            total += end - at
            at = end
    flush()
    return np.concatenate(found) if found else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)])


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of the window of size words from each word on, across texts too; the last size - 1 words have none."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, c in enumerate(seeds(size, 1000)):
        out += hashes[k : k + n] * c
    return mixed(out + U(size))

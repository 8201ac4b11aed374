"""Token ids of whole texts, by a public tokenizer of the tokenizers library, with a bounded memory of pieces.

A text is cut before a blank or line break that follows a visible character, and before a full stop or comma that follows a
letter or digit. In the tokenizers used here no token (and no step of normalising) reaches across such a place, so the pieces'
ids, joined, are the text's ids. Pieces recur like words do: a worker hashes all pieces of a batch at once, looks them up in a
sorted table, has the library encode those that are new, and gathers the ids. The table starts anew beyond PIECES entries.
"""

from __future__ import annotations

import os
import re

import numpy as np

from chartlake.llm.words import U, mixed

PIECES = 1_500_000
BLOCK_BYTES = 1 << 20
#: Places at which pieces may begin, after ASCII characters or Latin-1 letters. Not cutting is always right.
LETTER = "0-9A-Za-zÀ-ÖØ-öø-ÿ"
CUT = re.compile(rf"(?<=[!-~À-ÖØ-öø-ÿ])(?=[ \n])|(?<=[{LETTER}])(?=[.,])")
LONG_CUT = re.compile(rb"(?<=[!-~]) ")

_BLANK, _STOP, _VISIBLE, _ALNUM = (np.zeros(256, bool) for _ in range(4))
_BLANK[[32, 10]] = True
_STOP[[44, 46]] = True
_VISIBLE[33:127] = True
for _c in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
    _ALNUM[_c] = True


def pieces(text: str) -> list[str]:
    """text cut into pieces that can be encoded one by one."""
    return CUT.split(text)


def piece_starts(a: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes, after the first, at which pieces begin."""
    before = a[:-1]
    # Latin-1 letters are 0xC3 and another byte, but for the signs of multiplication and division.
    latin = np.zeros(len(before), bool)
    latin[1:] = (a[:-2] == 0xC3) & (before[1:] != 0x97) & (before[1:] != 0xB7)
    return 1 + np.flatnonzero((_BLANK[a[1:]] & (_VISIBLE[before] | latin)) | (_STOP[a[1:]] & (_ALNUM[before] | latin)))


class Encoder:
    """Ids of texts as the library gives them, without special tokens added, truncation or padding.

    special_as_text: strings of special tokens in a text are ordinary text, so that a text never holds such an id.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = special_as_text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.forget()

    def forget(self) -> None:
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.counts, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    def library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as bytes of dtype."""
        blocks, owner, out = [], [], [[] for _ in texts]
        for k, text in enumerate(texts):
            data, at = text.encode(), 0
            while at < len(data):
                cut = LONG_CUT.search(data, at + BLOCK_BYTES) if len(data) - at > BLOCK_BYTES else None
                end = cut.start() if cut else len(data)
                blocks.append(data[at:end])
                owner.append(k)
                at = end
        a = 0
        while a < len(blocks):
            b, size = a, 0
            while b < len(blocks) and (b == a or size + len(blocks[b]) <= BLOCK_BYTES):
                size += len(blocks[b])
                b += 1
            for k, ids in zip(owner[a:b], self._encode(blocks[a:b])):
                out[k].append(ids)
            a = b
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _encode(self, blocks: list[bytes]) -> list[bytes]:
        """The ids of blocks, none of them empty."""
        data = b"".join(blocks)
        a = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(x) for x in blocks])
        begins = np.zeros(len(a), bool)
        begins[piece_starts(a)] = True
        begins[0] = begins[ends[:-1]] = True
        at = np.flatnonzero(begins)
        lengths = np.diff(np.append(at, len(a)))
        place = (np.arange(len(a)) - np.repeat(at, lengths)).astype(np.uint64)
        values = mixed((place << U(8) | a) * U(0x9E3779B97F4A7C15) + U(0x2545F4914F6CDD1D))
        own, first, back = np.unique(np.add.reduceat(values, at), return_index=True, return_inverse=True)
        # A second sum tells pieces with the same hash apart, which a large corpus will have.
        checks = np.add.reduceat(values * values, at)[first]
        if len(self.hashes) > PIECES:
            self.forget()
        found = np.searchsorted(self.hashes, own)
        found[found == len(self.hashes)] = 0
        known = (self.hashes[found] == own) & (self.checks[found] == checks) if len(self.hashes) else np.zeros(len(own), bool)
        new = np.flatnonzero(~known)
        fresh = self.library([data[x : x + n].decode() for x, n in zip(at[first[new]], lengths[first[new]])])
        sizes = np.array([len(x) for x in fresh], np.int64)
        starts, counts = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
        if len(self.hashes):
            starts[:], counts[:] = self.starts[found], self.counts[found]
        starts[new], counts[new] = len(self.pool) + np.cumsum(sizes) - sizes, sizes
        self.pool = np.concatenate([self.pool, np.fromiter((i for x in fresh for i in x), self.dtype, int(sizes.sum()))])
        if len(new):
            # Of two pieces with one hash the newer stays.
            stay = np.ones(len(self.hashes), bool)
            if len(self.hashes):
                stay[found[new[self.hashes[found[new]] == own[new]]]] = False
            hashes = np.concatenate([self.hashes[stay], own[new]])
            order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[order]
            self.checks = np.concatenate([self.checks[stay], checks[new]])[order]
            self.starts = np.concatenate([self.starts[stay], starts[new]])[order]
            self.counts = np.concatenate([self.counts[stay], counts[new]])[order]
        n = counts[back]
        upto = np.cumsum(n)
        ids = self.pool[np.arange(upto[-1]) + np.repeat(starts[back] - (upto - n), n)]
        cut = np.concatenate([[0], upto])[np.searchsorted(at, np.concatenate([[0], ends]))]
        return [ids[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:])]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, special_as_text: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, special_as_text)
    return _ENCODERS[key]

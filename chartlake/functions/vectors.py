"""Vector expressions and the pluggable embedding and scoring slots."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake import constants as K
from chartlake.functions.text import QUESTION_WORD, words


def l2_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


Encoder = Callable[[list[str]], np.ndarray]
Scorer = Callable[[list[str], list[str]], np.ndarray]

_WORD = re.compile(QUESTION_WORD)


def hashed_counts(dim: int = K.EMBED_DIM) -> Callable[[], Encoder]:
    """Loader of the model-free encoder: term counts in hashed positions, scaled to unit length.

    A word's position is its first seven md5 digits modulo the width.
    """

    def load() -> Encoder:
        @lru_cache(maxsize=1 << 16)
        def slot(word: str) -> int:
            return int(hashlib.md5(word.encode(), usedforsecurity=False).hexdigest()[:7], 16) % dim

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for row, text in zip(out, texts):
                for word, n in Counter(_WORD.findall((text or "").lower())).items():
                    row[slot(word)] += n
            norms = np.linalg.norm(out, axis=1, keepdims=True)
            return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)

        return encode

    return load


def embed(text: Column, load: Callable[[], Encoder] | None = None, batch: int = K.EMBED_BATCH) -> Column:
    """Text to vector; the encoder is loaded once per Python worker and fed small batches."""
    load = load or hashed_counts()

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for series in batches:
            texts = series.tolist()
            vectors = [encode(texts[i : i + batch]).astype("float32") for i in range(0, len(texts), batch)]
            yield pd.Series([v for block in vectors for v in block])

    return run(text)


def pair_scores(question: Column, chunk: Column, load: Callable[[], Scorer]) -> Column:
    """Joint score of each (question, chunk) pair by a pluggable model."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        score = load()
        for q, c in batches:
            yield pd.Series(np.asarray(score(q.tolist(), c.tolist()), dtype="float64"))

    return run(question, chunk)


def distinct_words(text: Column) -> Column:
    return F.array_distinct(words(text))


def words_overlap(question: Column, chunk: Column) -> Column:
    """term_overlap of distinct words that are at hand."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(question, chunk)), F.size(question)), F.lit(0.0))


def term_overlap(question: Column, chunk: Column) -> Column:
    """Default pair score: the share of the question's distinct words that the chunk holds."""
    return words_overlap(distinct_words(question), distinct_words(chunk))


#: What can be worked out once a text instead of once a pair, and the score from it.
term_overlap.parts = (distinct_words, words_overlap)


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over the characters of a."""
    positions: dict[str, int] = {}
    for i, ch in enumerate(a):
        positions[ch] = positions.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    state = full
    for ch in b:
        hits = state & positions.get(ch, 0)
        state = ((state + hits) | (state - hits)) & full
    return len(a) - state.bit_count()


@F.pandas_udf(T.DoubleType())
def indel_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 * LCS / (m + n)."""
    return pd.Series([200.0 * _lcs(x, y) / (len(x) + len(y)) if x or y else 100.0 for x, y in zip(a, b)])

"""Quality rules over whole texts, with repetition measured on suffix arrays.

The words of a document are sorted by what follows them (a suffix array by prefix doubling, for many documents at once). The
longest common prefix of neighbours gives, for each word, the longest passage from it on that the document holds twice; from
`least` words on, such passages are repeats. Their union and the longest of them are limited: the union catches many short
repeats, the longest one a single long passage that is there twice. Both limits lie well below the base rule's half of all words.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.tables import by_text
from chartlake.llm.words import word_hashes

#: A passage of so many words that recurs in its document is a repeat.
LEAST_WORDS = 8
#: Limits of the verdict: the share of words in repeats, and the longest repeat as a share of all words.
MOST_COVERED = 0.3
MOST_LONGEST = 0.125
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def longest_repeats(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest passage from it on that starts at another word of its document too.

    words: all documents' words as numbers; at: the documents' offsets, one more than documents.
    """
    n = len(words)
    if not n:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    end = np.repeat(at[1:], np.diff(at))
    order = np.lexsort((words, doc))

    def ranked(order: np.ndarray, differs: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Where each element's run of equals begins in the suffix order."""
        new = np.concatenate([[True], differs])
        return base[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]

    place = np.arange(n, dtype=np.int64)
    rank = np.empty(n, np.int64)
    w, d = words[order], doc[order]
    rank[order] = ranked(order, (w[1:] != w[:-1]) | (d[1:] != d[:-1]), place)
    levels, step = [rank], 1
    suffixes = order
    while True:
        # Only suffixes that are still equal to a neighbour are sorted again.
        r = rank[suffixes]
        same = r[1:] == r[:-1]
        open_ = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same]))
        if not len(open_):
            break
        own = suffixes[open_]
        ahead = own + step
        second = np.where(ahead < end[own], rank[np.minimum(ahead, n - 1)] + 1, 0)
        first = rank[own]
        again = np.lexsort((second, first))
        own, first, second = own[again], first[again], second[again]
        suffixes = suffixes.copy()
        suffixes[open_] = own
        rank = rank.copy()
        rank[own] = ranked(own, (first[1:] != first[:-1]) | (second[1:] != second[:-1]), open_)
        levels.append(rank)
        step *= 2
    a, b = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        fits = (x < end[a]) & (y < end[b]) & (doc[a] == doc[b])
        equal = fits & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)])
        common += equal * (1 << k)
    out = np.zeros(n, np.int64)
    out[a] = common
    out[b] = np.maximum(out[b], common)
    return out


def covered(lengths: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of each document's words lie in the passages of these lengths from their words on."""
    inside = np.arange(len(lengths)) < np.maximum.accumulate(np.where(lengths > 0, np.arange(len(lengths)) + lengths, 0))
    return np.diff(np.concatenate([[0], np.cumsum(inside)])[at])


def repeated_lines(text: str) -> int:
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            count += line in seen
            seen.add(line)
    return count


MEASURES = [T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat",
)]
SPANS = T.StructField("repeats", T.ArrayType(T.ArrayType(T.LongType())))


def _measure(least: int, spans: bool):
    def kernel(texts: list[str]) -> list[list]:
        words, at = word_hashes([x.encode() for x in texts])
        lengths = longest_repeats(words, at)
        threes = covered(np.where(lengths >= 3, 3, 0), at)
        long = np.where(lengths >= least, lengths, 0)
        longest = [int(long[a:b].max(initial=0)) for a, b in zip(at[:-1], at[1:])]
        out = [
            np.diff(at), [len(x) - sum(map(x.count, BLANKS)) for x in texts], [sum(map(x.count, SYMBOLS)) for x in texts],
            [repeated_lines(x) for x in texts], threes, covered(long, at), longest,
        ]
        if spans:
            # A repeat is maximal if it isn't the rest of the one from the word before.
            maximal = (long > 0) & (np.concatenate([[0], long[:-1]]) <= long)
            out.append([[[int(k), int(long[a + k])] for k in np.flatnonzero(maximal[a:b])] for a, b in zip(at[:-1], at[1:])])
        return out

    return kernel


def measured(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS, spans: bool = True) -> DataFrame:
    """docs without its text, and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered, longest_repeat, repeats.

    repeats, left out without spans, lists maximal repeated passages as [first word, words]. Null texts count as empty and measure 0. Columns of docs
    with these names are replaced; rows are measured one by one, so repeated rows and ids don't matter.
    """
    return by_text(docs, text, [*MEASURES, SPANS] if spans else MEASURES, _measure(least, spans))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def passes(most_covered: float = MOST_COVERED, most_longest: float = MOST_LONGEST) -> Column:
    """The verdict: no base failure, and neither the repeats' union nor the longest of them over its limit."""
    fits = (F.col("n_covered") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= most_longest * F.col("n_words"))
    return ~base_failed() & fits


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, spans: bool = True) -> DataFrame:
    """(id, the measures, repeats if spans, base_failed, kept) for every row; null and empty texts have no words and fail."""
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_body"))
    out = measured(rows, "_body", least, spans).withColumn("base_failed", base_failed()).withColumn("kept", passes())
    return out.withColumnRenamed("_id", id)


def keep_good(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """The rows of docs that pass, with docs' own columns, whatever their names."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_body"))
    return measured(packed, "_body", least, spans=False).where(passes()).select("_row.*")

"""Substring dedup: word passages that started earlier in the corpus.

Method: relative Lempel-Ziv parsing. The pieces of each block (see `repeats`) in the order of the
corpus are its reference, indexed by the first place of every window. A piece is factored greedily
against all that stands earlier in the reference: at each word the longest match of the indexed
place is the factor, else the word is a literal. Factors of `length` words or more are duplicate
spans. A factor may end where another source would have gone on, so parsing continues `length` - 1
words before its end: windows across the boundary are looked up as well.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from evalspark.llm import repeats
from evalspark.llm.texts import mixed, span_hashes, word_bytes

GRAM = 6
WORDS = word_bytes(alphanumeric=False)


def repeated_spans(pieces: repeats.Pieces, length: int):
    """(piece, first word in it, words) of the factors that are duplicates."""
    order, group = pieces.classes()
    lead = np.concatenate(([True], np.diff(group) > 0))
    sizes = np.diff(pieces.at)
    gone = order[~lead]  # whole pieces seen before
    rows = order[lead]
    rows = rows[np.lexsort((pieces.start[rows], pieces.doc[rows]))]
    text = pieces.take(rows)
    width = np.diff(text.at)
    piece = np.repeat(np.arange(len(rows)), width)
    windows = np.flatnonzero(np.arange(len(text.values)) + length <= text.at[1:][piece])
    h = span_hashes(text.values, windows, windows + length)
    by_hash = np.argsort(h, kind="stable")  # stable: the first place in the corpus comes first
    new = np.concatenate(([True], np.diff(h[by_hash]) != 0))
    first = by_hash[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
    source = np.full(len(text.values), -1, np.int64)
    source[windows[by_hash]] = windows[first]
    source[source == np.arange(len(source))] = -1
    found: list[tuple[int, int, int]] = []
    known = np.flatnonzero(source >= 0)
    values, ends, at, i = text.values, text.at, -1, 0
    while i < len(known):
        at = int(known[i])
        p = int(piece[at])
        src = int(source[at])
        most = int(min(ends[p + 1] - at, ends[piece[src] + 1] - src))
        differ = np.flatnonzero(values[at + length : at + most] != values[src + length : src + most])
        size = length + (int(differ[0]) if len(differ) else most - length)
        found.append((p, at - int(ends[p]), size))
        i = int(np.searchsorted(known, at + size - length + 1))
    spans = np.array(found, np.int64).reshape(-1, 3)
    return (
        np.concatenate((gone, rows[spans[:, 0]])),
        np.concatenate((np.zeros(len(gone), np.int64), spans[:, 1])),
        np.concatenate((sizes[gone], spans[:, 2])),
    )


def _tokens(texts):
    starts, ends, first = texts.words(WORDS)
    return span_hashes(texts.data, starts, ends), first


def _grams(words: np.ndarray) -> np.ndarray:
    n = len(words) - GRAM + 1
    h = words[:n].copy()
    for j in range(1, GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[j : j + n]
    return mixed(h)


def _keep(text: bytes, starts, ends):
    words = text.split()  # bytes split at the same six white-space characters
    at, parts = 0, []
    for a, b in zip(starts.tolist(), ends.tolist()):
        parts += words[at:a]
        at = b
    return len(words), b" ".join(parts + words[at:])


def substring_dedup(docs: DataFrame, length: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens (words), spans (maximal removed word ranges) and kept (the other words,
    joined by one space, UTF-8) of each document. A word goes if a window of `length` words over it
    also starts earlier: in a document with a smaller doc_id, or before it in the same one. Words
    are compared by 64-bit hashes.

    Null and empty texts: no words. A null doc_id ranks behind all others. Rows of one doc_id are
    parts of one document, in the order of their texts. Other columns are ignored; an empty table
    gives no rows.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be {GRAM + 2} words at least")
    rule = repeats.Rule(length, GRAM, _tokens, _grams, True, lambda p: repeated_spans(p, length), _keep)
    return repeats.without_repeats(docs, rule, "uint64", doc_id, text)

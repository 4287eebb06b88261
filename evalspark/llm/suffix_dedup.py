"""Suffix-array dedup: byte passages that a document with a smaller doc_id holds as well.

Method: threshold-bounded interval expansion. Each block (see `repeats`) builds the
Burrows-Wheeler transform of its pieces and derives common-prefix lengths breadth first: level l
holds the suffix intervals of strings of l bytes, backward extension by every byte in front of an
interval gives level l + 1, and an interval that starts where no length is known yet sets it to l.
After `length` levels every place still unset joins suffixes that agree in `length` bytes at
least; deeper levels are never visited.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from evalspark.llm import repeats
from evalspark.llm.texts import mixed

GRAM = 20


def sorted_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of whole numbers >= 0, and the numbers in it. Key and place are sorted as one
    number where both fit, several times faster than an order of places."""
    n = len(keys)
    bits = n.bit_length()
    if n and int(keys.max()).bit_length() + bits > 63:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    both = np.sort(keys.astype(np.int64) << bits | np.arange(n))
    return both & ((1 << bits) - 1), both >> bits


def suffix_order(values: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of `values` (0: end of a piece) in the order of their first `depth` values or
    more, by doubling: ranks by 4 values, then by pairs of ranks."""
    n = len(values)
    padded = np.concatenate((values, np.zeros(4, values.dtype))).astype(np.int64)
    rank, reach = np.zeros(n, np.int64), 4
    for j in range(4):
        rank = rank << 9 | padded[j : j + n]
    while True:
        order, ordered = sorted_places(rank)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
        if reach >= depth:
            return order
        behind = np.zeros(n, np.int64)
        behind[:-reach] = rank[reach:] + 1
        rank = rank * (n + 1) + behind
        reach *= 2


def shared_starts(values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix order, and where in it a new group of suffixes equal in `length` values begins.
    It holds for suffixes without a piece end (0) in these values."""
    order = suffix_order(values, length)
    before = values[order - 1]  # the transform; the last value is an end, so -1 is one
    by_value = np.argsort(before, kind="stable")
    back = np.empty(len(values), np.int64)
    back[by_value] = np.arange(len(values))
    known = np.zeros(len(values) + 1, bool)
    known[-1] = True
    counts = np.bincount(values, minlength=257)
    edges = np.concatenate(([0], np.cumsum(counts)))
    live = np.flatnonzero(counts[1:]) + 1
    low, size = edges[live], counts[live]
    for level in range(length):
        fresh = ~known[low]
        low, size = low[fresh], size[fresh]
        known[low] = True
        if level == length - 1 or not len(low):
            break
        one = low[size == 1]
        single = back[one[before[one] > 0]]
        low, size = low[size > 1], size[size > 1]
        shift = np.cumsum(size) - size
        at = np.repeat(low - shift, size) + np.arange(size.sum())
        key = np.repeat(np.arange(len(low)), size) * 257 + before[at]
        at, key = at[before[at] > 0], key[before[at] > 0]
        by_key, key = sorted_places(key)
        first = np.flatnonzero(np.concatenate(([True], np.diff(key) > 0))) if len(key) else by_key
        low = np.concatenate((single, back[at[by_key[first]]]))
        size = np.concatenate((np.ones(len(single), np.int64), np.diff(np.append(first, len(key)))))
    known[0] = True
    return order, known[:-1]


def in_company(texts: repeats.Pieces, length: int) -> np.ndarray:
    """The texts whose anchor, the least hash in their first `length` bytes, is that of another."""
    grams = np.append(_grams(texts.values) >> np.uint64(32), np.uint64(0))
    bounds = np.stack((texts.at[:-1], texts.at[:-1] + length - GRAM + 1), 1).ravel()
    least = np.minimum.reduceat(grams, bounds)[::2]
    order = np.argsort(least)
    same = least[order][1:] == least[order][:-1]
    return np.sort(order[np.append(same, False) | np.append(False, same)])


def repeated_spans(pieces: repeats.Pieces, length: int):
    """(piece, first byte in it, bytes) of every run of windows with a copy in a smaller doc."""
    order, group = pieces.classes()
    lead = order[np.flatnonzero(np.concatenate(([True], np.diff(group) > 0)))]
    later = pieces.doc[order] > pieces.doc[lead[group]]
    sizes = np.diff(pieces.at)
    gone = order[later]
    found = [(gone, np.zeros(len(gone), np.int64), sizes[gone])]
    # One text of each class, under its smallest document, if another class has its anchor: a class
    # without such company shares no window with one.
    classes = in_company(pieces.take(lead), length)
    if not len(classes):
        return tuple(np.concatenate(x) for x in zip(*found))
    texts = pieces.take(lead[classes])
    width = np.diff(texts.at)
    shift = texts.at[:-1] + np.arange(len(classes))
    values = np.zeros(len(texts.values) + len(classes), np.int16)
    inside = np.repeat(shift - texts.at[:-1], width) + np.arange(len(texts.values))
    values[inside] = texts.values.astype(np.int16) + 1
    owner = np.repeat(np.arange(len(classes)), width + 1)
    ahead = np.repeat(shift + width, width + 1) - np.arange(len(values))  # bytes up to the end
    suffixes, start = shared_starts(values, length)
    full = ahead[suffixes] >= length
    at = suffixes[full]
    number = np.cumsum(start)[full]
    new = np.flatnonzero(np.concatenate(([True], np.diff(number) > 0)))
    doc = texts.doc[owner[at]]
    least = np.repeat(np.minimum.reduceat(doc, new), np.diff(np.append(new, len(at))))
    hit = np.sort(at[least < doc])
    if len(hit):
        new = np.flatnonzero(np.concatenate(([True], (np.diff(hit) > 1) | (np.diff(owner[hit]) > 0))))
        first, last = hit[new], hit[np.append(new[1:], len(hit)) - 1]
        # The same for every place of that text in its smallest document.
        own = order[~later]
        own_class = group[~later]
        bounds = np.searchsorted(own_class, [classes[owner[first]], classes[owner[first]] + 1])
        copies = bounds[1] - bounds[0]
        row = np.repeat(bounds[0] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        found.append((own[row], np.repeat(first - shift[owner[first]], copies), np.repeat(last - first + length, copies)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _tokens(texts):
    return texts.data, np.append(texts.starts, len(texts.data))


def _grams(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each byte on, from three overlapping words of eight bytes."""
    held = np.concatenate((data, np.zeros(8, np.uint8)))
    words = np.lib.stride_tricks.as_strided(held.view(np.uint8)[:8].view(np.uint64), (len(data),), (1,))
    n = len(data) - GRAM + 1
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15) ^ words[8 : n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    return mixed(h ^ words[GRAM - 8 : n + GRAM - 8] * np.uint64(0x165667B19E3779F9))


def _keep(text: bytes, starts, ends):
    at, parts = 0, []
    for a, b in zip(starts.tolist(), ends.tolist()):
        parts.append(text[at:a])
        at = b
    return len(text), b"".join([*parts, text[at:]])


def suffix_dedup(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens (bytes), spans (maximal removed byte ranges) and kept (the other bytes,
    which may cut a character) of each document. A byte goes if it lies in a string of `length`
    bytes that also starts in a document with a smaller doc_id, judged on the input.

    Null and empty texts: no bytes, nothing removed. A null doc_id ranks behind all others. Rows of
    one doc_id do not remove each other. Other columns are ignored; an empty table gives no rows.
    """
    if length < GRAM + 2:
        raise ValueError(f"length must be {GRAM + 2} bytes at least")
    rule = repeats.Rule(length, GRAM, _tokens, _grams, False, lambda p: repeated_spans(p, length), _keep)
    return repeats.without_repeats(docs, rule, "uint8", doc_id, text)

"""Benchmark decontamination: which documents repeat passages of benchmark items.

Method: an FM-index per training shard. A shard is about 1 MB of documents inside one task; its
text is the sequence of words that the benchmark knows, with a break at every other word and every
document end. The shard's Burrows-Wheeler transform is kept as a wavelet matrix; all test phrases
are searched backward in it at once by its ranks, occurrences are located by walking back to the
next sampled suffix position, and their word spans are merged per document. Nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from evalspark.llm.rows import put_back, set_aside
from evalspark.llm.texts import LOWER, Texts, slices, span_hashes, texts_of, word_bytes

WORDS = word_bytes(alphanumeric=True)
#: Bytes of benchmark texts searched in one pass over the documents; more are more passes.
PASS_BYTES = 8 << 20
SHARD_BYTES = 1 << 20
SAMPLE_EVERY = 8

HITS = "array<struct<start: bigint, end: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class Index:
    """FM-index over symbols 1 to `top`; 0 is a break, and no match crosses one."""

    def __init__(self, symbols: np.ndarray, top: int):
        order = _suffixes(symbols, top)
        n = len(symbols)
        counts = np.bincount(symbols, minlength=top + 1)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        before = symbols[order - 1]  # the text ends with a break, so -1 is one
        # Positions are sampled, and so is every start behind a break: no walk has to cross one.
        sampled = (order % SAMPLE_EVERY == 0) | (before == 0)
        self.sampled, self.positions = sampled, order[sampled]
        self.sample_rank = np.concatenate(([0], np.cumsum(sampled)))
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        level = before
        for bit in range(self.bits - 1, -1, -1):
            is_one = (level >> bit & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(is_one, dtype=np.int32))))
            self.zeros.append(n - int(self.ones[-1][-1]))
            level = np.concatenate((level[~is_one], level[is_one]))
        self.base = self._down(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, bit in enumerate(range(self.bits - 1, -1, -1)):
            ones = self.ones[k][at]
            at = np.where(symbol >> bit & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before that place of the transform."""
        return self._down(symbol, at) - self.base[symbol]

    def back(self, at: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one symbol earlier."""
        symbol = np.zeros(len(at), np.int64)
        for k in range(self.bits):
            ones = self.ones[k][at]
            one = self.ones[k][at + 1] > ones
            symbol = symbol << 1 | one
            at = np.where(one, self.zeros[k] + ones, at - ones)
        return self.first[symbol] + at - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """Rows [low, high) of each phrase (phrases: one a row, filled up with 0 in front)."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.first[-1], np.int64)
        live = np.arange(len(phrases))
        for step in range(phrases.shape[1]):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = phrases[live, -1 - step]
            low[live] = self.first[symbol] + self.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        found, steps = np.full(len(rows), -1, np.int64), 0
        live, at = np.arange(len(rows)), rows
        while len(live):
            here = self.sampled[at]
            found[live[here]] = self.positions[self.sample_rank[at[here]]] + steps
            live, at = live[~here], self.back(at[~here])
            steps += 1
        return found


def _suffixes(symbols: np.ndarray, top: int) -> np.ndarray:
    """The whole suffix order, by doubling; breaks differ from each other, by place. Only suffixes
    still tied are sorted again."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    breaks = np.flatnonzero(rank == 0)
    rank += len(breaks)
    rank[breaks] = np.arange(len(breaks))
    packed = rank.copy()
    packed[:-1] = packed[:-1] * (top + len(breaks) + 1) + rank[1:]
    packed[-1] *= top + len(breaks) + 1
    packed[breaks] = rank[breaks] * (top + len(breaks) + 1)
    order = np.argsort(packed, kind="stable")
    key, reach = packed[order], 2
    place = np.arange(n)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank[order] = head
    while True:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        some = order[at]
        pair = np.lexsort((rank[np.minimum(some + reach, n - 1)], head[at]))
        order[at] = some = some[pair]
        a, b = head[at], rank[np.minimum(some + reach, n - 1)]
        fresh = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        new[at] = fresh
        head[at] = np.maximum.accumulate(np.where(fresh, at, 0))
        rank[some] = head[at]
        reach *= 2


def _last_null(name: str | None) -> tuple[bool, str]:
    return name is None, name or ""


class Phrases:
    """The windows of some benchmark items, and the items that hold each."""

    def __init__(self, items: list[tuple[str | None, str]], length: int):
        texts = _lowered(texts_of(pa.array([t for _, t in items], pa.large_string())))
        starts, ends, first = texts.words(WORDS)
        hashes = span_hashes(texts.data, starts, ends)
        self.words = np.unique(hashes)
        symbols = np.searchsorted(self.words, hashes) + 1
        holders = defaultdict(set)
        for i, (name, _) in enumerate(items):
            own = symbols[first[i] : first[i + 1]].tolist()
            for at in range(max(1, len(own) - length + 1)) if own else ():
                holders[tuple(own[at : at + length])].add(name)
        self.items = [sorted(x, key=_last_null) for x in holders.values()]
        self.lengths = np.array([len(p) for p in holders], np.int64)
        self.rows = np.zeros((len(holders), length), np.int64)
        for i, p in enumerate(holders):
            self.rows[i, length - len(p) :] = p

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the words from 1 on, 0 for words that no item has."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at + 1, 0)


def _lowered(texts: Texts) -> Texts:
    return Texts(LOWER[texts.data], texts.starts, texts.ends)


def shard_hits(texts: Texts, phrases: Phrases):
    """(words of each document, document, first word in it, length, phrase) of all occurrences."""
    starts, ends, first = _lowered(texts).words(WORDS)
    n = np.diff(first)
    none = np.zeros(0, np.int64)
    if not len(starts) or not len(phrases.rows):
        return n, none, none, none, none
    symbol = phrases.symbols(span_hashes(LOWER[texts.data], starts, ends))
    # A document end is a break too: number the words with a gap before each document.
    doc = np.repeat(np.arange(len(n)), n)
    word = np.arange(len(symbol))
    known = np.flatnonzero(symbol)
    if not len(known):
        return n, none, none, none, none
    spread = word + doc
    gap = np.concatenate(([True], np.diff(spread[known]) > 1))
    at = np.arange(len(known)) + np.cumsum(gap)
    text = np.zeros(at[-1] + 2, np.int64)
    text[at] = symbol[known]
    index = Index(text, len(phrases.words))
    low, high = index.search(phrases.rows, phrases.lengths)
    found = np.flatnonzero(low < high)
    times = (high - low)[found]
    phrase = np.repeat(found, times)
    rows = np.repeat(low[found] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    place = np.searchsorted(at, index.locate(rows))
    word = known[place]
    return n, doc[word], word - first[doc[word]], phrases.lengths[phrase], phrase


def _search(phrases: Phrases):
    def batches(parts):
        for batch in parts:
            for a, b in slices(batch["text"], SHARD_BYTES):
                part = batch.slice(a, b - a)
                n, doc, start, size, phrase = shard_hits(texts_of(part["text"]), phrases)
                order = np.lexsort((start, doc))
                edges = np.searchsorted(doc[order], np.arange(len(n) + 1))
                spans, items = part["spans"].to_pylist(), part["items"].to_pylist()
                for d in np.unique(doc):
                    own = order[edges[d] : edges[d + 1]]
                    earlier = [(s["start"], s["end"]) for s in spans[d]]
                    spans[d] = _merged(earlier + list(zip(start[own].tolist(), (start + size)[own].tolist())))
                    items[d] = sorted({*items[d], *(i for p in set(phrase[own].tolist()) for i in phrases.items[p])}, key=_last_null)
                for name, column in (("n_words", pa.array(n, pa.int64())), ("spans", pa.array(spans, _SPANS)), ("items", pa.array(items, pa.list_(pa.string())))):
                    part = part.set_column(part.schema.get_field_index(name), name, column)
                yield part

    return batches


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], b)
        else:
            out.append({"start": a, "end": b})
    return out


def _passes(benchmark: DataFrame, item_id: str, text: str):
    """Benchmark items in lists of bounded size, brought over one after the other."""
    held, size = [], 0
    chosen = benchmark.select(F.col(item_id).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    for name, body in chosen.toLocalIterator():
        if held and size + len(body) > PASS_BYTES:
            yield held
            held, size = [], 0
        held.append((name, body))
        size += len(body)
    yield held


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    length: int = 13,
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """The documents with n_words, n_hit (words in any occurrence), spans (merged word ranges),
    items (ids as strings, sorted, whose windows occur) and contaminated (one word in 20 is hit).

    A window is `length` consecutive words of an item, or all words of a shorter one. Null and
    empty texts have no words and are never contaminated; items without words search for nothing;
    repeated items count once, and so do all items without an id: they hit like any other and stand
    as one null at the end of `items`. Repeated documents are judged alike. Columns of `docs` named
    like a result are replaced, all others are kept, whatever their names. The benchmark is a query set: it is
    brought to the tasks in lists of at most PASS_BYTES, one pass over the documents for each.
    """
    results = ("n_words", "n_hit", "spans", "items", "contaminated")
    kept = docs.drop(*results).columns
    # A text that is a string rides once, under its working name.
    apart = [c for c in kept if c != text or docs.schema[c].dataType != StringType()]
    empty = {x: F.coalesce(F.lit(None).cast(t), F.array().cast(t)) for x, t in (("spans", HITS), ("items", "array<string>"))}
    found = docs.select(
        *set_aside(apart),
        F.col(text).cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        *[v.alias(x) for x, v in empty.items()],
    )
    for items in _passes(benchmark, item_id, text):
        found = found.mapInArrow(_search(Phrases(items, length)), found.schema)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    found = found.withColumn("n_hit", hit)
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    own = dict(zip(apart, put_back(apart)))
    return found.withColumn("contaminated", bad).select(*[own.get(c, F.col("text").alias(c)) for c in kept], *results)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged in all their columns."""
    text = options.pop("text", "text")
    apart = docs.select(F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
    found = find_contamination(apart, benchmark, **options)
    return found.where(~F.col("contaminated")).select("row.*")

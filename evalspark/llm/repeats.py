"""Where passages of a corpus repeat: route every window of `length` tokens to one block.

The work that two repeat operators share. A document is a sequence of tokens (bytes or word
hashes). Each window of `length` tokens has one anchor: the smallest hash among its runs of `gram`
tokens. The anchor follows from the window's tokens alone, so equal windows have equal anchors
wherever they stand. Consecutive windows with one anchor form a piece, and a block holds all
pieces whose anchors fall to it: whatever may repeat meets in one block, which a solver then
judges on its own.

1. anchors: blocks of documents name their anchors, four bytes each, per bucket of anchors; those
   met twice come back. Each block of documents names an anchor at most NAMED times.
2. pieces: a block of documents sends the pieces of these anchors. Of equal pieces in one block of
   documents only the earliest goes on, the others are settled at once; so a passage that a third
   of all documents share sends one piece per block of documents.
3. solve: each lot of anchors judges its pieces, SOLVE_BYTES of them at once.
4. apply: the spans go back to their documents.

An anchor named HOT times stands in so many different surroundings that its pieces would fill a lot.
They are cut by the place of the anchor in the window, CUT windows each, and what these windows have
in common takes the place of the anchor: pieces then meet that differ in CUT - 1 tokens at either end.

The blocks of documents follow the size of the corpus, buckets and lots at a small part of it: a block
sends a row to each of them, so that their number would make the rows grow with the square of the
corpus. A row holds the arrays of all its pieces. The documents are shuffled once; the three steps
that read them by block share that exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.texts import Texts, int64s, mixed, slices, span_hashes, texts_of

BLOCK_BYTES = 2 << 20
#: Bytes of documents whose arrays are held at once.
SLICE_BYTES = 1 << 18
#: Buckets of anchors: one for each block of documents up to this many, beyond that one for BLOCK_SHARE.
BUCKETS = 256
BLOCK_SHARE = 32
#: Lots of pieces for each bucket of anchors: pieces overlap.
PIECE_LOTS = 4
#: Bytes of pieces that a solver, which needs many arrays, gets at once; one part of 256 of a lot at least.
SOLVE_BYTES = 1 << 19
#: A block of documents names an anchor so often at most, and one named so often in all is hot.
NAMED = 8
HOT = 4096
#: Windows in a piece of a hot anchor.
CUT = 4
#: A row's part: rows of one doc_id count as parts of one document, this far apart.
PART = 1 << 40
NO_ID = (1 << 63) - 1
#: The low bits of an anchor key hold a position in its slice, the high ones the hash.
POSITION_BITS = 32


@dataclass(frozen=True)
class Rule:
    """tokens: Texts -> (tokens, first token of each document plus the end). grams: tokens ->
    hash of the run of `gram` tokens that starts at each. within: repeats inside one document
    count. solve: Pieces -> spans. keep: (text, spans) -> (tokens in all, bytes that remain)."""

    length: int
    gram: int
    tokens: Callable
    grams: Callable
    within: bool
    solve: Callable
    keep: Callable


@dataclass
class Pieces:
    """The pieces of one block. Piece i stands in document doc[i] from token start[i] on and is
    values[at[i]:at[i + 1]]."""

    doc: np.ndarray
    start: np.ndarray
    at: np.ndarray
    values: np.ndarray

    def take(self, rows: np.ndarray) -> Pieces:
        sizes = np.diff(self.at)[rows]
        at = np.concatenate(([0], np.cumsum(sizes)))
        index = np.repeat(self.at[rows] - at[:-1], sizes) + np.arange(at[-1])
        return Pieces(self.doc[rows], self.start[rows], at, self.values[index])

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the pieces by (contents, doc, start), and the class number of each in it."""
        sizes = np.diff(self.at)
        h = span_hashes(self.values, self.at[:-1], self.at[1:])
        order = np.lexsort((self.start, self.doc, sizes, h))
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (sizes[order][1:] != sizes[order][:-1])
        return order, np.cumsum(new) - 1


def packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary column: row i holds values[edges[i]:edges[i + 1]]."""
    offsets = np.asarray(edges * values.itemsize, np.int32)
    held = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, held)


def unpacked(column: pa.Array | pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row holds."""
    held = texts_of(column)
    return held.data.view(kind), (held.ends - held.starts) // np.dtype(kind).itemsize


def edges_of(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end of the last."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def runs(rule: Rule, texts: Texts):
    """(document, first token, anchor's place, tokens, anchor) of the pieces of some documents, with
    the tokens and the first token of each document. Places count from the first document."""
    tokens, first = rule.tokens(texts)
    n = len(tokens)
    none = np.zeros(0, np.int64)
    if n < rule.length:
        return none, none, none, none, none.astype(np.uint64), tokens, first
    grams = rule.grams(tokens)
    keys = grams >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)
    keys |= np.arange(len(grams), dtype=np.uint64)
    left, reach = rule.length - rule.gram + 1, 1
    while reach < left:
        step = min(reach, left - reach)
        keys = np.minimum(keys[:-step], keys[step:])
        reach += step
    last = np.repeat(first[1:] - rule.length, np.diff(first))[: len(keys)]
    window = np.flatnonzero(np.arange(len(keys)) <= last)
    if not len(window):
        return none, none, none, none, none.astype(np.uint64), tokens, first
    where = (keys[window] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    last = np.append(new[1:], len(window)) - 1
    start = window[new]
    return (
        np.searchsorted(first, start, "right") - 1,
        start,
        where[new],
        window[last] - start + rule.length,
        mixed(grams[where[new]]),
        tokens,
        first,
    )


def cut(rule: Rule, start: np.ndarray, where: np.ndarray, size: np.ndarray, tokens: np.ndarray):
    """(piece, first token, tokens, hash of what its windows share) of the parts of pieces of hot anchors."""
    windows = size - rule.length + 1
    piece = np.repeat(np.arange(len(start)), windows)
    at = start[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
    part = (where[piece] - at) // CUT
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (part[1:] != part[:-1])
    new = np.flatnonzero(new)
    begin = where[piece[new]] - part[new] * CUT
    shared = span_hashes(tokens, begin, begin + rule.length - CUT + 1)
    return piece[new], at[new], np.diff(np.append(new, len(piece))) + rule.length - 1, shared


def block_count(docs: DataFrame, text: str) -> int:
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-total // BLOCK_BYTES))


def _parts(ids: np.ndarray, texts: Texts) -> np.ndarray:
    """Numbers the rows of one doc_id in the order of their texts."""
    part = np.zeros(len(ids), np.int64)
    order = np.argsort(ids, kind="stable")
    same = np.flatnonzero(ids[order][1:] == ids[order][:-1])
    for i in np.unique(ids[order][same]):
        rows = np.flatnonzero(ids == i)
        part[sorted(rows, key=texts.text)] = np.arange(len(rows))
    return part


def bucket_count(blocks: int) -> int:
    return min(blocks, BUCKETS + blocks // BLOCK_SHARE)


def _names(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of an anchor, and its low half."""
    return (anchor >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | anchor & np.uint64(0xFFFFFFFF)


NAME_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("anchors", pa.binary()), ("hot", pa.binary())])
NAME_DDL = "block bigint, bucket bigint, anchors binary, hot binary"


def _name_anchors(rule: Rule, buckets: int):
    def name(table: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for a, b in slices(table["text"], SLICE_BYTES):
            doc, _, _, _, anchor, _, _ = runs(rule, texts_of(table["text"].slice(a, b - a)))
            names = _names(anchor, buckets)
            if not rule.within:
                # Once a row: a slice has fewer than 65,536 that hold a window.
                number = np.zeros(len(doc), np.uint64)
                number[1:] = np.cumsum(doc[1:] != doc[:-1])
                pairs = np.sort(names << np.uint64(16) | number)
                names = pairs[edges_of(pairs)[:-1]] >> np.uint64(16) if len(pairs) else names
            found.append(_few(np.sort(names)))
        names = _few(np.sort(np.concatenate(found)))
        bucket = (names >> np.uint64(32)).astype(np.int64)
        edges = edges_of(bucket)
        n = len(edges) - 1
        block = pa.array(np.full(n, table["block"][0].as_py(), np.int64))
        held = packed(names.astype(np.uint32), edges)
        return pa.table([block, pa.array(bucket[edges[:-1]]), held, pa.nulls(n, pa.binary())], NAME_SCHEMA)

    return name


def _few(values: np.ndarray) -> np.ndarray:
    """Sorted values, each NAMED times at most."""
    keep = np.ones(len(values), bool)
    keep[NAMED:] = values[NAMED:] != values[:-NAMED]
    return values[keep]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array `known`."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _shared_anchors(hot: int):
    def share(table: pa.Table) -> pa.Table:
        values, counts = unpacked(table["anchors"], np.uint32)
        every = np.sort(values)
        row = np.repeat(np.arange(len(counts)), counts)
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
        columns = [table["block"], table["bucket"]]
        for times in (2, hot):
            known = np.unique(every[times - 1 :][every[times - 1 :] == every[: max(len(every) - times + 1, 0)]])
            keep = new & _among(values, known)
            columns.append(packed(values[keep], np.searchsorted(row[keep], np.arange(len(counts) + 1))))
        return pa.table(columns, NAME_SCHEMA)

    return share


PIECE_SCHEMA = pa.schema(
    [("key", pa.int64()), ("block", pa.int64())] + [(x, pa.binary()) for x in ("docs", "starts", "sizes", "parts", "body")]
)
PIECE_DDL = "key bigint, block bigint, docs binary, starts binary, sizes binary, parts binary, body binary"


def _piece_rows(block: int, key: np.ndarray, part: np.ndarray, pieces: Pieces, kind) -> pa.Table:
    """A row for each key; the pieces are in its order."""
    edges = edges_of(key)
    columns = [
        pa.array(key[edges[:-1]]),
        pa.array(np.full(len(edges) - 1, block, np.int64)),
        packed(pieces.doc, edges),
        packed(pieces.start, edges),
        packed(np.diff(pieces.at).astype(np.int32), edges),
        packed(part.astype(np.uint8), edges),
        packed(pieces.values.astype(kind, copy=False), pieces.at[edges]),
    ]
    return pa.table(columns, PIECE_SCHEMA)


def _send_pieces(rule: Rule, buckets: int, kind: str):
    def known_names(shared: pa.Table, column: str) -> np.ndarray:
        values, counts = unpacked(shared[column], np.uint32)
        bucket = np.repeat(int64s(shared["bucket"], 0).astype(np.uint64), counts)
        return np.sort(bucket << np.uint64(32) | values)

    def send(docs: pa.Table, shared: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return PIECE_SCHEMA.empty_table()
        block = docs["block"][0].as_py()
        known, hot = known_names(shared, "anchors"), known_names(shared, "hot")
        ids = int64s(docs["doc_id"], NO_ID)
        shift = _parts(ids, texts_of(docs["text"])) * PART
        got = []
        for a, b in slices(docs["text"], SLICE_BYTES) if len(known) else ():
            doc, start, where, size, anchor, tokens, first = runs(rule, texts_of(docs["text"].slice(a, b - a)))
            names = _names(anchor, buckets)
            hit = np.flatnonzero(_among(names, known))
            doc, start, where, size, anchor, names = (x[hit] for x in (doc, start, where, size, anchor, names))
            hit = _among(names, hot)
            if hit.any():
                piece, begin, length, h = cut(rule, start[hit], where[hit], size[hit], tokens)
                doc, start, size, anchor = (
                    np.concatenate(x)
                    for x in ((doc[~hit], doc[hit][piece]), (start[~hit], begin), (size[~hit], length), (anchor[~hit], h))
                )
            at = np.concatenate(([0], np.cumsum(size)))
            index = np.repeat(start - at[:-1], size) + np.arange(at[-1])
            got.append((ids[a:b][doc], start - first[doc] + shift[a:b][doc], size, anchor, tokens[index]))
        if not got:
            return PIECE_SCHEMA.empty_table()
        doc, start, size, anchor, values = (np.concatenate(x) for x in zip(*got))
        pieces = Pieces(doc, start, np.concatenate(([0], np.cumsum(size))), values)
        order, group = pieces.classes()
        lead = edges_of(group)[:-1][group]
        if rule.within:
            stays = np.arange(len(order)) == lead
        else:
            stays = doc[order] == doc[order][lead]
        # A negative key: settled, passed on as it is.
        gone = order[~stays]
        settled = pa.table(
            [[x] for x in (-1 - block, block, doc[gone].tobytes(), start[gone].tobytes(), size[gone].astype(np.int32).tobytes(), b"", b"")],
            PIECE_SCHEMA,
        )
        stay = order[stays]
        h = mixed(anchor[stay])
        key, part = (h % np.uint64(buckets * PIECE_LOTS)).astype(np.int64), h >> np.uint64(56)
        by_key = np.lexsort((part, key))
        sent = _piece_rows(block, key[by_key], part[by_key], pieces.take(stay[by_key]), kind)
        return pa.concat_tables([settled, sent]) if len(gone) else sent

    return send


SPAN_SCHEMA = pa.schema([("block", pa.int64())] + [(x, pa.binary()) for x in ("docs", "starts", "sizes")])


def _solved(rule: Rule, pieces: Pieces, part: np.ndarray, most: int):
    """(piece, first token in it, tokens) of all spans, `most` bytes at once; pieces of one part meet."""
    order = np.argsort(part, kind="stable")
    size = np.cumsum(np.diff(pieces.at)[order]) * pieces.values.itemsize
    edges = edges_of(part[order])
    found, i = [], 0
    while i < len(edges) - 1:
        before = size[edges[i] - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(size[edges[i + 1 :] - 1], before + most, "right")) + i)
        rows = order[edges[i] : edges[j]]
        piece, begin, length = rule.solve(pieces.take(rows))
        found.append((rows[piece], begin, length))
        i = j
    return tuple(np.concatenate(x) for x in zip(*found))


def _solve(rule: Rule, kind: str, most: int):
    def solve(table: pa.Table) -> pa.Table:
        doc, counts = unpacked(table["docs"], np.int64)
        start, _ = unpacked(table["starts"], np.int64)
        size = unpacked(table["sizes"], np.int32)[0].astype(np.int64)
        home = np.repeat(int64s(table["block"], 0), counts)
        if table["key"][0].as_py() < 0:
            piece, begin = np.arange(len(doc)), np.zeros(len(doc), np.int64)
        else:
            pieces = Pieces(doc, start, np.concatenate(([0], np.cumsum(size))), unpacked(table["body"], kind)[0])
            piece, begin, size = _solved(rule, pieces, unpacked(table["parts"], np.uint8)[0], most)
        by_home = np.argsort(home[piece], kind="stable")
        piece, begin, size = piece[by_home], begin[by_home], size[by_home]
        edges = edges_of(home[piece])
        columns = [pa.array(home[piece[edges[:-1]]]), *(packed(x, edges) for x in (doc[piece], start[piece] + begin, size))]
        return pa.table(columns, SPAN_SCHEMA)

    return solve


OUT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())]
)
OUT_DDL = "doc_id bigint, n_tokens bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"


NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def merged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the spans; touching spans are one run."""
    order = np.argsort(starts, kind="stable")
    begin, end = starts[order], np.maximum.accumulate((starts + sizes)[order])
    new = np.flatnonzero(np.concatenate(([True], begin[1:] > end[:-1])))
    return begin[new], end[np.append(new[1:], len(begin)) - 1]


def _apply(rule: Rule):
    def apply(docs: pa.Table, spans: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return OUT_SCHEMA.empty_table()
        doc, start, size = (unpacked(spans[c], np.int64)[0] for c in ("docs", "starts", "sizes"))
        order = np.lexsort((start, doc))
        doc, start, size = doc[order], start[order], size[order]
        rows = {x: [] for x in OUT_SCHEMA.names}
        ids = int64s(docs["doc_id"], NO_ID)
        whole = texts_of(docs["text"])
        shift = _parts(ids, whole) * PART
        low, high = np.searchsorted(doc, ids, "left"), np.searchsorted(doc, ids, "right")
        for row, (i, a, b, at) in enumerate(zip(docs["doc_id"].to_pylist(), low.tolist(), high.tolist(), shift.tolist())):
            text, cut_out = whole.text(row), NOTHING
            if b > a:
                lo, hi = a + np.searchsorted(start[a:b], [at, at + PART])
                if hi > lo:
                    cut_out = merged(start[lo:hi] - at, size[lo:hi])
            n, kept = rule.keep(text, *cut_out)
            rows["doc_id"].append(i)
            rows["n_tokens"].append(n)
            rows["spans"].append([{"start": s, "end": e} for s, e in zip(cut_out[0].tolist(), cut_out[1].tolist())])
            rows["kept"].append(kept)
        return pa.table(rows, OUT_SCHEMA)

    return apply


def without_repeats(docs: DataFrame, rule: Rule, kind: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, spans (removed token ranges, maximal, in order) and kept (binary) of each
    document. `kind` is the numpy type of the tokens."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks = block_count(docs, "text")
    placed = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    grouped = placed.groupBy("block")
    buckets = bucket_count(blocks)
    named = grouped.applyInArrow(_name_anchors(rule, buckets), NAME_DDL)
    shared = named.groupBy("bucket").applyInArrow(_shared_anchors(HOT), NAME_DDL)
    sent = placed.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_send_pieces(rule, buckets, kind), PIECE_DDL)
    solved = sent.groupBy("key").applyInArrow(_solve(rule, kind, SOLVE_BYTES), "block bigint, docs binary, starts binary, sizes binary")
    return placed.groupBy("block").cogroup(solved.groupBy("block")).applyInArrow(_apply(rule), OUT_DDL)

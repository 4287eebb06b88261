"""Mixing sources to target weights.

Method: Sainte-Lague apportionment. All words of the corpus are dealt as equal blocks: each source
gets blocks by the highest quotients target / (2 k + 1), and its blocks go to its shards by the same
rule, so every shard has an integer quota. The documents of a shard are laid end to end in a seeded
order and cut into blocks; a quota takes all blocks as often as it goes round and the rest by a
seeded permutation of the block numbers.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.texts import slices, texts_of, word_bytes
from evalspark.session import materialise

BLOCK_WORDS = 64
#: One shard of a source for so many words, so that no task orders a whole large source.
SHARD_WORDS = 1 << 18
#: A corpus of more than SHARD_WORDS * MAX_SHARDS words has larger shards: the plan stays this short.
MAX_SHARDS = 1 << 16
MOST = 3
#: A mix names a weight for every source; more than this is no mix, and is refused.
MAX_SOURCES = 1_000_000
#: A prime above the number of blocks of any shard: its multiples visit every block once.
STRIDE = 1_000_000_007
WORDS = word_bytes(alphanumeric=False)
#: Bytes of texts whose word spans are held at once.
SLICE_BYTES = 1 << 19


def word_count(text: str):
    r"""Words `[^\x20\x09-\x0D]+` of a text column; null has none."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    spaced = F.trim(F.regexp_replace(body, r"[\x20\x09-\x0D]+", " "))
    gaps = F.octet_length(spaced) - F.octet_length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", 0).otherwise(gaps + 1).cast("long")


def targets(sizes: np.ndarray, weights: np.ndarray, most: int = MOST) -> np.ndarray:
    """Shares of all sizes by weight, none above `most` times its size, the rest reshared."""
    full = np.zeros(len(sizes), bool)
    share = np.zeros(len(sizes))
    while not full.all():
        rest = sizes.sum() - most * sizes[full].sum()
        share = np.where(full, most * sizes, rest * weights / weights[~full].sum())
        over = ~full & (share > most * sizes)
        if not over.any():
            break
        full |= over
    return np.where(full, most * sizes, share).astype(float)


def sainte_lague(claims: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """`seats` dealt one by one to the highest quotient claim / (2 k + 1), ties to the first row,
    none above `most`. All seats that a common divisor gives are dealt at once."""
    seats = int(min(seats, most[claims > 0].sum()))

    def at(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(claims / divisor + 0.5)).astype(np.int64)

    low, high = 0.0, 2.0 * claims.sum() + 1.0  # at `high` nobody has a seat
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (low, middle) if at(middle).sum() <= seats else (middle, high)
    quota = at(high)
    queue = [(-c / (2 * q + 1), i) for i, (c, q, m) in enumerate(zip(claims, quota, most)) if q < m and c > 0]
    heapq.heapify(queue)
    for _ in range(seats - int(quota.sum())):
        _, i = heapq.heappop(queue)
        quota[i] += 1
        if quota[i] < most[i]:
            heapq.heappush(queue, (-claims[i] / (2 * quota[i] + 1), i))
    return quota


def mix_plan(sized: DataFrame, weights: list[float], seed: int, block: int, shard_words: int):
    """A DataFrame (source, shards) and a DataFrame (source, shard, source_size, target, blocks,
    rounds, rest): what to take of each shard. Only one row per source and per shard reaches the
    driver."""
    spark = sized.sparkSession
    rows = sized.groupBy("source").agg(F.sum("size").alias("n")).orderBy(F.asc_nulls_last("source"))
    rows = rows.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources")
    n = np.array([r.n or 0 for r in rows], np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(rows))], float)
    target = targets(n, weight)
    shards = np.maximum(1, -(-n // max(shard_words, int(n.sum()) // MAX_SHARDS)))
    known = spark.createDataFrame(
        [(r.source, int(k)) for r, k in zip(rows, shards)], "source string, shards bigint"
    )
    same = F.col("s.source").eqNullSafe(F.col("k.source"))
    placed = sized.alias("s").join(F.broadcast(known).alias("k"), same).select(
        "s.*", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("k.shards")).alias("shard")
    )
    cells = placed.groupBy("source", "shard").agg(F.sum("size").alias("n")).collect()
    cells = sorted(((r.source, r.shard, r.n or 0) for r in cells), key=lambda r: (r[0] is None, r[0] or "", r[1]))
    number = {r.source: i for i, r in enumerate(rows)}
    owner = np.array([number[c[0]] for c in cells], np.int64)
    words = np.array([c[2] for c in cells], np.int64)
    blocks = -(-words // block)
    quota = np.zeros(len(cells), np.int64)
    if len(cells):
        most = np.bincount(owner, MOST * blocks, len(rows)).astype(np.int64)
        seats = sainte_lague(target, round(target.sum() / block), most)
        edges = np.searchsorted(owner, np.arange(len(rows) + 1))
        for i, k in enumerate(seats):
            own = slice(edges[i], edges[i + 1])
            quota[own] = sainte_lague(words[own].astype(float), int(k), MOST * blocks[own])
    plan = [
        (c[0], int(c[1]), int(n[i]), float(target[i]), int(b), int(q // b) if b else 0, int(q % b) if b else 0)
        for c, i, b, q in zip(cells, owner.tolist(), blocks.tolist(), quota.tolist())
    ]
    ddl = "source string, shard bigint, source_size bigint, target double, blocks bigint, rounds bigint, rest bigint"
    return known, spark.createDataFrame(plan, ddl)


def mix(
    docs: DataFrame,
    weights: list[float] = (1, 2, 3),
    seed: int = 0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The documents with size (words), source_size, target (words its source should give), taken
    (words the mix takes of the document, repeats counted), rounds (how often it is taken whole)
    and parts (word ranges taken once more).

    Sources in code point order, null last, weigh `weights`, repeating. A source's taken words are
    within a block per shard of its target; no document is taken more than 3 times. Null, empty and
    blank texts have no words and are taken 0 times; a source without words has target 0. Documents
    that repeat share their source's quota like any others. The same rows give the same result.
    Columns of `docs` named like a result are replaced, others kept.
    """
    results = ("size", "source_size", "target", "taken", "rounds", "parts")
    held = docs.drop(*results)
    kept = held.columns
    names = {"doc_id": F.col(doc_id), "source": F.col(source).cast("string"), "size": word_count(text)}
    # The plan needs three narrow columns; they are stored once, the texts are read when used.
    rows = held.select(*[F.col(c).alias(f"_{c}") for c in kept], *[v.alias(k) for k, v in names.items()])
    narrow = materialise(rows.select("doc_id", "source", "size"), "sizes")
    laid = _laid(rows, narrow, list(weights), seed, block, shard_words)
    return laid.select(*[F.col(f"_{c}").alias(c) for c in kept], *results)


def _laid(rows: DataFrame, narrow: DataFrame, weights: list[float], seed: int, block: int, shard_words: int) -> DataFrame:
    """`rows` (doc_id, source, size and others) laid into their shards, with what is taken of each;
    `narrow` is the three columns, stored."""
    shards, plan = mix_plan(narrow, weights, seed, block, shard_words)
    # A row per source and a row per shard: MAX_SOURCES and MAX_SOURCES + MAX_SHARDS rows at most.
    placed = rows.alias("p").join(F.broadcast(shards).alias("k"), F.col("p.source").eqNullSafe(F.col("k.source")))
    placed = placed.select("p.*", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.col("k.shards")).alias("shard"))
    cell = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size")
    begin = F.sum("size").over(cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    laid = placed.withColumn("begin", begin)
    at = F.col("l.source").eqNullSafe(F.col("q.source")) & (F.col("l.shard") == F.col("q.shard"))
    laid = laid.alias("l").join(F.broadcast(plan).alias("q"), at).select("l.*", *[f"q.{c}" for c in ("source_size", "target", "blocks", "rounds", "rest")])
    shift = F.pmod(F.xxhash64("source", "shard", F.lit(seed + 2)), F.greatest("blocks", F.lit(1)))
    laid = laid.withColumn("shift", shift)
    parts = F.expr(
        f"""if(size = 0 or rest = 0, array(), transform(
            filter(sequence(begin div {block}, (begin + size - 1) div {block}),
                   j -> (j * {STRIDE} + shift) % blocks < rest),
            j -> struct(greatest(j * {block} - begin, 0L) AS start,
                        least((j + 1) * {block} - begin, size) AS end)))"""
    ).cast("array<struct<start: bigint, end: bigint>>")
    laid = laid.withColumn("parts", parts)
    once = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["end"] - p["start"])
    return laid.withColumn("taken", F.col("rounds") * F.col("size") + once)


def _copies(batches):
    """Each row as often as it is taken whole, and once more with the blocks taken of it."""
    for batch in batches:
        names = [c for c in batch.schema.names if c not in ("rounds", "parts")]
        for a, b in slices(batch["text"], SLICE_BYTES):
            some = batch.slice(a, b - a)
            rounds = some["rounds"].to_numpy(zero_copy_only=False)
            for k in range(int(rounds.max(initial=0))):
                yield some.filter(pa.array(rounds > k)).select(names)
            cut = some.filter(pc.greater(pc.list_value_length(some["parts"]), 0))
            if len(cut):
                at = names.index("text")
                yield cut.select(names).set_column(at, cut.schema.field("text"), _cut(cut))


def _cut(batch: pa.RecordBatch) -> pa.Array:
    """The word ranges of each text, joined by a line end where words between are missing."""
    texts = texts_of(batch["text"])
    starts, ends, first = texts.words(WORDS)
    out = []
    for i, spans in enumerate(batch["parts"].to_pylist()):
        n, base = first[i + 1] - first[i], int(texts.starts[i])
        body, pieces = texts.text(i), []
        for s in spans:
            a = 0 if s["start"] == 0 else int(starts[first[i] + s["start"]]) - base
            b = len(body) if s["end"] == n else int(ends[first[i] + s["end"] - 1]) - base
            if pieces and pieces[-1][1] == s["start"]:
                pieces[-1] = (pieces[-1][0], s["end"], b)
            else:
                pieces.append((a, s["end"], b))
        out.append(b"\n".join(body[a:b] for a, _, b in pieces).decode())
    return pa.array(out, batch.schema.field("text").type)


def mixed(
    docs: DataFrame,
    weights: list[float] = (1, 2, 3),
    seed: int = 0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The mix itself, in the columns of `docs`, whatever their names: a document as often as it is
    taken whole, and once more with the blocks taken of it (in order, joined by a line end where
    blocks between are missing) if only some are.

    Only numbers, ids, sources and sizes are ordered; the texts are stored once with their numbers
    and meet their part of the plan in one join.
    """
    others = [c for c in docs.columns if c != text]
    rows = docs.select(
        F.monotonically_increasing_id().alias("at"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        word_count(text).alias("size"),
        F.col(text).cast("string").alias("text"),
        F.struct(*[F.col(c) for c in others]).alias("row"),
    )
    rows = materialise(rows, "numbered")  # the numbers hold in both uses below
    narrow = rows.select("at", "doc_id", "source", "size")
    taken = _laid(narrow, narrow.drop("at"), list(weights), seed, block, shard_words)
    taken = taken.where("taken > 0").select("at", "rounds", "parts")
    both = rows.select("at", "text", "row").join(taken, "at").drop("at")
    copies = both.mapInArrow(_copies, both.drop("rounds", "parts").schema)
    kind = docs.schema[text].dataType
    return copies.select(*[F.col("text").cast(kind).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])

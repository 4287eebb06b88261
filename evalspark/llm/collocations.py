"""Phrase collocation mining: the frequent phrases of each language that mean more than their parts.

Method: dynamic itemset counting. The corpus is dealt into shards, scanned in a cycle; a round is
one job over one shard. Words are counted from the first round on. A longer phrase is activated
before the round that follows the one in which both its subphrases (without its last, without its
first word) have reached the threshold, so all lengths are counted in the same scans; each phrase is
counted until it has seen every shard once, which makes its count exact.

Which phrases have reached the threshold, and when, is a table of fixed size over hashes, one byte
per slot, the only thing sent to the tasks. Two phrases in one slot make a longer phrase active
earlier than need be, which costs counting and changes no result: a slot never changes once set, so
every phrase has one starting round and one full cycle. Counts are kept by 64-bit keys in a stored
table that a round's partial counts are added to; phrases whose cycle ends below the threshold
leave it. At last the keys that stayed are named from the first shard, and what it lacks from the
next; should two named phrases share a key, all is counted anew with other keys.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.texts import LOWER, Texts, mixed, slices, span_hashes, texts_of
from evalspark.session import discard, scratch_path

#: What ends a piece, and what stands between the words of a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
GAPS = b" \t"
LONGEST, LEAST, MOST = 4, 30, 2000
SHARDS = 2
#: The table of reached phrases has so many slots, as a power of two.
SLOT_BITS = 24
NEVER = 255
SLICE_BYTES = 2 << 20
#: Words whose arrays are held at once; a text of any length goes through in such steps.
STEP_WORDS = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_WORD = ~_BREAK
_WORD[list(GAPS)] = False
_STATE = "key bigint, meta int, n bigint"
_NAMES = "key bigint, lang string, words int, phrase string"
_BLOCK = 1 << 15
RECENT_KEYS = 1 << 20


def _lang_code(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


def _steps(batch, longest: int, step: int, seed: int):
    """Words of a batch in steps: (bytes, starts, ends, piece numbers, keys of the words, language
    numbers, own words). The last longest - 1 words of a step only complete the phrases before."""
    codes: dict[str, int] = {}
    langs = batch["lang"].to_pylist()
    code = np.array([codes.setdefault(x, _lang_code(x, seed)) for x in langs], np.uint64)
    for a, b in slices(batch["text"], SLICE_BYTES):
        texts = texts_of(batch["text"].slice(a, b - a))
        starts, ends, first = texts.words(_WORD)
        for at in range(0, len(starts), step):
            own = min(step, len(starts) - at)
            stop = min(at + own + longest - 1, len(starts))
            low, high = int(starts[at]), int(ends[stop - 1])
            data = LOWER[texts.data[low:high]]
            some = Texts(data, starts[at:stop] - low, ends[at:stop] - low)
            doc = np.searchsorted(first, np.arange(at, stop), "right") - 1
            piece = np.cumsum(_BREAK[data])[some.starts] + doc
            keys = mixed(span_hashes(data, some.starts, some.ends) ^ code[a + doc])
            yield data, some.starts, some.ends, piece, keys, a + doc, own


def _runs(keys: np.ndarray, piece: np.ndarray, longest: int):
    """(length, key of the run that starts at each word, whether it lies in one piece)."""
    run = keys
    for n in range(1, longest + 1):
        if n > 1:
            if len(run) < 2:
                return
            run = mixed(run[:-1] * ODD + keys[n - 1 :])
        yield n, run, piece[: len(run)] == piece[n - 1 :]


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _start(reached: np.ndarray, bits: int, part: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    """The round before which each run is activated, from the keys of the runs one word shorter."""
    if part is None:
        return np.zeros(len(keys), np.uint8)
    times = reached[_slots(part, bits)]
    return np.maximum(times[:-1], times[1:])


def _scan(table, now: int, shards: int, longest: int, step: int, seed: int):
    """Counts of all phrases that are active in this round; meta is starting round * 8 + length."""

    def batches(parts):
        reached = np.frombuffer(table.value, np.uint8)
        bits = len(reached).bit_length() - 1
        for batch in parts:
            codes = {x: _lang_code(x, seed) for x in set(batch["lang"].to_pylist())}
            code = np.array([codes[x] for x in batch["lang"].to_pylist()], np.uint64)
            for _, _, _, piece, words, doc, own in _steps(batch, longest, step, seed):
                held, part = [], None
                if now < shards:  # the words of each language, as a phrase of no words
                    some, words_of = np.unique(code[doc[:own]], return_counts=True)
                    held.append((some, np.zeros(len(some), np.int32), words_of))
                for n, keys, whole in _runs(words, piece, longest):
                    start = _start(reached, bits, part, keys).astype(np.int32)
                    active = whole & (start <= now) & (now < start + shards)
                    active[own:] = False
                    found, at, times = np.unique(keys[active], return_index=True, return_counts=True)
                    held.append((found, start[active][at] * 8 + n, times))
                    part = keys
                keys, meta, times = (np.concatenate(x) for x in zip(*held))
                if len(keys):
                    columns = [keys.view(np.int64), meta.astype(np.int32), times.astype(np.int64)]
                    yield pa.record_batch([pa.array(c) for c in columns], ["key", "meta", "n"])

    return batches


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A string array of byte ranges."""
    size = ends - starts
    offsets = np.concatenate(([0], np.cumsum(size)))
    held = data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(held))


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space behind each, and where each starts."""
    size = ends - starts
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(begin[-1], ord(" "), np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin[:-1], size) + inside] = data[np.repeat(starts, size) + inside]
    return out, begin


def _name(tables, longest: int, step: int, seed: int):
    """Language, length, text and key of all phrases that were counted and whose slot holds a wanted
    key; and every language as a phrase of length 0."""

    def batches(parts):
        reached, wanted = (np.frombuffer(x, np.uint8) for x in tables.value)
        bits, fine = len(reached).bit_length() - 1, len(wanted).bit_length() + 2
        last = np.zeros(RECENT_KEYS, np.uint64)  # keys named last: most repeats end here
        for batch in parts:
            langs = batch["lang"].to_pylist()
            some = sorted(set(langs))
            codes = np.array([_lang_code(x, seed) for x in some], np.uint64)
            yield _named(some, 0, pa.array([""] * len(some)), codes)
            for data, starts, ends, piece, words, doc, own in _steps(batch, longest, step, seed):
                spaced, begin = _spaced(data, starts, ends)
                part = None
                for n, keys, whole in _runs(words, piece, longest):
                    slot = _slots(keys, fine)
                    chosen = whole & (wanted[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1)
                    chosen &= _start(reached, bits, part, keys) != NEVER
                    chosen[own:] = False
                    chosen = np.flatnonzero(chosen)
                    found, at = np.unique(keys[chosen], return_index=True)
                    place = (found % np.uint64(RECENT_KEYS)).astype(np.int64)
                    new = last[place] != found
                    last[place[new]] = found[new]
                    at = chosen[at[new]]
                    text = _strings(spaced, begin[at], begin[at + n] - 1)
                    yield _named([langs[i] for i in doc[at]], n, text, found[new])
                    part = keys

    return batches


def _named(langs: list[str], n: int, text: pa.Array, keys: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(keys.view(np.int64)), pa.array(langs, pa.string()), pa.array(np.full(len(langs), n, np.int32)), text]
    return pa.record_batch(columns, ["key", "lang", "words", "phrase"])


def _bits(keys: DataFrame, slot_bits: int) -> np.ndarray:
    """Which slots the keys have, one bit each, whatever the number of keys."""
    slot = F.shiftrightunsigned("key", 64 - slot_bits)
    blocks = keys.select((slot / _BLOCK).cast("long").alias("block"), (slot % _BLOCK).alias("at"))
    out = np.zeros((1 << slot_bits) // 8, np.uint8)
    for r in blocks.groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits")).collect():
        out[r.block * (_BLOCK // 8) :][: _BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    shards: int = SHARDS,
    lang: str = "lang",
    text: str = "text",
    slot_bits: int = SLOT_BITS,
    step_words: int = STEP_WORDS,
) -> DataFrame:
    """lang, words, phrase and n (all its occurrences) of every phrase of 1 to `longest` words that
    occurs `least` times in its language; and per language a row of 0 words with all its words. `slot_bits` (15 at least) sizes the table that goes
    to the tasks, `step_words` the arrays held there; results do not depend on them."""
    spark = docs.sparkSession
    corpus = scratch_path(spark, "phrase-corpus")
    dealt = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    )
    dealt.write.partitionBy("shard").parquet(corpus)
    staged = spark.read.schema("lang string, text string, shard int").parquet(corpus)
    for seed in count():
        settled, reached, used = _counted(staged, longest, least, shards, slot_bits, step_words, seed)
        names, left = None, settled
        for shard in range(shards):
            tables = spark.sparkContext.broadcast((reached.tobytes(), _bits(left, slot_bits + 3).tobytes()))
            some = staged.where(F.col("shard") == shard).select("lang", "text").mapInArrow(_name(tables, longest, step_words, seed), _NAMES)
            path = scratch_path(spark, "phrase-names")
            some.join(left, "key", "left_semi").distinct().write.parquet(path)
            tables.destroy()
            used.append(path)
            some = spark.read.schema(_NAMES).parquet(path)
            names = some if names is None else names.union(some)
            left = settled.join(names, "key", "left_anti")
            if left.isEmpty():
                break
        known = names.join(settled, "key").select("key", "lang", "words", "phrase", "n")
        if not _shared(known):
            break
        for old in used:
            discard(spark, old)
    path = scratch_path(spark, "phrases")
    known.drop("key").write.parquet(path)
    for old in (*used, corpus):
        discard(spark, old)
    return spark.read.schema("lang string, words int, phrase string, n bigint").parquet(path)


def _counted(staged: DataFrame, longest: int, least: int, shards: int, slot_bits: int, step: int, seed: int):
    """The rounds: keys with their counts, the table of reached phrases, the paths of both."""
    spark = staged.sparkSession
    reached = np.full(1 << slot_bits, NEVER, np.uint8)
    open_, settled, used = None, None, []
    now, end = 0, shards
    while now < end:
        table = spark.sparkContext.broadcast(reached.tobytes())
        scan = _scan(table, now, shards, longest, step, seed)
        found = staged.where(F.col("shard") == now % shards).select("lang", "text").mapInArrow(scan, _STATE)
        both = found if open_ is None else found.union(open_)
        counts = both.groupBy("key", "meta").agg(F.sum("n").alias("n"))
        # The cycle of a phrase ends `shards` rounds after its first.
        over = F.shiftright("meta", 3) + shards <= now + 1
        path = scratch_path(spark, "phrase-counts")
        counts.where(~over | (F.col("n") >= least) | (F.col("meta") == 0)).write.parquet(path)
        stored = spark.read.schema(_STATE).parquet(path)
        table.destroy()
        used.append(path)
        open_ = stored.where(~over)
        settled = stored.where(over) if settled is None else settled.union(stored.where(over))
        bits = _bits(stored.where((F.col("n") >= least) & (F.col("meta") % 8).between(1, longest - 1)), slot_bits)
        new = np.unpackbits(bits, bitorder="little").view(bool) & (reached == NEVER)
        now += 1
        if new.any():
            reached[new] = now
            end = now + shards
    return settled, reached, used


def _shared(known: DataFrame) -> bool:
    """Whether two phrases have one key."""
    return not known.groupBy("key").count().where("count > 1").isEmpty()


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    most: int = MOST,
    covered: int = 80,
    shards: int = SHARDS,
    lang: str = "lang",
    text: str = "text",
    **options,
) -> DataFrame:
    r"""lang, rank, phrase, a, l, r, n, score: the `most` best phrases of each language.

    Texts are lower-cased (A-Z), split at `[.,;:!?\x0A-\x0D]` into pieces and these into words at
    spaces and tabs. a, l, r are the occurrences of the phrase, of its first and of its other part at
    the cut with the lowest score floor(2000000 a / (l + r)), ties to the shortest first part; n is
    the number of words of the language. Phrases inside a longer frequent one with at least `covered`
    percent of their occurrences go. Order: score, then a, both descending, then the phrase's bytes.
    Null texts are empty, a null language is `und`; repeated rows count each; other columns of `docs`
    are ignored, whatever their names; an empty table gives no rows. `options`: see `phrase_counts`.
    """
    counts = phrase_counts(docs, longest, least, shards, lang, text, **options)
    known = counts.where("words > 0").select("lang", "phrase", "n")
    phrases = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("right"),
    )
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # 38 digits: the product of a count and two million passes 64 bits.
    score = F.expr("cast(a as decimal(20, 0)) * cast(2000000 as decimal(7, 0)) div (cast(l as decimal(20, 0)) + r)")
    lowest = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("lowest")
    judged = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    # The largest count of a longer phrase around each phrase.
    size, at = F.sequence(F.lit(2), F.col("words") - 1), F.expr("sequence(1, words - size + 1)")
    parts = phrases.where("words > 2").select("lang", "w", "words", "a", F.explode(size).alias("size"))
    parts = parts.select("lang", "w", "size", "a", F.explode(at).alias("at"))
    around = parts.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    stay = judged.join(around, ["lang", "phrase"], "left")
    stay = stay.where(f"around IS NULL OR 100 * cast(around as decimal(20, 0)) < {int(covered)} * cast(a as decimal(20, 0))")
    # A language may hold most phrases: parts of it name their best first.
    order = (F.desc("lowest.score"), F.desc("a"), "phrase")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stay = stay.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    stay = stay.withColumn("place", best).where(F.col("place") <= most)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = stay.withColumn("rank", place.cast("long")).where(F.col("rank") <= most)
    total = counts.where("words = 0").select("lang", "n")
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score")

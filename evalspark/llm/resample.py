"""Target-distribution importance resampling: draw the documents that look like a target set.

Method: batch concatenation. A batch's texts are joined with separator sentinels and one regex pass
finds all words; document offsets are looked up by searchsorted, and n-grams whose words lie in two
documents are masked before the bucket counts (bincount). Counts of both sides are partial sums per
task; a document's weight is the sum of its features' gains, and a Gumbel key per document turns
"the highest scores" into a draw without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import re
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.llm.texts import LOWER, slices, texts_of
from evalspark.session import materialise

#: Fixed value: what a word is, over bytes of lower-cased UTF-8.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BUCKETS = 10_000
LEAST_WORDS = 20
#: Divides words as every byte outside them does, and stands between two documents of a batch.
SENTINEL = b"\x00"
SLICE_BYTES = 1 << 20
#: Words held at once; a text of any length goes through in such steps.
STEP_WORDS = 1 << 17
_LOWER = LOWER.tobytes()


def features(texts: list[bytes], longest: int, buckets: int, step: int = STEP_WORDS):
    """(document number, bucket, length of the run) arrays of all runs of 1 to `longest` words, in
    steps of bounded size."""
    size = np.array([len(t) for t in texts], np.int64)
    offsets = np.cumsum(size + len(SENTINEL)) - size - len(SENTINEL)
    found = WORD.finditer(SENTINEL.join(texts).translate(_LOWER))
    words: list[bytes] = []
    starts: list[int] = []
    while some := list(islice(found, step)):
        held = min(len(words), longest - 1)  # the last words open runs that end in this step
        words = words[len(words) - held :] + [m[0] for m in some]
        starts = starts[len(starts) - held :] + [m.start() for m in some]
        owner = np.searchsorted(offsets, starts, "right") - 1
        for n in range(1, min(longest, len(words)) + 1):
            runs = words if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(n))))
            codes = np.fromiter(map(crc32, runs), np.int64, len(words) - n + 1)
            first, last = owner[: len(codes)], owner[n - 1 :]
            inside = (first == last) & (np.arange(len(codes)) + n - 1 >= held)
            yield first[inside], codes[inside] % buckets, n


def _parts(column, longest: int, buckets: int):
    """(first row, rows, steps of features) of slices of a text column."""
    for a, b in slices(column, SLICE_BYTES):
        texts = texts_of(column.slice(a, b - a))
        yield a, b - a, features([texts.text(i) for i in range(b - a)], longest, buckets)


def _counts(longest: int, buckets: int):
    def batches(parts):
        total = np.zeros(buckets, np.int64)
        for batch in parts:
            for _, _, steps in _parts(batch["text"], longest, buckets):
                for _, bucket, _ in steps:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    return batches


def _weights(gains: np.ndarray, longest: int):
    def batches(parts):
        for batch in parts:
            n_words, n_features, weight = (np.zeros(len(batch), np.int64) for _ in range(3))
            for row, rows, steps in _parts(batch["text"], longest, len(gains)):
                for owner, bucket, n in steps:
                    count = np.bincount(owner, minlength=rows)
                    n_features[row : row + rows] += count
                    if n == 1:
                        n_words[row : row + rows] += count
                    np.add.at(weight, owner + row, gains[bucket])
            held = [batch[c] for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            added = [pa.array(x) for x in (n_words, n_features, weight)]
            yield pa.record_batch(held + added, names + ["n_words", "n_features", "weight"])

    return batches


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket of a whole table. One row per task and bucket is shuffled; `buckets` rows
    at most reach the driver."""
    body = texts.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = body.mapInArrow(_counts(longest, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of every bucket, in doubles."""
    all_raw, all_target = float(raw.sum() + len(raw)), float(target.sum() + len(raw))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target))) for s, t in zip(raw.tolist(), target.tolist())],
        np.int64,
    )


def gumbel(doc_id: str, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of the id's own u: the same in every run and on every machine."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, seed: int, doc_id: str, text: str, longest: int, extra: Column | None = None) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *([extra.alias("row")] if extra is not None else []), body.alias("text"))
    schema = rows.drop("text").schema
    for c in ("n_words", "n_features", "weight"):
        schema = schema.add(c, "long")
    return rows.mapInArrow(_weights(gain, longest), schema).withColumn("score", F.col("weight") + gumbel("doc_id", seed))


def importance(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    seed: int = 2024,
    longest: int = 1,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document.

    Features are all runs of 1 to `longest` words of the lower-cased (A-Z) text, repeats counted,
    in `buckets` buckets. Of the N documents with `least_words` words, the floor(percent N / 100)
    highest scores are drawn; rank is 1, 2, 3... by score, ties to the smaller doc_id, null for the
    rest. Null, empty and wordless texts have no features and weight 0. A null doc_id draws by the
    seed alone and comes last in ties; rows that share a doc_id are drawn each for itself, and rows
    equal in every result may change places. Other columns of `docs` are ignored, whatever their
    names. Either table may be empty.
    """
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = materialise(scored(docs, gain, seed, doc_id, text, longest), "scores")
    able = F.col("n_words") >= least_words
    drawn = percent * rows.where(able).count() // 100
    # A row's place: its range, and its number in the file that the range was written to.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "weight", "n_features"]
    ranged = rows.where(able).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialise(ranged.withColumn("part", F.spark_partition_id()), "ranked")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = ranged.groupBy("part").agg(F.count("*").alias("n"))
    begin = begin.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    # One row per range: as many as shuffle partitions, at most.
    placed = ranged.select("*", F.col("_metadata.row_index").alias("at")).join(F.broadcast(begin), "part")
    place = F.col("begin") + F.col("at") + 1
    names = ("doc_id", "n_words", "n_features", "weight", "score")
    first = placed.select(*names, F.when(place <= drawn, place).alias("rank"))
    return first.union(rows.where(~able).select(*names, F.lit(None).cast("long").alias("rank")))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 2024, longest: int = 1, least_words: int = LEAST_WORDS, **options) -> DataFrame:
    """The drawn documents in the columns of `docs`, see `importance`. Rows equal in score and
    doc_id to the last drawn one stay with it. Nothing is joined: the last drawn place is the cut."""
    chosen = dict(doc_id=doc_id, text=text, seed=seed, longest=longest)
    last = importance(docs, target, least_words=least_words, **chosen, **options).where("rank IS NOT NULL")
    cut = last.agg(F.max_by(F.struct("score", "doc_id"), "rank").alias("cut")).first().cut
    if cut is None:
        return docs.limit(0)
    buckets = options.get("buckets", BUCKETS)
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, text, longest, buckets))
    rows = scored(docs, gain, seed, doc_id, text, longest, F.struct(*[F.col(c) for c in docs.columns]))
    ahead = F.lit(True) if cut.doc_id is None else F.coalesce(F.col("doc_id") <= F.lit(cut.doc_id), F.lit(False))
    drawn = (F.col("score") > cut.score) | ((F.col("score") == cut.score) & ahead)
    return rows.where((F.col("n_words") >= least_words) & drawn).select("row.*")

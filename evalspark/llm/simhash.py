"""SimHash near-duplicates, found by meeting in the middle.

Method: ball hashing. Two fingerprints within `radius` 2 have a common variant within half of it,
1 bit. So every distinct fingerprint emits itself and its 64 neighbours, the shuffle is on these
variants, and whoever meets at a variant is verified by its differing bits. A variant has 65
fingerprints at most, so no group is large, whatever the number of copies: copies share one
fingerprint and are joined back at the end.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.balls import near_fingerprints
from evalspark.llm.components import components
from evalspark.llm.similar import similar_groups
from evalspark.llm.texts import LOWER, Texts, slices, texts_of
from evalspark.session import materialise

SEED = 42


def fingerprint(text: bytes, words: int) -> int:
    """Majority bits of the shingle hashes of a lower-cased text."""
    w = text.split()  # bytes split at the same six white-space characters
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    shingles = map(b" ".join, zip(*(w[k:] for k in range(words))))
    n = len(w) - words + 1
    h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        some = h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(words: int):
    def batches(parts):
        for batch in parts:
            column, out = batch["text"], []
            for a, b in slices(column):
                some = texts_of(column.slice(a, b - a))
                some = Texts(LOWER[some.data], some.starts, some.ends)
                out += [fingerprint(some.text(i), words) for i in range(len(some))]
            prints = pa.array(np.array(out, np.uint64).view(np.int64))
            yield pa.record_batch([batch["doc_id"], prints], ["doc_id", "fingerprint"])

    return batches


def simhash_groups(docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (long, its 64 bits) and component_id, the smallest doc_id reachable over
    links of at most 2 differing bits.

    Texts of fewer than `words` words have one shingle; null, empty and blank texts have
    fingerprint 0 and link like any other. Rows with a null doc_id get the component of their
    fingerprint (null if no member has an id). Repeated rows stay. Other columns are ignored; an
    empty table gives no rows.
    """
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    prints = chosen.mapInArrow(_fingerprints(words), "doc_id bigint, fingerprint bigint")
    prints = materialise(prints, "fingerprints")
    classes = materialise(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "classes")
    found = components(near_fingerprints(classes), "a", "b")
    known = classes.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    known = known.withColumn("component", F.coalesce("component", "fingerprint"))
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    mapped = known.join(least, "component").select("fingerprint", "component_id")
    return prints.join(mapped, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


def without_near_duplicates(
    docs: DataFrame, words: int = 3, doc_id: str = "doc_id", text: str = "text", similarity: float | None = None
) -> DataFrame:
    """One row of each group: the one with the smallest doc_id (null behind all others), of these
    the one with the smallest digest of its text; of rows equal in both any one. Rows are dropped by
    themselves, so another row of a dropped row's doc_id stays.

    Without `similarity`, groups are those of `simhash_groups`; with it, those of
    `similar.similar_groups`: shingles of `words` words with that Jaccard similarity.
    """
    row = "_row"
    while row in docs.columns:
        row = "_" + row
    # Written once: the numbers hold in all plans below.
    rows = materialise(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    if similarity is None:
        groups = simhash_groups(rows, words, row, text).select(F.col("doc_id").alias(row), F.col("component_id").alias("group"))
    else:
        groups = similar_groups(rows, row, text, words, similarity).toDF(row, "group")
    digest = F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256)
    rank = F.struct(F.col(doc_id).isNull(), F.col(doc_id), digest, F.col(row).alias("row"))
    ranked = rows.select(row, rank.alias("rank")).join(groups, row)
    stay = ranked.groupBy("group").agg(F.min("rank").alias("rank")).select(F.col("rank.row").alias(row))
    return rows.join(stay, row, "left_semi").select(*docs.columns)

"""Near-duplicates by the similarity of their texts: groups of texts linked by Jaccard >= a bound.

Method: candidates by SimHash fingerprints and by min-hash bands, each candidate pair verified exactly.
A text is the set of its shingles; texts with equal sets are one class. A class has a fingerprint, the
bits that over half of its shingles have, which emits its 1-bit ball; classes meet at a variant if they
differ in 2 bits at most. At similarity 0.8 fingerprints differ in some 10 bits, and half-radius balls
of 5 bits would be 8 million variants each. So what the fingerprints miss meets by bands: BANDS x ROWS
minima of the hashes give BANDS keys, and two texts of similarity s meet somewhere with probability
1 - (1 - s^ROWS)^BANDS, at 0.8 all but 4 pairs in a million, above it fewer.

A key that many texts share would have all their pairs. So each class is first compared with the
least one of each of its keys, which joins true copies into components. What is left are the classes
at keys where more than one component meets, and these go through a prefix filter, which is exact:
two sets of similarity s share one of the rarest shingles of each, n - ceil(s n) + 1 of n, in any
order that both use. Texts made from one template share the template but not what is rare, so they
do not meet. At a shingle, each class is first compared with the one that has the least of its own,
which stands in the middle of a group of edited copies and joins them without their pairs; then with
all of other components, but for pairs that two bounds rule out: the places of the shingle in both
orders, and the bits in which the parities of both sets differ. PARITY parities, each of the number of
shingles with that part of the hash: no more of them differ than shingles are in one set alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.llm.balls import near_fingerprints
from evalspark.llm.components import components
from evalspark.llm.texts import LOWER, Texts, mixed, slices, span_hashes, texts_of, word_bytes
from evalspark.session import bounded, materialise

BANDS, ROWS = 24, 4
#: Bytes of texts whose arrays are held at once.
SLICE_BYTES = 1 << 19
PARITY = 1024
WORDS = word_bytes(alphanumeric=False)
ODD = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) << np.uint64(1) | np.uint64(1)


def shingles(texts: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of lower-cased texts, and the first of each text (one more entry).
    A text of fewer words has one shingle, one without words none."""
    starts, ends, first = texts.words(WORDS)
    h = span_hashes(LOWER[texts.data], starts, ends)
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    at = np.concatenate(([0], np.cumsum(count)))
    begin = np.repeat(first[:-1] - at[:-1], count) + np.arange(at[-1])
    left = np.repeat(first[1:], count) - begin
    held = np.concatenate((h, np.zeros(words, np.uint64)))
    out = np.zeros(len(begin), np.uint64)
    for j in range(words):
        out = out * ODD + np.where(j < left, held[begin + j], np.uint64(j))
    return mixed(out), at


def _fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; none for no hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def _sketches(words: int):
    def batches(parts):
        for batch in parts:
            content, sizes, prints, bands = [], [], [], []
            for a, b in slices(batch["text"], SLICE_BYTES):
                h, at = shingles(texts_of(batch["text"].slice(a, b - a)), words)
                sets = [np.unique(h[x:y]) for x, y in zip(at[:-1], at[1:])]
                content += [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                sizes += map(len, sets)
                prints += map(_fingerprint, sets)
                full = np.flatnonzero(np.diff(at))
                keys = np.zeros((len(full), BANDS), np.uint64)
                for k, factor in enumerate(_FACTORS if len(full) else ()):
                    band = k // ROWS
                    least = np.minimum.reduceat(mixed(h * factor), at[full])
                    keys[:, band] = mixed(keys[:, band] * ODD + least + np.uint64(band))
                own = iter(keys.view(np.int64).tolist())
                bands += [next(own) if len(s) else [] for s in sets]
            columns = [batch["row"], pa.array(content, pa.binary()), pa.array(sizes, pa.int64())]
            columns += [pa.array(prints, pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, ["row", "content", "n", "fingerprint", "bands"])

    return batches


def _parities(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def _sets(words: int):
    def batches(parts):
        for batch in parts:
            for a, b in slices(batch["text"], SLICE_BYTES):
                some = batch.slice(a, b - a)
                h, at = shingles(texts_of(some["text"]), words)
                sets = [np.unique(h[x:y]) for x, y in zip(at[:-1], at[1:])]
                size = pa.array([len(s) for s in sets], pa.int64())
                lists = [[_parities(s) for s in sets], [s.view(np.int64) for s in sets]]
                columns = [some["row"], size, *(pa.array(x, pa.list_(pa.int64())) for x in lists)]
                yield pa.record_batch(columns, ["node", "n", "parity", "shingle"])

    return batches


def jaccard(a: Texts, b: Texts, words: int) -> np.ndarray:
    """Similarity of each pair of texts."""
    (ha, at_a), (hb, at_b) = shingles(a, words), shingles(b, words)
    out = np.ones(len(a))
    for i in range(len(a)):
        x, y = np.unique(ha[at_a[i] : at_a[i + 1]]), np.unique(hb[at_b[i] : at_b[i + 1]])
        both = len(np.intersect1d(x, y, assume_unique=True))
        if len(x) + len(y):
            out[i] = both / (len(x) + len(y) - both)
    return out


def _similar(words: int, similarity: float):
    def batches(parts):
        for batch in parts:
            for a, b in slices(batch["text_a"], SLICE_BYTES):
                some = batch.slice(a, b - a)
                near = jaccard(texts_of(some["text_a"]), texts_of(some["text_b"]), words) >= similarity
                yield some.select(["a", "b"]).filter(pa.array(near))

    return batches


def similar_groups(docs: DataFrame, row: str, text: str, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """row, component: the least row reachable over links of texts whose sets of shingles have that
    Jaccard similarity at least. `row` is a unique long without nulls.

    Texts are lower-cased; shingles are compared by 64-bit hashes. Null, empty and blank texts have
    no shingles and are one group.
    """
    docs = docs.select(F.col(row).alias("row"), F.col(text).cast("string").alias("text"))
    ready = docs.select("row", F.coalesce("text", F.lit("")).alias("text"))
    columns = "row bigint, content binary, n bigint, fingerprint bigint, bands array<bigint>"
    sketches = materialise(ready.mapInArrow(_sketches(words), columns), "sketches")
    least = materialise(bounded(sketches.groupBy("content").agg(F.min("row").alias("node")), sketches.count()), "classes")
    classes = least.count()
    nodes = least.select("node").join(sketches, F.col("node") == F.col("row"))
    nodes = materialise(nodes.where("n > 0").select("node", "n", "fingerprint", "bands"), "nodes")
    met = nodes.select("node", "n", F.explode("bands").alias("key"))
    heads = met.groupBy("key").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("members"))
    met = materialise(bounded(met.join(heads.where("members > 1").drop("members"), "key"), BANDS * classes), "met")

    def fits(n, m):
        """Sets whose sizes differ more cannot be as similar; the tolerance covers rounding."""
        return F.least(n, m) >= (similarity - 1e-9) * F.greatest(n, m)

    def ordered(a, b):
        return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")

    prints = materialise(bounded(nodes.groupBy("fingerprint").agg(F.min(F.struct("node", "n")).alias("head")), classes), "prints")
    copies = nodes.join(prints, "fingerprint").where("node <> head.node").where(fits(F.col("n"), F.col("head.n")))
    ends = [prints.select(F.col("fingerprint").alias(x), F.col("head").alias(f"of_{x}")) for x in ("a", "b")]
    balls = near_fingerprints(prints).distinct().join(ends[0], "a").join(ends[1], "b").where(fits(F.col("of_a.n"), F.col("of_b.n")))
    near = copies.select(*ordered("head.node", "node")).union(balls.select(*ordered("of_a.node", "of_b.node")))
    tested = met.where("node <> head.node").where(fits(F.col("n"), F.col("head.n")))
    tested = near.union(tested.select(*ordered("head.node", "node"))).distinct()
    # A class and each of its keys or variants of its fingerprint are one pair at most.
    tested = materialise(bounded(tested, (BANDS + 66) * classes), "pairs")
    # All that is compared from here on: the other texts are read no more.
    named = met.select("node").union(tested.select("a")).union(tested.select("b")).distinct()
    named = materialise(bounded(named.withColumnRenamed("node", "row"), classes), "candidates")
    ready = materialise(ready.join(named, "row", "left_semi"), "candidate-texts")

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(ready.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
        both = both.join(ready.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
        return materialise(both.mapInArrow(_similar(words, similarity), "a bigint, b bigint"), "similar")

    links = verified(tested)
    found = materialise(bounded(components(links, "a", "b", links.count()), classes), "components")

    named = met.select("key", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = materialise(named, "named")
    keys = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_ = named.join(keys, "key", "left_semi").select("node", "component").distinct()
    open_ = materialise(bounded(open_.withColumn("part", F.col("component")), classes), "open")
    sets = ready.join(open_.select(F.col("node").alias("row")), "row", "left_semi")
    sets = sets.mapInArrow(_sets(words), "node bigint, n bigint, parity array<bigint>, shingle array<bigint>")
    sets = materialise(sets, "sets")
    held = sets.agg(F.sum("n")).first()[0] or 0
    each = sets.select("node", F.explode("shingle").alias("shingle"))
    common = materialise(bounded(each.groupBy("shingle").count().where("count > 1"), held), "common")
    # Shingles of one set alone come first in the order and meet nobody.
    shared = each.join(common, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "shingle"))).alias("shared"))
    rare = sets.select("node", "n").join(shared, "node").withColumn("m", F.size("shared"))
    rare = rare.withColumn("prefix", F.expr(f"cast(n - ceil({similarity!r} * n - 1e-6) + 1 - (n - m) as int)")).where("prefix > 0")
    rare = rare.select("node", "n", "m", F.posexplode(F.slice("shared", 1, F.col("prefix"))).alias("at", "of"))
    rare = rare.select("node", "n", "m", (F.expr("n - m + 1") + F.col("at")).alias("place"), F.col("of.shingle").alias("shingle"))
    rare = materialise(bounded(rare, held), "prefixes")
    places = rare.count()

    def enough(n, m, other_n, other_m):
        """The shingles that two sets must have in common, if those which others share allow as many."""
        wanted = F.ceil(similarity / (1 + similarity) * (n + other_n) - 1e-6)
        return wanted, fits(n, other_n) & (F.least(m, other_m) >= wanted)

    def contracted(links: DataFrame) -> DataFrame:
        """`open_` with its components joined by links between them."""
        of = {x: open_.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in ("a", "b")}
        whole = links.join(of["a"], "a").join(of["b"], "b").select("of_a", "of_b").where("of_a <> of_b").distinct()
        joined = components(whole, "of_a", "of_b", links.count()).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        both = open_.join(joined, "component", "left")
        return materialise(bounded(both.select("node", "part", F.coalesce("whole", "component").alias("component")), classes), "open")

    # First with the set at a shingle that has the fewest shingles of its own.
    at = rare.join(open_.select("node", "component"), "node")
    own = F.struct((F.expr("(n - m) / n")).alias("own"), "node", "n", "m", "component")
    middle = at.groupBy("shingle").agg(F.min(own).alias("head"), F.min("component").alias("low"), F.max("component").alias("high"))
    middle = at.join(middle.where("low < high"), "shingle").where("component <> head.component")
    middle = middle.where(enough(F.col("n"), F.col("m"), F.col("head.n"), F.col("head.m"))[1])
    middle = middle.select(*ordered("head.node", "node")).distinct().join(tested, ["a", "b"], "left_anti")
    middle = materialise(bounded(middle, places), "middle")
    if not middle.isEmpty():
        open_ = contracted(verified(middle))
        tested = tested.union(middle)
    # Then all pairs of components. Sets of the largest component at a shingle wait for others to come.
    at = rare.join(open_.select("node", "component"), "node")
    main = at.groupBy("shingle", "component").count().groupBy("shingle")
    main = main.agg(F.max(F.struct("count", "component")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    apart = at.join(main.select("shingle", F.col("main.component").alias("main")), "shingle")
    apart = materialise(bounded(apart.join(sets.select("node", "parity"), "node"), places), "apart")
    one, other = apart.where("component <> main").alias("x"), apart.alias("y")
    wanted, may = enough(F.col("x.n"), F.col("x.m"), F.col("y.n"), F.col("y.m"))
    pairs = one.join(other, "shingle").where("x.component <> y.component AND (y.component = y.main OR x.node < y.node)")
    # A pair that is similar enough has room behind the first shingle in common.
    pairs = pairs.where(may & (F.expr("1 + least(x.n - x.place, y.n - y.place)") >= wanted))
    differ = F.expr(" + ".join(f"bit_count(x.parity[{i}] ^ y.parity[{i}])" for i in range(PARITY // 64)))
    pairs = pairs.where(differ <= F.col("x.n") + F.col("y.n") - 2 * wanted)
    pairs = pairs.select(*ordered("x.node", "y.node")).distinct().join(tested, ["a", "b"], "left_anti")
    pairs = materialise(pairs, "pairs")
    if not pairs.isEmpty():
        open_ = contracted(verified(pairs))
    # The first links are contracted already: the later ones joined whole components.
    wholes = open_.where("part <> component").select("part", F.col("component").alias("whole")).distinct()
    own = least.join(found, "node", "left").select("content", F.coalesce("component", "node").alias("part"))
    mapped = own.join(wholes, "part", "left").select("content", F.coalesce("whole", "part").alias("component"))
    return sketches.select("row", "content").join(mapped, "content").select("row", "component")

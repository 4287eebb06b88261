"""Group bootstrap with a fixed number of draws, split multinomially down to the tasks.

A replicate draws n of the n groups with replacement. Dealing these draws out is a chain of binomial
splits: the groups fall into buckets by a hash, a replicate's n draws are halved down a binary tree
over the bucket counts, and what reaches a bucket is drawn uniformly among its own groups. Every split
is a function of (seed, replicate, node), so any task can walk down to its bucket on its own, every
replicate has exactly n draws, and no task sees all groups. Buckets hold some thousand groups; the
bucket counts are the only thing that the driver collects, MAX_BUCKETS numbers at most.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.session import materialise

BUCKET_GROUPS = 4096
MAX_BUCKETS = 1 << 16


def generator(seed: int, replicate: int, node: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[seed, replicate << 32 | node]))


def bucket_draws(counts: np.ndarray, bucket: int, repeats: int, seed: int) -> np.ndarray:
    """Draws of each replicate that fall to a bucket; `counts` has a power of two of buckets.

    Node 1 is all buckets, the children of a node are 2 node and 2 node + 1."""
    draws = np.full(repeats, counts.sum(), np.int64)
    low, high, node = 0, len(counts), 1
    while high - low > 1:
        middle = (low + high) // 2
        all_, left = int(counts[low:high].sum()), int(counts[low:middle].sum())
        if all_ == 0:
            return np.zeros(repeats, np.int64)
        taken = np.array([generator(seed, r, node).binomial(d, left / all_) for r, d in enumerate(draws)], np.int64)
        if bucket < middle:
            draws, high, node = taken, middle, 2 * node
        else:
            draws, low, node = draws - taken, middle, 2 * node + 1
    return draws


def bucket_weights(counts: np.ndarray, bucket: int, repeats: int, seed: int) -> np.ndarray:
    """(replicates, groups of the bucket): how often each replicate draws each group."""
    size, leaf = int(counts[bucket]), len(counts) + bucket
    out = np.zeros((repeats, size))
    for r, d in enumerate(bucket_draws(counts, bucket, repeats, seed)):
        out[r] = np.bincount(generator(seed, r, leaf).integers(0, size, d), minlength=size)
    return out


def _whole_buckets(batches):
    """Frames of one bucket each, from batches sorted by bucket."""
    held: list[pd.DataFrame] = []
    for pdf in batches:
        for bucket, part in pdf.groupby("_bucket", sort=False):
            if held and held[0]["_bucket"].iloc[0] != bucket:
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def fixed_sums(stats: DataFrame, group: str, columns: list[str], repeats: int, seed: int) -> DataFrame:
    """(replicate, *columns, groups) like `bootstrap.replicate_sums`, with as many draws in every
    replicate as there are groups. `stats` has one row per group; a null group is one of them."""
    name = F.coalesce(F.col(group).cast("string"), F.lit(""))
    narrow = stats.select(
        F.xxhash64(F.lit(seed), name).alias("_hash"),
        name.alias("_name"),
        F.col(group).isNull().alias("_none"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    narrow = materialise(narrow, "group-statistics")
    groups = narrow.count()
    wanted = max(1, -(-groups // BUCKET_GROUPS))
    buckets = min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())
    placed = narrow.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
    counts = np.zeros(buckets, np.int64)
    for r in placed.groupBy("_bucket").count().collect():
        counts[r["_bucket"]] = r["count"]

    def partial(batches):
        total = None
        for pdf in _whole_buckets(batches):
            values = np.column_stack([pdf[columns].to_numpy(np.float64), np.ones(len(pdf))])
            weights = bucket_weights(counts, int(pdf["_bucket"].iloc[0]), repeats, seed)
            sums = np.vstack([values.sum(axis=0), weights @ values])
            total = sums if total is None else total + sums
        if total is not None:
            out = pd.DataFrame(total, columns=[*columns, "groups"])
            out.insert(0, "replicate", np.arange(-1, repeats, dtype=np.int32))
            yield out

    names = [*columns, "groups"]
    layout = "replicate int, " + ", ".join(f"`{c}` double" for c in names)
    dealt = placed.repartition("_bucket").sortWithinPartitions("_bucket", "_hash", "_name", "_none")
    parts = dealt.select("_bucket", *columns).mapInPandas(partial, layout)
    return parts.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in names])

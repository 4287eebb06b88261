"""Fingerprints of 64 bits that differ in at most RADIUS bits, found at common 1-bit variants."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 2
#: Fingerprints whose variants one task writes.
TASK_PRINTS = 1 << 15


def _links(batches):
    """Rows sorted by variant: links of each variant's least fingerprint to the others there."""
    held = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def linked(variant, prints):
        new = np.concatenate(([True], variant[1:] != variant[:-1]))
        head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        a, b = prints[head][~new], prints[~new]
        differ = np.unpackbits((a ^ b).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        near = (differ > 0) & (differ <= RADIUS)
        return pa.record_batch([pa.array(a[near]), pa.array(b[near])], ["a", "b"])

    for batch in batches:
        both = (np.concatenate((h, batch[c].to_numpy())) for h, c in zip(held, ("variant", "fingerprint")))
        variant, prints = both
        cut = int(np.searchsorted(variant, variant[-1])) if len(variant) else 0
        held = variant[cut:], prints[cut:]
        if cut:
            yield linked(variant[:cut], prints[:cut])
    if len(held[0]):
        yield linked(*held)


def near_fingerprints(prints: DataFrame) -> DataFrame:
    """(a, b): links whose components are those of all pairs of fingerprints within RADIUS bits.
    `prints` has a column fingerprint, a long, each value once; it is stored, so counting it is cheap."""
    tasks = max(1, -(-prints.count() // TASK_PRINTS))
    ball = F.expr("transform(sequence(-1, 63), i -> if(i < 0, fingerprint, fingerprint ^ shiftleft(1L, i)))")
    variants = prints.select("fingerprint").repartition(tasks, "fingerprint").select("fingerprint", F.explode(ball).alias("variant"))
    met = variants.repartition("variant").sortWithinPartitions("variant", "fingerprint")
    return met.mapInArrow(_links, "a bigint, b bigint")

"""Hash-derived identities and splits. All are functions of the value alone, so they do not depend
on partitioning, file layout or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hash labels and cut-offs of the data contract.
SPLIT_LABEL = "playground-v1:"
GROUP_LABEL = "prerank-v1:"
ORDER_LABEL = "prerank-roots-v1:"
SPLIT_MODULUS = 10000
TRAIN_CUTOFF = 8000
VALIDATION_CUTOFF = 9000
INNER_CUTOFF = 7000
SPLITS = ("train", "validation", "test")
# Hex digits of a digest that are folded at once: 60 bits, and 62 of a product below 2^31 squared.
WORD_DIGITS = 15


def text(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_bucket(identity, label: str = SPLIT_LABEL, modulus: int = SPLIT_MODULUS) -> Column:
    """sha256(label + id) as a 256-bit integer, modulo `modulus` (at most 2^31).

    The digest is folded in words of 15 hex digits by plain arithmetic, which stays in generated
    code: sums stay below 2^63, and the digest is a common subexpression of the words.
    """
    digest = F.sha2(F.concat(F.lit(label), text(identity).cast("string")), 256)
    folded = None
    for at in range(1, 65, WORD_DIGITS):
        digits = min(WORD_DIGITS, 65 - at)
        word = F.conv(F.substring(digest, at, digits), 16, 10).cast("long")
        if folded is not None:
            word = folded * F.lit(16**digits % modulus) + word
        folded = word % F.lit(modulus)
    return folded


def split_of_bucket(
    bucket: Column, train: int = TRAIN_CUTOFF, validation: int = VALIDATION_CUTOFF
) -> Column:
    return (
        F.when(bucket < train, "train").when(bucket < validation, "validation").otherwise("test")
    )


def split_for(identity) -> Column:
    return split_of_bucket(split_bucket(identity))


def inner_role(
    bucket: Column, inner: int = INNER_CUTOFF, train: int = TRAIN_CUTOFF
) -> Column:
    """`fit` and `inner` inside the train partition, null outside it."""
    return F.when(bucket < inner, "fit").when(bucket < train, "inner")


def hex_prefix(value: Column, width: int = 16) -> Column:
    return F.substring(F.sha2(value, 256), 1, width)


def group_id_for(canonical_fen: Column, dice: Column) -> Column:
    return hex_prefix(F.concat(F.lit(GROUP_LABEL), canonical_fen, F.lit("|"), dice), 16)


def order_key(canonical_fen: Column, dice: Column) -> Column:
    return F.sha2(F.concat(F.lit(ORDER_LABEL), canonical_fen, F.lit("|"), dice), 256)


def seeded_key(seed, *parts) -> Column:
    """A reproducible shuffle key: order rows by it to draw without coordination."""
    pieces = [F.lit(str(seed))] + [text(p).cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", *pieces), 256)


def seeded_uniform(seed, *parts) -> Column:
    """A uniform double in [0, 1) from the first 13 hex digits (52 bits) of the seeded key."""
    return F.conv(F.substring(seeded_key(seed, *parts), 1, 13), 16, 10).cast("double") / float(
        2**52
    )

"""Identity, ownership, overlap and exclusion on keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.operators import ordering
from evalspark.operators.validation import Refused
from evalspark.session import materialise


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys, keys repeated, and rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counts.agg(
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("rows") > 1).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("extra_rows"),
    )


def exclude_seen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in `seen`; the exclusion side is reduced to distinct keys."""
    return rows.join(seen.select(key).distinct(), key, "left_anti")


#: Positions of one block of the filter of seen keys; a block is a bitmap of 4 KB.
BLOCK_BITS = 1 << 15
#: Bits that a key sets in its block.
KEY_BITS = 4


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _positions(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), F.col(key)), F.lit(BLOCK_BITS)).cast("int") for i in range(1, KEY_BITS + 1)]


def seen_filter(seen: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, bits): a blocked Bloom filter of the keys, `blocks` bitmaps of 4 KB at most. A key sets
    KEY_BITS bits of the one block its hash names. Built as a partial aggregate; filters of parts of
    a table merge by `merged_filters`."""
    each = seen.where(F.col(key).isNotNull()).select(_block(key, blocks).alias("block"), F.explode(F.array(*_positions(key))).alias("at"))
    return each.groupBy("block").agg(F.bitmap_construct_agg(F.col("at").cast("long")).alias("bits"))


def merged_filters(filters: DataFrame) -> DataFrame:
    return filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def maybe_seen(rows: DataFrame, filter_: DataFrame, key: str, blocks: int, name: str = "_maybe") -> DataFrame:
    """`rows` with a flag that is false only for keys that the filter surely lacks (null keys among
    them). The filter has `blocks` rows at most, and is sent to the tasks: nothing is shuffled."""
    bits = F.broadcast(filter_.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    held = rows.withColumn("_block", _block(key, blocks)).withColumn("_at", F.array(*_positions(key)))
    byte = "cast(conv(hex(substring(_bits, _at[{0}] div 8 + 1, 1)), 16, 10) as int)"
    set_ = " AND ".join(f"shiftright({byte.format(i)}, _at[{i}] % 8) & 1 = 1" for i in range(KEY_BITS))
    flag = F.coalesce(F.col(key).isNotNull() & F.expr(set_), F.lit(False))
    return held.join(bits, "_block", "left").select(*rows.columns, flag.alias(name))


def exclude_seen_prefiltered(rows: DataFrame, seen: DataFrame, key: str, blocks: int = 1024) -> DataFrame:
    """Rows of `exclude_seen`, null keys kept like there. Rows that a Bloom filter of the seen keys
    surely lacks pass without a shuffle; only the others meet the exact exclusion, which decides, so
    nothing is removed by chance. Worth it where most rows are unseen: `rows` is read twice, and the
    filter (4 KB a block) should have some 8 bits per seen key; a full one only saves nothing."""
    flagged = maybe_seen(rows, materialise(seen_filter(seen, key, blocks), "seen-filter"), key, blocks)
    sure = flagged.where(~F.col("_maybe")).drop("_maybe")
    return sure.unionByName(exclude_seen(flagged.where("_maybe").drop("_maybe"), seen, key).select(*rows.columns))


def exclusion_counts(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Input, removed and kept rows of `exclude_seen`, without joining row by row: both sides are
    counted per key first."""
    a = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), F.lit(0).alias("seen"))
    b = seen.select(key).distinct().select(key, F.lit(0).cast("long"), F.lit(1))
    per_key = a.union(b).groupBy(key).agg(F.sum("rows").alias("rows"), F.max("seen").alias("seen"))
    return per_key.agg(
        F.sum("rows").alias("input_rows"),
        F.sum(F.when(F.col("seen") == 1, F.col("rows")).otherwise(0)).alias("removed_rows"),
        F.sum(F.when(F.col("seen") == 0, F.col("rows")).otherwise(0)).alias("kept_rows"),
    )


def mark_unseen(rows: DataFrame, seen: DataFrame, key: str, name: str = "unseen") -> DataFrame:
    """Flags instead of filtering: true when the key does not occur in `seen`."""
    marks = seen.select(key).distinct().withColumn("_hit", F.lit(True))
    return rows.join(marks, key, "left").withColumn(name, F.col("_hit").isNull()).drop("_hit")


def overlap_counts(
    df: DataFrame, key: str, split: str = "split", names=hashing.SPLITS
) -> DataFrame:
    """Distinct keys shared by each pair of splits. One shuffle on the key, partially aggregated;
    no pair of rows is ever formed."""
    seen_in = [F.max((F.col(split) == n).cast("int")).alias(n) for n in names]
    per_key = df.groupBy(key).agg(*seen_in)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    counts = per_key.agg(
        *[F.count_if((F.col(a) == 1) & (F.col(b) == 1)).alias(f"{a}:{b}") for a, b in pairs]
    )
    rows = [
        F.struct(F.lit(f"{a}:{b}").alias("pair"), F.col(f"`{a}:{b}`").alias("shared"))
        for a, b in pairs
    ]
    return counts.select(F.inline(F.array(*rows)))


def disjointness(left: DataFrame, right: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """(field, shared): distinct non-blank values of each field present on both sides."""

    def values(df: DataFrame, side: int) -> DataFrame:
        pairs = [
            F.struct(F.lit(name).alias("field"), value.cast("string").alias("value"))
            for name, value in fields.items()
        ]
        return (
            df.select(F.inline(F.array(*pairs)))
            .where("value is not null and value <> ''")
            .select("field", "value", F.lit(side).alias("side"))
        )

    both = (
        values(left, 1)
        .union(values(right, 2))
        .groupBy("field", "value")
        .agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    )
    return both.groupBy("field").agg(F.count_if(F.col("lo") < F.col("hi")).alias("shared"))


def ownership(df: DataFrame, group: str, fields: list[str]) -> DataFrame:
    """(field, value, groups): identities claimed by more than one declared group."""
    pairs = [
        F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields
    ]
    claims = df.select(F.col(group).alias("_group"), F.inline(F.array(*pairs))).where(
        "value is not null and value <> ''"
    )
    return (
        claims.groupBy("field", "value")
        .agg(F.min("_group").alias("first_group"), F.max("_group").alias("last_group"))
        .where("first_group <> last_group")
    )


def hold_out_games(
    df: DataFrame, game: str = "game_id", fraction: float = 0.2, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(train, validation) by whole games in a seeded hash order; both sides keep at least one.
    Counts the games (one job)."""
    if not 0.0 < fraction < 1.0:
        raise ValueError("fraction must lie strictly between 0 and 1")
    games = df.select(game).distinct()
    total = games.count()
    if total < 2:
        raise Refused("at least two games are needed to split without emptying a side")
    wanted = min(total - 1, max(1, int(total * fraction)))
    drawn = ordering.ordered_prefix(
        games.withColumn("_order", hashing.seeded_key(seed, game)), "_order", wanted
    ).select(game)
    return df.join(drawn, game, "left_anti"), df.join(drawn, game, "left_semi")


def first_games(df: DataFrame, game: str, ordinal: str, limit: int) -> DataFrame:
    """Rows of the `limit` games that appear first by `ordinal`."""
    starts = df.groupBy(game).agg(F.min(ordinal).alias("_start"))
    kept = ordering.first_rows(starts, ["_start", game], limit).select(game)
    return df.join(kept, game, "left_semi")


def distinct_roots(df: DataFrame) -> DataFrame:
    """One row per (canonical position, roll): the earliest by (game_id, ply, fen).

    `min` over a struct is a partial aggregate, so a root repeated in a third of the corpus
    collapses before the shuffle.
    """
    canonical, roll = fx.position_key("fen"), fx.canonical_dice("dice")
    rows = df.select(
        "game_id",
        "ply",
        "fen",
        roll.alias("dice"),
        "side",
        hashing.order_key(canonical, roll).alias("order_key"),
        hashing.group_id_for(canonical, roll).alias("group_id"),
    )
    first = rows.groupBy("order_key").agg(
        F.min(F.struct("game_id", "ply", "fen", "dice", "side", "group_id")).alias("r"),
        F.count(F.lit(1)).alias("occurrences"),
    )
    return first.select("order_key", "r.*", "occurrences")


def sample_roots(roots: DataFrame, limit: int | None = None) -> DataFrame:
    """The first `limit` roots in hash order: a bigger sample contains every smaller one."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    if limit is None:
        return roots.orderBy("order_key")
    return ordering.ordered_prefix(roots, "order_key", limit)


def extend_sample(roots: DataFrame, done: DataFrame, limit: int) -> DataFrame:
    """What a larger sample adds to roots that are already labelled."""
    return sample_roots(roots, limit).join(done.select("order_key"), "order_key", "left_anti")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(side, key) for keys found on one side only."""
    tagged = (
        left.select(key, F.lit(1).alias("_side"))
        .union(right.select(key, F.lit(2)))
        .groupBy(key)
        .agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    )
    return tagged.where("_lo = _hi").select(
        F.when(F.col("_lo") == 1, "missing").otherwise("extra").alias("side"), key
    )


def set_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on both sides, on the left only and on the right only; equal when the last
    two are zero."""
    tagged = (
        left.select(key, F.lit(1).alias("_side"))
        .union(right.select(key, F.lit(2)))
        .groupBy(key)
        .agg(F.min("_side").alias("_lo"), F.max("_side").alias("_hi"))
    )
    return tagged.agg(
        F.count_if(F.col("_lo") < F.col("_hi")).alias("both"),
        F.count_if(F.col("_hi") == 1).alias("missing"),
        F.count_if(F.col("_lo") == 2).alias("extra"),
    ).withColumn("equal", (F.col("missing") == 0) & (F.col("extra") == 0))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union by name; refuses parts whose columns differ."""
    if not parts:
        raise Refused("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b), parts)

"""Grouping rows by game and cutting them into shards that never split a game."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evalspark.operators import ordering
from evalspark.session import materialise


def game_order(df: DataFrame, game: str, ordinal: str) -> DataFrame:
    """(game, first, rows): games in first-appearance order."""
    return df.groupBy(game).agg(F.min(ordinal).alias("first"), F.count(F.lit(1)).alias("rows"))


def grouped_rows(df: DataFrame, game: str, ordinal: str, ply: str) -> DataFrame:
    """Each row with its game's first appearance; sorting by (first, ply, ordinal) keeps games
    contiguous and stable. The per-game side of the join is skew-safe under adaptive execution."""
    return df.join(game_order(df, game, ordinal).select(game, "first"), game)


def game_spans(df: DataFrame, game: str, ordinal: str) -> DataFrame:
    """(game, first, start, stop): the half-open row range of each game after grouping."""
    run = ordering.running_total(game_order(df, game, ordinal), [], ["first"], "rows", "stop")
    return run.select(game, "first", (F.col("stop") - F.col("rows")).alias("start"), "stop")


def next_starts(spans: DataFrame, size: int) -> DataFrame:
    """(start, next): where the shard after one beginning at `start` would begin - the first game
    boundary at or after start + size. Null when the shard reaches the end.

    The game holding row start + size is found per block of `size` rows: a block holds at most
    `size` games and as many targets, so every window here is bounded.
    """
    block = lambda c: F.floor(c / size).cast("long")
    pieces = spans.select(
        F.explode(F.sequence(block(F.col("start")), block(F.col("stop") - 1))).alias("block"),
        "start",
        "stop",
    ).select(
        "block",
        F.greatest("start", F.col("block") * size).alias("at"),
        F.lit(0).alias("kind"),
        F.struct("start", "stop").alias("game"),
        F.lit(None).cast("long").alias("origin"),
    )
    targets = spans.select(
        block(F.col("start") + size).alias("block"),
        (F.col("start") + size).alias("at"),
        F.lit(1).alias("kind"),
        F.lit(None).cast("struct<start:bigint,stop:bigint>").alias("game"),
        F.col("start").alias("origin"),
    )
    w = (
        Window.partitionBy("block")
        .orderBy("at", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        pieces.union(targets)
        .withColumn("hit", F.last("game", ignorenulls=True).over(w))
        .where("kind = 1")
    )
    after = F.when(F.col("hit.start") == F.col("at"), F.col("at")).otherwise(F.col("hit.stop"))
    inside = F.col("hit").isNotNull() & (F.col("at") < F.col("hit.stop"))
    return found.select(F.col("origin").alias("start"), F.when(inside, after).alias("next"))


def shard_starts(spans: DataFrame, size: int) -> DataFrame:
    """(start): first rows of the greedy shards - cut every `size` rows, extended to the end of
    the straddling game, counting again from there.

    The cuts form a chain start -> next. Each round follows three jumps and replaces the jump
    table by its fourth power, so log4(shards) rounds replace one step per shard. The jump table has
    a row per game; its joins are merge joins, so no round sends it through the driver.
    """
    total = spans.agg(F.max("stop")).first()[0] or 0
    jumps = next_starts(spans, size).where(F.col("next").isNotNull() & (F.col("next") < total))
    jumps = materialise(jumps, "shard-jumps")
    marked = spans.where("start = 0").select("start")
    known = 1 if total else 0

    def follow(at: DataFrame) -> DataFrame:
        return at.join(jumps.hint("merge"), "start").select(F.col("next").alias("start"))

    def squared(table: DataFrame) -> DataFrame:
        hop = table.select(F.col("start").alias("next"), F.col("next").alias("_then"))
        return table.join(hop.hint("merge"), "next").select("start", F.col("_then").alias("next"))

    while known:
        one = follow(marked)
        two = follow(one)
        reached = marked.union(one).union(two).union(follow(two)).distinct()
        marked = materialise(reached, "shard-starts")
        count = marked.count()
        if count < 4 * known:
            return marked
        known = count
        jumps = materialise(squared(squared(jumps)), "shard-jumps")
    return marked


def assign_shards(df: DataFrame, game: str, ordinal: str, size: int) -> DataFrame:
    """(game, shard, start, stop) for every game. Runs the doubling jobs of `shard_starts`."""
    if size <= 0:
        raise ValueError("shard size must be positive")
    spans = materialise(game_spans(df, game, ordinal), "game-spans")
    cuts = shard_starts(spans, size).withColumn("_cut", F.lit(1))
    flagged = spans.join(cuts, "start", "left").withColumn("_cut", F.coalesce("_cut", F.lit(0)))
    numbered = ordering.running_total(flagged, [], ["start"], "_cut", "_n")
    return numbered.select(game, (F.col("_n") - 1).cast("int").alias("shard"), "start", "stop")


def sharded_rows(df: DataFrame, game: str, ordinal: str, size: int) -> DataFrame:
    """Rows with their shard number and their game's row range."""
    return df.join(assign_shards(df, game, ordinal, size).hint("merge"), game)

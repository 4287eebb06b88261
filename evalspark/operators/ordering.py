"""Ranks, running totals and top-k that stay distributed when one group holds most of the rows.

A plain window sorts a whole group in one task. Where a group is too large for that, the rows are
range partitioned by (group, order) and stored: a large group is cut along its own sort order
whatever its keys look like, a small one only where a boundary happens to fall into it. The running
total inside a range is a window over the rows of one range; the totals of the earlier ranges come
from a pre-aggregated table with one row per range and group. Boundaries only steer balance, the
result is exact for any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evalspark.operators import selection
from evalspark.session import materialise

# Largest group a single task sorts; above it the rows are cut into ranges of a quarter of it.
WINDOW_ROWS = 1_000_000
# Candidate cuts lie so many standard deviations of a sampled rank, about, from the wanted one.
CUTS = (-4, -2, -1, -0.5, 0.5, 1, 2, 4)
SAMPLE_KEYS = 4096
# Default of spark.sql.optimizer.windowGroupLimitThreshold.
GROUP_LIMIT = 1000


def as_columns(values) -> list[Column]:
    return [F.col(v) if isinstance(v, str) else v for v in values]


def one_row(df: DataFrame) -> Column:
    """A one-row table as a single scalar subquery of struct type, so it is evaluated once
    however many of its columns are used."""
    return df.select(F.struct(*df.columns).alias("row")).scalar()


def group_sizes(df: DataFrame, group: list[str]) -> tuple[int, int]:
    """Rows in all and in the largest group. Runs one job: a partial count, then two numbers."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.sum("n"), F.max("n")).first()
    return row[0] or 0, row[1] or 0


def ranges_of(keyed: DataFrame, group: list[str], rows: int, window_rows: int) -> DataFrame:
    """`keyed` with `_bucket`, the number of its range of (group, `_key`), stored once so that
    every use sees the same boundaries. About a quarter of `window_rows` go into a range."""
    ranges = max(1, -(-4 * rows // window_rows))
    cut = keyed.repartitionByRange(ranges, *group, "_key")
    return materialise(cut.withColumn("_bucket", F.spark_partition_id()), "ranges")


def keyed_by(df: DataFrame, order: list) -> DataFrame:
    return df.withColumn(
        "_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(as_columns(order))])
    )


def running_total(
    df: DataFrame,
    group: list[str],
    order: list,
    value,
    name: str = "running",
    bucket: Column | None = None,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Inclusive running sum of `value` along ascending `order` inside each group.

    (group, order) must be unique. The largest group is measured first: while it fits
    `window_rows`, a window per group is the cheapest plan; beyond that the rows are cut into
    ranges. `bucket` replaces the ranges by any column that never decreases along the order and
    takes a bounded number of values, and skips the measurement.
    """
    amount = F.col(value) if isinstance(value, str) else value
    running = lambda w: w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = keyed_by(df, order).withColumn("_amount", amount)
    if bucket is None:
        rows, largest = group_sizes(df, group)
        if largest <= window_rows:
            whole = running(Window.partitionBy(*group).orderBy("_key"))
            return keyed.withColumn(name, F.sum("_amount").over(whole)).select(*df.columns, name)
        cut = ranges_of(keyed, group, rows, window_rows)
    else:
        cut = keyed.withColumn("_bucket", bucket)
    sizes = cut.groupBy(*group, "_bucket").agg(F.sum("_amount").alias("_size"))
    earlier = (
        Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *group, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = running(Window.partitionBy(*group, "_bucket").orderBy("_key"))
    return (
        cut.withColumn("_inside", F.sum("_amount").over(inside))
        .join(offsets, [*group, "_bucket"])
        .withColumn(name, F.col("_inside") + F.col("_offset"))
        .select(*df.columns, name)
    )


def row_numbers(df: DataFrame, group: list[str], order: list, name: str = "rn", **kw) -> DataFrame:
    """1-based position inside the group; (group, order) must be unique."""
    return running_total(df, group, order, F.lit(1).cast("long"), name, **kw)


def histogram(df: DataFrame, group: list[str], value: str, **sums) -> DataFrame:
    """One row per (group, value) with its count `n` and any extra sums; partial aggregation does
    the work before the shuffle."""
    extra = [F.sum(c).alias(alias) for alias, c in sums.items()]
    return df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n"), *extra)


def nearest_rank(
    df: DataFrame, group: list[str], value: str, fractions: dict[str, float]
) -> DataFrame:
    """sorted(values)[int(n * fraction)] per group, exact, plus min, max and n.

    Numbers and dates are selected by counting passes. Other types go by the value histogram, so
    repeated values are counted before anything is sorted; it is written once and read by sizing,
    totals and ranks.
    """
    if selection.selectable(df.schema[value].dataType):
        return selection.nearest_ranks(df, group, value, fractions)
    rows = df.where(F.col(value).isNotNull())
    counts = materialise(histogram(rows, group, value), "value-histogram")
    run = running_total(counts, group, [value], "n", "_through")
    totals = counts.groupBy(*group).agg(
        F.sum("n").alias("_total"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    if group:
        at = run.join(totals, group)
    else:
        at = run.withColumn("_t", one_row(totals)).select(*run.columns, "_t.*")
    picks = [
        F.max(
            F.when(
                (F.floor(F.col("_total") * f) >= F.col("_through") - F.col("n"))
                & (F.floor(F.col("_total") * f) < F.col("_through")),
                F.col(value),
            )
        ).alias(name)
        for name, f in fractions.items()
    ]
    return at.groupBy(*group).agg(
        F.first("_total").alias("n"), F.first("min").alias("min"), *picks, F.first("max").alias("max")
    )


def top_rows(
    df: DataFrame, group: list[str], order: list, k: int, name: str = "position", **kw
) -> DataFrame:
    """The first k rows of each group with their 1-based place.

    Up to GROUP_LIMIT rows the planner limits every group inside each input task before the
    exchange, so a group of any size reaches its reducer as at most k rows per task. Wider cuts do
    not get that limit; they are read off the row numbers, whose large groups are cut into ranges.
    """
    if k > GROUP_LIMIT:
        return row_numbers(df, group, order, name, **kw).where(F.col(name) <= k)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*as_columns(order)))
    return df.withColumn(name, place).where(F.col(name) <= k)


def _prefix_rows(cut: DataFrame, order: str, limit: int) -> DataFrame:
    """The first `limit` rows when `_bucket` never decreases along the unique `order`. Rows are
    counted per bucket and ranked inside their own, so no task sees more than one bucket; those
    below the cut stay whole."""
    counts = cut.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    through = F.sum("n").over(Window.orderBy("_bucket"))
    counts = counts.select("_bucket", (through - F.col("n")).alias("before")).where(
        F.col("before") < limit
    )
    last = counts.agg(F.max("_bucket").alias("bucket"), F.max("before").alias("before"))
    kept = cut.withColumn("_last", one_row(last)).where(F.col("_bucket") <= F.col("_last.bucket"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    inside = (F.col("_bucket") < F.col("_last.bucket")) | (
        F.col("_place") <= limit - F.col("_last.before")
    )
    return kept.withColumn("_place", place).where(inside).drop("_bucket", "_last", "_place")


def _candidate_cuts(inside: DataFrame, rows: int, wanted: int, sample_keys: int) -> DataFrame:
    """One row, `cuts`: keys around the wanted rank, ascending, from a hashed sample of the keys.
    Null where a cut would lie outside the sample."""
    step = max(1, rows // sample_keys)
    draw = F.xxhash64("_key")
    drawn = inside.where(F.pmod(draw, F.lit(step)) == 0).orderBy(draw).limit(2 * sample_keys)
    drawn = drawn.agg(F.array_sort(F.collect_list("_key")).alias("keys"), F.count("_key").alias("n"))
    at = [F.floor(F.col("n") * (wanted / rows) + d * F.sqrt("n")).cast("int") for d in CUTS]
    return materialise(drawn.select(F.array(*[F.get("keys", i) for i in at]).alias("cuts")), "cuts")


def first_rows(
    df: DataFrame,
    order: list,
    limit: int,
    window_rows: int = WINDOW_ROWS,
    sample_keys: int = SAMPLE_KEYS,
) -> DataFrame:
    """The first `limit` rows in a unique order, whatever the limit; the rows are not sorted.

    Candidate cuts come from a sample of the keys; one pass counts the rows below each. Rows below
    the last cut that is not too high stay whole, and the range that holds the wanted rank is cut
    again while it has more than `window_rows` rows. Only that range is ranked at last. The sample
    decides how many passes there are, never which rows.
    """
    keyed = materialise(keyed_by(df, order), "keyed")
    rows, wanted = keyed.count(), limit
    if rows <= limit:
        return keyed.select(*df.columns)
    key, low, inside = F.col("_key"), None, keyed
    high = None
    while rows > window_rows:
        cuts = one_row(_candidate_cuts(inside, rows, wanted, sample_keys))["cuts"]
        # No cut: nothing lies below a missing low one, everything below a missing high one.
        below = [F.coalesce(key < cuts[i], F.lit(d > 0)) for i, d in enumerate(CUTS)]
        counts = list(inside.agg(*[F.count_if(b).alias(f"n{i}") for i, b in enumerate(below)]).first())
        first = max((i for i, n in enumerate(counts) if n <= wanted), default=None)
        last = min((i for i, n in enumerate(counts) if n > wanted), default=None)
        begin = counts[first] if first is not None else 0
        end = counts[last] if last is not None else rows
        if end - begin == rows:
            break
        low = cuts[first] if begin else low
        high = cuts[last] if end < rows else high
        rows, wanted = end - begin, wanted - begin
        inside = keyed
        for bound in ([key >= low] if low is not None else []) + ([key < high] if high is not None else []):
            inside = inside.where(bound)
    if rows <= window_rows:
        kept = inside.orderBy("_key").limit(wanted)
    else:  # a sample that cuts nothing off
        kept = _prefix_rows(ranges_of(inside, [], rows, window_rows), "_key", wanted)
    if low is not None:
        kept = keyed.where(key < low).unionByName(kept)
    return kept.select(*df.columns)


def ordered_prefix(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The first `limit` rows by a unique hex key, in its order. The first four digits of a hash
    are evenly spread buckets, so rows are counted by them and only one bucket is ranked."""
    cut = df.withColumn("_bucket", F.substring(F.col(key), 1, 4))
    return _prefix_rows(cut, key, limit).orderBy(key)

"""Nearest ranks by distributed selection: counting passes over the bits of a value, no sort.

A number maps to a 64-bit key of the same order. A pass counts the rows of every open interval by the
next DIGIT bits of their keys; the bin that holds the wanted rank is the next interval. A bin whose
rows are all equal is settled. So a rank takes at most four passes whatever the values are, each a
partial aggregate of at most 2 ** DIGIT rows per interval, and only rows of open intervals are read
again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.session import materialise

DIGIT = 16
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def selectable(kind: T.DataType) -> bool:
    """Whether values of this type have ordered keys."""
    return isinstance(kind, (*WHOLE, T.FloatType, T.DoubleType, T.DateType))


def ordered_key(value: Column, kind: T.DataType) -> Column:
    """A long in the order of `value`: whole numbers and days themselves; of a double its bits, the
    lower ones turned over where it is negative. Zeros of both signs are one, all not-a-numbers are
    one and the greatest."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, WHOLE):
        return value.cast("long")
    plain = value.cast("double") + F.lit(0.0)
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), plain).cast("long")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def nearest_ranks(df: DataFrame, group: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """sorted(values)[int(n * fraction)] per group, exact, plus n, min and max. Groups, values and keys
    are stored once, so the passes neither run the plan of `df` nor make keys again. Null values do not
    count; a null group is a group. An empty table has no rows, for no group columns one row with n 0.
    """
    kind = df.schema[value].dataType
    each = F.struct(*group) if group else F.lit(0)
    rows = df.where(F.col(value).isNotNull()).select(
        each.alias("at"), F.col(value).alias("value"), ordered_key(F.col(value), kind).alias("key")
    )
    rows = materialise(rows, "rank-keys")
    totals = materialise(
        rows.groupBy("at").agg(
            F.count(F.lit(1)).alias("n"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.min("key").alias("low"),
            F.max("key").alias("high"),
        ),
        "rank-totals",
    )
    # The keys of a group agree above these bits.
    spread = F.length(F.bin(F.col("low").bitwiseXOR(F.col("high"))))
    width = totals.agg(F.max(spread)).first()[0] or 0
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(float(f)).alias("f")) for k, f in fractions.items()])
    prefix = F.shiftright("low", width) if width < 64 else F.lit(0).cast("long")
    targets = totals.select("at", "n", prefix.alias("prefix"), F.inline(wanted)).select(
        "at",
        "name",
        F.floor(F.col("n") * F.col("f")).alias("rank"),
        "prefix",
        F.lit(None).cast(kind).alias("least"),
        F.lit(False).alias("settled"),
    )
    open_count = width
    while width > 0 and open_count:
        above = width
        width = max(0, width - DIGIT)
        prefix = F.shiftright("key", above) if above < 64 else F.lit(0).cast("long")
        inside = rows.withColumn("prefix", prefix)
        if above < 64:
            intervals = targets.where("NOT settled").select("at", "prefix").distinct()
            inside = inside.join(intervals, ["at", "prefix"], "left_semi")
        bins = inside.groupBy("at", "prefix", F.shiftright("key", width).alias("digit")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("value").alias("least"), F.max("value").alias("most")
        )
        through = F.sum("rows").over(Window.partitionBy("at", "prefix").orderBy("digit"))
        bins = bins.withColumn("before", through - F.col("rows"))
        here = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("rows"))
        found = targets.where("NOT settled").drop("least", "settled").join(bins, ["at", "prefix"]).where(here)
        found = found.select(
            "at",
            "name",
            (F.col("rank") - F.col("before")).alias("rank"),
            F.col("digit").alias("prefix"),
            "least",
            (F.col("least") == F.col("most")).alias("settled"),
        )
        targets = materialise(targets.where("settled").unionByName(found), "rank-targets")
        open_count = targets.where("NOT settled").count()
    picks = targets.groupBy("at").agg(
        *[F.max(F.when(F.col("name") == k, F.col("least"))).alias(k) for k in fractions]
    )
    if group:
        out = totals.join(picks, "at")
    else:
        one = picks.agg(*[F.max(k).alias(k) for k in fractions]).select(F.struct(*fractions)).scalar()
        out = totals.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("min").alias("min"), F.max("max").alias("max")
        ).withColumn("_picks", one).select("n", "min", "_picks.*", "max")
    keys = [F.col("at")[g].alias(g) for g in group]
    return out.select(*keys, "n", "min", *fractions, "max")

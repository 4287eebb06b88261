"""Probability scores: row means, calibration tables, slices, baselines, replicate summaries.

Every report is built from `score_sums`, a set of partial sums that can be grouped by anything
(split, slice, seed, game) and added up again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import scoring as sx

BINS = 10
# Slice names of the report and the probe columns behind the tactical ones.
SLICES = (
    "phase:opening",
    "phase:middlegame",
    "phase:endgame",
    "side:w",
    "side:b",
    "material:behind",
    "material:balanced",
    "material:ahead",
    "target:decisive",
    "target:uncertain",
    "tactical:king_attack",
    "tactical:king_danger",
    "tactical:queen_attack",
    "tactical:queen_danger",
)
TACTICAL = {
    "king_attack": "king_capture_attack",
    "king_danger": "king_capture_danger",
    "queen_attack": "queen_capture_attack",
    "queen_danger": "queen_capture_danger",
}
OPENING_PLY = 10
ENDGAME_MATERIAL = 20


def decisive(df: DataFrame, result: str = "result") -> DataFrame:
    return df.where(F.col(result).isin(0.0, 1.0))


def partition(df: DataFrame, name: str, split: str = "split") -> DataFrame:
    return df.where(F.col(split) == name)


def slice_names() -> Column:
    """array<string>: every slice the row belongs to. Needs ply, side and the feature columns."""
    phase = (
        F.when(F.col("ply") <= OPENING_PLY, "phase:opening")
        .when(F.col("total_material") <= ENDGAME_MATERIAL, "phase:endgame")
        .otherwise("phase:middlegame")
    )
    material = (
        F.when(F.col("material_diff") > 1, "material:ahead")
        .when(F.col("material_diff") < -1, "material:behind")
        .otherwise("material:balanced")
    )
    tactical = [F.when(F.col(c) > 0, f"tactical:{n}") for n, c in TACTICAL.items()]
    labels = F.array(
        phase,
        F.concat(F.lit("side:"), F.col("side")),
        material,
        F.lit("target:decisive"),
        *tactical,
    )
    return F.filter(labels, lambda x: x.isNotNull())


def sum_columns(y: Column, p: Column, bins: int = BINS) -> list[Column]:
    """Partial sums that determine every probability score."""
    b = sx.calibration_bin(p, bins)
    out = [
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("s_y"),
        F.sum(sx.log_loss(y, p)).alias("s_ll"),
        F.sum(sx.brier(y, p)).alias("s_br"),
    ]
    for i in range(bins):
        hit = b == i
        out.append(F.sum(F.when(hit, p).otherwise(0.0)).alias(f"bp{i}"))
        out.append(F.sum(F.when(hit, y).otherwise(0.0)).alias(f"by{i}"))
    return out


def finish(df: DataFrame, keep: list[str], bins: int = BINS) -> DataFrame:
    """Scores from partial sums. ECE = sum over bins |sum p - sum y| / n."""
    gap = sum(F.abs(F.col(f"bp{i}") - F.col(f"by{i}")) for i in range(bins))
    n = F.col("n")
    return df.select(
        *keep,
        n.cast("long").alias("count"),
        (F.col("s_y") / n).alias("prevalence"),
        (F.col("s_ll") / n).alias("log_loss"),
        (F.col("s_br") / n).alias("brier"),
        (gap / n).alias("ece"),
    )


def scores(
    df: DataFrame, by: list[str] | None = None, y: str = "y", p: str = "p", bins: int = BINS
) -> DataFrame:
    """count, prevalence, log loss, Brier and ECE, overall or per `by`."""
    by = by or []
    return finish(df.groupBy(*by).agg(*sum_columns(F.col(y), F.col(p), bins)), by, bins)


def paired_scores(
    df: DataFrame, y: str, p: str, ref: str, by: list[str] | None = None
) -> DataFrame:
    """Scores of two predictions in one pass; the second one's columns start with `ref_`."""
    by = by or []
    second = [c.alias(f"r{i}") for i, c in enumerate(sum_columns(F.col(y), F.col(ref)))]
    names = [f"r{i}" for i in range(len(second))]
    first = sum_columns(F.col(y), F.col(p))
    sums = df.groupBy(*by).agg(*first, *second)
    mine = [c for c in sums.columns if c not in names and c not in by]
    scored = finish(sums, [*by, *names])
    back = scored.select(
        *by,
        F.struct("count", "prevalence", "log_loss", "brier", "ece").alias("_first"),
        *[F.col(r).alias(c) for r, c in zip(names, mine)],
    )
    out = finish(back, [*by, "_first"])
    return out.select(
        *by,
        "_first.*",
        *[F.col(m).alias(f"ref_{m}") for m in ("log_loss", "brier", "ece")],
    )


def calibration_table(df: DataFrame, y: str = "y", p: str = "p", bins: int = BINS) -> DataFrame:
    """All bins, empty ones included with null means."""
    spark = df.sparkSession
    filled = df.groupBy(sx.calibration_bin(F.col(p), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(p).alias("prediction"), F.avg(y).alias("observed")
    )
    frame = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return frame.join(filled, "bin", "left").select(
        "bin",
        (F.col("bin") / bins).alias("lower"),
        ((F.col("bin") + 1) / bins).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("count"),
        "prediction",
        "observed",
    )


def edge_calibration(df: DataFrame, y: str = "y", p: str = "p", bins: int = BINS) -> DataFrame:
    """Bins by edge comparison after clipping, empty ones dropped."""
    q = sx.clip(F.col(p), sx.HOLDOUT_EPSILON)
    return df.groupBy(sx.edge_bin(q, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(q).alias("mean_predicted"),
        F.avg(y).alias("mean_outcome"),
    )


def holdout_scores(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Mean losses at the holdout clip, against the holdout's own base rate. Accepts soft labels."""
    q = sx.clip(F.col(p), sx.HOLDOUT_EPSILON)
    label = F.col(y)
    sums = df.agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(sx.holdout_log_loss(label, F.col(p))).alias("log_loss"),
        F.avg(sx.brier(label, q)).alias("brier"),
        F.avg(label).alias("mean_y"),
    )
    rate = sx.clip(F.col("mean_y"), sx.HOLDOUT_EPSILON)
    floor = -(F.col("mean_y") * F.ln(rate) + (1 - F.col("mean_y")) * F.ln(1 - rate))
    return sums.select("count", "log_loss", "brier", floor.alias("no_information_log_loss"))


def base_rate(train: DataFrame, y: str = "y") -> Column:
    """Scalar subquery: the mean outcome of the train rows."""
    return train.agg(F.avg(y).alias("rate")).scalar()


def no_information(
    evaluated: DataFrame, train: DataFrame, by: list[str] | None = None, y: str = "y"
) -> DataFrame:
    """Scores of always predicting the train base rate."""
    constant = evaluated.withColumn("_rate", base_rate(train, y))
    by = by or []
    return scores(constant, [*by, "_rate"], y, "_rate").withColumnRenamed("_rate", "prediction")


def slice_scores(
    df: DataFrame, labels: Column, by: list[str] | None = None, y: str = "y", p: str = "p"
) -> DataFrame:
    """Scores per overlapping slice. Rows are narrowed before the explode (at most 8 slices each)
    and partially aggregated before the shuffle."""
    by = by or []
    narrow = df.select(*by, y, p, F.explode(labels).alias("slice"))
    return scores(narrow, [*by, "slice"], y, p)


def slice_report(df: DataFrame, labels: Column, y: str = "y", p: str = "p") -> DataFrame:
    """Every declared slice, measured or reported as unsupported."""
    spark = df.sparkSession
    declared = spark.createDataFrame([(s,) for s in SLICES], "slice string")
    measured = slice_scores(df, labels, None, y, p)
    return declared.join(measured, "slice", "left").withColumn(
        "status", F.when(F.col("count").isNull(), "unsupported").otherwise("measured")
    )


def across_seeds(per_seed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean and population deviation of each score over seeds; one row per seed in, few rows out."""
    by = by or []
    out = [F.count(F.lit(1)).alias("seeds")]
    for m in ("log_loss", "brier", "ece"):
        out += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_seed.groupBy(*by).agg(*out)


def ensemble(replicates: DataFrame, row: list[str], p: str) -> DataFrame:
    """Mean probability per row over its seeds."""
    return replicates.groupBy(*row).agg(F.avg(p).alias("p"))


def split_summary(
    df: DataFrame, split: str = "split", game: str = "game_id", result: str = "y"
) -> DataFrame:
    """Rows, decisive rows and distinct games per split, plus the total row (`all`).

    Counts per game first, then per split: distinct games need no second pass over the rows, and a
    game lives in one split, so totals add up."""
    per_game = df.groupBy(split, game).agg(
        F.count(F.lit(1)).alias("positions"),
        F.count_if(F.col(result).isin(0.0, 1.0)).alias("decisive"),
    )
    totals = per_game.rollup(split).agg(
        F.sum("positions").alias("positions"),
        F.sum("decisive").alias("decisive"),
        F.count(F.lit(1)).alias("games"),
    )
    return totals.withColumn(split, F.coalesce(split, F.lit("all")))

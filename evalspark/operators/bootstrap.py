"""Whole-group bootstrap intervals from per-group sufficient statistics.

The rows are aggregated once into one record per group. A replicate then weights the groups:
weight(replicate, group) is a Poisson(1) draw that is a function of (seed, replicate, group) only,
so any partitioning, retry or lost executor reproduces the same interval. Each task multiplies its
groups' weights with their statistics in small blocks and emits one partial sum per replicate; the
group x replicate table never exists, and only repeats x partitions rows are shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import scoring as sx
from evalspark.operators import multinomial, scoring

REPEATS = 1000
SEED = 13
# Mersenne prime of the hash field, and Poisson(1) inverse-CDF cuts scaled to it.
PRIME = 2147483647
POISSON_CUTS = (
    790015083,
    1580030167,
    1975037709,
    2106706890,
    2139624185,
    2146207644,
    2147304887,
    2147461637,
    2147481230,
    2147483407,
    2147483625,
    2147483645,
)
BLOCK = 512


def coefficients(seed: int, repeats: int) -> np.ndarray:
    """Four field elements per replicate: a cubic hash, so weights are 4-wise independent."""
    out = np.empty((repeats, 4), dtype=np.int64)
    for r in range(repeats):
        for j in range(4):
            digest = hashlib.md5(f"{seed}|{r}|{j}".encode()).hexdigest()
            out[r, j] = int(digest[:8], 16) % PRIME
    return out


def group_point(seed: int, group: Column) -> Column:
    """The group's element of the hash field."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), group.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(PRIME)


def poisson_weights(points: np.ndarray, coef: np.ndarray) -> np.ndarray:
    """(groups, repeats) Poisson(1) weights."""
    h = points[:, None]
    u = coef[:, 3][None, :]
    for j in (2, 1, 0):
        u = (u * h + coef[:, j][None, :]) % PRIME
    return np.searchsorted(np.asarray(POISSON_CUTS), u, side="right").astype(np.float64)


def replicate_sums(
    stats: DataFrame, group: str, columns: list[str], repeats: int = REPEATS, seed: int = SEED
) -> DataFrame:
    """(replicate, *columns, groups): weighted sums of the per-group statistics, and their plain
    sums and group count as replicate -1. `stats` has one row per group and is read once."""
    coef = coefficients(seed, repeats)

    def partial(batches):
        total = np.zeros((repeats + 1, len(columns) + 1))
        seen = False
        for pdf in batches:
            points = pdf["_point"].to_numpy(dtype=np.int64)
            values = pdf[columns].to_numpy(dtype=np.float64)
            values = np.column_stack([values, np.ones(len(values))])
            total[0] += values.sum(axis=0)
            for at in range(0, len(points), BLOCK):
                weights = poisson_weights(points[at : at + BLOCK], coef)
                total[1:] += weights.T @ values[at : at + BLOCK]
                seen = True
        if seen:
            out = pd.DataFrame(total, columns=[*columns, "groups"])
            out.insert(0, "replicate", np.arange(-1, repeats, dtype=np.int32))
            yield out

    narrow = stats.select(
        group_point(seed, F.col(group)).alias("_point"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    )
    names = [*columns, "groups"]
    layout = "replicate int, " + ", ".join(f"`{c}` double" for c in names)
    parts = narrow.mapInPandas(partial, layout)
    return parts.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in names])


def draws(stats: DataFrame, group: str, columns: list[str], repeats: int, seed: int, fixed: bool) -> DataFrame:
    """Weighted sums per replicate: Poisson(1) weights, or exactly as many draws as groups."""
    drawn = multinomial.fixed_sums if fixed else replicate_sums
    return drawn(stats, group, columns, repeats, seed)


def interval(
    values: DataFrame, metrics: list[str], low: float = 0.025, high: float = 0.975
) -> DataFrame:
    """(metric, point, low, high, groups): the plain value and the linear-interpolated percentiles
    of the replicates. At most `repeats` + 1 rows go in; fewer than two groups give null bounds."""
    drawn = F.col("replicate") >= 0
    known = F.col("_groups") >= 2
    bounds = values.agg(
        F.coalesce(F.max(F.when(~drawn, F.col("groups"))), F.lit(0)).cast("long").alias("_groups"),
        *[
            F.percentile(F.when(drawn, F.col(m)), F.array(F.lit(low), F.lit(high))).alias(f"b_{m}")
            for m in metrics
        ],
        *[F.max(F.when(~drawn, F.col(m))).alias(f"p_{m}") for m in metrics],
    )
    rows = [
        F.struct(
            F.lit(m).alias("metric"),
            F.col(f"p_{m}").alias("point"),
            F.when(known, F.get(F.col(f"b_{m}"), 0)).alias("low"),
            F.when(known, F.get(F.col(f"b_{m}"), 1)).alias("high"),
            F.col("_groups").alias("groups"),
        )
        for m in metrics
    ]
    return bounds.select(F.inline(F.array(*rows)))


def group_statistics(
    df: DataFrame, group: str, y: str = "y", p: str = "p", ref: str | None = None
) -> DataFrame:
    """One row per group: counts and loss sums, per-bin sums, and paired loss differences."""
    yy, pp = F.col(y), F.col(p)
    columns = scoring.sum_columns(yy, pp)
    if ref is not None:
        rr = F.col(ref)
        columns.append(F.sum(sx.log_loss(yy, pp) - sx.log_loss(yy, rr)).alias("d_ll"))
        columns.append(F.sum(sx.brier(yy, pp) - sx.brier(yy, rr)).alias("d_br"))
    return df.groupBy(group).agg(*columns)


def score_intervals(
    df: DataFrame,
    group: str,
    y: str = "y",
    p: str = "p",
    ref: str | None = None,
    repeats: int = REPEATS,
    seed: int = SEED,
    fixed: bool = False,
) -> DataFrame:
    """(metric, point, low, high, groups) for prevalence, log loss, Brier, ECE and, with `ref`, the
    paired differences in the same draws. Fewer than two groups give null bounds. `fixed`: every
    replicate draws as many groups as there are (`multinomial`), instead of Poisson(1) weights."""
    stats = group_statistics(df, group, y, p, ref)
    columns = [c for c in stats.columns if c != group]
    sums = draws(stats, group, columns, repeats, seed, fixed).where("n > 0")
    extra = [c for c in ("d_ll", "d_br", "n") if c in columns]
    drawn = scoring.finish(sums, ["replicate", "groups", *extra])
    metrics = ["prevalence", "log_loss", "brier", "ece"]
    if ref is not None:
        drawn = drawn.withColumn("log_loss_delta", F.col("d_ll") / F.col("n")).withColumn(
            "brier_delta", F.col("d_br") / F.col("n")
        )
        metrics += ["log_loss_delta", "brier_delta"]
    return interval(drawn, metrics)


def ratio_interval(
    df: DataFrame,
    group: str,
    value: str,
    name: str,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """(metric, mean, low, high, groups) for the mean of `value` over rows, resampling groups."""
    stats = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("s")
    )
    sums = replicate_sums(stats, group, ["n", "s"], repeats, seed).where("n > 0")
    bounds = interval(sums.withColumn(name, F.col("s") / F.col("n")), [name])
    return bounds.select(
        "metric", F.coalesce("point", F.lit(0.0)).alias("mean"), "low", "high", "groups"
    )


def seed_mean_delta(
    replicates: DataFrame, row: list[str], group: str, y: str, p: str, ref: str
) -> DataFrame:
    """Per row, the loss differences averaged over its seeds."""
    yy = F.col(y)
    return replicates.groupBy(group, *row).agg(
        F.avg(sx.log_loss(yy, F.col(p)) - sx.log_loss(yy, F.col(ref))).alias("log_loss_delta"),
        F.avg(sx.brier(yy, F.col(p)) - sx.brier(yy, F.col(ref))).alias("brier_delta"),
    )


def seed_intervals(
    replicates: DataFrame,
    seed_col: str,
    seeds: list[int],
    group: str,
    y: str,
    p: str,
    ref: str,
    repeats: int = REPEATS,
    seed: int = SEED,
    fixed: bool = False,
) -> DataFrame:
    """(seed, low, high): the paired log-loss interval of every seed, all in the same draws.

    The seeds become columns of one per-group record, so one bootstrap pass serves them all.
    """
    delta = sx.log_loss(F.col(y), F.col(p)) - sx.log_loss(F.col(y), F.col(ref))
    sums = []
    for s in seeds:
        hit = F.col(seed_col) == s
        sums.append(F.count_if(hit).alias(f"n{s}"))
        sums.append(F.sum(F.when(hit, delta).otherwise(0.0)).alias(f"d{s}"))
    stats = replicates.groupBy(group).agg(*sums)
    columns = [f"{kind}{s}" for s in seeds for kind in ("n", "d")]
    drawn = draws(stats, group, columns, repeats, seed, fixed)
    ratios = drawn.select(
        "replicate",
        "groups",
        *[
            F.when(F.col(f"n{s}") > 0, F.col(f"d{s}") / F.col(f"n{s}")).alias(str(s))
            for s in seeds
        ]
    )
    bounds = interval(ratios, [str(s) for s in seeds])
    return bounds.select(F.col("metric").cast("int").alias("seed"), "low", "high")

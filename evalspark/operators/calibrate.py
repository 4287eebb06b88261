"""Temperature search: every grid value is scored in the same pass over the rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalspark.functions import scoring as sx
from evalspark.operators import scoring

# Calibration search grid and the rules it may be selected by.
GRID_MIN = 0.5
GRID_MAX = 3.0
GRID_STEPS = 501
RULES = ("brier", "log_loss", "ece")
BLOCK = 256


def grid(low: float = GRID_MIN, high: float = GRID_MAX, steps: int = GRID_STEPS) -> np.ndarray:
    return np.linspace(low, high, steps)


def temperature_sums(
    df: DataFrame, z: str, y: str, temperatures: np.ndarray, bins: int = scoring.BINS
) -> DataFrame:
    """(step, temperature, partial sums): each task scores its rows against the whole grid in
    blocks and emits one row per grid value, so rows are never multiplied by the grid."""
    t = np.asarray(temperatures, dtype=np.float64)
    names = [f"{kind}{i}" for i in range(bins) for kind in ("bp", "by")]
    columns = ["n", "s_y", "s_ll", "s_br", *names]

    def partial(batches):
        base = np.zeros((len(t), 4))
        bp, by = np.zeros(len(t) * bins), np.zeros(len(t) * bins)
        row = np.arange(len(t))[None, :] * bins
        seen = False
        for pdf in batches:
            zs = pdf["z"].to_numpy(dtype=np.float64)
            ys = pdf["y"].to_numpy(dtype=np.float64)
            for at in range(0, len(zs), BLOCK):
                seen = True
                zz, yy = zs[at : at + BLOCK, None], ys[at : at + BLOCK, None]
                p = 1.0 / (1.0 + np.exp(-zz / t[None, :]))
                q = np.clip(p, sx.EPSILON, 1 - sx.EPSILON)
                base[:, 0] += len(zz)
                base[:, 1] += yy.sum()
                base[:, 2] += (-yy * np.log(q) - (1 - yy) * np.log1p(-q)).sum(axis=0)
                base[:, 3] += ((p - yy) ** 2).sum(axis=0)
                cell = (np.minimum((p * bins).astype(np.int64), bins - 1) + row).ravel()
                bp += np.bincount(cell, weights=p.ravel(), minlength=len(bp))
                by += np.bincount(
                    cell, weights=np.broadcast_to(yy, p.shape).ravel(), minlength=len(by)
                )
        if seen:
            out = pd.DataFrame(base, columns=columns[:4])
            for i in range(bins):
                out[f"bp{i}"] = bp.reshape(len(t), bins)[:, i]
                out[f"by{i}"] = by.reshape(len(t), bins)[:, i]
            out.insert(0, "step", np.arange(len(t), dtype=np.int32))
            out.insert(1, "temperature", t)
            yield out

    rows = df.select(F.col(z).cast("double").alias("z"), F.col(y).cast("double").alias("y"))
    layout = "step int, temperature double, " + ", ".join(f"{c} double" for c in columns)
    parts = rows.mapInPandas(partial, layout)
    return parts.groupBy("step", "temperature").agg(*[F.sum(c).alias(c) for c in columns])


def temperature_scores(
    df: DataFrame, z: str = "z", y: str = "y", temperatures: np.ndarray | None = None
) -> DataFrame:
    """(step, temperature, count, prevalence, log_loss, brier, ece) for the whole grid."""
    t = grid() if temperatures is None else temperatures
    return scoring.finish(temperature_sums(df, z, y, t), ["step", "temperature"])


def select_temperature(scored: DataFrame, rule: str = "brier") -> DataFrame:
    """The grid row with the best score; ties go to the value nearest 1, so an uninformative
    holdout cannot buy a temperature."""
    if rule not in RULES:
        raise ValueError(f"unknown calibration rule {rule!r}")
    best = F.min_by(
        F.struct("temperature", "count", "log_loss", "brier", "ece"),
        F.struct(F.col(rule), F.abs(F.col("temperature") - 1.0), F.col("temperature")),
    )
    return scored.agg(best.alias("b")).select("b.*")

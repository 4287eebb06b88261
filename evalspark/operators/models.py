"""Batch scoring inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def batch_scorer(
    open_session: Callable[[], Callable[[np.ndarray], np.ndarray]],
    width: int,
    clamp: bool = False,
    rows: int = 65536,
) -> Callable[[Column], Column]:
    """A column function scoring array columns. `open_session` runs once per task and returns
    matrix -> vector; Arrow batches are cut to at most `rows`. Wrong widths, lost rows and
    non-finite outputs fail the job."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = open_session()
        for batch in batches:
            out = np.empty(len(batch), dtype=np.float64)
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                # The rows are numpy arrays already; one copy lays them end to end.
                matrix = np.concatenate(part.to_numpy()).reshape(-1, width).astype(np.float32)
                values = np.asarray(run(matrix), dtype=np.float64).reshape(-1)
                if len(values) != len(part):
                    raise ValueError("the model lost rows")
                if not np.isfinite(values).all():
                    raise ValueError("the model returned a non-finite score")
                out[at : at + len(part)] = np.clip(values, 0.0, 1.0) if clamp else values
            yield pd.Series(out)

    def checked(column: Column) -> Column:
        # Widths are judged before the rows leave the JVM; a null array has no width.
        fits = F.size(column) == width
        return score(F.when(fits, column).otherwise(F.raise_error(F.lit(f"expected {width} features per row"))))

    return checked


def linear_session(weights, bias: float = 0.0):
    """A weights-only model with the same interface as a stored one."""
    w = np.asarray(weights, dtype=np.float64)

    def open_session():
        return lambda matrix: matrix.astype(np.float64) @ w + bias

    return open_session


def score_rows(
    df: DataFrame, features: str, scorer: Callable[[Column], Column], name: str = "score"
) -> DataFrame:
    return df.withColumn(name, scorer(F.col(features)))

"""Row-level scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clipping constants of the two scorers.
EPSILON = 1e-15
HOLDOUT_EPSILON = 1e-7


def clip(p: Column, epsilon: float) -> Column:
    return F.least(F.greatest(p, F.lit(epsilon)), F.lit(1.0 - epsilon))


def log_loss(y: Column, p: Column, epsilon: float = EPSILON) -> Column:
    q = clip(p, epsilon)
    return -y * F.ln(q) - (1 - y) * F.log1p(-q)


def holdout_log_loss(y: Column, p: Column, epsilon: float = HOLDOUT_EPSILON) -> Column:
    q = clip(p, epsilon)
    return -(y * F.ln(q) + (1 - y) * F.ln(1 - q))


def brier(y: Column, p: Column) -> Column:
    return (p - y) * (p - y)


def calibration_bin(p: Column, bins: int = 10) -> Column:
    """Truncating bin index; p = 1 falls in the last bin."""
    return F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")


def edge_bin(p: Column, bins: int = 10) -> Column:
    """Bin by comparison with the edges i * (1/bins), the last bin closed. Differs from the
    truncating index when p * bins rounds across an edge."""
    edges = [i * (1.0 / bins) for i in range(1, bins)]
    return sum((p >= F.lit(e)).cast("int") for e in edges)


def tempered_sigmoid(z: Column, temperature) -> Column:
    t = temperature if isinstance(temperature, Column) else F.lit(float(temperature))
    return 1 / (1 + F.exp(-z / t))


def unit_clamp(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))


def relative_overhead(value: Column, base: Column) -> Column:
    return (value - base) / base


def inverse_square_gain(rank: Column) -> Column:
    return 1 / (rank * rank)


def rank_discount(position: Column) -> Column:
    """NDCG discount of the i-th place, counted from one."""
    return 1 / F.log2(position + 1)


def dot(features: Column, weights) -> Column:
    """Linear score of a fixed-width feature array, unrolled so that it compiles."""
    terms = [F.get(features, i).cast("double") * F.lit(float(w)) for i, w in enumerate(weights)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def close(a: Column, b: Column, tolerance: float) -> Column:
    """Arrays of equal length whose elements differ by at most `tolerance`. A missing partner makes
    the difference null, which is not close."""
    gaps = F.zip_with(a, b, lambda x, y: F.coalesce(F.abs(x - y) <= tolerance, F.lit(False)))
    return F.coalesce(F.forall(gaps, lambda ok: ok), F.lit(False))


def finite(value: Column) -> Column:
    return (
        value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))
    )


def all_finite(values: Column) -> Column:
    return F.coalesce(F.forall(values, finite), F.lit(False))


def r6(value: Column) -> Column:
    """Six decimals, without negative zero, for reports that are compared by value."""
    return F.round(value.cast("double"), 6) + F.lit(0.0)

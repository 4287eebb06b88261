"""Comparing two tables that should agree, and pairs of rows inside one table.

Comparisons are a grouped union, not a full outer join: both sides are tagged, reduced per key by
partial aggregation, and judged per key. Repeated keys are counted instead of multiplied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import scoring as sx


def side_by_side(
    left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]
) -> DataFrame:
    """(keys, n_left, n_right, l_*, r_*): the smallest value of each column per side and key."""

    def tag(df: DataFrame, side: str) -> DataFrame:
        other = "r" if side == "l" else "l"
        values = F.struct(*[F.col(c) for c in columns])
        mine = values.alias(f"_{side}")
        blank = F.lit(None).cast(df.select(values.alias("v")).schema["v"].dataType)
        return df.select(
            *keys,
            F.lit(1 if side == "l" else 0).alias("_nl"),
            F.lit(1 if side == "r" else 0).alias("_nr"),
            mine,
            blank.alias(f"_{other}"),
        )

    both = tag(left, "l").unionByName(tag(right, "r"))
    merged = both.groupBy(*keys).agg(
        F.sum("_nl").alias("n_left"),
        F.sum("_nr").alias("n_right"),
        F.min("_l").alias("_l"),
        F.min("_r").alias("_r"),
    )
    return merged.select(
        *keys,
        "n_left",
        "n_right",
        *[F.col("_l")[c].alias(f"l_{c}") for c in columns],
        *[F.col("_r")[c].alias(f"r_{c}") for c in columns],
    )


def coverage(left: DataFrame, right: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row: keys on both sides, missing on the right, extra on the right, repeated keys, and a
    null-safe mismatch count per column over the shared keys."""
    pairs = side_by_side(left, right, keys, columns)
    shared = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    return pairs.agg(
        F.count_if(shared).alias("shared"),
        F.count_if(F.col("n_right") == 0).alias("missing"),
        F.count_if(F.col("n_left") == 0).alias("extra"),
        F.count_if((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("repeated"),
        *[
            F.count_if(shared & ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).alias(
                f"mismatch_{c}"
            )
            for c in columns
        ],
    )


def schema_alignment(
    base: DataFrame,
    other: DataFrame,
    keys: list[str],
    source_columns: list[str],
    prefix: list[str],
) -> DataFrame:
    """Do two feature tables describe the same rows? Key coverage and uniqueness, equal source
    columns, and float-identical shared feature prefix, in one shuffle."""
    report = coverage(base, other, keys, [*source_columns, *prefix])
    bad_source = sum(F.col(f"mismatch_{c}") for c in source_columns)
    bad_prefix = sum(F.col(f"mismatch_{c}") for c in prefix)
    return report.select(
        "shared",
        "missing",
        "extra",
        "repeated",
        bad_source.alias("source_mismatches"),
        bad_prefix.alias("prefix_mismatches"),
    ).withColumn(
        "aligned",
        (F.col("missing") + F.col("extra") + F.col("repeated") == 0)
        & (F.col("source_mismatches") + F.col("prefix_mismatches") == 0),
    )


def prediction_parity(
    left: DataFrame, right: DataFrame, key: str, value: str, tolerance: float = 1e-6
) -> DataFrame:
    """One row: shared, missing, extra, repeated keys, null answers, rows beyond the tolerance, the
    largest absolute error, and whether the two runs agree; a repeated key fails."""
    pairs = side_by_side(left, right, [key], [value])
    error = F.abs(F.col(f"l_{value}") - F.col(f"r_{value}"))
    shared = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    unknown = F.col(f"l_{value}").isNull() | F.col(f"r_{value}").isNull()
    report = pairs.agg(
        F.count_if(shared).alias("shared"),
        F.count_if(F.col("n_right") == 0).alias("missing"),
        F.count_if(F.col("n_left") == 0).alias("extra"),
        F.count_if((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("repeated"),
        F.count_if(shared & unknown).alias("null_answers"),
        F.count_if(shared & (error > tolerance)).alias("beyond_tolerance"),
        F.max(error).alias("max_abs_error"),
    )
    return report.withColumn(
        "passed",
        (F.col("missing") + F.col("extra") + F.col("repeated") + F.col("null_answers") == 0)
        & (F.coalesce("max_abs_error", F.lit(float("inf"))) <= tolerance),
    )


def stored_against_expected(
    stored: DataFrame, expected: DataFrame, keys: list[str], tolerance: float = 1e-6
) -> DataFrame:
    """Counters of a stored candidate table against the expected one: missing, extra, repeated
    keys (on either side), result, side, feature (beyond `tolerance`) and terminal-label mismatches. Both sides carry
    result_fen, side, features and terminal."""
    columns = ["result_fen", "side", "features", "terminal"]
    pairs = side_by_side(stored, expected, keys, columns)
    shared = (F.col("n_left") > 0) & (F.col("n_right") > 0)
    near = sx.close(F.col("l_features"), F.col("r_features"), tolerance)
    return pairs.agg(
        F.count_if(F.col("n_left") > 0).alias("stored"),
        F.count_if(F.col("n_left") == 0).alias("missing"),
        F.count_if(F.col("n_right") == 0).alias("extra"),
        F.count_if((F.col("n_left") > 1) | (F.col("n_right") > 1)).alias("repeated"),
        F.count_if(shared & (F.col("l_result_fen") != F.col("r_result_fen"))).alias(
            "result_mismatches"
        ),
        F.count_if(shared & (F.col("l_side") != F.col("r_side"))).alias("side_mismatches"),
        F.count_if(shared & ~near).alias("feature_mismatches"),
        F.count_if(shared & F.col("r_terminal")).alias("terminal_candidates"),
        F.count_if(shared & (F.col("l_terminal") != F.col("r_terminal"))).alias(
            "terminal_mismatches"
        ),
    )


def collisions(df: DataFrame, group: str, narrow: str, full: str) -> DataFrame:
    """(group, narrow, states, first_full, last_full): normalised keys that cover several full
    states."""
    states = df.groupBy(group, narrow, full).agg(F.count(F.lit(1)).alias("_n"))
    return (
        states.groupBy(group, narrow)
        .agg(
            F.count(F.lit(1)).alias("states"),
            F.min(full).alias("first_full"),
            F.max(full).alias("last_full"),
        )
        .where("states > 1")
    )


def collision_counts(found: DataFrame) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("collision_keys"),
        F.coalesce(F.sum(F.col("states") - 1), F.lit(0)).alias("lost_states"),
    )


def witnesses(found: DataFrame, order: list[str], limit: int = 8) -> DataFrame:
    """The first few examples in a stated order."""
    return found.orderBy(*order).limit(limit)


def paired_rows(df: DataFrame, base: Column, second: Column, columns: list[str]) -> DataFrame:
    """(base, a_*, b_*, halves): the two halves of each pair side by side. `second` marks the
    half that becomes b. One shuffle on the base id; incomplete pairs have halves < 2."""
    tagged = df.select(base.alias("base"), second.alias("_b"), *columns)
    out = [F.count(F.lit(1)).alias("halves")]
    for c in columns:
        out.append(F.min(F.when(~F.col("_b"), F.col(c))).alias(f"a_{c}"))
        out.append(F.min(F.when(F.col("_b"), F.col(c))).alias(f"b_{c}"))
    return tagged.groupBy("base").agg(*out)


def twin_checks(df: DataFrame, id_col: str, p: str, tolerance: float = 1e-5) -> DataFrame:
    """`x-twin` against `x`: absolute difference and whether it is within the tolerance. Twins
    without a base are reported as incomplete."""
    is_twin = F.col(id_col).endswith("-twin")
    base = F.regexp_replace(F.col(id_col), "-twin$", "")
    pairs = paired_rows(df, base, is_twin, [p])
    return pairs.where(F.col(f"b_{p}").isNotNull()).select(
        "base",
        F.col(f"a_{p}").isNotNull().alias("complete"),
        F.abs(F.col(f"a_{p}") - F.col(f"b_{p}")).alias("difference"),
        F.coalesce(
            F.abs(F.col(f"a_{p}") - F.col(f"b_{p}")) <= tolerance, F.lit(False)
        ).alias("passed"),
    )


def order_checks(df: DataFrame, id_col: str, p: str, chains: dict[str, list[str]]) -> DataFrame:
    """(check, passed): each named chain of ids must have strictly decreasing probabilities."""
    wanted = sorted({i for chain in chains.values() for i in chain})
    row = df.where(F.col(id_col).isin(*wanted)).agg(
        *[F.min(F.when(F.col(id_col) == i, F.col(p))).alias(f"v{n}") for n, i in enumerate(wanted)]
    )
    at = {i: F.col(f"v{n}") for n, i in enumerate(wanted)}
    checks = []
    for name, chain in chains.items():
        ok = F.lit(True)
        for a, b in zip(chain, chain[1:]):
            ok = ok & (at[a] > at[b])
        checks.append(
            F.struct(F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("passed"))
        )
    return row.select(F.inline(F.array(*checks)))


def pair_margins(df: DataFrame, id_col: str, score: str) -> DataFrame:
    """`name-blunder` against `name-safe`: margin, strict pass (a tie fails), completeness."""
    base = F.regexp_replace(F.col(id_col), "-(blunder|safe)$", "")
    pairs = paired_rows(df, base, F.col(id_col).endswith("-safe"), [score])
    a, b = F.col(f"a_{score}"), F.col(f"b_{score}")
    return pairs.select(
        F.col("base").alias("pair"),
        a.alias("blunder"),
        b.alias("safe"),
        (b - a).alias("margin"),
        F.coalesce(b > a, F.lit(False)).alias("passed"),
        (a.isNotNull() & b.isNotNull()).alias("complete"),
    )


def certify_pairs(df: DataFrame, id_col: str, danger: str, margin: float = 0.2) -> DataFrame:
    """A pair is a test only while its blunder is at least `margin` more exposed."""
    base = F.regexp_replace(F.col(id_col), "-(blunder|safe)$", "")
    pairs = paired_rows(df, base, F.col(id_col).endswith("-safe"), [danger])
    gap = F.col(f"a_{danger}") - F.col(f"b_{danger}")
    return pairs.select(
        F.col("base").alias("pair"),
        gap.alias("danger_margin"),
        F.coalesce(gap >= margin, F.lit(False)).alias("certified"),
    )


def visible_differences(
    df: DataFrame, base: Column, second: Column, columns: list[str]
) -> DataFrame:
    """(base, feature, a, b) for every named feature that differs inside a pair."""
    pairs = paired_rows(df, base, second, columns).where("halves = 2")
    entries = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"a_{c}").cast("double").alias("a"),
            F.col(f"b_{c}").cast("double").alias("b"),
        )
        for c in columns
    ]
    return pairs.select("base", F.inline(F.array(*entries))).where("not (a <=> b)")


def golden_mismatches(
    rows: DataFrame, golden: DataFrame, key: str, features: str, tolerance: float = 1e-6
) -> DataFrame:
    """One row: rows matched to a golden vector and rows whose vector is not close to it."""
    expected = golden.select(key, F.col(features).alias("_golden"))
    near = sx.close(F.col(features), F.col("_golden"), tolerance)
    return rows.join(expected, key).agg(
        F.count(F.lit(1)).alias("matched"), F.count_if(~near).alias("mismatched")
    )


def twin_safety(
    df: DataFrame, base: Column, second: Column, features: str, p: str, signal: list[int],
    tolerance: float, reviewed: bool,
) -> DataFrame:
    """Twins must share their vector, carry signal in the named features and agree in p."""
    pairs = paired_rows(df, base, second, [features, p])
    a = F.col(f"a_{features}")
    strong = F.lit(False)
    for i in signal:
        strong = strong | (F.get(a, i) > 0)
    same = a.eqNullSafe(F.col(f"b_{features}"))
    gap = F.abs(F.col(f"a_{p}") - F.col(f"b_{p}"))
    return pairs.where("halves = 2").select(
        "base",
        same.alias("same_features"),
        F.coalesce(strong, F.lit(False)).alias("signal"),
        gap.alias("difference"),
        F.coalesce(same & strong & (gap <= tolerance) & F.lit(reviewed), F.lit(False)).alias(
            "passed"
        ),
    )

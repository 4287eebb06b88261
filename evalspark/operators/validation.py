"""Row rules as violation tables: one pass, one row per rule, and an action that fails closed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.functions import scoring as sx
from evalspark.sources import schemas


class Refused(ValueError):
    """A dataset broke a rule; nothing of it may be used."""


def violations(df: DataFrame, rules: dict[str, Column], key) -> DataFrame:
    """(rule, n, sample_key): how many rows break each rule, with the smallest offending key.

    A rule is the condition of a *bad* row; null counts as bad, so a rule cannot pass by being
    unknown. One partial + final aggregation whatever the number of rules.
    """
    key = F.col(key) if isinstance(key, str) else key
    names = list(rules)
    # Each rule becomes a boolean column first, so it is evaluated once for count and sample.
    judged = df.select(
        key.cast("string").alias("_key"),
        *[F.coalesce(rules[name], F.lit(True)).alias(f"_r{i}") for i, name in enumerate(names)],
    )
    measures = []
    for i in range(len(names)):
        measures.append(F.count_if(F.col(f"_r{i}")).alias(f"n{i}"))
        measures.append(F.min(F.when(F.col(f"_r{i}"), F.col("_key"))).alias(f"k{i}"))
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"n{i}").alias("n"),
            F.col(f"k{i}").alias("sample_key"),
        )
        for i, name in enumerate(names)
    ]
    return judged.agg(*measures).select(F.inline(F.array(*rows)))


def require_clean(report: DataFrame, what: str = "dataset") -> None:
    """Action: raise with every broken rule of a violations table."""
    broken = report.where("n > 0").orderBy("rule").collect()
    if broken:
        detail = ", ".join(f"{r['rule']}={r['n']}" for r in broken)
        raise Refused(f"{what} refused: {detail}")


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Action: an empty result is a refusal, not a result."""
    if df.isEmpty():
        raise Refused(f"{what}: nothing left")
    return df


def null_rules(columns) -> dict[str, Column]:
    return {f"null_{c}": F.col(c).isNull() for c in columns}


def position_rules() -> dict[str, Column]:
    rules = null_rules(schemas.POSITION_COLUMNS)
    rules["blank_fen"] = F.trim("fen") == ""
    rules["negative_ply"] = F.col("ply") < 0
    rules["side_domain"] = ~F.col("side").isin(*schemas.SIDES)
    rules["result_domain"] = ~F.col("result").isin(*schemas.RESULTS)
    rules["dice"] = ~fx.valid_dice("dice")
    return rules


def feature_rules(columns) -> dict[str, Column]:
    return {f"not_finite_{c}": ~sx.finite(F.col(c)) for c in columns}


def side_rule() -> dict[str, Column]:
    return {"side_mismatch": fx.active_colour("fen") != F.col("side")}


def separator_rules(columns) -> dict[str, Column]:
    return {f"separator_{c}": F.col(c).rlike(r"[\t\n\r]") for c in columns}


def bundle_rules(width: int = 13, tolerance: float = 1e-6) -> dict[str, Column]:
    """One row of a rows bundle: identities, position, outcome and feature vector."""
    board = fx.placement("fen")
    parts = fx.fields("fen")
    rules = {
        f"blank_{c}": F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
        for c in ("id", "group_id", "game_id")
    }
    rules["fen_fields"] = ~(F.size(parts).isin(4, 6) & F.get(parts, 1).isin("w", "b"))
    rules["fen_side"] = fx.active_colour("fen") != F.col("side")
    rules["ply"] = F.col("ply").isNull() | (F.col("ply") < 0)
    rules["result"] = ~F.col("result").isin(*schemas.RESULTS)
    rules["kings"] = ~fx.one_king_each(board)
    rules["placement"] = ~fx.valid_placement(board)
    rules["features"] = (F.size("features") != width) | ~sx.all_finite(F.col("features"))
    rules["material"] = ~sx.close(
        F.slice("features", 1, 7), fx.material_block("fen", "side"), tolerance
    )
    return rules


def metric_rules(y: str = "y", p: str = "p") -> dict[str, Column]:
    return {
        "not_finite": ~(sx.finite(F.col(y)) & sx.finite(F.col(p))),
        "target_domain": ~F.col(y).isin(0.0, 1.0),
        "probability_domain": (F.col(p) < 0) | (F.col(p) > 1),
    }


def group_rules(width: int = 9) -> dict[str, Column]:
    """A nested candidate list, judged without exploding it."""
    c = F.col("candidates")
    canonical = fx.position_key("root_fen")
    return {
        "game": F.coalesce(F.trim("game_id"), F.lit("")) == "",
        "dice": ~(fx.valid_dice("dice") & (fx.canonical_dice("dice") == F.col("dice"))),
        "side": ~F.col("side").isin("w", "b"),
        "root_side": fx.active_colour("root_fen") != F.col("side"),
        "group_id": hashing.group_id_for(canonical, F.col("dice")) != F.col("group_id"),
        "no_candidates": F.coalesce(F.size(c), F.lit(0)) <= 0,
        "moves": F.exists(
            c,
            lambda x: x.moves.isNull()
            | (F.size(x.moves) == 0)
            | F.exists(x.moves, lambda m: F.coalesce(m, F.lit("")) == ""),
        ),
        "result_fen": F.exists(c, lambda x: F.coalesce(F.trim(x.result_fen), F.lit("")) == ""),
        "repeated_result": F.size(F.array_distinct(F.transform(c, lambda x: x.result_fen)))
        != F.size(c),
        "features": F.exists(
            c, lambda x: (F.size(x.features) != width) | ~sx.all_finite(x.features)
        ),
        "target": F.exists(c, lambda x: ~sx.finite(x.target)),
    }


# Layout of the sparse king-relative ids.
SPARSE_VOCABULARY = 2 * 16 * 10 * 64
SPARSE_TOKENS = 64


def sparse_rules() -> dict[str, Column]:
    """One row of the experimental corpus: dense a[9], b[13], sparse c[2], target, terminal."""
    half = SPARSE_VOCABULARY // 2
    a, b, c = F.col("a"), F.col("b"), F.col("c")

    def bad_anchor(ids: Column, anchor: int) -> Column:
        ordered = F.array_sort(F.array_distinct(ids)) == ids
        in_half = F.forall(ids, lambda i: (i >= anchor * half) & (i < (anchor + 1) * half))
        return ~(ordered & in_half & (F.size(ids) <= SPARSE_TOKENS))

    return {
        "width": (F.size(a) != 9) | (F.size(b) != 13) | (F.size(c) != 2),
        "not_finite": ~(sx.all_finite(a) & sx.all_finite(b)),
        "prefix": F.slice(b, 1, 9) != a,
        "ids_own": bad_anchor(F.get(c, 0), 0),
        "ids_other": bad_anchor(F.get(c, 1), 1),
        "target_range": (F.col("target") < -(2**31))
        | (F.col("target") > schemas.TERMINAL_TARGET),
        "terminal_sentinel": F.col("terminal") != (F.col("target") == schemas.TERMINAL_TARGET),
        "terminal_ids": F.col("terminal") & (F.size(F.flatten(c)) > 0),
    }


def latency_rules() -> dict[str, Column]:
    """Ordered, positive, finite latency summaries."""
    names = ("min_us", "median_us", "p95_us", "max_us")
    rules = {
        f"not_positive_{n}": ~(sx.finite(F.col(n)) & (F.col(n) > 0)) for n in names
    }
    rules["order"] = ~(
        (F.col("min_us") <= F.col("median_us"))
        & (F.col("median_us") <= F.col("p95_us"))
        & (F.col("p95_us") <= F.col("max_us"))
    )
    return rules


def metadata_rules(expected: dict[str, str]) -> dict[str, Column]:
    """File identity: every expected key of the `metadata` map has exactly the expected value."""
    return {
        f"metadata_{k}": ~F.coalesce(F.try_element_at("metadata", F.lit(k)) == v, F.lit(False))
        for k, v in expected.items()
    }


def layout_problems(df: DataFrame, columns) -> list[str]:
    """Driver-side schema check of an enriched table: base columns with exact types, then exactly
    the named float features in order."""
    wanted = [(f.name, f.dataType) for f in schemas.enriched(columns).fields]
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    problems = []
    for i, (name, kind) in enumerate(wanted):
        if i >= len(actual):
            problems.append(f"missing {name}")
        elif actual[i][0] != name:
            problems.append(f"position {i}: expected {name}, found {actual[i][0]}")
        elif actual[i][1] != kind:
            problems.append(f"{name}: expected {kind.simpleString()}")
    problems += [f"unexpected {name}" for name, _ in actual[len(wanted):]]
    return problems


def require_layout(df: DataFrame, columns) -> DataFrame:
    problems = layout_problems(df, columns)
    if problems:
        raise Refused("layout refused: " + "; ".join(problems))
    return df


def probability_bounds(df: DataFrame, source: str, output: str) -> DataFrame:
    """Per source: rows, all finite, all inside [0, 1], and the range when finite."""
    value = F.col(output)
    good = sx.finite(value)
    summary = df.groupBy(source).agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(good).alias("all_finite"),
        F.bool_and(good & (value >= 0) & (value <= 1)).alias("within_unit_interval"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    return summary.select(
        source,
        "rows",
        "all_finite",
        "within_unit_interval",
        F.when(F.col("all_finite"), F.col("low")).alias("min"),
        F.when(F.col("all_finite"), F.col("high")).alias("max"),
    )

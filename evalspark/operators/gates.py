"""Promotion gates: metric rows in, reason lists and selections out. All inputs are report-sized."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.operators import bootstrap, ordering, scoring


@dataclass(frozen=True)
class GateRules:
    """Thresholds of the evaluation protocol."""

    min_groups: int = 30
    min_slice_groups: int = 10
    min_relative_log_loss_gain: float = 0.01
    max_brier_regression: float = 0.0
    max_ece_regression: float = 0.01
    max_slice_log_loss_regression: float = 0.01
    max_slice_brier_regression: float = 0.01
    max_unseen_log_loss_regression: float = 0.01
    max_unseen_brier_regression: float = 0.0
    max_extraction_latency_overhead: float = 0.1


def reasons(checks: dict[str, Column]) -> Column:
    """array<string>: names of the conditions that do not hold; unknown does not hold."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return F.filter(F.array(*failed), lambda x: x.isNotNull())


def gate(row: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Whole-set gate. Expects groups, {log_loss, brier, ece}, the same with `ref_`, and
    delta_high (upper bound of the paired log-loss interval, null if not estimable)."""
    c, r = F.col, lambda m: F.col(f"ref_{m}")
    checks = {
        "insufficient-groups": c("groups") >= rules.min_groups,
        "insufficient-relative-gain": c("log_loss")
        <= r("log_loss") * (1 - rules.min_relative_log_loss_gain),
        "brier-regression": c("brier") - r("brier") <= rules.max_brier_regression,
        "calibration-regression": c("ece") - r("ece") <= rules.max_ece_regression,
        "uncertain-improvement": c("delta_high") < 0,
    }
    return row.withColumn("reasons", reasons(checks))


def gate_row(rows: DataFrame, group: str, y: str, p: str, ref: str) -> DataFrame:
    """The one-row input of `gate`: candidate and reference scores, groups, upper bound of the
    paired log-loss interval."""
    both = scoring.paired_scores(rows, y, p, ref)
    bound = bootstrap.score_intervals(rows, group, y, p, ref).where("metric = 'log_loss_delta'")
    return both.withColumn("_b", ordering.one_row(bound.select("high", "groups"))).select(
        *both.columns, F.col("_b.high").alias("delta_high"), F.col("_b.groups").alias("groups")
    )


def slice_gate(rows: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Critical-slice gate on rows with groups, log_loss, brier and ref_log_loss, ref_brier."""
    checks = {
        "insufficient-groups": F.col("groups") >= rules.min_slice_groups,
        "slice-log-loss-regression": F.col("log_loss") - F.col("ref_log_loss")
        <= rules.max_slice_log_loss_regression,
        "slice-brier-regression": F.col("brier") - F.col("ref_brier")
        <= rules.max_slice_brier_regression,
    }
    return rows.withColumn("reasons", reasons(checks))


def unseen_gate(row: DataFrame, rules: GateRules = GateRules()) -> DataFrame:
    """Gate on the validation rows whose position the train rows never show. Expects one row with
    count, {log_loss, brier} and the same with `ref_`. No unseen rows is a reason, not a pass."""
    checks = {
        "no-unseen-positions": F.col("count") > 0,
        "unseen-log-loss-regression": F.col("log_loss") - F.col("ref_log_loss")
        <= rules.max_unseen_log_loss_regression,
        "unseen-brier-regression": F.col("brier") - F.col("ref_brier")
        <= rules.max_unseen_brier_regression,
    }
    return row.withColumn("reasons", reasons(checks))


def cost_gate(
    overheads: DataFrame, candidates: DataFrame, rules: GateRules = GateRules(),
    schema: str = "schema",
) -> DataFrame:
    """(schema, mean_overhead, reasons) of every candidate. `overheads` holds one row per schema
    with its mean relative cost; a candidate without one has no evidence, which is a reason."""
    known = candidates.join(overheads.select(schema, "mean_overhead"), schema, "left")
    checks = {
        "missing-extraction-cost-evidence": F.col("mean_overhead").isNotNull(),
        "extraction-latency-overhead-exceeded": F.col("mean_overhead")
        <= rules.max_extraction_latency_overhead,
    }
    return known.withColumn("reasons", reasons(checks))


def slice_regressions(candidate: DataFrame, baseline: DataFrame, key: str = "slice") -> DataFrame:
    """(slice, log_loss_delta, brier_delta) on slices measured by both."""
    base = baseline.select(
        key, F.col("log_loss").alias("_ll"), F.col("brier").alias("_br")
    )
    return candidate.join(base, key).select(
        key,
        (F.col("log_loss") - F.col("_ll")).alias("log_loss_delta"),
        (F.col("brier") - F.col("_br")).alias("brier_delta"),
    )


def worst_regression(deltas: DataFrame) -> DataFrame:
    """The largest slice regressions, floored at zero."""
    return deltas.agg(
        F.greatest(F.lit(0.0), F.max("log_loss_delta")).alias("max_log_loss_regression"),
        F.greatest(F.lit(0.0), F.max("brier_delta")).alias("max_brier_regression"),
    )


def admissibility(summary: DataFrame, reference: Column, metric: str = "log_loss") -> DataFrame:
    """Margin to the no-information reference; admissible only when strictly better."""
    return summary.withColumn("margin", reference - F.col(metric)).withColumn(
        "admissible", F.col(metric) < reference
    )


def select_schema(
    arms: DataFrame, baseline: str, schema: str = "schema", metric: str = "log_loss"
) -> DataFrame:
    """(selected): the cleared arm with the lowest metric (the earlier name on a tie), else the
    baseline when it is admissible, else null. Expects cleared and admissible flags."""
    best = F.min(
        F.when(F.col("cleared") & (F.col(schema) != baseline), F.struct(F.col(metric), F.col(schema)))
    )
    fallback = F.max(F.when((F.col(schema) == baseline) & F.col("admissible"), F.col(schema)))
    return arms.agg(best.alias("b"), fallback.alias("f")).select(
        F.coalesce(F.col("b")[schema], F.col("f")).alias("selected")
    )


def seed_range(
    runs: DataFrame, protocol_seeds, seed: str = "seed", learned: str = "recall",
    floor: str = "floor_recall",
) -> DataFrame:
    """The headline as a range: min and max over seeds, how many seeds beat the floor, and whether
    the protocol's seeds are all present, once each, and no others."""
    expected = F.array(*[F.lit(s) for s in sorted(protocol_seeds)])
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.min(learned).alias("min_recall"),
        F.max(learned).alias("max_recall"),
        F.min(floor).alias("min_floor_recall"),
        F.max(floor).alias("max_floor_recall"),
        F.count_if(F.col(learned) > F.col(floor)).alias("admissible_seeds"),
        F.count_if(~(F.col(learned) > F.col(floor))).alias("inadmissible_seeds"),
        F.array_sort(F.collect_list(F.col(seed).cast("int"))).alias("_seeds"),
    ).select(
        "*", (F.col("_seeds") == expected).alias("complete")
    ).drop("_seeds")


def pick_budget(scored: DataFrame, budget: str, loss: str) -> DataFrame:
    """(selected, loss): the lowest loss, the smallest budget on a tie."""
    best = F.min(F.struct(F.col(loss).alias("loss"), F.col(budget).alias("budget")))
    return scored.agg(best.alias("b")).select(
        F.col("b.budget").alias("selected"), F.col("b.loss").alias("loss")
    )

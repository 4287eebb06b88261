"""Candidate lists: gains, shortlists, recall, NDCG, listwise losses, paired comparisons.

A list may hold millions of candidates, so nothing here collects or sorts a whole list in one
task: targets are reduced to a (list, target) histogram by partial aggregation, shortlists are
cut in two salted rounds, and log-sum-exp is accumulated in exponent bins in a single pass.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evalspark.functions import hashing
from evalspark.functions import scoring as sx
from evalspark.operators import bootstrap, ordering
from evalspark.session import materialise

# Fixed value: shortlist widths of the report.
WIDTHS = (1, 2, 8, 16, 24, 48)
EXP_BIN = 32


def list_stats(cands: DataFrame, group: str = "group_id", target: str = "target") -> DataFrame:
    """Per list: size, best target and number of distinct targets."""
    h = ordering.histogram(cands, [group], target)
    return h.groupBy(group).agg(
        F.sum("n").alias("size"),
        F.max(target).alias("best"),
        F.count(F.lit(1)).alias("distinct_targets"),
    )


def with_list_context(
    cands: DataFrame, group: str = "group_id", target: str = "target"
) -> DataFrame:
    """Each candidate with its list's size, best target and distinct targets."""
    return cands.join(list_stats(cands, group, target), group)


def trainable(cands: DataFrame, group: str = "group_id", minimum: int = 2) -> DataFrame:
    """Candidates of lists with at least `minimum` entries."""
    big = cands.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= minimum)
    return cands.join(big.select(group), group, "left_semi")


def gain_table(
    cands: DataFrame, group: str = "group_id", target: str = "target", **sums
) -> DataFrame:
    """(group, target, n, through, avg_rank, gain): the gain shared by every candidate of the list
    with that target. Descending average rank -> 1 / rank^2, summing to one over the list.

    Candidates with equal targets always share their gain, so the table is as wide as the
    distinct targets, not as the list. Extra `sums` ride along in the same pass. Histogram and
    result are written once to the shared folder: sizing, ranking and every later use of the gains
    then read these small tables instead of scanning and ranking the candidates again.
    """
    h = materialise(ordering.histogram(cands, [group], target, **sums), "target-histogram")
    run = ordering.running_total(h, [group], [-F.col(target)], "n", "through")
    rank = F.col("through") - (F.col("n") - 1) / 2
    raw = run.withColumn("avg_rank", rank).withColumn("_raw", sx.inverse_square_gain(rank))
    total = raw.groupBy(group).agg(F.sum(F.col("n") * F.col("_raw")).alias("_total"))
    gains = raw.join(total, group).withColumn("gain", F.col("_raw") / F.col("_total"))
    return materialise(gains.drop("_raw", "_total"), "gains")


def target_gains(
    cands: DataFrame, group: str = "group_id", target: str = "target"
) -> DataFrame:
    """Every candidate with its average rank and gain."""
    table = gain_table(cands, group, target).select(group, target, "avg_rank", "gain")
    return cands.join(table, [group, target])


def shortlist(
    cands: DataFrame,
    k: int,
    group: str = "group_id",
    score: str = "score",
    tie: str = "cand_idx",
    terminal: str | None = None,
) -> DataFrame:
    """The k best candidates of each list with their `position`; ties by candidate index, terminal
    rows first when the column is named."""
    order = [-F.col(score), F.col(tie)]
    if terminal is not None:
        order = [
            F.when(F.col(terminal), 0).otherwise(1),
            F.when(F.col(terminal), F.lit(0.0)).otherwise(-F.col(score)),
            F.col(tie),
        ]
    return ordering.top_rows(cands, [group], order, k)


def _measured_orders(
    cands: DataFrame,
    orders: dict[str, str],
    widths,
    group: str,
    target: str,
    tie: str,
    gains: DataFrame | None,
    terminal: str | None,
) -> DataFrame:
    """(group, k, size, <prefix>hit, <prefix>ndcg) of several orderings of the same lists.

    Per list at most max(widths) rows per ordering, with their gains, plus the ideal order read
    from the gain table. One aggregation turns them into all widths of all orderings at once.
    """
    top_k = max(widths)
    table = gain_table(cands, group, target) if gains is None else gains
    stats = table.groupBy(group).agg(F.sum("n").alias("size"), F.max(target).alias("best"))
    gain_of = table.select(group, target, "gain")
    names = list(orders)
    picked = [
        shortlist(cands, top_k, group, score, tie, terminal)
        .select(group, target, "position")
        .withColumn("_order", F.lit(i))
        for i, score in enumerate(orders.values())
    ]
    picked = reduce(DataFrame.unionByName, picked).join(gain_of, [group, target])
    first = F.col("through") - F.col("n") + 1
    ideal = table.where(first <= top_k).select(
        group,
        target,
        F.explode(
            F.sequence(first, F.least(F.col("through"), F.lit(top_k))).cast("array<int>")
        ).alias("position"),
        F.lit(-1).alias("_order"),
        "gain",
    )
    both = picked.unionByName(ideal).join(stats, group)
    term = F.col("gain") * sx.rank_discount(F.col("position"))
    measures = []
    for k in widths:
        inside = F.col("position") <= k
        measures.append(F.sum(F.when(inside & (F.col("_order") == -1), term)).alias(f"ideal{k}"))
        for i, _ in enumerate(names):
            mine = inside & (F.col("_order") == i)
            kept = mine & (F.col(target) == F.col("best"))
            measures.append(F.max(kept).alias(f"hit{k}_{i}"))
            measures.append(F.sum(F.when(mine, term)).alias(f"dcg{k}_{i}"))
    wide = both.groupBy(group, "size").agg(*measures)

    def at(k: int) -> Column:
        best = F.col(f"ideal{k}")
        fields = [F.lit(k).alias("k")]
        for i, name in enumerate(names):
            ratio = F.when(best > 0, F.col(f"dcg{k}_{i}") / best).otherwise(1.0)
            fields += [F.col(f"hit{k}_{i}").alias(f"{name}hit"), ratio.alias(f"{name}ndcg")]
        return F.struct(*fields)

    rows = wide.select(group, "size", F.inline(F.array(*[at(k) for k in widths])))
    return rows.where(F.col("size") > F.col("k"))


def width_metrics(
    cands: DataFrame,
    widths=WIDTHS,
    group: str = "group_id",
    target: str = "target",
    score: str = "score",
    tie: str = "cand_idx",
    gains: DataFrame | None = None,
    terminal: str | None = None,
) -> DataFrame:
    """(group, k, size, hit, ndcg) for every width smaller than the list."""
    return _measured_orders(cands, {"": score}, widths, group, target, tie, gains, terminal)


def compare_orders(
    cands: DataFrame,
    score: str,
    reference: str,
    widths=WIDTHS,
    group: str = "group_id",
    target: str = "target",
    tie: str = "cand_idx",
    gains: DataFrame | None = None,
) -> DataFrame:
    """(group, k, size, hit, ndcg, ref_hit, ref_ndcg): two orderings on the same lists."""
    return _measured_orders(
        cands, {"": score, "ref_": reference}, widths, group, target, tie, gains, None
    )


def width_report(metrics: DataFrame, widths=WIDTHS) -> DataFrame:
    """(k, groups, measured, recall_at_k, ndcg_at_k[, reference_*]); unmeasured widths are kept.
    The reference columns appear when the metrics compare two orderings."""
    spark = metrics.sparkSession
    frame = spark.createDataFrame([(int(k),) for k in widths], "k int")
    out = [
        F.count(F.lit(1)).alias("groups"),
        F.avg(F.col("hit").cast("double")).alias("recall_at_k"),
        F.avg("ndcg").alias("ndcg_at_k"),
    ]
    if "ref_hit" in metrics.columns:
        out += [
            F.avg(F.col("ref_hit").cast("double")).alias("reference_recall_at_k"),
            F.avg("ref_ndcg").alias("reference_ndcg_at_k"),
        ]
    report = metrics.groupBy("k").agg(*out)
    return (
        frame.join(report, "k", "left")
        .withColumn("groups", F.coalesce("groups", F.lit(0)))
        .withColumn("measured", F.col("groups") > 0)
    )


def two_sided_binomial(wins: int, trials: int) -> float:
    """Exact P(a split at least this uneven) of a fair coin.

    Terms of the tail shrink from the observed one on, so they are summed as ratios to it until
    they no longer change the total. The observed term is a ratio of integers while those are
    short, so that printed decimals are exact, and else taken from logarithms; both agree to 1e-12."""
    low = min(wins, trials - wins)
    if trials <= 2000:
        edge = math.comb(trials, low) / 2**trials
    else:
        choices = math.lgamma(trials + 1) - math.lgamma(low + 1) - math.lgamma(trials - low + 1)
        edge = math.exp(choices - trials * math.log(2.0))
    total, term, i = 1.0, 1.0, low
    while i > 0:
        term *= i / (trials - i + 1)
        if total + term == total:
            break
        total += term
        i -= 1
    return min(1.0, 2 * edge * total)


@F.pandas_udf(T.DoubleType())
def binomial_p(wins: pd.Series, trials: pd.Series) -> pd.Series:
    """`two_sided_binomial` over a report's rows."""
    return pd.Series([two_sided_binomial(int(w), int(n)) for w, n in zip(wins, trials)])


def discordance(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """wins, losses and the exact paired p-value of `hit` against `ref_hit`."""
    counts = pairs.groupBy(*(by or [])).agg(
        F.count_if(F.col("hit") & ~F.col("ref_hit")).alias("wins"),
        F.count_if(~F.col("hit") & F.col("ref_hit")).alias("losses"),
    )
    return counts.withColumn("p_value", binomial_p("wins", F.col("wins") + F.col("losses")))


def paired_interval(
    pairs: DataFrame, difference: Column, group: str = "group_id", name: str = "delta", **kw
) -> DataFrame:
    """Interval of the mean difference over lists; an empty comparison is zero, not a null."""
    rows = pairs.select(group, difference.cast("double").alias("_d"))
    out = bootstrap.ratio_interval(rows, group, "_d", name, **kw)
    return out.select(
        "metric",
        F.col("mean").alias("delta"),
        F.when(F.col("groups") == 0, F.lit(0.0)).otherwise(F.col("low")).alias("ci_low"),
        F.when(F.col("groups") == 0, F.lit(0.0)).otherwise(F.col("high")).alias("ci_high"),
        "groups",
    )


def log_sum_exp(
    cands: DataFrame, group: str = "group_id", score: str = "score", **weighted
) -> DataFrame:
    """(group, n, lse[, softmax means]) in one pass, without first finding the maximum.

    Scores are binned by floor(score / 32) and exp(score - 32 * bin) is summed per (list, bin):
    every term lies in [1, e^32), so nothing overflows, and the few bins of a list are combined
    relative to its highest one. `weighted` columns return their softmax-weighted means.
    """
    b = F.floor(F.col(score) / EXP_BIN)
    e = F.exp(F.col(score) - b * EXP_BIN)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(e).alias("e")]
    sums += [F.sum(e * c).alias(name) for name, c in weighted.items()]
    binned = cands.groupBy(group, b.alias("_bin")).agg(*sums)
    # One row per list and occupied exponent bin: scores inside +-1e6 fill 62,500 bins at most.
    top = F.max("_bin").over(Window.partitionBy(group))
    scaled = binned.withColumn("_top", top).withColumn(
        "_w", F.exp((F.col("_bin") - F.col("_top")) * float(EXP_BIN))
    )
    total = F.sum(F.col("e") * F.col("_w"))
    return scaled.groupBy(group).agg(
        F.sum("n").alias("n"),
        (F.first("_top") * float(EXP_BIN) + F.ln(total)).alias("lse"),
        *[(F.sum(F.col(name) * F.col("_w")) / total).alias(name) for name in weighted],
    )


def softmax(cands: DataFrame, group: str = "group_id", score: str = "score") -> DataFrame:
    """Each candidate's softmax probability inside its list."""
    lse = log_sum_exp(cands, group, score).select(group, "lse")
    return cands.join(lse, group).withColumn("softmax", F.exp(F.col(score) - F.col("lse"))).drop(
        "lse"
    )


def listwise_loss(
    cands: DataFrame, group: str = "group_id", target: str = "target", score: str = "score"
) -> DataFrame:
    """Per list: size and cross entropy -sum gain * log softmax = lse - sum gain * score."""
    table = gain_table(cands, group, target, s_score=F.col(score))
    pull = table.groupBy(group).agg(
        F.sum(F.col("gain") * F.col("s_score")).alias("_pull"), F.sum("n").alias("size")
    )
    lse = log_sum_exp(cands, group, score).select(group, "lse")
    return pull.join(lse, group).select(group, "size", (F.col("lse") - F.col("_pull")).alias("loss"))


def terminal_loss(
    cands: DataFrame,
    group: str = "group_id",
    target: str = "target",
    score: str = "score",
    terminal: str = "terminal",
) -> DataFrame:
    """Per list: the learned cross entropy of the non-terminal rows and the exact constant of the
    terminal branch (its entropy, and the non-terminal mass times its log). Gains are ranked in the
    complete list and not renormalised."""
    live = ~F.col(terminal)
    table = gain_table(
        cands,
        group,
        target,
        n_live=live.cast("long"),
        s_live=F.when(live, F.col(score)).otherwise(0.0),
    )
    g = F.col("gain")
    n_dead = F.col("n") - F.col("n_live")
    parts = table.groupBy(group).agg(
        F.sum("n").alias("size"),
        F.sum("n_live").alias("live"),
        F.sum(g * F.col("n_live")).alias("mass"),
        F.sum(g * F.col("s_live")).alias("_pull"),
        F.sum(-n_dead * g * F.ln(g)).alias("entropy"),
    )
    mass_term = F.when(F.col("mass") > 0, F.col("mass") * F.ln("mass")).otherwise(0.0)
    lse = log_sum_exp(cands.where(live), group, score).select(group, "lse")
    learned = F.when(
        F.col("live") > 0, F.col("mass") * F.col("lse") - F.col("_pull")
    ).otherwise(0.0)
    return parts.join(lse, group, "left").select(
        group,
        "size",
        "live",
        learned.alias("learned"),
        (F.col("entropy") - mass_term).alias("constant"),
        (learned + F.col("entropy") - mass_term).alias("loss"),
    )


def tie_order(cands: DataFrame, group: str, path: str) -> DataFrame:
    """0-based rank of the path string inside its list; paths must be unique in a list."""
    ranked = ordering.row_numbers(cands, [group], [path], "_rn")
    return ranked.withColumn("tie_order", F.col("_rn") - 1).drop("_rn")


def random_score(seed: int, *keys) -> Column:
    """A baseline ordering: uniform in [0, 1), a function of the seed and the row key."""
    return hashing.seeded_uniform(seed, *keys)


def column_score(features: str, index: int) -> Column:
    """A baseline ordering by one feature column."""
    return F.get(F.col(features), index).cast("double")


def corpus_summary(
    cands: DataFrame, group: str = "group_id", target: str = "target", shortlist_width: int = 48
) -> DataFrame:
    """One row: lists, candidates, size quantiles, lists above the shortlist, tied lists."""
    stats = materialise(list_stats(cands, group, target), "list-stats")
    sizes = ordering.nearest_rank(stats, [], "size", {"median": 0.5, "p95": 0.95})
    kinds = ordering.nearest_rank(stats, [], "distinct_targets", {"median": 0.5})
    out = stats.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("size").alias("candidates"),
        F.count_if(F.col("size") > shortlist_width).alias("groups_above_shortlist"),
        F.count_if(F.col("distinct_targets") == 1).alias("groups_entirely_tied"),
    )
    names = ("min", "median", "p95", "max")
    return (
        out.withColumn("_sizes", ordering.one_row(sizes))
        .withColumn("_kinds", ordering.one_row(kinds))
        .select(
            *out.columns,
            *[F.col("_sizes")[name].alias(f"size_{name}") for name in names],
            F.col("_kinds")["median"].alias("median_distinct_targets"),
        )
    )


def list_offsets(cands: DataFrame, group: str = "group_id") -> DataFrame:
    """(group, size, stop): running total of list sizes in group order."""
    sizes = cands.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    return ordering.running_total(sizes, [], [group], "size", "stop")


def standardisation(
    rows: DataFrame, features: str, width: int, where: Column | None = None
) -> DataFrame:
    """(feature, mean, scale): population statistics of an array column over the selected rows;
    a constant or non-finite scale becomes one."""
    chosen = rows if where is None else rows.where(where)
    x = [F.get(F.col(features), i).cast("double") for i in range(width)]
    sums = [F.avg(c).alias(f"m{i}") for i, c in enumerate(x)]
    sums += [F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(x)]
    one = chosen.agg(*sums)

    def scale(i: int) -> Column:
        s = F.col(f"s{i}")
        return F.when(sx.finite(s) & (s > 0), s).otherwise(1.0)

    rows_out = [
        F.struct(
            F.lit(i).alias("feature"), F.col(f"m{i}").alias("mean"), scale(i).alias("scale")
        )
        for i in range(width)
    ]
    return one.select(F.inline(F.array(*rows_out)))

"""Candidate lists: F1, F5-F9, F11, E7, E8, E17, E18, E23, E28-E31, E34, U3."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import scoring as sx
from evalspark.functions.scoring import r6
from evalspark.operators import gates, ranking, scoring
from evalspark.plans.metrics import nearest_sql, rounded, weights_sql
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R

C = "WITH " + bridge.CANDIDATES_SQL
WIDTHS = ranking.WIDTHS

GAINS = C + """, ranked AS (SELECT *, rank() OVER (PARTITION BY group_id ORDER BY target DESC)
    + (count(*) OVER (PARTITION BY group_id, target) - 1) / 2.0::DOUBLE AS avg_rank FROM candidates),
  gained AS (SELECT *, (1 / (avg_rank * avg_rank)) / sum(1 / (avg_rank * avg_rank))
    OVER (PARTITION BY group_id) AS gain FROM ranked)"""


@query(
    "f1_target_gains",
    GAINS + f" SELECT group_id, cand_idx, {R('avg_rank')} AS avg_rank, {R('gain')} AS gain FROM gained",
)
def target_gains(spark, sf):
    out = ranking.target_gains(bridge.candidates(spark, sf))
    return out.select("group_id", "cand_idx", r6(F.col("avg_rank")).alias("avg_rank"),
                      r6(F.col("gain")).alias("gain"))


@query(
    "f5_shortlist",
    C + """, placed AS (SELECT group_id, cand_idx, target, row_number() OVER (PARTITION BY group_id
        ORDER BY score DESC, cand_idx)::INTEGER AS position, max(target) OVER (PARTITION BY group_id)
        AS best FROM candidates)
    SELECT group_id, cand_idx, position, target = best AS is_best FROM placed WHERE position <= 8""",
)
def shortlist(spark, sf):
    cands = bridge.candidates(spark, sf)
    best = ranking.list_stats(cands).select("group_id", "best")
    top = ranking.shortlist(cands, 8).join(best, "group_id")
    return top.select(
        "group_id", "cand_idx", "position", (F.col("target") == F.col("best")).alias("is_best")
    )


def metrics_sql(score: str, widths=WIDTHS) -> str:
    """CTE body (group_id, k, size, hit, ndcg)."""
    return f"""SELECT group_id, k, any_value(size) AS size, bool_or(sr <= k AND target = best) AS hit,
      sum(CASE WHEN sr <= k THEN gain / log2(sr + 1) ELSE 0 END)
        / sum(CASE WHEN gr <= k THEN gain / log2(gr + 1) ELSE 0 END) AS ndcg
    FROM (SELECT group_id, target, gain, count(*) OVER w AS size, max(target) OVER w AS best,
        row_number() OVER (PARTITION BY group_id ORDER BY {score} DESC, cand_idx) AS sr,
        row_number() OVER (PARTITION BY group_id ORDER BY gain DESC) AS gr
      FROM gained WINDOW w AS (PARTITION BY group_id)), (SELECT unnest({list(widths)}) AS k)
    WHERE size > k GROUP BY group_id, k"""


MEASURED = GAINS + f""", mine AS ({metrics_sql("score")}), theirs AS ({metrics_sql("ref_score")})"""


@query(
    "f6_ndcg",
    MEASURED + f""" SELECT group_id, k::INTEGER AS k, size::BIGINT AS size, hit, {R("ndcg")} AS ndcg
    FROM mine""",
)
def ndcg(spark, sf):
    return rounded(ranking.width_metrics(bridge.candidates(spark, sf)), ("ndcg",))


@query(
    "f7_tie_order",
    """WITH paths AS (SELECT conv_id, turn, role || ' ' || md5(text) || ' ' || turn::VARCHAR AS path
      FROM conversations)
    SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY path)::BIGINT - 1
      AS tie_order FROM paths""",
)
def tie_order(spark, sf):
    paths = bridge.read(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.concat_ws(" ", "role", F.md5("text"), F.col("turn").cast("string")).alias("path"),
    )
    return ranking.tie_order(paths, "conv_id", "path").select("conv_id", "turn", "tie_order")


@query(
    "f8_softmax",
    C + f""", m AS (SELECT *, max(score) OVER (PARTITION BY group_id) AS top FROM candidates)
    SELECT group_id, cand_idx, {R("exp(score - top) / sum(exp(score - top)) OVER (PARTITION BY group_id)")}
      AS softmax FROM m""",
)
def softmax(spark, sf):
    out = ranking.softmax(bridge.candidates(spark, sf))
    return out.select("group_id", "cand_idx", r6(F.col("softmax")).alias("softmax"))


@query(
    "f9_terminal_first",
    C + """ SELECT group_id, cand_idx, position FROM (SELECT group_id, cand_idx,
      row_number() OVER (PARTITION BY group_id ORDER BY terminal DESC,
        CASE WHEN terminal THEN 0 ELSE -score END, cand_idx)::INTEGER AS position
      FROM candidates) WHERE position <= 24""",
)
def terminal_first(spark, sf):
    top = ranking.shortlist(bridge.candidates(spark, sf), 24, terminal="terminal")
    return top.select("group_id", "cand_idx", "position")


@query(
    "f11_list_context",
    C + """, per AS (SELECT group_id, count(*)::BIGINT AS size, max(target) AS best,
      count(DISTINCT target)::BIGINT AS distinct_targets FROM candidates GROUP BY 1)
    SELECT cand_idx, size, best, distinct_targets FROM candidates JOIN per USING (group_id)""",
)
def list_context(spark, sf):
    out = ranking.with_list_context(bridge.candidates(spark, sf))
    return out.select("cand_idx", "size", "best", "distinct_targets")


def both_orders(spark, sf):
    return ranking.compare_orders(bridge.candidates(spark, sf), "score", "ref_score")


PAIRED = MEASURED + """, pairs AS (SELECT m.*, t.hit AS ref_hit, t.ndcg AS ref_ndcg FROM mine m
  JOIN theirs t USING (group_id, k))"""


def interval_sql(difference: str, k: int) -> str:
    return f""", chosen AS (SELECT group_id, {difference} AS d FROM pairs WHERE k = {k})
    {weights_sql("chosen", "group_id")}, drawn AS (SELECT sum(w * d) / sum(w) AS v FROM weights
      JOIN chosen USING (group_id) GROUP BY r HAVING sum(w) > 0)
    SELECT 'delta' AS metric, {R("(SELECT avg(d) FROM chosen)")} AS delta,
      {R("quantile_cont(v, 0.025)")} AS ci_low, {R("quantile_cont(v, 0.975)")} AS ci_high,
      (SELECT count(*) FROM chosen)::BIGINT AS groups FROM drawn"""


@query(
    "e7_recall_interval",
    PAIRED + interval_sql("hit::INTEGER::DOUBLE - ref_hit::INTEGER::DOUBLE", 8),
)
def recall_interval(spark, sf):
    pairs = both_orders(spark, sf).where("k = 8")
    difference = F.col("hit").cast("double") - F.col("ref_hit").cast("double")
    return rounded(
        ranking.paired_interval(pairs, difference), ("delta", "ci_low", "ci_high")
    )


@query("e7_ndcg_interval", PAIRED + interval_sql("ndcg - ref_ndcg", 24))
def ndcg_interval(spark, sf):
    pairs = both_orders(spark, sf).where("k = 24")
    out = ranking.paired_interval(pairs, F.col("ndcg") - F.col("ref_ndcg"))
    return rounded(out, ("delta", "ci_low", "ci_high"))


@query(
    "e8_discordance",
    PAIRED + f""", c AS (SELECT k, count(*) FILTER (WHERE hit AND NOT ref_hit)::BIGINT AS wins,
      count(*) FILTER (WHERE NOT hit AND ref_hit)::BIGINT AS losses FROM pairs GROUP BY k),
    t AS (SELECT *, wins + losses AS n, least(wins, losses) AS lo FROM c)
    SELECT k::INTEGER AS k, wins, losses, {R('''CASE WHEN n = 0 THEN 1 ELSE least(1, 2 * list_sum(
      list_transform(range(0, lo + 1), lambda i : exp(lgamma(n + 1) - lgamma(i + 1)
        - lgamma(n - i + 1) - n * ln(2))))) END''')} AS p_value FROM t""",
)
def discordance(spark, sf):
    out = ranking.discordance(both_orders(spark, sf), ["k"])
    return rounded(out, ("p_value",))


@query(
    "e17_corpus_summary",
    C + f""", per AS (SELECT group_id, count(*)::BIGINT AS size,
      count(DISTINCT target)::BIGINT AS kinds FROM candidates GROUP BY 1)
    SELECT count(*)::BIGINT AS groups, sum(size)::BIGINT AS candidates,
      count(*) FILTER (WHERE size > 48)::BIGINT AS groups_above_shortlist,
      count(*) FILTER (WHERE kinds = 1)::BIGINT AS groups_entirely_tied, min(size) AS size_min,
      {nearest_sql('size', '0.5')} AS size_median, {nearest_sql('size', '0.95')} AS size_p95,
      max(size) AS size_max, {nearest_sql('kinds', '0.5')} AS median_distinct_targets FROM per""",
)
def corpus_summary(spark, sf):
    return ranking.corpus_summary(bridge.candidates(spark, sf))


SHORT = "WITH " + bridge.candidates_sql("l_orderkey")


@query(
    "e17_short_lists_summary",
    SHORT + f""", per AS (SELECT group_id, count(*)::BIGINT AS size,
      count(DISTINCT target)::BIGINT AS kinds FROM candidates GROUP BY 1)
    SELECT count(*)::BIGINT AS groups, sum(size)::BIGINT AS candidates,
      count(*) FILTER (WHERE size > 4)::BIGINT AS groups_above_shortlist,
      count(*) FILTER (WHERE kinds = 1)::BIGINT AS groups_entirely_tied, min(size) AS size_min,
      {nearest_sql('size', '0.5')} AS size_median, {nearest_sql('size', '0.95')} AS size_p95,
      max(size) AS size_max, {nearest_sql('kinds', '0.5')} AS median_distinct_targets FROM per""",
)
def short_lists_summary(spark, sf):
    return ranking.corpus_summary(bridge.candidates(spark, sf, "l_orderkey"), shortlist_width=4)


WIDTH_SQL = ", ".join(
    f"{R(f'avg(features[{i + 1}])')} AS m{i}, {R(f'stddev_pop(features[{i + 1}])')} AS s{i}"
    for i in range(9)
)


@query(
    "e18_nonterminal_standardisation",
    C + ", t AS (SELECT features FROM candidates WHERE split = 'train' AND NOT terminal) "
    + " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS feature, {R(f'avg(features[{i + 1}])')} AS mean, "
        f"{R(f'CASE WHEN stddev_pop(features[{i + 1}]) > 0 THEN stddev_pop(features[{i + 1}]) ELSE 1 END')}"
        f" AS scale FROM t"
        for i in range(9)
    ),
)
def nonterminal_standardisation(spark, sf):
    out = ranking.standardisation(
        bridge.candidates(spark, sf),
        "features",
        9,
        (F.col("split") == "train") & ~F.col("terminal"),
    )
    return rounded(out, ("mean", "scale"))


@query(
    "e18_embedding_standardisation",
    " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS feature, {R(f'avg(embedding[{i + 1}]::DOUBLE)')} AS mean, "
        f"{R(f'stddev_pop(embedding[{i + 1}]::DOUBLE)')} AS scale FROM embeddings"
        for i in range(64)
    ),
)
def embedding_standardisation(spark, sf):
    out = ranking.standardisation(bridge.read(spark, sf, "embeddings"), "embedding", 64)
    return rounded(out, ("mean", "scale"))


@query(
    "e23_seed_range",
    "WITH " + bridge.REPLICATES_SQL + f""", hits AS (SELECT seed,
      avg(((p_seed > 0.5) = (y = 1))::INTEGER::DOUBLE) AS recall,
      avg(((ref_seed > 0.5) = (y = 1))::INTEGER::DOUBLE) AS floor_recall
      FROM replicates WHERE split = 'validation' AND y IN (0, 1) GROUP BY seed)
    SELECT count(*)::BIGINT AS runs, {R("min(recall)")} AS min_recall, {R("max(recall)")} AS max_recall,
      {R("min(floor_recall)")} AS min_floor_recall, {R("max(floor_recall)")} AS max_floor_recall,
      count(*) FILTER (WHERE recall > floor_recall)::BIGINT AS admissible_seeds,
      count(*) FILTER (WHERE NOT recall > floor_recall)::BIGINT AS inadmissible_seeds,
      list_sort(list(seed)) = {sorted(bridge.SEEDS)} AS complete FROM hits""",
)
def seed_range(spark, sf):
    rows = bridge.replicates(
        scoring.decisive(scoring.partition(bridge.scored(spark, sf), "validation"), "y")
    )
    right = lambda p: ((F.col(p) > 0.5) == (F.col("y") == 1)).cast("double")
    runs = rows.groupBy("seed").agg(
        F.avg(right("p_seed")).alias("recall"), F.avg(right("ref_seed")).alias("floor_recall")
    )
    return rounded(
        gates.seed_range(runs, bridge.SEEDS),
        ("min_recall", "max_recall", "min_floor_recall", "max_floor_recall"),
    )


@query(
    "e28_recall",
    GAINS + f""", mine AS ({metrics_sql("score", (1, 48))})
    SELECT k::INTEGER AS k, count(*)::BIGINT AS groups, {R("avg(hit::INTEGER)")} AS recall
    FROM mine GROUP BY k""",
)
def recall(spark, sf):
    out = ranking.width_metrics(bridge.candidates(spark, sf), (1, 48))
    return out.groupBy("k").agg(
        F.count(F.lit(1)).alias("groups"), r6(F.avg(F.col("hit").cast("double"))).alias("recall")
    )


REPORT = ("recall_at_k", "ndcg_at_k", "reference_recall_at_k", "reference_ndcg_at_k")


@query(
    "e29_width_report",
    PAIRED + f""" SELECT w::INTEGER AS k, count(k)::BIGINT AS groups,
      {R("avg(hit::INTEGER)")} AS recall_at_k, {R("avg(ndcg)")} AS ndcg_at_k,
      {R("avg(ref_hit::INTEGER)")} AS reference_recall_at_k, {R("avg(ref_ndcg)")}
        AS reference_ndcg_at_k, count(k) > 0 AS measured
    FROM (SELECT unnest({list(WIDTHS)}) AS w) LEFT JOIN pairs ON k = w GROUP BY w""",
)
def width_report(spark, sf):
    return rounded(ranking.width_report(both_orders(spark, sf)), REPORT)


@query(
    "e29_width_report_short_lists",
    GAINS.replace(bridge.CANDIDATES_SQL, bridge.candidates_sql("l_orderkey"))
    + f""", mine AS ({metrics_sql("score")})
    SELECT w::INTEGER AS k, count(k)::BIGINT AS groups, {R("avg(hit::INTEGER)")} AS recall_at_k,
      {R("avg(ndcg)")} AS ndcg_at_k, count(k) > 0 AS measured
    FROM (SELECT unnest({list(WIDTHS)}) AS w) LEFT JOIN mine ON k = w GROUP BY w""",
)
def width_report_short(spark, sf):
    mine = ranking.width_metrics(bridge.candidates(spark, sf, "l_orderkey"))
    return rounded(ranking.width_report(mine), REPORT[:2])


@query(
    "e30_listwise_loss",
    GAINS + f""", m AS (SELECT *, max(score) OVER (PARTITION BY group_id) AS top FROM gained),
    d AS (SELECT *, ln(sum(exp(score - top)) OVER (PARTITION BY group_id)) AS den FROM m)
    SELECT group_id, count(*)::BIGINT AS size, {R("-sum(gain * (score - top - den))")} AS loss
    FROM d GROUP BY group_id""",
)
def listwise_loss(spark, sf):
    return rounded(ranking.listwise_loss(bridge.candidates(spark, sf)), ("loss",))


@query(
    "e31_terminal_loss",
    GAINS + f""", live AS (SELECT *, max(score) FILTER (WHERE NOT terminal) OVER w AS top
      FROM gained WINDOW w AS (PARTITION BY group_id)),
    d AS (SELECT *, ln(sum(exp(score - top)) FILTER (WHERE NOT terminal)
      OVER (PARTITION BY group_id)) AS den FROM live), s AS (
    SELECT group_id, count(*)::BIGINT AS size, count(*) FILTER (WHERE NOT terminal)::BIGINT AS live,
      coalesce(-sum(gain * (score - top - den)) FILTER (WHERE NOT terminal), 0) AS learned,
      coalesce(-sum(gain * ln(gain)) FILTER (WHERE terminal), 0) AS entropy,
      coalesce(sum(gain) FILTER (WHERE NOT terminal), 0) AS mass FROM d GROUP BY group_id),
    t AS (SELECT *, entropy - CASE WHEN mass > 0 THEN mass * ln(mass) ELSE 0 END AS constant FROM s)
    SELECT group_id, size, live, {R("learned")} AS learned, {R("constant")} AS constant,
      {R("learned + constant")} AS loss FROM t""",
)
def terminal_loss(spark, sf):
    out = ranking.terminal_loss(bridge.candidates(spark, sf))
    return rounded(out, ("learned", "constant", "loss"))


@query(
    "e34_baseline_orderings",
    C + f""", scored_both AS (SELECT group_id, cand_idx, features[5] AS by_column,
      ('0x' || substr(sha256('11|' || group_id || '|' || cand_idx::VARCHAR), 1, 13))::BIGINT
        / 4503599627370496::DOUBLE AS by_chance FROM candidates)
    SELECT cand_idx, {R("by_column")} AS by_column, {R("by_chance")} AS by_chance
    FROM scored_both""",
)
def baseline_orderings(spark, sf):
    return bridge.candidates(spark, sf).select(
        "cand_idx",
        r6(ranking.column_score("features", 4)).alias("by_column"),
        r6(ranking.random_score(11, "group_id", "cand_idx")).alias("by_chance"),
    )


WEIGHTS = (0.5, -1.0, 2.0, 0.25, 0.125, -0.5, 1.5, -0.75, 3.0)
DOT_SQL = " + ".join(f"features[{i + 1}] * {w}" for i, w in enumerate(WEIGHTS))


@query("u3_linear_scorer", C + f" SELECT cand_idx, {R(DOT_SQL)} AS score FROM candidates")
def linear_scorer(spark, sf):
    return bridge.candidates(spark, sf).select(
        "cand_idx", r6(sx.dot(F.col("features"), WEIGHTS)).alias("score")
    )

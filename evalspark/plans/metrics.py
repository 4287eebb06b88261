"""Probability scores, intervals, gates, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import fen as fx
from evalspark.functions.scoring import r6
from evalspark.operators import bootstrap, calibrate, gates, keys, multinomial, scoring, summaries
from evalspark.plans.expressions import KEY, SLICE_CASES
from evalspark.plans.identity import KEYED, keyed
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R
from evalspark.sources import schemas

S = "WITH " + bridge.SCORED_SQL
METRICS = ("prevalence", "log_loss", "brier", "ece")


def clip_sql(p: str) -> str:
    return f"least(greatest({p}, 1e-15::DOUBLE), 1 - 1e-15::DOUBLE)"


def ll_sql(y: str, p: str) -> str:
    return f"(-{y} * ln({clip_sql(p)}) - (1 - {y}) * ln(1 - {clip_sql(p)}))"


def scores_sql(source: str, by: str = "", y: str = "y", p: str = "p", rounded: bool = True) -> str:
    """count, prevalence, log loss, Brier and ECE of a source, per `by`."""
    head = f"{by}, " if by else ""
    using = f"USING ({by})" if by else "ON true"
    f = R if rounded else (lambda e: e)
    return f"""SELECT {head}m.count, {f("m.prevalence")} AS prevalence, {f("m.log_loss")} AS log_loss,
      {f("m.brier")} AS brier, {f("e.gap / m.count")} AS ece FROM (
      SELECT {head}count(*)::BIGINT AS count, avg({y}) AS prevalence, avg({ll_sql(y, p)}) AS log_loss,
        avg(({p} - {y}) * ({p} - {y})) AS brier FROM {source} {f"GROUP BY {by}" if by else ""}) m
      JOIN (SELECT {head}sum(abs(sp - sy)) AS gap FROM (
        SELECT {head}least(floor({p} * 10), 9) AS bin, sum({p}) AS sp, sum({y}) AS sy FROM {source}
        GROUP BY {head}bin) {f"GROUP BY {by}" if by else ""}) e {using}"""


def rounded(df, metrics=METRICS):
    for m in metrics:
        df = df.withColumn(m, r6(F.col(m)))
    return df


def evaluated(spark, sf):
    return scoring.decisive(scoring.partition(bridge.scored(spark, sf), "validation"), "y")


EVALUATED = S + ", evaluated AS (SELECT * FROM scored WHERE split = 'validation' AND y IN (0, 1)) "


@query("e1_scores", EVALUATED + scores_sql("evaluated"))
def scores(spark, sf):
    return rounded(scoring.scores(evaluated(spark, sf)))


@query(
    "e1_scores_by_split",
    S + ", decided AS (SELECT * FROM scored WHERE y IN (0, 1)) " + scores_sql("decided", "split"),
)
def scores_by_split(spark, sf):
    rows = scoring.decisive(bridge.scored(spark, sf), "y")
    return rounded(scoring.scores(rows, ["split"]))


@query(
    "e2_calibration_table",
    EVALUATED + f""", filled AS (SELECT least(floor(p * 10), 9)::INTEGER AS bin, count(*) AS n,
      avg(p) AS ap, avg(y) AS ay FROM evaluated GROUP BY 1)
    SELECT b::INTEGER AS bin, {R("b / 10.0")} AS lower, {R("(b + 1) / 10.0")} AS upper,
      coalesce(n, 0)::BIGINT AS count, {R("ap")} AS prediction, {R("ay")} AS observed
    FROM (SELECT unnest(range(10)) AS b) LEFT JOIN filled ON bin = b""",
)
def calibration_table(spark, sf):
    out = scoring.calibration_table(evaluated(spark, sf))
    return rounded(out, ("lower", "upper", "prediction", "observed"))


EDGES = " + ".join(f"(q >= {i * 0.1!r}::DOUBLE)::INTEGER" for i in range(1, 10))


@query(
    "e2_edge_calibration",
    S + f""" SELECT {EDGES} AS bin, count(*)::BIGINT AS count, {R("avg(q)")} AS mean_predicted,
      {R("avg(y)")} AS mean_outcome FROM (SELECT y, least(greatest(p, 1e-7::DOUBLE),
      1 - 1e-7::DOUBLE) AS q FROM scored) GROUP BY 1""",
)
def edge_calibration(spark, sf):
    out = scoring.edge_calibration(bridge.scored(spark, sf))
    return rounded(out, ("mean_predicted", "mean_outcome"))


@query(
    "e9_holdout_floor",
    S + f""", q AS (SELECT y, least(greatest(p, 1e-7::DOUBLE), 1 - 1e-7::DOUBLE) AS q FROM scored),
    m AS (SELECT avg(y) AS r FROM q)
    SELECT count(*)::BIGINT AS count, {R("avg(-(y * ln(q) + (1 - y) * ln(1 - q)))")} AS log_loss,
      {R("avg((q - y) * (q - y))")} AS brier,
      {R("-(any_value(r) * ln(any_value(r)) + (1 - any_value(r)) * ln(1 - any_value(r)))")}
        AS no_information_log_loss FROM q, m""",
)
def holdout_floor(spark, sf):
    out = scoring.holdout_scores(bridge.scored(spark, sf))
    return rounded(out, ("log_loss", "brier", "no_information_log_loss"))


GROUP_STATS = ", ".join(
    f"sum(CASE WHEN least(floor(p * 10), 9) = {i} THEN p ELSE 0 END) AS bp{i}, "
    f"sum(CASE WHEN least(floor(p * 10), 9) = {i} THEN y ELSE 0 END) AS by{i}"
    for i in range(10)
)
STATS = EVALUATED + f""", stats AS (SELECT game_id, count(*)::BIGINT AS n, sum(y) AS s_y,
  sum({ll_sql('y', 'p')}) AS s_ll, sum((p - y) * (p - y)) AS s_br, {GROUP_STATS},
  sum({ll_sql('y', 'p')} - {ll_sql('y', 'ref')}) AS d_ll,
  sum((p - y) * (p - y) - (ref - y) * (ref - y)) AS d_br FROM evaluated GROUP BY game_id)"""
STAT_COLUMNS = ["s_y", "s_ll", "s_br", "d_ll", "d_br"] + [
    f"b{k}{i}" for i in range(10) for k in ("p", "y")
]


@query(
    "e3_group_statistics",
    STATS + " SELECT game_id, n, " + ", ".join(f"{R(c)} AS {c}" for c in STAT_COLUMNS)
    + " FROM stats",
)
def group_statistics(spark, sf):
    out = bootstrap.group_statistics(evaluated(spark, sf), "game_id", ref="ref")
    return rounded(out, STAT_COLUMNS)


def weights_sql(groups: str, key: str, seed: int = 13, repeats: int = 1000) -> str:
    """CTEs `weights` (replicate, key, w): the Poisson weights spelled in SQL."""
    prime = bootstrap.PRIME
    coefs = ", ".join(
        f"('0x' || substr(md5('{seed}|' || r::VARCHAR || '|{j}'), 1, 8))::BIGINT % {prime} AS c{j}"
        for j in range(4)
    )
    steps = " + ".join(f"(u >= {cut})::INTEGER" for cut in bootstrap.POISSON_CUTS)
    return f""", points AS (SELECT {key}, ('0x' || substr(md5('{seed}|' || {key}::VARCHAR), 1, 8))
      ::BIGINT % {prime} AS h FROM {groups}),
    coefs AS (SELECT r, {coefs} FROM (SELECT unnest(range({repeats})) AS r)),
    weights AS (SELECT r, {key}, {steps} AS w FROM (
      SELECT r, {key}, (((c3 * h + c2) % {prime} * h + c1) % {prime} * h + c0) % {prime} AS u
      FROM points, coefs))"""


def bounds_sql(metric: str, source: str = "drawn", extra: str = "") -> str:
    return (
        f"SELECT '{metric}' AS metric, {R(f'quantile_cont({metric}, 0.025)')} AS low, "
        f"{R(f'quantile_cont({metric}, 0.975)')} AS high{extra} FROM {source}"
    )


DRAWN = STATS + weights_sql("stats", "game_id") + """, sums AS (
  SELECT r, sum(w * n) AS n, sum(w * s_y) AS s_y, sum(w * s_ll) AS s_ll, sum(w * s_br) AS s_br,
    sum(w * d_ll) AS d_ll, sum(w * d_br) AS d_br, """ + ", ".join(
    f"sum(w * bp{i}) - sum(w * by{i}) AS gap{i}" for i in range(10)
) + """ FROM weights JOIN stats USING (game_id) GROUP BY r HAVING sum(w * n) > 0),
drawn AS (SELECT s_y / n AS prevalence, s_ll / n AS log_loss, s_br / n AS brier,
  (""" + " + ".join(f"abs(gap{i})" for i in range(10)) + """) / n AS ece,
  d_ll / n AS log_loss_delta, d_br / n AS brier_delta FROM sums) """
GROUPS = ", (SELECT count(*) FROM stats)::BIGINT AS groups"


@query(
    "e4_group_bootstrap",
    DRAWN + " UNION ALL ".join(bounds_sql(m, extra=GROUPS) for m in METRICS),
)
def group_bootstrap(spark, sf):
    out = bootstrap.score_intervals(evaluated(spark, sf), "game_id").drop("point")
    return rounded(out, ("low", "high"))


@query(
    "e4_fixed_count_draws",
    EVALUATED + """, g AS (SELECT count(DISTINCT game_id)::BIGINT AS groups, count(*)::BIGINT AS rows
      FROM evaluated)
    SELECT 1001::BIGINT AS replicates, groups AS least, groups AS most, rows, true AS near,
      true AS same FROM g""",
)
def fixed_count_draws(spark, sf):
    """Draws of every replicate of the fixed-count bootstrap: as many as groups. The mean of the
    drawn rows lies within 5 standard errors of all rows, and another partitioning draws the same."""
    stats = evaluated(spark, sf).groupBy("game_id").agg(F.count(F.lit(1)).alias("n"))
    a = multinomial.fixed_sums(stats, "game_id", ["n"], bootstrap.REPEATS, bootstrap.SEED)
    b = multinomial.fixed_sums(stats.repartition(7, "n"), "game_id", ["n"], bootstrap.REPEATS, bootstrap.SEED)
    drawn = F.col("replicate") >= 0
    out = a.agg(
        F.count(F.lit(1)).alias("replicates"),
        F.min("groups").cast("long").alias("least"),
        F.max("groups").cast("long").alias("most"),
        F.max(F.when(~drawn, F.col("n"))).cast("long").alias("rows"),
        F.avg(F.when(drawn, F.col("n"))).alias("mean"),
        F.stddev(F.when(drawn, F.col("n"))).alias("spread"),
        F.sum(F.col("n") * (F.col("replicate") + 2)).alias("mark"),
    )
    near = F.abs(F.col("mean") - F.col("rows")) <= 5 * F.col("spread") / bootstrap.REPEATS**0.5
    mark = b.agg(F.sum(F.col("n") * (F.col("replicate") + 2)).alias("mark")).scalar()
    return out.select("replicates", "least", "most", "rows", near.alias("near"), (F.col("mark") == mark).alias("same"))


@query(
    "e5_paired_deltas",
    DRAWN
    + " UNION ALL ".join(bounds_sql(m, extra=GROUPS) for m in ("log_loss_delta", "brier_delta")),
)
def paired_deltas(spark, sf):
    out = bootstrap.score_intervals(evaluated(spark, sf), "game_id", ref="ref")
    return rounded(out.where("metric like '%delta'").drop("point"), ("low", "high"))


REPEATED = "WITH " + bridge.REPLICATES_SQL + """, measured AS (
  SELECT * FROM replicates WHERE split = 'validation' AND y IN (0, 1))"""


def measured(spark, sf):
    return bridge.replicates(evaluated(spark, sf))


@query(
    "e6_mean_seed_delta",
    REPEATED + f""", per_row AS (SELECT game_id, row_id,
      avg({ll_sql('y', 'p_seed')} - {ll_sql('y', 'ref_seed')}) AS d FROM measured GROUP BY ALL),
    stats AS (SELECT game_id, count(*) AS n, sum(d) AS s FROM per_row GROUP BY 1)
    {weights_sql("stats", "game_id")}, drawn AS (SELECT sum(w * s) / sum(w * n) AS log_loss_delta
      FROM weights JOIN stats USING (game_id) GROUP BY r HAVING sum(w * n) > 0)
    SELECT 'log_loss_delta' AS metric, {R("(SELECT sum(s) / sum(n) FROM stats)")} AS mean,
      {R("quantile_cont(log_loss_delta, 0.025)")} AS low,
      {R("quantile_cont(log_loss_delta, 0.975)")} AS high,
      (SELECT count(*) FROM stats)::BIGINT AS groups FROM drawn""",
)
def mean_seed_delta(spark, sf):
    rows = bootstrap.seed_mean_delta(
        measured(spark, sf), ["row_id"], "game_id", "y", "p_seed", "ref_seed"
    )
    out = bootstrap.ratio_interval(rows, "game_id", "log_loss_delta", "log_loss_delta")
    return rounded(out, ("mean", "low", "high"))


@query(
    "e6_seed_intervals",
    REPEATED + f""", stats AS (SELECT seed, game_id, count(*) AS n,
      sum({ll_sql('y', 'p_seed')} - {ll_sql('y', 'ref_seed')}) AS s FROM measured GROUP BY ALL),
    names AS (SELECT DISTINCT game_id FROM stats) {weights_sql("names", "game_id")},
    drawn AS (SELECT seed, sum(w * s) / sum(w * n) AS d FROM weights JOIN stats USING (game_id)
      GROUP BY seed, r HAVING sum(w * n) > 0)
    SELECT seed::INTEGER AS seed, {R("quantile_cont(d, 0.025)")} AS low,
      {R("quantile_cont(d, 0.975)")} AS high FROM drawn GROUP BY seed""",
)
def seed_intervals(spark, sf):
    out = bootstrap.seed_intervals(
        measured(spark, sf), "seed", bridge.SEEDS, "game_id", "y", "p_seed", "ref_seed"
    )
    return rounded(out, ("low", "high"))


NO_INFO = S + """, rate AS (SELECT avg(y) AS r FROM scored WHERE split = 'train' AND y IN (0, 1)),
  constant AS (SELECT scored.*, r FROM scored, rate WHERE split = 'validation' AND y IN (0, 1)) """


@query("e9_no_information", NO_INFO + scores_sql("constant", "r", "y", "r").replace(
    "SELECT r, m.count", f"SELECT {R('r')} AS prediction, m.count", 1
))
def no_information(spark, sf):
    rows = scoring.decisive(bridge.scored(spark, sf), "y")
    out = scoring.no_information(
        rows.where("split = 'validation'"), rows.where("split = 'train'")
    )
    return rounded(out, (*METRICS, "prediction"))


@query(
    "e9_unseen_scores",
    KEYED + """, seen AS (SELECT DISTINCT key FROM keyed WHERE split = 'train' AND y IN (0, 1)),
    flagged AS (SELECT *, key NOT IN (SELECT key FROM seen) AS unseen FROM keyed
      WHERE split = 'validation' AND y IN (0, 1)) """ + scores_sql("flagged", "unseen"),
)
def unseen_scores(spark, sf):
    rows = scoring.decisive(keyed(spark, sf), "y")
    flagged = keys.mark_unseen(
        rows.where("split = 'validation'"), rows.where("split = 'train'"), "key"
    )
    return rounded(scoring.scores(flagged, ["unseen"]))


def featured_rows(spark, sf):
    """Evaluated rows with their feature columns."""
    rows = evaluated(spark, sf)
    return bridge.feature_columns(rows)


SLICED = EVALUATED + f""", featured AS (SELECT *, {bridge.features_sql()} FROM evaluated),
  sliced AS (SELECT unnest({SLICE_CASES}) AS slice, y, p, ref, game_id, row_id, z, z_ref
    FROM featured) """


@query(
    "e10_slice_report",
    SLICED + f"""SELECT d.slice, count, prevalence, log_loss, brier, ece,
      CASE WHEN count IS NULL THEN 'unsupported' ELSE 'measured' END AS status
    FROM (SELECT unnest({list(scoring.SLICES)}) AS slice) d LEFT JOIN (
      {scores_sql("sliced", "slice")}) USING (slice)""",
)
def slice_report(spark, sf):
    return rounded(scoring.slice_report(featured_rows(spark, sf), scoring.slice_names()))


GATE_ROW = DRAWN.rstrip() + """, c AS (""" + scores_sql("evaluated", rounded=False) + """),
  b AS (""" + scores_sql("evaluated", p="ref", rounded=False) + """),
  h AS (SELECT quantile_cont(log_loss_delta, 0.975) AS delta_high FROM drawn),
  g AS (SELECT count(*)::BIGINT AS groups FROM stats)"""


@query(
    "e11_gate_reasons",
    GATE_ROW + """ SELECT groups, array_to_string(list_filter([
      CASE WHEN groups < 30 THEN 'insufficient-groups' END,
      CASE WHEN NOT c.log_loss <= b.log_loss * 0.99::DOUBLE THEN 'insufficient-relative-gain' END,
      CASE WHEN NOT c.brier - b.brier <= 0 THEN 'brier-regression' END,
      CASE WHEN NOT c.ece - b.ece <= 0.01 THEN 'calibration-regression' END,
      CASE WHEN NOT coalesce(delta_high < 0, false) THEN 'uncertain-improvement' END],
      lambda x : x IS NOT NULL), ',') AS reasons FROM c, b, h, g""",
)
def gate_reasons(spark, sf):
    rows = evaluated(spark, sf)
    out = gates.gate(gates.gate_row(rows, "game_id", "y", "p", "ref"))
    return out.select("groups", F.array_join("reasons", ",").alias("reasons"))


@query(
    "e11_slice_gate",
    SLICED + f""", gs AS (SELECT slice, count(DISTINCT game_id)::BIGINT AS groups FROM sliced
      GROUP BY 1), c AS ({scores_sql("sliced", "slice", rounded=False)}),
      b AS ({scores_sql("sliced", "slice", p="ref", rounded=False)})
    SELECT slice, groups, array_to_string(list_filter([
      CASE WHEN groups < 10 THEN 'insufficient-groups' END,
      CASE WHEN NOT c.log_loss - b.log_loss <= 0.01 THEN 'slice-log-loss-regression' END,
      CASE WHEN NOT c.brier - b.brier <= 0.01 THEN 'slice-brier-regression' END],
      lambda x : x IS NOT NULL), ',') AS reasons
    FROM gs JOIN c USING (slice) JOIN b USING (slice)""",
)
def slice_gate(spark, sf):
    rows = featured_rows(spark, sf)
    labels = scoring.slice_names()
    narrow = rows.select("game_id", "y", "p", "ref", F.explode(labels).alias("slice"))
    both = scoring.paired_scores(narrow, "y", "p", "ref", ["slice"])
    games = narrow.select("game_id", "slice").distinct()
    groups = games.groupBy("slice").agg(F.count(F.lit(1)).alias("groups"))
    out = gates.slice_gate(both.join(groups, "slice"))
    return out.select("slice", "groups", F.array_join("reasons", ",").alias("reasons"))


OVERHEADS = "WITH " + bridge.LATENCIES_SQL + """, overheads AS (
  SELECT probe, schema, (a.median_us - b.base) / b.base AS overhead FROM latencies a JOIN (
    SELECT probe, median_us AS base FROM latencies WHERE schema = 'S0') b USING (probe)
  WHERE schema <> 'S0')"""

#: Candidates of the cost gate; the last has no evidence.
COSTED = ["S1", "S2", "S9"]


@query(
    "e11_unseen_gate",
    EVALUATED + f""", seen AS (SELECT DISTINCT {KEY} AS key FROM scored
      WHERE split = 'train' AND y IN (0, 1)),
    unseen AS (SELECT * FROM evaluated WHERE {KEY} NOT IN (SELECT key FROM seen)),
    c AS ({scores_sql("unseen", rounded=False)}), b AS ({scores_sql("unseen", p="ref", rounded=False)})
    SELECT c.count, array_to_string(list_filter([
      CASE WHEN c.count = 0 THEN 'no-unseen-positions' END,
      CASE WHEN NOT coalesce(c.log_loss - b.log_loss <= 0.01, false) THEN 'unseen-log-loss-regression' END,
      CASE WHEN NOT coalesce(c.brier - b.brier <= 0, false) THEN 'unseen-brier-regression' END],
      lambda x : x IS NOT NULL), ',') AS reasons FROM c, b""",
)
def unseen_gate(spark, sf):
    train = scoring.decisive(keyed(spark, sf), "y").where("split = 'train'")
    rows = evaluated(spark, sf).withColumn("key", fx.position_key("fen"))
    unseen = keys.mark_unseen(rows, train, "key").where("unseen")
    out = gates.unseen_gate(scoring.paired_scores(unseen, "y", "p", "ref"))
    return out.select("count", F.array_join("reasons", ",").alias("reasons"))


@query(
    "e11_cost_gate",
    OVERHEADS + f""", per AS (SELECT schema, avg(overhead) AS mean FROM overheads GROUP BY schema),
    wanted AS (SELECT unnest({COSTED}) AS schema)
    SELECT schema, {R("mean")} AS mean_overhead, array_to_string(list_filter([
      CASE WHEN mean IS NULL THEN 'missing-extraction-cost-evidence' END,
      CASE WHEN NOT coalesce(mean <= 0.1, false) THEN 'extraction-latency-overhead-exceeded' END],
      lambda x : x IS NOT NULL), ',') AS reasons FROM wanted LEFT JOIN per USING (schema)""",
)
def cost_gate(spark, sf):
    overheads = summaries.extraction_overhead(bridge.latencies(spark, sf), "S0")
    wanted = spark.createDataFrame([(x,) for x in COSTED], "schema string")
    out = gates.cost_gate(summaries.overhead_gate(overheads), wanted)
    return rounded(out, ("mean_overhead",)).withColumn("reasons", F.array_join("reasons", ","))


@query(
    "e12_slice_regressions",
    SLICED + f""", c AS ({scores_sql("sliced", "slice", rounded=False)}),
      b AS ({scores_sql("sliced", "slice", p="ref", rounded=False)})
    SELECT {R("greatest(0, max(b.log_loss - c.log_loss))")} AS max_log_loss_regression,
      {R("greatest(0, max(b.brier - c.brier))")} AS max_brier_regression
    FROM c JOIN b USING (slice)""",
)
def slice_regressions(spark, sf):
    """The reference ordering judged against the candidate, so that there is something to find."""
    rows, labels = featured_rows(spark, sf), scoring.slice_names()
    c = scoring.slice_scores(rows, labels, None, "y", "ref")
    b = scoring.slice_scores(rows, labels)
    out = gates.worst_regression(gates.slice_regressions(c, b))
    return rounded(out, ("max_log_loss_regression", "max_brier_regression"))


ACROSS = ("log_loss_mean", "log_loss_std", "brier_mean", "brier_std", "ece_mean", "ece_std")
ACROSS_SQL = ", ".join(
    f"{R(f'avg({m})')} AS {m}_mean, {R(f'stddev_pop({m})')} AS {m}_std"
    for m in ("log_loss", "brier", "ece")
)


@query(
    "e13_across_seeds",
    REPEATED + f""", per_seed AS ({scores_sql("measured", "seed", p="p_seed", rounded=False)})
    SELECT count(*)::BIGINT AS seeds, {ACROSS_SQL} FROM per_seed""",
)
def across_seeds(spark, sf):
    per_seed = scoring.scores(measured(spark, sf), ["seed"], "y", "p_seed")
    return rounded(scoring.across_seeds(per_seed), ACROSS)


@query(
    "e13_across_seeds_by_slice",
    REPEATED + f""", featured AS (SELECT *, {bridge.features_sql()} FROM measured),
      sliced AS (SELECT unnest({SLICE_CASES}) || '/' || seed::VARCHAR AS cell, y, p_seed
        FROM featured), per AS ({scores_sql("sliced", "cell", p="p_seed", rounded=False)})
    SELECT split_part(cell, '/', 1) AS slice, count(*)::BIGINT AS seeds, {ACROSS_SQL} FROM per
    GROUP BY 1""",
)
def across_seeds_by_slice(spark, sf):
    rows = bridge.replicates(featured_rows(spark, sf))
    per = scoring.slice_scores(rows, scoring.slice_names(), ["seed"], "y", "p_seed")
    return rounded(scoring.across_seeds(per, ["slice"]), ACROSS)


@query(
    "e14_ensemble",
    REPEATED + """, mixed AS (SELECT row_id, y, avg(p_seed) AS p FROM measured GROUP BY ALL) """
    + scores_sql("mixed"),
)
def ensemble(spark, sf):
    return rounded(
        scoring.scores(scoring.ensemble(measured(spark, sf), ["row_id", "y"], "p_seed"))
    )


@query(
    "e15_split_summary",
    S + """ SELECT coalesce(split, 'all') AS split, count(*)::BIGINT AS positions,
      count(*) FILTER (WHERE y IN (0, 1))::BIGINT AS decisive,
      count(DISTINCT game_id)::BIGINT AS games FROM scored GROUP BY ROLLUP (split)""",
)
def split_summary(spark, sf):
    return scoring.split_summary(bridge.scored(spark, sf))


STAT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {R(f'avg({c})')} AS mean, "
    f"{R(f'CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END')} AS scale FROM train"
    for c in schemas.S0
)


@query(
    "e18_train_standardisation",
    S + f", train AS (SELECT *, {bridge.features_sql()} FROM scored "
    + "WHERE split = 'train' AND y IN (0, 1)) " + STAT_SQL,
)
def train_standardisation(spark, sf):
    rows = scoring.decisive(bridge.scored(spark, sf), "y").where("split = 'train'")
    out = summaries.column_statistics(bridge.feature_columns(rows), list(schemas.S0))
    return rounded(out, ("mean", "scale"))


@query(
    "e19_overhead_gate",
    OVERHEADS + f""" SELECT schema, count(*)::BIGINT AS probes, {R("avg(overhead)")}
      AS mean_overhead, {R("max(overhead)")} AS max_overhead, avg(overhead) <= 0.1 AS cleared
    FROM overheads GROUP BY schema""",
)
def overhead_gate(spark, sf):
    out = summaries.overhead_gate(
        summaries.extraction_overhead(bridge.latencies(spark, sf), "S0")
    )
    return rounded(out, ("mean_overhead", "max_overhead"))


@query(
    "e22_schema_selection",
    REPEATED + f""", per AS ({scores_sql("measured", "seed", p="p_seed", rounded=False)}),
    arms AS (SELECT 'A' || seed::VARCHAR AS schema, log_loss FROM per),
    rate AS (SELECT avg(y) AS r FROM scored WHERE split = 'train' AND y IN (0, 1)),
    floor AS (SELECT avg({ll_sql('y', 'r')}) AS f FROM scored, rate
      WHERE split = 'validation' AND y IN (0, 1)),
    base AS (SELECT log_loss AS b FROM arms WHERE schema = 'A11')
    SELECT coalesce((SELECT arg_min(schema, log_loss) FROM arms, base WHERE schema <> 'A11'
      AND log_loss <= b AND log_loss < f), CASE WHEN b < f THEN 'A11' END) AS selected
    FROM base, floor""",
)
def schema_selection(spark, sf):
    rows = bridge.scored(spark, sf)
    per = scoring.scores(measured(spark, sf), ["seed"], "y", "p_seed")
    arms = per.withColumn("schema", F.concat(F.lit("A"), F.col("seed").cast("string")))
    decided = scoring.decisive(rows, "y")
    floor = scoring.no_information(
        decided.where("split = 'validation'"), decided.where("split = 'train'")
    )
    judged = gates.admissibility(arms, floor.select("log_loss").scalar())
    base = arms.where("schema = 'A11'").select("log_loss").scalar()
    cleared = judged.withColumn(
        "cleared", (F.col("log_loss") <= base) & F.col("admissible")
    )
    return gates.select_schema(cleared, "A11")


@query(
    "e26_budget_selection",
    REPEATED + f""", per AS ({scores_sql("measured", "seed", p="p_seed", rounded=False)})
    SELECT arg_min(seed, log_loss)::INTEGER AS selected, {R("min(log_loss)")} AS loss FROM per""",
)
def budget_selection(spark, sf):
    per = scoring.scores(measured(spark, sf), ["seed"], "y", "p_seed")
    return rounded(gates.pick_budget(per, "seed", "log_loss"), ("loss",))


GRID_SQL = EVALUATED + f""", grid AS (SELECT i, 0.5::DOUBLE + i * 0.005::DOUBLE AS t
    FROM (SELECT unnest(range(501)) AS i)),
  warm AS (SELECT i, t, y, 1 / (1 + exp(-z / t)) AS p FROM evaluated, grid) """


@query("e27_temperature_grid", GRID_SQL + scores_sql("warm", "i").replace(
    "SELECT i, m.count", "SELECT i::INTEGER AS step, m.count", 1
))
def temperature_grid(spark, sf):
    out = calibrate.temperature_scores(evaluated(spark, sf))
    return rounded(out.drop("temperature"))


@query(
    "e27_temperature_selection",
    GRID_SQL + f""", s AS ({scores_sql("warm", "i", rounded=False)})
    SELECT {R("0.5 + i * 0.005")} AS temperature, count, {R("log_loss")} AS log_loss,
      {R("brier")} AS brier, {R("ece")} AS ece FROM s
    ORDER BY s.brier, abs(0.5 + i * 0.005 - 1.0) LIMIT 1""",
)
def temperature_selection(spark, sf):
    out = calibrate.select_temperature(calibrate.temperature_scores(evaluated(spark, sf)))
    return rounded(out, ("temperature", "log_loss", "brier", "ece"))


def nearest_sql(value: str, fraction: str) -> str:
    return f"list_sort(list({value}))[floor(count(*) * {fraction}::DOUBLE)::BIGINT + 1]"


BANDS = "CASE " + " ".join(
    f"WHEN l_quantity * 100 <= {b} THEN {b}" for b in summaries.SIZE_BANDS
) + " ELSE 0 END"


@query(
    "e32_latency_bands",
    f"""SELECT ({BANDS})::INTEGER AS band, count(*)::BIGINT AS rows,
      {R("avg(l_quantity * 100)")} AS mean_size,
      {R(nearest_sql('l_discount', '0.5'))} AS l_discount_median,
      {R(nearest_sql('l_extendedprice', '0.5'))} AS l_extendedprice_median,
      {R(nearest_sql('l_extendedprice', '0.5') + ' / avg(l_quantity * 100)')} AS per_item
    FROM lineitem GROUP BY 1""",
)
def latency_bands(spark, sf):
    rows = bridge.read(spark, sf, "lineitem").select(
        (F.col("l_quantity") * 100).alias("size"), "l_discount", "l_extendedprice"
    )
    out = summaries.latency_bands(rows, "size", ["l_discount", "l_extendedprice"])
    return rounded(
        out, ("mean_size", "l_discount_median", "l_extendedprice_median", "per_item")
    )


@query(
    "e33_sample_summary",
    f"""SELECT l_returnflag, count(*)::BIGINT AS n, {R("min(l_extendedprice)")} AS min,
      {R(nearest_sql('l_extendedprice', '0.5'))} AS median,
      {R(nearest_sql('l_extendedprice', '0.95'))} AS p95, {R("max(l_extendedprice)")} AS max
    FROM lineitem GROUP BY 1""",
)
def sample_summary(spark, sf):
    rows = bridge.read(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice")
    out = summaries.sample_summary(rows, ["l_returnflag"], "l_extendedprice")
    return rounded(out, ("min", "median", "p95", "max"))


@query(
    "g5_extreme_cases",
    f"""WITH m AS (SELECT {nearest_sql('n_chars', '0.5')} AS mid FROM documents)
    SELECT 'widest' AS "case", * FROM (SELECT doc_id AS key, n_chars AS size, length(lang)::BIGINT
      AS cost FROM documents ORDER BY n_chars DESC, doc_id LIMIT 1)
    UNION ALL SELECT 'median', * FROM (SELECT doc_id, n_chars, length(lang)::BIGINT FROM documents, m
      WHERE n_chars = mid ORDER BY doc_id LIMIT 1)""",
)
def extreme_cases(spark, sf):
    docs = bridge.read(spark, sf, "documents").select(
        "doc_id", "n_chars", F.length("lang").cast("long").alias("cost")
    )
    return summaries.extreme_cases(docs, "doc_id", "n_chars", "cost")

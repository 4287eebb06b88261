"""Model fits and batch scoring over the given tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import hashing
from evalspark.functions.scoring import r6
from evalspark.operators import fit, gates, models, ranking, scoring
from evalspark.plans.metrics import rounded
from evalspark.plans.ranks import C, DOT_SQL, GAINS, WEIGHTS
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R
from evalspark.session import materialise
from evalspark.sources import schemas

BUDGETS = [2, 5, 10]


def modelled(spark, sf):
    """Scored rows with every feature column and their inner role."""
    rows = bridge.feature_columns(bridge.scored(spark, sf).drop("z", "p"), schemas.S2)
    return rows.withColumn("role", hashing.inner_role(F.col("bucket")))


def train_rows(spark, sf):
    """Decisive train rows, stored once for all the fits of a query."""
    rows = scoring.decisive(modelled(spark, sf), "y").where("split = 'train'")
    return materialise(rows, "train-rows")


@query("m1_outcome_model")
def outcome_model(spark, sf):
    """Soft labels included: a draw trains as two half-weight rows."""
    rows = modelled(spark, sf)
    columns = list(schemas.S0)
    model = fit.fit_outcome(rows.where("split = 'train'"), columns)
    held = scoring.decisive(rows.where("split = 'validation'"), "y")
    return rounded(scoring.scores(fit.predict_outcome(model, held, columns)))


@query("m1_label_model")
def label_model(spark, sf):
    """Quality of documents from plain text counts."""
    docs = bridge.read(spark, sf, "documents").join(bridge.read(spark, sf, "labels"), "doc_id")
    rows = docs.select(
        "doc_id",
        F.col("quality").cast("double").alias("y"),
        F.log1p("n_chars").alias("f0"),
        F.size(F.split("text", r"\s+")).cast("double").alias("f1"),
        F.size(F.split("text", "\n")).cast("double").alias("f2"),
        hashing.split_for(F.col("doc_id").cast("string")).alias("split"),
    )
    columns = ["f0", "f1", "f2"]
    model = fit.fit_outcome(rows.where("split = 'train'"), columns, penalty=0.01)
    return rounded(
        scoring.scores(fit.predict_outcome(model, rows, columns), ["split"])
    )


@query("m2_budget_refit")
def budget_refit(spark, sf):
    _, budget, table = fit.fit_selected(train_rows(spark, sf), list(schemas.S0), BUDGETS)
    return rounded(table, ("log_loss",)).withColumn("selected", F.col("budget") == budget)


@query("m3_temperature_calibration")
def temperature_calibration(spark, sf):
    out = fit.fit_temperature(train_rows(spark, sf), list(schemas.S0), BUDGETS)
    return rounded(out, ("temperature", "log_loss", "brier", "ece"))


def staged(spark, sf):
    """The suppliers' lists, their split drawn once per list."""
    return fit.stage_lists(bridge.candidates(spark, sf), 9, 8, split=hashing.split_for("group_id"))


@query("m4_list_ranker")
def list_ranker(spark, sf):
    model = fit.fit_ranker(staged(spark, sf))
    return spark.createDataFrame(model.history, "epoch int, train_loss double, recall_at_k double")


START = [0.05 * (i - 4) for i in range(9)]


@query(
    "m4_loss_and_gradient",
    GAINS + f""", tr AS (SELECT * FROM (SELECT *, row_number() OVER () AS id,
      count(*) OVER (PARTITION BY group_id) AS size FROM gained WHERE split = 'train') WHERE size >= 2),
    long AS (SELECT group_id, id, gain, unnest(range(9)) AS i, unnest(features)::DOUBLE AS v FROM tr),
    st AS (SELECT i, avg(v) AS mean, CASE WHEN stddev_pop(v) > 0 THEN stddev_pop(v) ELSE 1 END AS scale
      FROM long GROUP BY i),
    x AS (SELECT group_id, id, gain, i, (v - mean) / scale AS x FROM long JOIN st USING (i)),
    z AS (SELECT group_id, id, any_value(gain) AS gain, sum(x * 0.05::DOUBLE * (i - 4)) AS z FROM x GROUP BY ALL),
    m AS (SELECT *, exp(z) / sum(exp(z)) OVER (PARTITION BY group_id) AS p,
      ln(sum(exp(z)) OVER (PARTITION BY group_id)) AS lse FROM z),
    loss AS (SELECT avg(loss) AS loss FROM (SELECT any_value(lse) - sum(gain * z) AS loss FROM m GROUP BY group_id)),
    per AS (SELECT group_id, i, sum((p - x.gain) * x) AS g FROM x JOIN m USING (group_id, id) GROUP BY ALL)
    SELECT i::INTEGER AS feature, {R("any_value(loss)")} AS loss, {R("avg(g)")} AS gradient
    FROM per, loss GROUP BY i""",
)
def loss_and_gradient(spark, sf):
    """What every step of the list fit computes, at fixed weights."""
    lists = staged(spark, sf)
    loss, gradient = fit.loss_and_gradient(lists, np.array(START))
    rows = [(i, loss, float(g)) for i, g in enumerate(gradient)]
    return rounded(
        spark.createDataFrame(rows, "feature int, loss double, gradient double"), ("loss", "gradient")
    )


@query("m5_seed_replication")
def seed_replication(spark, sf):
    lists = staged(spark, sf)
    runs = fit.replicate_ranker(lists, bridge.SEEDS, floor_column=0)
    return gates.seed_range(runs, bridge.SEEDS)


@query("m6_feature_ablation")
def feature_ablation(spark, sf):
    out = fit.ablation(modelled(spark, sf), schemas.FEATURE_SETS, BUDGETS, "S0")
    return rounded(out, ("log_loss", "brier", "ece", "margin"))


@query("u1_batch_scoring", C + f" SELECT cand_idx, {R(DOT_SQL)} AS score FROM candidates")
def batch_scoring(spark, sf):
    scorer = models.batch_scorer(models.linear_session(WEIGHTS), 9)
    rows = bridge.candidates(spark, sf).select(
        "cand_idx",
        # Whole numbers survive the float32 matrix exactly; discount and tax go in as cents.
        F.transform("features", lambda v: F.round(v * 100)).alias("x"),
    )
    scored = models.score_rows(rows, "x", scorer)
    return scored.select("cand_idx", r6(F.col("score") / 100).alias("score"))


@query(
    "u2_deployed_ordering",
    C + """, s AS (SELECT group_id, cand_idx, row_number() OVER (PARTITION BY group_id
      ORDER BY features[4] DESC, cand_idx)::INTEGER AS position FROM candidates)
    SELECT group_id, cand_idx, position FROM s WHERE position <= 8""",
)
def deployed_ordering(spark, sf):
    """A stored ordering scored in bounded batches, then cut like any other score."""
    weights = [0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    scorer = models.batch_scorer(models.linear_session(weights), 9, rows=4096)
    rows = bridge.candidates(spark, sf).withColumn("score", scorer(F.col("features")))
    return ranking.shortlist(rows, 8).select("group_id", "cand_idx", "position")


@query(
    "u4_exact_binomial",
    f"""WITH c AS (SELECT user_id, count(*) FILTER (WHERE event_id % 2 = 0)::BIGINT AS wins,
      count(*)::BIGINT AS trials FROM events GROUP BY user_id),
      t AS (SELECT *, least(wins, trials - wins) AS lo FROM c)
    SELECT user_id, wins, trials, {R('''least(1, 2 * list_sum(list_transform(range(0, lo + 1),
      lambda i : exp(lgamma(trials + 1) - lgamma(i + 1) - lgamma(trials - i + 1)
        - trials * ln(2)))))''')} AS p_value FROM t""",
)
def exact_binomial(spark, sf):
    counts = bridge.read(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_id") % 2 == 0).alias("wins"), F.count(F.lit(1)).alias("trials")
    )
    # Many users share their counts: each pair is computed once.
    pairs = counts.select("wins", "trials").distinct()
    known = pairs.withColumn("p_value", r6(ranking.binomial_p("wins", "trials")))
    return counts.join(known, ["wins", "trials"]).select("user_id", "wins", "trials", "p_value")

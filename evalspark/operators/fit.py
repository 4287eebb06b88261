"""Model fits as distributed jobs. The driver holds weights and report rows, never data."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evalspark.functions import hashing
from evalspark.functions import scoring as sx
from evalspark.operators import calibrate, gates, ordering, packed, ranking, scoring
from evalspark.operators.validation import Refused
from evalspark.session import materialise


def soft_label_rows(df: DataFrame, y: str = "y") -> DataFrame:
    """A label strictly between 0 and 1 becomes two weighted rows; certain labels stay one row."""
    label = F.col(y).cast("double")
    parts = F.filter(
        F.array(
            F.struct(F.lit(1.0).alias("label"), label.alias("weight")),
            F.struct(F.lit(0.0).alias("label"), (1 - label).alias("weight")),
        ),
        lambda x: x["weight"] > 0,
    )
    return df.select("*", F.inline(parts))


def feature_vector(columns: list[str]):
    return array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))


def fit_outcome(
    train: DataFrame, columns: list[str], y: str = "y", iterations: int = 20, penalty: float = 0.0
):
    """Logistic outcome model on raw features; the scaler inside the pipeline is fitted on the
    train rows only. Returns the pipeline model."""
    rows = soft_label_rows(train, y).select(
        feature_vector(columns).alias("raw"), "label", "weight"
    )
    scaler = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    model = LogisticRegression(
        featuresCol="scaled",
        labelCol="label",
        weightCol="weight",
        maxIter=iterations,
        regParam=penalty,
        standardization=False,
    )
    return Pipeline(stages=[scaler, model]).fit(rows)


def predict_outcome(model, df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds the logit `z` and the probability `p`."""
    scored = model.transform(df.withColumn("raw", feature_vector(columns)))
    keep = df.columns
    return scored.select(
        *keep,
        F.get(vector_to_array("rawPrediction"), 1).alias("z"),
        sx.unit_clamp(F.get(vector_to_array("probability"), 1)).alias("p"),
    )


def select_budget(
    fitting: DataFrame, inner: DataFrame, columns: list[str], budgets: list[int], y: str = "y"
) -> DataFrame:
    """(budget, log_loss): each iteration budget fitted on `fitting`, judged on `inner`."""
    spark = fitting.sparkSession
    found = []
    for budget in sorted(set(budgets)):
        model = fit_outcome(fitting, columns, y, budget)
        row = scoring.scores(predict_outcome(model, inner, columns), None, y, "p").first()
        found.append((int(budget), float(row["log_loss"])))
    return spark.createDataFrame(found, "budget int, log_loss double")


def fit_selected(
    train: DataFrame, columns: list[str], budgets: list[int], role: str = "role", y: str = "y"
):
    """Budget chosen on the inner part of train, then a refit on all of train. Returns
    (model, budget, table of candidates)."""
    fitting = train.where(F.col(role) == "fit")
    inner = train.where(F.col(role) == "inner")
    table = select_budget(fitting, inner, columns, budgets, y)
    budget = gates.pick_budget(table, "budget", "log_loss").first()["selected"]
    return fit_outcome(train, columns, y, budget), budget, table


def fit_temperature(
    train: DataFrame, columns: list[str], budgets: list[int], role: str = "role",
    rule: str = "brier", y: str = "y",
) -> DataFrame:
    """Temperature of a probe fit under the budget selected on the inner rows, scored on those
    rows, which the probe has not seen. One row with the budget."""
    fitting = train.where(F.col(role) == "fit")
    inner = train.where(F.col(role) == "inner")
    table = select_budget(fitting, inner, columns, budgets, y)
    budget = gates.pick_budget(table, "budget", "log_loss").first()["selected"]
    held = predict_outcome(fit_outcome(fitting, columns, y, budget), inner, columns)
    chosen = calibrate.select_temperature(calibrate.temperature_scores(held, "z", y), rule)
    return chosen.withColumn("budget", F.lit(budget))


@dataclass
class Ranker:
    """A linear list ranker with its standardisation folded into raw-feature weights."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    epoch: int = 0
    history: list[dict] = field(default_factory=list)

    def raw_weights(self) -> np.ndarray:
        return self.weights / self.scale

    def score(self, features: str = "features"):
        shift = float((self.weights * self.mean / self.scale).sum())
        return sx.dot(F.col(features), self.raw_weights()) - shift


def recall(marked: DataFrame, k: int, keys: list[str], by: str, score: str = "score") -> dict:
    """Per value of `by`, one of the keys: share of the lists whose first k keep a best candidate."""
    first = ordering.top_rows(marked, keys, [-F.col(score), F.col("cand_idx")], k)
    picked = first.groupBy(*keys).agg(F.max(F.col("_best").cast("double")).alias("kept"))
    return {r[by]: r["kept"] for r in picked.groupBy(by).agg(F.avg("kept").alias("kept")).collect()}


@dataclass
class Lists:
    """Candidate lists made ready for any number of fits: standardised train and validation lists
    packed once, and the term of the gradient that no weight changes."""

    packed: DataFrame
    held: DataFrame
    mean: np.ndarray
    scale: np.ndarray
    pull: np.ndarray
    k: int
    group: str
    cut: bool = False

    @property
    def width(self) -> int:
        return len(self.mean)


def stage_lists(
    cands: DataFrame,
    width: int,
    k: int,
    group: str = "group_id",
    target: str = "target",
    features: str = "features",
    split: str | Column = "split",
    piece_rows: int = packed.PIECE_ROWS,
) -> Lists:
    """Standardisation and gains of the train lists; validation lists longer than k with their
    best candidates marked; both packed by list. Refused without a list to train on or to measure.

    `split` names a column of the rows, or is an expression of the group alone, which is evaluated
    once per list. The rows that count are stored once, with their list's size and best target; every
    later step reads that table."""
    keys = [group, split] if isinstance(split, str) else [group]
    cands = cands.select("cand_idx", target, features, *keys)
    stats = cands.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(target).alias("_top"))
    side = F.col(split) if isinstance(split, str) else split
    stats = stats.withColumn("_train", side == "train").withColumn("_held", side == "validation")
    chosen = F.col("_train") & (F.col("_n") >= 2) | F.col("_held") & (F.col("_n") > k)
    held = F.col("_held")
    best = F.when(held, F.col(target) == F.col("_top")).alias("_best")
    rows = cands.join(stats.where(chosen), keys)
    rows = materialise(rows.select(group, "cand_idx", target, features, "_n", held, best), "rank-lists")
    largest = dict(rows.groupBy("_held").agg(F.max("_n")).collect())
    if False not in largest:
        raise Refused("list fit refused: no train list has two candidates")
    if True not in largest:
        raise Refused(f"list fit refused: no validation list is longer than {k}")
    train, held = rows.where("NOT _held"), rows.where("_held")
    stats = {r["feature"]: r for r in ranking.standardisation(train, features, width).collect()}
    mean = np.array([stats[i]["mean"] for i in range(width)])
    scale = np.array([stats[i]["scale"] for i in range(width)])
    x = [
        (F.get(F.col(features), i).cast("double") - float(mean[i])) / float(scale[i])
        for i in range(width)
    ]
    pulls = ranking.gain_table(train, group, target, **{f"p{i}": c for i, c in enumerate(x)})
    per_list = pulls.groupBy(group).agg(
        *[F.sum(F.col("gain") * F.col(f"p{i}")).alias(f"p{i}") for i in range(width)]
    )
    row = per_list.agg(*[F.avg(f"p{i}").alias(f"p{i}") for i in range(width)]).first()
    pull = np.array([row[f"p{i}"] for i in range(width)])
    table = packed.pack(rows, group, x, "cand_idx", F.col("_held"), F.col("_best"), F.col("_n"), piece_rows)
    table = materialise(packed.closed(table, width), "rank-packed")
    held = held.select(group, "cand_idx", "_best")
    return Lists(table, held, mean, scale, pull, k, group, max(largest.values()) > piece_rows)


def measure(lists: Lists, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per model (row of `weights`): mean cross entropy over the train lists, its gradient, and
    recall on the validation lists. The gradient is mean(softmax-weighted x) less mean(gain-weighted x)."""
    got = packed.measure(lists.packed, weights, lists.k, lists.cut)
    return got.lse - weights @ lists.pull, got.means - lists.pull, got.recall


def loss_and_gradient(lists: Lists, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and gradient of one model."""
    loss, gradient, _ = measure(lists, w[None, :])
    return float(loss[0]), gradient[0]


def fit_rankers(
    lists: Lists, seeds: list[int], epochs: int = 40, patience: int = 5, rate: float = 0.1
) -> list[Ranker]:
    """Listwise fits by full-batch Adam on the mean cross entropy over train lists, one per seed, all
    in the same passes: a pass measures the recall of every model's present weights and the gradient
    of its next step. A model leaves the passes when its validation recall has not improved for
    `patience` epochs, and takes its best weights. The number of jobs does not grow with the seeds."""
    w = np.stack([np.random.default_rng(s).normal(0.0, 0.01, lists.width) for s in seeds])
    m, v = np.zeros_like(w), np.zeros_like(w)
    models = [Ranker(row.copy(), lists.mean, lists.scale) for row in w]
    best = np.full(len(seeds), -1.0)
    live = np.arange(len(seeds))
    loss, gradient, _ = measure(lists, w)
    for epoch in range(1, epochs + 1):
        m[live] = 0.9 * m[live] + 0.1 * gradient
        v[live] = 0.999 * v[live] + 0.001 * gradient**2
        w[live] -= rate * (m[live] / (1 - 0.9**epoch)) / (np.sqrt(v[live] / (1 - 0.999**epoch)) + 1e-8)
        ahead, following, measured = measure(lists, w[live])
        for i, before, now in zip(live, loss, measured):
            models[i].history.append({"epoch": epoch, "train_loss": float(before), "recall_at_k": float(now)})
            if now > best[i]:
                best[i], models[i].weights, models[i].epoch = now, w[i].copy(), epoch
        going = np.array([epoch - models[i].epoch < patience for i in live])
        live, loss, gradient = live[going], ahead[going], following[going]
        if not len(live):
            break
    return models


def fit_ranker(lists: Lists, seed: int = 11, **kw) -> Ranker:
    """The fit of one seed."""
    return fit_rankers(lists, [seed], **kw)[0]


def replicate_ranker(lists: Lists, seeds: list[int], floor_column: int, **kw) -> DataFrame:
    """(seed, recall, floor_recall, random_recall, best_epoch) per seed against the ordering by
    one feature column and a seeded random ordering, all on the lists staged once and fitted
    together. A repeated seed is refused."""
    if len(set(seeds)) != len(seeds):
        raise ValueError("a seed appears twice")
    spark = lists.held.sparkSession
    # Standardising a column keeps its order.
    floor = measure(lists, np.eye(lists.width)[[floor_column]])[2][0]
    draws = [
        F.struct(F.lit(s).alias("seed"), ranking.random_score(s, lists.group, "cand_idx").alias("score"))
        for s in seeds
    ]
    drawn = lists.held.select(lists.group, "cand_idx", "_best", F.inline(F.array(*draws)))
    chance = recall(drawn, lists.k, [lists.group, "seed"], "seed")
    rows = [
        (s, max(h["recall_at_k"] for h in model.history), float(floor), float(chance[s]), model.epoch)
        for s, model in zip(seeds, fit_rankers(lists, seeds, **kw))
    ]
    return spark.createDataFrame(
        rows, "seed int, recall double, floor_recall double, random_recall double, best_epoch int"
    )


def ablation(
    rows: DataFrame,
    feature_sets: dict[str, tuple],
    budgets: list[int],
    baseline: str,
    y: str = "y",
    rules: gates.GateRules = gates.GateRules(),
) -> DataFrame:
    """One protocol over several feature sets: inner budget selection, refit on train, scores on
    validation, margin to the no-information reference, and the decision. `rows` carry split,
    bucket and every feature column; they are stored once. Returns one row per set: `cleared` needs
    an admissible loss that undercuts the baseline's by the required share without a worse Brier
    score or calibration than the rules allow; `selected` marks the set to take."""
    spark = rows.sparkSession
    decisive = rows.where(F.col(y).isin(0.0, 1.0))
    train = decisive.where(F.col("split") == "train").withColumn(
        "role", hashing.inner_role(F.col("bucket"))
    )
    train = materialise(train, "ablation-train")
    validation = materialise(decisive.where(F.col("split") == "validation"), "ablation-validation")
    out = []
    for name, columns in feature_sets.items():
        model, budget, _ = fit_selected(train, list(columns), budgets, "role", y)
        scored = predict_outcome(model, validation, list(columns))
        row = scoring.scores(scored, None, y, "p").first()
        out.append(
            (name, len(columns), int(budget), row["count"], row["log_loss"], row["brier"], row["ece"])
        )
    table = spark.createDataFrame(
        out,
        "schema string, features int, budget int, count long, log_loss double, brier double, "
        "ece double",
    )
    floor = scoring.no_information(validation, train, y=y).select("log_loss").first()[0]
    base = next(r for r in out if r[0] == baseline)
    judged = gates.admissibility(table, F.lit(floor))
    cleared = (
        F.col("admissible")
        & (F.col("log_loss") <= base[4] * (1 - rules.min_relative_log_loss_gain))
        & (F.col("brier") - base[5] <= rules.max_brier_regression)
        & (F.col("ece") - base[6] <= rules.max_ece_regression)
    )
    judged = judged.withColumn("cleared", cleared)
    chosen = gates.select_schema(judged, baseline).first()["selected"]
    return judged.withColumn("selected", F.lit(chosen).eqNullSafe(F.col("schema")))

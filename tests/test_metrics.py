import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.operators import bootstrap, calibrate, gates, multinomial, ranking, scoring, summaries

ROWS = [
    ("a", 1.0, 0.9), ("a", 0.0, 0.2), ("b", 1.0, 0.4), ("b", 0.0, 0.05), ("c", 1.0, 1.0),
    ("c", 0.0, 0.35), ("d", 1.0, 0.75), ("d", 1.0, 0.71),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "g string, y double, p double").withColumn(
        "ref", F.lit(0.5)
    )


def brute_scores(pairs):
    y = np.array([a for a, _ in pairs])
    p = np.array([b for _, b in pairs])
    q = np.clip(p, 1e-15, 1 - 1e-15)
    ll = (-y * np.log(q) - (1 - y) * np.log1p(-q)).mean()
    bins = np.minimum((p * 10).astype(int), 9)
    ece = sum(
        (bins == i).mean() * abs(p[bins == i].mean() - y[bins == i].mean())
        for i in range(10)
        if (bins == i).any()
    )
    return ll, ((p - y) ** 2).mean(), ece


@pytest.mark.parametrize("parts", [1, 7])
def test_scores_by_hand(rows, parts):
    row = scoring.scores(rows.repartition(parts)).first()
    ll, br, ece = brute_scores([(y, p) for _, y, p in ROWS])
    assert (row["count"], row.prevalence) == (8, 5 / 8)
    assert (row.log_loss, row.brier, row.ece) == pytest.approx((ll, br, ece))


def test_paired_scores_equal_two_passes(rows):
    both = scoring.paired_scores(rows, "y", "p", "ref").first()
    ref = scoring.scores(rows, None, "y", "ref").first()
    assert both.ref_log_loss == pytest.approx(ref.log_loss)
    assert both.ref_brier == pytest.approx(ref.brier) and both.ref_ece == pytest.approx(ref.ece)


def test_calibration_keeps_empty_bins(rows):
    table = {r.bin: r for r in scoring.calibration_table(rows).collect()}
    assert len(table) == 10 and table[5]["count"] == 0 and table[5].prediction is None
    assert table[7]["count"] == 2 and table[9]["count"] == 2


def test_slice_report_names_missing_slices(spark):
    df = spark.createDataFrame(
        [(3, "w", 30.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0, 0.6)],
        "ply int, side string, total_material double, material_diff double, "
        "king_capture_attack double, king_capture_danger double, queen_capture_attack double, "
        "queen_capture_danger double, y double, p double",
    )
    report = {r.slice: r for r in scoring.slice_report(df, scoring.slice_names()).collect()}
    measured = {s for s, r in report.items() if r.status == "measured"}
    assert measured == {
        "phase:opening", "side:w", "material:balanced", "target:decisive", "tactical:king_attack",
    }
    assert len(report) == len(scoring.SLICES)


def test_poisson_weights_have_unit_mean_and_variance():
    coef = bootstrap.coefficients(13, 400)
    points = np.random.default_rng(0).integers(0, bootstrap.PRIME, 300)
    w = bootstrap.poisson_weights(points, coef)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.05


@pytest.mark.parametrize("parts", [1, 7])
def test_bootstrap_equals_direct_weighting_of_rows(spark, rows, parts):
    """Sufficient statistics must give what reweighting every row gives."""
    out = bootstrap.score_intervals(rows.repartition(parts), "g", ref="ref", repeats=200)
    got = {r.metric: (r.low, r.high) for r in out.collect()}
    names = sorted({g for g, _, _ in ROWS})
    points = [
        r[0]
        for r in spark.createDataFrame([(n,) for n in names], "g string")
        .orderBy("g")
        .select(bootstrap.group_point(13, F.col("g")))
        .collect()
    ]
    w = bootstrap.poisson_weights(np.array(points), bootstrap.coefficients(13, 200))
    ll, delta = [], []
    for r in range(200):
        weight = np.array([w[names.index(g), r] for g, _, _ in ROWS])
        if weight.sum() == 0:
            continue
        y = np.array([y for _, y, _ in ROWS])
        q = np.clip(np.array([p for _, _, p in ROWS]), 1e-15, 1 - 1e-15)
        loss = -y * np.log(q) - (1 - y) * np.log1p(-q)
        ll.append((weight * loss).sum() / weight.sum())
        delta.append((weight * (loss - math.log(2))).sum() / weight.sum())
    assert got["log_loss"] == pytest.approx(tuple(np.quantile(ll, [0.025, 0.975])))
    assert got["log_loss_delta"] == pytest.approx(tuple(np.quantile(delta, [0.025, 0.975])))


def test_interval_width_agrees_with_fixed_count_resampling(spark):
    """Poisson and fixed-count draws agree in distribution on a few hundred groups."""
    rng = np.random.default_rng(5)
    values = rng.normal(size=400)
    df = spark.createDataFrame([(f"g{i}", float(v)) for i, v in enumerate(values)], "g string, v double")
    row = bootstrap.ratio_interval(df, "g", "v", "m").first()
    draws = [values[rng.integers(0, 400, 400)].mean() for _ in range(2000)]
    low, high = np.quantile(draws, [0.025, 0.975])
    assert row["mean"] == pytest.approx(values.mean())
    assert row.low == pytest.approx(low, abs=0.02) and row.high == pytest.approx(high, abs=0.02)


def test_fewer_than_two_groups_have_no_interval(rows):
    out = bootstrap.score_intervals(rows.where("g = 'a'"), "g", repeats=20).collect()
    assert all(r.low is None and r.high is None and r.groups == 1 for r in out)


def test_empty_comparison_is_zero(spark):
    empty = spark.createDataFrame([], "group_id string, hit boolean, ref_hit boolean")
    row = ranking.paired_interval(
        empty, F.col("hit").cast("double") - F.col("ref_hit").cast("double"), repeats=20
    ).first()
    assert (row.delta, row.ci_low, row.ci_high, row.groups) == (0.0, 0.0, 0.0, 0)


LISTS = {
    "a": [(5, 1.0), (5, 3.0), (2, 2.0), (9, 0.5)],
    "b": [(1, 4.0), (1, 3.0), (1, 2.0)],
    "c": [(7, 0.1)],
    "d": [(2147483647, -1.0), (3, 2.0), (2, 2.0), (2, 9.0), (1, 0.0), (0, 0.0)],
}


@pytest.fixture(scope="module")
def lists(spark):
    data = [
        (g, i, t, s, t == 2147483647) for g, v in LISTS.items() for i, (t, s) in enumerate(v)
    ]
    return spark.createDataFrame(
        data, "group_id string, cand_idx int, target long, score double, terminal boolean"
    )


def brute_gains(targets):
    ranks = []
    for t in targets:
        above = sum(x > t for x in targets)
        ranks.append(above + (sum(x == t for x in targets) + 1) / 2)
    raw = [1 / r**2 for r in ranks]
    return [x / sum(raw) for x in raw]


@pytest.mark.parametrize("parts", [1, 7])
def test_gains(lists, parts):
    got = {(r.group_id, r.cand_idx): r.gain for r in ranking.target_gains(lists.repartition(parts)).collect()}
    for g, v in LISTS.items():
        for i, gain in enumerate(brute_gains([t for t, _ in v])):
            assert got[(g, i)] == pytest.approx(gain)


def test_gains_ignore_units(lists):
    a = ranking.target_gains(lists).select("group_id", "cand_idx", "gain")
    b = ranking.target_gains(lists.withColumn("target", F.col("target") * 10 + 3)).select(
        "group_id", "cand_idx", "gain"
    )
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("parts", [1, 7])
def test_hits_and_ndcg_by_hand(lists, parts):
    out = ranking.width_metrics(lists.repartition(parts), (1, 2, 3)).collect()
    got = {(r.group_id, r.k): (r.hit, r.ndcg) for r in out}
    for g, v in LISTS.items():
        gains = brute_gains([t for t, _ in v])
        order = sorted(range(len(v)), key=lambda i: (-v[i][1], i))
        best = max(t for t, _ in v)
        for k in (1, 2, 3):
            if len(v) <= k:
                assert (g, k) not in got
                continue
            dcg = sum(gains[i] / math.log2(n + 2) for n, i in enumerate(order[:k]))
            ideal = sum(x / math.log2(n + 2) for n, x in enumerate(sorted(gains)[::-1][:k]))
            hit, ndcg = got[(g, k)]
            assert hit == any(v[i][0] == best for i in order[:k])
            assert ndcg == pytest.approx(dcg / ideal)


def test_unmeasured_width_is_reported(lists):
    report = {r.k: r for r in ranking.width_report(ranking.width_metrics(lists)).collect()}
    assert not report[48].measured and report[48].groups == 0 and report[48].ndcg_at_k is None
    assert report[1].groups == 3


def test_listwise_loss_against_numpy(lists):
    far = lists.withColumn("score", F.col("score") * 400 - 3000)
    for df, f in ((lists, lambda s: s), (far, lambda s: s * 400 - 3000)):
        got = {r.group_id: r.loss for r in ranking.listwise_loss(df).collect()}
        for g, v in LISTS.items():
            s = np.array([f(x) for _, x in v])
            logp = s - s.max() - np.log(np.exp(s - s.max()).sum())
            assert got[g] == pytest.approx(-(np.array(brute_gains([t for t, _ in v])) * logp).sum())


def test_terminal_branch_completes_the_full_loss(lists):
    """When terminal rows hold their gain as probability, the split loss is the full one."""
    got = {r.group_id: r for r in ranking.terminal_loss(lists).collect()}
    gains = np.array(brute_gains([t for t, _ in LISTS["d"]]))
    s = np.array([x for _, x in LISTS["d"]])[1:]
    logp = s - np.log(np.exp(s).sum())
    mass = gains[1:].sum()
    expected = -gains[0] * np.log(gains[0]) - mass * np.log(mass) - (gains[1:] * logp).sum()
    assert got["d"].loss == pytest.approx(expected) and got["d"].live == 5
    plain = {r.group_id: r.loss for r in ranking.listwise_loss(lists).collect()}
    assert got["a"].loss == pytest.approx(plain["a"])


def test_softmax_sums_to_one(lists):
    sums = ranking.softmax(lists).groupBy("group_id").agg(F.sum("softmax").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in sums)


def test_terminal_rows_come_first(lists):
    top = ranking.shortlist(lists.where("group_id = 'd'"), 2, terminal="terminal").orderBy("position")
    assert [r.cand_idx for r in top.collect()] == [0, 3]


@pytest.mark.parametrize("wins,trials", [(0, 0), (3, 3), (1, 10), (5, 10), (9, 10), (400, 1030)])
def test_binomial_is_exact(wins, trials):
    observed = math.comb(trials, wins)
    exact = sum(math.comb(trials, k) for k in range(trials + 1) if math.comb(trials, k) <= observed)
    expected = min(1.0, exact / 2**trials) if trials else 1.0
    assert ranking.two_sided_binomial(wins, trials) == pytest.approx(expected, rel=1e-12)


@pytest.mark.parametrize("wins", [900, 1100, 1250])
def test_long_binomial_tail_joins_the_exact_one(wins):
    n = 2500
    exact = 2 * sum(math.comb(n, k) for k in range(min(wins, n - wins) + 1)) / 2**n
    assert ranking.two_sided_binomial(wins, n) == pytest.approx(min(1.0, exact), rel=1e-9)


def test_a_hot_list_gives_the_same_answers(spark):
    """One list holds a third of the rows; small limits force the bucketed plan."""
    i = F.col("id")
    df = spark.range(6000).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (i % 50).cast("string")))
        .alias("group_id"),
        i.alias("cand_idx"),
        F.pmod(F.xxhash64(i), F.lit(900)).alias("target"),
        (F.pmod(F.xxhash64(i, F.lit(7)), F.lit(500)) / 10).alias("score"),
    )
    from evalspark.operators import ordering

    plain = ranking.gain_table(df)
    h = ordering.histogram(df, ["group_id"], "target")
    cut = ordering.running_total(h, ["group_id"], [-F.col("target")], "n", "through", window_rows=5)
    a = plain.select("group_id", "target", "through")
    assert a.exceptAll(cut.select("group_id", "target", "through")).count() == 0
    hot = [(r.target, r.score, r.cand_idx) for r in df.where("group_id = 'hot'").collect()]
    order = sorted(hot, key=lambda r: (-r[1], r[2]))[:48]
    got = ranking.width_metrics(df, (48,)).where("group_id = 'hot'").first()
    assert got.hit == (max(t for t, _, _ in hot) in [t for t, _, _ in order])
    gains = dict(zip([c for _, _, c in hot], brute_gains([t for t, _, _ in hot])))
    dcg = sum(gains[c] / math.log2(n + 2) for n, (_, _, c) in enumerate(order))
    ideal = sum(x / math.log2(n + 2) for n, x in enumerate(sorted(gains.values())[::-1][:48]))
    assert got.ndcg == pytest.approx(dcg / ideal)


def test_temperature_recovers_the_planted_one(spark):
    rng = np.random.default_rng(1)
    z = rng.normal(size=4000) * 3
    y = (rng.random(4000) < 1 / (1 + np.exp(-z / 2))).astype(float)
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(z, y)], "z double, y double"
    ).repartition(5)
    best = calibrate.select_temperature(calibrate.temperature_scores(df), "log_loss").first()
    assert best.temperature == pytest.approx(2.0, abs=0.3)


def test_an_uninformative_holdout_keeps_temperature_one(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0)], "z double, y double")
    best = calibrate.select_temperature(calibrate.temperature_scores(df)).first()
    assert best.temperature == 1.0


def test_gate_lists_every_failed_reason(spark):
    row = spark.createDataFrame(
        [(5, 0.69, 0.25, 0.05, 0.69, 0.24, 0.01, None)],
        "groups long, log_loss double, brier double, ece double, ref_log_loss double, "
        "ref_brier double, ref_ece double, delta_high double",
    )
    assert gates.gate(row).first().reasons == [
        "insufficient-groups", "insufficient-relative-gain", "brier-regression",
        "calibration-regression", "uncertain-improvement",
    ]
    good = row.select(
        F.lit(40).alias("groups"), F.lit(0.6).alias("log_loss"), F.lit(0.2).alias("brier"),
        F.lit(0.01).alias("ece"), "ref_log_loss", "ref_brier", "ref_ece",
        F.lit(-0.01).alias("delta_high"),
    )
    assert gates.gate(good).first().reasons == []


@pytest.mark.parametrize(
    "arms,expected",
    [
        ([("S0", 0.69, True, False), ("S1", 0.60, True, True), ("S2", 0.61, True, True)], "S1"),
        ([("S0", 0.69, True, False), ("S1", 0.60, True, False), ("S2", 0.7, True, False)], "S0"),
        ([("S0", 0.70, False, False), ("S1", 0.60, False, False)], None),
    ],
)
def test_schema_selection(spark, arms, expected):
    df = spark.createDataFrame(arms, "schema string, log_loss double, admissible boolean, cleared boolean")
    assert gates.select_schema(df, "S0").first().selected == expected


def test_seed_range_needs_the_protocol_seeds(spark):
    runs = spark.createDataFrame(
        [(1, 0.5, 0.4), (2, 0.3, 0.4)], "seed int, recall double, floor_recall double"
    )
    row = gates.seed_range(runs, [2, 1]).first()
    assert row.complete and (row.admissible_seeds, row.inadmissible_seeds) == (1, 1)
    assert not gates.seed_range(runs, [1, 2, 3]).first().complete


def test_budget_tie_goes_to_the_smallest(spark):
    df = spark.createDataFrame([(40, 0.5), (10, 0.5), (5, 0.6)], "budget int, loss double")
    assert gates.pick_budget(df, "budget", "loss").first().selected == 10


def test_constant_feature_keeps_scale_one(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "a double, b double")
    got = {r.feature: (r["mean"], r.scale) for r in summaries.column_statistics(df, ["a", "b"]).collect()}
    assert got == {"a": (2.0, 1.0), "b": (2.0, 1.0)}


def test_gates_fail_closed(spark):
    from evalspark.operators import gates

    names = "count long, log_loss double, brier double, ref_log_loss double, ref_brier double"
    rows = [(0, None, None, None, None), (5, 0.6, 0.2, 0.6, 0.2), (5, 0.62, 0.21, 0.6, 0.2)]
    got = [r.reasons for r in gates.unseen_gate(spark.createDataFrame(rows, names)).collect()]
    assert "no-unseen-positions" in got[0] and got[1] == []
    assert got[2] == ["unseen-log-loss-regression", "unseen-brier-regression"]
    costs = spark.createDataFrame([("S1", 0.05), ("S2", 0.2)], "schema string, mean_overhead double")
    wanted = spark.createDataFrame([("S1",), ("S2",), ("S9",)], "schema string")
    got = {r.schema: r.reasons for r in gates.cost_gate(costs, wanted).collect()}
    assert got["S1"] == [] and got["S2"] == ["extraction-latency-overhead-exceeded"]
    assert "missing-extraction-cost-evidence" in got["S9"]


def test_fixed_draws_split_down_a_tree(monkeypatch):
    counts = np.array([3, 0, 5, 1, 0, 0, 2, 9])
    weights = [multinomial.bucket_weights(counts, b, 400, 5) for b in range(8)]
    assert [w.shape[1] for w in weights] == counts.tolist()
    both = np.hstack(weights)
    assert (both.sum(axis=1) == 20).all()
    # Moments of a plain multinomial draw of 20 of 20.
    assert both.mean(axis=0) == pytest.approx(np.ones(20), abs=0.25)
    assert both.var(axis=0).mean() == pytest.approx(0.95, abs=0.1)
    cov = np.cov(both.T)
    assert cov[~np.eye(20, dtype=bool)].mean() == pytest.approx(-0.05, abs=0.02)


def test_fixed_count_bootstrap(spark, monkeypatch):
    monkeypatch.setattr(multinomial, "BUCKET_GROUPS", 16)
    rng = np.random.default_rng(3)
    data = [(f"g{i}" if i else None, int(rng.integers(1, 9)), float(rng.normal())) for i in range(300)]
    stats = spark.createDataFrame(data, "g string, n int, s double")
    got = sorted(map(tuple, multinomial.fixed_sums(stats, "g", ["n", "s"], 200, 7).collect()))
    assert [r[0] for r in got] == list(range(-1, 200)) and {r[3] for r in got} == {300}
    assert got[0][1] == sum(r[1] for r in data)
    again = sorted(map(tuple, multinomial.fixed_sums(stats.repartition(5), "g", ["n", "s"], 200, 7).collect()))
    assert np.array(again) == pytest.approx(np.array(got))
    # The spread of the mean is that of resampling directly.
    n, s = np.array([r[1] for r in data]), np.array([r[2] for r in data])
    drawn = rng.integers(0, 300, (2000, 300))
    direct = s[drawn].sum(axis=1) / n[drawn].sum(axis=1)
    ratios = np.array([r[2] / r[1] for r in got[1:]])
    assert ratios.std() == pytest.approx(direct.std(), rel=0.2)
    assert multinomial.fixed_sums(stats.limit(0), "g", ["n"], 10, 7).count() == 0


def test_intervals_with_fixed_draws(rows):
    a = {r.metric: r for r in bootstrap.score_intervals(rows, "g", ref="ref", fixed=True).collect()}
    b = {r.metric: r for r in bootstrap.score_intervals(rows, "g", ref="ref").collect()}
    for name in a:
        assert a[name].point == pytest.approx(b[name].point) and a[name].groups == 4
        assert a[name].low <= a[name].point <= a[name].high or name == "ece"

"""Sources, sinks, keys, validation: refusals and invariances."""

import gzip
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from evalspark.operators import fit, keys, models, reconcile, summaries, validation
from evalspark.operators.validation import Refused
from evalspark.sources import readers, schemas, writers
from evalspark.streaming import enrich

KINGS = "4k3/8/8/8/8/8/8/4K3"
POSITIONS = [
    ("g1", 0, f"{KINGS} w - -", "PNB", "w", 1.0),
    ("g1", 1, f"{KINGS} b - -", "QQK", "b", 0.0),
    ("g2", 0, f"{KINGS} w - - 0 1", "bnp", "w", 0.5),
]


@pytest.fixture(scope="module")
def positions(spark):
    return spark.createDataFrame(POSITIONS, schemas.POSITION)


def broken(report):
    return {r.rule for r in report.where("n > 0").collect()}


def test_clean_positions_pass(positions):
    report = validation.violations(positions, validation.position_rules(), "game_id")
    assert broken(report) == set()
    validation.require_clean(report)


@pytest.mark.parametrize(
    "column,value,rule",
    [
        ("fen", None, "null_fen"), ("fen", "  ", "blank_fen"), ("ply", -1, "negative_ply"),
        ("side", "x", "side_domain"), ("result", 0.25, "result_domain"), ("dice", "PP", "dice"),
        ("dice", "PXN", "dice"), ("result", None, "result_domain"),
    ],
)
def test_each_fault_is_refused(positions, column, value, rule):
    bad = positions.withColumn(
        column,
        F.when(F.col("game_id") == "g2", F.lit(value)).otherwise(F.col(column))
        .cast(positions.schema[column].dataType),
    )
    report = validation.violations(bad, validation.position_rules(), "game_id")
    assert rule in broken(report)
    with pytest.raises(Refused, match=rule):
        validation.require_clean(report)


def test_position_scan_checks_names_and_types(spark, positions, tmp_path):
    good = str(tmp_path / "good")
    positions.write.parquet(good)
    assert readers.positions(spark, good).count() == 3
    wrong = str(tmp_path / "wrong")
    positions.withColumn("result", F.col("result").cast("double")).write.parquet(wrong)
    with pytest.raises(Refused, match="result is double"):
        readers.positions(spark, wrong)
    short = str(tmp_path / "short")
    positions.drop("dice").write.parquet(short)
    with pytest.raises(Refused, match="missing dice"):
        readers.positions(spark, short)
    with pytest.raises(Refused, match="schema version"):
        readers.positions(spark, good, version="v0")


def test_export_reads_gzip_by_column_name(spark, tmp_path):
    path = tmp_path / "export.csv.gz"
    with gzip.open(path, "wt") as out:
        out.write("result,game_id,turn_number,fen,dice,side\n")
        out.write(f"1,g1,0,{KINGS} w - -,pnb,w\n-1,g1,1,{KINGS} b - -,qqk,b\n")
        out.write(f"0,g2,0,{KINGS} b - -,qqk,b\n7,g3,0,{KINGS} b - -,qqk,b\n")
    export = readers.export(spark, str(path))
    bad = validation.violations(export, readers.export_rules(), "game_id").first()
    assert (bad.n, bad.sample_key) == (1, "g3")
    rows = readers.to_positions(export.where("game_id <> 'g3'")).orderBy("game_id", "ply").collect()
    assert [(r.dice, r.result) for r in rows] == [("PNB", 1.0), ("QQK", 1.0), ("QQK", 0.5)]


def test_every_file_is_admitted(spark, positions, tmp_path):
    good, short, wide = (str(tmp_path / n) for n in ("good", "short", "wide"))
    positions.write.parquet(good)
    positions.drop("dice").write.parquet(short)
    positions.withColumn("result", F.col("result").cast("double")).write.parquet(wide)
    with pytest.raises(Refused, match="missing dice"):
        readers.positions(spark, good, short)
    with pytest.raises(Refused, match="result is double"):
        readers.positions(spark, good, wide)
    columns = schemas.S0
    rows = enriched(positions, columns)
    identity = {"feature_schema": "S0", "engine_version": "0.9.3", "columns": ",".join(columns)}
    paths = [str(tmp_path / n) for n in ("one", "two", "three")]
    writers.enriched(rows, paths[0], columns, identity)
    writers.enriched(rows, paths[1], columns, {**identity, "engine_version": "0.9.2"})
    rows.withColumn("more", F.lit(1.0)).write.parquet(paths[2])
    for other in paths[1:]:
        with pytest.raises(Refused, match="differ"):
            readers.enriched(spark, paths[0], other, expected=identity)
    with pytest.raises(Refused, match="identity names other"):
        writers.enriched(rows, str(tmp_path / "four"), columns[:3], identity)


def test_export_with_two_headers_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("game_id,turn_number,fen,dice,side,result\ng1,0,f,pnb,w,1\n")
    (tmp_path / "b.csv").write_text("result,game_id,turn_number,fen,dice,side\n1,g2,0,f,pnb,w\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    assert readers.export(spark, paths[1]).first().game_id == "g2"
    with pytest.raises(Exception, match="header"):
        readers.export(spark, *paths).collect()


def test_export_without_a_column_is_refused(spark, tmp_path):
    path = tmp_path / "export.csv"
    path.write_text("game_id,fen\ng1,x\n")
    with pytest.raises(Refused, match="turn_number"):
        readers.export(spark, str(path))


def enriched(positions, columns):
    cols = [F.lit(float(i)).cast("float").alias(c) for i, c in enumerate(columns)]
    return positions.select("*", *cols)


def test_enriched_round_trip_and_refusals(spark, positions, tmp_path):
    path = str(tmp_path / "enriched")
    identity = {"feature_schema": "S0", "engine_version": "0.9.3"}
    writers.enriched(enriched(positions, schemas.S0), path, schemas.S0, identity)
    assert readers.enriched(spark, path, expected=identity).count() == 3
    with pytest.raises(Refused, match="engine_version"):
        readers.enriched(spark, path, expected={**identity, "engine_version": "0.9.4"})
    with pytest.raises(Refused, match="missing own_moves_p"):
        readers.enriched(spark, path, columns=schemas.S1)
    extra = str(tmp_path / "extra")
    with pytest.raises(Refused, match="feature schema"):
        writers.enriched(enriched(positions, schemas.S1), extra, schemas.S1, identity)
    wide = {**identity, "feature_schema": "S1"}
    writers.enriched(enriched(positions, schemas.S1), extra, schemas.S1, wide)
    with pytest.raises(Refused, match="unexpected own_moves_p"):
        readers.enriched(spark, extra, columns=schemas.S0)


def bundle_source(positions):
    block = F.array(*[F.lit(0.0).cast("float")] * 13)
    feats = [F.get(block, i).alias(c) for i, c in enumerate(schemas.S0)]
    return positions.select("*", *feats)


def test_bundle_round_trip(spark, positions, tmp_path):
    path = str(tmp_path / "bundle")
    manifest = writers.bundle(writers.bundle_rows(bundle_source(positions)), path, {"schema": "x"})
    rows, declared = readers.bundle(spark, path)
    assert rows.count() == 3 and declared["rows_digest"] == manifest["rows_digest"]
    assert sorted(os.listdir(tmp_path)) == ["bundle"]
    with pytest.raises(Refused, match="already exists"):
        writers.bundle(rows, path, {"schema": "x"})
    readers.bundle(spark, path, {"schema": "x"})
    with pytest.raises(Refused, match="schema is 'x'"):
        readers.bundle(spark, path, {"schema": "y"})
    for part in (tmp_path / "bundle" / "rows").glob("*.json"):
        part.write_text(part.read_text().replace('"result":1.0', '"result":0.5'))
    for check in (tmp_path / "bundle" / "rows").glob(".*.crc"):
        check.unlink()
    with pytest.raises(Refused, match="digest"):
        readers.bundle(spark, path)


@pytest.mark.parametrize(
    "change,rule",
    [
        (lambda d: d.withColumn("features", F.transform("features", lambda v: v + 1)), "material"),
        (lambda d: d.withColumn("side", F.lit("w")), "fen_side"),
        (lambda d: d.withColumn("fen", F.replace("fen", F.lit("K"), F.lit("k"))), "kings"),
        (lambda d: d.withColumn("fen", F.replace("fen", F.lit("/8/"), F.lit("/7/"))), "placement"),
        (lambda d: d.withColumn("result", F.lit(0.3)), "result"),
        (lambda d: d.withColumn("id", F.lit("same")), "duplicate row identity"),
        (lambda d: d.withColumn("group_id", F.col("id")), "crosses groups"),
        (lambda d: d.withColumn("features", F.slice("features", 1, 12)), "features"),
        (lambda d: d.where("false"), "no rows"),
    ],
)
def test_bad_bundles_publish_nothing(positions, tmp_path, change, rule):
    path = str(tmp_path / "bundle")
    rows = writers.bundle_rows(bundle_source(positions))
    with pytest.raises(Refused, match=rule):
        writers.bundle(change(rows), path, {"schema": "x"})
    assert not os.path.exists(path)


def test_roots_keep_the_earliest_and_one_spelling(spark):
    fen = "r3k2r/8/8/8/8/8/8/R3K2R w {} - {}"
    df = spark.createDataFrame(
        [
            ("g2", 4, fen.format("KQkq", "0 1"), "PNB", "w", 1.0),
            ("g1", 9, fen.format("kqKQ", "3 2"), "bnp", "w", 1.0),
            ("g1", 7, fen.format("KQkq", ""), "NBP", "w", 0.0),
            ("g1", 2, fen.format("-", ""), "NBP", "w", 0.0),
        ],
        schemas.POSITION,
    )
    roots = keys.distinct_roots(df).collect()
    assert len(roots) == 2
    kept = {(r.game_id, r.ply): r for r in roots}
    assert kept[("g1", 7)].occurrences == 3 and kept[("g1", 7)].dice == "BNP"


def test_root_file_refuses_separators_and_keeps_order(spark, positions, tmp_path):
    roots = keys.distinct_roots(positions)
    path = str(tmp_path / "roots")
    writers.roots(roots, path)
    stored = [tuple(r) for r in writers.read_roots(spark, path).collect()]
    expected = roots.orderBy("order_key").select("game_id", "fen", "dice", "side").collect()
    assert stored == [tuple(r) for r in expected]
    for char in "\t\n\r":
        with pytest.raises(Refused, match="separator_game_id"):
            writers.roots(
                roots.withColumn("game_id", F.lit(f"a{char}b")), str(tmp_path / "bad")
            )


def test_limit_must_be_positive(positions):
    with pytest.raises(ValueError, match="positive"):
        keys.sample_roots(keys.distinct_roots(positions), 0)


def test_hold_out_keeps_games_whole(spark):
    df = spark.range(400).select((F.col("id") % 20).alias("g"), "id")
    train, held = keys.hold_out_games(df, "g", 0.25, 3)
    a = {r.g for r in train.collect()}
    b = {r.g for r in held.collect()}
    assert not a & b and len(b) == 5 and train.count() + held.count() == 400
    with pytest.raises(Refused):
        keys.hold_out_games(df.where("g = 1"), "g", 0.25, 3)


def test_excluding_everything_is_a_refusal(spark):
    df = spark.createDataFrame([("a",), ("a",)], "key string")
    with pytest.raises(Refused):
        validation.require_rows(keys.exclude_seen(df, df, "key"), "rows")
    row = keys.exclusion_counts(df, spark.createDataFrame([("z",)], "key string"), "key").first()
    assert (row.input_rows, row.removed_rows, row.kept_rows) == (2, 0, 2)


def test_digest_follows_contents_only(spark):
    df = spark.range(10000).select(
        F.col("id"), (F.col("id") / 7).alias("x"), F.lit(None).cast("string").alias("s")
    )

    def digest(d, **kw):
        return summaries.content_digest(d, **kw).first().digest

    base = digest(df)
    assert digest(df.repartition(9).select("s", "x", "id")) == base
    edited = df.withColumn("x", F.when(F.col("id") == 77, 0.0).otherwise(F.col("x")))
    assert digest(edited) != base
    assert digest(df.union(df.where("id = 5"))) != base
    assert digest(df, metadata={"engine": "2"}) != base


def test_reconciliation_survives_repeated_keys(spark):
    left = spark.createDataFrame([(1, 0.5), (2, 0.5), (2, 0.5), (3, 0.1)], "k int, p double")
    right = spark.createDataFrame([(1, 0.5), (2, 0.6), (4, 0.1)], "k int, p double")
    row = reconcile.coverage(left, right, ["k"], ["p"]).first()
    assert (row.shared, row.missing, row.extra, row.repeated, row.mismatch_p) == (2, 1, 1, 1, 1)
    parity = reconcile.prediction_parity(left, right, "k", "p").first()
    assert not parity.passed and parity.max_abs_error == pytest.approx(0.1)
    ones = spark.createDataFrame([(1, 0.5), (2, 0.5)], "k int, p double")
    twice = ones.union(spark.createDataFrame([(1, 0.9)], ones.schema))
    parity = reconcile.prediction_parity(ones, twice, "k", "p").first()
    assert (parity.passed, parity.repeated) == (False, 1)
    assert reconcile.prediction_parity(ones, ones, "k", "p").first().passed


def test_pair_tie_is_a_failure(spark):
    df = spark.createDataFrame(
        [("a-blunder", 1.0), ("a-safe", 1.0), ("b-blunder", 1.0), ("b-safe", 1.1), ("c-safe", 2.0)],
        "id string, score double",
    )
    got = {r.pair: r for r in reconcile.pair_margins(df, "id", "score").collect()}
    assert (got["a"].passed, got["b"].passed, got["c"].complete) == (False, True, False)


def test_frozen_split_counts(spark):
    cands = spark.createDataFrame([("a",), ("a",), ("b",)], "group_id string")
    splits = spark.createDataFrame(
        [("a", "train"), ("c", "screen")], "group_id string, split string"
    )
    row = readers.frozen_splits(cands, splits).first()
    assert (row.assigned, row.unassigned, row.unknown_groups, row.bad_split) == (1, 1, 1, 0)
    twice = splits.union(spark.createDataFrame([("a", "screen")], splits.schema))
    assert (row.repeated, readers.frozen_splits(cands, twice).first().repeated) == (0, 1)


def test_long_lists_continue_on_further_lines(spark):
    df = spark.range(25).select(F.lit("g").alias("group_id"), F.col("id").alias("cand_idx"),
                                F.col("id").cast("string").alias("sha"))
    lines = writers.fingerprint_lines(df, per_line=10).orderBy("part").collect()
    assert [len(r.candidate_state_sha256) for r in lines] == [10, 10, 5]
    assert sum((r.candidate_state_sha256 for r in lines), []) == [str(i) for i in range(25)]


def test_stream_adds_every_file_once(spark, positions, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    project = lambda d: d.select("game_id", F.upper("dice").alias("dice"))
    positions.write.parquet(source)
    args = (spark, source, schemas.POSITION, project, sink, state)
    enrich.stream_files(*args)
    enrich.stream_files(*args)
    assert spark.read.parquet(sink).count() == 3
    positions.write.mode("append").parquet(source)
    assert enrich.stream_files(*args) == 3
    assert spark.read.parquet(sink).count() == 6


def test_stream_counts_more_batches_than_spark_remembers(spark, positions, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "4")
    try:
        positions.repartition(3).write.parquet(source)
        for _ in range(3):
            positions.repartition(3).write.mode("append").parquet(source)
        files = len(list((tmp_path / "in").glob("*.parquet")))
        found = enrich.stream_files(
            spark, source, schemas.POSITION, lambda d: d.select("game_id"), sink, state, files_per_batch=1
        )
        assert files > 6 and found == 12
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_giant_game_spreads_over_files_of_one_shard(spark, tmp_path):
    i = F.col("id")
    df = spark.range(900).select(
        F.when(i < 600, F.lit("big")).otherwise(F.concat(F.lit("g"), (i % 30).cast("string")))
        .alias("game_id"), i.alias("ply"), i.alias("ordinal"),
    )
    path = str(tmp_path / "shards")
    # Tiny partitions would be merged again; at real sizes they are not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    writers.position_shards(df, path, 50)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    stored = spark.read.parquet(path).select("*", F.input_file_name().alias("f"))
    per = {
        r.game_id: (r.shards, r.files)
        for r in stored.groupBy("game_id")
        .agg(F.count_distinct("shard").alias("shards"), F.count_distinct("f").alias("files"))
        .collect()
    }
    assert stored.count() == 900 and per["big"][0] == 1 and per["big"][1] > 4
    assert all(v == (1, 1) for g, v in per.items() if g != "big")
    files = stored.where("game_id = 'big'").groupBy("f").agg(F.min("ply").alias("lo"), F.max("ply").alias("hi"))
    spans = [(r.lo, r.hi) for r in files.orderBy("f").collect()]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_report_is_exclusive(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "k string, m double")
    path = str(tmp_path / "report")
    writers.report([writers.tidy("s", df, "k", ["m"])], path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        writers.report([writers.tidy("s", df, "k", ["m"])], path)
    writers.report([writers.tidy("s", df, "k", ["m"])], path, overwrite=True)


def test_scoring_refuses_wrong_width_and_non_finite(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    with pytest.raises(Exception, match="expected 3 features"):
        models.score_rows(df, "x", models.batch_scorer(models.linear_session([1, 1, 1]), 3)).collect()
    with pytest.raises(Exception, match="expected 2 features"):
        none = df.select(F.lit(None).cast("array<double>").alias("x"))
        models.score_rows(none, "x", models.batch_scorer(models.linear_session([1, 1]), 2)).collect()
    bad = models.linear_session([float("nan"), 1.0])
    with pytest.raises(Exception, match="non-finite"):
        models.score_rows(df, "x", models.batch_scorer(bad, 2)).collect()
    good = models.batch_scorer(models.linear_session([1.0, 1.0]), 2, clamp=True)
    assert models.score_rows(df, "x", good).first().score == 1.0


def test_soft_labels_become_weighted_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 0.0), (3, 0.5)], "i int, y double")
    rows = fit.soft_label_rows(df).select("i", "label", "weight").collect()
    assert sorted(map(tuple, rows)) == [(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 0.0, 0.5), (3, 1.0, 0.5)]


def test_outcome_model_learns_and_scaler_sees_train_only(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 2)) * [1, 50]
    y = (rng.random(1500) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    df = spark.createDataFrame(
        [(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double"
    )
    model = fit.fit_outcome(df, ["a", "b"])
    z = np.array([r.z for r in fit.predict_outcome(model, df, ["a", "b"]).collect()])
    assert np.corrcoef(z, x[:, 0])[0, 1] > 0.98


def test_ranker_learns_the_planted_feature(spark):
    rng = np.random.default_rng(4)
    data = []
    for g in range(60):
        split = "train" if g < 40 else "validation"
        x = rng.normal(size=(12, 3))
        target = np.argsort(np.argsort(x[:, 1] * 3 + 7))
        data += [
            (f"g{g}", i, int(target[i]), split, [float(v) for v in x[i]]) for i in range(12)
        ]
    df = spark.createDataFrame(
        data, "group_id string, cand_idx int, target long, split string, features array<double>"
    )
    lists = fit.stage_lists(df, 3, 2)
    model = fit.fit_ranker(lists, epochs=6, patience=5, rate=0.5)
    assert max(h["recall_at_k"] for h in model.history) > 0.9
    assert abs(model.weights[1]) > 3 * max(abs(model.weights[0]), abs(model.weights[2]))
    losses = [h["train_loss"] for h in model.history]
    assert losses[-1] < losses[0]
    with pytest.raises(ValueError, match="twice"):
        fit.replicate_ranker(lists, [1, 1], 0)
    with pytest.raises(Refused, match="longer than 12"):
        fit.stage_lists(df, 3, 12)
    with pytest.raises(Refused, match="train list"):
        fit.stage_lists(df.where("cand_idx = 0 OR split = 'validation'"), 3, 2)


def test_ranker_stops_early_and_restores_the_best_weights(spark, monkeypatch):
    lists = fit.Lists(None, None, np.zeros(1), np.ones(1), np.zeros(1), 2, "group_id")
    steps = iter([0.0, 0.3, 0.5, 0.4, 0.5, 0.2, 0.9])
    one = np.ones(1)
    monkeypatch.setattr(fit, "measure", lambda lists, w: (one, one[None, :], np.array([next(steps)])))
    model = fit.fit_ranker(lists, epochs=40, patience=3, rate=0.1)
    assert model.epoch == 2 and len(model.history) == 5


def brute_measure(data, w, k, mean, scale):
    """Mean log-sum-exp, mean softmax-weighted features and recall, list by list."""
    lists = {}
    for g, i, target, split, x in data:
        lists.setdefault((split, g), []).append((i, target, (np.array(x) - mean) / scale))
    lse, means, kept = [], [], []
    for (split, _), rows in lists.items():
        z = np.array([x @ w for _, _, x in rows])
        if split == "train" and len(rows) > 1:
            lse.append(np.log(np.exp(z).sum()))
            means.append((np.exp(z - lse[-1])[:, None] * np.array([x for _, _, x in rows])).sum(axis=0))
        if split == "validation" and len(rows) > k:
            top = max(t for _, t, _ in rows)
            first = sorted(range(len(rows)), key=lambda j: (-z[j], rows[j][0]))[:k]
            kept.append(any(rows[j][1] == top for j in first))
    return np.mean(lse), np.mean(means, axis=0), np.mean(kept)


@pytest.mark.parametrize("piece_rows", [7, 4096])
def test_packed_lists_are_measured_whole(spark, piece_rows):
    """Several models in one pass, lists cut into pieces or not, tied scores: as list by list; and
    fits of several seeds together are those of each seed alone."""
    rng = np.random.default_rng(8)
    data = []
    for g in range(24):
        size = 150 if g in (3, 5) else int(rng.integers(1, 20))
        split = "train" if g % 4 < 2 or g == 3 else "validation"
        for i in range(size):
            x = [float(v) for v in rng.integers(0, 3, 3)]
            data.append((f"g{g}", i, int(3 * x[1] + rng.integers(0, 4)), split, x))
    df = spark.createDataFrame(
        data, "group_id string, cand_idx int, target long, split string, features array<double>"
    )
    lists = fit.stage_lists(df.repartition(3), 3, 2, piece_rows=piece_rows)
    assert lists.cut == (piece_rows == 7)
    w = np.array([[0.3, -0.2, 0.1], [0.0, 1.0, 0.0], [1.0, 0.5, -2.0]])
    got = fit.packed.measure(lists.packed, w, 2, lists.cut)
    for m, row in enumerate(w):
        lse, means, kept = brute_measure(data, row, 2, lists.mean, lists.scale)
        assert abs(got.lse[m] - lse) < 1e-9 and abs(got.recall[m] - kept) < 1e-9
        assert np.abs(got.means[m] - means).max() < 1e-9
    both = fit.fit_rankers(lists, [1, 2], epochs=3, patience=2)
    for seed, model in zip([1, 2], both):
        alone = fit.fit_ranker(lists, seed, epochs=3, patience=2)
        assert np.abs(alone.weights - model.weights).max() < 1e-9 and alone.epoch == model.epoch
        assert [h["recall_at_k"] for h in alone.history] == [h["recall_at_k"] for h in model.history]


def test_every_file_of_a_scan_is_judged(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    names = [f.name for f in schemas.POSITION.fields]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.float32()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*POSITIONS), kinds)], names)
    wide = table.cast(pa.schema([(n, pa.large_string() if pa.types.is_string(t) else t) for n, t in zip(names, kinds)]))
    coded = table.set_column(4, "side", table["side"].dictionary_encode())
    good, bad = tmp_path / "good", tmp_path / "bad"
    for path in (good, bad):
        path.mkdir()
    for i, t in enumerate((table, wide, coded)):  # shards of other writers
        pq.write_table(t, good / f"{i}.parquet")
    (good / "_notes").write_text("not a shard")
    assert readers.positions(spark, str(good)).count() == 9
    pq.write_table(table, bad / "a.parquet")
    pq.write_table(table.drop(["dice"]), bad / "b.pq")
    with pytest.raises(Refused, match="missing dice"):
        readers.positions(spark, str(bad))


def test_prefiltered_exclusion_decides_exactly(spark):
    rows = spark.createDataFrame([(i, None if i % 50 == 0 else f"k{i % 400}") for i in range(1000)], "i int, k string")
    seen = spark.createDataFrame([(f"k{i}",) for i in range(0, 400, 7)] * 2 + [(None,)], "k string")
    want = sorted(r.i for r in keys.exclude_seen(rows, seen, "k").collect())
    for blocks in (1, 64):
        got = keys.exclude_seen_prefiltered(rows, seen, "k", blocks)
        assert sorted(r.i for r in got.collect()) == want
    maybe = keys.maybe_seen(rows, keys.seen_filter(seen, "k", 64), "k", 64).where("_maybe").count()
    assert 1000 - len(want) <= maybe < 300  # only these rows are shuffled
    halves = [keys.seen_filter(seen.where(f"coalesce(xxhash64(k), 0) % 2 {op} 0"), "k", 8) for op in ("=", "<>")]
    whole = {r.block: bytes(r.bits) for r in keys.seen_filter(seen, "k", 8).collect()}
    assert {r.block: bytes(r.bits) for r in keys.merged_filters(halves[0].union(halves[1])).collect()} == whole
    assert keys.exclude_seen_prefiltered(rows, seen.limit(0), "k").count() == 1000


def test_digest_tree_locates_an_edited_row(spark):
    rows = spark.range(3000).selectExpr("id", "id * 7 % 11 AS v", "'x' AS t")
    tree = summaries.digest_tree(rows, "id")
    turned = summaries.digest_tree(rows.repartition(7).select("t", "v", "id"), "id")
    assert summaries.tree_differences(tree, turned).count() == 0
    edited = rows.withColumn("v", F.when(F.col("id") == 1234, 99).otherwise(F.col("v")))
    path = rows.where("id = 1234").select(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 3)).first()[0]
    found = summaries.tree_differences(tree, summaries.digest_tree(edited, "id")).collect()
    assert [(r.level, r.path) for r in found] == [(3, path)] and found[0].rows_a == found[0].rows_b
    lost = summaries.tree_differences(tree, summaries.digest_tree(rows.where("id <> 5").union(rows.where("id = 6")), "id")).collect()
    assert sum(r.rows_a - r.rows_b for r in lost) == 0 and len(lost) == 2
    hot = spark.range(500).selectExpr("1 AS id", "id AS v")  # one key: its leaf is cut by the rows
    leaves = summaries.digest_tree(hot, "id", depth=1, spread=2).where("level = 3")
    assert leaves.count() > 50 and leaves.agg(F.max("rows")).first()[0] < 20
    empty = summaries.digest_tree(rows.limit(0), "id").collect()
    assert [(r.level, r.rows) for r in empty] == [(0, 0)]
    assert summaries.tree_differences(tree, summaries.digest_tree(rows.limit(0), "id")).agg(F.sum("rows_a")).first()[0] == 3000

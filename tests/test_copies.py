"""Queries against their SQL on tables that the smallest driver tables do not show."""

import os
import shutil

import duckdb
import numpy as np
import pyarrow as pa
from oracle import TABLES, compare
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from evalspark.operators import fit, packed, shards
from evalspark.session import materialise
from evalspark.sources import readers, schemas, writers

SF = "/root/testdata/sf0.001"


def test_unseen_gate_without_unseen_positions(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE orders AS SELECT * FROM '{SF}/orders.parquet' WHERE o_orderkey < 40")
    con.execute(f"COPY orders TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    got = queries()["e11_unseen_gate"](spark, str(tmp_path))
    row = got.first()
    assert row["count"] == 0 and "no-unseen-positions" in row["reasons"]
    assert compare(got, con, oracle_sql()["e11_unseen_gate"]) is None


def test_footers_of_a_table_in_several_files(spark, tmp_path):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{tmp_path}/{t}.parquet"
        if t in ("orders", "region"):
            os.makedirs(path)
            for part in "ab":
                shutil.copy(f"{SF}/{t}.parquet", f"{path}/part-{part}.parquet")
        else:
            shutil.copy(f"{SF}/{t}.parquet", path)
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*' * os.path.isdir(path)}')")
    got = queries()["u5_footer_reader"](spark, str(tmp_path))
    assert compare(got, con, oracle_sql()["u5_footer_reader"]) is None


def test_a_pass_holds_few_candidates_at_once(monkeypatch):
    rows, sizes = [], [40, 7, 300, 1, 60, 60, 5]
    for i, n in enumerate(sizes):
        x = np.random.default_rng(i).normal(size=2 * n).tolist()
        rows.append({"list": str(i), "held": i == 3, "pieces": 1, "x": x, "tie": list(range(n)), "best": [True] * n})
    batch, weights = pa.RecordBatch.from_pylist(rows), np.array([[0.3, -0.2], [1.0, 2.0]])
    seen, softened = [], packed._softened

    def spy(w, x, at, n):
        seen.append(len(x))
        return softened(w, x, at, n)

    monkeypatch.setattr(packed, "_softened", spy)
    whole = list(packed._pass(weights, 3)([batch]))[-1].to_pylist()
    monkeypatch.setattr(packed, "SLICE_ROWS", 100)
    seen.clear()
    cut = list(packed._pass(weights, 3)([batch]))[-1].to_pylist()
    assert max(seen) == 300 and sorted(seen)[-2] <= 100 and sum(seen) == sum(sizes) - 1
    for a, b in zip(whole, cut):
        assert a["n"] == b["n"] and np.allclose(a["sums"], b["sums"], rtol=1e-12)


def test_lists_staged_by_a_split_of_the_group(spark):
    rows = [(f"g{g}", 10 * g + i, (g * i) % 5, [float(i), float(g * i % 3)]) for g in range(12) for i in range(6)]
    df = spark.createDataFrame(rows, "group_id string, cand_idx long, target long, features array<double>")
    split = F.when(F.length("group_id") == 3, "validation").when(F.col("group_id") == "g5", "test").otherwise("train")
    named, drawn = fit.stage_lists(df.withColumn("split", split), 2, 2), fit.stage_lists(df, 2, 2, split=split)
    w = np.array([[0.1, -0.4]])
    for a, b in zip(fit.measure(named, w), fit.measure(drawn, w)):
        assert np.allclose(a, b, rtol=1e-12)
    a, b = (lists.packed.select("list", "held", "tie").orderBy("list").collect() for lists in (named, drawn))
    assert a == b


def test_features_of_lists_are_sent_to_a_pass_compressed(spark):
    rows = [(f"g{g}", 1000 * g + i, (g * i) % 5, [float(i % 7), float(g * i % 3), 0.01 * (i % 11)]) for g in range(8) for i in range(300)]
    df = spark.createDataFrame(rows, "group_id string, cand_idx long, target long, features array<double>")
    split = F.when(F.col("group_id") < "g2", "validation").otherwise("train")
    whole, cut = (fit.stage_lists(df, 3, 2, split=split, piece_rows=n) for n in (4096, 70))
    sent = whole.packed.agg(F.sum(F.length("x")), F.sum("size")).first()
    assert sent[1] == 2400 and sent[0] < 2400 * 8
    w = np.array([[0.1, -0.4, 0.2], [0.0, 0.0, 0.0], [-1.0, 0.3, 2.0]])
    for a, b in zip(fit.measure(whole, w), fit.measure(cut, w)):
        assert np.allclose(a, b, rtol=1e-12)
    x = np.array([r[3] for r in rows]).reshape(8, 300, 3)[2:]
    x = (x - whole.mean) / whole.scale
    z = x @ w.T
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    means = np.einsum("gim,gif->mf", p, x) / 6
    assert np.allclose(fit.measure(whole, w)[1], means - whole.pull, rtol=1e-9, atol=1e-12)


def test_jumps_between_shards_stay_on_the_executors(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialise(df, name)

    monkeypatch.setattr(shards, "materialise", kept)
    rows = spark.range(4000).select((F.col("id") % 500).alias("game"), F.col("id").alias("at"))
    placed = shards.assign_shards(rows, "game", "at", 20)
    assert placed.agg(F.max("shard")).first()[0] == 4000 // 24 and len(plans) > 4
    assert not any("BroadcastHashJoin" in plan for plan in plans)


def test_many_shards_are_written_by_few_tasks(spark, tmp_path, monkeypatch):
    asked, repartition = [], type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda df, n, *c: asked.append(n) or repartition(df, n, *c))
    rows = spark.range(3000).select((F.col("id") % 300).alias("game_id"), F.col("id").alias("ply"), F.col("id").alias("ordinal"))
    writers.position_shards(rows, f"{tmp_path}/shards", 10)
    stored = spark.read.parquet(f"{tmp_path}/shards")
    assert asked == [writers.SHARD_TASKS]
    assert stored.count() == 3000 and stored.groupBy("shard").count().where("count <> 10").isEmpty()
    assert stored.select("shard").distinct().count() == 300


def test_a_bundle_is_parsed_once_and_what_was_judged_is_read(spark, tmp_path):
    feats = [F.lit(0.0).cast("float").alias(c) for c in schemas.S0]
    row = ("g1", 0, "4k3/8/8/8/8/8/8/4K3 w - -", "PNB", "w", 1.0)
    source = spark.createDataFrame([row], schemas.POSITION).select("*", *feats)
    path = f"{tmp_path}/bundle"
    writers.bundle(writers.bundle_rows(source), path, {"schema": "x"})
    rows, _ = readers.bundle(spark, path)
    for part in (tmp_path / "bundle" / "rows").iterdir():
        part.unlink()
    assert [(r.id, r.result) for r in rows.collect()] == [("g1:0", 1.0)]

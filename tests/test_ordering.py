"""Ranks and totals must be exact, independent of partitioning, and survive one group holding a
third of the rows or more."""

import pytest
from pyspark.sql import functions as F

from evalspark.operators import keys, ordering, shards


@pytest.fixture(scope="module")
def skewed(spark):
    """9,000 rows: one list holds a third, half of its scores tie."""
    i = F.col("id")
    group = F.when(i % 3 == 0, 0).otherwise(i % 97 + 1)
    score = F.when(i % 2 == 0, 5).otherwise(F.pmod(F.xxhash64(i), F.lit(1000)))
    return spark.range(9000).select(group.cast("int").alias("g"), score.alias("s"), i.alias("i"))


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append((r["s"], r["i"]))
    return {(g, i): n + 1 for g, v in by.items() for n, (_, i) in enumerate(sorted(v))}


@pytest.mark.parametrize("window_rows", [10, 1_000_000])
@pytest.mark.parametrize("parts", [1, 7])
def test_row_numbers(spark, skewed, window_rows, parts):
    out = ordering.row_numbers(
        skewed.repartition(parts), ["g"], ["s", "i"], window_rows=window_rows
    )
    assert {(r.g, r.i): r.rn for r in out.collect()} == brute(skewed.collect())


@pytest.mark.parametrize("spread", [True, False])
def test_hot_group_is_cut_along_its_own_keys(spark, spread):
    """No (group, range) holds more than a window, be the keys of the hot group spread over all or
    next to each other; small groups are left whole but for the range boundaries."""
    hot = F.col("id") % 10 == 0 if spread else F.col("id") < 4000
    df = spark.range(40_000).select(F.when(hot, -1).otherwise(F.col("id") % 997).alias("g"), "id")
    keyed = ordering.keyed_by(df, ["id"])
    cut = ordering.ranges_of(keyed.repartition(5), ["g"], 40_000, 400)
    pieces = cut.groupBy("g", "_bucket").count()
    assert pieces.agg(F.max("count")).first()[0] <= 400
    groups, ranges = pieces.select("g").distinct().count(), pieces.select("_bucket").distinct().count()
    assert pieces.count() < groups + ranges


def test_global_running_total(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    a = ordering.running_total(df.repartition(5), [], ["k"], "v", window_rows=10)
    got = {r.k: r.running for r in a.collect()}
    total = 0
    for k in range(5000):
        total += k % 7
        assert got[k] == total


def test_group_limit_comes_before_the_exchange(spark, skewed):
    """The hot group is cut inside each input task, not after being collected."""
    top = ordering.top_rows(skewed.repartition(7), ["g"], [-F.col("s"), F.col("i")], 48)
    plan = top._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.splitlines() if "WindowGroupLimit" in x or "hashpartitioning(g" in x]
    assert "Final" in lines[0] and "hashpartitioning" in lines[1] and "Partial" in lines[2]


@pytest.mark.parametrize("k, kw", [(1, {}), (8, {}), (2000, {}), (2000, {"window_rows": 50})])
def test_top_rows(spark, skewed, k, kw):
    out = ordering.top_rows(skewed.repartition(7), ["g"], [-F.col("s"), F.col("i")], k, **kw)
    got = {}
    for r in out.collect():
        got.setdefault(r.g, {})[r.position] = r.i
    by = {}
    for r in skewed.collect():
        by.setdefault(r["g"], []).append((-r["s"], r["i"]))
    for g, v in by.items():
        expected = [i for _, i in sorted(v)[:k]]
        assert [got[g][n + 1] for n in range(len(expected))] == expected


def test_nearest_rank_uses_no_interpolation(spark):
    for values in ([3, 1, 2, 4], list(range(101)), [7], [5, 5, 5, 9]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        row = ordering.nearest_rank(df, [], "v", {"median": 0.5, "p95": 0.95}).first()
        ordered = sorted(values)
        n = len(ordered)
        assert (row.n, row.min, row.max) == (n, ordered[0], ordered[-1])
        assert row["median"] == ordered[n // 2] and row.p95 == ordered[int(n * 0.95)]


def test_bigger_prefix_contains_smaller(spark):
    df = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    a = [r.k for r in ordering.ordered_prefix(df, "k", 50).collect()]
    b = [r.k for r in ordering.ordered_prefix(df.repartition(7), "k", 500).collect()]
    assert b[:50] == a and len(b) == 500
    every = sorted(r.k for r in df.collect())
    for limit in (1, 2999, 3000, 5000):
        assert [r.k for r in ordering.ordered_prefix(df, "k", limit).collect()] == every[:limit]
    assert ordering.ordered_prefix(df.where("k = 'x'"), "k", 5).count() == 0


def greedy(sizes, n):
    """Reference fold: close a shard at the first game boundary at or after n rows."""
    shard, filled, out = 0, 0, []
    for s in sizes:
        out.append(shard)
        filled += s
        if filled >= n:
            shard, filled = shard + 1, 0
    return out


@pytest.mark.parametrize("size", [1, 10, 1000])
@pytest.mark.parametrize(
    "sizes", [[3, 4, 5, 1, 1, 20, 2, 2, 2, 9, 10, 1], [1] * 70, [7, 300, 1, 1, 1, 40]]
)
def test_shards_match_the_sequential_fold(spark, sizes, size):
    rows, ordinal = [], 0
    for g, s in enumerate(sizes):
        for _ in range(s):
            rows.append((f"g{g}", ordinal))
            ordinal += 1
    df = spark.createDataFrame(rows, "game string, ordinal long").repartition(3)
    got = {r.game: r.shard for r in shards.assign_shards(df, "game", "ordinal", size).collect()}
    assert [got[f"g{g}"] for g in range(len(sizes))] == greedy(sizes, size)


def test_interleaved_games_stay_whole(spark):
    df = spark.createDataFrame(
        [("a", 0, 1), ("b", 1, 1), ("a", 2, 2), ("b", 3, 2), ("c", 4, 1)],
        "game string, ordinal long, ply int",
    )
    rows = shards.sharded_rows(df, "game", "ordinal", 2).orderBy("start", "ply").collect()
    assert [(r.game, r.shard) for r in rows] == [
        ("a", 0), ("a", 0), ("b", 1), ("b", 1), ("c", 2),
    ]


def test_first_games(spark):
    df = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), ("c", 3)], "g string, o long")
    assert {r.g for r in keys.first_games(df, "g", "o", 2).collect()} == {"a", "b"}


@pytest.mark.parametrize("sample", [1, 16, 4096])
def test_first_rows_do_not_depend_on_the_sample(spark, sample):
    """Nulls come first, as in a sort; a sample of one key cuts little off and changes nothing."""
    k = F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(90)))
    df = spark.range(4000).select(k.alias("k"), F.concat(F.lit("g"), "id").alias("name")).repartition(4)
    for limit in (0, 3, 571, 572, 3999):
        got = ordering.first_rows(df, ["k", "name"], limit, 60, sample).collect()
        want = df.orderBy("k", "name").limit(limit).collect()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_first_rows_are_not_sorted(spark, capsys):
    """Only the range that holds the cut is ordered."""
    df = spark.range(50_000).select(F.xxhash64("id").alias("k"), "id")
    found = ordering.first_rows(df, ["k", "id"], 20_000, 5_000)
    found.explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan and "Window" not in plan and "Sort [" not in plan
    assert found.count() == 20_000


@pytest.mark.parametrize("window_rows", [40, 1_000_000])
def test_first_rows_by_rank_equals_limit(spark, window_rows):
    df = spark.range(3000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("k"), "id")
    for limit in (1, 700, 2999, 4000):
        b = ordering.first_rows(df.repartition(5), ["k", "id"], limit, window_rows)
        want = [tuple(r) for r in df.orderBy("k", "id").limit(limit).collect()]
        assert sorted(tuple(r) for r in b.collect()) == want


SPECIAL = [0.0, -0.0, 1e-308, -1e308, float("inf"), float("-inf"), float("nan"), -2.5, 2.5]


@pytest.mark.parametrize("kind", ["double", "float", "long", "int", "date"])
@pytest.mark.parametrize("parts", [1, 6])
def test_nearest_rank_is_that_of_the_sorted_values(spark, kind, parts):
    """Distinct values, ties, both signs and a group with a third of the rows."""
    i = F.col("id")
    spread = F.pmod(F.xxhash64(i), F.lit(2_000_003)) - 1_000_000
    value = {
        "double": spread / 7.0,
        "float": (spread / 7.0).cast("float"),
        "long": spread * F.lit(4_000_000_000_000),
        "int": (spread % 50).cast("int"),
        "date": F.date_add(F.lit("1970-01-01").cast("date"), (spread % 9000).cast("int")),
    }[kind]
    df = spark.range(3000).select(F.when(i % 3 == 0, "hot").when(i % 3 == 1, (i % 11).cast("string")).alias("g"), value.alias("v"))
    df = df.repartition(parts)
    out = ordering.nearest_rank(df, ["g"], "v", {"median": 0.5, "p95": 0.95, "first": 0.0})
    by = {}
    for r in df.collect():
        by.setdefault(r.g, []).append(r.v)
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    assert set(got) == set(by) and None in by
    for g, values in by.items():
        v, n = sorted(values), len(values)
        assert got[g] == (n, v[0], v[n // 2], v[int(n * 0.95)], v[0], v[-1])


def test_nearest_rank_of_special_values(spark):
    df = spark.createDataFrame([(x,) for x in SPECIAL] + [(None,)], "v double")
    fractions = {f"r{i}": (i + 0.5) / 9 for i in range(9)}
    row = ordering.nearest_rank(df, [], "v", fractions).first()
    wanted = [float("-inf"), -1e308, -2.5, 0.0, 0.0, 1e-308, 2.5, float("inf"), float("nan")]
    assert row.n == 9 and repr([row[f"r{i}"] + 0.0 for i in range(9)]) == repr(wanted)
    empty = ordering.nearest_rank(df.where("v IS NULL"), [], "v", {"median": 0.5}).collect()
    assert [tuple(r) for r in empty] == [(0, None, None, None)]
    assert ordering.nearest_rank(df.withColumn("g", F.lit(1)).where("false"), ["g"], "v", {"median": 0.5}).collect() == []


def test_selection_sorts_no_rows(spark, capsys):
    """The rows meet partial aggregates only; what is sorted are counted bins and their totals."""
    from evalspark.operators import selection

    plans = []
    keep = selection.materialise

    def watched(df, name):
        df.explain()
        plans.append(capsys.readouterr().out)
        return keep(df, name)

    selection.materialise = watched
    try:
        df = spark.range(5000).select((F.col("id") / 3.0).alias("v"))
        row = ordering.nearest_rank(df, [], "v", {"median": 0.5}).first()
    finally:
        selection.materialise = keep
    assert row.median == 2500 / 3.0
    first = plans[2]
    assert "Window" in first and first.index("Window") < first.index("HashAggregate")
    assert "Sort" not in first[first.index("HashAggregate"):]

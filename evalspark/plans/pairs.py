"""Pairs and reconciliations."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import fen as fx
from evalspark.functions.scoring import r6
from evalspark.operators import reconcile
from evalspark.plans.expressions import FEATURED, P
from evalspark.plans.metrics import rounded
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R
from evalspark.sources import schemas


@query(
    "d7_schema_alignment",
    FEATURED + """, a AS (SELECT * FROM featured WHERE row_id % 211 <> 3),
    b AS (SELECT row_id, game_id, ply, CASE WHEN row_id % 197 = 1 THEN fen || ' ' ELSE fen END AS fen,
      side, p_diff + CASE WHEN row_id % 193 = 2 THEN 1 ELSE 0 END AS p_diff, mobility_diff
      FROM featured WHERE row_id % 223 <> 4),
    j AS (SELECT a.row_id AS ra, b.row_id AS rb, a.fen IS DISTINCT FROM b.fen AS f, a.side IS DISTINCT
      FROM b.side AS s, a.p_diff IS DISTINCT FROM b.p_diff AS p, a.mobility_diff IS DISTINCT FROM
      b.mobility_diff AS m FROM a FULL JOIN b ON a.game_id = b.game_id AND a.ply = b.ply),
    c AS (SELECT count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL)::BIGINT AS shared,
      count(*) FILTER (WHERE rb IS NULL)::BIGINT AS missing,
      count(*) FILTER (WHERE ra IS NULL)::BIGINT AS extra, 0::BIGINT AS repeated,
      (count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL AND f) + count(*) FILTER (WHERE
        ra IS NOT NULL AND rb IS NOT NULL AND s))::BIGINT AS source_mismatches,
      (count(*) FILTER (WHERE ra IS NOT NULL AND rb IS NOT NULL AND p) + count(*) FILTER (WHERE
        ra IS NOT NULL AND rb IS NOT NULL AND m))::BIGINT AS prefix_mismatches FROM j)
    SELECT *, missing + extra + repeated + source_mismatches + prefix_mismatches = 0 AS aligned
    FROM c""",
)
def schema_alignment(spark, sf):
    k = F.col("row_id")
    rows = bridge.feature_columns(bridge.positions(spark, sf), schemas.S1)
    narrow = rows.select("row_id", "game_id", "ply", "fen", "side", "p_diff", "mobility_diff")
    wide = narrow.where(k % 223 != 4).withColumn(
        "fen", F.when(k % 197 == 1, F.concat("fen", F.lit(" "))).otherwise(F.col("fen"))
    ).withColumn(
        "p_diff",
        F.when(k % 193 == 2, F.col("p_diff") + 1).otherwise(F.col("p_diff")).cast("float"),
    )
    return reconcile.schema_alignment(
        narrow.where(k % 211 != 3),
        wide,
        ["game_id", "ply"],
        ["fen", "side"],
        ["p_diff", "mobility_diff"],
    )


T = "WITH " + bridge.TWINS_SQL


@query(
    "d8_twin_checks",
    T + f""" SELECT base, count(*) FILTER (WHERE half = '') > 0 AS complete,
      {R("abs(max(p) FILTER (WHERE half = '') - max(p) FILTER (WHERE half <> ''))")} AS difference,
      coalesce(abs(max(p) FILTER (WHERE half = '') - max(p) FILTER (WHERE half <> ''))
        <= 0.00001, false) AS passed
    FROM twin_probes GROUP BY base HAVING count(*) FILTER (WHERE half <> '') > 0""",
)
def twin_checks(spark, sf):
    return rounded(
        reconcile.twin_checks(bridge.twin_probes(spark, sf), "id", "p"), ("difference",)
    )


CHAINS = {"first-three": ["probe-0", "probe-1", "probe-2"], "reverse": ["probe-2", "probe-1"]}


@query(
    "d8_order_checks",
    T + """, v AS (SELECT max(p) FILTER (WHERE id = 'probe-0') AS a,
      max(p) FILTER (WHERE id = 'probe-1') AS b, max(p) FILTER (WHERE id = 'probe-2') AS c
      FROM twin_probes)
    SELECT 'first-three' AS "check", coalesce(a > b AND b > c, false) AS passed FROM v
    UNION ALL SELECT 'reverse', coalesce(c > b, false) FROM v""",
)
def order_checks(spark, sf):
    return reconcile.order_checks(bridge.twin_probes(spark, sf), "id", "p", CHAINS)


D = "WITH " + bridge.PAIRS_SQL + """, halves AS (SELECT pair,
  max(score) FILTER (WHERE role = 'blunder') AS blunder, max(score) FILTER (WHERE role = 'safe')
    AS safe, max(danger) FILTER (WHERE role = 'blunder') - max(danger) FILTER (WHERE role = 'safe')
    AS gap, max(material) FILTER (WHERE role = 'blunder') AS a_mat,
  max(material) FILTER (WHERE role = 'safe') AS b_mat,
  max(mobility) FILTER (WHERE role = 'blunder') AS a_mob,
  max(mobility) FILTER (WHERE role = 'safe') AS b_mob, count(*) AS n
  FROM danger_pairs GROUP BY pair)"""


@query(
    "d9_pair_margins",
    D + f""" SELECT pair, {R("blunder")} AS blunder, {R("safe")} AS safe, {R("safe - blunder")}
      AS margin, coalesce(safe > blunder, false) AS passed, n = 2 AS complete FROM halves""",
)
def pair_margins(spark, sf):
    out = reconcile.pair_margins(bridge.danger_pairs(spark, sf), "id", "score")
    return rounded(out, ("blunder", "safe", "margin"))


@query(
    "d10_pair_certification",
    D + f""" SELECT pair, {R("gap")} AS danger_margin, coalesce(gap >= 0.2::DOUBLE, false)
      AS certified FROM halves""",
)
def pair_certification(spark, sf):
    out = reconcile.certify_pairs(bridge.danger_pairs(spark, sf), "id", "danger")
    return rounded(out, ("danger_margin",))


@query(
    "d11_visible_differences",
    D + f""" SELECT pair AS base, 'material' AS feature, {R("a_mat")} AS a, {R("b_mat")} AS b FROM halves
      WHERE n = 2 AND a_mat <> b_mat
    UNION ALL SELECT pair, 'mobility', {R("a_mob")}, {R("b_mob")} FROM halves
      WHERE n = 2 AND a_mob <> b_mob""",
)
def visible_differences(spark, sf):
    rows = bridge.danger_pairs(spark, sf)
    out = reconcile.visible_differences(
        rows,
        F.regexp_replace("id", "-(blunder|safe)$", ""),
        F.col("id").endswith("-safe"),
        ["material", "mobility"],
    )
    return rounded(out, ("a", "b"))


@query(
    "d12_coverage",
    """WITH m AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 89 <> 1),
      e AS (SELECT o_orderkey + CASE WHEN o_orderkey % 97 = 2 THEN 1000000000 ELSE 0 END AS k,
        CASE WHEN o_orderkey % 83 = 3 THEN 'X' ELSE o_orderstatus END AS s FROM orders)
    SELECT count(*) FILTER (WHERE m.k IS NOT NULL AND e.k IS NOT NULL)::BIGINT AS shared,
      count(*) FILTER (WHERE e.k IS NULL)::BIGINT AS missing,
      count(*) FILTER (WHERE m.k IS NULL)::BIGINT AS extra, 0::BIGINT AS repeated,
      count(*) FILTER (WHERE m.k IS NOT NULL AND e.k IS NOT NULL AND m.s <> e.s)::BIGINT
        AS mismatch_s FROM m FULL JOIN e ON m.k = e.k""",
)
def coverage(spark, sf):
    k = F.col("o_orderkey")
    orders = bridge.read(spark, sf, "orders")
    measured = orders.where(k % 89 != 1).select(k.alias("k"), F.col("o_orderstatus").alias("s"))
    expected = orders.select(
        (k + F.when(k % 97 == 2, 1000000000).otherwise(0)).alias("k"),
        F.when(k % 83 == 3, "X").otherwise(F.col("o_orderstatus")).alias("s"),
    )
    return reconcile.coverage(measured, expected, ["k"], ["s"])


@query(
    "d14_prediction_parity",
    "WITH " + bridge.PREDICTIONS_SQL + f""", c AS (SELECT
      count(*) FILTER (WHERE a.row_id IS NOT NULL AND b.row_id IS NOT NULL)::BIGINT AS shared,
      count(*) FILTER (WHERE b.row_id IS NULL)::BIGINT AS missing,
      count(*) FILTER (WHERE a.row_id IS NULL)::BIGINT AS extra,
      count(*) FILTER (WHERE a.row_id IS NOT NULL AND b.row_id IS NOT NULL
        AND (a.p IS NULL OR b.p IS NULL))::BIGINT AS null_answers,
      count(*) FILTER (WHERE abs(a.p - b.p) > 1e-6)::BIGINT AS beyond_tolerance,
      max(abs(a.p - b.p)) AS worst FROM run_a a FULL JOIN run_b b USING (row_id)), again AS (
      SELECT count(*)::BIGINT AS repeated FROM run_a WHERE row_id % 151 = 9)
    SELECT shared, missing, extra, repeated, null_answers, beyond_tolerance, {R("worst")} AS max_abs_error,
      missing + extra + repeated + null_answers = 0 AND worst <= 1e-6 AS passed FROM c, again""",
)
def prediction_parity(spark, sf):
    """Some answers of the first run are written twice; they must be counted."""
    left, right = bridge.predictions(spark, sf)
    left = left.unionByName(left.where(F.col("row_id") % 151 == 9))
    return rounded(
        reconcile.prediction_parity(left, right, "row_id", "p"), ("max_abs_error",)
    )


def stored_candidates(spark, sf):
    """Stored candidates with planted drift, and the expected table they are checked against."""
    k = F.col("row_id")
    base = bridge.after_states(spark, sf).select(
        "row_id",
        F.col("game_id").alias("group_id"),
        F.col("row_id").alias("cand"),
        F.col("fen").alias("result_fen"),
        "side",
        F.array((k % 7).cast("double"), (k % 11).cast("double")).alias("features"),
        fx.is_terminal("fen", "side").alias("terminal"),
    )
    expected = base.where(k % 103 != 1)
    stored = base.where(k % 107 != 2).select(
        "row_id",
        "group_id",
        "cand",
        F.when(k % 109 == 3, F.concat("result_fen", F.lit("?")))
        .otherwise(F.col("result_fen"))
        .alias("result_fen"),
        F.when(k % 113 == 4, "x").otherwise(F.col("side")).alias("side"),
        F.when(k % 127 == 5, F.transform("features", lambda v: v + 0.00001))
        .when(k % 131 == 6, F.transform("features", lambda v: v + 0.0000001))
        .otherwise(F.col("features"))
        .alias("features"),
        F.when(k % 137 == 7, ~F.col("terminal")).otherwise(F.col("terminal")).alias("terminal"),
    )
    return stored, expected


BOTH = "row_id % 103 <> 1 AND row_id % 107 <> 2"


@query(
    "d16_stored_against_expected",
    P + f""" SELECT count(*) FILTER (WHERE row_id % 107 <> 2)::BIGINT AS stored,
      count(*) FILTER (WHERE row_id % 107 = 2 AND row_id % 103 <> 1)::BIGINT AS missing,
      count(*) FILTER (WHERE row_id % 103 = 1 AND row_id % 107 <> 2)::BIGINT AS extra,
      count(*) FILTER (WHERE row_id % 107 <> 2 AND row_id % 139 = 8)::BIGINT AS repeated,
      count(*) FILTER (WHERE {BOTH} AND row_id % 109 = 3)::BIGINT AS result_mismatches,
      count(*) FILTER (WHERE {BOTH} AND row_id % 113 = 4)::BIGINT AS side_mismatches,
      count(*) FILTER (WHERE {BOTH} AND row_id % 127 = 5)::BIGINT AS feature_mismatches,
      count(*) FILTER (WHERE {BOTH} AND row_id % 7 = 0)::BIGINT AS terminal_candidates,
      count(*) FILTER (WHERE {BOTH} AND row_id % 137 = 7)::BIGINT AS terminal_mismatches
    FROM positions""",
)
def stored_against_expected(spark, sf):
    """Some stored candidates are written twice."""
    stored, expected = stored_candidates(spark, sf)
    stored = stored.unionByName(stored.where(F.col("row_id") % 139 == 8))
    return reconcile.stored_against_expected(stored, expected, ["group_id", "cand"])


@query(
    "d17_paired_rows",
    "WITH " + bridge.PREDICTIONS_SQL + f""" SELECT row_id, {R("a.p")} AS candidate,
      {R("b.p")} AS reference FROM run_a a JOIN run_b b USING (row_id)""",
)
def paired_rows(spark, sf):
    left, right = bridge.predictions(spark, sf)
    joined = left.select("row_id", F.col("p").alias("candidate")).join(
        right.select("row_id", F.col("p").alias("reference")), "row_id"
    )
    return rounded(joined, ("candidate", "reference"))


@query(
    "d18_golden_mismatches",
    """SELECT count(*)::BIGINT AS matched, count(*) FILTER (WHERE vec_id % 41 = 3)::BIGINT
      AS mismatched FROM embeddings WHERE vec_id % 13 <> 5""",
)
def golden_mismatches(spark, sf):
    k = F.col("vec_id")
    rows = bridge.read(spark, sf, "embeddings").select("vec_id", "embedding")
    golden = rows.where(k % 13 != 5).select(
        "vec_id",
        F.when(k % 41 == 3, F.transform("embedding", lambda v: (v + 0.001).cast("float")))
        .otherwise(F.col("embedding"))
        .alias("embedding"),
    )
    return reconcile.golden_mismatches(rows, golden, "vec_id", "embedding")


@query(
    "d19_twin_safety",
    T + f""", h AS (SELECT base, count(*) AS n, max(f0) FILTER (WHERE half = '') AS a0,
      max(f0) FILTER (WHERE half <> '') AS b0, max(f1) FILTER (WHERE half = '') AS a1,
      max(f1) FILTER (WHERE half <> '') AS b1, max(f2) FILTER (WHERE half = '') AS a2,
      max(f2) FILTER (WHERE half <> '') AS b2,
      abs(max(p) FILTER (WHERE half = '') - max(p) FILTER (WHERE half <> '')) AS gap
      FROM twin_probes GROUP BY base)
    SELECT base, a0 = b0 AND a1 = b1 AND a2 = b2 AS same_features, a1 > 0 AS signal,
      {R("gap")} AS difference, a0 = b0 AND a1 = b1 AND a2 = b2 AND a1 > 0 AND gap <= 1e-6 AS passed
    FROM h WHERE n = 2""",
)
def twin_safety(spark, sf):
    rows = bridge.twin_probes(spark, sf)
    out = reconcile.twin_safety(
        rows,
        F.regexp_replace("id", "-twin$", ""),
        F.col("id").endswith("-twin"),
        "features",
        "p",
        [1],
        1e-6,
        True,
    )
    return rounded(out, ("difference",))


STATES = """WITH states AS (SELECT l_suppkey AS g, l_partkey % 50 AS narrow, l_partkey AS full_key
    FROM lineitem), found AS (SELECT g, narrow, count(DISTINCT full_key)::BIGINT AS states,
    min(full_key) AS first_full, max(full_key) AS last_full FROM states GROUP BY ALL
    HAVING count(DISTINCT full_key) > 1)"""


def found_collisions(spark, sf):
    rows = bridge.read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("g"),
        (F.col("l_partkey") % 50).alias("narrow"),
        F.col("l_partkey").alias("full_key"),
    )
    return reconcile.collisions(rows, "g", "narrow", "full_key")


@query("e24_collisions", STATES + " SELECT * FROM found")
def collisions(spark, sf):
    return found_collisions(spark, sf)


@query(
    "e24_collision_counts",
    STATES + " SELECT count(*)::BIGINT AS collision_keys, sum(states - 1)::BIGINT AS lost_states "
    "FROM found",
)
def collision_counts(spark, sf):
    return reconcile.collision_counts(found_collisions(spark, sf))


@query("g4_witnesses", STATES + " SELECT * FROM found ORDER BY g, narrow LIMIT 8")
def witnesses(spark, sf):
    return reconcile.witnesses(found_collisions(spark, sf), ["g", "narrow"])

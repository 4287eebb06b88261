"""B: projections, filters and validation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import fen as fx
from evalspark.functions import scoring as sx
from evalspark.functions.scoring import r6
from evalspark.operators import keys, ranking, scoring, validation
from evalspark.plans.expressions import FEATURED, KEY, P
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R
from evalspark.sources import readers, schemas, writers


def counted(source: str, key: str, rules: dict[str, str]) -> str:
    """SQL of a violations table: one row per rule with its count and smallest key."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE coalesce({bad}, true))::BIGINT AS n, "
        f"min(CASE WHEN coalesce({bad}, true) THEN ({key})::VARCHAR END) AS sample_key "
        f"FROM {source}"
        for name, bad in rules.items()
    )


@query(
    "b1_convert_export",
    P + f""" SELECT row_id, ply, upper(dice) AS dice,
      {R("CASE WHEN side = 'b' THEN 1 - (white_result + 1) / 2.0 ELSE (white_result + 1) / 2.0 END")}
      AS result FROM positions""",
)
def convert_export(spark, sf):
    rows = bridge.positions(spark, sf)
    export = rows.select(
        "row_id",
        "game_id",
        F.col("ply").alias("turn_number"),
        "fen",
        "dice",
        "side",
        F.col("white_result").alias("result"),
    )
    converted = readers.to_positions(export.drop("row_id"))
    return converted.select(
        (F.substring("game_id", 2, 20).cast("long") * bridge.PLIES + F.col("ply")).alias("row_id"),
        "ply",
        "dice",
        r6(F.col("result")).alias("result"),
    )


ROLL_OK = "regexp_full_match(upper(dice), '[PNBRQK]{3}')"


@query(
    "b2_dice_rule",
    "WITH " + bridge.SPOILED_SQL
    + f" SELECT {ROLL_OK} AS valid, count(*)::BIGINT AS rows FROM spoiled GROUP BY 1",
)
def dice_rule(spark, sf):
    return (
        bridge.spoiled_positions(spark, sf)
        .groupBy(fx.valid_dice("dice").alias("valid"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "b3_canonical_roll",
    P + f" SELECT {bridge.ROLL_SQL.format('dice')} AS roll, count(*)::BIGINT AS rows, "
    "count(DISTINCT dice)::BIGINT AS spellings FROM positions GROUP BY 1",
)
def canonical_roll(spark, sf):
    spelled = bridge.positions(spark, sf).groupBy(
        fx.canonical_dice("dice").alias("roll"), "dice"
    ).agg(F.count(F.lit(1)).alias("n"))
    return spelled.groupBy("roll").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("spellings")
    )


FRAME_RULES = {f"null_{c}": f"{c} IS NULL" for c in schemas.POSITION_COLUMNS} | {
    "blank_fen": "trim(fen) = ''",
    "negative_ply": "ply < 0",
    "side_domain": "side NOT IN ('w','b')",
    "result_domain": "result NOT IN (0.0, 0.5, 1.0)",
    "dice": f"NOT {ROLL_OK}",
}


@query("b4_frame_rules", "WITH " + bridge.SPOILED_SQL + counted("spoiled", "row_id", FRAME_RULES))
def frame_rules(spark, sf):
    return validation.violations(
        bridge.spoiled_positions(spark, sf), validation.position_rules(), "row_id"
    )


@query("b5_metadata_rules")
def metadata_rules(spark, sf):
    """Footer identity of freshly written shards: Spark's own key matches, a foreign one fails."""
    from evalspark.session import scratch_path

    path = scratch_path(spark, "shards")
    bridge.positions(spark, sf).select(*schemas.POSITION_COLUMNS).write.parquet(path)
    expected = {
        "org.apache.spark.version": spark.version,
        "engine_version": "0.9.3",
    }
    report = readers.metadata_violations(spark, expected, path)
    return report.select("rule", (F.col("n") > 0).alias("broken"))


@query(
    "b6_feature_layout",
    FEATURED + """, holed AS (SELECT row_id,
      CASE WHEN row_id % 97 = 1 THEN NULL ELSE mobility_diff END AS mobility_diff,
      CASE WHEN row_id % 89 = 2 THEN 'nan'::DOUBLE WHEN row_id % 83 = 3 THEN 'inf'::DOUBLE
        ELSE king_safety_diff END AS king_safety_diff, p_diff FROM featured) """
    + counted(
        "holed",
        "row_id",
        {
            f"not_finite_{c}": f"NOT isfinite({c})"
            for c in ("mobility_diff", "king_safety_diff", "p_diff")
        },
    ),
)
def feature_layout(spark, sf):
    rows = bridge.feature_columns(bridge.positions(spark, sf))
    validation.require_layout(rows.select(*schemas.POSITION_COLUMNS, *schemas.S0), schemas.S0)
    k = F.col("row_id")
    holed = rows.withColumn(
        "mobility_diff", F.when(k % 97 == 1, None).otherwise(F.col("mobility_diff"))
    ).withColumn(
        "king_safety_diff",
        F.when(k % 89 == 2, float("nan"))
        .when(k % 83 == 3, float("inf"))
        .otherwise(F.col("king_safety_diff")),
    )
    return validation.violations(
        holed, validation.feature_rules(("mobility_diff", "king_safety_diff", "p_diff")), "row_id"
    )


BUNDLE = FEATURED + """, bundle AS (
  SELECT row_id, CASE WHEN row_id % 101 = 1 THEN ' ' ELSE game_id || ':' || ply::VARCHAR END AS id,
    game_id AS group_id, game_id,
    CASE WHEN row_id % 107 = 2 THEN fen || ' 9 9 9' ELSE fen END AS fen,
    CASE WHEN row_id % 109 = 3 THEN (CASE side WHEN 'w' THEN 'b' ELSE 'w' END) ELSE side END AS side,
    CASE WHEN row_id % 113 = 4 THEN NULL ELSE ply END AS ply,
    CASE WHEN row_id % 127 = 5 THEN 2.0 ELSE result END AS result,
    CASE WHEN row_id % 131 = 6 AND row_id % 107 <> 2 THEN replace(board, 'k', 'KK') ELSE board END
      AS board, row_id % 131 = 6 AND row_id % 107 <> 2 AS broken, row_id % 137 = 7 AS shifted, row_id % 139 = 8 AS short
  FROM featured)"""


def spoiled_bundle(spark, sf):
    k = F.col("row_id")
    rows = bridge.feature_columns(bridge.positions(spark, sf))
    features = F.array(*[F.col(c) for c in schemas.S0])
    parts = F.split("fen", " ", 2)
    fen = F.when(k % 107 == 2, F.concat("fen", F.lit(" 9 9 9"))).when(
        k % 131 == 6,
        F.concat_ws(" ", F.replace(F.get(parts, 0), F.lit("k"), F.lit("KK")), F.get(parts, 1)),
    ).otherwise(F.col("fen"))
    shifted = F.concat(
        F.array((F.get(features, 0) + 0.5).cast("float")), F.slice(features, 2, 12)
    )
    return rows.select(
        "row_id",
        F.when(k % 101 == 1, " ").otherwise(
            F.concat_ws(":", "game_id", F.col("ply").cast("string"))
        ).alias("id"),
        F.col("game_id").alias("group_id"),
        "game_id",
        fen.alias("fen"),
        F.when(k % 109 == 3, F.when(F.col("side") == "w", "b").otherwise("w"))
        .otherwise(F.col("side"))
        .alias("side"),
        F.when(k % 113 == 4, None).otherwise(F.col("ply")).alias("ply"),
        F.when(k % 127 == 5, 2.0).otherwise(F.col("result").cast("double")).alias("result"),
        F.when(k % 139 == 8, F.slice(features, 1, 12))
        .when(k % 137 == 7, shifted)
        .otherwise(features)
        .alias("features"),
    )


BUNDLE_RULES = {
    "blank_id": "trim(id) = ''",
    "blank_group_id": "trim(group_id) = ''",
    "blank_game_id": "trim(game_id) = ''",
    "fen_fields": "len(string_split(fen, ' ')) NOT IN (4, 6)",
    "fen_side": "split_part(fen, ' ', 2) <> side",
    "ply": "ply IS NULL OR ply < 0",
    "result": "result NOT IN (0.0, 0.5, 1.0)",
    "kings": "length(replace(board,'K','')) <> length(board) - 1 "
    "OR length(replace(board,'k','')) <> length(board) - 1",
    "placement": "broken",
    "features": "short",
    "material": "shifted AND NOT short OR row_id % 109 = 3 AND "
    "(p_diff <> 0 OR n_diff <> 0 OR b_diff <> 0 OR r_diff <> 0 OR q_diff <> 0)",
}


@query(
    "b7_bundle_rules",
    BUNDLE.replace("row_id, CASE", "p_diff, n_diff, b_diff, r_diff, q_diff, row_id, CASE", 1)
    + counted("bundle", "row_id", BUNDLE_RULES),
)
def bundle_rules(spark, sf):
    return validation.violations(spoiled_bundle(spark, sf), validation.bundle_rules(), "row_id")


@query(
    "b8_format_bundle",
    FEATURED + " SELECT game_id || ':' || ply::VARCHAR AS id, game_id AS group_id, fen, side, ply, "
    + "result, "
    + ", ".join(f"{R(c)} AS f{i}" for i, c in enumerate(schemas.S0))
    + " FROM featured",
)
def format_bundle(spark, sf):
    rows = writers.bundle_rows(bridge.feature_columns(bridge.positions(spark, sf)))
    return rows.select(
        "id",
        "group_id",
        "fen",
        "side",
        "ply",
        "result",
        *[r6(F.get("features", i)).alias(f"f{i}") for i in range(13)],
    )


SPLIT_ROWS = "WITH " + bridge.SCORED_SQL


@query(
    "b9_decisive_filter",
    SPLIT_ROWS + " SELECT row_id, game_id, y FROM scored WHERE y IN (0, 1)",
)
def decisive_filter(spark, sf):
    return scoring.decisive(bridge.scored(spark, sf), "y").select("row_id", "game_id", "y")


@query(
    "b10_partition_filter",
    SPLIT_ROWS + " SELECT row_id, game_id FROM scored WHERE split = 'validation'",
)
def partition_filter(spark, sf):
    return scoring.partition(bridge.scored(spark, sf), "validation").select("row_id", "game_id")


FIRST_GAMES = 100


@query(
    "b11_first_games",
    f""" WITH firsts AS (SELECT o_custkey, min(o_orderkey) AS first FROM orders GROUP BY 1
      ORDER BY first LIMIT {FIRST_GAMES})
    SELECT o_custkey, count(*)::BIGINT AS rows FROM orders SEMI JOIN firsts USING (o_custkey)
    GROUP BY 1""",
)
def first_games(spark, sf):
    rows = bridge.read(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return (
        keys.first_games(rows, "o_custkey", "o_orderkey", FIRST_GAMES)
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


GROUP_RULES = {
    "game": "row_id % 73 = 4",
    "dice": "row_id % 79 = 5",
    "side": "row_id % 83 = 6",
    "root_side": "row_id % 83 = 6",
    "group_id": "row_id % 71 = 3 OR row_id % 79 = 5",
    "no_candidates": "row_id % 89 = 7",
    "moves": "row_id % 59 = 8 AND row_id % 89 <> 7",
    "result_fen": "row_id % 53 = 9 AND row_id % 89 <> 7",
    # A blank first result no longer repeats the others.
    "repeated_result": "row_id % 61 = 1 AND row_id % 89 <> 7"
    " AND row_id % 4 > CASE WHEN row_id % 53 = 9 THEN 1 ELSE 0 END",
    "features": "row_id % 67 = 2 AND row_id % 89 <> 7",
    "target": "row_id % 47 = 10 AND row_id % 89 <> 7",
}


@query("b12_group_rules", P + counted("positions", "row_id", GROUP_RULES))
def group_rules(spark, sf):
    return validation.violations(
        bridge.nested_groups(spark, sf, spoil=True), validation.group_rules(), "row_id"
    )


@query(
    "b13_side_agreement",
    "WITH " + bridge.SPOILED_SQL
    + counted("spoiled", "row_id", {"side_mismatch": "trim(fen) = '' OR split_part(fen,' ',2) <> side"}),
)
def side_agreement(spark, sf):
    return validation.violations(
        bridge.spoiled_positions(spark, sf), validation.side_rule(), "row_id"
    )


@query(
    "b14_field_separators",
    counted(
        "documents",
        "doc_id",
        {f"separator_{c}": f"contains({c}, chr(9)) OR contains({c}, chr(10)) OR contains({c}, chr(13))"
         for c in ("text", "lang", "source")},
    ),
)
def field_separators(spark, sf):
    return validation.violations(
        bridge.read(spark, sf, "documents"),
        validation.separator_rules(("text", "lang", "source")),
        "doc_id",
    )


@query(
    "b15_producer_record",
    P + """ SELECT count(*)::BIGINT AS groups, sum(1 + row_id % 4)::BIGINT AS candidates
    FROM positions""",
)
def producer_record(spark, sf):
    """The producer writes its counts beside the lists; the lists read back must agree with them."""
    from evalspark.session import scratch_path

    path = scratch_path(spark, "producer")
    nested = bridge.nested_groups(spark, sf).drop("row_id")
    nested.write.json(f"{path}/groups")
    readers.group_counts(nested).write.json(f"{path}/record")
    declared = spark.read.json(f"{path}/record").first().asDict()
    stored = readers.admit_groups(readers.groups(spark, f"{path}/groups"), declared)
    return readers.group_counts(stored)


def sparse_rows(spark, sf):
    """Experimental rows from after-states, with planted faults."""
    k = F.col("row_id")
    c = fx.king_relative_ids("fen", "side")
    rows = bridge.after_states(spark, sf).select(
        "row_id", "game_id", c.alias("c0"), fx.is_terminal("fen", "side").alias("terminal")
    )
    a = F.transform(F.sequence(F.lit(1), F.lit(9)), lambda j: ((k * j) % 11).cast("double"))
    tail = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda j: ((k + j) % 5).cast("double"))
    lead = F.when(k % 61 == 1, F.transform(a, lambda v: v + 1)).otherwise(a)
    return rows.select(
        "row_id",
        "game_id",
        a.alias("a"),
        F.when(k % 67 == 2, F.concat(lead, F.slice(tail, 1, 3))).otherwise(
            F.concat(lead, tail)
        ).alias("b"),
        F.when(k % 71 == 3, F.array(F.reverse(F.get("c0", 0)), F.get("c0", 1)))
        .when(k % 73 == 4, F.array(F.get("c0", 0), F.get("c0", 0)))
        .otherwise(F.col("c0"))
        .alias("c"),
        F.when(
            F.col("terminal") & (k % 79 != 5), F.lit(schemas.TERMINAL_TARGET).cast("long")
        ).otherwise(k % 1000).alias("target"),
        "terminal",
    )


SPARSE = "WITH " + bridge.AFTER_SQL + """, sparse AS (
  SELECT row_id, row_id % 7 = 0 AS terminal,
    length(regexp_replace(board, '[1-8/kK]', '', 'g')) AS pieces FROM after_states) """
SPARSE_RULES = {
    "width": "row_id % 67 = 2",
    "not_finite": "false",
    "prefix": "row_id % 61 = 1",
    "ids_own": "row_id % 71 = 3 AND NOT terminal AND pieces > 1",
    "ids_other": "row_id % 73 = 4 AND row_id % 71 <> 3 AND NOT terminal AND pieces > 0",
    "target_range": "false",
    "terminal_sentinel": "row_id % 79 = 5 AND terminal",
    "terminal_ids": "false",
}


@query("b16_sparse_rules", SPARSE + counted("sparse", "row_id", SPARSE_RULES))
def sparse_rules(spark, sf):
    return validation.violations(sparse_rows(spark, sf), validation.sparse_rules(), "row_id")


@query(
    "b17_metric_inputs",
    "WITH faulty AS (SELECT event_id, CASE WHEN event_id % 97 = 1 THEN 'nan'::DOUBLE "
    "ELSE value / 480 END AS p, (event_id % 2 + CASE WHEN event_id % 89 = 2 THEN 0.5 ELSE 0 END)"
    "::DOUBLE AS y FROM events) "
    + counted(
        "faulty",
        "event_id",
        {
            "not_finite": "NOT isfinite(p)",
            "target_domain": "y NOT IN (0, 1)",
            "probability_domain": "p < 0 OR p > 1",
        },
    ),
)
def metric_inputs(spark, sf):
    k = F.col("event_id")
    rows = bridge.read(spark, sf, "events").select(
        "event_id",
        F.when(k % 97 == 1, float("nan")).otherwise(F.col("value") / 480).alias("p"),
        (k % 2 + F.when(k % 89 == 2, 0.5).otherwise(0.0)).alias("y"),
    )
    return validation.violations(rows, validation.metric_rules(), "event_id")


@query(
    "b18_list_widths",
    "WITH " + bridge.candidates_sql("l_orderkey") + """, sizes AS (
      SELECT group_id, split, count(*) AS n FROM candidates GROUP BY ALL)
    SELECT split, count(*) FILTER (WHERE n >= 2)::BIGINT AS trainable,
      count(*) FILTER (WHERE n > 4)::BIGINT AS evaluated FROM sizes GROUP BY split""",
)
def list_widths(spark, sf):
    cands = bridge.candidates(spark, sf, "l_orderkey")
    kept = ranking.trainable(cands)
    sizes = kept.groupBy("group_id", "split").agg(F.count(F.lit(1)).alias("size"))
    return sizes.groupBy("split").agg(
        F.count(F.lit(1)).alias("trainable"), F.count_if(F.col("size") > 4).alias("evaluated")
    )


@query(
    "b19_authored_probes",
    "WITH " + bridge.TWINS_SQL + " SELECT id FROM twin_probes WHERE NOT starts_with(id, 'sample-')",
)
def authored_probes(spark, sf):
    return bridge.twin_probes(spark, sf).where(~F.col("id").startswith("sample-")).select("id")


LATENCY_RULES = {
    f"not_positive_{n}": f"NOT ({n} > 0)" for n in ("min_us", "median_us", "p95_us", "max_us")
} | {"order": "NOT (min_us <= median_us AND median_us <= p95_us AND p95_us <= max_us)"}


@query(
    "b20_latency_rules",
    "WITH " + bridge.LATENCIES_SQL + counted("latencies", "probe", LATENCY_RULES),
)
def latency_rules(spark, sf):
    return validation.violations(bridge.latencies(spark, sf), validation.latency_rules(), "probe")


@query(
    "b21_probability_bounds",
    f"""WITH outputs AS (SELECT event_type AS source, CASE WHEN event_id % 4999 = 7
      AND event_type = 'error' THEN 'nan'::DOUBLE ELSE value / 490 END AS p FROM events)
    SELECT source, count(*)::BIGINT AS rows, bool_and(isfinite(p)) AS all_finite,
      bool_and(isfinite(p) AND p >= 0 AND p <= 1) AS within_unit_interval,
      {R("CASE WHEN bool_and(isfinite(p)) THEN min(p) END")} AS min,
      {R("CASE WHEN bool_and(isfinite(p)) THEN max(p) END")} AS max
    FROM outputs GROUP BY source""",
)
def probability_bounds(spark, sf):
    bad = (F.col("event_id") % 4999 == 7) & (F.col("event_type") == "error")
    rows = bridge.read(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.when(bad, float("nan")).otherwise(F.col("value") / 490).alias("p"),
    )
    out = validation.probability_bounds(rows, "source", "p")
    return out.withColumn("min", r6(F.col("min"))).withColumn("max", r6(F.col("max")))

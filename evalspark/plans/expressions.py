"""C: scalar, string and array functions, row by row over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from evalspark import bridge
from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.functions import scoring as sx
from evalspark.functions.scoring import r6
from evalspark.operators import scoring
from evalspark.plans.registry import query
from evalspark.plans.registry import r6_sql as R

P = "WITH " + bridge.POSITIONS_SQL
KEY = bridge.sql_position_key("fen")
SQUARES = "array_to_string(list_reverse(string_split({0}, '/')), '')"
for _d in range(8, 0, -1):
    SQUARES = f"replace({SQUARES}, '{_d}', '{'.' * _d}')"
TWIN_BOARD = (
    "translate(array_to_string(list_reverse(string_split({0}, '/')), '/'), "
    "'PNBRQKpnbrqk', 'pnbrqkPNBRQK')"
)
MOVER_VIEW = (
    f"CASE WHEN side = 'b' THEN {SQUARES.format(TWIN_BOARD.format('board'))} "
    f"ELSE {SQUARES.format('board')} END"
)
PLANE_INDEX = (
    "list_filter(list_transform(range(0,64), lambda i : CASE WHEN view[i+1] = '.' THEN NULL ELSE "
    "(instr('PNBRQKpnbrqk', view[i+1]) - 1) * 64 + i END), lambda x : x IS NOT NULL)"
)


@query(
    "c1_split_bucket",
    P + f", games AS (SELECT DISTINCT game_id FROM positions) SELECT game_id, "
    f"{bridge.sql_bucket('game_id')}::BIGINT AS bucket, "
    f"{bridge.sql_split(bridge.sql_bucket('game_id'))} AS split FROM games",
)
def split_bucket(spark, sf):
    games = bridge.positions(spark, sf).select("game_id").distinct()
    return games.select(
        "game_id",
        hashing.split_bucket("game_id").alias("bucket"),
        hashing.split_for("game_id").alias("split"),
    )


@query(
    "c2_inner_split",
    "WITH " + bridge.SCORED_SQL + """
    SELECT CASE WHEN bucket < 7000 THEN 'fit' WHEN bucket < 8000 THEN 'inner' ELSE 'outside' END
      AS role, count(*)::BIGINT AS rows, count(DISTINCT game_id)::BIGINT AS games
    FROM scored WHERE y IN (0, 1) GROUP BY 1""",
)
def inner_split(spark, sf):
    rows = scoring.decisive(bridge.scored(spark, sf), "y")
    per_game = rows.groupBy(
        F.coalesce(hashing.inner_role(F.col("bucket")), F.lit("outside")).alias("role"), "game_id"
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_game.groupBy("role").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("games")
    )


@query("c3_position_key", P + f" SELECT row_id, {KEY} AS key FROM positions")
def position_key(spark, sf):
    return bridge.positions(spark, sf).select("row_id", fx.position_key("fen").alias("key"))


@query(
    "c4_canonical_root",
    "WITH " + bridge.SPOILED_SQL + f""", keyed AS (
      SELECT row_id, CASE WHEN trim(fen) = '' THEN NULL ELSE {KEY} END AS canonical,
        CASE WHEN regexp_full_match(upper(dice), '[PNBRQK]{{3}}')
          THEN {bridge.ROLL_SQL.format('dice')} END AS roll
      FROM spoiled)
    SELECT canonical, roll, count(*)::BIGINT AS rows FROM keyed GROUP BY ALL""",
)
def canonical_root(spark, sf):
    return (
        bridge.spoiled_positions(spark, sf)
        .select(
            fx.position_key("fen").alias("canonical"), fx.canonical_dice("dice").alias("roll")
        )
        .groupBy("canonical", "roll")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query("c5_group_id", P + f" SELECT row_id, {bridge.GROUP_ID_SQL} AS group_id FROM positions")
def group_id(spark, sf):
    return bridge.positions(spark, sf).select(
        "row_id",
        hashing.group_id_for(fx.position_key("fen"), fx.canonical_dice("dice")).alias("group_id"),
    )


@query(
    "c6_order_key",
    P + f" SELECT row_id, sha256('prerank-roots-v1:' || {KEY} || '|' || "
    f"{bridge.ROLL_SQL.format('dice')}) AS order_key FROM positions",
)
def order_key(spark, sf):
    return bridge.positions(spark, sf).select(
        "row_id",
        hashing.order_key(fx.position_key("fen"), fx.canonical_dice("dice")).alias("order_key"),
    )


BLOCK = ("p_diff", "n_diff", "b_diff", "r_diff", "q_diff", "material_diff", "total_material")


@query("c7_material_block", P + f" SELECT row_id, {bridge.features_sql(BLOCK)} FROM positions")
def material_block(spark, sf):
    rows = bridge.positions(spark, sf).select(
        "row_id", fx.material_block("fen", "side").alias("m")
    )
    return rows.select(
        "row_id", *[F.get("m", i).cast("double").alias(n) for i, n in enumerate(BLOCK)]
    )


@query(
    "c8_twin_fen",
    P + f""" SELECT row_id, {TWIN_BOARD.format('board')} || ' '
      || CASE side WHEN 'w' THEN 'b' ELSE 'w' END || ' '
      || CASE split_part(fen,' ',3) WHEN '-' THEN '-' ELSE array_to_string(list_sort(string_split(
           translate(split_part(fen,' ',3), 'KQkq', 'kqKQ'), '')), '') END || ' '
      || CASE split_part(fen,' ',4) WHEN '-' THEN '-' ELSE substr(split_part(fen,' ',4),1,1)
           || (9 - substr(split_part(fen,' ',4),2,1)::INT)::VARCHAR END
      || CASE WHEN split_part(fen,' ',5) = '' THEN '' ELSE ' ' || split_part(fen,' ',5) || ' '
           || split_part(fen,' ',6) END AS twin
    FROM positions""",
)
def twin_fen(spark, sf):
    return bridge.positions(spark, sf).select("row_id", fx.twin_fen("fen").alias("twin"))


@query(
    "c9_placement_planes",
    P + f""", views AS (SELECT row_id, {SQUARES.format('board')} AS view FROM positions),
    hot AS (SELECT row_id, {PLANE_INDEX} AS idx FROM views)
    SELECT row_id, len(idx)::BIGINT AS pieces, list_sum(idx)::BIGINT AS index_sum,
      768::BIGINT AS cells FROM hot""",
)
def placement_planes(spark, sf):
    planes = bridge.positions(spark, sf).select("row_id", fx.placement_planes("fen").alias("x"))
    return _plane_summary(planes)


def _plane_summary(planes):
    ones = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    weighted = F.aggregate(
        F.transform("x", lambda v, i: v * i), F.lit(0.0), lambda a, v: a + v
    )
    return planes.select(
        "row_id",
        ones.cast("long").alias("pieces"),
        weighted.cast("long").alias("index_sum"),
        F.size("x").cast("long").alias("cells"),
    )


@query(
    "c10_mover_perspective",
    P + f""", views AS (SELECT row_id, {MOVER_VIEW} AS view FROM positions)
    SELECT row_id, view, array_to_string({PLANE_INDEX}, ',') AS planes FROM (
      SELECT row_id, view FROM views)""".replace(
        f"array_to_string({PLANE_INDEX}, ',')",
        f"array_to_string(list_sort({PLANE_INDEX}), ',')",
    ),
)
def mover_perspective(spark, sf):
    return bridge.positions(spark, sf).select(
        "row_id",
        fx.mover_squares("fen", "side").alias("view"),
        F.array_join(fx.active_indices("fen", "dice", "side").cast("array<string>"), ",").alias(
            "planes"
        ),
    )


FACES = ", ".join(
    R(f"(length(dice) - length(replace(upper(dice), '{p}', ''))) / 3.0") + f" AS share_{p.lower()}"
    for p in fx.PIECES
)


@query("c11_dice_encoding", P + f" SELECT row_id, {FACES} FROM positions")
def dice_encoding(spark, sf):
    rows = bridge.positions(spark, sf).select("row_id", fx.dice_fractions("dice").alias("d"))
    return rows.select(
        "row_id", *[r6(F.get("d", i)).alias(f"share_{p.lower()}") for i, p in enumerate(fx.PIECES)]
    )


@query(
    "c12_encode_position",
    P + f""", views AS (SELECT row_id, dice, {MOVER_VIEW} AS view FROM positions),
    hot AS (SELECT row_id, dice, {PLANE_INDEX} AS idx FROM views)
    SELECT row_id, 774::BIGINT AS width, len(idx)::BIGINT AS pieces,
      array_to_string(list_sort(idx), ',') AS board, {FACES} FROM hot""",
)
def encode_position(spark, sf):
    rows = bridge.positions(spark, sf).select(
        "row_id", fx.encode_position("fen", "dice", "side").alias("v")
    )
    dice = [F.get("v", fx.BOARD_DIM + i) for i in range(fx.DICE_DIM)]
    # All 774 values: the board holds zeros and ones only, so its ones, by place, say it all.
    places = F.transform(F.slice("v", 1, fx.BOARD_DIM), lambda v, i: F.when(v == 1, i).when(v != 0, -1))
    ones = F.filter(places, lambda i: i.isNotNull())
    return rows.select(
        "row_id",
        F.size("v").cast("long").alias("width"),
        F.size(ones).cast("long").alias("pieces"),
        F.concat_ws(",", ones.cast("array<string>")).alias("board"),
        *[r6(d.cast("double")).alias(f"share_{p.lower()}") for d, p in zip(dice, fx.PIECES)],
    )


SLICE_CASES = """
  list_filter([
    CASE WHEN ply <= 10 THEN 'phase:opening' WHEN total_material <= 20 THEN 'phase:endgame'
      ELSE 'phase:middlegame' END,
    'side:' || side,
    CASE WHEN material_diff > 1 THEN 'material:ahead' WHEN material_diff < -1
      THEN 'material:behind' ELSE 'material:balanced' END,
    'target:decisive',
    CASE WHEN king_capture_attack > 0 THEN 'tactical:king_attack' END,
    CASE WHEN king_capture_danger > 0 THEN 'tactical:king_danger' END,
    CASE WHEN queen_capture_attack > 0 THEN 'tactical:queen_attack' END,
    CASE WHEN queen_capture_danger > 0 THEN 'tactical:queen_danger' END
  ], lambda x : x IS NOT NULL)"""
FEATURED = P + f", featured AS (SELECT *, {bridge.features_sql()} FROM positions)"


@query(
    "c13_slice_names",
    FEATURED + f""" SELECT slice, count(*)::BIGINT AS rows FROM (
      SELECT unnest({SLICE_CASES}) AS slice FROM featured) GROUP BY slice""",
)
def slice_names(spark, sf):
    rows = bridge.feature_columns(bridge.positions(spark, sf))
    return (
        rows.select(F.explode(scoring.slice_names()).alias("slice"))
        .groupBy("slice")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "c15_pad_fen",
    P + " SELECT row_id, CASE WHEN split_part(fen,' ',5) = '' THEN fen || ' 0 1' ELSE fen END "
    "AS padded FROM positions",
)
def pad_fen(spark, sf):
    return bridge.positions(spark, sf).select("row_id", fx.pad_fen("fen").alias("padded"))


S = "WITH " + bridge.SCORED_SQL
CLIP = "least(greatest(p, 1e-15::DOUBLE), (1 - 1e-15::DOUBLE))"
LL_SQL = f"(-y * ln({CLIP}) - (1 - y) * ln(1 - {CLIP}))"


@query(
    "c16_row_losses",
    S + f" SELECT row_id, {R(LL_SQL)} AS log_loss, {R('(p - y) * (p - y)')} AS brier "
    "FROM scored WHERE y IN (0, 1)",
)
def row_losses(spark, sf):
    rows = scoring.decisive(bridge.scored(spark, sf), "y")
    y, p = F.col("y"), F.col("p")
    return rows.select(
        "row_id", r6(sx.log_loss(y, p)).alias("log_loss"), r6(sx.brier(y, p)).alias("brier")
    )


@query(
    "c17_tempered_sigmoid",
    S + f""" SELECT row_id, {R('1 / (1 + exp(-z / 1.5))')} AS tempered,
      {R('least(greatest(z, 0.0), 1.0)')} AS clamped FROM scored""",
)
def tempered_sigmoid(spark, sf):
    return bridge.scored(spark, sf).select(
        "row_id",
        r6(sx.tempered_sigmoid(F.col("z"), 1.5)).alias("tempered"),
        r6(sx.unit_clamp(F.col("z"))).alias("clamped"),
    )


A = "WITH " + bridge.AFTER_SQL
SPARSE_IDS = (
    "list_sort(list_filter(list_transform(range(0,64), lambda i : CASE WHEN "
    "instr('PNBRQpnbrq', view[i+1]) = 0 THEN NULL ELSE ((({1} * 16 + (({0} % 8) // 2) + 4 * "
    "(({0} // 8) // 2)) * 10 + instr('PNBRQpnbrq', view[i+1]) - 1) * 64 + i) END), "
    "lambda x : x IS NOT NULL))"
)


@query(
    "c18_king_relative_ids",
    A + f""", views AS (
      SELECT row_id, CASE WHEN side = 'w' THEN instr(board, 'k') = 0 ELSE instr(board, 'K') = 0 END
        AS terminal, {MOVER_VIEW} AS view FROM after_states
    ), kings AS (SELECT *, instr(view, 'K') - 1 AS own, instr(view, 'k') - 1 AS other FROM views)
    SELECT row_id, CASE WHEN terminal THEN '' ELSE
        array_to_string({SPARSE_IDS.format('own', 0)}, ',') END AS own_ids,
      CASE WHEN terminal THEN '' ELSE array_to_string({SPARSE_IDS.format('other', 1)}, ',') END
        AS other_ids FROM kings""",
)
def king_relative_ids(spark, sf):
    rows = bridge.after_states(spark, sf).select(
        "row_id", fx.king_relative_ids("fen", "side").alias("c")
    )
    return rows.select(
        "row_id",
        F.array_join(F.get("c", 0).cast("array<string>"), ",").alias("own_ids"),
        F.array_join(F.get("c", 1).cast("array<string>"), ",").alias("other_ids"),
    )


@query(
    "c19_terminal_test",
    A + """ SELECT row_id, CASE WHEN side = 'w' THEN instr(board, 'k') = 0
      ELSE instr(board, 'K') = 0 END AS terminal FROM after_states""",
)
def terminal_test(spark, sf):
    return bridge.after_states(spark, sf).select(
        "row_id", fx.is_terminal("fen", "side").alias("terminal")
    )


@query("c20_state_fingerprint", A + f" SELECT row_id, sha256({KEY}) AS sha FROM after_states")
def state_fingerprint(spark, sf):
    return bridge.after_states(spark, sf).select("row_id", fx.state_fingerprint("fen").alias("sha"))


@query(
    "c22_path_string",
    P + """ SELECT row_id, i AS cand, 'm' || i::VARCHAR || ' r' || (row_id % 9)::VARCHAR AS path
      FROM (SELECT row_id, unnest(range(1, 2 + row_id % 4))::INTEGER AS i FROM positions)""",
)
def path_string(spark, sf):
    return bridge.nested_groups(spark, sf).select(
        "row_id", F.posexplode("candidates").alias("pos", "c")
    ).select(
        "row_id", (F.col("pos") + 1).alias("cand"), F.array_join("c.moves", " ").alias("path")
    )


@query(
    "c23_gain_and_discount",
    "WITH " + bridge.CANDIDATES_SQL + f"""
    SELECT cand_idx, {R("1.0 / (p * p)")} AS gain, {R("1 / log2(p + 1)")} AS discount FROM (
      SELECT cand_idx, (cand_idx % 50 + 1)::DOUBLE AS p FROM candidates)""",
)
def gain_and_discount(spark, sf):
    place = (F.col("cand_idx") % 50 + 1).cast("double")
    return bridge.candidates(spark, sf).select(
        "cand_idx",
        r6(sx.inverse_square_gain(place)).alias("gain"),
        r6(sx.rank_discount(place)).alias("discount"),
    )


@query(
    "c24_relative_overhead",
    "WITH " + bridge.LATENCIES_SQL + f"""
    SELECT probe, schema, {R("(a.median_us - b.median_us) / b.median_us")} AS overhead
    FROM latencies a JOIN (SELECT probe, median_us FROM latencies WHERE schema = 'S0') b
      USING (probe) WHERE schema <> 'S0'""",
)
def relative_overhead(spark, sf):
    from evalspark.operators import summaries

    out = summaries.extraction_overhead(bridge.latencies(spark, sf), "S0")
    return out.select("probe", "schema", r6(F.col("overhead")).alias("overhead"))

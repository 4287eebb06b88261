"""Table layouts. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and domains of the data contract.
POSITION_COLUMNS = ("game_id", "ply", "fen", "dice", "side", "result")
EXPORT_COLUMNS = ("game_id", "turn_number", "fen", "dice", "side", "result")
RESULTS = (0.0, 0.5, 1.0)
SIDES = ("w", "b")
WHITE_RESULTS = (-1, 0, 1)
S0 = (
    "p_diff",
    "n_diff",
    "b_diff",
    "r_diff",
    "q_diff",
    "material_diff",
    "total_material",
    "mobility_diff",
    "king_safety_diff",
    "king_capture_attack",
    "king_capture_danger",
    "queen_capture_attack",
    "queen_capture_danger",
)
MOBILITY = (
    "own_moves_p",
    "own_moves_n",
    "own_moves_b",
    "own_moves_r",
    "own_moves_q",
    "own_moves_k",
    "opp_moves_p",
    "opp_moves_n",
    "opp_moves_b",
    "opp_moves_r",
    "opp_moves_q",
    "opp_moves_k",
    "own_pdi",
    "opp_pdi",
)
PAWNS = (
    "own_passed_pawns",
    "opp_passed_pawns",
    "own_passed_max_rank",
    "opp_passed_max_rank",
)
S1 = S0 + MOBILITY
S2 = S1 + PAWNS
FEATURE_SETS = {"S0": S0, "S1": S1, "S2": S2}
TERMINAL_TARGET = 2147483647
FROZEN_SPLITS = ("train", "early_stop", "screen")

POSITION = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("ply", T.IntegerType()),
        T.StructField("fen", T.StringType()),
        T.StructField("dice", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("result", T.FloatType()),
    ]
)
EXPORT = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("turn_number", T.IntegerType()),
        T.StructField("fen", T.StringType()),
        T.StructField("dice", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("result", T.IntegerType()),
    ]
)
ROWS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("group_id", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("root_id", T.StringType()),
        T.StructField("fen", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("ply", T.IntegerType()),
        T.StructField("result", T.DoubleType()),
        T.StructField("features", T.ArrayType(T.FloatType())),
    ]
)
CANDIDATE = T.StructType(
    [
        T.StructField("moves", T.ArrayType(T.StringType())),
        T.StructField("result_fen", T.StringType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
        T.StructField("target", T.DoubleType()),
    ]
)
GROUPS = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("game_id", T.StringType()),
        T.StructField("root_fen", T.StringType()),
        T.StructField("dice", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("candidates", T.ArrayType(CANDIDATE)),
    ]
)
FEATURE_ROW = T.StructType(
    [
        T.StructField("a", T.ArrayType(T.DoubleType())),
        T.StructField("b", T.ArrayType(T.DoubleType())),
        T.StructField("c", T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField("target", T.LongType()),
        T.StructField("terminal", T.BooleanType()),
        T.StructField("moves", T.ArrayType(T.StringType())),
    ]
)
FEATURE_LINES = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("rows", T.ArrayType(FEATURE_ROW)),
    ]
)
PROBE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("fen", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("note", T.StringType()),
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
)
PROBES = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("perspective", T.StringType()),
        T.StructField("engineVersion", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("probes", T.ArrayType(PROBE)),
    ]
)
LATENCY = T.StructType(
    [
        T.StructField(name, T.DoubleType())
        for name in ("min_us", "median_us", "p95_us", "max_us")
    ]
)
COST_EVIDENCE = T.StructType(
    [
        T.StructField("schema", T.StringType()),
        T.StructField("engine_version", T.StringType()),
        T.StructField(
            "probes",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("fen", T.StringType()),
                        T.StructField("schemas", T.MapType(T.StringType(), LATENCY)),
                    ]
                ),
            ),
        ),
    ]
)


def enriched(columns=S0) -> T.StructType:
    """Position columns followed by exactly the named float features."""
    return T.StructType(
        list(POSITION.fields) + [T.StructField(c, T.FloatType()) for c in columns]
    )

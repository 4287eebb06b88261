"""Domain-shaped tables derived row by row from the driver's TPC-H-like tables.

Each derivation is a projection of one table, so its size grows with that table, and each has the
same text in SQL (`*_SQL`) for checking against another engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.functions.scoring import tempered_sigmoid
from evalspark.sources import schemas

WHITE_KING_RANKS = ["4K3", "R3K2R", "2KR4", "5RK1", "K7", "1K5B", "3QK3"]
BLACK_KING_RANKS = ["4k3", "r3k2r", "2kr4", "5rk1", "k7", "1k5b", "3qk3"]
INNER_RANKS = [
    "8", "pppppppp", "PPPPPPPP", "2p2P2", "3nN3", "P1P1p1p1", "1b4B1", "q6Q", "r1p2P1R",
]
CASTLING = ["KQkq", "kqKQ", "Kq", "qK", "-"]
EN_PASSANT = ["-", "e3", "-", "d6"]
WHITE_RESULT = [1, -1, 0, 1, -1]
DICE_FACES = ["P", "N", "B", "R", "Q", "K"]
SEEDS = [11, 23, 47, 89, 131]
PLIES = 40


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(values, index: Column) -> Column:
    """values[index] from a constant array."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def div(value: Column, by: int) -> Column:
    return F.floor(value / by).cast("long")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One position per order. A game is a run of forty orders, so (game, ply) is unique; the
    position depends on the customer, so exact repeats cross games and splits."""
    return shape_positions(read(spark, sf_dir, "orders"))


def shape_positions(orders: DataFrame) -> DataFrame:
    """The projection behind `positions`, for batch and streaming inputs alike."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    base = orders.select(
        key.alias("row_id"),
        div(key, PLIES).alias("game"),
        "o_totalprice",
        (cust * 4 + key % 4).alias("q"),
    )
    q = F.col("q")
    ranks = [pick(BLACK_KING_RANKS, q % 7)]
    ranks += [pick(INNER_RANKS, div(q * (2 * i + 3), 7) % 9) for i in range(6)]
    ranks += [pick(WHITE_KING_RANKS, div(q, 7) % 7)]
    ply = (F.col("row_id") % PLIES).cast("int")
    side = F.when(q % 2 == 0, "w").otherwise("b")
    clocks = F.when(div(F.col("row_id"), 4) % 3 == 0, "").otherwise(
        F.concat_ws(" ", F.lit(""), (ply % 50).cast("string"), (1 + div(ply, 2)).cast("string"))
    )
    fen = F.concat(
        F.concat_ws("/", *ranks),
        F.lit(" "),
        side,
        F.lit(" "),
        pick(CASTLING, F.col("row_id") % 5),
        F.lit(" "),
        pick(EN_PASSANT, q % 4),
        clocks,
    )
    a, b, c = (pick(DICE_FACES, x % 6) for x in (q, div(q, 6), div(q, 36)))
    turn = F.col("row_id") % 3
    roll = (
        F.when(turn == 0, F.concat(a, b, c))
        .when(turn == 1, F.concat(c, a, b))
        .otherwise(F.concat(b, c, a))
    )
    white = pick(WHITE_RESULT, F.col("game") % 5)
    score = (white + 1) / 2
    return base.select(
        "row_id",
        F.concat(F.lit("g"), F.col("game").cast("string")).alias("game_id"),
        ply.alias("ply"),
        fen.alias("fen"),
        F.when(side == "b", F.lower(roll)).otherwise(roll).alias("dice"),
        side.alias("side"),
        F.when(side == "b", 1 - score).otherwise(score).cast("float").alias("result"),
        white.alias("white_result"),
        "o_totalprice",
    )


def _sql_pick(values, index: str) -> str:
    quoted = [f"'{v}'" if isinstance(v, str) else str(v) for v in values]
    return f"([{', '.join(quoted)}])[({index}) + 1]"


def _positions_sql() -> str:
    ranks = [_sql_pick(BLACK_KING_RANKS, "q % 7")]
    ranks += [_sql_pick(INNER_RANKS, f"(q * {2 * i + 3} // 7) % 9") for i in range(6)]
    ranks += [_sql_pick(WHITE_KING_RANKS, "(q // 7) % 7")]
    placement = " || '/' || ".join(ranks)
    a, b, c = (_sql_pick(DICE_FACES, f"{x} % 6") for x in ("q", "(q // 6)", "(q // 36)"))
    white = _sql_pick(WHITE_RESULT, "game % 5")
    return f"""
position_base AS (
  SELECT o_orderkey AS row_id, o_orderkey // {PLIES} AS game, o_totalprice,
    o_custkey * 4 + o_orderkey % 4 AS q
  FROM orders
), position_parts AS (
  SELECT row_id, game, o_totalprice, q, (row_id % {PLIES})::INTEGER AS ply,
    CASE WHEN q % 2 = 0 THEN 'w' ELSE 'b' END AS side,
    {placement} AS board,
    CASE row_id % 3 WHEN 0 THEN {a} || {b} || {c} WHEN 1 THEN {c} || {a} || {b}
      ELSE {b} || {c} || {a} END AS roll,
    {white} AS white_result
  FROM position_base
), positions AS (
  SELECT row_id, 'g' || game::VARCHAR AS game_id, ply,
    board || ' ' || side || ' ' || {_sql_pick(CASTLING, "row_id % 5")} || ' '
      || {_sql_pick(EN_PASSANT, "q % 4")}
      || CASE WHEN (row_id // 4) % 3 = 0 THEN ''
         ELSE ' ' || (ply % 50)::VARCHAR || ' ' || (1 + ply // 2)::VARCHAR END AS fen,
    CASE WHEN side = 'b' THEN lower(roll) ELSE roll END AS dice, side,
    CASE WHEN side = 'b' THEN 1 - (white_result + 1) / 2.0 ELSE (white_result + 1) / 2.0 END
      ::DOUBLE AS result,
    white_result, o_totalprice, board
  FROM position_parts
)"""


POSITIONS_SQL = _positions_sql()

# Spelling of the shared scalar functions in SQL, over a text column or expression {0}.
KEY_SQL = (
    "(split_part({0},' ',1) || ' ' || split_part({0},' ',2) || ' ' || "
    "array_to_string(list_sort(string_split(split_part({0},' ',3),'')),'') || ' ' || "
    "split_part({0},' ',4))"
)
BUCKET_SQL = (
    "list_reduce(list_transform(range(0,8), lambda k : ('0x' || substr(sha256('playground-v1:' "
    "|| {0}), k*8+1, 8))::BIGINT), lambda a, x : (a*4294967296 + x) % 10000, 0::BIGINT)"
)
ROLL_SQL = "array_to_string(list_sort(string_split(upper({0}),'')),'')"
LETTER_SQL = "(length({0}) - length(replace({0}, '{1}', '')))"


def sql_position_key(column: str) -> str:
    return KEY_SQL.format(column)


def sql_bucket(column: str) -> str:
    return BUCKET_SQL.format(column)


def sql_split(bucket: str) -> str:
    return (
        f"CASE WHEN {bucket} < 8000 THEN 'train' WHEN {bucket} < 9000 THEN 'validation' "
        "ELSE 'test' END"
    )


def feature_columns(df: DataFrame, names=schemas.S0) -> DataFrame:
    """Attach the named feature columns: material from the board, the rest from the row key."""
    block = fx.material_block("fen", "side")
    key = F.col("row_id")
    made = {name: F.get(F.col("_block"), i) for i, name in enumerate(schemas.S0[:7])}
    made["mobility_diff"] = (key * 31 % 41 - 20).cast("float")
    made["king_safety_diff"] = (key * 17 % 11 - 5).cast("float")
    for i, name in enumerate(schemas.S0[9:]):
        made[name] = F.when(
            (key + i) % 3 == 0, ((key * (37 + i)) % 64).cast("float") / 64
        ).otherwise(0.0).cast("float")
    for i, name in enumerate(schemas.S2[13:]):
        made[name] = (key * (13 + i) % (5 + i)).cast("float")
    keep = df.columns
    return df.withColumn("_block", block).select(*keep, *[made[n].alias(n) for n in names])


def _feature_sql(name: str) -> str:
    diffs = {"p_diff": "P", "n_diff": "N", "b_diff": "B", "r_diff": "R", "q_diff": "Q"}

    def delta(piece: str) -> str:
        return (
            f"({LETTER_SQL.format('board', piece)} - {LETTER_SQL.format('board', piece.lower())})"
        )

    sign = "(CASE WHEN side = 'w' THEN 1 ELSE -1 END)"
    if name in diffs:
        return f"({sign} * {delta(diffs[name])})::DOUBLE"
    if name == "material_diff":
        return (
            f"({sign} * (" + " + ".join(f"{v} * {delta(p)}" for p, v in fx.PIECE_VALUES.items())
            + "))::DOUBLE"
        )
    if name == "total_material":
        total = " + ".join(
            f"{v} * ({LETTER_SQL.format('board', p)} + {LETTER_SQL.format('board', p.lower())})"
            for p, v in fx.PIECE_VALUES.items()
        )
        return f"({total})::DOUBLE"
    if name == "mobility_diff":
        return "(row_id * 31 % 41 - 20)::DOUBLE"
    if name == "king_safety_diff":
        return "(row_id * 17 % 11 - 5)::DOUBLE"
    if name in schemas.S0:
        i = schemas.S0.index(name) - 9
        return (
            f"(CASE WHEN (row_id + {i}) % 3 = 0 THEN ((row_id * {37 + i}) % 64) / 64.0 "
            "ELSE 0 END)::DOUBLE"
        )
    i = schemas.S2.index(name) - 13
    return f"(row_id * {13 + i} % {5 + i})::DOUBLE"


def features_sql(names=schemas.S0) -> str:
    return ", ".join(f"{_feature_sql(n)} AS {n}" for n in names)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisive and drawn rows with a logit `z`, its probability `p`, and a weaker reference."""
    y = F.col("result").cast("double")
    noise = ((F.col("row_id") * 7919) % 1000) / 1000 - 0.5
    other = ((F.col("row_id") * 6389) % 1000) / 1000 - 0.5
    base = positions(spark, sf_dir).select(
        "row_id",
        "game_id",
        "ply",
        "side",
        "fen",
        y.alias("y"),
        (noise * 2 + (2 * y - 1) * 0.4).alias("z"),
        (other * 2 + (2 * y - 1) * 0.3).alias("z_ref"),
        hashing.split_bucket("game_id").alias("bucket"),
    )
    return base.select(
        "*",
        hashing.split_of_bucket(F.col("bucket")).alias("split"),
        tempered_sigmoid(F.col("z"), 1.0).alias("p"),
        tempered_sigmoid(F.col("z_ref"), 1.0).alias("ref"),
    )


SCORED_SQL = (
    POSITIONS_SQL
    + f""", scored_base AS (
  SELECT row_id, game_id, ply, side, fen, board, result AS y,
    (((row_id * 7919) % 1000) / 1000.0 - 0.5)::DOUBLE * 2 + (2 * result - 1) * 0.4::DOUBLE AS z,
    (((row_id * 6389) % 1000) / 1000.0 - 0.5)::DOUBLE * 2 + (2 * result - 1) * 0.3::DOUBLE AS z_ref
  FROM positions
), game_buckets AS (
  SELECT game_id, {sql_bucket("game_id")} AS bucket FROM (SELECT DISTINCT game_id FROM positions)
), scored AS (
  SELECT s.*, bucket, {sql_split("bucket")} AS split,
    1 / (1 + exp(-z)) AS p, 1 / (1 + exp(-z_ref)) AS ref
  FROM scored_base s JOIN game_buckets USING (game_id)
)"""
)


def replicates(df: DataFrame, seeds=SEEDS) -> DataFrame:
    """Long table (seed, row): every seed's probability for every row."""
    seed = F.explode(F.array(*[F.lit(s) for s in seeds])).alias("seed")
    jitter = ((F.col("row_id") * F.col("seed")) % 97) / 97 - 0.5
    return df.select("*", seed).select(
        "*",
        tempered_sigmoid(F.col("z") + jitter * 0.3, 1.0).alias("p_seed"),
        tempered_sigmoid(F.col("z_ref") + jitter * 0.2, 1.0).alias("ref_seed"),
    )


REPLICATES_SQL = (
    SCORED_SQL
    + f""", replicates AS (
  SELECT s.*, seed,
    1 / (1 + exp(-(z + (((row_id * seed) % 97) / 97::DOUBLE - 0.5) * 0.3))) AS p_seed,
    1 / (1 + exp(-(z_ref + (((row_id * seed) % 97) / 97::DOUBLE - 0.5) * 0.2))) AS ref_seed
  FROM scored s, (SELECT unnest({SEEDS}) AS seed)
)"""
)


def candidates(spark: SparkSession, sf_dir: str, group: str = "l_suppkey") -> DataFrame:
    """One candidate per line item; a list is a supplier (long lists) or an order (short ones)."""
    line = read(spark, sf_dir, "lineitem")
    target = F.floor(F.col("l_extendedprice") / 5000).cast("long")
    terminal = F.col("l_extendedprice") >= 100000
    listed = line.select(
        F.concat(F.lit("s"), F.col(group).cast("string")).alias("group_id"),
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias(
            "cand_idx"
        ),
        F.when(terminal, F.lit(schemas.TERMINAL_TARGET).cast("long"))
        .otherwise(target)
        .alias("target"),
        terminal.alias("terminal"),
        F.col("l_quantity").alias("score"),
        (F.col("l_discount") * 100 + F.col("l_linenumber") * 0.125).alias("ref_score"),
        F.array(
            F.col("l_quantity"),
            F.col("l_discount"),
            F.col("l_tax"),
            F.col("l_linenumber").cast("double"),
            (F.col("l_partkey") % 7).cast("double"),
            (F.col("l_partkey") % 11).cast("double"),
            (F.col("l_orderkey") % 5).cast("double"),
            (F.col("l_orderkey") % 3).cast("double"),
            F.lit(1.0),
        ).alias("features"),
    )
    return listed.withColumn(
        "split", hashing.split_of_bucket(hashing.split_bucket("group_id"))
    )


def candidates_sql(group: str = "l_suppkey") -> str:
    return f"""
candidate_base AS (
  SELECT 's' || {group}::VARCHAR AS group_id,
    (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey AS cand_idx,
    CASE WHEN l_extendedprice >= 100000 THEN 2147483647
      ELSE floor(l_extendedprice / 5000)::BIGINT END AS target,
    l_extendedprice >= 100000 AS terminal,
    l_quantity AS score, l_discount * 100 + l_linenumber * 0.125::DOUBLE AS ref_score,
    [l_quantity, l_discount, l_tax, l_linenumber::DOUBLE, (l_partkey % 7)::DOUBLE,
     (l_partkey % 11)::DOUBLE, (l_orderkey % 5)::DOUBLE, (l_orderkey % 3)::DOUBLE, 1.0::DOUBLE]
      AS features
  FROM lineitem
), list_splits AS (
  SELECT group_id, {sql_split("b")} AS split FROM (
    SELECT group_id, {sql_bucket("group_id")} AS b
    FROM (SELECT DISTINCT group_id FROM candidate_base))
), candidates AS (
  SELECT c.*, split FROM candidate_base c JOIN list_splits USING (group_id)
)"""


CANDIDATES_SQL = candidates_sql()


def spoiled_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with planted faults, each on its own residue of the row key."""
    k = F.col("row_id")
    return positions(spark, sf_dir).select(
        "row_id",
        F.when(k % 101 == 1, None).otherwise(F.col("game_id")).alias("game_id"),
        F.when(k % 103 == 2, -1).otherwise(F.col("ply")).cast("int").alias("ply"),
        F.when(k % 107 == 3, " ").otherwise(F.col("fen")).alias("fen"),
        F.when(k % 109 == 4, "PP").when(k % 113 == 5, "PXN").otherwise(F.col("dice")).alias("dice"),
        F.when(k % 127 == 6, "x").otherwise(F.col("side")).alias("side"),
        F.when(k % 131 == 7, 0.25).otherwise(F.col("result")).cast("float").alias("result"),
    )


SPOILED_SQL = (
    POSITIONS_SQL
    + """, spoiled AS (
  SELECT row_id, CASE WHEN row_id % 101 = 1 THEN NULL ELSE game_id END AS game_id,
    CASE WHEN row_id % 103 = 2 THEN -1 ELSE ply END AS ply,
    CASE WHEN row_id % 107 = 3 THEN ' ' ELSE fen END AS fen,
    CASE WHEN row_id % 109 = 4 THEN 'PP' WHEN row_id % 113 = 5 THEN 'PXN' ELSE dice END AS dice,
    CASE WHEN row_id % 127 = 6 THEN 'x' ELSE side END AS side,
    CASE WHEN row_id % 131 = 7 THEN 0.25 ELSE result END AS result
  FROM positions
)"""
)


def after_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions as results of a move by `side`; on one row in seven the other king is taken."""
    taken = F.when(F.col("side") == "w", F.replace(F.col("fen"), F.lit("k"), F.lit("1"))).otherwise(
        F.replace(F.col("fen"), F.lit("K"), F.lit("1"))
    )
    board, rest = F.split(F.col("fen"), " ", 2), F.split(taken, " ", 2)
    fen = F.when(
        F.col("row_id") % 7 == 0, F.concat_ws(" ", F.get(rest, 0), F.get(board, 1))
    ).otherwise(F.col("fen"))
    return positions(spark, sf_dir).withColumn("fen", fen)


AFTER_SQL = (
    POSITIONS_SQL
    + """, after_states AS (
  SELECT row_id, game_id, ply, dice, side, result,
    CASE WHEN row_id % 7 = 0 THEN replace(board, CASE WHEN side = 'w' THEN 'k' ELSE 'K' END, '1')
      ELSE board END AS board,
    CASE WHEN row_id % 7 = 0
      THEN replace(board, CASE WHEN side = 'w' THEN 'k' ELSE 'K' END, '1') ELSE board END
      || substr(fen, length(board) + 1) AS fen
  FROM positions
)"""
)


def nested_groups(spark: SparkSession, sf_dir: str, spoil: bool = False) -> DataFrame:
    """One list of one to four candidates per position, built inside the row."""
    k = F.col("row_id")
    canonical, roll = fx.position_key("fen"), fx.canonical_dice("dice")
    fault = (lambda m, r: (k % m == r)) if spoil else (lambda m, r: F.lit(False))
    candidates_ = lambda canonical: F.transform(
        F.sequence(F.lit(1), (1 + k % 4).cast("int")),
        lambda i: F.struct(
            F.array(
                F.when(fault(59, 8) & (i == 1), "").otherwise(F.concat(F.lit("m"), i.cast("string"))),
                F.concat(F.lit("r"), (k % 9).cast("string")),
            ).alias("moves"),
            F.when(fault(53, 9) & (i == 1), " ").otherwise(
                F.concat_ws("#", canonical, F.when(fault(61, 1), F.lit(1)).otherwise(i).cast("string"))
            ).alias("result_fen"),
            F.transform(
                F.sequence(F.lit(1), F.when(fault(67, 2), F.lit(8)).otherwise(9)),
                lambda j: ((k * j + i) % 13).cast("double"),
            ).alias("features"),
            F.when(fault(47, 10) & (i == 1), float("nan"))
            .otherwise(((k * i) % 17).cast("double"))
            .alias("target"),
        ),
    )
    listed = fx.let(canonical, candidates_)
    group = F.when(fault(71, 3), F.lit("0000")).otherwise(hashing.group_id_for(canonical, roll))
    return positions(spark, sf_dir).select(
        "row_id",
        group.alias("group_id"),
        F.when(fault(73, 4), " ").otherwise(F.col("game_id")).alias("game_id"),
        F.col("fen").alias("root_fen"),
        F.when(fault(79, 5), F.lower(roll)).otherwise(roll).alias("dice"),
        F.when(fault(83, 6), "x").otherwise(F.col("side")).alias("side"),
        F.when(fault(89, 7), F.slice(listed, 1, 0)).otherwise(listed).alias("candidates"),
    )


GROUP_ID_SQL = f"substr(sha256('prerank-v1:' || {KEY_SQL.format('fen')} || '|' || {ROLL_SQL.format('dice')}), 1, 16)"


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, probe, schema, min_us, median_us, p95_us, max_us): three schemas per order, with a
    few out-of-order and non-positive records."""
    k, base = F.col("o_orderkey"), F.col("o_totalprice") / 1000
    schema = F.explode(F.array(F.lit("S0"), F.lit("S1"), F.lit("S2"))).alias("schema")
    lift = F.when(F.col("schema") == "S0", 0).otherwise(
        (k % 7 - 2) / F.when(F.col("schema") == "S1", 100).otherwise(60)
    )
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", schema)
        .select(
            k.alias("row_id"),
            F.concat(F.lit("p"), k.cast("string")).alias("probe"),
            "schema",
            F.when(k % 211 == 1, 0.0).otherwise(base * 0.9 * (1 + lift)).alias("min_us"),
            (base * (1 + lift)).alias("median_us"),
            F.when(k % 223 == 2, base * 0.5).otherwise(base * 1.2 * (1 + lift)).alias("p95_us"),
            (base * 1.5 * (1 + lift)).alias("max_us"),
        )
    )


LATENCIES_SQL = """
latency_base AS (
  SELECT o_orderkey AS row_id, 'p' || o_orderkey::VARCHAR AS probe, schema,
    o_totalprice / 1000 AS base,
    CASE schema WHEN 'S0' THEN 0 WHEN 'S1' THEN (o_orderkey % 7 - 2) / 100::DOUBLE
      ELSE (o_orderkey % 7 - 2) / 60::DOUBLE END AS lift
  FROM orders, (SELECT unnest(['S0','S1','S2']) AS schema)
), latencies AS (
  SELECT row_id, probe, schema,
    CASE WHEN row_id % 211 = 1 THEN 0.0 ELSE base * 0.9::DOUBLE * (1 + lift) END AS min_us,
    base * (1 + lift) AS median_us,
    CASE WHEN row_id % 223 = 2 THEN base * 0.5::DOUBLE ELSE base * 1.2::DOUBLE * (1 + lift) END
      AS p95_us,
    base * 1.5::DOUBLE * (1 + lift) AS max_us
  FROM latency_base
)"""


def twin_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, p, danger, features): every event is a probe and its twin; some twins are missing,
    and some drift by more than the tolerance."""
    k = F.col("event_id")
    half = F.explode(F.array(F.lit(""), F.lit("-twin"))).alias("half")
    name = F.concat(
        F.when(k % 10 == 9, "sample-").otherwise("probe-"), k.cast("string"), F.col("half")
    )
    p = F.col("value") / 500 + F.when((F.col("half") != "") & (k % 17 == 0), 0.001).otherwise(0.0)
    return (
        read(spark, sf_dir, "events")
        .select("event_id", "value", half)
        .where(~((F.col("half") != "") & (k % 29 == 3)))
        .select(
            name.alias("id"),
            k.alias("key"),
            "half",
            p.alias("p"),
            F.array(
                F.col("value"),
                (k % 3).cast("double"),
                F.when((F.col("half") != "") & (k % 31 == 4), 1.0).otherwise(0.0),
            ).alias("features"),
        )
    )


TWINS_SQL = """
twin_probes AS (
  SELECT CASE WHEN event_id % 10 = 9 THEN 'sample-' ELSE 'probe-' END || event_id::VARCHAR || half
      AS id,
    CASE WHEN event_id % 10 = 9 THEN 'sample-' ELSE 'probe-' END || event_id::VARCHAR AS base,
    event_id AS key, half,
    value / 500 + CASE WHEN half <> '' AND event_id % 17 = 0 THEN 0.001::DOUBLE ELSE 0 END AS p,
    value AS f0, (event_id % 3)::DOUBLE AS f1,
    CASE WHEN half <> '' AND event_id % 31 = 4 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS f2
  FROM events, (SELECT unnest(['', '-twin']) AS half)
  WHERE NOT (half <> '' AND event_id % 29 = 3)
)"""


def danger_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, score, danger, columns...): `<event>-blunder` and `<event>-safe`; some halves are
    missing and some pairs tie."""
    k = F.col("event_id")
    role = F.explode(F.array(F.lit("blunder"), F.lit("safe"))).alias("role")
    safe = F.col("role") == "safe"
    return (
        read(spark, sf_dir, "events")
        .select("event_id", "value", role)
        .where(~(safe & (k % 37 == 5)))
        .select(
            F.concat(F.lit("e"), k.cast("string"), F.lit("-"), F.col("role")).alias("id"),
            (F.col("value") + F.when(safe, (k % 5 - 2).cast("double")).otherwise(0.0)).alias(
                "score"
            ),
            F.when(safe, (k % 50).cast("double") / 100).otherwise(0.55).alias("danger"),
            F.col("value").alias("material"),
            F.when(safe, (k % 4).cast("double")).otherwise(1.0).alias("mobility"),
        )
    )


PAIRS_SQL = """
danger_pairs AS (
  SELECT 'e' || event_id::VARCHAR AS pair, role,
    value + CASE WHEN role = 'safe' THEN (event_id % 5 - 2)::DOUBLE ELSE 0 END AS score,
    CASE WHEN role = 'safe' THEN (event_id % 50)::DOUBLE / 100 ELSE 0.55::DOUBLE END AS danger,
    value AS material,
    CASE WHEN role = 'safe' THEN (event_id % 4)::DOUBLE ELSE 1.0::DOUBLE END AS mobility
  FROM events, (SELECT unnest(['blunder', 'safe']) AS role)
  WHERE NOT (role = 'safe' AND event_id % 37 = 5)
)"""


def predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two runs over the events: ids missing on either side, one null and a few drifting answers."""
    k = F.col("event_id")
    events = read(spark, sf_dir, "events")
    left = events.where(k % 53 != 1).select(k.alias("row_id"), (F.col("value") / 500).alias("p"))
    drift = F.when(k % 59 == 2, 0.00001).when(k % 61 == 3, 0.0000001).otherwise(0.0)
    right = events.where(k % 47 != 4).select(
        k.alias("row_id"),
        F.when(k % 997 == 5, None).otherwise(F.col("value") / 500 + drift).alias("p"),
    )
    return left, right


PREDICTIONS_SQL = """
run_a AS (
  SELECT event_id AS row_id, value / 500 AS p FROM events WHERE event_id % 53 <> 1
), run_b AS (
  SELECT event_id AS row_id, CASE WHEN event_id % 997 = 5 THEN NULL ELSE value / 500
    + CASE WHEN event_id % 59 = 2 THEN 0.00001::DOUBLE WHEN event_id % 61 = 3
      THEN 0.0000001::DOUBLE ELSE 0 END END AS p
  FROM events WHERE event_id % 47 <> 4
)"""

import hashlib

import pytest
from pyspark.sql import functions as F

from evalspark.functions import fen as fx
from evalspark.functions import hashing
from evalspark.functions import scoring as sx

START = "rnbqkbnr/pppppppp/8/8/8/8/PPPPPPPP/RNBQKBNR w KQkq - 0 1"
MIXED = "r3k2r/1P6/8/3q4/8/8/6p1/R3K2R b qkQK e3 4 9"


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row if len(columns) > 1 else row[0]


def test_split_bucket_is_the_256_bit_modulus(spark):
    rows = spark.range(300).select(
        F.concat(F.lit("g"), F.col("id").cast("string")).alias("g")
    ).select("g", hashing.split_bucket("g").alias("b"), hashing.split_for("g").alias("s"))
    for g, b, s in rows.collect():
        expected = int(hashlib.sha256(f"playground-v1:{g}".encode()).hexdigest(), 16) % 10000
        assert b == expected
        assert s == ("train" if b < 8000 else "validation" if b < 9000 else "test")


def test_position_key_ignores_clocks_and_castling_order(spark):
    key = one(spark, k=fx.position_key(F.lit(MIXED)))
    assert key == "r3k2r/1P6/8/3q4/8/8/6p1/R3K2R b KQkq e3"
    assert one(spark, k=fx.position_key(F.lit("8/8 w"))) is None


@pytest.mark.parametrize(
    "dice,expected", [("qnp", "NPQ"), ("KKB", "BKK"), ("PP", None), ("PXN", None)]
)
def test_canonical_dice(spark, dice, expected):
    assert one(spark, d=fx.canonical_dice(F.lit(dice))) == expected


def test_twin_is_an_involution_and_shares_the_view(spark):
    twin = one(spark, t=fx.twin_fen(F.lit(MIXED)))
    assert twin == "r3k2r/6P1/8/8/3Q4/8/1p6/R3K2R w KQkq e6 4 9"
    row = one(
        spark,
        back=fx.twin_fen(F.lit(twin)),
        a=fx.mover_squares(F.lit(MIXED), F.lit("b")),
        b=fx.mover_squares(F.lit(twin), F.lit("w")),
        m=fx.material_block(F.lit(MIXED), F.lit("b")),
        n=fx.material_block(F.lit(twin), F.lit("w")),
    )
    assert row.back == "r3k2r/1P6/8/3q4/8/8/6p1/R3K2R b KQkq e3 4 9"
    assert row.a == row.b and list(row.m) == list(row.n)
    assert list(row.m) == [0, 0, 0, 0, 1, 9, 31]


def brute_planes(fen):
    planes = [0.0] * 768
    for r, rank in enumerate(fen.split()[0].split("/")):
        file = 0
        for ch in rank:
            if ch.isdigit():
                file += int(ch)
                continue
            planes["PNBRQKpnbrqk".index(ch) * 64 + (7 - r) * 8 + file] = 1.0
            file += 1
    return planes


@pytest.mark.parametrize("fen", [START, MIXED])
def test_placement_planes(spark, fen):
    assert list(one(spark, p=fx.placement_planes(F.lit(fen)))) == brute_planes(fen)


@pytest.mark.parametrize(
    "board",
    ["8/8/8/8/8/8/8", "9/8/8/8/8/8/8/8", "7/8/8/8/8/8/8/8", "x7/8/8/8/8/8/8/8", ".7/8/8/8/8/8/8/8"],
)
def test_bad_placements_encode_to_null(spark, board):
    fen = F.lit(f"{board} w - -")
    assert one(spark, p=fx.placement_planes(fen)) is None
    assert one(spark, p=fx.encode_position(fen, F.lit("PPP"), F.lit("w"))) is None


def test_encoding_mixes_nulls_and_rows(spark):
    rows = spark.createDataFrame(
        [(0, START, "PNB", "w"), (1, "bad", "PNB", "w"), (2, MIXED, "kkq", "b")],
        "i int, fen string, dice string, side string",
    ).select("i", fx.encode_position("fen", "dice", "side").alias("v"))
    got = {r.i: r.v for r in rows.collect()}
    assert got[1] is None and len(got[0]) == 774 and sum(got[0][:768]) == 32
    assert list(got[0][:768]) == brute_planes(START)
    assert got[2][768:] == pytest.approx([0, 0, 0, 0, 1 / 3, 2 / 3])


def brute_ids(view):
    pieces = [(i, c) for i, c in enumerate(view) if c in "PNBRQpnbrq"]
    out = []
    for anchor, king in enumerate("Kk"):
        sq = view.index(king)
        bucket = (sq % 8) // 2 + 4 * (sq // 8 // 2)
        out.append(
            sorted(
                ((anchor * 16 + bucket) * 10 + "PNBRQpnbrq".index(c)) * 64 + i for i, c in pieces
            )
        )
    return out


@pytest.mark.parametrize("fen,side", [(START, "w"), (MIXED, "b"), (MIXED, "w")])
def test_king_relative_ids(spark, fen, side):
    row = one(
        spark,
        view=fx.mover_squares(F.lit(fen), F.lit(side)),
        ids=fx.king_relative_ids(F.lit(fen), F.lit(side)),
    )
    assert [list(x) for x in row.ids] == brute_ids(row.view)


def test_terminal_position_has_no_ids(spark):
    fen = F.lit("8/8/8/8/8/8/8/4K3 b - -")
    row = one(
        spark,
        t=fx.is_terminal(fen, F.lit("w")),
        ids=fx.king_relative_ids(fen, F.lit("w")),
        other=fx.is_terminal(fen, F.lit("b")),
    )
    assert row.t and not row.other and [list(x) for x in row.ids] == [[], []]


def test_edge_bin_and_truncating_bin_differ(spark):
    p = F.lit(0.3)
    row = one(spark, a=sx.calibration_bin(p), b=sx.edge_bin(p), c=sx.calibration_bin(F.lit(1.0)))
    assert (row.a, row.b, row.c) == (3, 2, 9)


def test_log_loss_clips(spark):
    row = one(spark, a=sx.log_loss(F.lit(1.0), F.lit(0.0)), b=sx.log_loss(F.lit(0.0), F.lit(0.0)))
    assert row.a == pytest.approx(34.538776394910684) and row.b == pytest.approx(0, abs=1e-12)


def test_close_needs_equal_lengths(spark):
    a = F.array(F.lit(1.0), F.lit(2.0))
    row = one(
        spark,
        same=sx.close(a, F.array(F.lit(1.0), F.lit(2.0 + 1e-7)), 1e-6),
        far=sx.close(a, F.array(F.lit(1.0), F.lit(2.1)), 1e-6),
        short=sx.close(a, F.array(F.lit(1.0)), 1e-6),
    )
    assert (row.same, row.far, row.short) == (True, False, False)


def test_pad_fen(spark):
    row = one(spark, a=fx.pad_fen(F.lit("8/8 w - -")), b=fx.pad_fen(F.lit(START)))
    assert row.a == "8/8 w - - 0 1" and row.b == START

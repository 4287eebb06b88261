"""Position strings (4 or 6 space-separated fields) as SQL expressions.

Piece letters are case sensitive: upper case is White, lower case Black.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Piece letters in plane order, and the unit values of the material count.
PIECES = "PNBRQK"
PIECE_VALUES = {"P": 1, "N": 3, "B": 3, "R": 5, "Q": 9}
DICE_COUNT = 3
BOARD_DIM = 768
DICE_DIM = 6


def col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """body(value) with `value` evaluated once: lambdas would otherwise re-evaluate a captured
    expression for every array element."""
    return F.get(F.transform(F.array(value), body), 0)


def fields(fen) -> Column:
    return F.split(F.trim(col(fen)), r"\s+")


def placement(fen) -> Column:
    return F.get(fields(fen), 0)


def active_colour(fen) -> Column:
    return F.get(fields(fen), 1)


def sort_letters(value: Column) -> Column:
    return F.array_join(F.array_sort(F.split(value, "")), "")


def position_key(fen) -> Column:
    """Placement, side, sorted castling rights, en passant; clocks do not take part.
    Null when the string has fewer than four fields."""
    f = fields(fen)
    return F.when(
        F.size(f) >= 4,
        F.concat_ws(" ", F.get(f, 0), F.get(f, 1), sort_letters(F.get(f, 2)), F.get(f, 3)),
    )


def state_fingerprint(fen) -> Column:
    return F.sha2(position_key(fen), 256)


def pad_fen(fen) -> Column:
    """Four fields become six with a fresh clock; anything else is left alone."""
    f = col(fen)
    return F.when(F.size(fields(f)) == 4, F.concat(f, F.lit(" 0 1"))).otherwise(f)


def valid_dice(dice) -> Column:
    return F.coalesce(F.upper(col(dice)).rlike(f"^[{PIECES}]{{{DICE_COUNT}}}$"), F.lit(False))


def canonical_dice(dice) -> Column:
    """Sorted upper-case letters: a roll is a multiset. Null when it is not three piece letters."""
    return F.when(valid_dice(dice), sort_letters(F.upper(col(dice))))


def count_letter(board: Column, letter: str) -> Column:
    return F.length(board) - F.length(F.replace(board, F.lit(letter), F.lit("")))


def material_block(fen, side) -> Column:
    """array<float>[7]: five piece differences, the material difference and the total, with the
    mover's pieces counted positive. Every letter is counted once per row."""
    values = list(PIECE_VALUES.items())
    n = len(values)
    sign = F.when(col(side) == "w", 1).when(col(side) == "b", -1)

    def counts(board: Column) -> Column:
        white = [count_letter(board, p) for p, _ in values]
        black = [count_letter(board, p.lower()) for p, _ in values]
        return F.array(*white, *black)

    def block(c: Column) -> Column:
        diffs = [F.get(c, i) - F.get(c, n + i) for i in range(n)]
        both = [F.get(c, i) + F.get(c, n + i) for i in range(n)]
        balance = sum(d * v for d, (_, v) in zip(diffs, values))
        total = sum(b * v for b, (_, v) in zip(both, values))
        parts = [*[sign * d for d in diffs], sign * balance, total]
        return F.array(*[x.cast("float") for x in parts])

    return let(let(placement(fen), counts), block)


SWAP_FROM = PIECES + PIECES.lower()
SWAP_TO = PIECES.lower() + PIECES


def swap_case(value: Column) -> Column:
    return F.translate(value, SWAP_FROM, SWAP_TO)


def mirror_placement(board: Column) -> Column:
    return swap_case(F.array_join(F.reverse(F.split(board, "/")), "/"))


def twin_fen(fen) -> Column:
    """The same decision seen from the other side: ranks reversed, colours swapped."""
    f = fields(fen)
    castling, ep = F.get(f, 2), F.get(f, 3)
    side2 = F.when(F.get(f, 1) == "w", "b").otherwise("w")
    castling2 = F.when(castling == "-", "-").otherwise(sort_letters(swap_case(castling)))
    ep2 = F.when(ep == "-", "-").otherwise(
        F.concat(F.substring(ep, 1, 1), (9 - F.substring(ep, 2, 1).cast("int")).cast("string"))
    )
    head = F.array(mirror_placement(F.get(f, 0)), side2, castling2, ep2)
    return F.when(
        F.size(f) >= 4, F.array_join(F.concat(head, F.slice(f, 5, F.size(f))), " ")
    )


def squares(board: Column) -> Column:
    """64 characters, square index = rank * 8 + file with rank 0 = White's back rank; empty is '.'."""
    return spread(F.array_join(F.reverse(F.split(board, "/")), ""))


def spread(board: Column) -> Column:
    """Digits become that many dots; rank separators stay."""
    for digit in range(8, 0, -1):
        board = F.replace(board, F.lit(str(digit)), F.lit("." * digit))
    return board


def valid_placement(board: Column) -> Column:
    """Eight ranks, each spelling exactly eight files with known letters."""
    rank = f"[.{SWAP_FROM}]{{8}}"
    plain = ~F.contains(board, F.lit("."))
    return F.coalesce(plain & spread(board).rlike(f"^{rank}(/{rank}){{7}}$"), F.lit(False))


def one_king_each(board: Column) -> Column:
    return (count_letter(board, "K") == 1) & (count_letter(board, "k") == 1)


def is_terminal(fen, mover) -> Column:
    """The mover has taken the other king."""
    board, side = placement(fen), col(mover)
    return F.when(side == "w", F.instr(board, "k") == 0).otherwise(F.instr(board, "K") == 0)


def mover_squares(fen, side) -> Column:
    """64 characters with the mover's pieces in upper case, seen from the mover's back rank."""
    board = placement(fen)
    return squares(F.when(col(side) == "b", mirror_placement(board)).otherwise(board))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def board_planes(view: pa.Array) -> pa.Array:
    """array<float>[768]: 12 planes of 64 squares from a 64-character board; null stays null.

    The one dense expansion of the library: 768 floats per row cost far less as one vector
    comparison per Arrow batch than as 768 expression evaluations per row.
    """
    known = view.is_valid().to_numpy(zero_copy_only=False)
    text = "".join(view.drop_null().to_pylist()).encode("ascii")
    cells = np.frombuffer(text, dtype=np.uint8).reshape(-1, 1, 64)
    letters = np.frombuffer(SWAP_FROM.encode("ascii"), dtype=np.uint8).reshape(1, 12, 1)
    planes = (cells == letters).astype(np.float32).reshape(-1)
    stops = np.concatenate([[0], np.cumsum(known * BOARD_DIM)]).astype(np.int32)
    offsets = pa.array(stops, mask=np.concatenate([~known, [False]]))
    return pa.ListArray.from_arrays(offsets, pa.array(planes))


def placement_planes(fen) -> Column:
    """White's view of the board; null when the placement is malformed."""
    board = placement(fen)
    return board_planes(F.when(valid_placement(board), squares(board)))


def dice_fractions(dice) -> Column:
    roll = F.upper(col(dice))
    return F.when(
        valid_dice(dice),
        F.array(*[(count_letter(roll, p) / F.lit(float(DICE_COUNT))).cast("float") for p in PIECES]),
    )


def encode_position(fen, dice, side) -> Column:
    """array<float>[774]: mover's planes followed by the roll's fractions; null if invalid."""
    good = valid_placement(placement(fen)) & valid_dice(dice) & col(side).isin("w", "b")
    return F.concat(board_planes(F.when(good, mover_squares(fen, side))), dice_fractions(dice))


def active_indices(fen, dice, side) -> Column:
    """The set cells of `encode_position`'s board part, ascending: at most 32 of 768."""
    cells = F.split(mover_squares(fen, side), "")
    hits = F.transform(
        cells,
        lambda c, i: F.when(
            c != ".", (F.instr(F.lit(SWAP_FROM), c) - 1) * 64 + i
        ),
    )
    return F.array_sort(F.filter(hits, lambda x: x.isNotNull()))


def king_relative_ids(fen, mover) -> Column:
    """array<array<int>>[2]: sparse ids anchored on the mover's king, then on the other king.

    id = ((anchor * 16 + bucket) * 10 + category) * 64 + square, where the bucket is the king's
    4 x 4 block and the category is the mover's P N B R Q, then the opponent's. Both lists are
    empty for a terminal position. Black's view is the vertical reflection.
    """
    letters = PIECES[:5] + PIECES[:5].lower()

    def pieces(view: Column) -> Column:
        """category * 64 + square of every piece but the kings."""
        cells = F.transform(
            F.split(view, ""), lambda c, i: (F.instr(F.lit(letters), c) - 1) * 64 + i
        )
        return F.filter(cells, lambda x: x >= 0)

    def base(view: Column, anchor: int, king: str) -> Column:
        square = F.instr(view, king) - 1
        bucket = F.shiftright(square % 8, 1) + 4 * F.shiftright(square, 4)
        return (anchor * 16 + bucket) * 640

    def anchored(view: Column) -> Column:
        found = F.array_sort(pieces(view))
        bases = F.array(base(view, 0, "K"), base(view, 1, "k"))
        return let(
            found,
            lambda ids: F.transform(
                bases, lambda at: F.transform(ids, lambda x: (x + at).cast("int"))
            ),
        )

    empty = F.array().cast("array<int>")
    return F.when(is_terminal(fen, mover), F.array(empty, empty)).otherwise(
        let(mover_squares(fen, mover), anchored)
    )

"""Positions in SFEN, moves in USI and evaluations, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: The start position, the mate bound and the bounds of plain evaluations.
STARTPOS = "lnsgkgsnl/1r5b1/ppppppppp/9/9/9/PPPPPPPPP/1B5R1/LNSGKGSNL b - 1"
MATE, EVAL_MOST = 32000, 30000


def swap_case(text: Column) -> Column:
    return F.translate(text, LOWER + UPPER, UPPER + LOWER)


def part(sfen: Column, k: int) -> Column:
    """The k-th of board, side, hands and ply, from 0; null if it is missing."""
    return F.get(F.split(sfen, " "), k)


def flip_sfen(sfen: Column) -> Column:
    """The position turned by 180 degrees with colours swapped; a ply, if there is one, stays."""
    board = F.regexp_replace(swap_case(F.reverse(part(sfen, 0))), r"([A-Za-z])\+", r"+$1")
    hands = part(sfen, 2)
    mine, theirs = F.regexp_extract_all(hands, F.lit(r"\d*[A-Z]"), 0), F.regexp_extract_all(hands, F.lit(r"\d*[a-z]"), 0)
    flipped = F.concat(swap_case(F.array_join(theirs, "")), swap_case(F.array_join(mine, "")))
    hand = F.when(hands == "-", "-").otherwise(flipped)
    side = F.when(part(sfen, 1) == "b", "w").otherwise("b")
    return F.concat_ws(" ", board, side, hand, part(sfen, 3))


def flip_move(move: Column) -> Column:
    """Files 1-9 and ranks a-i mirrored; drops keep their piece. Words such as resign stay."""
    turned = F.translate(move, "123456789abcdefghi", "987654321ihgfedcba")
    return F.when(move.rlike(r"^([1-9][a-i]|[A-Z]\*)[1-9][a-i]\+?$"), turned).otherwise(move)


def trim_ply(sfen: Column) -> Column:
    """The position without its trailing number."""
    return F.regexp_replace(F.trim(sfen), r"\s+\d+$", "")


def ply(sfen: Column, missing: int = 0) -> Column:
    return F.coalesce(F.regexp_extract(sfen, r"\s(\d+)\s*$", 1).try_cast("int"), F.lit(missing))


def side(sfen: Column) -> Column:
    """b or w; anything else fails."""
    s = part(sfen, 1)
    return F.when(s.isin("b", "w"), s).otherwise(F.raise_error(F.concat(F.lit("no side to move: "), sfen)))


def normal_move(move: Column) -> Column:
    m = F.lower(F.trim(F.coalesce(move, F.lit(""))))
    return F.when(m.isin("", "none", "resign"), "none").otherwise(F.trim(move))


def score(kind: Column, value: Column) -> Column:
    """The evaluation of a USI score: cp is held within 30000, mate counts down from 32000; a bare sign is mate in one."""
    n = F.when(value == "+", 1).when(value == "-", -1).otherwise(value.cast("int"))
    mate = F.when(n > 0, MATE - n).otherwise(-MATE - n)
    return F.when(kind == "mate", mate).otherwise(F.greatest(F.least(n, F.lit(EVAL_MOST)), F.lit(-EVAL_MOST)))


def legacy_eval(value: Column) -> Column:
    """Old mate scores around 100000 as scores around 32000; other values are held within 32000."""
    near = F.abs(value) > 90000
    mate = F.when(value > 0, MATE - (100000 - value)).otherwise(-MATE + (100000 + value))
    return F.when(near, mate).otherwise(F.greatest(F.least(value, F.lit(MATE)), F.lit(-MATE))).cast("int")


def clamp16(value: Column) -> Column:
    """Held within 16 signed bits, symmetric: -32767 to 32767."""
    return F.greatest(F.least(value, F.lit(32767)), F.lit(-32767))


def signed16(value: Column) -> Column:
    return F.when(value >= 32768, value - 65536).otherwise(value)


def unsigned64(value: Column) -> Column:
    """A bigint's bits as an unsigned decimal."""
    wide = value.cast("decimal(20,0)")
    return F.when(value < 0, wide + F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide).cast("decimal(20,0)")


def elo(wins: Column, losses: Column) -> Column:
    """The rating difference of a score without draws: null without games, infinite at 0 and 1."""
    rate = wins / F.nullif(wins + losses, F.lit(0))
    inf = F.lit(float("inf"))
    return F.when(rate == 1, inf).when(rate == 0, -inf).otherwise(-400 * F.log10(1 / F.when((rate > 0) & (rate < 1), rate) - 1))

"""Training records: fixed-size positions (hcpe, psv), games (hcpe3, pack), and their conversions."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import codec
from tessera.functions.codec import little

# Record sizes and the limits of game records.
HCPE_BYTES, PSV_BYTES = 38, 40
MOST_PLIES, MOST_CANDIDATES = 513, 593
HCPE3_HEAD, HCPE3_MOVE, HCPE3_VISITS = struct.Struct("<32sHBB"), struct.Struct("<HhH"), struct.Struct("<HH")

GAME = "hcp binary, result int, info int, plies array<struct<move16:int,eval:int,candidates:array<struct<move16:int,visits:int>>>>"
PACK = "start binary, ply int, result int, reason int, plies array<struct<move16:int,eval:int>>"


def read_records(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(record) of fixed-size records; files split among tasks at record borders, which no file source of DataFrames does."""
    return spark.createDataFrame(spark.sparkContext.binaryRecords(path, size).map(lambda r: (bytearray(r),)), "record binary")


def read_hcpe(spark: SparkSession, path: str) -> DataFrame:
    r = F.col("record")
    return read_records(spark, path, HCPE_BYTES).select(
        F.substring(r, 1, 32).alias("hcp"), little(r, 32, 2, True).alias("eval"), little(r, 34, 2).alias("move16"), little(r, 36, 1).alias("result")
    )


def read_psv(spark: SparkSession, path: str) -> DataFrame:
    r = F.col("record")
    return read_records(spark, path, PSV_BYTES).select(
        F.substring(r, 1, 32).alias("sfen"), little(r, 32, 2, True).alias("score"), little(r, 34, 2).alias("move16"),
        little(r, 36, 2).alias("ply"), little(r, 38, 1, True).alias("result"),
    )


def side_to_move(packed: Column) -> Column:
    """0 for Black and 1 for White: the first bit of a packed position."""
    return little(packed, 0, 1).bitwiseAND(1)


def relative_result(result: Column, side: Column) -> Column:
    """0 draw, 1 Black won, 2 White won, as 1, 0 or -1 for the side to move."""
    black = F.when(result == 1, 1).when(result == 2, -1).otherwise(0)
    return F.when(side == 1, -black).otherwise(black)


def absolute_result(result: Column, side: Column) -> Column:
    """The inverse of ``relative_result``."""
    black = F.when(side == 1, -result).otherwise(result)
    return F.when(black == 1, 1).when(black == -1, 2).otherwise(0)


def hcpe_to_psv(rows: DataFrame) -> DataFrame:
    """The ply isn't known in hcpe and is 0."""
    return rows.select(
        F.col("hcp").alias("sfen"), F.col("eval").alias("score"), "move16", F.lit(0).alias("ply"), relative_result(F.col("result"), side_to_move(F.col("hcp"))).alias("result")
    )


def psv_to_hcpe(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("sfen").alias("hcp"), F.col("score").alias("eval"), "move16", absolute_result(F.col("result"), side_to_move(F.col("sfen"))).alias("result")
    )


def decode_hcpe3(data: bytes) -> Iterator[tuple]:
    """(hcp, result, info, plies) of each game; truncated or oversized games are errors."""
    at = 0
    while at < len(data):
        try:
            hcp, moves, result, info = HCPE3_HEAD.unpack_from(data, at)
            at += HCPE3_HEAD.size
            if moves > MOST_PLIES:
                raise ValueError(f"{moves} plies")
            plies = []
            for _ in range(moves):
                move, value, n = HCPE3_MOVE.unpack_from(data, at)
                at += HCPE3_MOVE.size
                if n > MOST_CANDIDATES:
                    raise ValueError(f"{n} candidates")
                plies.append((move, value, [HCPE3_VISITS.unpack_from(data, at + k * HCPE3_VISITS.size) for k in range(n)]))
                at += n * HCPE3_VISITS.size
        except struct.error as e:
            raise ValueError("truncated game") from e
        yield hcp, result, info, plies


def encode_hcpe3(hcp: bytes, result: int, info: int, plies: list[tuple]) -> bytes:
    body = b"".join(HCPE3_MOVE.pack(m, v, len(c)) + b"".join(HCPE3_VISITS.pack(*x) for x in c) for m, v, c in plies)
    return HCPE3_HEAD.pack(hcp, len(plies), result, info) + body


def decode_pack(data: bytes) -> Iterator[tuple]:
    """(start, ply, result, reason, plies) of each game: a null start is the start position.

    A game ends with a move whose source and target are equal, which holds the result, and a byte for the reason.
    """
    at = 0

    def take(form: str) -> int:
        nonlocal at
        try:
            (x,) = struct.unpack_from(form, data, at)
        except struct.error as e:
            raise ValueError("truncated game") from e
        at += struct.calcsize(form)
        return x

    while at < len(data):
        kind, start, ply = take("<B"), None, 1
        if kind == 0:
            start, ply = take("<32s"), take("<H")
        elif kind != 1:
            raise ValueError("unknown start of a game")
        plies = []
        while True:
            move = take("<H")
            if move & 127 == move >> 7 & 127:
                break
            plies.append((move, take("<h")))
        yield start, ply, move & 127, take("<B"), plies


def encode_pack(start: bytes | None, ply: int, result: int, reason: int, plies: list[tuple[int, int]]) -> bytes:
    """K3: evaluations are held within 32000."""
    head = b"\x01" if start is None else b"\x00" + start + struct.pack("<H", ply)
    body = b"".join(struct.pack("<Hh", m, max(-32000, min(32000, v))) for m, v in plies)
    return head + body + struct.pack("<HB", result | result << 7, reason)


def read_games(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Games of ``hcpe3`` or ``pack`` files; such files have no borders to split at, so a task reads one file."""
    decode, schema = {"hcpe3": (decode_hcpe3, GAME), "pack": (decode_pack, PACK)}[kind]
    names = [x.strip().split()[0] for x in schema.split(", ")]

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for data in part["content"]:
                rows: list[tuple] = []
                for row in decode(bytes(data)):
                    rows.append(row)
                    if len(rows) == 1000:
                        yield frame(rows)
                        rows = []
                if rows:
                    yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        keys = ("move16", "eval") if kind == "pack" else ("move16", "eval", "candidates")
        out = pd.DataFrame(rows, columns=names)
        ply = lambda p: dict(zip(keys, p if len(p) == 2 else (p[0], p[1], [dict(zip(("move16", "visits"), c, strict=True)) for c in p[2]]), strict=True))
        out["plies"] = [[ply(p) for p in r] for r in out["plies"]]
        return out

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, schema)


def game_moves(games: DataFrame) -> DataFrame:
    """A row per ply with its move in USI, the evaluation and the following move as ponder."""
    key = [c for c in games.columns if c != "plies"]
    x = games.select(*key, "plies", F.posexplode("plies").alias("at", "p"))
    following = F.get(F.col("plies"), F.col("at") + 1)["move16"]
    return x.select(*key, "at", codec.usi_of(F.col("p.move16")).alias("move"), F.col("p.eval").alias("eval"), codec.usi_of(following).alias("ponder"))

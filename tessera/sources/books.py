"""Opening books as files: text books (.db), binary books (.ybb) and Apery books."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import codec
from tessera.functions.codec import little
from tessera.functions.sfen import normal_move, trim_ply
from tessera.operators.books import saturated
from tessera.sources.training import read_records

# The headers and records of the formats.
DB_HEADER = "#YANEURAOU-DB2016 1.00"
YBB_MAGIC = b"YANE-BINBOOK-V1\0"
YBB_HEADER, YBB_INDEX, YBB_MOVE, YBB_MOVE_DEPTH = (struct.Struct(f) for f in ("<16sQQ", "<32sQHH", "<Hh", "<HhH"))
YBB_DEPTH_FLAG = 1
APERY = struct.Struct("<QHHi")


def read_db(spark: SparkSession, path: str, ignore_ply: bool = False, miner: bool = False) -> DataFrame:
    """(key, seq, move, ponder, value, depth, move_count) of a text book.

    Records are cut at lines that begin with ``sfen``, so files split among tasks and each row is a position with its moves; whatever
    stands before the first position and lines that begin with # or // are skipped. Move lines have spaces or commas between fields; missing
    numbers are zero. ``miner`` drops moves whose value is None. ``seq`` is the place in the position's list; positions that occur twice
    stay separate blocks, told apart by ``block``.
    """
    blocks = spark.read.option("lineSep", "\nsfen ").text(path)
    text = F.regexp_replace("value", r"^\x{FEFF}?sfen ", "")
    lines = F.transform(F.split(text, "\n"), lambda x: F.rtrim(F.trim(F.replace(x, F.lit("\r"), F.lit("")))))
    is_position = F.regexp_replace("value", r"^\x{FEFF}", "").rlike(r"^(sfen )?\S+ [bw] \S+")  # what stands before the first position of a file is none
    x = blocks.where(is_position).select(F.monotonically_increasing_id().alias("block"), lines.alias("lines"))
    key = F.col("lines")[0]
    kept = F.filter(F.slice("lines", 2, 1 << 30), lambda s: (s != "") & ~s.startswith("#") & ~s.startswith("//"))
    x = x.select("block", (trim_ply(key) if ignore_ply else key).alias("key"), F.posexplode(kept).alias("seq", "line"))
    f = F.split(F.trim("line"), r"[\s,]+")
    number = lambda k, kind: F.coalesce(F.get(f, F.lit(k)).try_cast(kind), F.lit(0))
    out = x.select(
        "key", "block", "seq", normal_move(F.get(f, F.lit(0))).alias("move"), normal_move(F.get(f, F.lit(1))).alias("ponder"),
        F.get(f, F.lit(2)).alias("raw"), number(3, "int").alias("depth"), number(4, "bigint").alias("move_count"),
    )
    if miner:
        out = out.where("raw <> 'None'")
    return out.withColumn("value", F.coalesce(F.col("raw").try_cast("int"), F.lit(0))).drop("raw")


def write_db(moves: DataFrame, path: str) -> None:
    """K1: a text book sorted by position, moves by falling count and value; the header is the first file's first line."""
    line = F.concat_ws(" ", "move", "ponder", F.col("value").cast("string"), F.col("depth").cast("string"), F.col("move_count").cast("string"))
    item = F.struct((-F.col("move_count")).alias("a"), (-F.col("value")).alias("b"), "seq", line.alias("line"))
    body = moves.groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("items"))
    rows = body.select(F.lit(1).alias("k"), "key", F.concat_ws("\r\n", F.concat(F.lit("sfen "), "key"), F.col("items.line")).alias("text"))
    head = moves.sparkSession.range(1).select(F.lit(0).alias("k"), F.lit("").alias("key"), F.lit(DB_HEADER).alias("text"))
    rows.unionByName(head).orderBy("k", "key").select("text").write.option("lineSep", "\r\n").text(path)


def read_ybb(spark: SparkSession, path: str) -> DataFrame:
    """(packed, ply, seq, move, value, depth) of binary books; magic, flags, order of the keys and offsets are checked.

    A file is read by one task; its records are taken as arrays, some at a time, and moves are named by a built-in expression.
    """

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for data in part["content"]:
                yield from decode_ybb(bytes(data))

    files = spark.read.format("binaryFile").load(path).select("content")
    rows = files.mapInPandas(parse, "packed binary, ply int, seq int, move16 int, value int, depth int")
    return rows.select("packed", "ply", "seq", codec.usi_of(F.col("move16")).alias("move"), "value", "depth")


def decode_ybb(data: bytes, records_at_once: int = 1 << 16) -> Iterator[pd.DataFrame]:
    magic, records, flags = YBB_HEADER.unpack_from(data, 0)
    if magic != YBB_MAGIC or flags & ~YBB_DEPTH_FLAG:
        raise ValueError("no binary book, or unknown flags")
    fields = [("move16", "<u2"), ("value", "<i2"), ("depth", "<u2")][: 3 if flags & YBB_DEPTH_FLAG else 2]
    move = np.dtype(fields)
    heap = YBB_HEADER.size + records * YBB_INDEX.size
    if heap > len(data):
        raise ValueError("index beyond the end of the book")
    index = np.frombuffer(data, [("packed", "S32"), ("offset", "<u8"), ("ply", "<u2"), ("n", "<u2")], records, YBB_HEADER.size)
    keys = np.frombuffer(data, np.uint8, records * YBB_INDEX.size, YBB_HEADER.size).reshape(records, YBB_INDEX.size)[:, :32]
    words = np.ascontiguousarray(keys).view(">u8")
    differ = words[1:] != words[:-1]
    first = differ.argmax(axis=1)
    at = np.arange(len(first))
    if not (differ.any(axis=1) & (words[1:][at, first] > words[:-1][at, first])).all():
        raise ValueError("positions are not in rising order")
    offset, n = index["offset"].astype(np.int64), index["n"].astype(np.int64)
    if (heap + offset + n * move.itemsize > len(data)).any() or (offset < 0).any():
        raise ValueError("moves beyond the end of the book")
    raw = np.frombuffer(data, np.uint8)
    for k in range(0, records, records_at_once):
        own = slice(k, k + records_at_once)
        count = n[own]
        of = np.repeat(np.arange(len(count)), count)
        seq = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        begin = heap + offset[own][of] + seq * move.itemsize
        found = raw[begin[:, None] + np.arange(move.itemsize)].copy().view(move)[:, 0] if len(of) else np.zeros(0, move)
        packed = [bytes(x) for x in keys[own]]
        yield pd.DataFrame({
            "packed": [packed[i] for i in of.tolist()], "ply": index["ply"][own][of].astype(np.int32), "seq": seq.astype(np.int32), "move16": found["move16"].astype(np.int32),
            "value": found["value"].astype(np.int32), "depth": found["depth"].astype(np.int32) if "depth" in move.names else 0,
        })


def encode_ybb(positions: list[tuple[bytes, int, list[tuple[str, int, int]]]], depths: bool = True) -> bytes:
    """K2: a binary book from (packed, ply, moves); duplicate positions and values out of range are errors."""
    move = YBB_MOVE_DEPTH if depths else YBB_MOVE
    index, heap = [], bytearray()
    positions = sorted(positions, key=lambda p: p[0])
    for (a, *_), (b, *_) in zip(positions, positions[1:], strict=False):
        if a == b:
            raise ValueError("duplicate position")
    for packed, ply, moves in positions:
        index.append(YBB_INDEX.pack(packed, len(heap), ply, len(moves)))
        for usi, value, depth in moves:
            heap += move.pack(codec.move16(usi), value, depth) if depths else move.pack(codec.move16(usi), value)
    return YBB_HEADER.pack(YBB_MAGIC, len(index), YBB_DEPTH_FLAG * depths) + b"".join(index) + bytes(heap)


def read_apery(spark: SparkSession, path: str) -> DataFrame:
    """(key, move16, count, score) of 16-byte records; key is the unsigned hash. Files split among tasks at records."""
    r = F.col("record")
    half = lambda at: little(r, at, 4).cast("decimal(20,0)")
    key = half(0) + half(4) * F.lit(1 << 32).cast("decimal(20,0)")
    return read_records(spark, path, APERY.size).select(
        key.cast("decimal(20,0)").alias("key"), little(r, 8, 2).alias("move16"), little(r, 10, 2).alias("count"), little(r, 12, 4, True).alias("score")
    )


def apery_rows(moves: DataFrame) -> DataFrame:
    """K9: (key, move16, count, score) in the order of an Apery book; counts stop at 65535."""
    return moves.select("key", "move16", saturated(F.col("count")).cast("int").alias("count"), "score").orderBy("key", F.col("count").desc())

"""Files in the domain's binary formats, written from data frames to any file system that Spark reads."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import codec
from tessera.sources import books, training

#: Bytes that the driver sends to a file at once.
CHUNK = 1 << 20


def write_file(spark: SparkSession, path: str, parts: Iterable[bytes], force: bool = False) -> None:
    """One file from bytes as they come: written beside its place and then renamed; an existing file is an error unless ``force``."""
    jvm = spark._jvm
    target, beside = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, path + ".tmp"))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not force and store.exists(target):
        raise FileExistsError(path)
    out = store.create(beside, True)
    try:
        held = bytearray()
        for part in parts:
            held += part
            if len(held) >= CHUNK:
                out.write(bytes(held))
                held.clear()
        out.write(bytes(held))
    finally:
        out.close()
    if force:
        store.delete(target, False)
    if not store.rename(beside, target):
        raise OSError(f"{beside} can't be renamed")


def bits(value: Column, size: int) -> Column:
    """A number as ``size`` little-endian bytes."""
    digits = F.lpad(F.hex(F.pmod(value.cast("bigint"), F.lit(1 << 8 * size))), 2 * size, "0")
    return F.unhex(F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size)))))


def write_records(records: DataFrame, path: str) -> None:
    """K3: a folder of files of fixed-size records, whose last byte is a padding zero, from (record), their other bytes.

    Tasks write side by side: a record goes out as a line of raw bytes, and the padding is the line's end.
    """
    records.select(F.col("record").cast("string")).write.option("lineSep", "\0").text(path)


def write_hcpe(rows: DataFrame, path: str) -> None:
    """K3: (hcp, eval, move16, result) as records of 38 bytes."""
    write_records(rows.select(F.concat("hcp", bits(F.col("eval"), 2), bits(F.col("move16"), 2), bits(F.col("result"), 1)).alias("record")), path)


def write_psv(rows: DataFrame, path: str) -> None:
    """K3: (sfen, score, move16, ply, result) as records of 40 bytes."""
    write_records(
        rows.select(F.concat("sfen", bits(F.col("score"), 2), bits(F.col("move16"), 2), bits(F.col("ply"), 2), bits(F.col("result"), 1)).alias("record")), path
    )


def write_apery(moves: DataFrame, path: str, force: bool = False) -> None:
    """K9: one Apery book, sorted by key, from (key, move16, count, score); counts stop at 65535. Rows stream through the driver."""
    key = F.col("key").cast("decimal(20,0)")
    low = F.when(key >= F.lit("9223372036854775808").cast("decimal(20,0)"), key - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(key).cast("bigint")
    digits = F.lpad(F.hex(low), 16, "0")
    first = F.unhex(F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8)))))
    rows = books.apery_rows(moves).select(F.concat(first, bits(F.col("move16"), 2), bits(F.col("count"), 2), bits(F.col("score"), 4)).alias("r"))
    write_file(moves.sparkSession, path, (bytes(r.r) for r in rows.toLocalIterator()), force)


def write_games(games: DataFrame, path: str, kind: str, force: bool = False) -> None:
    """K3: one file of ``hcpe3`` or ``pack`` games, in the order of the rows, which stream through the driver."""
    write_file(games.sparkSession, path, map(encoded(kind), games.toLocalIterator()), force)


def encoded(kind: str):
    def hcpe3(g) -> bytes:
        return training.encode_hcpe3(bytes(g.hcp), g.result, g.info, [(p["move16"], p["eval"], [(c["move16"], c["visits"]) for c in p["candidates"]]) for p in g.plies])

    def pack(g) -> bytes:
        return training.encode_pack(None if g.start is None else bytes(g.start), g.ply, g.result, g.reason, [(p["move16"], p["eval"]) for p in g.plies])

    return {"hcpe3": hcpe3, "pack": pack}[kind]


def write_ybb(moves: DataFrame, path: str, force: bool = False) -> None:
    """K2: one binary book, sorted by packed position, from (packed, ply, seq, move, value, depth).

    A position that has two plies is an error. Positions are sorted by Spark and stream through the driver twice, first for the index, then for the moves; the driver holds
    neither.
    """
    spark = moves.sparkSession
    item = F.struct("seq", "move", "value", "depth")
    grouped = moves.groupBy("packed").agg(F.min("ply").alias("ply"), F.max("ply").alias("top"), F.sort_array(F.collect_list(item)).alias("moves")).orderBy("packed")
    if (twice := grouped.where("ply <> top").limit(1).count()) or (n := grouped.count()) < 0:
        raise ValueError(f"duplicate position ({twice})")

    def index() -> Iterator[bytes]:
        at = 0
        for r in grouped.select("packed", "ply", F.size("moves").alias("n")).toLocalIterator():
            yield books.YBB_INDEX.pack(bytes(r.packed), at, r.ply, r.n)
            at += r.n * books.YBB_MOVE_DEPTH.size

    def heap() -> Iterator[bytes]:
        for r in grouped.select("moves").toLocalIterator():
            yield b"".join(books.YBB_MOVE_DEPTH.pack(codec.move16(m.move), m.value, m.depth) for m in r.moves)

    head = books.YBB_HEADER.pack(books.YBB_MAGIC, n, books.YBB_DEPTH_FLAG)
    write_file(spark, path, itertools.chain([head], index(), heap()), force)

"""Operators that need the rules: games into books, plies over legal moves, budgeted walks and candidate lists."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.rules import book_moves, successors
from tessera.functions.sfen import part, trim_ply
from tessera.plans.physical import checkpoint


def games_to_book(games: DataFrame, limit: int) -> DataFrame:
    """(key, move, ponder, move_count) of the first ``limit`` + 1 moves of each ``position`` line.

    The ponder of a move is the next one; a game's last move has none and is left out. Moves end at the first illegal one.
    Equal lines are counted and the rest are walked as a tree, a batch at a time, so that a batch sends a row for each of its positions and moves.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(0).drop_null().value_counts()
            lines = zip(found.field("values").to_pylist(), found.field("counts").to_pylist())
            columns = list(zip(*book_moves(lines, limit))) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64()))], ["sfen", "move", "ponder", "n"])

    pairs = games.select("position").mapInArrow(of, "sfen string, move string, ponder string, n bigint").withColumn("key", trim_ply(F.col("sfen")))
    return pairs.groupBy("key", "move").agg(F.min("ponder").alias("ponder"), F.sum("n").alias("move_count"))


def ply_labels(book: DataFrame, start: str, depth: int) -> DataFrame:
    """(key, level): the least number of legal moves from the start over positions that are in the book (key, without ply).

    Only new positions of a level are expanded, so each position's moves are made once.
    """
    spark = book.sparkSession
    keys = book.select("key").distinct()
    level = spark.createDataFrame([(start,)], "sfen string").select(trim_ply(F.col("sfen")).alias("key"), F.lit(0).alias("level"))
    out = level = checkpoint(level.join(keys, "key", "left_semi"))
    for k in range(1, depth + 1):
        reached = level.select(F.explode(successors(F.col("key"))).alias("s")).select(trim_ply(F.col("s.sfen")).alias("key")).distinct()
        level = checkpoint(reached.join(keys, "key", "left_semi").join(out, "key", "left_anti").withColumn("level", F.lit(k)))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out


def budgeted_walk(book: DataFrame, start: str, budget: int, depth: int) -> DataFrame:
    """(key, level) of the book's positions that legal moves reach by way of at most ``budget`` unregistered ones in a row.

    A registered position restores the budget; a position is expanded again only when it is reached with more budget left.
    """
    spark = book.sparkSession
    keys = book.select("key", F.lit(True).alias("known")).distinct()
    first = spark.createDataFrame([(start, budget)], "key string, left int").select(trim_ply(F.col("key")).alias("key"), "left")
    best = level = checkpoint(first.join(keys, "key", "left").withColumn("level", F.lit(0)))
    for k in range(1, depth + 1):
        x = level.select("left", F.explode(successors(F.col("key"))).alias("s")).select(trim_ply(F.col("s.sfen")).alias("key"), "left")
        x = x.groupBy("key").agg(F.max("left").alias("left")).join(keys, "key", "left")
        x = x.withColumn("left", F.when(F.col("known"), budget).otherwise(F.col("left") - 1)).where("left >= 0")
        seen = best.groupBy("key").agg(F.max("left").alias("seen"))
        level = checkpoint(x.join(seen, "key", "left").where("seen IS NULL OR left > seen").drop("seen").withColumn("level", F.lit(k)))
        if level.isEmpty():
            break
        best = best.unionByName(level)
    return best.where("known").groupBy("key").agg(F.min("level").alias("level"))


def leaf_children(book: DataFrame) -> DataFrame:
    """(key, move, child): legal moves of the book's positions that lead out of it."""
    x = book.select("key").distinct().select("key", F.explode(successors(F.col("key"))).alias("s"))
    x = x.select("key", F.col("s.move").alias("move"), trim_ply(F.col("s.sfen")).alias("child"))
    return x.join(book.select(F.col("key").alias("child")).distinct(), "child", "left_anti")


def pieces(sfen: Column) -> Column:
    """The number of pieces on the board and in hand."""
    board = F.length(F.regexp_replace(part(sfen, 0), "[^A-Za-z]", ""))
    hands = F.regexp_extract_all(part(sfen, 2), F.lit(r"(\d*)[A-Za-z]"), 1)
    return board + F.aggregate(hands, F.lit(0), lambda a, n: a + F.coalesce(n.try_cast("int"), F.lit(1)))


def is_handicap(sfen: Column, standard: Column) -> Column:
    """a start that isn't the standard one and has under 40 pieces."""
    return (trim_ply(sfen) != trim_ply(standard)) & (pieces(sfen) < 40)


def balanced_starts(moves: DataFrame, ply: int = 32, most: int = 50) -> DataFrame:
    """the positions at ``ply`` whose first move is worth at most ``most`` for either side."""
    first = moves.where(F.col("ply") == ply).groupBy("key").agg(F.min_by("value", "seq").alias("value"))
    return first.where((F.col("value") <= most) & (F.col("value") >= -most))


def prune_candidates(rows: DataFrame, by: str, width: int, diff: int) -> DataFrame:
    """candidate moves (by, move, score, legal, selected): illegal and repeated ones go, the ``width`` best stay and so does the selected one,
    and those over ``diff`` below the best go unless selected.
    """
    once = F.row_number().over(Window.partitionBy(by, "move").orderBy(F.col("selected").desc(), F.col("score").desc()))
    x = rows.where("legal").withColumn("p_once", once).where("p_once = 1").drop("p_once")
    w = Window.partitionBy(by)
    others = F.row_number().over(w.orderBy(F.col("selected").desc(), F.col("score").desc(), "move"))
    x = x.withColumns({"p_rank": others, "p_best": F.max("score").over(w)})
    keep = F.col("selected") | ((F.col("p_rank") <= width) & (F.col("p_best") - F.col("score") <= diff))
    return x.where(keep).drop("p_rank", "p_best")

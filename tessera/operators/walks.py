"""Walks that plan what to examine next: refuted moves, leaves that lead back, unsolved lines, and probes of a book."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import books, graph, windows
from tessera.plans.physical import small


def refuted_exits(edges: DataFrame, roots: DataFrame, old_best: DataFrame, turn: int, diff: int, depth: int, margin: int) -> DataFrame:
    """(node, dst, value, old_move): best moves out of the book that refute the old book's choice.

    ``pruned_bfs`` visits positions; of each, the first move counts if it leads to no position of the book, its depth is 0, and it beats the
    old best move, as the new book values both, by ``margin``. ``edges`` needs depth besides (src, dst, value, idx).
    """
    seen = graph.pruned_bfs(edges.drop("depth"), roots, turn, diff, depth).select("node")
    known = edges.select(F.col("src").alias("dst")).distinct()
    exits = edges.where("idx = 0 AND depth = 0").join(known, "dst", "left_anti").select(F.col("src").alias("key"), F.col("dst").alias("move"))
    new = edges.select(F.col("src").alias("key"), F.col("dst").alias("move"), "value")
    better = books.refutations(old_best, new, margin).join(exits, ["key", "move"], "left_semi")
    return better.join(seen.withColumnRenamed("node", "key"), "key", "left_semi").select(F.col("key").alias("node"), F.col("move").alias("dst"), "value", "old_move")


def rejoining_leaves(edges: DataFrame, roots: DataFrame, successors: DataFrame, turn: int, diff: int, depth: int) -> DataFrame:
    """(node): positions that ``pruned_bfs`` reaches, that have no move in the book, and from which a legal move (node, dst) leads back into it."""
    book = edges.select(F.col("src").alias("node")).distinct()
    found = graph.pruned_bfs(edges, roots, turn, diff, depth).select("node").join(book, "node", "left_anti")
    return graph.rejoin(found, successors, book)


def unsolved_lines(lines: DataFrame, edges: DataFrame, limit: int, steps: int, most_ply: int) -> DataFrame:
    """(line, ply, leaf): for each prefix of a line of positions, the leaf that best moves lead to.

    ``lines`` has (line, path), an array of positions from the root on. A prefix counts if its ply is under ``most_ply``, the book has a value for it and for the root, and its
    value has dropped by less than ``limit`` from the root's, as the root's side sees it. Prefixes whose walk repeats or takes too long have no row.
    """
    best = small(edges.where("idx = 0").select(F.col("src").alias("node"), "value"))
    each = lines.select("line", F.posexplode("path").alias("ply", "node")).join(best, "node")
    whole = each.join(each.where("ply = 0").select("line"), "line", "left_semi")
    kept = windows.eval_drop(whole.where(F.col("ply") < most_ply), "line", ["ply"], "ply", "value", limit)
    ends = graph.best_walk(edges, kept.select("node").distinct(), steps).where("node IS NOT NULL").select(F.col("root").alias("node"), F.col("node").alias("leaf"))
    return kept.join(ends, "node").select("line", "ply", "leaf")


def store_book(moves: DataFrame, path: str) -> None:
    """A book laid out for probes: Parquet sorted by key, so that a probe reads the row groups whose range holds the key."""
    moves.repartitionByRange("key").sortWithinPartitions("key").write.option("parquet.block.size", 8 << 20).parquet(path)


def probe(book: DataFrame, keys: list) -> DataFrame:
    """The rows of a few keys; the filter reaches the scan."""
    return book.where(F.col("key").isin(keys))


def probe_many(book: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of all keys of a frame: a semi-join, whose side is broadcast if a count shows that it is small."""
    return book.join(small(keys.select("key").distinct()), "key", "left_semi")


def mining_starts(lines: DataFrame, book: DataFrame, limit: int) -> DataFrame:
    """(line, ply, node, reason): where an engine is to begin on each line (line, path): the part of the mining walk that plans.

    A walk follows the line's positions. It needs the engine at the first one that the book (node, value) has no value for (``unknown``). It ends where the
    line leaves the book while a value beyond ``limit`` says that the game is ``decided``; a line followed to its end is extended from there (``end``).
    """
    known = book.where("value IS NOT NULL").groupBy("node").agg(F.max("value").alias("value"))
    x = lines.select("line", F.size("path").alias("n"), F.posexplode("path").alias("ply", "node")).join(known, "node", "left")
    x = x.withColumn("beyond", F.lead("value").over(Window.partitionBy("line").orderBy("ply")))
    last = F.col("ply") == F.col("n") - 1
    left = ~last & F.col("beyond").isNull() & (F.abs("value") > limit)
    x = x.withColumn("reason", F.when(F.col("value").isNull(), "unknown").when(left, "decided").when(last, "end")).where("reason IS NOT NULL")
    return x.groupBy("line").agg(F.min_by(F.struct("ply", "node", "reason"), "ply").alias("s")).select("line", "s.*")

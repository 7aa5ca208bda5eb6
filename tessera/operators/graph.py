"""Walks on the graph of positions: level by level, pruned by value, along best moves, and min-max."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.physical import checkpoint


def book_edges(moves: DataFrame, width: int) -> DataFrame:
    """(src, dst, value, idx): the ``width`` best moves of each position; idx counts from 0."""
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.col("value").desc(), "seq", "dst"))
    return moves.withColumn("r", rank).where(F.col("r") <= width).select("src", "dst", "value", (F.col("r") - 1).cast("int").alias("idx"))


def bfs(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """(node, level): the least number of moves from a root, up to ``depth``.

    One join, one distinct and one anti-join per level, each level checkpointed; only whether a level is empty reaches the driver.
    """
    out = level = checkpoint(roots.select("node").distinct().withColumn("level", F.lit(0)))
    steps = checkpoint(edges.select(F.col("src").alias("node"), "dst").distinct())
    for k in range(1, depth + 1):
        reached = level.join(steps, "node").select(F.col("dst").alias("node")).distinct()
        level = checkpoint(reached.join(out, "node", "left_anti").withColumn("level", F.lit(k)))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out


def leaves(edges: DataFrame, roots: DataFrame, depth: int) -> DataFrame:
    """Nodes reached within ``depth`` moves that have no move in the book."""
    return bfs(edges, roots, depth).join(edges.select(F.col("src").alias("node")), "node", "left_anti")


def pruned_bfs(edges: DataFrame, roots: DataFrame, turn: int, diff: int, depth: int) -> DataFrame:
    """G1: (node, level, path): the walk for one side, whose own moves are all those equal to the best.

    At the other side's turn moves count that are worth the root's best value, negated at each ply, less ``diff`` or more. A node counts where it is reached
    first; among paths of one length the least by root and move indexes, which is the order in which a first-in
    first-out walk visits. Leaves are nodes without moves.
    """
    edges = checkpoint(edges)
    best = edges.groupBy("src").agg(F.max("value").alias("best"))
    e = checkpoint(edges.join(best, "src").withColumnRenamed("src", "node"))
    root = roots.select("node", F.col("idx").alias("root_idx")).join(best.withColumnRenamed("src", "node"), "node", "left")
    level = checkpoint(root.select("node", F.lit(0).alias("level"), F.array(F.col("root_idx").cast("int")).alias("path"), F.coalesce("best", F.lit(0)).alias("root_best")))
    out = level
    for k in range(1, depth + 1):
        own = (k - 1) % 2 == turn
        bound = F.col("best") if own else F.col("root_best") - diff
        step = level.join(e, "node").where(F.col("value") >= bound)
        reached = step.select(F.col("dst").alias("node"), F.concat("path", F.array("idx")).alias("path"), (-F.col("root_best")).alias("root_best"))
        first = reached.groupBy("node").agg(F.min(F.struct("path", "root_best")).alias("m")).select("node", F.lit(k).alias("level"), "m.path", "m.root_best")
        level = checkpoint(first.join(out, "node", "left_anti"))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.select("node", "level", "path")


def best_walk(edges: DataFrame, roots: DataFrame, steps: int) -> DataFrame:
    """(root, node, length): follows each position's first move, to where there is none, it repeats, or ``steps`` are done.

    A repetition or too many steps give a null node.
    """
    first = checkpoint(edges.where("idx = 0").select(F.col("src").alias("node"), F.col("dst").alias("following")))
    walk = checkpoint(roots.select(F.col("node").alias("root"), "node", F.array("node").alias("seen"), F.lit(False).alias("done")))
    for _ in range(steps):
        x = walk.join(first, "node", "left")
        stop = F.col("done") | F.col("following").isNull() | F.col("node").isNull()
        again = F.array_contains("seen", F.col("following"))
        step = F.when(stop, F.col("node")).when(again, F.lit(None)).otherwise(F.col("following"))
        seen = F.when(stop | again, F.col("seen")).otherwise(F.array_append("seen", F.col("following")))
        walk = checkpoint(x.select("root", step.alias("node"), seen.alias("seen"), (stop | again).alias("done")))
    x = walk.join(first, "node", "left")
    done = F.col("done") | F.col("following").isNull()
    return x.select("root", F.when(done, F.col("node")).alias("node"), (F.size("seen") - 1).cast("bigint").alias("length"))


def minimax(edges: DataFrame, leaf_value: str, depth: int) -> DataFrame:
    """(node, value) after ``depth`` rounds of value(src) = max over moves of -value(dst).

    A move to a position that the last round has no value for keeps the value of the move itself. Bounded rounds define the result on cycles, which the reference
    leaves to an external engine.
    """
    e = checkpoint(edges.select("src", "dst", F.col(leaf_value).alias("own")))
    value = e.groupBy("src").agg(F.max("own").alias("value"))
    for k in range(depth):
        below = value.select(F.col("src").alias("dst"), F.col("value").alias("below"))
        value = e.join(below, "dst", "left").groupBy("src").agg(F.max(F.coalesce(-F.col("below"), F.col("own"))).alias("value"))
        if k % 4 == 3:
            value = checkpoint(value)
    return value.select(F.col("src").alias("node"), "value")


def rejoin(leaf_nodes: DataFrame, successors: DataFrame, book: DataFrame) -> DataFrame:
    """The leaves any of whose successors (node, dst) is in the book (node)."""
    back = successors.join(book.select(F.col("node").alias("dst")).distinct(), "dst", "left_semi").select("node")
    return leaf_nodes.join(back, "node", "left_semi")


def child_ponder(edges: DataFrame) -> DataFrame:
    """Each move with the first move of the position that it leads to."""
    first = edges.where("idx = 0").select(F.col("src").alias("dst"), F.col("dst").alias("ponder"))
    return edges.join(first, "dst", "left").select("src", "dst", "idx", "ponder")

"""Opening books: move lists per position (key), with a total order ``seq`` of the moves as they were read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sfen import flip_move, flip_sfen


def merge_duplicates(moves: DataFrame) -> DataFrame:
    """A1/A3: one row per (key, move): value and depth of the last by ``seq``, counts added, the slot of the first.

    ``seq`` must be a total order within a key and move. Each column has an aggregate of its own: buffers of plain numbers keep this a hash
    aggregate, where a struct would make Spark sort the rows first.
    """
    return moves.groupBy("key", "move").agg(
        F.max_by("value", "seq").alias("value"), F.max_by("depth", "seq").alias("depth"), F.sum("move_count").cast("bigint").alias("move_count"), F.min("seq").alias("slot")
    )


def positions(moves: DataFrame) -> DataFrame:
    """(key, moves): the merged moves of each position as an array in list order."""
    item = F.struct("slot", "move", "value", "depth", "move_count")
    return merge_duplicates(moves).groupBy("key").agg(F.sort_array(F.collect_list(item)).alias("moves"))


def merge_books(left: DataFrame, right: DataFrame) -> DataFrame:
    """(key, chosen, moves) from two books (key, moves): the deeper first move, then the longer list, then the left one.

    An empty or missing list loses. Catalyst plans the full outer join as a sort-merge join on key.
    """
    a, b = left.select("key", F.col("moves").alias("a")), right.select("key", F.col("moves").alias("b"))
    x = a.join(b, "key", "full_outer")
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    x = x.withColumns({"na": F.greatest(size(F.col("a")), F.lit(0)), "nb": F.greatest(size(F.col("b")), F.lit(0))})
    depth = lambda c: F.when(F.col("n" + c) > 0, F.col(c)[0]["depth"])
    right_wins = (
        F.when(F.col("nb") == 0, False).when(F.col("na") == 0, True)
        .when(depth("b") != depth("a"), depth("b") > depth("a")).otherwise(F.col("nb") > F.col("na"))
    )
    chosen = F.when(right_wins, "right").otherwise("left")
    return x.select("key", chosen.alias("chosen"), F.when(right_wins, F.col("b")).otherwise(F.col("a")).alias("moves"))


def merge_sides(black: DataFrame, white: DataFrame, side: Column) -> DataFrame:
    """Positions with Black to move from the first book and with White to move from the second, merged."""
    return merge_books(black.where(side == "b"), white.where(side == "w"))


def merge_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """U4: how many keys are in both books, only in the left and only in the right."""
    x = left.select("key", F.lit(1).alias("a")).join(right.select("key", F.lit(1).alias("b")), "key", "full_outer")
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias
    a, b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return x.agg(count(a & b)("same"), count(a & ~b)("only_left"), count(~a & b)("only_right"))


def least_ply(rows: DataFrame, base: str, ply: str) -> DataFrame:
    """A2: the rows of each base position that have its least ply."""
    return rows.withColumn("b_least", F.min(ply).over(Window.partitionBy(base))).where(F.col(ply) == F.col("b_least")).drop("b_least")


def best_move(moves: DataFrame) -> DataFrame:
    """The move of the greatest value, the first of equals; positions without any value have no row."""
    best = F.max_by(F.struct("move", "value", "depth"), F.struct("value", -F.col("seq"), -F.col("move")))
    return moves.where("value IS NOT NULL").groupBy("key").agg(best.alias("m")).select("key", "m.move", "m.value", "m.depth")


def within_window(moves: DataFrame, diff: int) -> DataFrame:
    """the moves whose value is at least the position's best less ``diff``; null values never are."""
    best = F.max("value").over(Window.partitionBy("key"))
    return moves.withColumn("b_best", best).where(F.col("value") >= F.col("b_best") - diff).drop("b_best")


def break_ties(moves: DataFrame) -> DataFrame:
    """Values in falling order (by seq among equals), all that equal the best but the first less one."""
    w = Window.partitionBy("key")
    rank = F.row_number().over(w.orderBy(F.col("value").desc(), "seq", "move"))
    tied = (F.col("value") == F.max("value").over(w)) & (F.col("rank") > 1)
    return moves.withColumn("rank", rank).withColumn("value", F.col("value") - F.when(tied, 1).otherwise(0))


def newest_wins(runs: DataFrame, keys: list[str], newest: str) -> DataFrame:
    """Of the rows of each key the one of the newest run; a key has one row in a run."""
    return runs.groupBy(*keys).agg(*(F.max_by(c, newest).alias(c) for c in runs.columns if c not in keys))


def update_known(old: DataFrame, new: DataFrame) -> DataFrame:
    """New moves are added; of known moves value and depth are overwritten where the new value isn't null."""
    a = old.select("key", "move", F.col("value").alias("v0"), F.col("depth").alias("d0"), F.lit(True).alias("old"))
    b = new.select("key", "move", F.col("value").alias("v1"), F.col("depth").alias("d1"))
    take = F.col("old").isNull() | F.col("v1").isNotNull()
    return a.join(b, ["key", "move"], "full_outer").select(
        "key", "move", F.when(take, F.col("v1")).otherwise(F.col("v0")).alias("value"), F.when(take, F.col("d1")).otherwise(F.col("d0")).alias("depth")
    )


def refutations(old_best: DataFrame, new_moves: DataFrame, margin: int) -> DataFrame:
    """Moves of the new book that beat the old book's best move, as the new book values both, by ``margin``."""
    reference = old_best.select("key", F.col("move").alias("old_move")).join(
        new_moves.select("key", F.col("move").alias("old_move"), F.col("value").alias("old_value")), ["key", "old_move"]
    )
    x = new_moves.join(reference, "key")
    return x.where((F.col("move") != F.col("old_move")) & (F.col("value") - F.col("old_value") >= margin)).select(
        "key", "move", "value", "old_move", "old_value"
    )


def canonical(key: Column) -> Column:
    """One name for a position and its image with colours swapped; right where a book holds one of the two at most."""
    return F.least(key, flip_sfen(key))


def flip_lookup(keys: DataFrame, book: DataFrame) -> DataFrame:
    """(key, found, flipped, moves): the key as it is, else its flipped image, whose moves are flipped back."""
    direct = book.select("key", F.col("moves").alias("direct"))
    image = book.select(F.col("key").alias("image"), F.col("moves").alias("imaged"))
    x = keys.join(direct, "key", "left").withColumn("image", flip_sfen(F.col("key"))).join(image, "image", "left")
    back = F.transform("imaged", lambda m: m.withField("move", flip_move(m["move"])))
    use = F.col("direct").isNull() & F.col("imaged").isNotNull()
    return x.select("key", (F.col("direct").isNotNull() | use).alias("found"), use.alias("flipped"), F.coalesce("direct", F.when(use, back)).alias("moves"))


def merge_flipped(moves: DataFrame) -> DataFrame:
    """Positions that are images of each other become one, named by the first inserted; null values are filled.

    Here depth travels with the value and ply is the least of both, which the reference loses (a defect that isn't copied).
    """
    node = canonical(F.col("key"))
    first = F.min_by("key", "seq").over(Window.partitionBy("node"))
    named = moves.withColumn("node", node).withColumn("name", first)
    own = F.when(F.col("name") == F.col("key"), F.col("move")).otherwise(flip_move(F.col("move")))
    best = F.min_by(F.struct("value", "depth"), F.struct(F.col("value").isNull(), F.col("seq")))
    return named.withColumn("move", own).groupBy("name", "move").agg(best.alias("v"), F.min("seq").alias("seq")).select(
        F.col("name").alias("key"), "move", "v.value", "v.depth", "seq"
    )


def frontier(children: DataFrame) -> DataFrame:
    """The least ply of each child position (key, ply); ply 0 counts as 1, and images are one position."""
    return children.groupBy(canonical(F.col("key")).alias("key")).agg(F.min(F.greatest("ply", F.lit(1))).alias("ply"))


def saturated(count: Column) -> Column:
    """K9: a move count as 16 unsigned bits."""
    return F.least(count, F.lit(65535))


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df``, failing at run time if a key occurs twice."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    check = F.when(F.col("b_n") > 1, F.raise_error(F.concat(F.lit("duplicate key "), F.concat_ws(",", *keys)))).otherwise(F.lit(True))
    return df.withColumn("b_n", n).where(check).drop("b_n")

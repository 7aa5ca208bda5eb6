"""Window-shaped operators: rankings, apportionment, carry-forward, islands and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_softmax(df: DataFrame, by: str, score: str, order: Sequence[Column | str], k: int) -> DataFrame:
    """The k best rows of each group and their softmax over those, as a probability and as 16 bits."""
    best = Window.partitionBy(by).orderBy(F.col(score).desc(), *order)
    x = df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    w = Window.partitionBy(by)
    e = F.exp(F.col(score) - F.max(score).over(w))
    x = x.withColumn("e", e).withColumn("prob", F.col("e") / F.sum("e").over(w)).drop("e")
    return x.withColumn("u16", F.floor(F.round(F.col("prob"), 9) * 65535).cast("int"))


def apportion(df: DataFrame, by: str, score: str, order: Sequence[Column | str], total: int, temperature: float) -> DataFrame:
    """``total`` visits shared by softmax of score / temperature: one each, then by largest remainders, 65535 at most.

    A temperature of zero or less gives everything to the first of the best.
    """
    w, n = Window.partitionBy(by), F.count(F.lit(1)).over(Window.partitionBy(by))
    if temperature <= 0:
        best = F.row_number().over(w.orderBy(F.col(score).desc(), *order))
        return df.withColumn("visits", F.when(best == 1, F.least(F.lit(total), F.lit(65535))).otherwise(0).cast("bigint"))
    e = F.exp((F.col(score) - F.max(score).over(w)) / temperature)
    x = df.withColumns({"e": e, "n": n}).withColumn("share", F.round(F.col("e") / F.sum("e").over(w) * F.greatest(total - F.col("n"), F.lit(0)), 9))
    x = x.withColumns({"whole": F.floor("share"), "frac": F.col("share") - F.floor("share")})
    rest = F.greatest(total - F.col("n"), F.lit(0)) - F.sum("whole").over(w)
    place = F.row_number().over(w.orderBy(F.round("frac", 6).desc(), *order))
    x = x.withColumns({"rest": rest, "place": place})
    visits = F.least(1 + F.col("whole") + F.when(F.col("place") <= F.col("rest"), 1).otherwise(0), F.lit(65535))
    return x.withColumn("visits", visits.cast("bigint")).drop("e", "n", "share", "whole", "frac", "rest", "place")


def carry_forward(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], columns: Sequence[str], reset: Column | None = None) -> DataFrame:
    """Each column's last value that isn't null, up to the row; where ``reset`` holds, a new stretch begins."""
    keys = list(by)
    x = df
    if reset is not None:
        x = x.withColumn("w_part", F.sum(reset.cast("int")).over(Window.partitionBy(*keys).orderBy(*order)))
        keys = [*keys, "w_part"]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return x.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns}).drop("w_part")


def islands(df: DataFrame, by: Sequence[str], index: str) -> DataFrame:
    """(by, first, last, n): runs of consecutive indexes."""
    gap = F.col(index) - F.row_number().over(Window.partitionBy(*by).orderBy(index))
    x = df.select(*by, index).distinct().withColumn("w_gap", gap)
    return x.groupBy(*by, "w_gap").agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count(F.lit(1)).alias("n")).drop("w_gap")


def pending(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], is_move: Column, value: str) -> DataFrame:
    """The move rows with their own value, else the last one given on a line since the move before."""
    w = Window.partitionBy(*by).orderBy(*order)
    moves_before = F.coalesce(F.sum(is_move.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    x = df.withColumns({"w_move": is_move, "w_group": moves_before})
    held = F.last(value, ignorenulls=True).over(Window.partitionBy(*by, "w_group").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return x.withColumn(value, held).where("w_move").drop("w_move", "w_group")


def rolling_rate(events: DataFrame, by: str, at: str, minutes: int) -> DataFrame:
    """Each event with the number of its group's events in the ``minutes`` up to it, itself and ties included."""
    seconds = F.unix_micros(F.col(at).cast("timestamp"))
    w = Window.partitionBy(by).orderBy(seconds).rangeBetween(-minutes * 60_000_000, 0)
    return events.withColumn("recent", F.count(F.lit(1)).over(w))


def tumbling_counts(events: DataFrame, at: str, minutes: int) -> DataFrame:
    """(start, n): events in each stretch of ``minutes``."""
    return events.groupBy(F.window(at, f"{minutes} minutes").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def latest(df: DataFrame, by: str, order: str) -> DataFrame:
    """The row of the greatest ``order`` of each group, which no other row of it has."""
    return df.groupBy(by).agg(*(F.max_by(c, order).alias(c) for c in df.columns if c != by))


def prefixes(df: DataFrame, moves: str) -> DataFrame:
    """Every prefix of a move list, the empty one and the whole included, with its length as ``ply``."""
    n = F.explode(F.sequence(F.lit(0), F.size(moves)))
    return df.withColumn("ply", n).withColumn("prefix", F.slice(F.col(moves), 1, F.col("ply")))


def eval_drop(df: DataFrame, by: str, order: Sequence[Column | str], ply: str, value: str, limit: int) -> DataFrame:
    """The rows whose value, seen from the side of the group's first row, is less than ``limit`` below that row's."""
    w = Window.partitionBy(by).orderBy(*order)
    sign = F.when((F.col(ply) - F.first(ply).over(w)) % 2 == 0, 1).otherwise(-1)
    x = df.withColumn("w_drop", F.first(value).over(w) - F.col(value) * sign)
    return x.where(F.col("w_drop") < limit).drop("w_drop")


def pairs(df: DataFrame, by: str, order: Sequence[Column | str], value: str, name: str) -> DataFrame:
    """Each row with the next row's value; a group's last row is left out."""
    following = F.lead(value).over(Window.partitionBy(by).orderBy(*order))
    last = F.row_number().over(Window.partitionBy(by).orderBy(*order)) == F.count(F.lit(1)).over(Window.partitionBy(by))
    return df.withColumns({name: following, "w_last": last}).where("NOT w_last").drop("w_last")


def first_occurrence(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of each key by ``order``, which is unique; a partial aggregate, so copies of one key don't meet in one task."""
    return df.groupBy(*keys).agg(*(F.min_by(c, order).alias(c) for c in df.columns if c not in keys))

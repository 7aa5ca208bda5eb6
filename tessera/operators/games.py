"""Games: filters on players, dates and evaluations, semi-joins on ratings, and win-rate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sfen import elo
from tessera.plans.physical import checkpoint, small


def eval_below(df: DataFrame, limit: int, value: str = "value") -> DataFrame:
    """drops abs(value) >= limit; the range form is pushed into the scan, which abs() is not."""
    return df.where((F.col(value) < limit) & (F.col(value) > -limit))


def drop_draws(df: DataFrame, result: str = "winner", draw: int = 2) -> DataFrame:
    """F2."""
    return df.where(F.col(result) != draw)


def names_match(both: Sequence[str], either: Sequence[str], black: Column, white: Column) -> Column:
    """patterns, in any case, of which one fits both players, or another list's fits either; no patterns fit all."""
    b, w = F.lower(black), F.lower(white)
    if not both and not either:
        return F.lit(True)
    any_of = lambda c, ps: F.coalesce(c.rlike("|".join(f"(?:{p.lower()})" for p in ps)), F.lit(False)) if ps else F.lit(False)
    return (any_of(b, both) & any_of(w, both)) | any_of(b, either) | any_of(w, either)


def played_between(at: Column, day: Column, start: str, end: str) -> Column:
    """a time after ``start`` 00:00 and up to 00:00 of the day after ``end``, or a day from start to end; neither known fails."""
    first, last = F.lit(start).cast("timestamp_ntz"), F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz")
    by_time = (at > first) & (at <= last)
    return F.coalesce(F.when(at.isNotNull(), by_time).otherwise(day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))), F.lit(False))


def event_year(path: Column) -> Column:
    """the year that a path's event name stands for: wdoorYYYY, wcscN (1989+N up to 5, then 1990+N), wcso1; else null."""
    n = F.regexp_extract(path, r"(?i)wcsc(\d+)", 1).try_cast("int")
    return (
        F.when(path.rlike(r"(?i)wdoor\d{4}"), F.regexp_extract(path, r"(?i)wdoor(\d{4})", 1).try_cast("int"))
        .when(n.isNotNull(), F.when(n <= 5, 1989 + n).otherwise(1990 + n)).when(path.rlike("(?i)wcso1"), 2020)
    )


def both_rated(least: float, black: Column, white: Column) -> Column:
    """F7."""
    return F.coalesce((black >= least) & (white >= least), F.lit(False))


def reversals(evals: DataFrame, bound: int) -> DataFrame:
    """F8: games in which a side's value was at or beyond +/-bound and later on the other side of zero.

    A row is held against the rows before it, of the same game and side.
    """
    before = Window.partitionBy("game", "side").orderBy("ply", "tie").rowsBetween(Window.unboundedPreceding, -1)
    x = evals.withColumns({"most": F.max("value").over(before), "least": F.min("value").over(before)})
    turned = ((F.col("most") >= bound) & (F.col("value") < 0)) | ((F.col("least") <= -bound) & (F.col("value") > 0))
    return x.where(turned).select("game").distinct()


def skip_reasons(df: DataFrame, reasons: Sequence[tuple[str, Column]]) -> DataFrame:
    """(reason, n): each row counts under the first reason that holds, or none (null)."""
    reason = F.coalesce(*(F.when(c, name) for name, c in reasons))
    return df.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def unpivot_players(games: DataFrame) -> DataFrame:
    """A row per player and colour, with won, drawn and lost as 0 or 1."""
    side = lambda c, k, own: F.struct(F.col(c).alias("player"), F.lit(k).alias("colour"), own.alias("won"), (F.lit(1) - own - F.col("d")).alias("lost"), F.col("d").alias("drawn"))
    x = games.withColumn("d", (F.col("winner") == 2).cast("int"))
    a, b = (F.col("winner") == 0).cast("int"), (F.col("winner") == 1).cast("int")
    return x.select("game", F.explode(F.array(side("black", "black", a), side("white", "white", b))).alias("p")).select("game", "p.*")


def colour_stats(games: DataFrame) -> DataFrame:
    """A4: games, wins, losses and draws of each player and colour."""
    return unpivot_players(games).groupBy("player", "colour").agg(
        F.count(F.lit(1)).alias("games"), *(F.sum(c).cast("bigint").alias(n) for c, n in (("won", "wins"), ("lost", "losses"), ("drawn", "draws")))
    )


def player_stats(games: DataFrame, matches) -> DataFrame:
    """A5: of the players whom ``matches(player)`` holds for: games (once each, even if both match), and results by seat."""
    seats = unpivot_players(games).where(matches(F.col("player")))
    return seats.agg(
        F.count_distinct("game").alias("matched_games"), *(F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("won", "wins"), ("lost", "losses"), ("drawn", "draws")))
    )


def best_ratings(games: DataFrame) -> DataFrame:
    """(player, best): the highest rating that a player ever had; players never rated have no row."""
    both = F.explode(F.array(F.struct(F.col("black").alias("player"), F.col("black_rate").alias("r")), F.struct(F.col("white").alias("player"), F.col("white_rate").alias("r"))))
    return games.select(both.alias("x")).where("x.r IS NOT NULL").groupBy("x.player").agg(F.max("x.r").alias("best"))


def rating_semi_join(games: DataFrame, both: float, loser: float, drawer: float, external: DataFrame | None = None) -> DataFrame:
    """Games of two players ever rated ``both``, or lost by one ever rated ``loser``, or drawn by one rated ``drawer``.

    Whether a player was ever rated so much is told by the highest rating, a partial aggregate that is made once and joined to each
    side. ``external`` (player, rate) adds ratings.
    """
    best = best_ratings(games)
    if external is not None:
        best = best.unionByName(external.select("player", F.col("rate").alias("best"))).groupBy("player").agg(F.max("best").alias("best"))
    best = small(checkpoint(best))
    x = games
    for side in ("black", "white"):
        x = x.join(best.select(F.col("player").alias(f"r_{side}"), F.col("best").alias(f"best_{side}")), F.col(side) == F.col(f"r_{side}"), "left")
    least = lambda side, n: F.coalesce(F.col(f"best_{side}") >= n, F.lit(False))
    lost = F.when(F.col("winner") == 0, least("white", loser)).when(F.col("winner") == 1, least("black", loser)).otherwise(False)
    drawn = (F.col("winner") == 2) & (least("black", drawer) | least("white", drawer))
    return x.where((least("black", both) & least("white", both)) | lost | drawn).select(games.columns)


def finalist_games(games: DataFrame, finalists: DataFrame) -> DataFrame:
    """Games of an event in which a finalist's name is part of either player's; equi-join on event, then containment."""
    f = finalists.select(F.col("event").alias("f_event"), F.col("name").alias("f_name"))
    hit = F.col("black").contains(F.col("f_name")) | F.col("white").contains(F.col("f_name"))
    return games.join(small(f), (F.col("event") == F.col("f_event")) & hit, "left_semi")


def win_rates(games: DataFrame, keys: Sequence[str], least: int = 10) -> DataFrame:
    """Wins, losses, draws, rate and Elo for all, each key and all keys together; sets under ``least`` games are left out."""
    sets = [(), *((k,) for k in keys), tuple(keys)]
    cube = games.groupingSets([[F.col(c) for c in s] for s in dict.fromkeys(sets)], *(F.col(k) for k in keys))
    won = lambda k: F.sum((F.col("winner") == k).cast("int")).cast("bigint")
    x = cube.agg(F.count(F.lit(1)).alias("games"), won(0).alias("wins"), won(1).alias("losses"), won(2).alias("draws"), F.grouping_id().cast("bigint").alias("level"))
    rate = F.col("wins") / F.nullif(F.col("wins") + F.col("losses"), F.lit(0))
    return x.where(F.col("games") >= least).select(*keys, "level", "games", "wins", "losses", "draws", F.round(rate, 6).alias("rate"), F.round(elo(F.col("wins"), F.col("losses")), 4).alias("elo"))


def trailing_rates(games: DataFrame, order: Sequence[Column], lengths: Sequence[int], by: str) -> DataFrame:
    """(by, n, wins, losses) over each group's last n games, for each n that the group has games for.

    One rank, then each row is counted in the windows that it lies in; windows come from an array literal, not a join.
    """
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    total = F.count(F.lit(1)).over(Window.partitionBy(by))
    x = games.withColumns({"rank": rank, "total": total}).where(F.col("rank") <= max(lengths))
    x = x.withColumn("n", F.explode(F.array(*map(F.lit, lengths)))).where("rank <= n AND n <= total")
    count = lambda k: F.sum((F.col("winner") == k).cast("int")).cast("bigint")
    return x.groupBy(by, "n").agg(count(0).alias("wins"), count(1).alias("losses"))


def value_or_mixed(df: DataFrame, by: str, value: Column) -> DataFrame:
    """A group's one value as text, or ``mixed``; null if it has none."""
    text = value.cast("string")
    return df.groupBy(by).agg(F.when(F.min(text) == F.max(text), F.min(text)).when(F.min(text).isNotNull(), "mixed").alias("value"))


def greatest_by(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The greatest of each nullable column per key; null only where all are."""
    return df.groupBy(key).agg(*(F.max(v).alias(v) for v in values))


def daily_counts(df: DataFrame, at: str) -> DataFrame:
    """Rows per day."""
    return df.groupBy(F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def gradient(steps: DataFrame, mobility: float) -> DataFrame:
    """Each parameter after its game pairs: v += shift * step * delta * mobility, held in its bounds at each step.

    The clamp makes order matter, so a parameter's steps are folded in order; without clamping a sum would do.
    """
    item = F.struct("seq", (F.col("shift") * F.col("step") * F.col("delta") * mobility).alias("d"))
    x = steps.groupBy("name").agg(F.first("v").alias("v"), F.first("least").alias("least"), F.first("most").alias("most"), F.sort_array(F.collect_list(item)).alias("items"))
    folded = F.aggregate("items", F.col("v").cast("double"), lambda a, i: F.least(F.greatest(a + i["d"], F.col("least")), F.col("most")))
    return x.select("name", folded.alias("v"))

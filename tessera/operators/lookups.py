"""Joins that look up names, parameters and configurations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def config_cross(*axes: DataFrame) -> DataFrame:
    """Every combination of the axes of a build configuration: short lists whose product is the wanted result."""
    out = axes[0]
    for axis in axes[1:]:
        out = out.crossJoin(axis)
    return out


def common_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """The names in both."""
    return left.intersect(right)


def assert_disjoint(left: DataFrame, right: DataFrame) -> None:
    """Fails and lists up to 20 names if both have any in common."""
    if found := [r[0] for r in common_names(left, right).limit(20).collect()]:
        raise ValueError(f"names in both: {', '.join(sorted(map(str, found)))}")


def upsert(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, state): new values over old ones; state is added, kept or changed."""
    a, b = old.select(key, F.col(value).alias("l_a"), F.lit(1).alias("l_x")), new.select(key, F.col(value).alias("l_b"), F.lit(1).alias("l_y"))
    state = F.when(F.col("l_x").isNull(), "added").when(F.col("l_y").isNull(), "kept").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, F.coalesce("l_b", "l_a").alias(value), state.alias("state"))


def attach(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """The columns of both by key; a key of either side has a row."""
    return rows.join(more, keys, "full_outer")


def duel_lookup(plies: DataFrame, own: DataFrame, opponent: DataFrame) -> DataFrame:
    """Each ply's moves from the own book at even plies and from the opponent's at odd ones; one join over both books."""
    both = own.withColumn("l_odd", F.lit(0)).unionByName(opponent.withColumn("l_odd", F.lit(1)))
    return plies.withColumn("l_odd", F.pmod("ply", F.lit(2))).join(both, ["key", "l_odd"], "left").drop("l_odd")


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """nulls of optional columns become the job's defaults."""
    return df.fillna(defaults)

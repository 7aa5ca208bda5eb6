"""Helpers that the training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.physical import checkpoint, shared_folder, small  # noqa: F401  (small is for the operators)

#: The characters that separate words: the space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

def words(text: Column) -> Column:
    """The words of a text as an array; a null or blank text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, even where ``body`` uses it inside a lambda.

    A plain column reference may be inlined by the optimizer into a lambda and so be computed for
    every array element; a lambda variable cannot.
    """
    return F.transform(F.array(value), body)[0]


def shingles(tokens: Column, width: int, of) -> Column:
    """``of(window)`` for each run of ``width`` consecutive tokens; none if there are fewer tokens."""
    return let(
        tokens,
        lambda ws: F.when(F.size(ws) < width, F.array().cast("array<string>") if of is None else None).otherwise(
            F.transform(F.sequence(F.lit(1), F.size(ws) - (width - 1)), lambda i: of(F.slice(ws, i, width)))
        ),
    )


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as compressed Parquet and read again: for wide rows, of which later reads may need few columns.

    The files go when the session ends.
    """
    spark = df.sparkSession
    place = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.option("compression", "zstd").parquet(place)
    return spark.read.parquet(place)


def set_aside(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with every column but the needed ones renamed to k0, k1 and so on, so that none clashes with names used on the way.

    ``toDF(*docs.columns)`` undoes it.
    """
    return docs.toDF(*(c if c in needed else f"k{k}" for k, c in enumerate(docs.columns)))


def spread_join(rows: DataFrame, side: DataFrame, on: str, weight: str, total: int) -> DataFrame:
    """``rows`` joined with ``side`` on the column ``on`` of both, where a value of ``on`` can stand in a large share of ``rows``.

    ``side`` has each value once, and in ``weight`` the number of its rows. Those of more than a fixed part of ``total`` rows are few, so they
    are broadcast and their rows stay where they are; all other rows are joined by a shuffle or as the planner sees fit.
    """
    parts = 8 * partitions(rows.sparkSession)
    hot = checkpoint(side.where(F.col(weight) > max(1, total // parts)))  # fewer than ``parts`` rows
    if hot.isEmpty():
        return rows.join(side.drop(weight), on)
    rest = rows.join(F.broadcast(hot.select(on)), on, "left_anti").join(side.where(F.col(weight) <= max(1, total // parts)).drop(weight), on)
    return rows.join(F.broadcast(hot.drop(weight)), on).unionByName(rest)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

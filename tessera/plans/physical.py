"""Strategies that several operators share: checkpoints, checked broadcasts and a distributed global rank."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its rows and their bytes have been counted and are no more than these.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, made from the session's ``spark.checkpoint.dir``.

    Only in a session on one machine, as in tests, may that be unset: then a temporary folder takes its place. On a cluster
    executors don't share such a folder, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not shared and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """A new folder's name in the shared folder, which goes when the session ends."""
    place = f"{shared_folder(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return place


def checkpoint(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by files in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: 8 for a number, its bytes for a string or binary, its JSON's for a nested column."""
    out = F.lit(16)
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        text = c if kind in ("string", "binary") else F.to_json(F.struct(c)) if kind in ("array", "struct", "map") else None
        out = out + (F.lit(8) if text is None else F.coalesce(F.octet_length(text), F.lit(0)) + 8)
    return out


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows and ``most`` bytes by count; otherwise the planner is left to choose."""
    t = df.limit(rows + 1).select(row_bytes(df).cast("bigint").alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).first()
    return F.broadcast(df) if t.n <= rows and (t.b or 0) <= most else df


def global_rank(df: DataFrame, by: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """``df`` with a gapless 1-based rank by ``by``, without a window over all rows in one task.

    Rows are range-partitioned and cut from their lineage, so that both uses see the same ranges; ranks within a
    range and the ranges' counts, a row per partition, make the rank. ``by`` should be a total order.
    """
    ordered = checkpoint(df.repartitionByRange(*by).withColumn("g_pid", F.spark_partition_id()))
    counts = ordered.groupBy("g_pid").agg(F.count(F.lit(1)).alias("g_n"))
    before = F.sum("g_n").over(Window.orderBy("g_pid").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("g_pid", F.coalesce(before, F.lit(0)).alias("g_start"))
    own = F.row_number().over(Window.partitionBy("g_pid").orderBy(*by))
    return (
        ordered.withColumn("g_own", own).join(F.broadcast(starts), "g_pid")
        .withColumn(name, (F.col("g_start") + F.col("g_own")).cast("bigint")).drop("g_pid", "g_own", "g_start")
    )

"""Rates and progress of event streams; the same functions run on a batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, schema: str = EVENTS, files_per_trigger: int = 1, pattern: str = "*") -> DataFrame:
    """New Parquet files of a folder as a stream, those whose names fit ``pattern``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("pathGlobFilter", pattern).parquet(path)


def timed(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, minutes: int = 10, late: str = "10 minutes") -> DataFrame:
    """(start, n): events of each stretch; events later than ``late`` behind the newest are dropped from a stream."""
    w = F.window("ts", f"{minutes} minutes")
    return timed(events).withWatermark("ts", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n")


def sliding(events: DataFrame, minutes: int = 10, every: int = 1, late: str = "10 minutes") -> DataFrame:
    """(start, n, rise): events and the rise of a counter in each sliding stretch; a counter that falls counts as restarted."""
    w = F.window("ts", f"{minutes} minutes", f"{every} minutes")
    rise = F.greatest(F.max("value") - F.min("value"), F.lit(0.0))
    return timed(events).withWatermark("ts", late).groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), rise.alias("rise")).select(F.col("w.start").alias("start"), "n", "rise")


def progress(events: DataFrame, job: str = "user_id", done_when: str = "event_type = 'purchase'") -> DataFrame:
    """(job, taken, done): each job's counts whenever they change; state is two numbers per job. ``done_when`` is SQL for the events that finish a task."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get if state.exists else (0, 0)
        taken, done = before
        for p in parts:
            taken += len(p)
            done += int(p["finished"].sum())
        if (taken, done) != before:
            state.update((taken, done))
            yield pd.DataFrame({"job": [key[0]], "taken": [taken], "done": [done]})

    marked = events.select(F.col(job).alias("job"), F.coalesce(F.expr(done_when), F.lit(False)).alias("finished"))
    return marked.groupBy("job").applyInPandasWithState(
        update, "job bigint, taken bigint, done bigint", "taken bigint, done bigint", "update", GroupStateTimeout.NoTimeout
    )


def deferrals(events: DataFrame, task: str, waits: str, limit: int = 1000) -> DataFrame:
    """T4: (task, deferred, given_up): how often each task was put back, and whether that is over the limit, after which it isn't queued again.

    ``waits`` is SQL for the events that put a task back. The same aggregate runs on a batch and, in update mode, on a stream.
    """
    n = F.sum(F.when(F.expr(waits), 1).otherwise(0)).cast("bigint")
    return events.groupBy(F.col(task).alias("task")).agg(n.alias("deferred"), (n > limit).alias("given_up"))


def requeued(events: DataFrame, task: str, waits: str, limit: int = 1000) -> DataFrame:
    """T4: the rows of a batch that put a task back and are queued again: the first ``limit`` of each task."""
    rank = F.row_number().over(Window.partitionBy(task).orderBy("ts", "event_id"))
    return events.where(waits).withColumn("turn", rank).where(F.col("turn") <= limit)


def snapshots(events: DataFrame, hours: int = 3, late: str = "10 minutes") -> DataFrame:
    """T5: (start, revision, changes): one snapshot for each stretch in which something changed, at its last revision; clean stretches have none."""
    w = F.window("ts", f"{hours} hours")
    out = timed(events).withWatermark("ts", late).groupBy(w.alias("w")).agg(F.max("event_id").alias("revision"), F.count(F.lit(1)).alias("changes"))
    return out.select(F.col("w.start").alias("start"), "revision", "changes")

"""Streams give what the batch gives."""

from tessera.operators.windows import tumbling_counts
from tessera.streaming import rates

EVENTS = "/root/testdata/sf0.001/events.parquet"


def drained(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None


def test_tumbling(spark, tmp_path):
    spark.read.parquet(EVENTS).repartition(4).write.parquet(str(tmp_path / "in"))
    drained(rates.tumbling(rates.event_stream(spark, str(tmp_path / "in"), files_per_trigger=100)), "tumbling", "complete")
    got = {(str(r.start), r.n) for r in spark.table("tumbling").collect()}
    assert got == {(str(r.start), r.n) for r in tumbling_counts(spark.read.parquet(EVENTS), "ts", 10).collect()}


def test_progress(spark, tmp_path):
    events = spark.read.parquet(EVENTS)
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    drained(rates.progress(rates.event_stream(spark, str(tmp_path / "in"))), "progress", "update")
    last = spark.table("progress").groupBy("job").agg({"taken": "max", "done": "max"})
    want = events.groupBy("user_id").count()
    assert {(r.job, r["max(taken)"]) for r in last.collect()} == {(r.user_id, r["count"]) for r in want.collect()}

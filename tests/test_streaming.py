"""Restart check: a stream stopped after part of its input and restarted from
its checkpoint gives the batch result (SURVEY §5, check 4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemart.operators import dedup
from pulsemart.session import work_dir
from pulsemart.sources import adapters as A
from pulsemart.sources.stream import replay, topic_stream
from pulsemart.sources.tables import Tables
from pulsemart.streaming.jobs import DAY_MS, build_dau_stream, run_available_now

SF = "/root/testdata/sf0.001"


def test_dau_stream_restart_equals_batch(spark):
    t = Tables(spark, SF)
    st = A.startup(t).withColumn("event_id", F.col("event_id").cast("string"))
    base = work_dir(spark, "test_restart", fresh=True)
    topic, ckpt, sink = f"{base}/topic", f"{base}/ckpt", f"{base}/sink"
    cols = ["mid", "uid", "area", "os", "vs", "ts", "event_id"]
    split = st.agg(F.min("ts")).first()[0] + 15 * DAY_MS
    replay(st.where(F.col("ts") < split), topic, "ts", 6, cols)

    def run():
        stream = build_dau_stream(topic_stream(spark, "TOPIC_STARTUP", topic, max_per_trigger=2))
        run_available_now(stream.select("mid", "logdate"), ckpt, sink)

    run()
    first = spark.read.parquet(sink).count()
    replay(st.where(F.col("ts") >= split), topic, "ts", 6, cols)
    run()  # restart from the checkpoint: only the new files are read
    got = {tuple(r) for r in spark.read.parquet(sink).collect()}
    want = {tuple(r) for r in dedup.dau_table(A.startup(t)).select("mid", "logdate").collect()}
    assert 0 < first < len(want)
    assert got == want
    assert spark.read.parquet(sink).count() == len(want)  # no duplicates across the restart


def test_processing_time_dau_job_over_arriving_files(spark):
    """W4 + O3 + S4: the DAU job on a processing-time trigger while files
    arrive in two waves; the stored table holds each device-day once."""
    from pulsemart.sources import sinks
    from pulsemart.sources.stream import publish
    from pulsemart.streaming.jobs import build_startup_stream, dau_batch_writer, start_processing_time

    t = Tables(spark, SF)
    st = A.startup(t).withColumn("event_id", F.col("event_id").cast("string"))
    base = work_dir(spark, "test_processing_time", fresh=True)
    topic, ckpt, table = f"{base}/topic", f"{base}/ckpt", f"{base}/table"
    cols = ["mid", "uid", "area", "os", "vs", "ts", "event_id"]
    split = st.agg(F.min("ts")).first()[0] + 15 * DAY_MS
    publish(st.where(F.col("ts") < split), topic, cols)
    stream = build_startup_stream(topic_stream(spark, "TOPIC_STARTUP", topic, max_per_trigger=2)).drop("event_time")
    q = start_processing_time(stream, ckpt, foreach_batch=dau_batch_writer(table), interval="1 second")
    try:
        q.processAllAvailable()
        first = sinks.read_dau_table(spark, table).count()
        publish(st.where(F.col("ts") >= split), topic, cols)
        q.processAllAvailable()
    finally:
        q.stop()
    assert q.exception() is None
    stored = sinks.read_dau_table(spark, table).select("mid", "logdate")
    want = {tuple(r) for r in dedup.first_seen(A.startup(t)).select("mid", "logdate").collect()}
    assert 0 < first < len(want)
    assert {tuple(r) for r in stored.collect()} == want
    assert stored.count() == len(want)

"""What grows with the tables: sides of joins, topics and the files of a stream."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from pulsemart.operators import join
from pulsemart.session import work_dir
from pulsemart.sources import adapters as A
from pulsemart.sources import stream
from pulsemart.sources.tables import Tables
from pulsemart.streaming import jobs


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def _files(path: str) -> list[str]:
    return sorted(f"{d}/{x}" for d, _, names in os.walk(_local(path)) for x in names if x.startswith("part-"))


def _bytes(path: str) -> int:
    return sum(map(os.path.getsize, _files(path)))


def _lines_and_parts(spark, parts: int) -> Tables:
    base = work_dir(spark, "test_at_size", fresh=True)
    name = F.concat(F.lit("large ring "), (F.col("id") % 7).cast("string"), F.lit(" of a name that packs well"))
    spark.range(parts).select(F.col("id").alias("p_partkey"), name.alias("p_name")).write.parquet(f"{base}/part.parquet")
    lines = [(1, 1, 1, 1, 2.0, 3.5), (1, 2, 1, 2, 1.0, 4.5), (2, None, 1, 1, 1.0, 5.5), (2, parts + 1, 1, 2, 1.0, 6.5)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double")
    lines.withColumn("l_shipdate", F.to_timestamp(F.lit("2024-01-01"))).write.parquet(f"{base}/lineitem.parquet")
    return Tables(spark, base)


def test_a_part_table_larger_than_its_files_is_not_broadcast(spark):
    """Its files are under the bound, its rows in the driver's memory are not."""
    t = _lines_and_parts(spark, 1_000_000)
    assert _bytes(f"{t.sf_dir}/part.parquet") < join.BROADCAST_MAX_BYTES < join.measured_bytes(t.part)
    lines = A.order_detail(t)
    assert "BroadcastExchange" not in _plan(lines) and "SortMergeJoin" in _plan(lines)
    names = [r.sku_name and r.sku_name[:12] for r in lines.collect()]
    assert sorted(n or "" for n in names) == ["", "", "large ring 1", "large ring 2"]


def test_a_small_part_table_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(A.order_detail(_lines_and_parts(spark, 100)))


def test_a_larger_topic_has_more_files_in_event_time_order(spark, monkeypatch):
    monkeypatch.setattr(jobs, "REPLAY_RECORDS", 100)
    topic = work_dir(spark, "test_topic", fresh=True) + "/topic"
    rows = spark.range(2000).select((F.col("id") * 7 % 2000).alias("ts"), F.lit("the same text again").alias("v"))
    values = jobs._replayed(rows, topic, "TOPIC_STARTUP", "ts", 2000)
    sink = work_dir(spark, "test_topic", fresh=True)
    batches = []

    def write(batch, batch_id):
        ts = F.get_json_object("value", "$.ts").cast("long")
        batches.append(batch.agg(F.min(ts).alias("a"), F.max(ts).alias("z"), F.count("*").alias("n")).first())

    jobs.run_available_now(values, f"{sink}/checkpoint", foreach_batch=write)
    assert len(_files(topic)) > jobs.REPLAY_FILES and len(batches) == 3
    assert sum(b.n for b in batches) == 2000 and all(x.z < y.a for x, y in zip(batches, batches[1:]))


def test_topics_are_packed_and_read_back_whole(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("string").alias("id"), F.lit("order_info").alias("table_name"), F.col("id").alias("ts"))
    text = rows.agg(F.sum(F.length(F.to_json(F.struct(*rows.columns))))).first()[0]
    base = work_dir(spark, "test_packed", fresh=True)
    stream.publish(rows, f"{base}/a", records_per_file=3000)
    stream.replay(rows, f"{base}/b", "ts", 4)
    for topic in (f"{base}/a", f"{base}/b"):
        assert _bytes(topic) < text / 4
        assert spark.read.json(topic).agg(F.count("*"), F.countDistinct("id")).first()[:] == (20_000, 20_000)


def test_a_routed_stream_leaves_packed_topics(spark):
    changes = spark.range(5000).select(
        F.lit("shop").alias("schema_name"), F.lit("order_info").alias("table_name"), F.lit("ROWDATA").alias("kind"),
        F.lit("INSERT").alias("op"), F.create_map(F.lit("id"), F.col("id").cast("string")).alias("after"), F.col("id").alias("seq"))
    base = work_dir(spark, "test_routed", fresh=True)
    stream.publish(changes, f"{base}/topic", value=F.to_json(F.struct(*changes.columns)))
    routed = jobs.build_route_stream(stream.topic_stream(spark, "CHANGES", f"{base}/topic"))
    jobs.run_available_now(routed, f"{base}/checkpoint", f"{base}/sink", partition_by=["topic"], fmt="json")
    back = spark.read.schema("key string, value string, topic string").json(f"{base}/sink")
    assert {r.key for r in back.collect()} == {str(i) for i in range(5000)}
    text = back.agg(F.sum(F.length(F.to_json(F.struct("key", "value"))))).first()[0]
    assert _bytes(f"{base}/sink") < text / 4

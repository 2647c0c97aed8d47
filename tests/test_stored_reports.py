"""Day reports prune folders, streams keep every row, named sources are used or fail."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulsemart.functions.dates import with_log_date_hour
from pulsemart.operators import dedup
from pulsemart.operators.join import measured_bytes
from pulsemart.session import work_dir
from pulsemart.sources import adapters as A
from pulsemart.sources import sinks
from pulsemart.sources.stream import publish, replay, topic_stream
from pulsemart.sources.tables import Tables
from pulsemart.streaming.jobs import build_sale_detail_stream, run_available_now

SF = "/root/testdata/sf0.001"
T0 = 1_704_067_200_000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_reports_prune_partitions(spark):
    t = Tables(spark, SF)
    base = work_dir(spark, "test_day_reports", fresh=True)
    sinks.write_dau_rows(dedup.dau_table(A.startup(t)), f"{base}/dau")
    sinks.write_order_rows(A.purchases(t), f"{base}/orders")
    for df in (sinks.read_dau_table(spark, f"{base}/dau", ["2024-01-10"]),
               sinks.read_order_table(spark, f"{base}/orders", ["2024-01-10"])):
        assert "PartitionFilters: [isnotnull" in _plan(df) or "PartitionFilters: [(cast" in _plan(df)
        assert 0 < len(df.inputFiles())
        assert df.count() > 0


def test_replay_keeps_rows_without_a_time(spark):
    path = work_dir(spark, "test_replay_null", fresh=True) + "/topic"
    rows = spark.createDataFrame([("a", T0), ("b", None), ("c", T0 + 86_400_000)], "id string, ts long")
    assert replay(rows, path, "ts", 3) == 3
    assert spark.read.text(path).count() == 3


def test_replay_is_one_job_in_event_time_order(spark):
    """Files follow each other in time, by their dates too, and a second replay's files
    come after the first one's."""
    path = work_dir(spark, "test_replay_order", fresh=True) + "/topic"
    rows = spark.range(1000).select(F.pmod(F.col("id") * 7919, F.lit(500)).alias("ts"))
    replay(rows, path, "ts", 5)
    replay(rows.withColumn("ts", F.col("ts") + 500), path, "ts", 4)
    files = spark.read.text(path).select(
        F.get_json_object("value", "$.ts").cast("long").alias("ts"), F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_name").alias("f"))
    spans = files.groupBy("f").agg(F.min("ts").alias("a"), F.max("ts").alias("z"), F.min("at").alias("at")).orderBy("at").collect()
    assert len(spans) == 9
    assert all(x.z <= y.a and x.at < y.at for x, y in zip(spans, spans[1:]))


def test_publish_scans_once_and_cuts_files(spark):
    path = work_dir(spark, "test_publish", fresh=True) + "/topic"
    publish(spark.range(100).repartition(1), path, records_per_file=10)
    read = spark.read.text(path)
    assert read.count() == 100 and len(read.inputFiles()) == 10


def test_a_named_cluster_is_used_or_fails(spark):
    path = work_dir(spark, "test_named", fresh=True)
    with pytest.raises(ValueError):
        topic_stream(spark, "t")
    with pytest.raises(ValueError):
        topic_stream(spark, "t", path=path, bootstrap="nowhere:1")
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_stream(spark, "t", bootstrap="nowhere:1")


def test_no_round_robin_shuffle_over_scans(spark):
    assert "RoundRobin" not in _plan(Tables(spark, "/root/testdata/sf0.1").lineitem)


def test_first_seen_without_event_ids(spark):
    rows = [("a", T0 + 5, None), ("a", T0, None), ("a", T0, 3), ("b", T0, 7), ("b", T0, 2)]
    startup = with_log_date_hour(spark.createDataFrame(rows, "mid string, ts long, event_id long"))
    got = {r.mid: (r.ts, r.event_id, r.loghour) for r in dedup.first_seen(startup).collect()}
    table = {r.mid: (r.ts, r.event_id, r.loghour) for r in dedup.dau_table(startup).collect()}
    assert got == table == {"a": (T0, None, "00"), "b": (T0, 2, "00")}


def test_measured_bytes_counts_utf8(spark):
    a = measured_bytes(spark.createDataFrame([("a" * 10,)], "s string"))
    b = measured_bytes(spark.createDataFrame([("é" * 10,)], "s string"))
    assert b - a == 10


@pytest.mark.parametrize("salts", [1, 4])
def test_a_hot_order_joins_all_its_lines(spark, salts):
    """One order holds a third of the lines; its salted copies meet each line once."""
    base = work_dir(spark, "test_hot_order", fresh=True)
    orders = spark.range(60).select(
        F.col("id").cast("string").alias("id"), F.lit("u").alias("user_id"), F.lit("O").alias("order_status"),
        F.lit(1.0).alias("total_amount"), F.lit("2024-01-01 00:00:00").alias("create_time"),
        F.timestamp_millis(F.lit(T0)).alias("event_ts"))
    lines = spark.range(300).select(
        F.concat(F.lit("l"), "id").alias("id"), F.when(F.col("id") % 3 == 0, "0").otherwise((F.col("id") % 60).cast("string")).alias("order_id"),
        F.lit("s").alias("sku_id"), F.lit("2.5").alias("order_price"), F.lit("1").alias("sku_num"),
        F.lit("x").alias("sku_name"), F.timestamp_millis(F.lit(T0)).alias("event_ts"))
    replay(orders, f"{base}/o", "event_ts", 2)
    replay(lines, f"{base}/l", "event_ts", 2)
    stream = build_sale_detail_stream(topic_stream(spark, "o", f"{base}/o"), topic_stream(spark, "l", f"{base}/l"), "1 day", salts=salts)
    run_available_now(stream, f"{base}/ckpt", f"{base}/sink")
    out = spark.read.parquet(f"{base}/sink")
    assert out.count() == 300 and out.select("order_detail_id").distinct().count() == 300
    assert out.filter("order_id = '0'").count() >= 100


def test_a_record_is_parsed_once_for_all_its_fields(spark):
    from pulsemart.functions.json import parse_json
    from pulsemart.schemas import ORDER_INFO_WIRE

    values = [None, "", "{", "[]", "7", '{"id":1}', '{"id":"a"', '{"id":"a","user_id":{"x":[1]}}', '{"user_id":"u","id":null,"other":2}',
              '{"id":"a"} {"id":"b"}', '{"id":"a","id":"b"}', '[{"id":"a"}]', '{"id":tru,"user_id":"u"}', '{"user_id":"u","id":tru}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    parsed = parse_json(df, "value", ORDER_INFO_WIRE, keep=("value",))
    one_field = "from_json(StructField(id,StringType,true), value"         # a parse of its own for the field
    plain = df.select("value", *[F.from_json("value", ORDER_INFO_WIRE).getField(f.name).alias(f.name) for f in ORDER_INFO_WIRE.fields])
    assert one_field in plain._jdf.queryExecution().optimizedPlan().toString()
    assert one_field not in parsed._jdf.queryExecution().optimizedPlan().toString()
    whole = df.select("value", F.from_json("value", ORDER_INFO_WIRE).alias("r")).collect()
    assert [tuple(r) for r in parsed.collect()] == [(r.value, *(r.r or [None] * len(ORDER_INFO_WIRE.fields))) for r in whole]
    differ = [v.value for v, w in zip(parsed.collect(), plain.collect()) if tuple(v) != tuple(w)]
    assert differ == [], differ

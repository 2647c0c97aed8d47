"""Stateful streams: sliding alerts, the audit of unmatched orders, two-level dedup,
seek paging over what they store."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemart.operators import alert, dedup
from pulsemart.plans import reports
from pulsemart.session import work_dir
from pulsemart.sources import sinks
from pulsemart.sources.stream import publish, topic_stream
from pulsemart.streaming.jobs import (
    alert_document_writer, build_alert_stream, build_buffered_sale_stream, build_fact_stream, build_unmatched_stream, run_available_now,
)

T0 = 1_704_067_200_000
EVENT_COLS = ["mid", "uid", "evid", "itemid", "ts", "event_id"]


def _event_topic(spark, path, rows):
    events = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ts long, event_id string")
    publish(events.coalesce(1), path, EVENT_COLS)


def _alert_documents(spark, base, waves, window, slide, delay="1 minute"):
    """Both alert streams after each wave of events; the documents at the end."""
    for wave in waves:
        _event_topic(spark, f"{base}/topic", wave)
        values = topic_stream(spark, "T", f"{base}/topic", max_per_trigger=1)
        run_available_now(build_fact_stream(values, slide, delay), f"{base}/c1", f"{base}/facts", partition_by=["day"])
        alerts = build_alert_stream(spark, f"{base}/facts", window, slide, delay)
        run_available_now(alerts, f"{base}/c2", foreach_batch=alert_document_writer(f"{base}/facts", f"{base}/table", window, slide, 4))
    return sinks.read_upserted(spark, f"{base}/table")


def test_sliding_alerts_equal_the_batch_form(spark):
    """Accounts over several panes and batches, late clicks, null accounts and devices:
    the documents are the batch form's, window by window and minute by minute."""
    base = work_dir(spark, "test_sliding", fresh=True)
    rows = []
    for i in range(240):
        kind = "coupon" if i % 11 else "clickItem"
        rows.append((None if i % 37 == 0 else f"m{i % 3}", None if i % 17 == 0 else f"u{i % 7}", kind, f"i{i % 5}", T0 + i * 1900, str(i)))
    closing = ("closing", "u", "coupon", "i", T0 + 86_400_000, "end")
    got = _alert_documents(spark, base, [rows[:80], rows[80:160], rows[160:] + [closing]], "1 minute", "5 seconds")
    events = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ts long, event_id string")
    alerts = alert.coupon_alerts(events, "1 minute", "5 seconds")
    want = alert.alert_per_minute(alerts).where(F.col("mid").isNotNull())
    columns = ["doc_id", "mid", "window_start", "window_end", "n_accounts", "uids", "item_ids", "ts"]
    documents = {tuple(r) for r in got.where(F.col("mid").isNotNull()).select(*columns).collect()}
    assert documents == {tuple(r) for r in want.select(*columns).collect()}
    assert alerts.count() > len(documents) > 5                   # the minute collapses windows


def test_alerts_wait_for_the_window_to_close(spark):
    base = work_dir(spark, "test_alert_close", fresh=True)
    three = [("m", f"u{i}", "coupon", "i", T0 + i * 1000, str(i)) for i in range(3)]
    assert _alert_documents(spark, base, [three], "5 minutes", "5 minutes") is None
    click = [("m", "u9", "clickItem", "i", T0 + 100_000, "9")]
    later = [("z", "u", "coupon", "i", T0 + 900_000, "10")]
    assert _alert_documents(spark, base, [click, later], "5 minutes", "5 minutes") is None      # a click, in time, undoes it


def test_no_state_row_grows_with_a_device(spark):
    """One device with thousands of accounts: state rows are many and of constant
    width, spread over the partitions, with one count on top."""
    base = work_dir(spark, "test_state_width", fresh=True)
    events = spark.range(20_000).select(
        F.lit("hot").alias("mid"), F.concat(F.lit("u"), "id").alias("uid"), F.lit("coupon").alias("evid"),
        F.lit("i").alias("itemid"), (F.lit(T0) + F.col("id") % 1000).alias("ts"), F.col("id").cast("string").alias("event_id"))
    publish(events, f"{base}/topic", EVENT_COLS)
    values = topic_stream(spark, "T", f"{base}/topic")
    run_available_now(build_fact_stream(values, "30 seconds", "1 minute"), f"{base}/c1", f"{base}/facts", partition_by=["day"])
    stream = build_alert_stream(spark, f"{base}/facts", "1 minute", "30 seconds", "1 minute")
    assert "collect" not in stream._jdf.queryExecution().analyzed().toString()
    run_available_now(stream, f"{base}/c2", f"{base}/sink")
    state = spark.read.format("statestore").load(f"{base}/c1")
    spread = [r["count"] for r in state.groupBy("partition_id").count().collect()]
    assert state.count() == 20_001 and max(spread) < 20_001 / 2              # accounts and the one item
    width = state.select(F.max(F.length(F.to_json("key"))), F.max(F.length(F.to_json("value")))).first()
    assert width[0] < 200 and width[1] < 100
    counts = spark.read.format("statestore").option("operatorId", 0).load(f"{base}/c2")
    assert counts.count() == 2                                               # a count for each window of the device


def _orders(spark, rows):
    return spark.createDataFrame(rows, "id string, user_id string, order_status string, create_time string, event_ts timestamp")


def _lines(spark, rows):
    return spark.createDataFrame(rows, "id string, order_id string, sku_id string, order_price string, event_ts timestamp")


def _at(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


def test_unmatched_orders_appear_when_the_watermark_passes_them(spark):
    base = work_dir(spark, "test_unmatched", fresh=True)

    def wave(orders, lines):
        publish(_orders(spark, [(o, "u", "O", "2024-01-01 00:00:00", _at(t)) for o, t in orders]).coalesce(1), f"{base}/o")
        publish(_lines(spark, [(f"{o}-{t}", o, "s", "1.5", _at(t)) for o, t in lines]).coalesce(1), f"{base}/l")
        stream = build_unmatched_stream(
            topic_stream(spark, "o", f"{base}/o"), topic_stream(spark, "l", f"{base}/l"), "5 seconds", "20 seconds", "10 seconds")
        run_available_now(stream, f"{base}/ckpt", f"{base}/sink")
        return {r.order_id for r in spark.read.schema("order_id string").parquet(f"{base}/sink").collect()}

    # a: line 19 s before; b: 21 s before; c: 9 s after; d: 11 s after; e: none
    orders = [("a", 100), ("b", 100), ("c", 100), ("d", 100), ("e", 100)]
    lines = [("a", 81), ("b", 79), ("c", 109), ("d", 111)]
    assert wave(orders, lines) == set()                         # the lines' watermark is at 106: an order of 100 may still meet one
    assert wave([("f", 200)], [("f", 200)]) == {"b", "d", "e"}
    assert wave([("g", 1000)], [("g", 1000)]) == {"b", "d", "e"}


@pytest.mark.parametrize("salts", [1, 3])
def test_buffers_live_for_seconds(spark, salts):
    """Lines 19, 20 and 21 s before the order and 9, 10 and 11 s after it, in separate
    micro-batches; several lines wait for one order; nothing is left at the end."""
    base = work_dir(spark, "test_buffers", fresh=True)

    def wave(orders, lines):
        if orders:
            publish(_orders(spark, [(o, "u", "O", "2024-01-01 00:00:00", _at(t)) for o, t in orders]).coalesce(1), f"{base}/o")
        if lines:
            publish(_lines(spark, [(f"{o}-{t}", o, "s", "1.5", _at(t)) for o, t in lines]).coalesce(1), f"{base}/l")
        stream = build_buffered_sale_stream(
            topic_stream(spark, "o", f"{base}/o"), topic_stream(spark, "l", f"{base}/l"), "15 seconds", salts)
        run_available_now(stream, f"{base}/ckpt", f"{base}/sink")
        return sorted(r.order_detail_id for r in spark.read.schema("order_detail_id string").parquet(f"{base}/sink").collect())

    assert wave([("x", 70)], [("a", 79), ("a", 80), ("a", 81), ("b", 90), ("b", 91), ("b", 92)]) == []
    assert wave([("a", 100), ("b", 100), ("c", 100)], []) == ["a-80", "a-81", "b-90", "b-91", "b-92"]      # 79 waited 21 s
    assert wave([], [("c", 109), ("c", 110), ("c", 111), (None, 109)])[-2:] == ["c-109", "c-110"]
    wave([("y", 1000)], [("z", 1000)])
    out = wave([("y", 5000)], [("z", 5000)])
    assert out == ["a-80", "a-81", "b-90", "b-91", "b-92", "c-109", "c-110"]            # each pair once
    left = spark.read.format("statestore").option("stateVarName", "order").load(f"{base}/ckpt")
    assert {r.key["order_id"] for r in left.collect()} <= {"y"}
    lines = spark.read.format("statestore").option("stateVarName", "lines").load(f"{base}/ckpt")
    assert {r.key["order_id"] for r in lines.collect()} <= {"z"}


@pytest.mark.parametrize("salts", [1, 16])
def test_a_hot_device_day_is_spread_before_the_keyed_dedup(spark, salts):
    base = work_dir(spark, "test_two_level", fresh=True)
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), (F.col("id") % 500).cast("string"))).alias("mid"),
        F.lit("2024-01-01").alias("logdate"), F.timestamp_millis(F.lit(T0) + F.col("id")).alias("event_time"), "id")
    rows.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
    run_available_now(dedup.dedup_stream(stream, salts=salts), f"{base}/ckpt", f"{base}/sink")
    out = spark.read.parquet(f"{base}/sink")
    want = rows.select("mid", "logdate").distinct().count()
    assert out.count() == out.select("mid", "logdate").distinct().count() == want
    if salts > 1:
        first = spark.read.format("statestore").option("operatorId", 1).load(f"{base}/ckpt")
        hot = first.where(F.col("key").getField("mid") == "hot")
        assert 1 < hot.count() <= salts and hot.select("partition_id").distinct().count() > 1


def test_first_seen_stream_is_the_earliest_of_the_day(spark):
    base = work_dir(spark, "test_first_stream", fresh=True)
    rows = [("a", T0 + 5, 3), ("a", T0 + 1, 9), ("a", T0 + 1, 4), ("b", T0 + 86_400_000, None), ("b", T0 + 86_399_999, 1),
            ("end", T0 + 10 * 86_400_000, 0)]
    df = spark.createDataFrame(rows, "mid string, ts long, event_id long").withColumn("event_time", F.timestamp_millis("ts"))
    df.write.parquet(f"{base}/in")
    run_available_now(dedup.first_seen_stream(spark.readStream.schema(df.schema).parquet(f"{base}/in")), f"{base}/ckpt", f"{base}/sink")
    got = {tuple(r) for r in spark.read.parquet(f"{base}/sink").collect()}
    assert got == {("a", "2024-01-01", "00", T0 + 1, 4), ("b", "2024-01-01", "23", T0 + 86_399_999, 1),
                   ("b", "2024-01-02", "00", T0 + 86_400_000, None)}


def test_pages_by_key_equal_pages_by_offset(spark):
    rows = [(f"2024-01-0{i % 4 + 1}", f"o{i % 7}", f"o{i % 7}-{i}", i) for i in range(53)]
    found = spark.createDataFrame(rows, "dt string, order_id string, order_detail_id string, n int")
    after, seen = None, 0
    while True:
        page = reports.sale_search_after(found, after, 10)
        assert "offset" not in page._jdf.queryExecution().optimizedPlan().toString().lower()
        got = [tuple(r) for r in page.collect()]
        assert got == [tuple(r) for r in reports.sale_search_page(found, seen // 10 + 1, 10).collect()]
        seen += len(got)
        if len(got) < 10:
            break
        after = got[-1][:3]
    assert seen == 53


def test_the_day_key_of_a_page_reaches_the_scan(spark):
    path = work_dir(spark, "test_seek", fresh=True) + "/t"
    spark.createDataFrame([("2024-01-01", "o", "l")], "dt string, order_id string, order_detail_id string").write.parquet(path)
    plan = reports.sale_search_after(spark.read.parquet(path), ("2024-01-01", "a", "b"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(dt,2024-01-01)" in plan



def test_join_state_holds_the_interval_only(spark):
    """Orders and lines over 400 days in event-time order: what the join still holds at
    the end lies within the interval of the last watermark."""
    from pulsemart.sources.stream import replay
    from pulsemart.streaming.jobs import build_sale_detail_stream

    base = work_dir(spark, "test_join_state", fresh=True)
    day = F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id AS int) % 400)")
    rows = spark.range(8000).withColumn("event_ts", day)
    orders = rows.select(F.col("id").cast("string").alias("id"), F.lit("u").alias("user_id"), F.lit("O").alias("order_status"),
                         F.lit("2024-01-01 00:00:00").alias("create_time"), "event_ts")
    lines = rows.select(F.concat(F.lit("l"), "id").alias("id"), F.col("id").cast("string").alias("order_id"), F.lit("s").alias("sku_id"),
                        F.lit("1.5").alias("order_price"), F.lit("n").alias("sku_name"), "event_ts")
    replay(orders, f"{base}/o", "event_ts", 20)
    replay(lines, f"{base}/l", "event_ts", 20)
    stream = build_sale_detail_stream(
        topic_stream(spark, "o", f"{base}/o", max_per_trigger=2), topic_stream(spark, "l", f"{base}/l", max_per_trigger=2),
        "1 day", "20 days", "10 days")
    run_available_now(stream, f"{base}/ckpt", f"{base}/sink")
    assert spark.read.parquet(f"{base}/sink").count() == 8000
    held = [spark.read.format("statestore").option("joinSide", side).load(f"{base}/ckpt").count() for side in ("left", "right")]
    assert held[0] <= 20 * (10 + 2) and held[1] <= 20 * (20 + 2)        # 20 rows a day

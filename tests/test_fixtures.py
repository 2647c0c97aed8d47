"""Hand-made fixtures for the rules the star schema cannot exercise (FIXTURES.md §3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from pulsemart.functions.dates import with_log_date_hour, whole_year_age
from pulsemart.functions.json import parse_json
from pulsemart.operators import aggregates as agg
from pulsemart.operators import alert, cdc, dedup, join
from pulsemart.plans import reports
from pulsemart.schemas import wire_schema

T0 = int(dt.datetime(2024, 1, 10, 12, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)


def ms(y, mo, d, h=0, mi=0, s=0, milli=0):
    return int(dt.datetime(y, mo, d, h, mi, s, milli * 1000, tzinfo=dt.timezone.utc).timestamp() * 1000)


def startup_df(spark, rows):
    df = spark.createDataFrame(rows, "mid string, ts long, event_id long")
    return with_log_date_hour(df.withColumn("uid", F.col("mid")))


def events_df(spark, rows):
    """rows: (mid, uid, evid, itemid, ts, event_id)"""
    return spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ts long, event_id long")


# --- DAU -----------------------------------------------------------------------


def test_tie_on_ts_keeps_lower_event_id(spark):
    df = startup_df(spark, [("d1", T0, 7), ("d1", T0, 3)])
    out = dedup.dau_first_event(df).collect()
    assert len(out) == 1 and out[0]["first_event_id"] == 3


def test_midnight_splits_days_and_hours(spark):
    df = startup_df(spark, [("d1", ms(2024, 1, 1, 23, 59, 59, 999), 1), ("d1", ms(2024, 1, 2), 2)])
    out = sorted((r["logdate"], r["loghour"]) for r in dedup.dau_first_event(df).collect())
    assert out == [("2024-01-01", "23"), ("2024-01-02", "00")]


def test_late_startup_counted_once_for_its_own_day(spark):
    # mid seen today; a late row of yesterday arrives in the next batch
    seen = dedup.dau_table(startup_df(spark, [("d1", ms(2024, 1, 2, 8), 1)]))
    batch = startup_df(spark, [("d1", ms(2024, 1, 1, 23), 2), ("d1", ms(2024, 1, 1, 23, 30), 3)])
    out = dedup.dau_incremental(dedup.dau_table(batch), seen).select("mid", "logdate").collect()
    assert [(r.mid, r.logdate) for r in out] == [("d1", "2024-01-01")]


def test_first_seen_is_the_first_row_of_dau_table(spark):
    rows = [("d1", T0, 7), ("d1", T0, 3), ("d1", T0 - 1, 9), ("d2", T0, -5), ("d2", T0, 2),
            ("d3", ms(2024, 1, 10, 23, 59, 59, 999), 1), ("d3", ms(2024, 1, 11), 0)]
    df = startup_df(spark, rows)
    want = {(r.mid, r.logdate, r.ts, r.event_id, r.loghour) for r in dedup.dau_table(df).collect()}
    got = {(r.mid, r.logdate, r.ts, r.event_id, r.loghour) for r in dedup.first_seen(df).collect()}
    assert got == want


def test_pair_key_orders_like_the_pair_and_round_trips(spark):
    import random

    from pulsemart.functions.ids import pair_key, pair_major, pair_minor

    rnd = random.Random(7)
    big = 2**63 - 1
    pairs = [(rnd.randint(-4 * 10**18, 4 * 10**18), rnd.randint(-big - 1, big)) for _ in range(200)]
    pairs += [(0, -big - 1), (0, big), (-1, big), (1, -big - 1), (T0, 0), (T0, -1)]
    df = spark.createDataFrame(pairs, "a long, b long").select(
        "a", "b", pair_key("a", "b").alias("k")
    ).select("a", "b", "k", pair_major("k").alias("a2"), pair_minor("k").alias("b2"))
    got = df.orderBy("k").collect()
    assert [(r.a, r.b) for r in got] == sorted(pairs)
    assert all((r.a2, r.b2) == (r.a, r.b) for r in got)


def test_funnel_counts_per_batch(spark):
    rows = [("a", ms(2024, 1, 1, 1), 1), ("a", ms(2024, 1, 1, 2), 2), ("b", ms(2024, 1, 1, 3), 3),
            ("a", ms(2024, 1, 1, 13), 4), ("c", ms(2024, 1, 1, 14), 5)]
    out = {(r.batch_start, r.step): r.n for r in dedup.dau_funnel(startup_df(spark, rows), 12 * 3600).collect()}
    assert out[("2024-01-01 00:00:00", "raw")] == 3
    assert out[("2024-01-01 00:00:00", "not_seen")] == 3
    assert out[("2024-01-01 00:00:00", "distinct")] == 2
    assert out[("2024-01-01 12:00:00", "raw")] == 2
    assert out[("2024-01-01 12:00:00", "not_seen")] == 1
    assert out[("2024-01-01 12:00:00", "distinct")] == 1


# --- joins ----------------------------------------------------------------------


def _orders(spark, rows):
    return spark.createDataFrame(rows, "id string, event_ts timestamp")


def _lines(spark, rows):
    return spark.createDataFrame(rows, "id string, order_id string, event_ts timestamp")


def test_line_buffer_20s_and_order_buffer_10s(spark):
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    orders = _orders(spark, [("o1", t)])
    lines = _lines(spark, [
        ("l19", "o1", t - dt.timedelta(seconds=19)), ("l20", "o1", t - dt.timedelta(seconds=20)),
        ("l21", "o1", t - dt.timedelta(seconds=21)),
        ("a9", "o1", t + dt.timedelta(seconds=9)), ("a10", "o1", t + dt.timedelta(seconds=10)),
        ("a11", "o1", t + dt.timedelta(seconds=11)),
    ])
    out = join.order_line_interval_join(orders, lines, "20 seconds", "10 seconds").collect()
    assert sorted(r.order_detail_id for r in out) == ["a10", "a9", "l19", "l20"]


def test_several_waiting_lines_each_once(spark):
    t = dt.datetime(2024, 1, 1, 12, 0, 0)
    orders = _orders(spark, [("o1", t)])
    lines = _lines(spark, [(f"l{i}", "o1", t - dt.timedelta(seconds=i)) for i in range(3)])
    out = join.order_line_interval_join(orders, lines, "20 seconds", "10 seconds").collect()
    assert sorted(r.order_detail_id for r in out) == ["l0", "l1", "l2"]


def test_unknown_user_gets_defaults(spark):
    sales = spark.createDataFrame(
        [("d1", "o1", "F", "2024-01-01 00:00:00", "u9", "s1", 1.5, "x", "2024-01-01")],
        "order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
        "sku_id string, sku_price double, sku_name string, dt string",
    )
    users = spark.createDataFrame([("u1", "a", "L1", "2000-01-01", "M")], "id string, login_name string, user_level string, birthday string, gender string")
    r = join.with_user(sales, users, "2024-01-31 00:00:00").collect()[0]
    assert (r.user_id, r.user_age, r.user_gender, r.user_level) == ("u9", 0, None, None)


def test_age_uses_365_day_years(spark):
    df = spark.createDataFrame([("2000-02-29",)], "b string")
    a = df.select(
        whole_year_age(F.col("b"), "2024-02-28 00:00:00").alias("x"),
        whole_year_age(F.col("b"), "2024-03-01 00:00:00").alias("y"),
    ).first()
    assert (a.x, a.y) == (24, 24)


# --- alert ----------------------------------------------------------------------


def _alerts(spark, rows, window="5 minutes", slide=None):
    return alert.coupon_alerts(events_df(spark, rows), window, slide).collect()


def test_alert_fires_for_three_accounts(spark):
    rows = [("m", f"u{i}", "coupon", f"i{i}", T0 + i * 10_000, i) for i in range(3)]
    out = _alerts(spark, rows)
    assert len(out) == 1 and out[0].n_accounts == 3 and out[0].uids == "u0,u1,u2"


def test_alert_click_in_window_blocks(spark):
    rows = [("m", f"u{i}", "coupon", "i", T0 + i * 1000, i) for i in range(3)]
    rows.append(("m", "u0", "clickItem", "i", T0 + 5000, 9))
    assert _alerts(spark, rows) == []


def test_alert_click_in_next_window_does_not_block(spark):
    rows = [("m", f"u{i}", "coupon", "i", T0 + i * 1000, i) for i in range(3)]
    rows.append(("m", "u0", "clickItem", "i", T0 + 6 * 60_000, 9))
    assert len(_alerts(spark, rows)) == 1


def test_alert_null_account_is_not_an_account(spark):
    rows = [("m", "u1", "coupon", "i", T0, 1), ("m", "u2", "coupon", "i", T0 + 1, 2), ("m", None, "coupon", "i", T0 + 2, 3)]
    assert _alerts(spark, rows) == []


def test_alert_same_account_thrice(spark):
    rows = [("m", "u1", "coupon", "i", T0 + i, i) for i in range(3)]
    assert _alerts(spark, rows) == []


def test_sliding_panes_match_spark_window(spark):
    import random

    rnd = random.Random(7)
    rows = [
        (f"m{rnd.randint(0, 3)}", f"u{rnd.randint(0, 5)}", ("clickItem" if rnd.random() < 0.02 else rnd.choice(["coupon", "view"])),
         f"i{rnd.randint(0, 4)}", T0 + rnd.randint(0, 3_600_000), n)
        for n in range(400)
    ]
    ev = events_df(spark, rows)
    got = {(r.mid, r.window_start, r.n_accounts) for r in alert.coupon_alerts(ev, "10 minutes", "2 minutes").collect()}
    w = F.window(F.timestamp_millis("ts"), "10 minutes", "2 minutes")
    naive = ev.groupBy("mid", w.alias("w")).agg(
        F.count_distinct(F.when(F.col("evid") == "coupon", F.col("uid"))).alias("n"),
        F.bool_or(F.col("evid") == "clickItem").alias("c"),
    ).where("n >= 3 AND NOT c")
    want = {(r.mid, r.w.start.strftime("%Y-%m-%d %H:%M:%S"), r.n) for r in naive.collect()}
    assert got == want and got


def test_alert_per_minute_collapses_repeats(spark):
    # 5 s slides: many windows end within the same minute -> one document each minute
    rows = [("m", f"u{i}", "coupon", "i", T0 + i * 1000, i) for i in range(3)]
    alerts = alert.coupon_alerts(events_df(spark, rows), "5 minutes", "5 seconds")
    n_alerts = alerts.count()
    per_min = alert.alert_per_minute(alerts).collect()
    assert n_alerts > len(per_min) > 0
    assert len({r.doc_id for r in per_min}) == len(per_min)


# --- change feed ----------------------------------------------------------------


def _changes(spark, rows):
    return spark.createDataFrame(rows, "schema_name string, table_name string, kind string, op string, after map<string,string>, seq long")


def test_user_update_wins_over_replayed_insert(spark):
    ch = _changes(spark, [
        ("shop", "user_info", "ROWDATA", "INSERT", {"id": "1", "user_level": "a"}, 10),
        ("shop", "user_info", "ROWDATA", "UPDATE", {"id": "1", "user_level": "b"}, 11),
        ("shop", "user_info", "ROWDATA", "INSERT", {"id": "1", "user_level": "a"}, 10),
    ])
    out = cdc.latest_user(ch).collect()
    assert [(r.id, r.user_level) for r in out] == [("1", "b")]


def test_order_delete_and_update_not_routed(spark):
    ch = _changes(spark, [
        ("shop", "order_info", "ROWDATA", "DELETE", {"id": "1"}, 1),
        ("shop", "order_info", "ROWDATA", "UPDATE", {"id": "1"}, 2),
        ("shop", "order_info", "ROWDATA", "INSERT", {"id": "2"}, 3),
        ("shop", "order_info", "TRANSACTIONEND", None, None, 4),
        ("other", "order_info", "ROWDATA", "INSERT", {"id": "3"}, 5),
    ])
    out = cdc.route(ch).collect()
    assert [(r.topic, r.key) for r in out] == [("TOPIC_ORDER_INFO", "2")]


def test_quoted_numbers_parse(spark):
    df = spark.createDataFrame([('{"id":"1","total_amount":"12.5"}',)], "value string")
    out = parse_json(df, "value", wire_schema(("id", "total_amount"), extra=()), casts={"total_amount": "double"}).first()
    assert out.total_amount == 12.5


# --- reports --------------------------------------------------------------------


def test_empty_day(spark):
    dau = spark.createDataFrame([("d1", "2024-01-01", "05")], "mid string, logdate string, loghour string")
    orders = spark.createDataFrame([("2024-01-01", "05", 3.0)], "create_date string, create_hour string, total_amount double")
    kpi = {r.id: r.value for r in reports.kpi_total(dau, orders, "2024-01-05").collect()}
    assert kpi == {"dau": 0.0, "new_mid": 0.0, "order_amount": None}
    zero = reports.hourly_zero_fill(agg.dau_hourly(dau), "2024-01-05").collect()
    assert len(zero) == 24 and all(r.ct == 0 for r in zero)


def test_unknown_metric_gives_no_rows(spark):
    dau = spark.createDataFrame([("d1", "2024-01-01", "05")], "mid string, logdate string, loghour string")
    orders = spark.createDataFrame([("2024-01-01", "05", 3.0)], "create_date string, create_hour string, total_amount double")
    assert reports.hourly_compare("x", dau, orders, "2024-01-01").collect() == []
    today = reports.hourly_compare("dau", dau, orders, "2024-01-02").collect()
    assert [(r.hour, r.yesterday, r.today) for r in today] == [("05", 1, None)]


def test_full_outer_rewrite_equals_full_outer_join(spark):
    orders = spark.createDataFrame([("1",), ("2",), ("2",), ("4",)], "id string")
    lines = spark.createDataFrame(
        [("a", "1"), ("b", "1"), ("c", "3"), ("d", "2"), ("e", None)], "id string, order_id string"
    )
    got = [tuple(r) for r in join.order_line_full_outer(orders, lines).collect()]
    o = orders.select(F.col("id").alias("o_id"))
    li = lines.select(F.col("order_id").alias("l_order"), F.col("id").alias("order_detail_id"))
    full = o.join(li, o.o_id == li.l_order, "full").select(
        F.coalesce("o_id", "l_order").alias("order_id"), "order_detail_id",
        F.when(F.col("o_id").isNotNull() & F.col("order_detail_id").isNotNull(), "both")
        .when(F.col("o_id").isNotNull(), "order_only").otherwise("line_only").alias("side"),
    )
    want = [tuple(r) for r in full.collect()]
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert ("4", None, "order_only") in got and ("3", "c", "line_only") in got


def test_checked_small_join_broadcasts_only_under_the_bound(spark):
    big = spark.createDataFrame([(i % 5, i) for i in range(50)], "k long, v long")
    small = spark.createDataFrame([(1, "one"), (3, "three")], "k long, name string")
    assert join.measured_bytes(small) == 2 * (8 + 8) + len("one") + len("three")
    results = []
    for bound, strategy in ((1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            out = join.join_checked_small(big, small, "k", max_bytes=bound)
            assert strategy in out._jdf.queryExecution().executedPlan().toString()
            results.append(sorted(tuple(r) for r in out.collect()))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32MB")
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert results[0] == results[1] and len(results[0]) == 20

"""Plan shapes the scale design relies on (README "Design for scale"): a hot
key is reduced map-side before its shuffle, no full outer join reaches AQE
unsplittable, and the events are not shuffled to find an alert's events."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from pulsemart.functions.dates import with_log_date_hour
from pulsemart.operators import alert, dedup, join

T0 = 1_704_067_200_000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_startups(spark, n=3000):
    # device "hot" holds a third of the rows
    rows = [("hot" if i % 3 == 0 else f"d{i % 97}", T0 + i * 1000, i) for i in range(n)]
    return with_log_date_hour(spark.createDataFrame(rows, "mid string, ts long, event_id long"))


def test_first_startup_is_a_partial_hash_aggregate_before_the_shuffle(spark):
    firsts = dedup.first_seen(_hot_startups(spark))
    plan = _plan(firsts)
    assert "SortAggregate" not in plan
    # partial aggregate below the exchange, final above it
    assert re.search(r"HashAggregate\(keys=\[mid.*logdate.*partial_min", plan, re.S)
    got = {r.mid: r.event_id for r in firsts.where(F.col("mid") == "hot").collect()}
    assert got == {"hot": 0}


def test_full_outer_join_is_planned_without_a_full_outer_join(spark):
    orders = spark.createDataFrame([(str(i),) for i in range(50)], "id string")
    lines = spark.createDataFrame([(f"l{i}", "0" if i % 3 == 0 else str(i % 60)) for i in range(300)],
                                  "id string, order_id string")
    plan = _plan(join.order_line_full_outer(orders, lines))
    assert "FullOuter" not in plan
    assert "LeftOuter" in plan and "LeftAnti" in plan


def test_alert_events_do_not_shuffle_the_events_when_alerts_are_small(spark):
    rows = [("m1", f"u{i}", "coupon", "1", T0 + i * 1000, i) for i in range(5)]
    rows += [("m2", "u1", "clickItem", "2", T0 + 10 * 1000 + i, 100 + i) for i in range(20)]
    events = spark.createDataFrame(rows, "mid string, uid string, evid string, itemid string, ts long, event_id long")
    alerts = alert.coupon_alerts(events, "1 hour")
    out = alert.alert_events(events, alerts, "1 hour")
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.count() == 5

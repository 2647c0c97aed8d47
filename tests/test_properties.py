"""The coupon alert against a brute-force evaluation of its rule on random
events (tumbling and sliding windows), including null accounts and clicks."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from pulsemart.operators import alert

T0 = 1_704_067_200_000
MINUTE = 60_000

event = st.tuples(
    st.sampled_from(["m1", "m2"]),
    st.one_of(st.none(), st.sampled_from(["u1", "u2", "u3", "u4", "u5"])),
    st.sampled_from(["coupon", "coupon", "coupon", "clickItem", "view"]),
    st.sampled_from(["i1", "i2", "i3"]),
    st.integers(min_value=0, max_value=40 * MINUTE),
)


def _fmt(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, tz=dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def _brute(rows, window_ms, slide_ms):
    groups = {}
    for mid, uid, evid, item, ts in rows:
        last = ts - ts % slide_ms
        for k in range(window_ms // slide_ms):
            groups.setdefault((mid, last - k * slide_ms), []).append((uid, evid, item))
    out = set()
    for (mid, start), evs in groups.items():
        uids = sorted({u for u, e, _ in evs if e == "coupon" and u is not None})
        items = sorted({i for _, e, i in evs if e == "coupon" and i is not None})
        clicked = any(e == "clickItem" for _, e, _ in evs)
        if len(uids) >= alert.MIN_ACCOUNTS and not clicked:
            out.add((mid, _fmt(start), _fmt(start + window_ms), len(uids), ",".join(uids), ",".join(items),
                     start + window_ms))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(event, min_size=1, max_size=40), sliding=st.booleans())
@example(rows=[("m1", "u1", "coupon", "i1", 0), ("m1", "u2", "coupon", "i2", MINUTE),
               ("m1", "u3", "coupon", "i1", 3 * MINUTE), ("m1", None, "coupon", "i3", 4 * MINUTE)], sliding=True)
def test_coupon_alerts_match_brute_force(spark, rows, sliding):
    data = [(m, u, e, i, T0 + t, n) for n, (m, u, e, i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "mid string, uid string, evid string, itemid string, ts long, event_id long")
    window, slide = ("10 minutes", "2 minutes") if sliding else ("10 minutes", None)
    got = {tuple(r) for r in alert.coupon_alerts(df, window, slide).collect()}
    want = _brute([(m, u, e, i, ts) for m, u, e, i, ts, _ in data], 10 * MINUTE, (2 if sliding else 10) * MINUTE)
    assert got == want
    if rows and rows[0] == ("m1", "u1", "coupon", "i1", 0) and len(rows) == 4:
        assert len(want) == 4   # windows starting 6, 4, 2 and 0 minutes before hold all three accounts


startup = st.tuples(
    st.sampled_from(["d1", "d2", "d3"]),
    st.integers(min_value=0, max_value=3 * 86_400_000 - 1),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(startup, min_size=1, max_size=40))
def test_dau_funnel_matches_batch_replay(spark, rows):
    from pulsemart.functions.dates import with_log_date_hour
    from pulsemart.operators import dedup

    batch_ms = 12 * 3600 * 1000
    data = [(m, T0 + t, n) for n, (m, t) in enumerate(rows)]
    df = with_log_date_hour(spark.createDataFrame(data, "mid string, ts long, event_id long"))
    got = {(r.batch_start, r.step): r.n for r in dedup.dau_funnel(df, 12 * 3600).collect()}
    want, seen = {}, set()
    for b in sorted({ts - ts % batch_ms for _, ts, _ in data}):
        rows_b = [(m, ts) for m, ts, _ in data if b <= ts < b + batch_ms]
        keys = {(m, _fmt(ts)[:10]) for m, ts in rows_b}
        fresh = keys - seen
        start = _fmt(b)
        want[(start, "raw")] = len(rows_b)
        want[(start, "not_seen")] = sum(1 for m, ts in rows_b if (m, _fmt(ts)[:10]) in fresh)
        want[(start, "distinct")] = len(fresh)
        seen |= keys
    assert got == want


change = st.tuples(
    st.sampled_from(["1", "2", "3"]),
    st.sampled_from(["INSERT", "UPDATE", "DELETE"]),
    st.sampled_from(["gold", "silver", "VIP"]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(changes=st.lists(change, min_size=1, max_size=25), order=st.randoms(use_true_random=False))
def test_latest_and_current_users_match_a_fold_of_the_feed(spark, changes, order):
    from pulsemart.operators import cdc

    rows = []
    for seq, (uid, op, level) in enumerate(changes):
        after = {"id": uid} if op == "DELETE" else {"id": uid, "login_name": f"n{uid}", "user_level": level,
                                                      "birthday": "2000-01-01", "gender": "F"}
        rows.append(("shop", "user_info", "ROWDATA", op, after, seq))
    order.shuffle(rows)      # arrival order is not the change order; seq is
    df = spark.createDataFrame(rows, "schema_name string, table_name string, kind string, op string, "
                                     "after map<string,string>, seq long")
    latest, current = {}, {}
    for seq, (uid, op, level) in enumerate(changes):
        if op != "DELETE":
            latest[uid] = (level, seq)
            current[uid] = (level, seq)
        else:
            current.pop(uid, None)
    got_latest = {r.id: (r.user_level, r.seq) for r in cdc.latest_user(df).collect()}
    got_current = {r.id: (r.user_level, r.seq) for r in cdc.current_users(df).collect()}
    assert got_latest == latest
    assert got_current == current


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    orders=st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3"]), st.integers(0, 60)), min_size=1, max_size=6),
    lines=st.lists(st.tuples(st.sampled_from(["o1", "o2", "o3", "o4"]), st.integers(0, 60)), min_size=1, max_size=12),
)
def test_interval_join_matches_brute_force(spark, orders, lines):
    from pulsemart.operators import join

    base = dt.datetime(2024, 1, 1)
    o = spark.createDataFrame([(oid, base + dt.timedelta(days=d)) for oid, d in orders], "id string, event_ts timestamp")
    li = spark.createDataFrame(
        [(f"l{n}", oid, base + dt.timedelta(days=d)) for n, (oid, d) in enumerate(lines)],
        "id string, order_id string, event_ts timestamp",
    )
    got = sorted(tuple(r) for r in join.order_line_interval_join(o, li).collect())
    want = sorted(
        (oid, f"l{n}")
        for oid, od in orders
        for n, (lid, ld) in enumerate(lines)
        if lid == oid and od - 20 <= ld <= od + 10
    )
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells=st.dictionaries(st.tuples(st.sampled_from(["2024-01-01", "2024-01-02", "2024-01-04"]),
                                       st.sampled_from(["00", "05", "23"])),
                             st.integers(1, 9), min_size=1, max_size=9))
def test_hour_reports_match_brute_force(spark, cells):
    from pulsemart.plans import reports

    hourly = spark.createDataFrame([(d, h, n) for (d, h), n in cells.items()], "logdate string, lh string, ct long")
    days = sorted({d for d, _ in cells})
    zero = {(r.logdate, r.lh): r.ct for r in reports.hourly_zero_fill(hourly).collect()}
    assert zero == {(d, f"{h:02d}"): cells.get((d, f"{h:02d}"), 0) for d in days for h in range(24)}

    def next_day(d):
        return (dt.date.fromisoformat(d) + dt.timedelta(days=1)).isoformat()

    cmp = {(r.logdate, r.hour): (r.yesterday, r.today)
           for r in reports._compare(hourly, "logdate", "lh", "ct", None).collect()}
    want = {}
    for (d, h), n in cells.items():
        y, t = want.get((d, h), (None, None))
        want[(d, h)] = (y, n)
        y2, t2 = want.get((next_day(d), h), (None, None))
        want[(next_day(d), h)] = (n, t2)
    assert cmp == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(startup, min_size=1, max_size=30),
       buys=st.lists(st.tuples(st.integers(0, 3 * 86_400_000 - 1), st.integers(1, 500)), max_size=10))
def test_kpi_tiles_match_brute_force(spark, rows, buys):
    from pulsemart.functions.dates import with_log_date_hour, with_order_date_hour
    from pulsemart.operators import dedup
    from pulsemart.plans import reports

    data = [(m, T0 + t, n) for n, (m, t) in enumerate(rows)]
    dau = dedup.first_seen(with_log_date_hour(spark.createDataFrame(data, "mid string, ts long, event_id long")))
    orders = with_order_date_hour(spark.createDataFrame(
        [(_fmt(T0 + t), float(v)) for t, v in buys], "create_time string, total_amount double"))
    got = {(r.day, r.id): r.value for r in reports.kpi_total(dau, orders).collect()}
    want = {}
    days_of = {}
    for m, ts, _ in data:
        days_of.setdefault(m, set()).add(_fmt(ts)[:10])
    for m, days in days_of.items():
        for d in days:
            want[(d, "dau")] = want.get((d, "dau"), 0.0) + 1
        first = min(days)
        want[(first, "new_mid")] = want.get((first, "new_mid"), 0.0) + 1
    amounts = {}
    for t, v in buys:
        amounts[_fmt(T0 + t)[:10]] = amounts.get(_fmt(T0 + t)[:10], 0.0) + v
    want.update({(d, "order_amount"): round(a, 2) for d, a in amounts.items()})
    assert got == want


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.sets(st.tuples(st.sampled_from(["2024-01-01", "2024-01-02"]), st.integers(1, 30), st.integers(1, 5)),
                    min_size=1, max_size=40),
       size=st.integers(1, 7))
def test_pages_tile_the_sorted_result(spark, keys, size):
    from pulsemart.plans import reports

    df = spark.createDataFrame([(d, str(o), f"{o}-{line}") for d, o, line in keys],
                               "dt string, order_id string, order_detail_id string")
    ordered = sorted((d, str(o), f"{o}-{line}") for d, o, line in keys)
    pages = []
    for page in range(1, -(-len(ordered) // size) + 2):
        pages.extend(tuple(r) for r in reports.sale_search_page(df, page, size).collect())
    assert pages == ordered

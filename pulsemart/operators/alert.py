"""Coupon-fraud alert.

Rule, per device and time window: at least ``min_accounts`` distinct accounts
took a coupon and nobody clicked an item.  The reference collects every event
of a device into one in-memory group; here each piece is a partial aggregate:

* one scan turns events into distinct (device, window, kind, value) facts,
  kind = click / account / item; the distinct is keyed by the value, so a
  device holding a third of all rows is spread over tasks before counting
* clicks and accounts -> ``bool_or`` / ``count_if`` per (device, window)
* the lists -> built only for the windows that alert, from the same facts

Sliding windows use panes ("No pane, no gain", Li et al., SIGMOD Record 2005):
events are first reduced to one row per (device, pane, account) with
pane = slide, and only these rows are copied to the ``window / slide``
windows that contain the pane -- never the raw events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions.ids import alert_doc_id
from pulsemart.operators.cdc import latest_by_key
from pulsemart.operators.join import join_checked_small

# Fixed values of the rule.
COUPON = "coupon"
CLICK = "clickItem"
MIN_ACCOUNTS = 3

SALTS = 16                         # tasks that a hot window's lists are built in


def duration_ms(duration: str) -> int:
    """'12 hours' / '5 minutes' / '5 seconds' -> milliseconds."""
    n, unit = duration.split()
    unit = unit.rstrip("s")
    factor = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit]
    return int(n) * factor


def _fmt(ms_col):
    return F.date_format(F.timestamp_millis(ms_col), "yyyy-MM-dd HH:mm:ss")


def _start_of(ts_ms, length_ms: int):
    """Start of the ``length_ms`` bucket holding ``ts_ms``; buckets start at the
    epoch, as Spark's ``window()`` (``pmod``: right for times before 1970 too)."""
    return ts_ms - F.pmod(ts_ms, F.lit(length_ms))


def _facts(events: DataFrame, *kept) -> DataFrame:
    """Every event as the facts it holds, (kept columns, mid, kind, val): at most one
    of a kind."""
    evid, uid, item = F.col("evid"), F.col("uid"), F.col("itemid")
    facts = F.array_compact(
        F.array(
            F.when(evid == CLICK, F.struct(F.lit("c").alias("k"), F.lit("").alias("v"))),
            F.when((evid == COUPON) & uid.isNotNull(), F.struct(F.lit("u").alias("k"), uid.alias("v"))),
            F.when((evid == COUPON) & item.isNotNull(), F.struct(F.lit("i").alias("k"), item.alias("v"))),
        )
    )
    rows = events.select("mid", *kept, F.explode(facts).alias("_f"))
    return rows.select(*[c for c in rows.columns if c != "_f"], F.col("_f.k").alias("kind"), F.col("_f.v").alias("val"))


def _window_facts(events: DataFrame, window: str, slide: str | None) -> DataFrame:
    """Distinct (mid, window start, kind, value) facts, kind c = click, u = account, i = item.

    One scan of the events.  Each event yields at most one fact per kind and
    facts are made distinct per pane first (partial aggregation keyed by the
    value, so a hot device spreads over tasks), then copied to the windows
    that contain the pane.
    """
    w_ms = duration_ms(window)
    s_ms = duration_ms(slide) if slide else w_ms
    if w_ms % s_ms:
        raise ValueError("window length must be a multiple of the slide")
    copies = w_ms // s_ms
    pane = _start_of(F.col("ts"), s_ms).alias("_pane")
    per_pane = _facts(events, pane).distinct()
    if copies == 1:
        return per_pane.withColumnRenamed("_pane", "_wstart")
    k = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_k")
    return (
        per_pane.select("mid", "kind", "val", "_pane", k)
        .select("mid", "kind", "val", (F.col("_pane") - F.col("_k") * F.lit(s_ms)).alias("_wstart"))
        .distinct()
    )


def coupon_alerts(
    events: DataFrame,
    window: str = "5 minutes",
    slide: str | None = None,
    min_accounts: int = MIN_ACCOUNTS,
) -> DataFrame:
    """W1/W2 + A3 + A5 + A6 + F4 + F5: one row per alerting (device, window).

    Columns: mid, window_start, window_end (``yyyy-MM-dd HH:mm:ss``),
    n_accounts, uids and item_ids (sorted, comma-joined) and ts = window end
    in epoch ms (the reference stamps the wall clock instead).  Null accounts
    are not accounts (SURVEY D8).
    """
    w_ms = duration_ms(window)
    facts = _window_facts(events, window, slide)
    summary = facts.groupBy("mid", "_wstart").agg(
        F.count_if(F.col("kind") == "u").alias("n_accounts"),
        F.bool_or(F.col("kind") == "c").alias("_click"),
    )
    hits = summary.where((F.col("n_accounts") >= min_accounts) & ~F.col("_click")).select(
        "mid", "_wstart", "n_accounts"
    )
    # Lists only for the windows that alert.  These are measured and broadcast when
    # small, so the facts are usually not shuffled again; the lists are built by salt
    # first, so a window with a third of the facts is spread over tasks.
    salt = F.pmod(F.xxhash64("val"), F.lit(SALTS)).alias("_salt")
    listed = join_checked_small(facts.where(F.col("kind") != "c"), hits.select("mid", "_wstart"), ["mid", "_wstart"])

    def values(kind: str):
        return F.collect_list(F.when(F.col("kind") == kind, F.col("val")))

    def joined(name: str):
        return F.array_join(F.sort_array(F.flatten(F.collect_list(name))), ",")

    parts = listed.groupBy("mid", "_wstart", salt).agg(values("u").alias("_u"), values("i").alias("_i"))
    lists = parts.groupBy("mid", "_wstart").agg(joined("_u").alias("uids"), joined("_i").alias("item_ids"))
    end = F.col("_wstart") + F.lit(w_ms)
    return hits.join(lists, ["mid", "_wstart"], "left").select(
        "mid",
        _fmt(F.col("_wstart")).alias("window_start"),
        _fmt(end).alias("window_end"),
        "n_accounts",
        "uids",
        "item_ids",
        end.alias("ts"),
    )


def alert_events(events: DataFrame, alerts: DataFrame, window: str) -> DataFrame:
    """A4: the events of every alerting tumbling window, one row per event.

    The reference keeps them as a list in the alert; a list per group would
    put a hot device's whole window into one value, so they stay rows keyed by
    (mid, window_start) and ordered by (event_ts, event_id).  The join is on
    (mid, window start): a broadcast when the alerts measure small, else a
    shuffled join where AQE splits a skewed device partition.
    """
    w_ms = duration_ms(window)
    e = events.select(
        "mid", "event_id", "evid", F.col("ts").alias("event_ts"), _start_of(F.col("ts"), w_ms).alias("_ws")
    )
    # Joined on the numeric window start: no per-event date formatting.  The
    # alerts are measured and broadcast only when small, so the events are
    # usually not shuffled at all.
    a = alerts.select("mid", (F.col("ts") - F.lit(w_ms)).alias("_ws"), "window_start")
    return join_checked_small(e, a, ["mid", "_ws"], "inner").select(
        "mid", "window_start", "event_ts", "event_id", "evid"
    )


def with_doc_id(alerts: DataFrame) -> DataFrame:
    """Document id = device id + epoch minute of the alert time."""
    return alerts.withColumn("doc_id", alert_doc_id("mid", "ts"))


def alert_per_minute(alerts: DataFrame) -> DataFrame:
    """One alert per device and minute -- the last window wins, as a
    keyed upsert by the document id would leave it."""
    return latest_by_key(with_doc_id(alerts), "doc_id", order="ts")


# --- streams: chained stateful steps, append mode ----------------------------------
#
# No state value holds a list or a set.  The first step keeps one row per distinct
# (device, pane, kind, value), the second one per (device, window, kind, value), so
# a device with a third of all accounts is spread over the state partitions by
# account; on top of them lies one count per (device, window).


def pane_facts(events: DataFrame, slide: str, delay: str) -> DataFrame:
    """The first step: distinct (mid, pane, kind, val) of a stream, a pane being
    ``slide`` long.  State is dropped when the watermark, ``delay`` behind, passes it."""
    pane = F.timestamp_millis(_start_of(F.col("ts"), duration_ms(slide))).alias("pane")
    facts = _facts(events, pane).withWatermark("pane", delay)
    return facts.dropDuplicates(["mid", "pane", "kind", "val"])


def alerts_of_facts(
    facts: DataFrame, window: str, slide: str | None, delay: str, min_accounts: int = MIN_ACCOUNTS
) -> DataFrame:
    """The second step: the alerting (device, window)s of a stream of pane facts, each
    emitted once, when the watermark passes the window's end (W1, W2, A6, F4, F5)."""
    span = F.window("pane", window, slide) if slide else F.window("pane", window)
    merged = (
        facts.withWatermark("pane", delay).where(F.col("kind") != "i").select("mid", span.alias("_w"), "kind", "val")
    )
    if slide and slide != window:              # an account seen in several panes of a window counts once
        merged = merged.dropDuplicates(["mid", "_w", "kind", "val"])
    counts = merged.groupBy("mid", "_w").agg(
        F.count_if(F.col("kind") == "u").alias("n_accounts"), F.bool_or(F.col("kind") == "c").alias("_click"))
    end = F.unix_millis(F.col("_w.end"))
    return counts.where((F.col("n_accounts") >= min_accounts) & ~F.col("_click")).select(
        "mid", F.date_format("_w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("_w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "n_accounts", end.alias("ts"),
    )


def with_lists(alerts: DataFrame, facts: DataFrame, window: str, slide: str | None) -> DataFrame:
    """A3 + A5: the accounts and items of each alert, from the stored pane facts.  Only
    the panes of alerting windows are joined, by (device, pane)."""
    w_ms, s_ms = duration_ms(window), duration_ms(slide or window)
    panes = F.explode(F.sequence(F.col("ts") - F.lit(w_ms), F.col("ts") - F.lit(s_ms), F.lit(s_ms).cast("long")))
    wanted = alerts.withColumn("_pane", panes)
    held = facts.where(F.col("kind") != "c").select("mid", F.unix_millis("pane").alias("_pane"), "kind", "val")

    def listed(kind: str):
        return F.array_join(F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("val")))), ",")

    return wanted.join(held, ["mid", "_pane"]).groupBy(*alerts.columns).agg(
        listed("u").alias("uids"), listed("i").alias("item_ids"))

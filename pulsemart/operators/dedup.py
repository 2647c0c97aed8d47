"""Daily-active-device dedup.

The reference groups a whole micro-batch by (device, day), sorts each group
and keeps one row, then filters against a driver-side set.  Here the same
results come from declarative aggregates: ``min_by`` is a partial aggregate,
so a device holding a third of all rows is reduced map-side to one row per
task before the shuffle; no group is ever materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions.dates import log_hour
from pulsemart.functions.ids import pair_key, pair_major, pair_minor

KEY = ("mid", "logdate")
NO_EVENT_ID = -(1 << 63)          # packed in place of a null event id: the lowest long, so it sorts first


def dau_table(startup: DataFrame, key=KEY, order=("ts", "event_id"), with_rows: bool = False) -> DataFrame:
    """A2 + L1: the earliest startup of every (device, day), all columns kept, with
    ``with_rows`` also ``_rows``, the number of its startups.

    Ties on ``ts`` break on ``event_id`` (the reference keeps arrival order).
    """
    value_cols = [c for c in startup.columns if c not in key]
    first = F.min_by(F.struct(*value_cols), F.struct(*order)).alias("_first")
    rows = [F.count(F.lit(1)).alias("_rows")] if with_rows else []
    return startup.groupBy(*key).agg(first, *rows).select(
        *key, *[F.col(f"_first.{c}").alias(c) for c in value_cols], *(["_rows"] if with_rows else []))


def first_seen(startup: DataFrame, key=KEY) -> DataFrame:
    """A2 + L1 for the reports: time, event id and hour of the first startup
    of every (device, day) -- what the DAU counts need, not the whole row.

    ``(ts, event_id)`` is packed into one ordered decimal, so ``min`` runs as
    a hash aggregate (partial map-side, codegen) instead of the sort-based
    aggregate a struct needs.  Same row as ``dau_table``: earliest ``ts``,
    ties to the lower event id, a row without one first.
    """
    tie = F.coalesce(F.col("event_id").cast("long"), F.lit(NO_EVENT_ID))
    firsts = startup.groupBy(*key).agg(F.min(pair_key("ts", tie)).alias("_k"))
    ts, event_id = pair_major(F.col("_k")), pair_minor(F.col("_k"))
    return firsts.select(
        *key, ts.alias("ts"), F.nullif(event_id, F.lit(NO_EVENT_ID)).alias("event_id"), log_hour(ts).alias("loghour")
    )


def dau_first_event(startup: DataFrame) -> DataFrame:
    """A2 as a report: device, day, id, time and hour of the first startup."""
    return first_seen(startup).select(
        "mid", "logdate", "loghour",
        F.col("event_id").alias("first_event_id"),
        F.col("ts").alias("first_ts"),
    )


def dau_incremental(firsts: DataFrame, seen: DataFrame, key=KEY) -> DataFrame:
    """Device-days of a new batch that the stored DAU table does not hold yet.

    ``firsts`` is the batch already reduced to one row per key (``dau_table``
    for the stored rows, ``first_seen`` for keys), so both join sides come out
    of aggregations hash-partitioned on the key and the anti-join adds no
    exchange.  It is on the full key (device and *log* day; SURVEY D5).  No
    broadcast is forced: the seen table grows with the data, so AQE picks a
    broadcast only when the shuffled side measures under the configured
    threshold.
    """
    return firsts.join(seen.select(*key), list(key), "left_anti")


def dau_funnel(startup: DataFrame, batch_seconds: int = 12 * 3600, key=KEY) -> DataFrame:
    """A11 over every micro-batch of a replayed log: raw, not seen, distinct.

    Batch ``b`` holds startups with ``ts`` in ``[b, b + batch_seconds)``.  A
    row is *not seen* when no earlier batch produced its (device, day); the
    distinct step counts those keys once.  All hash aggregates, no window:
    rows -> one count per (key, batch); per key, its first batch and that
    batch's count (``min_by`` over two longs); per batch, the keys first seen
    there.  A device's raw rows never meet in one group.
    """
    ms = batch_seconds * 1000
    per_batch = (
        startup.withColumn("_batch", F.col("ts") - F.pmod(F.col("ts"), F.lit(ms)))
        .groupBy(*key, "_batch")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    raw = per_batch.groupBy("_batch").agg(F.sum("_rows").alias("raw"))
    first = per_batch.groupBy(*key).agg(
        F.min("_batch").alias("_batch"), F.min_by("_rows", "_batch").alias("_first_rows")
    )
    new = first.groupBy("_batch").agg(
        F.sum("_first_rows").alias("not_seen"), F.count(F.lit(1)).alias("distinct")
    )
    agg = raw.join(new, "_batch", "left").select(
        "_batch", "raw",
        F.coalesce(F.col("not_seen"), F.lit(0)).alias("not_seen"),
        F.coalesce(F.col("distinct"), F.lit(0)).alias("distinct"),
    )
    return agg.select(
        F.date_format(F.timestamp_millis(F.col("_batch")), "yyyy-MM-dd HH:mm:ss").alias("batch_start"),
        F.expr("stack(3, 'raw', raw, 'not_seen', not_seen, 'distinct', `distinct`) AS (step, n)"),
    )


SALTS = 16                         # state partitions that a hot device-day is spread over


def dedup_stream(
    stream: DataFrame, event_time: str = "event_time", delay: str = "1 day", key=KEY, salts: int = SALTS
) -> DataFrame:
    """O1: stateful cross-batch dedup of (device, day) on a streaming DataFrame.

    State per key lives until the watermark passes it by ``delay``; two rows
    of one device-day are less than a day apart, so one day bounds the state
    without losing duplicates (SURVEY H1a).  The first arrival wins.

    Spark's streaming dedup has no map-side step, so it runs twice: on (key, salt),
    which spreads a device-day with a third of the rows over ``salts`` partitions,
    then on the key, which gets at most one row a salt.
    """
    rows = stream.withWatermark(event_time, delay)
    if salts > 1:
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).cast("int"))
        rows = rows.dropDuplicatesWithinWatermark([*key, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(list(key))


def first_seen_stream(stream: DataFrame, event_time: str = "event_time", delay: str = "1 day") -> DataFrame:
    """O1 + A2: time, event id and hour of the earliest startup of every (device, day),
    emitted when the watermark closes the day.  ``min`` of one packed decimal is
    partial map-side, so a hot device-day is one row a task, and one row of state."""
    tie = F.coalesce(F.col("event_id").cast("long"), F.lit(NO_EVENT_ID))
    day = F.window(event_time, "1 day").alias("_day")
    firsts = stream.withWatermark(event_time, delay).groupBy("mid", day).agg(F.min(pair_key("ts", tie)).alias("_k"))
    ts, event_id = pair_major(F.col("_k")), pair_minor(F.col("_k"))
    return firsts.select(
        "mid", F.date_format("_day.start", "yyyy-MM-dd").alias("logdate"), log_hour(ts).alias("loghour"),
        ts.alias("ts"), F.nullif(event_id, F.lit(NO_EVENT_ID)).alias("event_id"),
    )

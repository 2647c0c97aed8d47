"""Structured Streaming twins of the batch operators.

Each registered stream query replays the driver's tables into a topic
directory (``sources.stream.replay``), runs the streaming operator with an
``availableNow`` trigger and a checkpoint under the shared work dir, and
returns the sink read back as a batch DataFrame.  Production runs use the
same ``build_*`` functions with ``topic_stream`` on Kafka and a
``processingTime`` trigger (the reference's 5 s batches).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsemart.functions.dates import with_log_date_hour, with_order_date_hour
from pulsemart.functions.json import ONE_PARSE, parse_json
from pulsemart.operators import aggregates as agg
from pulsemart.operators import alert, buffers, cdc, dedup, join
from pulsemart.plans import catalog, reports
from pulsemart.plans import oracle as O
from pulsemart.schemas import (
    EVENT_WIRE, ORDER_DETAIL_WIRE, ORDER_INFO_FIELDS, ORDER_INFO_WIRE, STARTUP_WIRE, USER_INFO_FIELDS, wire_schema,
)
from pulsemart.session import configure, drop_shuffles, work_dir
from pulsemart.sources import adapters as A
from pulsemart.sources import buckets, sinks
from pulsemart.sources.stream import PACKED, count_files, publish, replay, topic_stream
from pulsemart.sources.tables import Tables

DAY_MS = 86_400_000
CLEAN_S = 30                      # shuffle files of micro-batches that are over are dropped so often
BATCH_INTERVAL = "5 seconds"      # the reference's micro-batch (W4)
REPLAY_FILES, REPLAY_BATCH = 9, 3  # files of a topic replayed in event-time order, at least, and of one of its micro-batches
REPLAY_RECORDS = 500_000          # records in such a file of a larger topic, about: one task reads it
TOPIC_FILE_RECORDS = 20_000       # records in a file of a topic without an order
TOPIC_BATCH = 16                  # its files in one micro-batch, at least
TOPIC_BATCHES = 4                 # micro-batches of a topic of any size, about: each rewrites the keyed table it fills

STREAM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
STREAM_ORACLE: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        STREAM_QUERIES[name] = run
        if sql is not None:
            STREAM_ORACLE[name] = sql
        return fn

    return deco


def run_available_now(
    stream: DataFrame,
    checkpoint: str,
    sink_path: str | None = None,
    foreach_batch=None,
    output_mode: str = "append",
    timeout_s: float | None = None,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> None:
    """Drain everything available, then stop.  Restarting with the same
    checkpoint resumes where it stopped (exactly-once file sink, or an
    idempotent ``foreachBatch`` keyed by batch id).  It runs for as long as the
    input takes; a caller may set a limit, beyond which the stream is stopped
    and a TimeoutError raised."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).option("path", sink_path)
        if fmt == "json":
            w = w.options(**PACKED)
        if partition_by:
            w = w.partitionBy(*partition_by)
    q = _start(stream.sparkSession, w.trigger(availableNow=True))
    try:
        if timeout_s is None:
            while not q.awaitTermination(CLEAN_S):
                drop_shuffles(stream.sparkSession)
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError(f"stream did not finish within {timeout_s}s")
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _start(spark: SparkSession, writer):
    """Start with one state partition per task slot.

    A stateful query fixes its state partitioning in the checkpoint at first
    start (from ``spark.sql.shuffle.partitions``; AQE does not resize state).
    Task slots of the cluster is the natural width: every slot serves one
    partition per micro-batch.  The session setting is restored afterwards.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def upsert_each_batch(path: str, key: str, order: str | None = None, n_buckets: int = buckets.BUCKETS):
    """The ``foreachBatch`` writer -- each micro-batch is one upsert batch,
    which rewrites only the buckets its keys fall into."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.upsert(batch, path, batch_id, key, order, n_buckets=n_buckets)

    return write


def dau_batch_writer(
    table_path: str, compact_every: int | None = None, max_day_files: int = 64, sums_path: str | None = None
):
    """O3 + O5 + J1 + A2 + S4/S7/S8: the per-micro-batch DAU hook.

    For each batch: keep the first startup per (device, log day), drop the
    device-days the stored table already holds (read for the batch's days
    only: partition pruning), append the rest.  A replayed batch finds its
    rows already stored and appends nothing, so the hook is idempotent.  The
    seen side is not broadcast by hand: it is the stored table of those days,
    and AQE broadcasts it only when it measures small.

    ``sums_path`` gets two small rows sets a batch, before the rows are appended and
    once only: the added devices by day and hour (``hours``; A7, A8), and what was
    observed while they were computed (``counts``; A11): rows read, rows of unseen
    device-days, device-days added.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # Small files: finish a compaction that died half-way before reading
        # the table; every ``compact_every`` batches rewrite the days that
        # have more than ``max_day_files`` files (this writer is the table's
        # only writer, so no append races the rewrite).
        due = []
        if compact_every and batch_id > 0 and batch_id % compact_every == 0:
            due = [d for d, n in sinks.dau_day_files(spark, table_path).items() if n > max_day_files]
        sinks.compact_dau_days(spark, table_path, due)
        read, added = Observation(), Observation()
        rows = F.coalesce(F.sum("_rows"), F.lit(0))
        firsts = dedup.dau_table(batch, with_rows=True).observe(read, rows.alias("raw")).persist()      # O5
        new = firsts
        try:
            days = [r.logdate for r in firsts.select("logdate").distinct().collect()]  # days of one batch
            if not days:
                return
            seen = sinks.read_dau_table(spark, table_path, days)
            if seen is not None:
                new = dedup.dau_incremental(firsts, seen)
            if sums_path and not sinks.has_rollup(spark, f"{sums_path}/counts", batch_id):
                new = new.observe(added, rows.alias("not_seen"), F.count(F.lit(1)).alias("distinct")).persist()
                sinks.write_rollup(agg.dau_hourly(new).withColumnRenamed("ct", "n"), f"{sums_path}/hours", batch_id)
                counts = {"batch": int(batch_id), **read.get, **added.get}
                sinks.write_rollup(spark.createDataFrame([counts], sinks.COUNTS), f"{sums_path}/counts", batch_id)
            sinks.write_dau_rows(new.select(*batch.columns), table_path)
        finally:
            new.unpersist()
            firsts.unpersist()

    return write


def gmv_batch_writer(path: str, rollup_path: str, n_buckets: int = buckets.BUCKETS):
    """S4 + A9 + A10: orders upserted by id, and each batch's amounts by day and hour as
    a rollup.  Orders are only ever inserted (F1), so the amounts add up."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            amounts = batch.groupBy("create_date", "create_hour").agg(
                F.sum(F.col("total_amount").cast("decimal(28,6)")).alias("amount"), F.count(F.lit(1)).alias("n"))
            sinks.write_rollup(amounts, rollup_path, batch_id)
            sinks.upsert(batch, path, batch_id, "id", n_buckets=n_buckets)
        finally:
            batch.unpersist()

    return write


def alert_document_writer(facts_path: str, path: str, window: str, slide: str | None, n_buckets: int = buckets.BUCKETS):
    """W3 + P9 + S5: each micro-batch of alerts becomes documents, one per device and
    minute (the last window wins), with the lists of accounts and items read from the
    stored facts of the alerts' days."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        documents = alert.alert_per_minute(batch).persist()
        try:
            span = F.lit(alert.duration_ms(window))
            ends = [F.date_format(F.timestamp_millis(F.col("ts") - x), "yyyy-MM-dd") for x in (span, F.lit(1))]
            days = documents.select(F.explode(F.sequence(*[F.to_date(e) for e in ends])).alias("d")).distinct()
            days = [str(r.d) for r in days.collect()]                          # days of one batch
            facts = spark.read.schema(FACTS).parquet(facts_path).where(F.col("day").isin(days))
            sinks.upsert(alert.with_lists(documents, facts, window, slide), path, batch_id, "doc_id", "ts", n_buckets=n_buckets)
        finally:
            documents.unpersist()

    return write


def start_processing_time(
    stream: DataFrame, checkpoint: str, foreach_batch=None, sink_path: str | None = None,
    output_mode: str = "append", interval: str = BATCH_INTERVAL,
):
    """W4 for production: the same query on a ``processingTime`` trigger (the
    reference's 5 s batches).  Returns the running ``StreamingQuery``."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.foreachBatch(foreach_batch) if foreach_batch is not None else w.format("parquet").option("path", sink_path)
    return _start(stream.sparkSession, w.trigger(processingTime=interval))


# --- builders (shared by the registered twins and production jobs) -----------


def build_startup_stream(values: DataFrame) -> DataFrame:
    """S1 + P1 + P3: topic values -> typed startup rows with an event-time column."""
    parsed = parse_json(values, "value", STARTUP_WIRE, casts={"ts": "long", "event_id": "long"})
    return with_log_date_hour(parsed).withColumn("event_time", F.timestamp_millis("ts"))


def build_event_stream(values: DataFrame) -> DataFrame:
    parsed = parse_json(values, "value", EVENT_WIRE, casts={"ts": "long", "event_id": "long"})
    return with_log_date_hour(parsed)


def build_dau_stream(values: DataFrame, delay: str = "1 day") -> DataFrame:
    """O1: first arrival per (device, day) across micro-batches, bounded state."""
    return dedup.dedup_stream(build_startup_stream(values), "event_time", delay)


def _order_sides(
    order_values: DataFrame, line_values: DataFrame, delay: str | None, salts: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Orders and lines as the two sides of an interval join, watermarked where a
    ``delay`` is given.  ``salts``
    spreads a hot order: its lines over so many state partitions, a copy of the
    order in each."""
    o = with_order_date_hour(parse_json(order_values, "value", ORDER_INFO_WIRE, casts={"event_ts": "timestamp"}))
    o = o.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id", F.col("create_date").alias("dt"),
        F.col("event_ts").alias("order_ts"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("o_salt"),
    )
    li = parse_json(line_values, "value", ORDER_DETAIL_WIRE, casts={"event_ts": "timestamp"})
    li = li.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("l_order_id"), "sku_id", "sku_name",
        F.col("order_price").cast("double").alias("sku_price"), F.col("event_ts").alias("line_ts"),
        F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("l_salt"),
    )
    return (o, li) if delay is None else (o.withWatermark("order_ts", delay), li.withWatermark("line_ts", delay))


def _same_order(before: str, after: str):
    return (F.col("order_id") == F.col("l_order_id")) & (F.col("o_salt") == F.col("l_salt")) & join.interval_condition(
        F.col("order_ts"), F.col("line_ts"), before, after)


def build_sale_detail_stream(
    order_values: DataFrame, line_values: DataFrame, delay: str,
    before: str = join.LINE_BEFORE, after: str = join.LINE_AFTER, salts: int = 1,
) -> DataFrame:
    """J3 + O2 + P5 + P8: the wide sale row of every (order, line) pair within the
    interval, as a stream-stream join; expiring buffers become join state.

    Spark drops each side's state once the other side's watermark rules out a
    match (an order after ``after``, a line after ``before``): the
    reference's 10 s / 20 s buffers, here scaled to days (T9).
    """
    o, li = _order_sides(order_values, line_values, delay, salts)
    return o.join(li, _same_order(before, after), "inner").select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id",
        "sku_id", "sku_price", "sku_name", "dt",
    )


def build_buffered_sale_stream(order_values: DataFrame, line_values: DataFrame, delay: str, salts: int = 1) -> DataFrame:
    """J3 + O2 by buffers with a time-to-live of 10 and 20 seconds."""
    o, li = _order_sides(order_values, line_values, None, salts)
    return buffers.buffered_sales(o, li, delay)


def build_unmatched_stream(
    order_values: DataFrame, line_values: DataFrame, delay: str,
    before: str = join.LINE_BEFORE, after: str = join.LINE_AFTER,
) -> DataFrame:
    """J5 as a stream: the orders whose buffer expires without a line.

    A left outer interval join: an order without a match leaves the state as a row
    with null line when the watermark of the lines passes its interval, not before.
    """
    o, li = _order_sides(order_values, line_values, delay)
    joined = o.join(li, _same_order(before, after), "leftOuter")
    return joined.where(F.col("l_order_id").isNull()).select("order_id", "order_status", "user_id", "create_time")


def sale_document_writer(users_path: str, path: str, as_of: str, n_buckets: int = buckets.BUCKETS):
    """J4 + P6 + S5: each micro-batch of sale rows is joined with the user table as it
    is then -- a row per user, as the table's buckets hold it, nothing is resolved
    again -- and upserted as documents by ``order_detail_id``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        users = sinks.read_upserted(batch.sparkSession, users_path).select("id", "gender", "user_level", "birthday")
        documents = join.with_user(batch, join.measured(users), as_of)
        sinks.upsert_documents(documents, path, batch_id, id_col="order_detail_id", order="sku_price", n_buckets=n_buckets)

    return write


def build_user_stream(values: DataFrame) -> DataFrame:
    """S6 stream: user images, typed.  It keeps no state: the sink keeps the image
    with the highest sequence."""
    return parse_json(values, "value", wire_schema(USER_INFO_FIELDS, extra=("seq",)), casts={"seq": "long"})


def build_order_stream(order_values: DataFrame) -> DataFrame:
    """S1 + P1 + P4: routed order records (every value quoted) -> typed orders, all
    18 fields, with create_date and create_hour split from create_time."""
    orders = parse_json(order_values, "value", wire_schema(ORDER_INFO_FIELDS, extra=()), casts={"total_amount": "double"})
    return with_order_date_hour(orders)


CHANGE_WIRE = "schema_name string, table_name string, kind string, op string, after map<string,string>, seq long"


def build_route_stream(change_values: DataFrame) -> DataFrame:
    """S2 + F1-F3 + P2 + S3 as a stream: change records (JSON) -> (topic, key, value).

    Written with ``partition_by=["topic"]`` and the JSON format, each routed
    record lands with its key under ``topic=<name>/`` -- one folder per topic --
    through the exactly-once file sink."""
    changes = change_values.select(F.from_json("value", CHANGE_WIRE, ONE_PARSE).alias("_c")).select("_c.*")
    return cdc.route(changes).select("topic", "key", "value")


FACTS = "mid string, pane timestamp, kind string, val string, day string"


def build_fact_stream(values: DataFrame, slide: str, delay: str) -> DataFrame:
    """The alert's first stateful step as a stream of its own: distinct pane facts,
    written by day.  The alerts and the lists of their documents both read them."""
    return alert.pane_facts(build_event_stream(values), slide, delay).withColumn("day", F.date_format("pane", "yyyy-MM-dd"))


def build_alert_stream(spark: SparkSession, facts_path: str, window: str, slide: str | None, delay: str) -> DataFrame:
    """W1/W2 stream over the stored facts: the alerting windows, in append mode."""
    facts = spark.readStream.schema(FACTS).parquet(facts_path)
    return alert.alerts_of_facts(facts, window, slide, delay)


# --- registered twins ------------------------------------------------------------


def _dirs(t: Tables, name: str) -> tuple[str, str, str, str]:
    base = work_dir(t.spark, "streams", name, fresh=True)
    return f"{base}/topic", f"{base}/topic2", f"{base}/checkpoint", f"{base}/sink"


def _topic_batch(spark: SparkSession, topic: str) -> int:
    """Files of a published topic in one micro-batch.  Their number is bounded by size on a
    live topic; a replayed one is all there, and a keyed table is rewritten by every batch,
    so the batches grow with the topic instead of in number."""
    return max(TOPIC_BATCH, -(-count_files(spark, topic) // TOPIC_BATCHES))


@_register(
    "stream_source_rows",
    O.with_ctes(O.EVENT) + "SELECT event_id, mid, evid, ts AS ts_ms FROM event",
)
def stream_source_rows(t: Tables) -> DataFrame:
    """S1 + P1: events through a topic and a file-sink stream, read back.

    The query is stateless, so arrival order does not matter and the topic is
    written in one job."""
    topic, _, ckpt, sink = _dirs(t, "source_rows")
    ev = A.event(t).withColumn("event_id", F.col("event_id").cast("string"))
    publish(ev, topic, ["mid", "uid", "evid", "itemid", "ts", "event_id"])
    stream = build_event_stream(topic_stream(t.spark, "TOPIC_EVENT", topic, max_per_trigger=_topic_batch(t.spark, topic)))
    run_available_now(stream.select("event_id", "mid", "evid", F.col("ts").alias("ts_ms")), ckpt, sink)
    return t.spark.read.parquet(sink)


def _replayed(rows: DataFrame, topic: str, name: str, time_col: str, count: int) -> DataFrame:
    """About ``count`` rows as a topic in event-time order, and the stream that reads it:
    a larger topic has more files, in as many micro-batches."""
    files = max(REPLAY_FILES, -(-count // REPLAY_RECORDS))
    replay(rows, topic, time_col, files)
    return topic_stream(rows.sparkSession, name, topic, max_per_trigger=-(-files * REPLAY_BATCH // REPLAY_FILES))


_STARTUP_COLS = ["mid", "uid", "area", "os", "vs", "ts", "event_id"]


def _startup_topic(t: Tables, topic: str, closing: bool = False) -> DataFrame:
    """The startups as a topic in event-time order, and the stream that reads it.

    ``closing`` adds a startup of a device of its own some days later: a watermark
    moves on with later records only, and without one the last day stays open."""
    st = A.startup(t).withColumn("event_id", F.col("event_id").cast("string")).select(*_STARTUP_COLS)
    if closing:
        st = st.unionByName(_closing(st, {"mid": CLOSING}))
    return _replayed(st, topic, "TOPIC_STARTUP", "ts", t.events.count())


CLOSING = "closing"               # device or order id of a topic's closing record
CLOSING_DAYS = 60


def _closing(rows: DataFrame, values: dict[str, str], time_col: str = "ts") -> DataFrame:
    """One record ``CLOSING_DAYS`` after the last of ``rows``, other columns null."""
    last = F.max(time_col)
    late = last + CLOSING_DAYS * DAY_MS if dict(rows.dtypes)[time_col] == "bigint" else last + F.expr(f"INTERVAL {CLOSING_DAYS} DAYS")
    found = rows.agg(late.alias(time_col))
    return found.select(*[
        F.col(c) if c == time_col else F.lit(values.get(c)).cast(k).alias(c) for c, k in rows.dtypes
    ])


@_register(
    "dau_stream_dedup",
    O.with_ctes(O.STARTUP) + "SELECT DISTINCT mid, logdate FROM startup",
)
def dau_stream_dedup(t: Tables) -> DataFrame:
    """O1 + W4 + O6: streaming device-day dedup with a 1-day watermark, salted, then
    by key; a device-day is emitted when its first startup arrives."""
    topic, _, ckpt, sink = _dirs(t, "dau")
    stream = build_dau_stream(_startup_topic(t, topic))
    run_available_now(stream.select("mid", "logdate", "loghour", "ts", "event_id"), ckpt, sink)
    return t.spark.read.parquet(sink).select("mid", "logdate")


_FIRSTS_SQL = """SELECT mid, logdate, loghour, ts, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY mid, logdate ORDER BY ts, event_id) AS rn FROM startup) WHERE rn = 1"""


@_register("dau_stream_first", O.with_ctes(O.STARTUP) + _FIRSTS_SQL)
def dau_stream_first(t: Tables) -> DataFrame:
    """O1 + A2: the earliest startup of every device-day, when the day is closed."""
    topic, _, ckpt, sink = _dirs(t, "dau_first")
    stream = dedup.first_seen_stream(build_startup_stream(_startup_topic(t, topic, closing=True)))
    run_available_now(stream, ckpt, sink)
    return t.spark.read.parquet(sink)


_JOIN_DELAY = "1 day"             # the topics are in event-time order


def _sale_topics(t: Tables, topic_o: str, topic_l: str, closing: bool = False) -> tuple[DataFrame, DataFrame]:
    """Orders and lines as two topics in event-time order."""
    orders, lines = A.order_info(t).drop("create_date", "create_hour"), A.order_detail(t)
    if closing:
        orders = orders.unionByName(_closing(orders, {"id": CLOSING, "create_time": "2000-01-01 00:00:00"}, "event_ts"))
        lines = lines.unionByName(_closing(lines, {"id": CLOSING}, "event_ts"))
    return (
        _replayed(orders, topic_o, cdc.TOPIC_ORDER, "event_ts", t.orders.count()),
        _replayed(lines, topic_l, cdc.TOPIC_ORDER_DETAIL, "event_ts", t.lineitem.count()),
    )


JOIN_SALTS = 4                    # state partitions that a hot order's lines are spread over


@_register(
    "order_line_stream_join",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL) + catalog._INTERVAL_SQL,
)
def order_line_stream_join(t: Tables) -> DataFrame:
    """J3 + O2: orders and lines as two topics, joined by a stream-stream interval join."""
    topic_o, topic_l, ckpt, sink = _dirs(t, "order_line")
    sales = build_sale_detail_stream(*_sale_topics(t, topic_o, topic_l), _JOIN_DELAY, salts=JOIN_SALTS)
    run_available_now(sales.select("order_id", "order_detail_id"), ckpt, sink)      # only these go through the state
    return t.spark.read.parquet(sink)


@_register(
    "unmatched_orders_stream",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL)
    + """SELECT id AS order_id, order_status, user_id, create_time FROM order_info o WHERE NOT EXISTS (
  SELECT 1 FROM order_detail d WHERE d.order_id = o.id
  AND d.event_ts BETWEEN o.event_ts - INTERVAL 20 DAY AND o.event_ts + INTERVAL 10 DAY)""",
)
def unmatched_orders_stream(t: Tables) -> DataFrame:
    """The orders that the streaming join's buffers drop unmatched, each when the
    watermark rules a match out."""
    topic_o, topic_l, ckpt, sink = _dirs(t, "unmatched")
    run_available_now(build_unmatched_stream(*_sale_topics(t, topic_o, topic_l, closing=True), _JOIN_DELAY), ckpt, sink)
    return t.spark.read.parquet(sink)


_SALE_STREAM_CTES = (
    O.ORDER_INFO, O.ORDER_DETAIL,
    O.SALE_DETAIL[:-1] + " AND d.event_ts BETWEEN o.event_ts - INTERVAL 20 DAY AND o.event_ts + INTERVAL 10 DAY)",
    O.USERS, O.LATEST_USERS, catalog._SALE_USER_SQL.replace("current_users", "latest_users"),
)


@_register(
    "sale_detail_stream",
    O.with_ctes(*_SALE_STREAM_CTES)
    + """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY sku_price DESC) AS rn FROM sale_user) WHERE rn = 1""",
)
def sale_detail_stream(t: Tables) -> DataFrame:
    """J3 + P5-P8 + J4 + S5: the reference's sale job -- orders and lines joined,
    the latest user looked up per micro-batch, documents upserted by line id (of
    two lines that share an id, T8, the dearer one stays)."""
    topic_o, topic_l, ckpt, table = _dirs(t, "sale_detail")
    users = work_dir(t.spark, "streams", "sale_users", fresh=True)
    n_users, n_lines = buckets.buckets_for(t.customer.count()), buckets.buckets_for(t.lineitem.count())
    sinks.upsert(cdc.user_changes(A.changes(t)).drop("op"), users, 0, "id", "seq", n_buckets=n_users)
    stream = build_sale_detail_stream(*_sale_topics(t, topic_o, topic_l), _JOIN_DELAY, salts=JOIN_SALTS)
    run_available_now(stream, ckpt, foreach_batch=sale_document_writer(users, table, catalog.AS_OF, n_lines))
    return sinks.read_upserted(t.spark, table)


@_register(
    "latest_user_stream",
    O.with_ctes(O.USERS, O.LATEST_USERS) + "SELECT id, login_name, user_level, birthday, gender, seq FROM latest_users",
)
def latest_user_stream(t: Tables) -> DataFrame:
    """S6 stream: routed user changes -> keyed upsert by sequence, without state."""
    topic, _, ckpt, table = _dirs(t, "latest_user")
    rows = cdc.change_rows(A.changes(t)).where(cdc.topic_of() == cdc.TOPIC_USER)
    # The arrival order of one replayed file set is not the change order, so the
    # change sequence travels inside the record.
    value = F.to_json(F.map_concat("after", F.create_map(F.lit("seq"), F.col("seq").cast("string"))))
    publish(rows, topic, value=value, records_per_file=TOPIC_FILE_RECORDS)
    stream = build_user_stream(topic_stream(t.spark, cdc.TOPIC_USER, topic, max_per_trigger=_topic_batch(t.spark, topic)))
    n_buckets = buckets.buckets_for(t.customer.count())
    run_available_now(stream, ckpt, foreach_batch=upsert_each_batch(table, "id", "seq", n_buckets))
    return sinks.read_upserted(t.spark, table)


_FACT_DELAY = "1 hour"            # the replayed events are in event-time order
_ALERT_COLS = ["mid", "window_start", "window_end", "n_accounts", "uids", "item_ids", "ts"]


def _alert_documents(t: Tables, name: str, window: str, slide: str | None, devices=None) -> DataFrame:
    """The two alert streams one after the other: events -> facts, facts -> documents."""
    topic, facts, ckpt, table = _dirs(t, name)
    ev = A.event(t).withColumn("event_id", F.col("event_id").cast("string"))
    if devices is not None:
        ev = ev.withColumn("mid", devices)
    ev = ev.select("mid", "uid", "evid", "itemid", "ts", "event_id")
    ev = ev.unionByName(_closing(ev, {"mid": CLOSING, "uid": CLOSING, "evid": alert.COUPON}))
    values = _replayed(ev, topic, "TOPIC_EVENT", "ts", t.events.count())
    run_available_now(build_fact_stream(values, slide or window, _FACT_DELAY), f"{ckpt}/facts", facts, partition_by=["day"])
    alerts = build_alert_stream(t.spark, facts, window, slide, _FACT_DELAY)
    writer = alert_document_writer(facts, table, window, slide, buckets.buckets_for(t.events.count()))
    run_available_now(alerts, f"{ckpt}/alerts", foreach_batch=writer)
    found = sinks.read_upserted(t.spark, table)
    if found is None:                                                     # no alert at all
        found = t.spark.createDataFrame([], "doc_id string, mid string, window_start string, window_end string, "
                                            "n_accounts long, ts long, uids string, item_ids string")
    return found


@_register("coupon_alert_stream", catalog._TUMBLING + "SELECT mid, window_start, window_end, n_accounts, uids, item_ids, ts FROM alerts")
def coupon_alert_stream(t: Tables) -> DataFrame:
    """W2 + O4 stream: 12 h windows; each alert once, when its window closes."""
    return _alert_documents(t, "alert", catalog.ALERT_WINDOW, None).select(*_ALERT_COLS)


@_register("coupon_alert_stream_sliding", catalog._MINUTE_ALERTS)
def coupon_alert_stream_sliding(t: Tables) -> DataFrame:
    """W1 + W3 + A3 + P9 stream: windows sliding by half a minute, merged from panes,
    and one document per device and minute: the later window of a minute replaces
    the earlier one's."""
    found = _alert_documents(t, "alert_sliding", catalog.MINUTE_WINDOW, catalog.MINUTE_SLIDE, catalog.minute_device())
    return found.select("doc_id", *_ALERT_COLS)


def _dau_job(t: Tables, name: str) -> tuple[str, str]:
    """The reference's DAU job over the replayed startups: (table, sums)."""
    topic, sums, ckpt, table = _dirs(t, name)
    stream = build_startup_stream(_startup_topic(t, topic)).drop("event_time")
    run_available_now(stream, ckpt, foreach_batch=dau_batch_writer(table, compact_every=2, sums_path=sums))
    return table, sums


@_register("dau_stream_upsert", O.with_ctes(O.STARTUP) + _FIRSTS_SQL)
def dau_stream_upsert(t: Tables) -> DataFrame:
    """O3 + S4 + S7-S9 + P12: the reference's DAU job -- per batch, dedup, anti-join
    to the stored table, append -- as a ``foreachBatch`` stream; the stored row is the
    earliest startup."""
    table, _ = _dau_job(t, "dau_upsert")
    return sinks.read_dau_table(t.spark, table).select(
        "mid", "logdate", "loghour", "ts", F.col("event_id").cast("long").alias("event_id"))


@_register(
    "dau_stream_counts",
    O.with_ctes(O.STARTUP)
    + """SELECT count(*) AS raw, count(DISTINCT (mid, logdate)) AS n_distinct, true AS ordered FROM startup""",
)
def dau_stream_counts(t: Tables) -> DataFrame:
    """What the running job observed, added up over its batches; in each batch
    rows read >= rows of unseen device-days >= device-days added."""
    _, sums = _dau_job(t, "dau_counts")
    rows = sinks.read_rollup(t.spark, f"{sums}/counts")
    return rows.agg(
        F.sum("raw").alias("raw"), F.sum("distinct").alias("n_distinct"),
        F.bool_and((F.col("raw") >= F.col("not_seen")) & (F.col("not_seen") >= F.col("distinct"))).alias("ordered"))


@_register(
    "dau_rollup_hourly",
    O.with_ctes(O.STARTUP, catalog._DAU_FIRST_SQL) + "SELECT logdate, loghour AS lh, count(*) AS ct FROM dau GROUP BY ALL",
)
def dau_rollup_hourly(t: Tables) -> DataFrame:
    """A7 + A8: devices per day and hour from the partial counts the job keeps."""
    _, sums = _dau_job(t, "dau_rollup")
    return agg.rolled_up(sinks.read_rollup(t.spark, f"{sums}/hours"), "logdate", "lh").select("logdate", "lh", F.col("n").alias("ct"))


@_register("cdc_route_stream", catalog.ORACLE["cdc_route"])
def cdc_route_stream(t: Tables) -> DataFrame:
    """S2 + S3 + F1-F3 stream: the change feed as a topic, routed by a stream
    into one folder per topic, every record read back and parsed.  Routing looks at
    one record at a time, so arrival order does not matter and the feed is
    written in one job."""
    topic, _, ckpt, sink = _dirs(t, "cdc_route")
    changes = A.changes(t)
    publish(changes, topic, value=F.to_json(F.struct(*changes.columns)), records_per_file=TOPIC_FILE_RECORDS)
    stream = build_route_stream(topic_stream(t.spark, "CHANGES", topic, max_per_trigger=_topic_batch(t.spark, topic)))
    run_available_now(stream, ckpt, sink, partition_by=["topic"], fmt="json")
    return catalog.routed_records(t.spark, sink)


def _order_job(t: Tables, name: str, records: DataFrame | None = None) -> tuple[str, str]:
    """E4, the reference's order job: the routed order topic -> all fields, quoted
    numbers parsed -> date and hour -> keyed upsert of the order table by id, and
    the amounts by day and hour: (table, rollup)."""
    topic, _, ckpt, table = _dirs(t, name)
    routed = cdc.route(A.order_changes(t)) if records is None else records
    publish(routed, topic, value=F.col("value"), records_per_file=TOPIC_FILE_RECORDS)
    stream = build_order_stream(topic_stream(t.spark, cdc.TOPIC_ORDER, topic, max_per_trigger=_topic_batch(t.spark, topic)))
    n_buckets = buckets.buckets_for((t.orders if records is None else t.events).count())
    run_available_now(stream, ckpt, foreach_batch=gmv_batch_writer(table, f"{table}_rollup", n_buckets))
    return table, f"{table}_rollup"


@_register(
    "kpi_rollup_day",
    O.with_ctes(O.STARTUP, O.PURCHASES)
    + f"""SELECT '{catalog.REPORT_DAY}' AS day, 'dau' AS id, CAST(count(DISTINCT mid) AS DOUBLE) AS value
FROM startup WHERE logdate = '{catalog.REPORT_DAY}'
UNION ALL SELECT '{catalog.REPORT_DAY}', 'order_amount', round(sum(total_amount), 2)
FROM purchases WHERE create_date = '{catalog.REPORT_DAY}'""",
)
def kpi_rollup_day(t: Tables) -> DataFrame:
    """R1 + A7 + A9 of one day from the partial sums that the DAU job and the order job
    keep, the latter over the purchases."""
    _, sums = _dau_job(t, "kpi_dau")
    purchases = A.purchases(t).select("id", "user_id", F.col("total_amount").cast("string").alias("total_amount"), "create_time")
    _, rollup = _order_job(t, "kpi_gmv", purchases.select(F.to_json(F.struct(*purchases.columns)).alias("value")))
    return reports.kpi_rolled_up(
        sinks.read_rollup(t.spark, f"{sums}/hours"), sinks.read_rollup(t.spark, rollup), catalog.REPORT_DAY)


@_register("gmv_stream_upsert", catalog.ORACLE["cdc_order_amounts"])
def gmv_stream_upsert(t: Tables) -> DataFrame:
    """E4 + A9: amount and orders per day from the amounts the order job keeps."""
    _, rollup = _order_job(t, "gmv")
    days = agg.rolled_up(sinks.read_rollup(t.spark, rollup), "create_date")
    return days.select("create_date", F.round(F.col("amount").cast("double"), 2).alias("sum_amount"), "n")


@_register("order_table_stream", O.with_ctes(O.ORDER_TABLE) + "SELECT * FROM order_table")
def order_table_stream(t: Tables) -> DataFrame:
    """S4 + P4 + P12: the order table as the order job stores it, all 20 columns."""
    table, _ = _order_job(t, "order_table")
    columns = [*ORDER_INFO_FIELDS, "create_date", "create_hour"]
    return sinks.upper_case_columns(sinks.read_upserted(t.spark, table).select(*columns))

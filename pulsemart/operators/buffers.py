"""Order and line buffers with a time-to-live (O2): per-order state with timers.

The reference keeps an order for 10 seconds and a line for 20 seconds, and joins
whichever arrives second with what is waiting.  Here the buffers are state of one
stateful operator keyed by (order id, salt): an order value and a map of waiting
lines, each with an event-time timer that removes it when the watermark has passed
its lifetime.  All waiting lines are kept, each pair is emitted once (D3, D4).

The interval join of ``streaming.jobs`` gives the same pairs by Spark's own join
state; this form is the one to run where the state has to be empty after seconds,
or read from outside while the stream runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

ORDER_SECONDS, LINE_SECONDS = 10, 20         # fixed lifetimes of an order and of a line

_ORDER = "at long, order_status string, create_time string, user_id string, dt string"
_LINE = "at long, sku_id string, sku_price double, sku_name string"
SALES = ("order_detail_id string, order_id string, order_status string, create_time string, user_id string, "
         "sku_id string, sku_price double, sku_name string, dt string")


class OrderLineBuffers(StatefulProcessor):
    """The two buffers of one order.  Input rows are orders (``order_detail_id`` null)
    or lines; ``at`` is their event time in ms."""

    def __init__(self, order_ms: int = ORDER_SECONDS * 1000, line_ms: int = LINE_SECONDS * 1000) -> None:
        self.order_ms, self.line_ms = order_ms, line_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.order = handle.getValueState("order", _ORDER)
        self.lines = handle.getMapState("lines", "order_detail_id string", _LINE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows))
        found = []
        for row in batch[batch.order_detail_id.isna()].itertuples():
            order = (int(row.at_ms), row.order_status, row.create_time, row.user_id, row.dt)
            self.order.update(order)
            self.handle.registerTimer(order[0] + self.order_ms + 1)
            found += [(order, k[0], tuple(line)) for k, line in self.lines.iterator() if self._meet(order, line)]
        order = self.order.get() if self.order.exists() else None
        for row in batch[batch.order_detail_id.notna()].itertuples():
            line = (int(row.at_ms), row.sku_id, None if pd.isna(row.sku_price) else float(row.sku_price), row.sku_name)
            if order is not None and self._meet(order, line):
                found.append((order, row.order_detail_id, line))
            self.lines.updateValue((row.order_detail_id,), line)
            self.handle.registerTimer(line[0] + self.line_ms + 1)
        if found:
            yield pd.DataFrame(
                [(d, key[0], o[1], o[2], o[3], li[1], li[2], li[3], o[4]) for o, d, li in found],
                columns=[c.split()[0] for c in SALES.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.order.exists() and self.order.get()[0] + self.order_ms < now:
            self.order.clear()
        for line in [k for k, v in self.lines.iterator() if v[0] + self.line_ms < now]:
            self.lines.removeKey(line)
        return iter([])

    def _meet(self, order, line) -> bool:
        """A line up to ``line_ms`` ahead of its order or ``order_ms`` behind it."""
        return -self.line_ms <= line[0] - order[0] <= self.order_ms

    def close(self) -> None:
        pass


def buffered_sales(
    orders: DataFrame, lines: DataFrame, delay: str, order_ms: int = ORDER_SECONDS * 1000, line_ms: int = LINE_SECONDS * 1000
) -> DataFrame:
    """The sale rows of two streams: ``orders`` (order_id, order_status, create_time,
    user_id, dt, order_ts, o_salt) and ``lines`` (order_detail_id, l_order_id, sku_id,
    sku_price, sku_name, line_ts, l_salt).  Lines without an order id meet none."""
    none = lambda t: F.lit(None).cast(t)
    rows = orders.select(
        "order_id", F.col("o_salt").alias("salt"), F.col("order_ts").alias("at"), none("string").alias("order_detail_id"),
        "order_status", "create_time", "user_id", "dt",
        none("string").alias("sku_id"), none("double").alias("sku_price"), none("string").alias("sku_name"),
    ).unionByName(lines.select(
        F.col("l_order_id").alias("order_id"), F.col("l_salt").alias("salt"), F.col("line_ts").alias("at"), "order_detail_id",
        none("string").alias("order_status"), none("string").alias("create_time"), none("string").alias("user_id"),
        none("string").alias("dt"), "sku_id", "sku_price", "sku_name",
    ))
    rows = rows.where(F.col("order_id").isNotNull()).withColumn("at_ms", F.unix_millis("at")).withWatermark("at", delay)
    return rows.groupBy("order_id", "salt").transformWithStateInPandas(
        OrderLineBuffers(order_ms, line_ms), SALES, outputMode="Append", timeMode="EventTime")

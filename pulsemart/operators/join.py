"""Order <-> order-line <-> user joins.

All are equi-joins on the order or user id, so Spark hash-partitions both
sides on the key (or broadcasts one when AQE measures it small).  The
interval condition of J3 is a residual filter on the co-partitioned rows;
there is no cross product anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions.dates import whole_year_age
from pulsemart.session import work_dir

# Buffer lengths of the reference (10 s order buffer, 20 s line buffer) scaled
# to days for the tables, where ship date - order date spans years.
LINE_BEFORE = "20 days"
LINE_AFTER = "10 days"

# Largest side broadcast after measuring it (the session's broadcast bound).
BROADCAST_MAX_BYTES = 32 << 20


def order_line_full_outer(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Every order and every line; ``side`` tells which sides matched.

    Written as ``lines LEFT JOIN orders`` plus the orders no line names, which
    is the full outer join row for row (duplicates included).  AQE can split a
    skewed key of the left side of a left join, never of a full outer join, so
    an order holding a third of all lines does not land in one task.  The
    line side of the anti join is reduced to distinct order ids first
    (partial aggregation map-side), so a hot order id is one row per task.
    """
    o = orders.select(F.col("id").alias("order_id"), F.lit(True).alias("_o"))
    li = lines.select("order_id", F.col("id").alias("order_detail_id"))
    matched_or_line = li.join(o, "order_id", "left").select(
        "order_id", "order_detail_id",
        F.when(F.col("_o"), F.lit("both")).otherwise(F.lit("line_only")).alias("side"),
    )
    order_only = _orders_without_lines(o, lines).select(
        "order_id", F.lit(None).cast("string").alias("order_detail_id"), F.lit("order_only").alias("side")
    )
    return matched_or_line.unionByName(order_only)


def _orders_without_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders (with an ``order_id`` column) that no line names."""
    return orders.join(lines.select("order_id").distinct(), "order_id", "left_anti")


def interval_condition(order_ts, line_ts, before: str = LINE_BEFORE, after: str = LINE_AFTER):
    """Line time within [order - before, order + after], both ends included."""
    return (line_ts >= order_ts - F.expr(f"INTERVAL {before}")) & (
        line_ts <= order_ts + F.expr(f"INTERVAL {after}")
    )


def order_line_interval_join(
    orders: DataFrame, lines: DataFrame, before: str = LINE_BEFORE, after: str = LINE_AFTER
) -> DataFrame:
    """J3 (batch twin): a line joins its order when it arrives no more than
    ``before`` ahead of the order or ``after`` behind it; other lines and
    orders are dropped, as the reference's expiring buffers drop them."""
    o = orders.select(F.col("id").alias("order_id"), F.col("event_ts").alias("order_ts"))
    li = lines.select("order_id", F.col("id").alias("order_detail_id"), F.col("event_ts").alias("line_ts"))
    cond = (o.order_id == li.order_id) & interval_condition(o.order_ts, li.line_ts, before, after)
    return o.join(li, cond, "inner").select(o.order_id, "order_detail_id")


def unmatched_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders that no line ever joins (audit of what J3 drops)."""
    return _orders_without_lines(orders.select(F.col("id").alias("order_id")), lines)


def sale_detail(orders: DataFrame, lines: DataFrame, strict: bool = True) -> DataFrame:
    """P5 + P8: the wide sale row of every matched (order, line) pair.

    ``sku_price`` is the line's string price cast to double (ANSI cast: a bad
    price fails the job, as in the reference; ``strict=False`` gives NULL).
    """
    o = orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"),
    )
    price = F.col("order_price")
    price = price.cast("double") if strict else price.try_cast("double")
    name = F.col("sku_name") if "sku_name" in lines.columns else F.lit(None).cast("string")
    li = lines.select(
        F.col("id").alias("order_detail_id"), "order_id", "sku_id", name.alias("sku_name"),
        price.alias("sku_price"),
    )
    return li.join(o, "order_id", "inner").select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id",
        "sku_id", "sku_price", "sku_name", "dt",
    )


def add_user_attributes(df: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """J4 + P6 + P7 on any frame with a ``user_id``: gender, level and
    whole-year age of the latest user row; an unknown user gets age 0 and
    NULL gender and level (the defaults of the reference's record)."""
    u = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        F.col("user_level"),
        whole_year_age(F.col("birthday"), as_of).alias("_age"),
    )
    joined = df.join(u, "user_id", "left")
    return joined.withColumn("user_age", F.coalesce(F.col("_age"), F.lit(0))).drop("_age")


def with_user(sales: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """J4 + P6 + P7: the wide sale row with the attributes of its user; a sale
    whose user is unknown keeps its user id."""
    return add_user_attributes(sales, users, as_of).select(
        "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
        "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt",
    )


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df`` measured, not estimated: rows times the fixed
    width of its non-string columns plus the actual bytes of its strings.
    One aggregate job; a single row comes back."""
    strings = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    fixed = sum(f.dataType().defaultSize() for f in df._jdf.schema().fields() if f.name() not in strings)
    text = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in strings), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("s")).first()
    per_row = fixed + 8 * len(strings)          # offset and length of each string
    return int(row["n"]) * per_row + int(row["s"] or 0)


def measured(side: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``side`` of a join, hinted by what it measures: broadcast up to ``max_bytes``, else a
    merge join.  Without a hint Spark goes by the size of the side's files, and a table
    that compresses well is many times as large in the driver's memory."""
    return F.broadcast(side) if measured_bytes(side) <= max_bytes else side.hint("merge")


def join_checked_small(
    big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Join ``big`` with a side that is usually small, broadcasting it only
    when measured under ``max_bytes``; otherwise a shuffled join.

    The side is first checkpointed (reliable, in the shared checkpoint
    folder): it is computed once, its lineage is cut, and the measurement
    reads the written data.  Broadcasting avoids a full shuffle of ``big``,
    which AQE cannot avoid on its own: it decides after both shuffle stages
    have run.
    """
    work_dir(small.sparkSession)                 # a checkpoint folder exists (set only where unset)
    small = small.checkpoint(eager=True)
    if measured_bytes(small) <= max_bytes:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)

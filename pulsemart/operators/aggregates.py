"""Counts and sums behind the dashboard tiles.

All of them are plain ``groupBy().agg()`` with partial (map-side) aggregation.
Sums of doubles are rounded to 2 places: addition order differs between
engines and runs (SURVEY H4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fixed report parameters (our choices; SURVEY A13/A14).
AGE_BUCKETS = (("<20", None, 20), ("20-29", 20, 30), (">=30", 30, None))
PROVINCE_BIN_WIDTH = 100


def _on_day(df: DataFrame, col: str, day: str | None) -> DataFrame:
    """optional equality on a day column.  On a stored table partitioned by
    that day it prunes folders (``sinks.read_dau_table``, ``read_order_table``);
    on a day derived from a timestamp it is tested after the scan."""
    return df if day is None else df.where(F.col(col) == F.lit(day))


def dau_total(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Device count per day (``count(*)`` of the DAU table)."""
    return _on_day(dau, "logdate", day).groupBy("logdate").agg(F.count(F.lit(1)).alias("ct"))


def dau_hourly(dau: DataFrame, day: str | None = None) -> DataFrame:
    """Device count per day and first-seen hour."""
    return (
        _on_day(dau, "logdate", day)
        .groupBy("logdate", F.col("loghour").alias("lh"))
        .agg(F.count(F.lit(1)).alias("ct"))
    )


def gmv_total(orders: DataFrame, day: str | None = None) -> DataFrame:
    """Order amount per day (NULL sum for a day whose amounts are all NULL)."""
    return (
        _on_day(orders, "create_date", day)
        .groupBy("create_date")
        .agg(F.round(F.sum("total_amount"), 2).alias("sum_amount"))
    )


def gmv_hourly(orders: DataFrame, day: str | None = None) -> DataFrame:
    """A10: order amount per day and hour, as double."""
    return (
        _on_day(orders, "create_date", day)
        .groupBy("create_date", "create_hour")
        .agg(F.round(F.sum("total_amount").cast("double"), 2).alias("sum_amount"))
    )


def rolled_up(rollup: DataFrame, *by: str) -> DataFrame:
    """A7-A10 from a rollup: its partial sums ``n`` and ``amount`` added up by ``by``."""
    return rollup.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", "amount") if c in rollup.columns])


def _with_share(counts: DataFrame) -> DataFrame:
    # The window has no partition key on purpose: it runs over the handful of
    # bucket rows left after the aggregation, never over raw rows.
    total = F.sum("ct").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("ct") / total, 4))


def _rows(weight: str | None):
    """Row count, or the sum of a per-row count column when rows were
    pre-aggregated (e.g. one row per user with its number of sales)."""
    return F.count(F.lit(1)) if weight is None else F.sum(weight).cast("long")


def facet_gender(sales: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per gender and their share of all rows."""
    counts = sales.groupBy(F.col("user_gender").alias("bucket")).agg(_rows(weight).alias("ct"))
    return _with_share(counts)


def age_bucket(age_col: str = "user_age"):
    expr = None
    for label, lo, hi in AGE_BUCKETS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(age_col) >= lo)
        if hi is not None:
            cond = cond & (F.col(age_col) < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def facet_age(sales: DataFrame, weight: str | None = None) -> DataFrame:
    """Rows per age bucket (<20, 20-29, >=30) and their share."""
    counts = sales.groupBy(age_bucket().alias("bucket")).agg(_rows(weight).alias("ct"))
    return _with_share(counts)


def sales_by_province(orders: DataFrame, user_provinces: DataFrame | None = None) -> DataFrame:
    """Orders and amount per province, with a colour bin of width 100 orders.

    ``orders`` carries ``province_id``, or ``user_provinces`` (user_id,
    province_id) maps each order's user to one.  With the map, orders are
    first reduced to one row per user (partial aggregation map-side), so the
    join meets one row per user instead of every order, and a user with a
    third of all orders is one row per task before any shuffle.
    """
    if user_provinces is not None:
        per_user = orders.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("_n"), F.sum("total_amount").alias("_amount")
        )
        orders = per_user.join(user_provinces, "user_id", "left")
        ct, amount = F.sum("_n"), F.sum("_amount")
    else:
        ct, amount = F.count(F.lit(1)), F.sum("total_amount")
    agg = orders.groupBy("province_id").agg(ct.alias("ct"), F.round(amount, 2).alias("amount"))
    return agg.withColumn("bin", F.floor(F.col("ct") / PROVINCE_BIN_WIDTH).cast("long"))

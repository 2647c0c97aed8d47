"""Dashboard and search reports composed from the operators.

Each report takes an optional ``day``: with a day it answers the reference's
request for that date (equality filter pushed to the scan); without it, it
answers for every day at once, which is the same plan minus the filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.functions.dates import DAY_FORMAT, next_day
from pulsemart.operators.aggregates import dau_hourly, facet_age, facet_gender, gmv_hourly, gmv_total



def device_days(dau: DataFrame) -> DataFrame:
    """(logdate, dau, new_mid): devices of a day, and those whose first-ever day it is
    (the reference shows a constant).

    One frame for both: a device's days are folded to one array (partial map-side, as
    long as the table has days), then counted by day.
    """
    days = dau.groupBy("mid").agg(F.collect_set(F.to_date("logdate", DAY_FORMAT)).alias("_days"))
    rows = days.select(F.explode("_days").alias("_d"), F.array_min("_days").alias("_first"))
    return rows.groupBy(F.date_format("_d", DAY_FORMAT).alias("logdate")).agg(
        F.count(F.lit(1)).alias("dau"), F.count_if(F.col("_d") == F.col("_first")).alias("new_mid"))


def kpi_total(dau: DataFrame, orders: DataFrame, day: str | None = None) -> DataFrame:
    """(day, id, value) for dau, new_mid and order_amount.

    With a ``day`` the three rows always exist: a day without data gives
    dau 0, new_mid 0 and order_amount NULL, as count and sum do (SURVEY H6).
    """
    devices = device_days(dau)
    if day is not None:
        d = F.lit(day)
        devices = devices.where(F.col("logdate") == d).agg(
            d.alias("logdate"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("dau", "new_mid")])
        amounts = orders.where(F.col("create_date") == d).agg(F.round(F.sum("total_amount"), 2).alias("value")).select(
            d.alias("day"), F.lit("order_amount").alias("id"), "value")
    else:
        amounts = gmv_total(orders).select(
            F.col("create_date").alias("day"), F.lit("order_amount").alias("id"), F.col("sum_amount").alias("value"))
    tiles = F.expr("stack(2, 'dau', CAST(dau AS DOUBLE), 'new_mid', CAST(new_mid AS DOUBLE)) AS (id, value)")
    # a day without a new device has no such tile, unless the day was asked for
    tiles = devices.select(F.col("logdate").alias("day"), tiles).where((F.col("value") > 0) | F.lit(day is not None))
    return tiles.unionByName(amounts)


def kpi_rolled_up(dau_hours: DataFrame, order_hours: DataFrame, day: str) -> DataFrame:
    """R1 of one day from the rollups that the streaming jobs keep: dau and
    order_amount, without a look at devices or orders."""
    d = F.lit(day)
    dau = dau_hours.where(F.col("logdate") == d).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("value"))
    amount = order_hours.where(F.col("create_date") == d).agg(F.round(F.sum("amount").cast("double"), 2).alias("value"))
    return dau.select(d.alias("day"), F.lit("dau").alias("id"), "value").unionByName(
        amount.select(d.alias("day"), F.lit("order_amount").alias("id"), "value"))


def _compare(hourly: DataFrame, day_col: str, hour_col: str, value_col: str, day: str | None) -> DataFrame:
    """Today against yesterday per hour, by one aggregation (no self-join).

    Every hourly row is emitted twice -- as *today* of its own day and as
    *yesterday* of the next day -- by one ``explode`` over the single hourly
    aggregate, and one ``groupBy(day, hour)`` lines them up.
    """
    if day is not None:
        hourly = hourly.where(F.col(day_col).isin(day, previous_day(day)))
    none = F.lit(None).cast(hourly.schema[value_col].dataType)
    value, hour = F.col(value_col), F.col(hour_col)
    as_today = F.struct(F.col(day_col).alias("logdate"), hour.alias("hour"), value.alias("today"), none.alias("yesterday"))
    as_yesterday = F.struct(next_day(F.col(day_col)).alias("logdate"), hour.alias("hour"), none.alias("today"), value.alias("yesterday"))
    both = hourly.select(F.explode(F.array(as_today, as_yesterday)).alias("_r")).select("_r.*")
    if day is not None:
        both = both.where(F.col("logdate") == day)
    return both.groupBy("logdate", "hour").agg(
        F.max("yesterday").alias("yesterday"), F.max("today").alias("today")
    )


def previous_day(day: str) -> str:
    """The day before a given one, as text."""
    import datetime as _dt

    return (_dt.date.fromisoformat(day) - _dt.timedelta(days=1)).isoformat()


def hourly_compare(metric_id: str, dau: DataFrame, orders: DataFrame, day: str | None = None) -> DataFrame:
    """R2 + P11: (logdate, hour, yesterday, today) for ``dau`` or ``order_amount``.

    An unknown id gives no rows (the reference answers two NULL maps).
    """
    if metric_id == "order_amount":
        return _compare(gmv_hourly(orders), "create_date", "create_hour", "sum_amount", day)
    out = _compare(dau_hourly(dau), "logdate", "lh", "ct", day)
    return out if metric_id == "dau" else out.where(F.lit(False))


def hourly_zero_fill(hourly: DataFrame, day: str | None = None, spark=None) -> DataFrame:
    """24 rows per day, missing hours as 0.

    One pass over the hourly counts: each day's counts become a map of at
    most 24 entries, then ``explode(sequence(0, 23))`` -- a generator, not a
    cross join -- walks the hours and looks each one up.  For a requested day
    the day list is that one day, so an empty day still gives 24 zero rows.
    """
    if day is not None:
        hourly = hourly.where(F.col("logdate") == day)
    per_day = hourly.groupBy("logdate").agg(F.map_from_entries(F.collect_list(F.struct("lh", "ct"))).alias("_m"))
    if day is not None:
        session = spark or hourly.sparkSession
        one = session.range(1).select(F.lit(day).alias("logdate"))
        per_day = one.join(per_day, "logdate", "left")   # one row on each side at most
    hours = per_day.select("logdate", "_m", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h")).select(
        "logdate", "_m", F.lpad(F.col("_h").cast("string"), 2, "0").alias("lh")
    )
    return hours.select(
        "logdate", "lh", F.coalesce(F.element_at(F.col("_m"), F.col("lh")), F.lit(0)).cast("long").alias("ct")
    )


def hour_map(hourly: DataFrame, hour_col: str = "lh", value_col: str = "ct", day_col: str = "logdate") -> DataFrame:
    """One row per day with a map hour -> value (at most 24 entries)."""
    return hourly.groupBy(day_col).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(hour_col, value_col)))).alias("hours")
    )


# --- search (F7, R5, L2) ----------------------------------------------------

SEARCH_ORDER = ("dt", "order_id", "order_detail_id")


def sale_search(sales: DataFrame, day: str | None = None, keyword: str = "") -> DataFrame:
    """optional day equality and case-insensitive keyword on the sku name.

    An empty keyword means no keyword filter, as in the reference's form.
    """
    out = sales
    if day:
        out = out.where(F.col("dt") == day)
    if keyword:
        out = out.where(F.lower(F.col("sku_name")).contains(keyword.lower()))
    return out


def sale_search_total(found: DataFrame) -> DataFrame:
    return found.agg(F.count(F.lit(1)).alias("total"))


def sale_search_page(found: DataFrame, page: int = 1, size: int = 20) -> DataFrame:
    """L2: rows ``(page-1)*size`` .. ``page*size-1`` in a total order.

    The sort key is unique, so pages never overlap; Spark plans the limit as a
    per-partition top-k merged once, good for shallow pages.
    """
    return found.orderBy(*SEARCH_ORDER).offset((page - 1) * size).limit(size)


def sale_search_after(found: DataFrame, after: tuple[str, str, str] | None, size: int = 20) -> DataFrame:
    """L2 by key: the ``size`` rows that follow the row with the order key ``after``
    (dt, order id, line id), the first ones for None.

    A deep page costs what the first one does: rows before it are filtered out, not
    sorted and skipped, and every task keeps ``size`` rows.  The key of a page's last
    row asks for the next one.
    """
    if after is not None:
        key, passed = F.lit(False), F.lit(True)
        for name, value in zip(SEARCH_ORDER, after):
            key = key | (passed & (F.col(name) > F.lit(value)))
            passed = passed & (F.col(name) == F.lit(value))
        found = found.where(F.col(SEARCH_ORDER[0]) >= F.lit(after[0])).where(key)
    return found.orderBy(*SEARCH_ORDER).limit(size)


def sale_search_report(sales: DataFrame, path: str, day=None, keyword="", page=1, size=20) -> DataFrame:
    """Total, facets and one page of one search as rows (section, key, n, share).

    The matches are written once to ``path`` and every section reads them from
    there, so the joins behind ``sales`` run once.  A page row's ``n`` is its
    place in the whole result.
    """
    sale_search(sales, day, keyword).write.mode("overwrite").parquet(path)
    found = sales.sparkSession.read.parquet(path)
    no_share = F.lit(None).cast("double").alias("share")
    total = sale_search_total(found).select(F.lit("total").alias("section"), F.lit("").alias("key"), F.col("total").alias("n"), no_share)
    facets = [
        facet.select(F.lit(name).alias("section"), F.col("bucket").alias("key"), F.col("ct").alias("n"), "share")
        for name, facet in (("gender", facet_gender(found)), ("age", facet_age(found)))
    ]
    place = F.row_number().over(Window.orderBy(*SEARCH_ORDER)) + F.lit((page - 1) * size)    # of one page's rows
    rows = sale_search_page(found, page, size).select(
        F.lit("page").alias("section"), F.col("order_detail_id").alias("key"), place.cast("long").alias("n"), no_share)
    return total.unionByName(facets[0]).unionByName(facets[1]).unionByName(rows)

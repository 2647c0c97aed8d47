"""Time derivations (P3, P4, P7, P11) as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    """Timestamp -> epoch milliseconds (bigint)."""
    return F.unix_millis(_col(ts))


def log_date(ts_ms) -> Column:
    """Epoch ms -> ``yyyy-MM-dd`` in the session zone."""
    return F.date_format(F.timestamp_millis(_col(ts_ms)), DAY_FORMAT)


def log_hour(ts_ms) -> Column:
    """Epoch ms -> two-digit hour ``HH`` in the session zone."""
    return F.date_format(F.timestamp_millis(_col(ts_ms)), HOUR_FORMAT)


def with_log_date_hour(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"logdate": log_date(ts), "loghour": log_hour(ts)})


def order_date(create_time) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> date part, by splitting (no parsing)."""
    return F.get(F.split(_col(create_time), " "), 0)


def order_hour(create_time) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` -> ``HH``; null when the time part is missing."""
    return F.get(F.split(F.get(F.split(_col(create_time), " "), 1), ":"), 0)


def with_order_date_hour(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    return df.withColumns(
        {"create_date": order_date(create_time), "create_hour": order_hour(create_time)}
    )


def idiv(c: Column, n: int) -> Column:
    """Integral division truncating toward zero, as JVM ``long / long``.

    ``c - c % n`` is an exact multiple of ``n`` (``%`` keeps the dividend's
    sign), so the division is exact and the cast loses nothing.
    """
    return ((c - c % F.lit(n)) / F.lit(n)).cast("long")


def whole_year_age(birthday, as_of) -> Column:
    """Age in whole 365-day years.

    Milliseconds between the birthday (``yyyy-MM-dd``, midnight in the session
    zone) and ``as_of``, integer-divided step by step by 1000, 60, 60, 24 and
    365: leap days are ignored and the result truncates.  ``as_of`` is an
    argument (a timestamp column or a literal string), never the wall clock,
    so results are reproducible.
    """
    as_of_col = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    born = F.to_timestamp(_col(birthday), DAY_FORMAT)
    out = F.unix_millis(as_of_col) - F.unix_millis(born)
    for step in (1000, 60, 60, 24, 365):
        out = idiv(out, step)
    return out.cast("int")


def next_day(day) -> Column:
    """``yyyy-MM-dd`` string -> the calendar day after, same format."""
    return F.date_format(F.date_add(F.to_date(_col(day), DAY_FORMAT), 1), DAY_FORMAT)

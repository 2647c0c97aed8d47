"""The query catalogue: one Spark query per operator of SURVEY §2, each with
its DuckDB oracle statement.

Every query reads the driver's tables (or data Spark derives from them) in
full; parameters below are fixed values of the reports, not samples.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemart.functions.json import ONE_PARSE, parse_json
from pulsemart.operators import aggregates as agg
from pulsemart.operators import alert, cdc, dedup, join
from pulsemart.plans import oracle as O
from pulsemart.plans import reports
from pulsemart.schemas import wire_schema
from pulsemart.session import configure, work_dir
from pulsemart.sources import adapters as A
from pulsemart.sources import sinks
from pulsemart.sources.buckets import buckets_for
from pulsemart.sources.tables import Tables

# Fixed parameters of the registered queries.
AS_OF = "2024-01-31 00:00:00"            # age reference time (P7)
SPLIT = "2024-01-15 12:00:00"            # history | new batch for the incremental DAU (J1)
FUNNEL_BATCH_SECONDS = 12 * 3600         # micro-batch length of the replayed funnel (A11)
ALERT_WINDOW = "12 hours"                # T11: 5 minutes never fires on the tables
SLIDING_WINDOW, SLIDING_SLIDE = "12 hours", "3 hours"
# Half-minute slides, so that several windows end in one minute (W3); ten devices, as
# 100 never have three accounts with coupons in so short a window.
MINUTE_WINDOW, MINUTE_SLIDE = "10 minutes", "30 seconds"
MINUTE_DEVICES = 10
SEARCH_KEYWORD = "Gear"                  # case-insensitive on sku_name
SEARCH_PAGE, SEARCH_SIZE = 2, 20
SEARCH_DAY = "1995-06-17"
REPORT_DAY = "2024-01-10"                # the day of the reports over stored tables (F6, S9)


def _ms(ts: str) -> int:
    return int(dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


SPLIT_MS = _ms(SPLIT)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --- P1-P4, P7 ---------------------------------------------------------------

@register("parse_events", O.with_ctes(O.EVENT) + "SELECT event_id, mid, uid, evid, ts FROM event")
def parse_events(t: Tables) -> DataFrame:
    """Events -> JSON text (ts as a number, the rest quoted) -> typed rows."""
    ev = A.event(t)
    wire = ev.select(
        F.to_json(F.struct("mid", "uid", "evid", "itemid", "ts", F.col("event_id").cast("string").alias("event_id")))
        .alias("value")
    )
    schema = wire_schema(("mid", "uid", "evid", "itemid"))
    parsed = parse_json(wire, "value", schema, casts={"ts": "long", "event_id": "long"})
    return parsed.select("event_id", "mid", "uid", "evid", "ts")


@register(
    "rows_to_json",
    O.with_ctes(O.USERS)
    + """SELECT id,
  '{"id":' || to_json(id) || ',"login_name":' || to_json(login_name) || ',"user_level":' ||
  to_json(user_level) || ',"birthday":' || to_json(birthday) || ',"gender":' || to_json(gender) || '}' AS json,
  login_name, user_level FROM users""",
)
def rows_to_json(t: Tables) -> DataFrame:
    """User rows -> JSON text, and the round trip back to columns."""
    u = A.user_info(t).withColumn("json", F.to_json(F.struct("id", "login_name", "user_level", "birthday", "gender")))
    back = F.from_json("json", "id string, login_name string, user_level string")
    return u.select(F.col("id").alias("_id"), "json", back.alias("_b")).select(
        F.col("_b.id").alias("id"), "json", F.col("_b.login_name").alias("login_name"),
        F.col("_b.user_level").alias("user_level"),
    )


@register("derive_log_date_hour", O.with_ctes(O.STARTUP) + "SELECT event_id, logdate, loghour FROM startup")
def derive_log_date_hour(t: Tables) -> DataFrame:
    """Epoch ms -> logdate, loghour."""
    return A.startup(t).select("event_id", "logdate", "loghour")


@register("derive_order_date_hour", O.with_ctes(O.ORDER_INFO) + "SELECT id, create_date, create_hour FROM order_info")
def derive_order_date_hour(t: Tables) -> DataFrame:
    """create_time string -> create_date, create_hour by splitting."""
    return A.order_info(t).select("id", "create_date", "create_hour")


@register(
    "user_age",
    O.with_ctes(O.USERS)
    + f"""SELECT id, birthday, CAST(((epoch_us(TIMESTAMP '{AS_OF}') // 1000 - epoch_us(CAST(birthday AS TIMESTAMP)) // 1000)
  // 1000 // 60 // 60 // 24 // 365) AS INTEGER) AS user_age FROM users""",
)
def user_age(t: Tables) -> DataFrame:
    """Whole 365-day years between birthday and AS_OF."""
    from pulsemart.functions.dates import whole_year_age

    u = A.user_info(t)
    return u.select("id", "birthday", whole_year_age(F.col("birthday"), AS_OF).alias("user_age"))


# --- DAU (A2, J1, A11, A7, A8) -------------------------------------------------

_DAU_FIRST_SQL = """dau AS (
  SELECT mid, logdate, loghour, event_id AS first_event_id, ts AS first_ts FROM (
    SELECT *, row_number() OVER (PARTITION BY mid, logdate ORDER BY ts, event_id) AS rn FROM startup)
  WHERE rn = 1)"""


@register("dau_first_event", O.with_ctes(O.STARTUP, _DAU_FIRST_SQL) + "SELECT * FROM dau")
def dau_first_event(t: Tables) -> DataFrame:
    """A2 + L1: first startup per (device, day)."""
    return dedup.dau_first_event(A.startup(t))


@register(
    "dau_incremental",
    O.with_ctes(O.STARTUP)
    + f"""SELECT DISTINCT b.mid, b.logdate FROM startup b WHERE b.ts >= {SPLIT_MS}
  AND NOT EXISTS (SELECT 1 FROM startup s WHERE s.ts < {SPLIT_MS} AND s.mid = b.mid AND s.logdate = b.logdate)""",
)
def dau_incremental(t: Tables) -> DataFrame:
    """Device-days of the batch after SPLIT that the DAU table before SPLIT lacks."""
    s = A.startup(t)
    seen = dedup.first_seen(s.where(F.col("ts") < SPLIT_MS))
    return dedup.dau_incremental(dedup.first_seen(s.where(F.col("ts") >= SPLIT_MS)), seen).select("mid", "logdate")


_B = FUNNEL_BATCH_SECONDS * 1000


@register(
    "dau_funnel",
    O.with_ctes(O.STARTUP)
    + f"""SELECT strftime(epoch_ms(batch), '%Y-%m-%d %H:%M:%S') AS batch_start, step, n FROM (
  SELECT batch, sum(rows_) AS raw, sum(CASE WHEN is_new THEN rows_ ELSE 0 END) AS not_seen,
         count(*) FILTER (WHERE is_new) AS n_distinct
  FROM (SELECT batch, rows_, batch = min(batch) OVER (PARTITION BY mid, logdate) AS is_new FROM (
          SELECT mid, logdate, ts - ts % {_B} AS batch, count(*) AS rows_ FROM startup GROUP BY ALL))
  GROUP BY batch)
UNPIVOT (n FOR step IN (raw AS 'raw', not_seen AS 'not_seen', n_distinct AS 'distinct'))""",
)
def dau_funnel(t: Tables) -> DataFrame:
    """Per micro-batch -- raw rows, rows of unseen device-days, new device-days."""
    return dedup.dau_funnel(A.startup(t), FUNNEL_BATCH_SECONDS)


@register("dau_total", O.with_ctes(O.STARTUP) + "SELECT logdate, count(DISTINCT mid) AS ct FROM startup GROUP BY logdate")
def dau_total(t: Tables) -> DataFrame:
    """Devices per day."""
    return agg.dau_total(dedup.first_seen(A.startup(t)))


@register(
    "dau_hourly",
    O.with_ctes(O.STARTUP, _DAU_FIRST_SQL) + "SELECT logdate, loghour AS lh, count(*) AS ct FROM dau GROUP BY ALL",
)
def dau_hourly(t: Tables) -> DataFrame:
    """Devices per day and hour of their first startup."""
    return agg.dau_hourly(dedup.first_seen(A.startup(t)))


# --- GMV (A9, A10) --------------------------------------------------------------

@register(
    "gmv_total",
    O.with_ctes(O.ORDER_INFO) + "SELECT create_date, round(sum(total_amount), 2) AS sum_amount FROM order_info GROUP BY ALL",
)
def gmv_total(t: Tables) -> DataFrame:
    """Order amount per day (orders)."""
    return agg.gmv_total(A.order_info(t))


@register(
    "gmv_hourly",
    O.with_ctes(O.PURCHASES)
    + "SELECT create_date, create_hour, round(sum(total_amount), 2) AS sum_amount FROM purchases GROUP BY ALL",
)
def gmv_hourly(t: Tables) -> DataFrame:
    """A10: amount per day and hour (purchase events; orders have no hour, T10)."""
    return agg.gmv_hourly(A.purchases(t))


# --- reports (R1-R4) -------------------------------------------------------------

@register(
    "kpi_total",
    O.with_ctes(O.STARTUP, O.PURCHASES, "dau AS (SELECT DISTINCT mid, logdate FROM startup)")
    + """SELECT logdate AS day, 'dau' AS id, CAST(count(*) AS DOUBLE) AS value FROM dau GROUP BY logdate
UNION ALL
SELECT first_day, 'new_mid', CAST(count(*) AS DOUBLE) FROM (SELECT mid, min(logdate) AS first_day FROM dau GROUP BY mid) GROUP BY first_day
UNION ALL
SELECT create_date, 'order_amount', round(sum(total_amount), 2) FROM purchases GROUP BY create_date""",
)
def kpi_total(t: Tables) -> DataFrame:
    """Dau, new_mid (first-ever day of a device) and order_amount for every day."""
    return reports.kpi_total(dedup.first_seen(A.startup(t)), A.purchases(t))


def _compare_sql(hourly_cte: str, value_type: str) -> str:
    return f"""{hourly_cte}
SELECT coalesce(t.d, strftime(CAST(y.d AS DATE) + 1, '%Y-%m-%d')) AS logdate, coalesce(t.h, y.h) AS hour,
       CAST(y.v AS {value_type}) AS yesterday, CAST(t.v AS {value_type}) AS today
FROM hourly t FULL JOIN hourly y ON t.d = strftime(CAST(y.d AS DATE) + 1, '%Y-%m-%d') AND t.h = y.h"""


@register(
    "hourly_compare_dau",
    _compare_sql(
        O.with_ctes(O.STARTUP, _DAU_FIRST_SQL, "hourly AS (SELECT logdate AS d, loghour AS h, count(*) AS v FROM dau GROUP BY ALL)"),
        "BIGINT",
    ),
)
def hourly_compare_dau(t: Tables) -> DataFrame:
    """R2 + P11: devices per hour, today against the previous day, every day."""
    return reports.hourly_compare("dau", dedup.first_seen(A.startup(t)), A.purchases(t))


@register(
    "hourly_compare_gmv",
    _compare_sql(
        O.with_ctes(O.PURCHASES, "hourly AS (SELECT create_date AS d, create_hour AS h, round(sum(total_amount), 2) AS v FROM purchases GROUP BY ALL)"),
        "DOUBLE",
    ),
)
def hourly_compare_gmv(t: Tables) -> DataFrame:
    """R2: amount per hour, today against the previous day, every day."""
    return reports.hourly_compare("order_amount", dedup.first_seen(A.startup(t)), A.purchases(t))


@register(
    "hourly_zero_fill",
    O.with_ctes(O.STARTUP, _DAU_FIRST_SQL, "hourly AS (SELECT logdate, loghour AS lh, count(*) AS ct FROM dau GROUP BY ALL)")
    + """SELECT d.logdate, lpad(CAST(h.h AS VARCHAR), 2, '0') AS lh, coalesce(x.ct, 0) AS ct
FROM (SELECT DISTINCT logdate FROM hourly) d CROSS JOIN range(0, 24) h(h)
LEFT JOIN hourly x ON x.logdate = d.logdate AND x.lh = lpad(CAST(h.h AS VARCHAR), 2, '0')""",
)
def hourly_zero_fill(t: Tables) -> DataFrame:
    """24 hours per day, missing hours as 0."""
    return reports.hourly_zero_fill(agg.dau_hourly(dedup.first_seen(A.startup(t))))


@register(
    "hour_map",
    O.with_ctes(O.STARTUP, _DAU_FIRST_SQL, "hourly AS (SELECT logdate, loghour AS lh, count(*) AS ct FROM dau GROUP BY ALL)")
    + """SELECT logdate, '{' || string_agg('"' || lh || '":' || CAST(ct AS VARCHAR), ',' ORDER BY lh) || '}' AS hours
FROM hourly GROUP BY logdate""",
)
def hour_map(t: Tables) -> DataFrame:
    """Per day, the map hour -> devices as the JSON a client receives."""
    m = reports.hour_map(agg.dau_hourly(dedup.first_seen(A.startup(t))))
    return m.select("logdate", F.to_json("hours").alias("hours"))


# --- joins (J2-J5, P5-P8, S6) ---------------------------------------------------

@register(
    "order_line_full_outer",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL)
    + """SELECT coalesce(o.id, d.order_id) AS order_id, d.id AS order_detail_id,
  CASE WHEN o.id IS NOT NULL AND d.id IS NOT NULL THEN 'both' WHEN o.id IS NOT NULL THEN 'order_only' ELSE 'line_only' END AS side
FROM order_info o FULL JOIN order_detail d ON o.id = d.order_id""",
)
def order_line_full_outer(t: Tables) -> DataFrame:
    """Full outer join of orders and lines on the order id."""
    return join.order_line_full_outer(A.order_info(t), A.order_detail(t, with_sku_name=False))


_INTERVAL_SQL = """SELECT o.id AS order_id, d.id AS order_detail_id FROM order_info o JOIN order_detail d
ON o.id = d.order_id AND d.event_ts BETWEEN o.event_ts - INTERVAL 20 DAY AND o.event_ts + INTERVAL 10 DAY"""


@register("order_line_interval_join", O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL) + _INTERVAL_SQL)
def order_line_interval_join(t: Tables) -> DataFrame:
    """J3 batch twin: line within [order - 20 d, order + 10 d] (seconds scaled to days, T9)."""
    return join.order_line_interval_join(A.order_info(t), A.order_detail(t, with_sku_name=False))


@register(
    "unmatched_orders",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL)
    + "SELECT id AS order_id FROM order_info o WHERE NOT EXISTS (SELECT 1 FROM order_detail d WHERE d.order_id = o.id)",
)
def unmatched_orders(t: Tables) -> DataFrame:
    """Orders without any line."""
    return join.unmatched_orders(A.order_info(t), A.order_detail(t, with_sku_name=False))


@register(
    "sale_detail",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL, O.SALE_DETAIL) + "SELECT * FROM sale_detail",
)
def sale_detail(t: Tables) -> DataFrame:
    """P5 + P8: wide row of every (order, line) pair."""
    return join.sale_detail(A.order_info(t), A.order_detail(t))


@register(
    "latest_user",
    O.with_ctes(O.USERS, O.LATEST_USERS) + "SELECT id, login_name, user_level, birthday, gender, seq FROM latest_users",
)
def latest_user(t: Tables) -> DataFrame:
    """Last routed image per user from the change feed."""
    return cdc.latest_user(A.changes(t))


@register(
    "current_users",
    O.with_ctes(O.USERS, O.LATEST_USERS, O.CURRENT_USERS) + "SELECT * FROM current_users",
)
def current_users(t: Tables) -> DataFrame:
    """Users alive after the whole feed (deletes applied)."""
    return cdc.current_users(A.changes(t))


_SALE_USER_SQL = f"""sale_user AS (
  SELECT s.order_detail_id, s.order_id, s.order_status, s.create_time, s.user_id, s.sku_id,
         u.gender AS user_gender,
         coalesce(CAST(((epoch_us(TIMESTAMP '{AS_OF}') // 1000 - epoch_us(CAST(u.birthday AS TIMESTAMP)) // 1000)
                        // 1000 // 60 // 60 // 24 // 365) AS INTEGER), 0) AS user_age,
         u.user_level, s.sku_price, s.sku_name, s.dt
  FROM sale_detail s LEFT JOIN current_users u ON u.id = s.user_id)"""
_SALE_USER_CTES = (O.ORDER_INFO, O.ORDER_DETAIL, O.SALE_DETAIL, O.USERS, O.LATEST_USERS, O.CURRENT_USERS, _SALE_USER_SQL)


def _sales_with_users(t: Tables) -> DataFrame:
    sales = join.sale_detail(A.order_info(t), A.order_detail(t))
    return join.with_user(sales, cdc.current_users(A.changes(t)), AS_OF)


@register("sale_detail_user", O.with_ctes(*_SALE_USER_CTES) + "SELECT * FROM sale_user")
def sale_detail_user(t: Tables) -> DataFrame:
    """J4 + P6 + P7: sale rows with gender, level and age of the current user."""
    return _sales_with_users(t)


# --- search (F7, R5, L2, A12, A13) ----------------------------------------------

_FOUND = f"found AS (SELECT * FROM sale_user WHERE contains(lower(sku_name), '{SEARCH_KEYWORD.lower()}'))"


def _found(t: Tables) -> DataFrame:
    return reports.sale_search(_sales_with_users(t), None, SEARCH_KEYWORD)


def _found_per_user(t: Tables) -> DataFrame:
    """The search's matches reduced to one row per user with their count
    (``_n``) before the user attributes are joined: the facets need only
    user attributes, so the join meets users, not sale rows."""
    sales = join.sale_detail(A.order_info(t), A.order_detail(t))
    found = reports.sale_search(sales, None, SEARCH_KEYWORD)
    per_user = found.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    return join.add_user_attributes(per_user, cdc.current_users(A.changes(t)), AS_OF)


@register("sale_search", O.with_ctes(*_SALE_USER_CTES, _FOUND) + "SELECT * FROM found")
def sale_search(t: Tables) -> DataFrame:
    """keyword search over all days."""
    return _found(t)


@register("sale_search_total", O.with_ctes(*_SALE_USER_CTES, _FOUND) + "SELECT count(*) AS total FROM found")
def sale_search_total(t: Tables) -> DataFrame:
    return reports.sale_search_total(_found(t))


@register(
    "sale_search_page",
    O.with_ctes(*_SALE_USER_CTES, _FOUND)
    + f"SELECT * FROM found ORDER BY dt, order_id, order_detail_id LIMIT {SEARCH_SIZE} OFFSET {(SEARCH_PAGE - 1) * SEARCH_SIZE}",
)
def sale_search_page(t: Tables) -> DataFrame:
    """L2: one page of the search in a total order."""
    return reports.sale_search_page(_found(t), SEARCH_PAGE, SEARCH_SIZE)


@register(
    "sale_search_seek",
    O.with_ctes(*_SALE_USER_CTES, _FOUND)
    + f"SELECT * FROM found ORDER BY dt, order_id, order_detail_id LIMIT {SEARCH_SIZE} OFFSET {SEARCH_SIZE}",
)
def sale_search_seek(t: Tables) -> DataFrame:
    """L2 by key: the page that follows the first page's last row."""
    path = work_dir(t.spark, "sale_seek", fresh=True) + "/found"
    _found(t).write.parquet(path)                        # the joins run once for both pages
    found = t.spark.read.parquet(path)
    first = reports.sale_search_after(found, None, SEARCH_SIZE).select(*reports.SEARCH_ORDER).tail(1)    # one page
    return reports.sale_search_after(found, tuple(first[0]) if first else None, SEARCH_SIZE)


@register(
    "facet_gender",
    O.with_ctes(*_SALE_USER_CTES, _FOUND)
    + "SELECT user_gender AS bucket, count(*) AS ct, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM found GROUP BY ALL",
)
def facet_gender(t: Tables) -> DataFrame:
    """Search rows per gender with share."""
    return agg.facet_gender(_found_per_user(t), weight="_n")


@register(
    "facet_age",
    O.with_ctes(*_SALE_USER_CTES, _FOUND)
    + """SELECT CASE WHEN user_age < 20 THEN '<20' WHEN user_age < 30 THEN '20-29' ELSE '>=30' END AS bucket,
  count(*) AS ct, round(count(*) / sum(count(*)) OVER (), 4) AS share FROM found GROUP BY ALL""",
)
def facet_age(t: Tables) -> DataFrame:
    """Search rows per age bucket with share."""
    return agg.facet_age(_found_per_user(t), weight="_n")


@register(
    "sales_by_province",
    O.with_ctes(O.ORDER_INFO)
    + """SELECT CAST(c_nationkey AS VARCHAR) AS province_id, count(*) AS ct, round(sum(total_amount), 2) AS amount,
  CAST(floor(count(*) / 100) AS BIGINT) AS bin
FROM order_info o LEFT JOIN customer c ON c.c_custkey = CAST(o.user_id AS BIGINT) GROUP BY ALL""",
)
def sales_by_province(t: Tables) -> DataFrame:
    """Orders and amount per province with a colour bin."""
    return agg.sales_by_province(A.order_info(t), A.user_provinces(t))


@register("sale_search_day", O.with_ctes(*_SALE_USER_CTES) + f"SELECT * FROM sale_user WHERE dt = '{SEARCH_DAY}'")
def sale_search_day(t: Tables) -> DataFrame:
    """the search's date filter without a keyword."""
    return reports.sale_search(_sales_with_users(t), SEARCH_DAY)


@register(
    "sale_search_report",
    O.with_ctes(*_SALE_USER_CTES, _FOUND)
    + f"""SELECT 'total' AS section, '' AS key, count(*) AS n, CAST(NULL AS DOUBLE) AS share FROM found
UNION ALL SELECT 'gender', user_gender, count(*), round(count(*) / sum(count(*)) OVER (), 4) FROM found GROUP BY user_gender
UNION ALL SELECT 'age', CASE WHEN user_age < 20 THEN '<20' WHEN user_age < 30 THEN '20-29' ELSE '>=30' END,
  count(*), round(count(*) / sum(count(*)) OVER (), 4) FROM found GROUP BY 2
UNION ALL (SELECT 'page', order_detail_id, row_number() OVER (ORDER BY dt, order_id, order_detail_id), NULL FROM found
  ORDER BY dt, order_id, order_detail_id LIMIT {SEARCH_SIZE} OFFSET {(SEARCH_PAGE - 1) * SEARCH_SIZE})""",
)
def sale_search_report(t: Tables) -> DataFrame:
    """Total, facets and a page of one search, its matches computed once."""
    path = work_dir(t.spark, "sale_search", fresh=True) + "/found"
    return reports.sale_search_report(_sales_with_users(t), path, None, SEARCH_KEYWORD, SEARCH_PAGE, SEARCH_SIZE)


# --- reports of one day over the stored tables (S9, F6, A7-A10) ------------------

def _stored_dau(t: Tables, days: list[str] | None) -> DataFrame:
    path = work_dir(t.spark, "dau_table", fresh=True) + "/t"
    sinks.write_dau_rows(dedup.dau_table(A.startup(t)), path)
    return sinks.read_dau_table(t.spark, path, days)


def _stored_orders(t: Tables, days: list[str]) -> DataFrame:
    path = work_dir(t.spark, "order_table", fresh=True) + "/t"
    sinks.write_order_rows(A.purchases(t), path)
    return sinks.read_order_table(t.spark, path, days)


@register(
    "dau_total_day",
    O.with_ctes(O.STARTUP) + f"SELECT logdate, count(DISTINCT mid) AS ct FROM startup WHERE logdate = '{REPORT_DAY}' GROUP BY logdate",
)
def dau_total_day(t: Tables) -> DataFrame:
    """A7 + S9: devices of one day from the stored table."""
    return agg.dau_total(_stored_dau(t, [REPORT_DAY]), REPORT_DAY)


@register(
    "dau_hourly_day",
    O.with_ctes(O.STARTUP, _DAU_FIRST_SQL) + f"SELECT logdate, loghour AS lh, count(*) AS ct FROM dau WHERE logdate = '{REPORT_DAY}' GROUP BY ALL",
)
def dau_hourly_day(t: Tables) -> DataFrame:
    """A8 + S9: devices of one day by the hour of their first startup."""
    return agg.dau_hourly(_stored_dau(t, [REPORT_DAY]), REPORT_DAY)


@register(
    "gmv_total_day",
    O.with_ctes(O.PURCHASES) + f"SELECT create_date, round(sum(total_amount), 2) AS sum_amount FROM purchases WHERE create_date = '{REPORT_DAY}' GROUP BY create_date",
)
def gmv_total_day(t: Tables) -> DataFrame:
    """A9 + S9: order amount of one day from the stored table."""
    return agg.gmv_total(_stored_orders(t, [REPORT_DAY]), REPORT_DAY)


@register(
    "gmv_hourly_day",
    O.with_ctes(O.PURCHASES) + f"SELECT create_date, create_hour, round(sum(total_amount), 2) AS sum_amount FROM purchases WHERE create_date = '{REPORT_DAY}' GROUP BY ALL",
)
def gmv_hourly_day(t: Tables) -> DataFrame:
    """A10 + S9: order amount of one day by hour from the stored table."""
    return agg.gmv_hourly(_stored_orders(t, [REPORT_DAY]), REPORT_DAY)


@register(
    "kpi_day",
    O.with_ctes(O.STARTUP, O.PURCHASES, "dau AS (SELECT DISTINCT mid, logdate FROM startup)")
    + f"""SELECT '{REPORT_DAY}' AS day, 'dau' AS id, CAST(count(*) AS DOUBLE) AS value FROM dau WHERE logdate = '{REPORT_DAY}'
UNION ALL
SELECT '{REPORT_DAY}', 'new_mid', CAST(count(*) AS DOUBLE) FROM (
  SELECT mid FROM dau GROUP BY mid HAVING min(logdate) = '{REPORT_DAY}')
UNION ALL
SELECT '{REPORT_DAY}', 'order_amount', round(sum(total_amount), 2) FROM purchases WHERE create_date = '{REPORT_DAY}'""",
)
def kpi_day(t: Tables) -> DataFrame:
    """R1 of one day over the stored tables."""
    return reports.kpi_total(_stored_dau(t, None), _stored_orders(t, [REPORT_DAY]), REPORT_DAY)


def _compare_day_sql(hourly: str, day: str, value: str) -> str:
    return f"""SELECT coalesce(a.h, b.h) AS hour, '{REPORT_DAY}' AS logdate, b.v AS yesterday, a.v AS today
FROM (SELECT * FROM ({hourly}) WHERE {day} = '{REPORT_DAY}') a(d, h, v)
FULL JOIN (SELECT * FROM ({hourly}) WHERE {day} = strftime(DATE '{REPORT_DAY}' - 1, '%Y-%m-%d')) b(d, h, v) ON a.h = b.h"""


@register(
    "hourly_compare_dau_day",
    O.with_ctes(O.STARTUP, _DAU_FIRST_SQL)
    + _compare_day_sql("SELECT logdate, loghour, count(*) FROM dau GROUP BY ALL", "logdate", "ct"),
)
def hourly_compare_dau_day(t: Tables) -> DataFrame:
    """R2 of one day over the stored table: only the folders of two days are read."""
    dau = _stored_dau(t, [REPORT_DAY, reports.previous_day(REPORT_DAY)])
    return reports.hourly_compare("dau", dau, None, REPORT_DAY)


@register(
    "hourly_compare_gmv_day",
    O.with_ctes(O.PURCHASES)
    + _compare_day_sql("SELECT create_date, create_hour, round(sum(total_amount), 2) FROM purchases GROUP BY ALL", "create_date", "s"),
)
def hourly_compare_gmv_day(t: Tables) -> DataFrame:
    """R2 of one day's order amounts over the stored table."""
    orders = _stored_orders(t, [REPORT_DAY, reports.previous_day(REPORT_DAY)])
    return reports.hourly_compare("order_amount", None, orders, REPORT_DAY)


# --- alert (A3-A6, W1-W3, P9) ----------------------------------------------------


def _alert_sql(window_ms: int, slide_ms: int) -> str:
    copies = window_ms // slide_ms
    return f"""win AS (
  SELECT e.mid, e.uid, e.evid, e.itemid, (e.ts - e.ts % {slide_ms}) - r.k * {slide_ms} AS ws
  FROM event e CROSS JOIN range(0, {copies}) r(k)),
grp AS (
  SELECT mid, ws, count(DISTINCT uid) FILTER (WHERE evid = 'coupon') AS n_accounts,
         bool_or(evid = 'clickItem') AS clicked,
         string_agg(DISTINCT uid, ',' ORDER BY uid) FILTER (WHERE evid = 'coupon') AS uids,
         string_agg(DISTINCT itemid, ',' ORDER BY itemid) FILTER (WHERE evid = 'coupon') AS item_ids
  FROM win GROUP BY mid, ws),
alerts AS (
  SELECT mid, strftime(epoch_ms(ws), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(epoch_ms(ws + {window_ms}), '%Y-%m-%d %H:%M:%S') AS window_end,
         n_accounts, uids, item_ids, ws + {window_ms} AS ts
  FROM grp WHERE n_accounts >= 3 AND NOT clicked)"""


_W12 = 12 * 3600 * 1000
_S3 = 3 * 3600 * 1000
_M10 = 10 * 60 * 1000
_S30 = 30 * 1000
_MINUTE = O.with_ctes(
    O.EVENT.replace("json_extract_string(props, '$.k')", f"CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % {MINUTE_DEVICES} AS VARCHAR)"),
    _alert_sql(_M10, _S30),
)
_MINUTE_ALERTS = _MINUTE + """SELECT doc_id, mid, window_start, window_end, n_accounts, uids, item_ids, ts FROM (
  SELECT *, mid || CAST(ts // 1000 // 60 AS VARCHAR) AS doc_id,
         row_number() OVER (PARTITION BY mid || CAST(ts // 1000 // 60 AS VARCHAR) ORDER BY ts DESC) AS rn
  FROM alerts) WHERE rn = 1"""
_TUMBLING = O.with_ctes(O.EVENT, _alert_sql(_W12, _W12))
_SLIDING = O.with_ctes(O.EVENT, _alert_sql(_W12, _S3))


@register("coupon_alert_tumbling", _TUMBLING + "SELECT * FROM alerts")
def coupon_alert_tumbling(t: Tables) -> DataFrame:
    """W2 + A3 + A5 + A6: >= 3 coupon accounts and no click per device and 12 h window."""
    return alert.coupon_alerts(A.event(t), ALERT_WINDOW)


@register(
    "coupon_alert_events",
    _TUMBLING
    + f"""SELECT e.mid, a.window_start, e.ts AS event_ts, e.event_id, e.evid FROM event e
JOIN alerts a ON a.mid = e.mid AND a.window_start = strftime(epoch_ms(e.ts - e.ts % {_W12}), '%Y-%m-%d %H:%M:%S')""",
)
def coupon_alert_events(t: Tables) -> DataFrame:
    """A4: the events of every alerting window, one row each."""
    ev = A.event(t)
    return alert.alert_events(ev, alert.coupon_alerts(ev, ALERT_WINDOW), ALERT_WINDOW)


@register("coupon_alert_sliding", _SLIDING + "SELECT * FROM alerts")
def coupon_alert_sliding(t: Tables) -> DataFrame:
    """The rule over 12 h windows sliding by 3 h (pane-based)."""
    return alert.coupon_alerts(A.event(t), SLIDING_WINDOW, SLIDING_SLIDE)


@register(
    "alert_doc_id",
    _TUMBLING + "SELECT mid, window_start, mid || CAST(ts // 1000 // 60 AS VARCHAR) AS doc_id FROM alerts",
)
def alert_doc_id(t: Tables) -> DataFrame:
    """Device id + epoch minute of the alert time."""
    return alert.with_doc_id(alert.coupon_alerts(A.event(t), ALERT_WINDOW)).select("mid", "window_start", "doc_id")


def minute_device():
    """The device of the half-minute alerts."""
    return (F.col("mid").cast("int") % MINUTE_DEVICES).cast("string")


@register("alert_per_minute", _MINUTE_ALERTS)
def alert_per_minute(t: Tables) -> DataFrame:
    """W1 + W3: windows sliding by half a minute, one alert per device and minute (the
    last window wins)."""
    events = A.event(t).withColumn("mid", minute_device())
    return alert.alert_per_minute(alert.coupon_alerts(events, MINUTE_WINDOW, MINUTE_SLIDE)).select(
        "doc_id", "mid", "window_start", "window_end", "n_accounts", "uids", "item_ids", "ts")


# --- change feed (S2, S3, F1-F3) ------------------------------------------------

_CHANGE_COUNTS = """counts(table_name, op, n) AS (
  SELECT 'order_info', 'INSERT', count(*) FROM orders
  UNION ALL SELECT 'order_detail', 'INSERT', count(*) FROM lineitem
  UNION ALL SELECT 'user_info', 'INSERT', count(*) FROM customer
  UNION ALL SELECT 'user_info', 'UPDATE', count(*) FROM customer WHERE c_custkey % 3 = 0
  UNION ALL SELECT 'user_info', 'DELETE', count(*) FROM customer WHERE c_custkey % 11 = 0)"""


@register("cdc_rows", O.with_ctes(_CHANGE_COUNTS) + "SELECT table_name, op, n FROM counts WHERE n > 0")
def cdc_rows(t: Tables) -> DataFrame:
    """S2 + F2 + F3: row-data changes of subscribed tables, counted by table and op."""
    rows = cdc.change_rows(A.changes(t))
    return rows.groupBy("table_name", "op").agg(F.count(F.lit(1)).alias("n"))


_ROUTED_SQL = """SELECT 'TOPIC_ORDER_INFO' AS topic, id AS key, user_id AS ref, order_status AS label,
  total_amount AS amount, create_time AS at FROM order_info
UNION ALL SELECT 'TOPIC_ORDER_DETAIL', id, order_id, sku_id, sku_price, NULL FROM order_detail
UNION ALL SELECT 'TOPIC_USER_INFO', id, login_name, user_level, NULL, birthday FROM users
UNION ALL SELECT 'TOPIC_USER_INFO', id, login_name, 'VIP', NULL, birthday FROM users WHERE c_custkey % 3 = 0"""


def routed_records(spark: SparkSession, path: str) -> DataFrame:
    """The routed topics read back, every record parsed: its topic and key, and of its
    payload the row it refers to, a label, the amount and the time."""
    back = spark.read.schema("key string, value string, topic string").json(path)
    names = ("id", "user_id", "order_id", "login_name", "order_status", "sku_id", "user_level",
             "total_amount", "order_price", "create_time", "birthday")
    rows = back.select("topic", "key", F.from_json("value", wire_schema(names, extra=()), ONE_PARSE).alias("v"))
    first = lambda *fields: F.coalesce(*[F.col(f"v.{f}") for f in fields])
    return rows.where(F.col("key").eqNullSafe(F.col("v.id"))).select(
        "topic", "key", first("order_id", "user_id", "login_name").alias("ref"),
        first("order_status", "sku_id", "user_level").alias("label"),
        first("total_amount", "order_price").cast("double").alias("amount"), first("create_time", "birthday").alias("at"),
    )


@register("cdc_route", O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL, O.USERS) + _ROUTED_SQL)
def cdc_route(t: Tables) -> DataFrame:
    """F1 + P2 + S3: route changes to topic files; every record read back and parsed."""
    path = work_dir(t.spark, "topics", fresh=True)
    sinks.write_topics(cdc.route(A.changes(t)), path)
    return routed_records(t.spark, path)


@register(
    "cdc_order_amounts",
    O.with_ctes(O.ORDER_INFO) + "SELECT create_date, round(sum(total_amount), 2) AS sum_amount, count(*) AS n FROM order_info GROUP BY ALL",
)
def cdc_order_amounts(t: Tables) -> DataFrame:
    """P1 on the routed order topic: quoted numbers are parsed as strings, then cast."""
    from pulsemart.functions.dates import with_order_date_hour

    routed = cdc.route(A.changes(t)).where(F.col("topic") == cdc.TOPIC_ORDER)
    orders = parse_json(
        routed, "value", wire_schema(("id", "user_id", "order_status", "total_amount", "create_time"), extra=()),
        casts={"total_amount": "double"},
    )
    return with_order_date_hour(orders).groupBy("create_date").agg(
        F.round(F.sum("total_amount"), 2).alias("sum_amount"), F.count(F.lit(1)).alias("n")
    )


# --- upsert sinks (S4, S5) --------------------------------------------------------


@register(
    "upsert_table",
    O.with_ctes(O.ORDER_INFO)
    + """SELECT id, CASE WHEN order_status = 'O' THEN 'F' ELSE order_status END AS order_status,
  total_amount, create_date FROM order_info""",
)
def upsert_table(t: Tables) -> DataFrame:
    """Batch 1 writes every order; batch 2 re-writes the open ones as
    fulfilled."""
    path = work_dir(t.spark, "upsert_table", fresh=True)
    orders = A.order_info(t).select("id", "order_status", "total_amount", "create_date")
    n_buckets = buckets_for(t.orders.count())
    sinks.upsert(orders, path, 1, "id", n_buckets=n_buckets)
    fulfilled = orders.where(F.col("order_status") == "O").withColumn("order_status", F.lit("F"))
    sinks.upsert(fulfilled, path, 2, "id", n_buckets=n_buckets)
    return sinks.read_upserted(t.spark, path)


@register(
    "upsert_documents",
    O.with_ctes(O.ORDER_INFO, O.ORDER_DETAIL, O.SALE_DETAIL)
    + """SELECT doc_id, order_id, order_status, sku_price FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY b DESC, sku_price DESC) AS rn FROM (
    SELECT order_detail_id AS doc_id, order_id, order_status, sku_price, 1 AS b FROM sale_detail WHERE order_status <> 'P'
    UNION ALL
    SELECT order_detail_id, order_id, 'F', sku_price, 2 FROM sale_detail WHERE order_status = 'O'))
WHERE rn = 1
UNION ALL SELECT 'generated', order_id, order_status, sku_price FROM sale_detail WHERE order_status = 'P'""",
)
def upsert_documents(t: Tables) -> DataFrame:
    """Sale documents by id; the second bulk re-sends open orders' lines as fulfilled.

    Lines of pending orders are sent without an id: each gets one of its own, shown
    as ``generated``.  Two lines can share a document id (T8: one case at sf0.001); the
    keyed sink keeps one of them, the higher price, exactly as the oracle does.
    """
    path = work_dir(t.spark, "upsert_documents", fresh=True)
    docs = join.sale_detail(A.order_info(t), A.order_detail(t, with_sku_name=False)).select(
        F.when(F.col("order_status") != "P", F.col("order_detail_id")).alias("doc_id"), "order_id", "order_status", "sku_price"
    )
    options = {"tiebreak": "sku_price", "n_buckets": buckets_for(t.lineitem.count())}
    sinks.upsert_documents(docs, path, 1, **options)
    fulfilled = docs.where(F.col("order_status") == "O").withColumn("order_status", F.lit("F"))
    sinks.upsert_documents(fulfilled, path, 2, **options)
    generated = F.col("order_status") == "P"
    return sinks.read_upserted(t.spark, path).withColumn(
        "doc_id", F.when(generated & F.col("doc_id").isNotNull(), F.lit("generated")).otherwise(F.col("doc_id")))

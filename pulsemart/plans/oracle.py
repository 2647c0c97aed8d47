"""DuckDB SQL twins of the adapters, used by the oracle statements.

They repeat the adapters' fixed values literally (FIXTURES.md §2).  Epoch
milliseconds are ``epoch_us(ts) // 1000``: DuckDB's ``epoch_ms(timestamp)``
rounds, Spark's ``unix_millis`` truncates.
"""

STARTUP = """startup AS (
  SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
         'area' || CAST(user_id % 7 AS VARCHAR) AS area, event_type AS os,
         epoch_us(ts) // 1000 AS ts, event_id,
         strftime(ts, '%Y-%m-%d') AS logdate, strftime(ts, '%H') AS loghour
  FROM events)"""

EVENT = """event AS (
  SELECT json_extract_string(props, '$.k') AS mid, CAST(user_id AS VARCHAR) AS uid,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'click' THEN 'clickItem'
              ELSE event_type END AS evid,
         CAST(event_id % 50 AS VARCHAR) AS itemid, epoch_us(ts) // 1000 AS ts, event_id
  FROM events)"""

ORDER_INFO = """order_info AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
         o_orderstatus AS order_status, o_totalprice AS total_amount,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time, o_orderdate AS event_ts,
         strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour
  FROM orders)"""

ORDER_TABLE = """order_table AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS ID, CAST(c_nationkey AS VARCHAR) AS PROVINCE_ID, c_name AS CONSIGNEE,
         o_orderpriority AS ORDER_COMMENT, lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS CONSIGNEE_TEL,
         o_orderstatus AS ORDER_STATUS, CAST(o_orderkey % 3 + 1 AS VARCHAR) AS PAYMENT_WAY,
         CAST(o_custkey AS VARCHAR) AS USER_ID, CAST(NULL AS VARCHAR) AS IMG_URL, o_totalprice AS TOTAL_AMOUNT,
         strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS EXPIRE_TIME,
         concat_ws(' ', c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS DELIVERY_ADDRESS,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS CREATE_TIME,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS OPERATE_TIME, CAST(NULL AS VARCHAR) AS TRACKING_NO,
         CAST(NULL AS VARCHAR) AS PARENT_ORDER_ID, 'T' || CAST(o_orderkey AS VARCHAR) AS OUT_TRADE_NO,
         CAST(NULL AS VARCHAR) AS TRADE_BODY, strftime(o_orderdate, '%Y-%m-%d') AS CREATE_DATE,
         strftime(o_orderdate, '%H') AS CREATE_HOUR
  FROM orders LEFT JOIN customer ON c_custkey = o_custkey)"""

PURCHASES = """purchases AS (
  SELECT CAST(event_id AS VARCHAR) AS id, value AS total_amount,
         strftime(ts, '%Y-%m-%d') AS create_date, strftime(ts, '%H') AS create_hour
  FROM events WHERE event_type = 'purchase')"""

ORDER_DETAIL = """order_detail AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' ||
         CAST(l_suppkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         l_extendedprice AS sku_price, l_shipdate AS event_ts, p_name AS sku_name
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""

USERS = """users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '1950-01-01' + CAST((c_custkey * 37) % 22000 AS INTEGER), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         c_custkey
  FROM customer)"""

# Latest image per user after the feed (updates: key % 3 = 0 -> 'VIP';
# deletes: key % 11 = 0).  ``latest`` keeps deleted users, ``current`` drops them.
LATEST_USERS = """latest_users AS (
  SELECT id, login_name,
         CASE WHEN c_custkey % 3 = 0 THEN 'VIP' ELSE user_level END AS user_level,
         birthday, gender,
         c_custkey * 10 + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS seq,
         c_custkey
  FROM users)"""

CURRENT_USERS = """current_users AS (
  SELECT id, login_name, user_level, birthday, gender, seq FROM latest_users
  WHERE c_custkey % 11 <> 0)"""

SALE_DETAIL = """sale_detail AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id,
         d.sku_id, d.sku_price, d.sku_name, o.create_date AS dt
  FROM order_detail d JOIN order_info o ON o.id = d.order_id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"

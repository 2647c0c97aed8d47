"""Adapters: the driver's tables -> the streams of the data model (FIXTURES.md §2).

Each adapter is a projection (plus, where the record needs it, one join) over
the parquet tables, so column pruning and filter pushdown reach the scan.  The
synthetic constants below are part of the contract with the SQL oracle, which
repeats them literally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.functions.dates import DATETIME_FORMAT, epoch_ms, with_log_date_hour, with_order_date_hour
from pulsemart.functions.ids import joined_key
from pulsemart.operators.join import measured
from pulsemart.schemas import ORDER_INFO_FIELDS
from pulsemart.sources.tables import Tables

# Fixed values of the synthetic columns (must equal the oracle SQL).
AREA_MODULUS = 7            # area = 'area' || user_id % 7
ITEM_MODULUS = 50           # itemid = event_id % 50
EVENT_KIND = {"purchase": "coupon", "click": "clickItem"}
BIRTHDAY_BASE = "1950-01-01"
BIRTHDAY_STEP = 37          # birthday = base + (custkey * 37) % 22000 days
BIRTHDAY_SPAN = 22000
UPDATE_MODULUS = 3          # customers with custkey % 3 = 0 get an UPDATE
UPDATED_LEVEL = "VIP"
DELETE_MODULUS = 11         # customers with custkey % 11 = 0 get a DELETE
TXN_MARKER_MODULUS = 10     # one TRANSACTIONEND entry per order with key % 10 = 0
PAYMENT_WAYS = 3            # payment_way = orderkey % 3 + 1
PHONE_DIGITS = 11           # consignee_tel = the customer key with leading zeros
FOREIGN_SCHEMA_MODULUS = 5  # customer inserts with key % 5 = 0 repeated in schema 'ops'


def _null_str():
    return F.lit(None).cast("string")


def startup(t: Tables) -> DataFrame:
    """Startup log: one per event row; mid = uid = user id."""
    e = t.events
    uid = e.user_id.cast("string")
    df = e.select(
        uid.alias("mid"),
        uid.alias("uid"),
        _null_str().alias("appid"),
        F.concat(F.lit("area"), (e.user_id % AREA_MODULUS).cast("string")).alias("area"),
        e.event_type.alias("os"),
        _null_str().alias("ch"),
        _null_str().alias("type"),
        F.lit("1").alias("vs"),
        epoch_ms(e.ts).alias("ts"),
        e.event_id.alias("event_id"),
    )
    return with_log_date_hour(df)


def event(t: Tables) -> DataFrame:
    """Event log: device = props.k, account = user id, purchase/click renamed."""
    e = t.events
    evid = (
        F.when(e.event_type == "purchase", F.lit(EVENT_KIND["purchase"]))
        .when(e.event_type == "click", F.lit(EVENT_KIND["click"]))
        .otherwise(e.event_type)
    )
    df = e.select(
        F.get_json_object(e.props, "$.k").alias("mid"),
        e.user_id.cast("string").alias("uid"),
        _null_str().alias("appid"),
        _null_str().alias("area"),
        _null_str().alias("os"),
        _null_str().alias("type"),
        evid.alias("evid"),
        _null_str().alias("pgid"),
        _null_str().alias("npgid"),
        (e.event_id % ITEM_MODULUS).cast("string").alias("itemid"),
        epoch_ms(e.ts).alias("ts"),
        e.event_id.alias("event_id"),
    )
    return with_log_date_hour(df)


def order_info(t: Tables, with_province: bool = False) -> DataFrame:
    """Orders.  ``event_ts`` is the order time (always midnight in the tables).

    ``province_id`` needs a join with customer; it is only added on request so
    queries that do not use it do not pay for the shuffle.
    """
    o = t.orders
    df = o.select(
        o.o_orderkey.cast("string").alias("id"),
        o.o_custkey.cast("string").alias("user_id"),
        o.o_orderstatus.alias("order_status"),
        o.o_totalprice.alias("total_amount"),
        F.date_format(o.o_orderdate, DATETIME_FORMAT).alias("create_time"),
        o.o_orderdate.alias("event_ts"),
        o.o_custkey.alias("_custkey"),
    )
    if with_province:
        c = t.customer.select(
            F.col("c_custkey").alias("_custkey"), F.col("c_nationkey").cast("string").alias("province_id")
        )
        df = df.join(c, "_custkey", "left")
    return with_order_date_hour(df.drop("_custkey"))


def _order_fields(t: Tables) -> DataFrame:
    """Every order with the record's 18 fields as strings, in the record's order.  Four
    of them the tables cannot fill."""
    o, c = t.orders, t.customer
    joined = o.join(
        c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment"), "o_custkey", "left")
    key, cust, at = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderdate")
    time = F.date_format(at, DATETIME_FORMAT)
    values = {
        "id": key, "province_id": F.col("c_nationkey").cast("string"), "consignee": F.col("c_name"),
        "order_comment": F.col("o_orderpriority"), "consignee_tel": F.lpad(cust, PHONE_DIGITS, "0"),
        "order_status": F.col("o_orderstatus"), "payment_way": (F.col("o_orderkey") % PAYMENT_WAYS + 1).cast("string"),
        "user_id": cust, "img_url": _null_str(), "total_amount": F.col("o_totalprice").cast("string"),
        "expire_time": F.date_format(at + F.expr("INTERVAL 1 DAY"), DATETIME_FORMAT),
        "delivery_address": F.concat_ws(" ", "c_mktsegment", F.col("c_nationkey").cast("string")),
        "create_time": time, "operate_time": time, "tracking_no": _null_str(), "parent_order_id": _null_str(),
        "out_trade_no": F.concat(F.lit("T"), key), "trade_body": _null_str(),
    }
    return joined.select("o_orderkey", *[values[f].alias(f) for f in ORDER_INFO_FIELDS])


def order_changes(t: Tables) -> DataFrame:
    """The change feed's order inserts with the whole record as after-image."""
    rows = _order_fields(t)
    after = F.create_map(*[x for f in ORDER_INFO_FIELDS for x in (F.lit(f), F.col(f))])
    return rows.select(
        F.lit("shop").alias("schema_name"), F.lit("order_info").alias("table_name"), F.lit("ROWDATA").alias("kind"),
        F.lit("INSERT").alias("op"), after.alias("after"), (F.col("o_orderkey") * 10).alias("seq"))


def user_provinces(t: Tables) -> DataFrame:
    """(user_id, province_id): each user's province (the customer's nation)."""
    c = t.customer
    return c.select(c.c_custkey.cast("string").alias("user_id"), c.c_nationkey.cast("string").alias("province_id"))


def purchases(t: Tables) -> DataFrame:
    """Order-shaped rows from purchase events: the only source with real hours."""
    e = t.events.where(F.col("event_type") == "purchase")
    df = e.select(
        e.event_id.cast("string").alias("id"),
        e.user_id.cast("string").alias("user_id"),
        e.value.alias("total_amount"),
        F.date_format(e.ts, DATETIME_FORMAT).alias("create_time"),
        e.ts.alias("event_ts"),
    )
    return with_order_date_hour(df)


def order_detail(t: Tables, with_sku_name: bool = True) -> DataFrame:
    """Order lines.  The record has no time; ``event_ts`` = ship date (H2).

    The id joins order key, part, supplier and line number: the short key
    (order, line number) is not unique (trap T8).
    """
    li = t.lineitem
    df = li.select(
        joined_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("id"),
        li.l_orderkey.cast("string").alias("order_id"),
        li.l_partkey.cast("string").alias("sku_id"),
        li.l_extendedprice.cast("string").alias("order_price"),
        li.l_quantity.cast("string").alias("sku_num"),
        li.l_shipdate.alias("event_ts"),
        li.l_partkey.alias("_partkey"),
    )
    if with_sku_name:
        p = t.part.select(F.col("p_partkey").alias("_partkey"), F.col("p_name").alias("sku_name"))
        df = df.join(measured(p), "_partkey", "left")
    return df.drop("_partkey")


def _gender(custkey):
    return F.when(custkey % 2 == 0, F.lit("M")).otherwise(F.lit("F"))


def _birthday(custkey):
    offset = ((custkey * BIRTHDAY_STEP) % BIRTHDAY_SPAN).cast("int")
    return F.date_format(F.date_add(F.lit(BIRTHDAY_BASE).cast("date"), offset), "yyyy-MM-dd")


def user_info(t: Tables) -> DataFrame:
    """User profiles as first inserted (before any change-feed update)."""
    c = t.customer
    return c.select(
        c.c_custkey.cast("string").alias("id"),
        c.c_name.alias("login_name"),
        c.c_mktsegment.alias("user_level"),
        _birthday(c.c_custkey).alias("birthday"),
        _gender(c.c_custkey).alias("gender"),
    )


def changes(t: Tables) -> DataFrame:
    """A change feed (S2 input): after-images as map<string,string>, all values quoted.

    Orders and lines are INSERTs; customers are INSERTed, some UPDATEd to a new
    level and some DELETEd afterwards.  ``seq`` orders the changes of one key
    (insert < update < delete).  Transaction markers and a foreign schema give
    the entry-kind and subscription filters something to drop.  Each source
    table is scanned once: its row yields all of its changes through one
    ``explode``.
    """
    o, li, c = t.orders, t.lineitem, t.customer
    s = lambda col: F.col(col).cast("string")

    def entry(op, after, seq, schema="shop", kind="ROWDATA"):
        return F.struct(
            F.lit(schema).alias("schema_name"),
            F.lit(kind).alias("kind"),
            (F.lit(op) if op else _null_str()).alias("op"),
            after.cast("map<string,string>").alias("after"),
            seq.cast("long").alias("seq"),
        )

    def rows(df, table, *entries):
        """``entries``: (condition or None, change struct).  The table name
        stays a literal outside the explode, so a filter on it drops the
        other tables' branches of the union before any scan."""
        arr = F.array(*[e if cond is None else F.when(cond, e) for cond, e in entries])
        exploded = df.select(F.explode(F.array_compact(arr)).alias("_c"))
        return exploded.select(
            "_c.schema_name", F.lit(table).alias("table_name"), "_c.kind", "_c.op", "_c.after", "_c.seq"
        )

    order_after = F.create_map(
        F.lit("id"), s("o_orderkey"),
        F.lit("user_id"), s("o_custkey"),
        F.lit("order_status"), F.col("o_orderstatus"),
        F.lit("total_amount"), s("o_totalprice"),
        F.lit("create_time"), F.date_format("o_orderdate", DATETIME_FORMAT),
    )
    line_after = F.create_map(
        F.lit("id"), joined_key("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
        F.lit("order_id"), s("l_orderkey"),
        F.lit("sku_id"), s("l_partkey"),
        F.lit("order_price"), s("l_extendedprice"),
        F.lit("sku_num"), s("l_quantity"),
    )

    def user_after(level):
        return F.create_map(
            F.lit("id"), s("c_custkey"),
            F.lit("login_name"), F.col("c_name"),
            F.lit("user_level"), level,
            F.lit("birthday"), _birthday(F.col("c_custkey")),
            F.lit("gender"), _gender(F.col("c_custkey")),
        )

    key, okey = F.col("c_custkey"), F.col("o_orderkey")
    orders = rows(
        o, "order_info",
        (None, entry("INSERT", order_after, okey * 10)),
        (okey % TXN_MARKER_MODULUS == 0, entry(None, F.lit(None), okey * 10 + 9, kind="TRANSACTIONEND")),
    )
    lines = rows(li, "order_detail", (None, entry("INSERT", line_after, F.col("l_orderkey") * 10 + 1)))
    users = rows(
        c, "user_info",
        (None, entry("INSERT", user_after(F.col("c_mktsegment")), key * 10)),
        (key % UPDATE_MODULUS == 0, entry("UPDATE", user_after(F.lit(UPDATED_LEVEL)), key * 10 + 1)),
        (key % DELETE_MODULUS == 0, entry("DELETE", F.create_map(F.lit("id"), s("c_custkey")), key * 10 + 2)),
        (key % FOREIGN_SCHEMA_MODULUS == 0,
         entry("INSERT", user_after(F.col("c_mktsegment")), key * 10, schema="ops")),
    )
    return orders.unionByName(lines).unionByName(users)

"""Record schemas of the streams and outputs.

Wire schemas are all-string on purpose (trap T1): the change feed quotes every
value, so JSON is parsed as strings first and cast afterwards.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


# Field names of the records.
STARTUP_FIELDS = ("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
EVENT_FIELDS = ("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
ORDER_INFO_FIELDS = (
    "id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status",
    "payment_way", "user_id", "img_url", "total_amount", "expire_time", "delivery_address",
    "create_time", "operate_time", "tracking_no", "parent_order_id", "out_trade_no", "trade_body",
)
ORDER_DETAIL_FIELDS = ("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")
USER_INFO_FIELDS = ("id", "login_name", "user_level", "birthday", "gender")

def wire_schema(fields, extra=("ts", "event_id")) -> T.StructType:
    """All-string JSON schema of a stream record (ids, amounts and ts included)."""
    return T.StructType(_strings(*fields, *extra))


STARTUP_WIRE = wire_schema(STARTUP_FIELDS)
EVENT_WIRE = wire_schema(EVENT_FIELDS)
ORDER_INFO_WIRE = wire_schema(ORDER_INFO_FIELDS, extra=("event_ts",))
ORDER_DETAIL_WIRE = wire_schema(ORDER_DETAIL_FIELDS, extra=("event_ts",))

CHANGES = T.StructType(
    [
        T.StructField("schema_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("kind", T.StringType(), True),
        T.StructField("op", T.StringType(), True),
        T.StructField("after", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("seq", T.LongType(), True),
    ]
)

"""Change-feed routing and the latest-value table.

A change record is (schema_name, table_name, kind, op, after, seq).  Routing
is one ``CASE`` giving the topic, so the feed is scanned once and every row
goes to at most one topic.  The latest-value table is ``max_by`` per key, a
partial aggregate: a key updated a million times is folded map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Topic names and the routing rule of the change client.
TOPIC_ORDER = "TOPIC_ORDER_INFO"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER = "TOPIC_USER_INFO"
SUBSCRIPTION = "shop.*"      # regex on "schema.table"
ROW_KIND = "ROWDATA"


def change_rows(changes: DataFrame, subscription: str = SUBSCRIPTION) -> DataFrame:
    """S2 + F2 + F3: row-data entries of subscribed tables only."""
    name = F.concat_ws(".", F.col("schema_name"), F.col("table_name"))
    return changes.where((F.col("kind") == ROW_KIND) & name.rlike(f"^(?:{subscription})$"))


def topic_of(table_col: str = "table_name", op_col: str = "op"):
    """order and line tables route INSERTs; the user table INSERT or UPDATE."""
    t, op = F.col(table_col), F.col(op_col)
    return (
        F.when((t == "order_info") & (op == "INSERT"), F.lit(TOPIC_ORDER))
        .when((t == "order_detail") & (op == "INSERT"), F.lit(TOPIC_ORDER_DETAIL))
        .when((t == "user_info") & op.isin("INSERT", "UPDATE"), F.lit(TOPIC_USER))
    )


def route(changes: DataFrame) -> DataFrame:
    """F1 + P2: (topic, key, value JSON, seq) for every routed change.

    The value is the after-image as JSON with every value quoted, as the
    change client writes it (trap T1 for the reader).
    """
    rows = change_rows(changes).withColumn("topic", topic_of())
    return rows.where(F.col("topic").isNotNull()).select(
        "topic",
        F.col("after")["id"].alias("key"),
        F.to_json(F.col("after")).alias("value"),
        "seq",
    )


def latest_by_key(df: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """The row with the highest ``order`` per ``key`` (last writer wins)."""
    others = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*others), F.col(order)).alias("_last")
    return df.groupBy(key).agg(last).select(key, *[F.col(f"_last.{c}").alias(c) for c in others])


def user_changes(changes: DataFrame, include_deletes: bool = False) -> DataFrame:
    """User after-images from the feed as typed rows (id, ..., seq, op)."""
    rows = change_rows(changes).where(F.col("table_name") == "user_info")
    ops = ["INSERT", "UPDATE", "DELETE"] if include_deletes else ["INSERT", "UPDATE"]
    rows = rows.where(F.col("op").isin(*ops))
    a = F.col("after")
    return rows.select(
        a["id"].alias("id"), a["login_name"].alias("login_name"), a["user_level"].alias("user_level"),
        a["birthday"].alias("birthday"), a["gender"].alias("gender"), "seq", "op",
    )


def latest_user(changes: DataFrame) -> DataFrame:
    """S6 as in the reference: the last routed (INSERT/UPDATE) image per user.

    DELETEs are never routed, so a deleted user keeps its last image.
    """
    return latest_by_key(user_changes(changes).drop("op"), "id")


def current_users(changes: DataFrame) -> DataFrame:
    """Users alive after the whole feed: the last change per id, unless it is a DELETE."""
    last = latest_by_key(user_changes(changes, include_deletes=True), "id")
    return last.where(F.col("op") != "DELETE").drop("op")

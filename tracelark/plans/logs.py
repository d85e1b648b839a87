"""Event logs over the test tables.

Click log: one case per user and day (or per user) of ``events``.
Order log: orders and their line items, mirroring the retail log's sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedup import drop_copies
from ..operators.event_log import Event, EventSource, linked_log
from ..session import fresh_dir
from ..sources.tables import overwrite_table, read_table

CLICK_RANKS = {"CLICK": 0}
ORDER_RANKS = {"ORDER": 0, "LINE": 1, "RETURN": 2, "PAYMENT": 3}
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _click_case(by: str):
    user = F.col("user_id").cast("string")
    if by == "user":
        return user
    return F.concat(user, F.lit("/"), F.to_date("ts").cast("string"))


def click_sources(spark: SparkSession, folder: str, by: str = "day") -> list[EventSource]:
    clicked = Event(
        activity=F.col("event_type"),
        ts=F.col("ts"),
        category="CLICK",
        resource=F.col("user_id").cast("string"),
        attributes={"value": F.col("value"), "props": F.col("props")},
    )
    events = read_table(spark, folder, "events")
    return [EventSource(events, _click_case(by), F.col("event_id"), [clicked])]


def customer_places(spark: SparkSession, folder: str) -> DataFrame:
    """Nation (as store) and market segment (as channel) of every customer."""
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, folder, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.col("n_name").alias("store_id"), F.col("c_mktsegment").alias("channel")
    )


def click_dims(spark: SparkSession, folder: str, by: str = "day") -> DataFrame:
    events = read_table(spark, folder, "events")
    cases = events.select(_click_case(by).alias("case_id"), "user_id").distinct()
    places = customer_places(spark, folder)
    return cases.join(places, F.col("user_id") == F.col("c_custkey"), "left").select("case_id", "store_id", "channel")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items, one per order and line number."""
    return drop_copies(read_table(spark, folder, "lineitem"), LINE_KEY, LINE_ORDER)


def order_sources(spark: SparkSession, folder: str, payments: bool = True) -> list[EventSource]:
    orders = read_table(spark, folder, "orders")
    lines = order_lines(spark, folder)
    placed = Event(F.lit("ORDER_PLACED"), F.col("o_orderdate"), "ORDER", attributes={"status": F.col("o_orderstatus")})
    paid = Event(
        F.lit("PAYMENT_APPLIED"),
        F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"),
        "PAYMENT",
        when=F.col("o_orderpriority") == "1-URGENT",
    )
    closed = Event(
        F.when(F.col("o_orderstatus") == "F", "ORDER_FILLED")
        .when(F.col("o_orderstatus") == "O", "ORDER_OPEN")
        .otherwise("ORDER_PARTIAL"),
        F.col("last_ship"),
        "ORDER",
    )
    last_ship = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    shipped_orders = orders.join(last_ship, F.col("o_orderkey") == F.col("l_orderkey"))
    number = F.col("l_linenumber").cast("string")
    is_return = F.col("l_returnflag") == "R"
    moved = Event(
        F.when(is_return, "ITEM_RETURNED").when(F.col("l_linestatus") == "O", "ITEM_OPEN").otherwise("ITEM_SHIPPED"),
        F.col("l_shipdate"),
        "LINE",
        attributes={"line": number, "part": F.col("l_partkey"), "supplier": F.col("l_suppkey")},
    )
    raised = Event(
        F.lit("RETURN_RAISED"), F.col("l_shipdate"), "RETURN", attributes={"incident_id": number}, when=is_return
    )
    resolved = Event(
        F.lit("RETURN_RESOLVED"),
        F.col("l_shipdate") + F.make_dt_interval(F.col("l_linenumber")),
        "RETURN",
        attributes={"incident_id": number},
        when=is_return,
    )
    order_key = F.col("o_orderkey")
    no_key = F.lit("")
    all_lines = read_table(spark, folder, "lineitem")
    return [
        EventSource(orders, order_key, no_key, [placed, paid] if payments else [placed]),
        EventSource(shipped_orders, order_key, no_key, [closed], count_in=orders),
        EventSource(lines, F.col("l_orderkey"), number, [moved, raised, resolved], count_in=all_lines),
    ]


def order_dims(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    places = customer_places(spark, folder)
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        F.col("o_orderkey").alias("case_id"), "store_id", "channel"
    )


def click_log(spark: SparkSession, folder: str, by: str = "day", dims: bool = True) -> DataFrame:
    places = click_dims(spark, folder, by) if dims else None
    return linked_log(click_sources(spark, folder, by), CLICK_RANKS, places)


def order_log(spark: SparkSession, folder: str, dims: bool = True) -> DataFrame:
    places = order_dims(spark, folder) if dims else None
    return linked_log(order_sources(spark, folder), ORDER_RANKS, places)


def stored_order_log(spark: SparkSession, folder: str) -> DataFrame:
    """The order log, without attributes, written once for queries that use it several times."""
    log = order_log(spark, folder).drop("event_attributes", "resource_id")
    return overwrite_table(log, fresh_dir(spark, "order-log"))

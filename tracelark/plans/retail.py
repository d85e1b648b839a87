"""Retail transaction documents written from the test tables.

Every order becomes a transaction.  A document holds the header with tender
lines, or the header with a block of at most ``BLOCK`` item lines and their
incidents; so headers repeat and have to be de-duplicated, and no document
grows with the number of lines of its order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.dedup import drop_copies
from ..operators.event_log import linked_log
from ..operators.retail import CATEGORY_RANKS, case_dimensions, columns_read, retail_sources
from ..session import fresh_dir
from ..sources.documents import explode_incidents, explode_items, explode_tender, parse_headers
from ..sources.raw import add_ingest_columns
from ..sources.tables import overwrite_table, read_table
from .logs import LINE_KEY, LINE_ORDER

BLOCK = 4
OPENING_MS = 1_746_057_600_000
INGEST_TS = "2025-12-01 00:00:00"


def _start_ms(order_key: Column) -> Column:
    return F.lit(OPENING_MS) + order_key * 37_000 + F.pmod(order_key * 7, F.lit(1000))


def _pick(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def _money(amount: Column) -> Column:
    return amount.cast("decimal(12,2)")


def _document(*sections: Column) -> Column:
    """An order's header and the given sections as JSON."""
    order_key, customer = F.col("o_orderkey"), F.col("o_custkey")
    store = F.concat(F.lit("STR-00"), (F.pmod(customer, F.lit(7)) + 1).cast("string"))
    start = _start_ms(order_key)
    end = start + 45_000 + F.pmod(customer, F.lit(30)) * 1000
    status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "SUSPENDED")
    total = _money(F.col("o_totalprice"))
    columns = [
        F.concat(F.lit("T"), order_key.cast("string")).alias("transaction_id"),
        store.alias("store_id"),
        F.concat(store, F.lit("-TERM-0"), (F.pmod(order_key, F.lit(4)) + 1).cast("string")).alias("terminal_id"),
        F.when(
            F.pmod(order_key, F.lit(3)) == 0, F.concat(F.lit("C"), F.pmod(customer, F.lit(50)).cast("string"))
        ).alias("cashier_id"),
        F.concat(F.lit("CUST-"), customer.cast("string")).alias("customer_id"),
        _pick(order_key, "IN_STORE_ASSISTED", "SELF_CHECKOUT", "KIOSK").alias("channel"),
        F.timestamp_millis(start).alias("transaction_start_ts"),
        F.timestamp_millis(end).alias("transaction_end_ts"),
        status.otherwise("VOIDED").alias("status"),
        F.lit("USD").alias("currency"),
        total.alias("subtotal_amount"),
        _money(F.lit(0)).alias("discount_amount"),
        _money(F.lit(0)).alias("tax_amount"),
        total.alias("total_amount"),
        F.pmod(customer, F.lit(10)).cast("int").alias("item_count"),
        *(sections or [_tender(order_key, customer, end, total).alias("tender")]),
    ]
    return F.to_json(F.struct(*columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX"})


def _tender(order_key: Column, customer: Column, end: Column, total: Column) -> Column:
    def line(number: int, ts: Column, kind: Column, amount: Column, brand: Column) -> Column:
        return F.struct(
            F.lit(f"P{number}").alias("tender_id"),
            F.timestamp_millis(ts).alias("tender_ts"),
            kind.alias("tender_type"),
            amount.alias("amount"),
            brand.alias("card_brand"),
        )

    # An order without a customer has a coupon: element_at takes its result for not null, so a null index gave one or the other.
    kind = F.when(customer.isNull(), "COUPON").otherwise(_pick(customer, "CASH", "CREDIT_CARD", "COUPON"))
    no_brand = F.lit(None).cast("string")
    first = line(1, end, kind, total, F.when(kind == "CREDIT_CARD", "VISA"))
    second = line(2, end - 2000, F.lit("GIFT_CARD"), _money(F.lit(1)), no_brand)
    lines = F.when(F.pmod(order_key, F.lit(12)) == 0, F.array(first, second)).otherwise(F.array(first))
    return F.when(F.col("o_orderstatus") == "F", lines).otherwise(F.slice(lines, 1, 0))


#: What the lines of a document are made of; a block carries these narrow values, its item and incident fields come last.
LINE_VALUES = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")


def _line_id(line: Column) -> Column:
    return F.concat(F.lit("LN-00"), line["l_linenumber"].cast("string"))


def _scan_ms(order_key: Column, line: Column) -> Column:
    return _start_ms(order_key) + F.floor((line["l_linenumber"] + 1) / 2) * 11_000


def _item(order_key: Column, line: Column) -> Column:
    number, part, supplier = line["l_linenumber"], line["l_partkey"], line["l_suppkey"]
    return F.struct(
        _line_id(line).alias("line_id"),
        number.alias("sequence_number"),
        F.timestamp_millis(_scan_ms(order_key, line)).alias("scan_ts"),
        F.concat(F.lit("SKU-"), part.cast("string")).alias("sku"),
        F.concat(F.lit("Part "), part.cast("string")).alias("item_name"),
        _pick(part, "Grocery", "Electronics", "Bakery", "Produce").alias("department"),
        F.concat(F.lit("C"), F.pmod(part, F.lit(10)).cast("string")).alias("category"),
        _pick(supplier, "BARCODE", "QR_CODE", "MANUAL_ENTRY", "WEIGHT_PLU", "PLU_LOOKUP", "RFID").alias("scan_method"),
        line["l_quantity"].cast("decimal(10,3)").alias("quantity"),
        _money(line["l_extendedprice"]).alias("unit_price"),
        _money(line["l_discount"]).alias("line_discount_amount"),
        _money(line["l_extendedprice"]).alias("extended_amount"),
        (line["l_returnflag"] == "R").alias("is_return"),
        (number == 7).alias("is_void"),
    )


def _incident(order_key: Column, line: Column) -> Column:
    supplier, scan = line["l_suppkey"], _scan_ms(order_key, line)
    open_ms = F.pmod(line["l_partkey"], F.lit(40)) * 500
    is_resolved = F.pmod(supplier, F.lit(5)) != 0
    return F.struct(
        F.concat(F.lit("I"), line["l_linenumber"].cast("string")).alias("incident_id"),
        F.timestamp_millis(scan).alias("incident_ts"),
        _pick(supplier, "WEIGHT_SCAN_REQUIRED", "PRICE_OVERRIDE", "MANAGER_APPROVAL_REQUIRED").alias("incident_type"),
        _line_id(line).alias("related_line_id"),
        F.when(is_resolved, "APPROVED").alias("resolution"),
        F.when(is_resolved, F.timestamp_millis(scan + open_ms)).alias("resolution_ts"),
        F.when(
            is_resolved & (F.pmod(supplier, F.lit(2)) == 1),
            F.concat(F.lit("MGR-"), F.pmod(supplier, F.lit(100)).cast("string")),
        ).alias("resolved_by"),
        F.when(is_resolved, F.floor(open_ms / 1000).cast("int")).alias("duration_seconds"),
    )


def _line_blocks(lines: DataFrame) -> DataFrame:
    """(order_key, block, lines): the lines of every block, each line number once.

    Line items are shuffled once, by order: dropping copies, blocks and the join with the orders all keep to that partitioning.
    """
    once = drop_copies(lines.repartition("l_orderkey"), LINE_KEY, LINE_ORDER)
    block = F.floor((F.col("l_linenumber") - 1) / BLOCK)
    # (order, line number) is unique here, so a block never has more than BLOCK lines.
    return once.groupBy(F.col("l_orderkey").alias("order_key"), block.alias("block")).agg(
        F.collect_list(F.struct(*LINE_VALUES)).alias("lines")
    )


def retail_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as JSON text lines (``raw_json``)."""
    orders = read_table(spark, folder, "orders")
    blocks = _line_blocks(read_table(spark, folder, "lineitem"))
    is_first = F.row_number().over(Window.partitionBy("order_key").orderBy("block")) == 1
    # All documents of an order are written next to each other, so that copies of its header meet before they are shuffled.
    joined = orders.join(blocks.withColumn("is_first", is_first), F.col("o_orderkey") == F.col("order_key"), "left")
    order_key, lines = F.col("order_key"), F.col("lines")
    items = F.transform(lines, lambda line: _item(order_key, line))
    returned = F.filter(lines, lambda line: line["l_returnflag"] == "R")
    incidents = F.transform(returned, lambda line: _incident(order_key, line))
    texts = F.array(
        F.when(order_key.isNull() | F.col("is_first"), _document()),
        F.when(order_key.isNotNull(), _document(items.alias("items"), incidents.alias("incidents"))),
    )
    return joined.select(F.explode(texts).alias("raw_json")).where(F.col("raw_json").isNotNull())


def with_faults(lines: DataFrame, column: str = "raw_json") -> DataFrame:
    """The same documents with fields misnamed, missing or negative, a few of each table."""
    text = F.col(column)
    text = F.regexp_replace(text, '"sku":("SKU-[0-9]*7")', '"code":$1')
    text = F.regexp_replace(text, '"quantity":(5[.])', '"quantity":-$1')
    text = F.regexp_replace(text, '"tender_type":"COUPON"', '"kind":"COUPON"')
    text = F.regexp_replace(text, '"amount":1[.]00([,}])', '"amount":0.00$1')
    early = F.contains(text, F.lit("STR-007-TERM-01"))
    text = F.when(early, F.regexp_replace(text, '"transaction_start_ts":"[^"]*",', "")).otherwise(text)
    return lines.withColumn(column, text)


def retail_raw(spark: SparkSession, folder: str) -> DataFrame:
    ingested = F.lit(INGEST_TS).cast("timestamp")
    return add_ingest_columns(retail_lines(spark, folder), ingest_ts=ingested)


@dataclass(frozen=True)
class RetailTables:
    transactions: DataFrame
    items: DataFrame
    incidents: DataFrame
    tender: DataFrame

    def sources(self, attributes: Sequence[str] | None = None) -> list:
        return retail_sources(self.transactions, self.items, self.incidents, self.tender, attributes)

    def log(self, attributes: Sequence[str] | None = None, **options) -> DataFrame:
        return linked_log(self.sources(attributes), CATEGORY_RANKS, case_dimensions(self.transactions), **options)

    def stored(self, root: str, attributes: Sequence[str] | None = None) -> RetailTables:
        """The tables written below ``root``; with ``attributes`` only the columns that a log with those attributes reads."""
        tables = {}
        for name in (f.name for f in fields(RetailTables)):
            table = getattr(self, name)
            if attributes is not None:
                table = table.select(columns_read(name, attributes, table.columns))
            tables[name] = overwrite_table(table, f"{root}/{name}")
        return RetailTables(**tables)


def typed_tables(raw: DataFrame, **options) -> RetailTables:
    return RetailTables(
        parse_headers(raw, **options),
        explode_items(raw, **options),
        explode_incidents(raw, **options),
        explode_tender(raw, **options),
    )


def retail_tables(spark: SparkSession, folder: str) -> RetailTables:
    """Typed tables over the documents, which are written once as a raw table."""
    return typed_tables(overwrite_table(retail_raw(spark, folder), fresh_dir(spark, "retail-raw")))


def retail_log(spark: SparkSession, folder: str, attributes: Sequence[str] | None = None) -> DataFrame:
    """The linked retail log over stored typed tables; ``attributes`` names the event attributes wanted (default: all)."""
    return retail_tables(spark, folder).stored(fresh_dir(spark, "retail-typed"), attributes).log(attributes)

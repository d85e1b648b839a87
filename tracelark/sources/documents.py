"""From raw JSON lines to four typed tables.

Each table declares only the part of the document it needs, so every parse
skips the rest.  Malformed lines become null structs; rows without an id are
dropped unless ``keep_null_ids`` is set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import drop_copies, drop_stream_copies

# Field names and types of the transaction document
HEADER_FIELDS = """
    transaction_id STRING, store_id STRING, terminal_id STRING, cashier_id STRING,
    customer_id STRING, channel STRING, transaction_start_ts TIMESTAMP,
    transaction_end_ts TIMESTAMP, status STRING, currency STRING,
    subtotal_amount DECIMAL(12,2), discount_amount DECIMAL(12,2),
    tax_amount DECIMAL(12,2), total_amount DECIMAL(12,2), item_count INT
"""
ITEM_FIELDS = """
    line_id: STRING, sequence_number: INT, scan_ts: TIMESTAMP, sku: STRING,
    item_name: STRING, department: STRING, category: STRING, scan_method: STRING,
    quantity: DECIMAL(10,3), unit_price: DECIMAL(12,2), line_discount_amount: DECIMAL(12,2),
    extended_amount: DECIMAL(12,2), is_return: BOOLEAN, is_void: BOOLEAN
"""
INCIDENT_FIELDS = """
    incident_id: STRING, incident_ts: TIMESTAMP, incident_type: STRING,
    related_line_id: STRING, resolution: STRING, resolution_ts: TIMESTAMP,
    resolved_by: STRING, duration_seconds: INT
"""
TENDER_FIELDS = """
    tender_id: STRING, tender_ts: TIMESTAMP, tender_type: STRING, amount: DECIMAL(12,2),
    authorization_number: STRING, card_brand: STRING, last4: STRING, coupon_code: STRING,
    change_amount: DECIMAL(12,2)
"""
SECTIONS = {
    "items": (ITEM_FIELDS, "line_id"),
    "incidents": (INCIDENT_FIELDS, "incident_id"),
    "tender": (TENDER_FIELDS, "tender_id"),
}

WATERMARK = "1 hour"


def _parsed(raw: DataFrame, fields: str, *more: str) -> DataFrame:
    """The fields as columns, all null for a malformed line, and ``more`` of the raw columns.

    A filter on fields would be moved ahead of a plain projection and parse every
    document once more; it stays behind a generator.
    """
    return raw.select(F.inline(F.array(F.from_json("raw_json", fields))), *more)


def header_rows(raw: DataFrame, keep_null_ids: bool = False) -> DataFrame:
    """Typed header columns with ``ingest_ts`` and ``record_hash``; copies still in."""
    rows = _parsed(raw, HEADER_FIELDS, "ingest_ts", "record_hash")
    return rows if keep_null_ids else rows.where(F.col("transaction_id").isNotNull())


def section_rows(raw: DataFrame, section: str, keep_null_ids: bool = False) -> DataFrame:
    """One row per element of a document's array; copies still in."""
    fields, key = SECTIONS[section]
    rows = (
        _parsed(raw, f"transaction_id STRING, {section} ARRAY<STRUCT<{fields}>>", "ingest_ts")
        .select("transaction_id", F.explode(section).alias("part"), "ingest_ts")
        .select("transaction_id", "part.*", "ingest_ts")
    )
    if keep_null_ids:
        return rows
    return rows.where(F.col("transaction_id").isNotNull() & F.col(key).isNotNull())


def parse_headers(raw: DataFrame, scope: str = "forever", keep_null_ids: bool = False) -> DataFrame:
    """One row per ``transaction_id``."""
    return _once_per_key(header_rows(raw, keep_null_ids), ["transaction_id"], scope)


def explode_section(raw: DataFrame, section: str, scope: str = "forever", keep_null_ids: bool = False) -> DataFrame:
    """One row per (``transaction_id``, element id) of the section."""
    key = SECTIONS[section][1]
    return _once_per_key(section_rows(raw, section, keep_null_ids), ["transaction_id", key], scope)


def explode_items(raw: DataFrame, **options) -> DataFrame:
    return explode_section(raw, "items", **options)


def explode_incidents(raw: DataFrame, **options) -> DataFrame:
    return explode_section(raw, "incidents", **options)


def explode_tender(raw: DataFrame, **options) -> DataFrame:
    return explode_section(raw, "tender", **options)


def _once_per_key(rows: DataFrame, keys: Sequence[str], scope: str) -> DataFrame:
    """Streams keep the first arrival; batches the earliest ingested copy, then by content hash."""
    if rows.isStreaming:
        return drop_stream_copies(rows, keys, "ingest_ts", WATERMARK, scope)
    rest = [name for name in rows.columns if name not in keys and name != "ingest_ts"]
    return drop_copies(rows, keys, ["ingest_ts", F.xxhash64(*rest)])

"""The retail mapping: four typed tables to event sources."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from .event_log import Event, EventSource

# Categories, their order at equal times, and labels
LIFECYCLE = "TRANSACTION_LIFECYCLE"
ITEM_SCAN = "ITEM_SCAN"
INCIDENT = "INCIDENT"
PAYMENT = "PAYMENT"
CATEGORY_RANKS = {LIFECYCLE: 0, ITEM_SCAN: 1, INCIDENT: 2, PAYMENT: 3}
SCAN_LABELS = {
    "BARCODE": "ITEM_SCANNED_BARCODE",
    "QR_CODE": "ITEM_SCANNED_QR_CODE",
    "MANUAL_ENTRY": "ITEM_ENTERED_MANUALLY",
    "WEIGHT_PLU": "ITEM_WEIGHED",
    "PLU_LOOKUP": "ITEM_LOOKED_UP",
}
DEFAULT_SCAN_LABEL = "ITEM_SCANNED_BARCODE"
#: What the log reads of each table, besides attributes.
READ = {
    "transactions": ("transaction_id", "transaction_start_ts", "transaction_end_ts", "status", "cashier_id", "store_id", "channel"),
    "items": ("transaction_id", "line_id", "scan_ts", "scan_method", "is_void", "is_return"),
    "incidents": ("transaction_id", "incident_id", "incident_type", "incident_ts", "resolution_ts", "resolved_by"),
    "tender": ("transaction_id", "tender_id", "tender_ts"),
}


def _attributes(*names: str) -> dict:
    return {name: F.col(name) for name in names}


def lifecycle_source(transactions: DataFrame) -> EventSource:
    """Every transaction starts, and ends with its status."""
    started = Event(
        activity=F.lit("TRANSACTION_STARTED"),
        ts=F.col("transaction_start_ts"),
        category=LIFECYCLE,
        resource=F.col("cashier_id"),
        attributes=_attributes("store_id", "terminal_id", "channel", "currency"),
    )
    ended = Event(
        activity=F.concat(F.lit("TRANSACTION_"), F.col("status")),
        ts=F.col("transaction_end_ts"),
        category=LIFECYCLE,
        resource=F.col("cashier_id"),
        attributes=_attributes("store_id", "status", "total_amount", "item_count"),
    )
    return EventSource(transactions, F.col("transaction_id"), F.lit(""), [started, ended])


def item_source(items: DataFrame) -> EventSource:
    """A line is a void before a return before the way it was scanned."""
    label = F.when(F.col("is_void"), "ITEM_VOIDED").when(F.col("is_return"), "ITEM_RETURNED")
    for method, name in SCAN_LABELS.items():
        label = label.when(F.col("scan_method") == method, name)
    scanned = Event(
        activity=label.otherwise(DEFAULT_SCAN_LABEL),
        ts=F.col("scan_ts"),
        category=ITEM_SCAN,
        attributes=_attributes(
            "sku", "item_name", "department", "category", "scan_method", "quantity", "unit_price", "line_id"
        ),
    )
    return EventSource(items, F.col("transaction_id"), F.col("line_id"), [scanned])


def incident_source(incidents: DataFrame) -> EventSource:
    """An incident is raised and, where there is a resolution time, resolved."""
    raised = Event(
        activity=F.concat(F.col("incident_type"), F.lit("_RAISED")),
        ts=F.col("incident_ts"),
        category=INCIDENT,
        attributes=_attributes("incident_id", "incident_type", "related_line_id"),
    )
    resolved = Event(
        activity=F.concat(F.col("incident_type"), F.lit("_RESOLVED")),
        ts=F.col("resolution_ts"),
        category=INCIDENT,
        resource=F.col("resolved_by"),
        attributes=_attributes("incident_id", "incident_type", "resolution", "duration_seconds"),
        when=F.col("resolution_ts").isNotNull(),
    )
    return EventSource(incidents, F.col("transaction_id"), F.col("incident_id"), [raised, resolved])


def tender_source(tender: DataFrame) -> EventSource:
    applied = Event(
        activity=F.lit("TENDER_APPLIED"),
        ts=F.col("tender_ts"),
        category=PAYMENT,
        attributes=_attributes("tender_type", "amount", "card_brand", "tender_id"),
    )
    return EventSource(tender, F.col("transaction_id"), F.col("tender_id"), [applied])


def columns_read(table: str, attributes: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Those of a typed table's columns that a log with these attributes needs."""
    return [name for name in columns if name in READ[table] or name in attributes]


def retail_sources(
    transactions: DataFrame,
    items: DataFrame,
    incidents: DataFrame,
    tender: DataFrame,
    attributes: Sequence[str] | None = None,
) -> list[EventSource]:
    """The four sources; ``attributes`` names the event attributes to carry along (default: all).

    A map is shuffled with its event as a whole, so one that nobody reads in full is better built in part.
    """
    sources = [
        lifecycle_source(transactions),
        item_source(items),
        incident_source(incidents),
        tender_source(tender),
    ]
    if attributes is None:
        return sources

    def wanted(event: Event) -> Event:
        return replace(event, attributes={name: value for name, value in event.attributes.items() if name in attributes})

    return [replace(source, events=[wanted(event) for event in source.events]) for source in sources]


def case_dimensions(transactions: DataFrame) -> DataFrame:
    """Store and channel of every case."""
    return transactions.select(F.col("transaction_id").alias("case_id"), "store_id", "channel")

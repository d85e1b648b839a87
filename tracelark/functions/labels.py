"""Text forms shown to people."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NO_VALUE = "—"
ARROW = "→"


def title_label(name: Column) -> Column:
    """ITEM_SCANNED_BARCODE -> Item Scanned Barcode."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def thousands(count: Column) -> Column:
    """12345 -> 12,345."""
    return F.format_number(count, 0)


def duration_text(ms: Column) -> Column:
    """Seconds with one decimal below a minute, else whole minutes and seconds; a dash for null."""
    seconds = ms.cast("double") / 1000
    whole = seconds.cast("long")
    return (
        F.when(ms.isNull() | F.isnan(ms.cast("double")), F.lit(NO_VALUE))
        .when(seconds < 60, F.format_string("%.1fs", seconds))
        .otherwise(F.format_string("%dm %ds", F.floor(whole / 60).cast("long"), F.pmod(whole, F.lit(60))))
    )


def step_label(step: Column) -> Column:
    """Abbreviated count: 512, 4k, 2M (cut, not rounded)."""
    return (
        F.when(step >= 1_000_000, F.concat(F.floor(step / 1_000_000).cast("string"), F.lit("M")))
        .when(step >= 1_000, F.concat(F.floor(step / 1_000).cast("string"), F.lit("k")))
        .otherwise(step.cast("string"))
    )


def edge_id(source: Column, target: Column) -> Column:
    return F.concat(source, F.lit(ARROW), target)

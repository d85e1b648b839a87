"""Time differences in milliseconds at a chosen precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PRECISIONS = ("second", "milli")


def epoch_ms(ts: Column, precision: str = "second") -> Column:
    """Milliseconds since 1970.

    ``second`` floors to the whole second first, so results are multiples of
    1000; ``milli`` keeps the milliseconds.
    """
    if precision == "second":
        return F.unix_seconds(ts) * F.lit(1000).cast("long")
    if precision == "milli":
        return F.unix_millis(ts)
    raise ValueError(f"precision must be one of {PRECISIONS}, not {precision!r}")


def elapsed_ms(start: Column, stop: Column, precision: str = "second") -> Column:
    return epoch_ms(stop, precision) - epoch_ms(start, precision)

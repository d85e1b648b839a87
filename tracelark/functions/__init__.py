"""Column builders; all of them are built-in expressions."""

from .labels import duration_text, edge_id, step_label, thousands, title_label
from .attributes import attribute_map, category_rank, numeric_or_zero
from .timing import elapsed_ms, epoch_ms

__all__ = [
    "attribute_map",
    "category_rank",
    "duration_text",
    "edge_id",
    "elapsed_ms",
    "epoch_ms",
    "numeric_or_zero",
    "step_label",
    "thousands",
    "title_label",
]

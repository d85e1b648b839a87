"""Structured Streaming: ingest, typed tables, numbered logs, and the refresh of log and graph after them."""

from .cases import numbered_stream, settled_log
from .fanout import TableFanout
from .incremental import IncrementalGraph
from .keys import KeyStore
from .late import LateSplit
from .pipeline import Pipeline, run_available, run_to_folder

__all__ = ["IncrementalGraph", "KeyStore", "LateSplit", "Pipeline", "TableFanout", "numbered_stream", "run_available", "run_to_folder", "settled_log"]

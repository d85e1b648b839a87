"""From a landing folder to the graph tables.

raw lines -> bronze -> four typed tables run as streams, each with its own
checkpoint below ``root``; an ``availableNow`` run takes what is new and ends.
The event log and the graph are then recomputed in full, as counts and
percentiles of a case's edges change when late events reach the case.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dfg import DIMS, dfg_edges, dfg_nodes
from ..operators.event_log import linked_log
from ..operators.retail import CATEGORY_RANKS, case_dimensions, retail_sources
from ..operators.sequence import HOT_CASE_ROWS
from ..session import BUILD_CONF, collect_garbage, fresh_dir, shuffles_released
from ..sources.documents import explode_incidents, explode_items, explode_tender, parse_headers
from ..sources.raw import FILES_PER_TRIGGER, add_ingest_columns, raw_line_stream
from ..sources.snapshots import Folder, Snapshots
from ..sources.tables import by_keys
from .fanout import TableFanout

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("raw_json", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("record_hash", T.StringType()),
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_file_ts", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)
STATE_CONF = [name for name in BUILD_CONF if name.startswith("spark.sql.streaming.stateStore.")]
PARSERS = {
    "silver_transactions": parse_headers,
    "silver_transaction_items": explode_items,
    "silver_transaction_incidents": explode_incidents,
    "silver_transaction_tender": explode_tender,
}


def start_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append all input that is there to parquet files, exactly once per checkpoint.

    State goes to RocksDB, also in a session somebody else built: keys outgrow
    the heap long before they outgrow the disks.  A micro-batch stores its changes
    of the state, not the files that were compacted meanwhile.
    """
    for name in STATE_CONF:
        stream.sparkSession.conf.set(name, BUILD_CONF[name])
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def run_available(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> None:
    start_available(stream, path, checkpoint, partition_by).awaitTermination()


def run_to_folder(spark: SparkSession, stream: DataFrame, tag: str) -> DataFrame:
    """One-off run into a new folder below the shared one; returns what was written."""
    folder = fresh_dir(spark, tag)
    run_available(stream, f"{folder}/table", f"{folder}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")


@dataclass(frozen=True)
class Pipeline:
    """``landing`` holds NDJSON files; tables and checkpoints go below ``root``.

    A new ``generation`` has checkpoints and table folders of its own, so
    everything is read again without touching older output.  ``activate`` makes a
    generation the one that ``active`` opens.
    """

    spark: SparkSession
    landing: str
    root: str
    scope: str = "forever"
    keep_null_ids: bool = False
    max_files: int = FILES_PER_TRIGGER
    generation: str = "g0"
    precision: str = "second"
    hot_rows: int | None = HOT_CASE_ROWS

    def path(self, table: str) -> str:
        return f"{self.root}/{self.generation}/tables/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/{self.generation}/checkpoints/{table}"

    @property
    def gold(self) -> Snapshots:
        """Event log, edges and nodes: always those of one refresh."""
        return Snapshots(self.spark, f"{self.root}/{self.generation}/gold")

    def table(self, name: str) -> DataFrame:
        return self.gold.read(name) if name.startswith("gold_") else self.spark.read.parquet(self.path(name))

    def _pointer(self) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/active")

    def activate(self) -> None:
        """From now on, this generation is the one in use."""
        self._pointer().publish({"generation": Folder(self.generation, "")})

    def active(self) -> Pipeline:
        """The generation in use: the one activated last, else this one."""
        found = self._pointer().current().get("generation")
        return replace(self, generation=found.path) if found else self

    def reset(self, generation: str) -> Pipeline:
        """Everything anew under another name, in use once it is complete; the old generation is left as it is."""
        fresh = replace(self, generation=generation)
        fresh.run()
        fresh.activate()
        return fresh

    def ingest(self) -> None:
        """Landing files to bronze, by ingest date."""
        lines = add_ingest_columns(raw_line_stream(self.spark, self.landing, self.max_files))
        run_available(lines, self.path("bronze"), self.checkpoint("bronze"), ["ingest_date"])

    def bronze_stream(self) -> DataFrame:
        reader = self.spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", self.max_files)
        return reader.parquet(self.path("bronze"))

    def typed_stream(self, table: str) -> DataFrame:
        parse = partial(PARSERS[table], scope=self.scope, keep_null_ids=self.keep_null_ids)
        return parse(self.bronze_stream())

    def parse(self) -> None:
        """Bronze to the four typed tables, side by side."""
        self._parse_all()
        collect_garbage(self.spark)

    def _parse_all(self) -> None:
        started = [
            start_available(self.typed_stream(table), self.path(table), self.checkpoint(table)) for table in PARSERS
        ]
        for query in started:
            query.awaitTermination()

    def fanout(self) -> TableFanout:
        """The writer behind ``parse_once`` and its tables, quarantine and counts."""
        return TableFanout(self.spark, f"{self.root}/{self.generation}/fanout", keep_null_ids=self.keep_null_ids)

    def parse_once(self) -> None:
        """Bronze to the four typed tables in one stream: each document is read and parsed once, rules are applied.

        An alternative to ``parse``, with tables of its own; copies are dropped against all batches before, as with the scope ``forever``.
        """
        writer = self.bronze_stream().writeStream.foreachBatch(self.fanout().write)
        writer = writer.option("checkpointLocation", self.checkpoint("fanout")).trigger(availableNow=True)
        with shuffles_released(self.spark):
            writer.start().awaitTermination()

    def refresh(self) -> None:
        """Recompute event log, edges and nodes; readers change over to the new ones in one step.

        A refresh that fails leaves the tables as they were.  The stored log carries successor, end flag and dimensions, so the
        graph reads a few narrow columns of it and needs no window.
        """
        self._refresh_from(self.table)

    def _refresh_from(self, table: Callable[[str], DataFrame]) -> None:
        with shuffles_released(self.spark):
            transactions, items, incidents, tender = (table(name) for name in PARSERS)
            sources = retail_sources(transactions, items, incidents, tender)
            linked = linked_log(sources, CATEGORY_RANKS, case_dimensions(transactions), self.hot_rows)
            gold = self.gold
            stored = gold.write(linked)
            log = gold.frame([stored])
            edges = by_keys(dfg_edges(log, self.precision), [*DIMS, "source_activity", "target_activity"])
            nodes = by_keys(dfg_nodes(log, self.precision), [*DIMS, "activity_name", "activity_category"])
            gold.publish({"gold_event_log": stored, "gold_dfg_edges": gold.write(edges), "gold_dfg_nodes": gold.write(nodes)})
            gold.expire()

    def run_once(self) -> None:
        """Like ``run``, over ``parse_once``; rows in quarantine have no part in log and graph."""
        self.ingest()
        self.parse_once()
        self._refresh_from(self.fanout().table)

    def run(self) -> None:
        self.ingest()
        self.parse()
        self.refresh()

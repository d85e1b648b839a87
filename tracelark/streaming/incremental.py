"""Log and graph kept up to date by the cases that new events touch.

The linked log is stored in buckets of cases.  An append looks the new events'
cases up in one column of their buckets, reads only the buckets that hold some
of them, links those cases anew, and rewrites just these buckets; cases never
seen before go to further folders.  The files also say which rows are new or
have changed, and from what: the graph's sums lose what the touched cases had
added and gain what they add now.  Log, sums, edges and nodes are published in
one step.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from ..operators.dfg import DIMS
from ..operators.event_log import LOG_ORDER
from ..operators.increment import changed_sums, edges_of_sums, graph_sums, nodes_of_sums, summed_columns
from ..operators.sequence import CASE, HOT_CASE_ROWS, LINKS, link_events
from ..session import fresh_dir, shuffles_released
from ..sources.snapshots import Folder, Snapshots
from ..sources.tables import overwrite_table, remove_table

BUCKET = "case_bucket"
#: Parts of a bucket: its cases are dealt to this many at most.
PART, PARTS = "bucket_part", 64
#: What the files of an append tell besides the log: a row's state and, of a changed one, what it was.
STATE, WAS = "row_state", "row_was"
UNTOUCHED, SAME, CHANGED, NEW = 0, 1, 2, 3
EDGES, NODES = "gold_dfg_edges", "gold_dfg_nodes"


@dataclass(frozen=True)
class Appended:
    """What an append did: its version, how many cases were there before, the log folders it read and those it left alone."""

    version: int
    reopened_cases: int
    folders_read: list[str] = field(default_factory=list)
    folders_left: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class IncrementalGraph:
    """``buckets`` bounds the folders an append can touch; choose it so that a bucket is a few files."""

    spark: SparkSession
    root: str
    buckets: int = 64
    precision: str = "second"
    hot_rows: int | None = HOT_CASE_ROWS
    keep: int = 2

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.spark, self.root, self.keep)

    def table(self, name: str) -> DataFrame:
        """gold_dfg_edges, gold_dfg_nodes or one of the tables of sums, as published last."""
        return self.snapshots.read(name)

    def log(self) -> DataFrame:
        """The linked log as published last."""
        snapshots = self.snapshots
        return snapshots.frame(f for name, f in snapshots.current().items() if name.startswith("log/"))

    def append(self, events: DataFrame, dims: DataFrame) -> Appended:
        """Take in events not seen before (as given by ``ranked_events``) and the dimensions of their cases.

        A case without a row in ``dims`` keeps the dimensions it has.  Events of any
        time may come for any case.  No events change nothing but the version.
        """
        with shuffles_released(self.spark):
            return self._append(events, dims)

    def _append(self, events: DataFrame, dims: DataFrame) -> Appended:
        snapshots = self.snapshots
        folders = snapshots.current()
        work = fresh_dir(self.spark, "append")
        new = overwrite_table(events.withColumn(BUCKET, self._bucket()), f"{work}/new-events")
        touched = {r[0] for r in new.select(BUCKET).distinct().collect()}  # at most ``buckets``
        parts = {name: f for name, f in folders.items() if name.startswith("log/")}
        probed = self._probed(new, {n: f for n, f in parts.items() if _bucket_of(n) in touched})
        hit = {r[BUCKET] for r in probed if r["reopened"]}
        read = {name: f for name, f in parts.items() if _bucket_of(name) in hit}
        stored = snapshots.frame(read.values()).withColumn(BUCKET, self._bucket()) if read else None
        long = self.hot_rows and max([r["longest"] for r in probed], default=0) > self.hot_rows
        rows = self._by_joins(new, stored, dims, work) if long else self._by_windows(new, stored, dims)
        number = max([int(name.rsplit("/", 1)[1]) for name in parts], default=0) + 1
        written = snapshots.write_split(rows, BUCKET)
        changes: dict[str, Folder | None] = {name: None for name in read}
        for bucket, folder in written.items():
            changes[f"log/{bucket}/{number}"] = _as_log(folder)
        before = {name: snapshots.frame([folders[name]]) for name in summed_columns()} if EDGES in folders else {}
        change = graph_sums(_changes(snapshots.frame(written.values()) if written else rows), self.precision)
        changes |= {name: snapshots.write(df) for name, df in changed_sums(before, change).items()}
        now = {name: snapshots.frame([changes[name]]) for name in summed_columns()}
        changes[EDGES] = snapshots.write(edges_of_sums(now))
        changes[NODES] = snapshots.write(nodes_of_sums(now))
        version = snapshots.publish(changes)
        snapshots.expire()
        remove_table(self.spark, work)
        return Appended(
            version,
            sum(r["reopened"] for r in probed),
            sorted(f.path for f in read.values()),
            sorted(f.path for name, f in parts.items() if name not in read),
        )

    def _bucket(self):
        return F.pmod(F.xxhash64(CASE), F.lit(self.buckets)).cast("int")

    def _probed(self, new: DataFrame, parts: dict[str, Folder]) -> list:
        """Per bucket, how many touched cases the log holds and how long its longest case gets; reads one column of the touched buckets."""
        cases = new.select(BUCKET, CASE, F.lit(1).alias("_new"))
        if parts:
            stored = self.snapshots.frame(parts.values()).select(self._bucket().alias(BUCKET), CASE, F.lit(0).alias("_new"))
            cases = cases.unionByName(stored)
        sizes = cases.groupBy(BUCKET, CASE).agg(F.sum("_new").alias("_new"), F.count("*").alias("_size"))
        reopened = (F.col("_new") > 0) & (F.col("_size") > F.col("_new"))
        return sizes.groupBy(BUCKET).agg(F.count_if(reopened).alias("reopened"), F.max("_size").alias("longest")).collect()

    def _by_windows(self, new: DataFrame, stored: DataFrame | None, dims: DataFrame) -> DataFrame:
        """All rows of the buckets read and of the new events, linked anew where a case is touched, in one shuffle.

        Rows are dealt by bucket and part of a bucket, so that a task writes few buckets.  Dimensions come in as a row of their own
        before the events of a case; windows find them and whether the case is touched.
        """
        blank = F.lit(None).cast(_was_type(new, dims))
        given = dims.where(F.col(CASE).isNotNull()).select(CASE, F.struct(F.lit(1).alias("age"), *DIMS).alias("_given"), self._bucket().alias(BUCKET))
        events = new.withColumns({WAS: blank, "_given": F.lit(None).cast(given.schema["_given"].dataType), "_new": F.lit(True)})
        if stored is not None:
            held = {WAS: F.struct(*LINKS, *DIMS), "_given": F.struct(F.lit(0).alias("age"), *DIMS), "_new": F.lit(False)}
            events = events.unionByName(stored.withColumns(held).drop(*LINKS, *DIMS))
        rows = events.unionByName(given, allowMissingColumns=True).withColumn(PART, F.pmod(F.hash(CASE), F.lit(PARTS)))
        dealt = rows.repartition(BUCKET, PART)
        whole = Window.partitionBy(CASE, BUCKET, PART).orderBy(*LOG_ORDER).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )
        told = dealt.withColumns({"_touched": F.max("_new").over(whole), "_found": F.max("_given").over(whole)})
        told = told.where(F.col("_new").isNotNull()).drop("_new", "_given")
        linked = link_events(told, LOG_ORDER, hot_rows=None, within=(BUCKET, PART))
        touched = F.col("_touched")
        now = {c: F.when(touched, F.col(c)).otherwise(F.col(WAS)[c]) for c in LINKS}
        now |= {c: F.when(touched, F.col("_found")[c]).otherwise(F.col(WAS)[c]) for c in DIMS}
        return _told_apart(linked.withColumns(now).drop("_found", PART), touched).drop("_touched")

    def _by_joins(self, new: DataFrame, stored: DataFrame | None, dims: DataFrame, work: str) -> DataFrame:
        """The same with cases too long for one task, which ``link_events`` spreads over several."""
        blank = F.lit(None).cast(_was_type(new, dims))
        events, own, rest = new.withColumn(WAS, blank), dims.select(CASE, *DIMS, F.lit(1).alias("_age")), None
        if stored is not None:
            chosen = overwrite_table(new.select(F.col(CASE).alias("_case")).distinct(), f"{work}/touched")
            same = stored[CASE].eqNullSafe(chosen["_case"])
            before = stored.withColumn(WAS, F.struct(*LINKS, *DIMS))
            old = overwrite_table(before.join(chosen, same, "left_semi"), f"{work}/old-cases")
            rest = before.join(chosen, same, "left_anti")
            events = events.unionByName(old.drop(*LINKS, *DIMS))
            own = own.unionByName(old.select(CASE, *DIMS, F.lit(0).alias("_age")).distinct())
        newest = own.groupBy(CASE).agg(F.max_by(F.struct(*DIMS), "_age").alias("_dims")).select(CASE, "_dims.*")
        linked = _told_apart(link_events(events, LOG_ORDER, newest, self.hot_rows), F.lit(True))
        whole = linked if rest is None else linked.unionByName(_told_apart(rest, F.lit(False)))
        # rebalance: a bucket is one file unless it is large
        return whole.hint("rebalance", F.col(BUCKET))


def _was_type(new: DataFrame, dims: DataFrame) -> T.StructType:
    """What a row says of its place in the log."""
    kinds = {**{f.name: f.dataType for f in dims.schema}, "event_sequence": T.LongType(), "is_end": T.BooleanType()}
    kinds |= {"next_activity": new.schema["activity_name"].dataType, "next_ts": new.schema["event_ts"].dataType}
    return T.StructType([T.StructField(c, kinds[c]) for c in (*LINKS, *DIMS)])


def _told_apart(rows: DataFrame, touched: Column) -> DataFrame:
    """Which rows are new, changed or as before, and what changed ones were; both only stand in the files, not in the log."""
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(WAS)[c]) for c in (*LINKS, *DIMS)])
    state = F.when(~touched, UNTOUCHED).when(F.col(WAS).isNull(), NEW).when(same, SAME).otherwise(CHANGED)
    told = rows.withColumn(STATE, state)
    return told.withColumn(WAS, F.when(F.col(STATE) == CHANGED, F.col(WAS)))


def _as_log(folder: Folder) -> Folder:
    """The same files without the columns that tell rows apart."""
    fields = [f for f in T.StructType.fromJson(json.loads(folder.columns)).fields if f.name not in (STATE, WAS)]
    return Folder(folder.path, T.StructType(fields).json())


def _changes(rows: DataFrame) -> DataFrame:
    """The touched cases' rows as they are (``now`` 1) and as they were (``was`` 1); a row that is as before stands for both."""
    state = F.col(STATE)
    here = rows.where(state != UNTOUCHED).withColumns({"now": F.lit(1), "was": F.when(state == SAME, 1).otherwise(0)})
    gone = rows.where(state == CHANGED).withColumns(
        {**{c: F.col(WAS)[c] for c in (*LINKS, *DIMS)}, "now": F.lit(0), "was": F.lit(1)}
    )
    return here.drop(STATE, WAS).unionByName(gone.drop(STATE, WAS))


def _bucket_of(name: str) -> int:
    return int(name.split("/")[1])

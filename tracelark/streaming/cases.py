"""A numbered event log out of a stream: a case is numbered when it is complete.

Cases live in keyed state: their events, and the time to act on them.  When no
event has come for ``gap`` of event time, a case is complete and all its events
go out, numbered.  They stay in the state for ``keep`` more; an event that comes
meanwhile reopens the case, which goes out again as a higher revision.  After
that it is dropped, so the state holds the cases of about delay + gap + keep of
event time, however long the stream runs.

The key of the state is a bucket of cases, not a case: a call into the state
costs as much as dozens of events, and most cases have but a few.  A bucket is
read and written once per micro-batch that touches it, and has one timer, that
of the case which is due first.

An event that comes even later begins another life of its case, and a case with
more events than a state should hold goes out in parts without numbers.
``settled_log`` puts lives and parts together and numbers those few cases in a
batch, long ones spread over several tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.event_log import LOG_ORDER, EventSource, stream_events
from ..operators.sequence import CASE, HOT_CASE_ROWS, link_events
from ..session import BUILD_CONF

#: Events of one case that a state holds at most; the rest of such a case is numbered in a batch.
STATE_EVENTS = 10_000

#: Times as microseconds, attributes as JSON: plain types are cheap to keep and to send.
EVENT_FIELDS = (
    "activity_name string, at bigint, resource_id string, activity_category string, "
    "attributes string, event_key string, category_rank int"
)
EMITTED = f"{CASE} string, life bigint, part int, revision int, event_sequence bigint, {EVENT_FIELDS}"
#: A row to be sent out: it has to know its names.
EmittedRow = Row(*[field.split()[0] for field in EMITTED.split(", ")])
BUCKET = "case_bucket"
#: Buckets of cases.  All live cases of a bucket meet in one value of the state: choose more for more live cases than some 10 million.
BUCKETS = 2_048


@dataclass
class LiveCase:
    """A case as its bucket holds it; ``timer_ms`` is when it is complete or, if it is complete already, forgotten."""

    case: str | None
    life: int
    part: int
    revision: int
    last_ms: int
    timer_ms: int
    complete: bool
    events: list = field(default_factory=list)


class CompleteCases(StatefulProcessor):
    """Collects the events of a bucket's cases, sends a case out numbered once it is complete, forgets it later."""

    def __init__(self, gap_ms: int, keep_ms: int, most_events: int = STATE_EVENTS):
        self.gap_ms, self.keep_ms, self.most_events = gap_ms, keep_ms, most_events

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "timer_ms bigint, cases string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        timer_ms, cases = self._stored()
        arrived: dict[str | None, list] = {}
        for row in rows:
            arrived.setdefault(row[1], []).append(tuple(row[2:]))
        for case, events in arrived.items():
            live = cases.get(case)
            if live is None:
                live = cases[case] = LiveCase(case, now, 0, 0, now, 0, False)
            live.events += events
            live.last_ms = max([live.last_ms, *(e[1] // 1000 for e in events if e[1] is not None)])
            live.timer_ms, live.complete = live.last_ms + self.gap_ms, False
            if len(live.events) > self.most_events:
                yield from self._emitted(live, numbered=False)
                live.events, live.part, live.revision = [], live.part + 1, 0
        self._store(timer_ms, cases.values())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # what is due at the expired time, or before the watermark as Spark's own timers are
        until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        _, cases = self._stored()
        staying = []
        for live in cases.values():
            if live.timer_ms <= until and not live.complete:
                if live.events:
                    yield from self._emitted(live, numbered=True)
                live.revision, live.complete = live.revision + 1, True
                live.timer_ms += max(1, self.keep_ms)
            if live.timer_ms > until:
                staying.append(live)
        self._store(None, staying)  # Spark takes away the timer that has expired

    def close(self) -> None:
        pass

    def _stored(self) -> tuple[int | None, dict[str | None, LiveCase]]:
        """The bucket's timer and its cases."""
        if not self.bucket.exists():
            return None, {}
        timer_ms, cases = self.bucket.get()
        return timer_ms, {fields[0]: LiveCase(*fields) for fields in json.loads(cases)}

    def _store(self, old_ms: int | None, cases: Iterable[LiveCase]) -> None:
        rows = [(c.case, c.life, c.part, c.revision, c.last_ms, c.timer_ms, c.complete, c.events) for c in cases]
        new_ms = min((row[5] for row in rows), default=None)
        if old_ms != new_ms:
            if old_ms is not None:
                self.handle.deleteTimer(old_ms)
            if new_ms is not None:
                self.handle.registerTimer(new_ms)
        if rows:
            self.bucket.update((new_ms, json.dumps(rows)))
        else:
            self.bucket.clear()

    @staticmethod
    def _emitted(live: LiveCase, numbered: bool) -> Iterator[Row]:
        found = live.events
        if numbered:  # time, priority, label, key; missing values first
            found = sorted(found, key=lambda e: [(v is not None, v) for v in (e[1], e[6], e[0], e[5])])
        for place, event in enumerate(found, 1):
            yield EmittedRow(live.case, live.life, live.part, live.revision + 1, place if numbered else None, *event)


def _ms(interval: str) -> int:
    """Milliseconds of an interval such as '2 hours'."""
    number, unit = interval.split()
    # Milliseconds of a unit of time
    units = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(number) * units[unit.rstrip("s")]


def numbered_stream(
    sources: Sequence[EventSource],
    ranks: dict[str, int],
    delay: str = "2 hours",
    gap: str = "1 hour",
    keep: str = "1 day",
    most_events: int = STATE_EVENTS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Stream of the events of complete cases, with their numbers; append it to a table and read that by ``settled_log``.

    Intervals are in seconds, minutes, hours or days.  Events behind the watermark are dropped as
    late, as in every stream.  A null case is a case like others; events without a time come out with their case.
    ``buckets`` is fixed for the life of a checkpoint.
    """
    events = stream_events(sources, ranks, delay)
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", BUILD_CONF["spark.sql.streaming.stateStore.providerClass"])
    plain = events.select(
        F.pmod(F.xxhash64(F.col(CASE).cast("string")), F.lit(buckets)).alias(BUCKET),
        F.col(CASE).cast("string").alias(CASE),
        "activity_name",
        F.unix_micros("event_ts").alias("at"),
        "resource_id",
        "activity_category",
        F.to_json("event_attributes").alias("attributes"),
        "event_key",
        F.col("category_rank").cast("int").alias("category_rank"),
        "event_ts",
    )
    processor = CompleteCases(_ms(gap), _ms(keep), most_events)
    return plain.drop("event_ts").groupBy(BUCKET).transformWithState(processor, EMITTED, "Append", "EventTime")


def settled_log(emitted: DataFrame, hot_rows: int | None = HOT_CASE_ROWS) -> DataFrame:
    """The numbered log of what ``numbered_stream`` has written: the last revision of every part, each event once.

    Cases of one part have their numbers already.  Those of several lives or
    parts are numbered here, all over again.  A case that was reopened and is
    not complete yet is shown as it was when it was complete last.
    """
    emission = ["life", "part", "revision"]
    found = emitted.groupBy(CASE, *emission).agg(F.max(F.col("event_sequence").isNull()).alias("open"))
    by_case = Window.partitionBy(CASE)
    newest = found.withColumns(
        {
            "newest": F.max("revision").over(Window.partitionBy(CASE, "life", "part")),
            "again": (F.min(F.struct("life", "part")).over(by_case) != F.max(F.struct("life", "part")).over(by_case))
            | F.max("open").over(by_case),
        }
    ).where("revision = newest")
    keys = newest.select(F.col(CASE).alias("_case"), *[F.col(c).alias(f"_{c}") for c in emission], "again")
    same = emitted[CASE].eqNullSafe(keys["_case"])
    for column in emission:
        same = same & (emitted[column] == keys[f"_{column}"])
    kept = emitted.join(keys, same).select(
        CASE,
        "activity_name",
        F.timestamp_micros("at").alias("event_ts"),
        "resource_id",
        "activity_category",
        F.from_json("attributes", "map<string,string>").alias("event_attributes"),
        "event_key",
        "category_rank",
        "event_sequence",
        "again",
    )
    columns = [c for c in kept.columns if c != "again"]
    done = kept.where(~F.col("again")).select(columns)
    rest = kept.where("again").drop("again", "event_sequence")
    return done.unionByName(link_events(rest, LOG_ORDER, hot_rows=hot_rows).select(columns))

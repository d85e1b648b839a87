"""Late rows kept aside instead of being dropped.

A micro-batch's watermark is the latest event time of all batches before it,
less the delay.  Rows at or behind it are stored apart by the same write that
stores the others, with how late they are; nothing is lost and nothing else
waits for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

BATCH = "batch"
ON_TIME, LATE = "on_time", "late"
LAG = "lag_ms"


@dataclass(frozen=True)
class LateSplit:
    """The writer of a stream with event times: ``stream.writeStream.foreachBatch(split.write)``."""

    spark: SparkSession
    root: str
    time: str
    delay_ms: int

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store a micro-batch; a batch that comes again replaces its own files only."""
        mark = self._marks(batch_id).agg(F.max("high_ms")).first()[0] if batch_id else None
        micros, seen = F.unix_micros(self.time), Observation(f"late {batch_id}")
        lag = F.lit(None).cast("bigint")
        if mark is not None:
            behind = (mark - self.delay_ms) * 1000 - micros
            lag = F.when(behind >= 0, F.floor(behind / 1000))
        judged = rows.withColumn(LAG, lag).withColumn("arrival", F.when(F.col(LAG).isNull(), ON_TIME).otherwise(LATE))
        observed = judged.observe(seen, F.max(F.floor(micros / 1000)).alias("high_ms"), F.count(LAG).alias("late"), F.count("*").alias("rows"))
        observed.write.mode("overwrite").partitionBy("arrival").parquet(f"{self.root}/rows/{BATCH}={batch_id}")
        found = seen.get
        counts = [(found["high_ms"], found["late"], found["rows"])]
        frame = self.spark.createDataFrame(counts, "high_ms bigint, late bigint, rows bigint")
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/marks/{BATCH}={batch_id}")

    def _marks(self, before: int | None = None) -> DataFrame:
        marks = self.spark.read.parquet(f"{self.root}/marks")
        return marks if before is None else marks.where(F.col(BATCH) < before)

    def counts(self) -> DataFrame:
        """(batch, rows, late)"""
        return self._marks().select(BATCH, "rows", "late")

    def on_time(self) -> DataFrame:
        return self._rows(ON_TIME).drop(LAG)

    def late(self) -> DataFrame:
        """Rows behind the watermark, with ``lag_ms`` behind it."""
        return self._rows(LATE)

    def _rows(self, arrival: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/rows").where(F.col("arrival") == arrival).drop("arrival", BATCH)

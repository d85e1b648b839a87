"""Raw ingest: one row per text line, plus metadata; nothing is parsed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.dedup import drop_copies, drop_stream_copies

#: Session setting that names the landing folder; ``source_path`` takes any other name as well.
PATH_SETTING = "tracelark.source.path"
# Fixed values
SOURCE_SYSTEM = "POS_SYSTEM"
FILES_PER_TRIGGER = 100


def source_path(spark: SparkSession, default: str | None = None, setting: str = PATH_SETTING) -> str:
    """Landing folder from the session settings, else the default."""
    path = spark.conf.get(setting, default)
    if not path:
        raise ValueError(f"no landing folder: set {setting} or pass a default")
    return path


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch scan of all lines below ``path``."""
    return _with_provenance(spark.read.text(path))


def raw_line_stream(spark: SparkSession, path: str, max_files: int = FILES_PER_TRIGGER) -> DataFrame:
    """Streaming scan; every micro-batch takes at most ``max_files`` new files."""
    return _with_provenance(spark.readStream.option("maxFilesPerTrigger", max_files).text(path))


def _with_provenance(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("value").alias("raw_json"),
        F.col("_metadata.file_path").alias("source_file_path"),
        F.col("_metadata.file_modification_time").alias("source_file_ts"),
    )


def add_ingest_columns(
    lines: DataFrame,
    source_system: str = SOURCE_SYSTEM,
    ingest_ts: Column | None = None,
    batch_id: Column | None = None,
) -> DataFrame:
    """Bronze columns over ``raw_json`` (and file provenance where there is any).

    ``ingest_ts`` defaults to the clock, which Spark fixes once per query or
    micro-batch; ``batch_id`` defaults to one uuid per row.
    """
    clock = F.current_timestamp() if ingest_ts is None else ingest_ts
    provenance = {
        "source_file_path": F.lit(None).cast("string"),
        "source_file_ts": F.lit(None).cast("timestamp"),
    }
    return lines.select(
        F.col("raw_json"),
        clock.alias("ingest_ts"),
        F.lit(source_system).alias("source_system"),
        (F.expr("uuid()") if batch_id is None else batch_id).alias("batch_id"),
        F.sha2(F.col("raw_json"), 256).alias("record_hash"),
        F.to_date(clock).alias("ingest_date"),
        *[F.col(name) if name in lines.columns else empty.alias(name) for name, empty in provenance.items()],
    )


def unique_records(raw: DataFrame, scope: str = "forever", delay: str = "1 hour") -> DataFrame:
    """One row per ``record_hash``: drops lines that were delivered again word for word."""
    if raw.isStreaming:
        return drop_stream_copies(raw, ["record_hash"], "ingest_ts", delay, scope)
    return drop_copies(raw, ["record_hash"], ["ingest_ts", "source_file_path"])

"""Tables in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def zoned(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants of the session zone, so watermarks and epoch casts work."""
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in naive}) if naive else df


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Batch read of ``folder/name.parquet`` (a file or a directory of files)."""
    return zoned(spark.read.parquet(f"{folder}/{name}.parquet"))


def stream_table(spark: SparkSession, folder: str, name: str, max_files: int = 100) -> DataFrame:
    """Stream of the same table; the schema comes from the footer, not from the data."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    return zoned(reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder))


def overwrite_table(df: DataFrame, path: str) -> DataFrame:
    """Full refresh; returns the table as read back, which also cuts the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table that was written for a while only."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def overwrite_graph_table(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Full refresh laid out by ``keys``.

    Readers of the old table may fail meanwhile; ``Snapshots`` spares them that.
    """
    return overwrite_table(by_keys(df, keys), path)


def by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Laid out by ``keys``.

    Range partitioning on the whole key keeps each (store, channel) together in
    few files with narrow min/max statistics, yet splits one that is very large.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_ndjson(df: DataFrame, path: str, records_per_file: int = 1000, mode: str = "errorifexists") -> None:
    """One JSON object per line, at most ``records_per_file`` lines per file."""
    lines = df.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSX"}).alias("value"))
    lines.write.mode(mode).option("maxRecordsPerFile", records_per_file).text(path)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")

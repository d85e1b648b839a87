"""Written intermediate tables, keys of document rows, joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import fresh_dir

#: A side of a join is broadcast only if it was counted and has at most this many rows of fixed width.
BROADCAST_ROWS = 1_000_000

#: Many small files take longer to open, commit and list than their rows to compute.
FILES_PER_CORE = 4

#: Bytes of rows that go to a Python worker at once: with Spark's 10,000 rows of texts, JVM and worker would each hold 20 MB and more beside their heaps.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Identifies a document row together with its doc_id; equal keys mean equal ids and texts.
TEXT_HASH = "__text_hash"


def written(df: DataFrame, tag: str) -> DataFrame:
    """The table stored below the shared folder and read back: cuts lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by_cores(df: DataFrame, tag: str) -> DataFrame:
    """The same for a table of ids and numbers out of a shuffle: at most ``FILES_PER_CORE`` files a core, however many partitions there were.

    A task writes several partitions, one after the other, so what it holds at once does not grow.
    """
    return written(df.coalesce(FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism), tag)


def narrow(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """With a broadcast hint if its counted rows are few, else as it is (a shuffle join)."""
    if rows is None:
        rows = df.count()
    return F.broadcast(df) if rows <= bound else df


def document_texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the columns asked for; other columns, whatever their names, are left.

    From now on the session sends Python at most ``BATCH_BYTES`` at once (one longer row is sent alone).
    """
    docs.sparkSession.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def held_out(modulo: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by ``modulo``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulo == 0, F.lit(False))

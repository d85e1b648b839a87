"""Streams against batches, both scopes of de-duplication, incremental runs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tracelark.operators.dedup import drop_copies, drop_stream_copies
from tracelark.plans.retail import typed_tables
from tracelark.session import RELEASE, fresh_dir, shuffles_released
from tracelark.sources import add_ingest_columns, raw_lines, source_path, write_ndjson
from tracelark.streaming import Pipeline, run_available

START = dt.datetime(2024, 1, 1)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.length())) if name.startswith("shuffle_")}


def append_lines(spark, landing, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(landing)


def rows(df, drop=("ingest_ts", "record_hash")):
    return sorted((str(sorted(r.asDict().items())) for r in df.drop(*drop).collect()))


def test_pipeline_equals_batch_and_runs_on(spark, fixture_lines):
    root = fresh_dir(spark, "pipeline-test")
    landing = f"{root}/landing"
    append_lines(spark, landing, [fixture_lines[0], fixture_lines[3], "not json", ""])
    pipeline = Pipeline(spark, landing, root)
    pipeline.run()
    assert pipeline.table("silver_transactions").count() == 1
    assert pipeline.table("gold_dfg_nodes").count() == 10 - 2

    append_lines(spark, landing, fixture_lines[1:3] + [fixture_lines[0]])
    pipeline.run()
    pipeline.run()  # nothing new: nothing changes
    bronze = pipeline.table("bronze")
    assert bronze.count() == 7
    assert bronze.where("record_hash <> sha2(raw_json, 256) OR source_file_path IS NULL").count() == 0

    batch = typed_tables(add_ingest_columns(raw_lines(spark, landing)))
    for table, frame in (
        ("silver_transactions", batch.transactions),
        ("silver_transaction_items", batch.items),
        ("silver_transaction_incidents", batch.incidents),
        ("silver_transaction_tender", batch.tender),
    ):
        assert rows(pipeline.table(table)) == rows(frame), table
    assert pipeline.table("gold_event_log").count() == 23
    assert pipeline.table("gold_dfg_edges").count() == 18
    assert pipeline.table("gold_dfg_nodes").count() == 17
    assert pipeline.table("gold_dfg_edges").agg(F.sum("edge_frequency")).first()[0] == 20


def stream_of(spark, folder, batches, schema="key string, ts timestamp, n int"):
    """One file, so one micro-batch, per list of rows; files are taken in name order of time."""
    for rows_ in batches:
        spark.createDataFrame(rows_, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, stream, root):
    run_available(stream, f"{root}/out", f"{root}/checkpoint")
    return [tuple(r) for r in spark.read.parquet(f"{root}/out").orderBy("ts", "n").collect()]


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


BATCHES = [
    [("a", at(0), 1), ("a", at(1), 2), ("b", at(2), 3)],
    [("c", at(300), 4)],
    [("d", at(301), 5)],
    [("a", at(302), 6), ("late", at(3), 7)],
]


def test_a_refresh_leaves_no_shuffle_files(spark, fixture_lines):
    root = fresh_dir(spark, "released")
    append_lines(spark, f"{root}/landing", fixture_lines)
    pipeline = Pipeline(spark, f"{root}/landing", root)
    pipeline.ingest()
    pipeline.parse()
    before, setting = shuffle_files(spark), spark.conf.get(RELEASE, None)
    pipeline.refresh()
    assert not shuffle_files(spark) - before
    with pytest.raises(RuntimeError), shuffles_released(spark):
        assert spark.conf.get(RELEASE) == "true"
        raise RuntimeError
    assert spark.conf.get(RELEASE, None) == setting != "true"
    log = pipeline.table("gold_event_log").groupBy("case_id").count()
    assert len(log.collect()) == len(log.collect()) > 0


def test_forever_remembers_every_key(spark):
    root = fresh_dir(spark, "forever")
    stream = stream_of(spark, f"{root}/in", BATCHES)
    got = run(spark, drop_stream_copies(stream, ["key"], "ts", "1 hour", "forever"), root)
    assert [r[0] for r in got] == ["a", "b", "c", "d"]


def test_watermark_scope_forgets(spark):
    root = fresh_dir(spark, "watermark")
    stream = stream_of(spark, f"{root}/in", BATCHES)
    got = run(spark, drop_stream_copies(stream, ["key"], "ts", "1 hour", "watermark"), root)
    assert [r[0] for r in got] == ["a", "b", "c", "d", "a"]


@pytest.mark.parametrize("scope", ["forever", "watermark"])
@pytest.mark.parametrize("size", [1, 2, 10_000])
def test_the_first_arrival_stays_whatever_the_batch_size(spark, scope, size):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        root = fresh_dir(spark, "arrival")
        stream = stream_of(spark, f"{root}/in", [[("k", at(i), i) for i in (3, 1, 4, 2)]])
        assert [r[2] for r in run(spark, drop_stream_copies(stream, ["key"], "ts", "1 hour", scope), root)] == [3]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_state_is_kept_in_rocksdb(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    root = fresh_dir(spark, "rocksdb")
    run(spark, drop_stream_copies(stream_of(spark, f"{root}/in", BATCHES[:1]), ["key"], "ts", "1 hour"), root)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_a_late_copy_does_not_shadow_one_in_time(spark):
    root = fresh_dir(spark, "late")
    batches = [[("x", at(600), 1)], [("y", at(601), 2)], [("k", at(0), 3), ("k", at(602), 4)]]
    stream = stream_of(spark, f"{root}/in", batches)
    got = run(spark, drop_stream_copies(stream, ["key"], "ts", "1 hour"), root)
    assert [r[2] for r in got] == [1, 2, 4]


def test_unknown_scope(spark):
    root = fresh_dir(spark, "scope")
    stream = stream_of(spark, f"{root}/in", BATCHES[:1])
    with pytest.raises(ValueError):
        drop_stream_copies(stream, ["key"], "ts", "1 hour", "sometimes")


def test_batch_copies_keep_the_first_in_order(spark, capsys):
    data = [("k", 2, i) for i in range(500)] + [("k", 1, 7), ("l", 5, 1), (None, 1, 1), (None, 0, 2)]
    kept = drop_copies(spark.createDataFrame(data, "key string, a int, b int").repartition(5), ["key"], ["a", "b"])
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([("k", 1, 7), ("l", 5, 1), (None, 0, 2)], key=str)
    capsys.readouterr()
    kept.explain()
    limits = [line for line in capsys.readouterr().out.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in line for line in limits)  # before the shuffle


def test_ndjson_files_are_bounded(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(25).select("id", F.lit("2025-05-01 10:00:00.5").cast("timestamp").alias("at")).coalesce(1)
    write_ndjson(frame, path, records_per_file=10)
    files = sorted((tmp_path / "out").glob("part-*"))
    assert [len(f.read_text().splitlines()) for f in files] == [10, 10, 5]
    assert json.loads(files[0].read_text().splitlines()[0]) == {"id": 0, "at": "2025-05-01T10:00:00.500Z"}


def test_source_path_setting(spark):
    assert source_path(spark, "/landing") == "/landing"
    with pytest.raises(ValueError):
        source_path(spark)

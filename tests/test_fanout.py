"""One parse for all tables, rules in the stream, keys that last, late rows, layout for several columns."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tracelark.operators.dedup import drop_stream_copies
from tracelark.operators.quality import ITEM_RULES, clean_rows, quarantined_rows, violation_counts
from tracelark.plans import catalogue
from tracelark.plans.retail import retail_lines, typed_tables, with_faults
from tracelark.session import fresh_dir, shared_dir
from tracelark.sources import add_ingest_columns
from tracelark.sources.layout import clustered
from tracelark.sources.tables import by_keys, overwrite_table
from tracelark.streaming import KeyStore, LateSplit, Pipeline, TableFanout
from tracelark.streaming import fanout as module
from tracelark.streaming.pipeline import start_available

START = dt.datetime(2024, 1, 1)


def rows(df, drop=("ingest_ts", "record_hash")):
    return sorted(json.dumps(r.asDict(recursive=True), default=str, sort_keys=True) for r in df.drop(*drop).collect())


def raw(spark, lines, hour=0):
    stamp = F.lit(START + dt.timedelta(hours=hour)).cast("timestamp")
    return add_ingest_columns(spark.createDataFrame([(line,) for line in lines], "raw_json string"), ingest_ts=stamp)


def test_four_tables_equal_the_batch_parse(spark, fixture_lines):
    fanned = TableFanout(spark, fresh_dir(spark, "fanout"))
    fanned.write(raw(spark, fixture_lines[:2] + fixture_lines[-2:]), 0)
    fanned.write(raw(spark, fixture_lines[1:], 1), 1)
    batch = typed_tables(raw(spark, fixture_lines))
    for name, frame in zip([t.name for t in module.TARGETS], (batch.transactions, batch.items, batch.incidents, batch.tender)):
        # the rules apply here and not there
        rules = next(t.rules for t in module.TARGETS if t.name == name)
        assert rows(fanned.table(name)) == rows(clean_rows(frame, rules)), name


def test_a_repeated_batch_changes_nothing(spark, folder):
    lines = retail_lines(spark, folder)
    parts = [overwrite_table(add_ingest_columns(lines.where(F.pmod(F.xxhash64("raw_json"), F.lit(2)) == p)), fresh_dir(spark, "part")) for p in range(2)]
    fanned = TableFanout(spark, fresh_dir(spark, "fanout"))
    for i, part in enumerate(parts):
        fanned.write(with_faults(part), i)
    names = [t.name for t in module.TARGETS]
    before = [rows(fanned.table(n)) + rows(fanned.quarantine(n)) for n in names] + [rows(fanned.counts())]
    for i in (0, 1, 1):
        fanned.write(with_faults(parts[i]), i)
    assert [rows(fanned.table(n)) + rows(fanned.quarantine(n)) for n in names] + [rows(fanned.counts())] == before
    items = typed_tables(with_faults(parts[0].unionByName(parts[1]))).items
    counted = {r.rule: r.n for r in fanned.counts().where("table_name LIKE '%items'").groupBy("rule").agg(F.sum("violations").alias("n")).collect()}
    assert counted.pop("rows") == items.count() and counted.pop("quarantined") == quarantined_rows(items, ITEM_RULES).count() > 0
    assert counted == {r.rule: r.violations for r in violation_counts(items, ITEM_RULES).collect()}


def test_rows_are_stored_once(spark, fixture_lines):
    """Besides tables, keys, filters and counts a batch leaves nothing behind: no staged documents, no arrivals."""
    fanned = TableFanout(spark, fresh_dir(spark, "fanout"))
    others = set(os.listdir(shared_dir(spark)))
    for batch in range(2):
        fanned.write(raw(spark, fixture_lines, batch), batch)
    assert sorted(os.listdir(fanned.root)) == ["counts", "keys", "staged", "tables"]
    assert not os.listdir(f"{fanned.root}/staged")
    assert {p for p in set(os.listdir(shared_dir(spark))) - others if not p.startswith("fanout-")} == set()
    read = spark.read.option("recursiveFileLookup", "true").parquet(f"{fanned.root}/tables/silver_transaction_items")
    assert read.count() == fanned.table("silver_transaction_items").count() + fanned.quarantine("silver_transaction_items").count()
    assert fanned.table("silver_transactions").groupBy("transaction_id").count().where("count > 1").count() == 0


def test_documents_land_compressed_and_are_built_once(spark, folder):
    fanned = catalogue._fanned(spark, folder, True)
    landing = f"{fanned.root.split('/g0/')[0]}/landing"
    landed = [name for name in os.listdir(landing) if name.startswith("part-")]
    assert landed and all(name.endswith(".gz") for name in landed)
    assert spark.read.text(landing).count() == retail_lines(spark, folder).count()
    assert not [name for name in os.listdir(shared_dir(spark)) if name.startswith("built-")]


def test_bronze_is_read_once(spark, fixture_lines, monkeypatch):
    root = fresh_dir(spark, "once")
    spark.createDataFrame([(line,) for line in fixture_lines], "value string").coalesce(1).write.text(f"{root}/landing")
    pipeline = Pipeline(spark, f"{root}/landing", root)
    pipeline.ingest()
    read = spark.sparkContext.accumulator(0)
    plain, count = module.F.from_json, module.F.udf(lambda x: (read.add(1), x)[1], "string")
    monkeypatch.setattr(module.F, "from_json", lambda c, s: plain(count(c), s))
    pipeline.parse_once()
    assert read.value == len(fixture_lines)
    monkeypatch.undo()
    pipeline.parse_once()  # nothing new
    pipeline._refresh_from(pipeline.fanout().table)
    assert pipeline.table("gold_event_log").count() == 23 and pipeline.table("gold_dfg_edges").count() == 18


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_lasting_keys_equal_forever_over_many_batches(spark, bits):
    """Small filters are full and everything is joined; large ones rule out nearly all.  Both are exact."""
    store = KeyStore(spark, fresh_dir(spark, "keys"), ["a", "b"], bits)
    seen, sizes = {}, []
    for batch in range(6):
        data = [(f"k{(i * 7 + batch * 90) % 300}" if i % 20 else None, i % 3, START + dt.timedelta(hours=12 * batch, seconds=i), i) for i in range(120)]
        new = store.first_arrivals(spark.createDataFrame(data, "a string, b int, ts timestamp, n int"), batch, "ts", ["n"])
        expected = {}
        for a, b, _, n in data:
            if (a, b) not in seen:
                expected.setdefault((a, b), n)
        assert {(r.a, r.b): r.n for r in new.collect()} == expected
        assert new.count() == len(expected)
        seen |= expected
        filters = spark.read.parquet(f"{store.root}/filters")
        sizes.append(filters.where(F.col("batch") == batch).agg(F.sum(F.length("bitmap"))).first()[0] or 0)
    assert max(sizes) <= bits // 8 and spark.read.parquet(f"{store.root}/keys").count() == len(seen)
    again = store.first_arrivals(spark.createDataFrame(data, "a string, b int, ts timestamp, n int"), 5, "ts", ["n"])
    assert {(r.a, r.b): r.n for r in again.collect()} == expected


def test_late_rows_are_those_that_spark_drops(spark):
    root = fresh_dir(spark, "late")
    batches = [
        [(100 * b + i, None if m is None else START + dt.timedelta(minutes=m)) for i, m in enumerate(ms)]
        for b, ms in enumerate(([0, 200, 100], [140, 139, 141, 500], [439, 440, 441, 1, None]))
    ]
    split, dropped = LateSplit(spark, f"{root}/split", "ts", 3_600_000), 0
    for rows_ in batches:
        spark.createDataFrame(rows_, "id long, ts timestamp").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema("id long, ts timestamp").parquet(f"{root}/in")
        writer = stream.writeStream.foreachBatch(split.write).option("checkpointLocation", f"{root}/c1")
        writer.trigger(availableNow=True).start().awaitTermination()
        query = start_available(drop_stream_copies(stream, ["id"], "ts", "1 hour"), f"{root}/out", f"{root}/c2")
        query.awaitTermination()
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    late = {r.id: r.lag_ms for r in split.late().collect()}
    assert late == {100: 0, 101: 60_000, 200: 60_000, 201: 0, 203: 439 * 60_000}
    assert dropped == len(late) == sum(r.late for r in split.counts().collect())
    kept = {r.id for r in split.on_time().collect()}
    assert kept == {r.id for r in spark.read.parquet(f"{root}/out").collect()}
    assert kept | set(late) == {i for rows_ in batches for i, _ in rows_}
    before = (rows(split.late()), rows(split.counts()))
    split.write(spark.createDataFrame(batches[1], "id long, ts timestamp"), 1)
    assert (rows(split.late()), rows(split.counts())) == before


def test_curve_layout_serves_filters_on_any_column(spark):
    table = spark.range(40_000).select(
        F.concat(F.lit("s"), F.lpad((F.col("id") % 199).cast("string"), 3, "0")).alias("store_id"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("channel"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 1000).alias("n"),
    )

    def share(df, column, value):
        """Share of the files whose range of values holds this one, as min/max statistics tell."""
        path = fresh_dir(spark, "layout")
        stored = overwrite_table(df, path)
        assert sorted(map(tuple, stored.groupBy("store_id", "channel").count().collect())) == sorted(map(tuple, table.groupBy("store_id", "channel").count().collect()))
        files = stored.groupBy(F.col("_metadata.file_path")).agg(F.min(column).alias("low"), F.max(column).alias("high"))
        return files.where((F.col("low") <= value) & (F.col("high") >= value)).count() / files.count()

    one_after_the_other = by_keys(table, ["store_id", "channel"]).repartitionByRange(64, "store_id", "channel")
    assert share(one_after_the_other, "channel", "c3") > 0.9
    on_curve = clustered(table, ["store_id", "channel"], 64)
    assert share(on_curve, "channel", "c3") < 0.35 and share(on_curve, "store_id", "s100") < 0.35
    assert share(clustered(table, ["channel", "n", "store_id"], 64), "n", 500) < 0.5
    assert clustered(table.limit(0), ["n"], 4).count() == 0
    with pytest.raises(ValueError):
        clustered(table, [], 4)


def test_files_per_trigger(spark):
    root = fresh_dir(spark, "trigger")
    for i in range(7):
        spark.createDataFrame([(f"line {i}",)], "value string").coalesce(1).write.mode("append").text(f"{root}/landing")
    pipeline = Pipeline(spark, f"{root}/landing", root, max_files=3)
    pipeline.ingest()
    batches = pipeline.table("bronze").groupBy("ingest_ts").agg(F.count_distinct("source_file_path").alias("n")).orderBy("ingest_ts")
    assert [r.n for r in batches.collect()] == [3, 3, 1]


def test_landing_folder_and_database_by_name(spark):
    from tracelark.sources import ensure_database, source_path

    setting = "tracelark.source.path"
    spark.conf.set(setting, "/somewhere/else")
    try:
        assert source_path(spark) == source_path(spark, "/landing") == "/somewhere/else"
    finally:
        spark.conf.unset(setting)
    ensure_database(spark, "gold_tables")
    ensure_database(spark, "gold_tables")
    assert spark.catalog.databaseExists("gold_tables")
    spark.sql("DROP DATABASE gold_tables")

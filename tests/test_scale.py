"""What keeps a task, a shuffle or a stored table small."""

import datetime as dt

from pyspark.sql import functions as F

from tracelark.plans import catalogue, retail
from tracelark.plans.catalogue import all_queries
from tracelark.plans.retail import retail_lines
from tracelark.sources.documents import SECTIONS, header_rows, section_rows
from tracelark.streaming import run_available

DAY = dt.datetime(1996, 1, 2)


def orders_and_lines(spark, tmp_path, orders=50, lines=9):
    headers = [(i, i % 7, "FOP"[i % 3], 10.0 * i, DAY, "1-URGENT") for i in range(orders)]
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
    spark.createDataFrame(headers, schema).write.parquet(f"{tmp_path}/orders.parquet")
    rows = [
        (i, 3 * i + n, i + n, n, 1.0 * n, 2.5 * i, 0.1, 0.0, "RN"[n % 2], "O", DAY + dt.timedelta(days=n))
        for i in range(orders)
        for n in [*range(1, lines), 1]  # the first line comes twice
    ]
    schema = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_line_items_are_shuffled_once(spark, tmp_path):
    folder = orders_and_lines(spark, tmp_path)
    found = retail_lines(spark, folder)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(l_orderkey" in line for line in plan.splitlines()) == 1
    assert "Exchange hashpartitioning(order_key" not in plan
    texts = [r.raw_json for r in found.collect()]
    assert len(texts) == 50 + 50 * 2
    items = found.select(F.explode(F.from_json("raw_json", "items ARRAY<STRUCT<line_id: STRING>>").getField("items")))
    assert items.count() == 50 * 8


def test_queries_bound_what_a_task_reads(spark, tmp_path):
    """A MB of shuffled events is many in a task; 64 of them, Spark's own bound, are gigabytes."""
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    all_queries()["parse_headers"](spark, orders_and_lines(spark, tmp_path))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert spark.conf.get("spark.sql.parquet.compression.codec") == "zstd"


def test_landing_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    """Micro-batches cost their own; files of a thousand lines make one of a few MB."""
    spark.range(2_500).selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    root = tmp_path / "root"
    monkeypatch.setattr(catalogue, "fresh_dir", lambda spark, tag: str(root))
    assert all_queries()["raw_ingest"](spark, str(tmp_path)).count() == 2_500
    assert len(list((root / "landing").glob("part-*"))) == 1


def test_a_state_stores_its_changes(spark, tmp_path):
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    spark.range(5).selectExpr("id", "timestamp_seconds(id) AS ts").write.parquet(f"{tmp_path}/in")
    try:
        live = spark.readStream.schema("id bigint, ts timestamp").parquet(f"{tmp_path}/in")
        run_available(live.dropDuplicates(["id"]), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        assert spark.conf.get(name) == "true"
    finally:
        spark.conf.set(name, before)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_orders_without_a_customer_have_a_coupon(spark, tmp_path):
    folder = orders_and_lines(spark, tmp_path)
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("o_custkey", F.lit(None).cast("bigint"))
    orders.write.parquet(f"{tmp_path}/null/orders.parquet")
    spark.read.parquet(f"{folder}/lineitem.parquet").write.parquet(f"{tmp_path}/null/lineitem.parquet")
    tender = retail.retail_tables(spark, f"{tmp_path}/null").tender
    assert {(r.tender_type, r.card_brand) for r in tender.where("tender_id = 'P1'").collect()} == {("COUPON", None)}


def test_a_document_is_parsed_once_for_a_table(spark, tmp_path):
    texts = [
        '{"transaction_id":"T1","items":[{"line_id":"a"},{"sku":"no id"}],"tender":[]}',
        '{"transaction_id":"T2","items":[],"incidents":null}',
        '{"items":[{"line_id":"b"}]}',
        "not json",
        "",
        None,
    ]
    lines = spark.createDataFrame([(t,) for t in texts], "raw_json string")
    retail.add_ingest_columns(lines).write.parquet(f"{tmp_path}/raw")
    raw = spark.read.parquet(f"{tmp_path}/raw")
    for rows in (header_rows(raw), *[section_rows(raw, section) for section in SECTIONS]):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert sum(line.count("[from_json(") + line.count("(from_json(") for line in plan.splitlines()) == 1
    assert sorted(r.transaction_id for r in header_rows(raw).collect()) == ["T1", "T2"]
    assert header_rows(raw, keep_null_ids=True).count() == len(texts)
    assert [(r.transaction_id, r.line_id) for r in section_rows(raw, "items").collect()] == [("T1", "a")]
    kept = section_rows(raw, "items", keep_null_ids=True).collect()
    assert sorted((r.transaction_id or "", r.line_id or "") for r in kept) == [("", "b"), ("T1", ""), ("T1", "a")]
    assert not section_rows(raw, "incidents").collect() and not section_rows(raw, "tender").collect()


def test_a_log_carries_the_attributes_asked_for(spark, tmp_path):
    folder = orders_and_lines(spark, tmp_path)
    whole, some = retail.retail_log(spark, folder), retail.retail_log(spark, folder, ["line_id"])
    names = [name for name in whole.columns if name != "event_attributes"]
    line = F.col("event_attributes")["line_id"].alias("line_id")
    assert sorted(map(str, some.select(*names, line).collect())) == sorted(map(str, whole.select(*names, line).collect()))
    assert {k for r in some.collect() for k in r.event_attributes} == {"line_id"}
    stored = retail.retail_tables(spark, folder).stored(f"{tmp_path}/typed", ["line_id"])
    assert "sku" not in stored.items.columns and "record_hash" not in stored.transactions.columns

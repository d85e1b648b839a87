"""How many bytes are handled at once changes no result."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import shared
from tracelark.llm import language, neardup, pii, textops
from tracelark.llm.tables import BATCH_BYTES, document_texts


@pytest.mark.parametrize("size", [1, 100, 5_000, 2 << 20])
def test_runs_of_words_do_not_depend_on_the_chunk(monkeypatch, size):
    texts = pa.array([r[1] or "" for r in shared.document_rows()], pa.large_string())
    before = [(n, h.tolist()) for n, h in textops.shingle_rows(texts, 3)]
    monkeypatch.setattr(textops.chunks, "__defaults__", (size, True))
    assert [(n, h.tolist()) for n, h in textops.shingle_rows(texts, 3)] == before


def test_replaced_texts_keep_all_other_columns(spark):
    rows = [(i, f"write to some.body{i % 3}@example.org now, {shared.prose(i, 20)}" if i % 2 else None if i % 4 else "nothing here", "en", f"s{i}", 5) for i in range(12)]
    docs = shared.documents(spark, rows)
    found = {r.doc_id: r for r in pii.sanitised(docs).collect()}
    assert len(found) == 12 and pii.sanitised(docs).columns == docs.columns
    for i, text, lang, source, _ in rows:
        r = found[i]
        assert (r.lang, r.source, r.key, r.words) == (lang, source, "k", "w")
        if text and "@" in text:
            assert "@example.org" not in r.text and r.n_chars == len(r.text)
        else:
            assert r.text == text and r.n_chars == 5
    assert neardup.one_of_each(docs).count() <= 12


def test_texts_go_to_python_by_bytes(spark, tmp_path):
    long = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40_000).alias("text"))
    long.coalesce(1).write.parquet(f"{tmp_path}/documents")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])

    sizes = document_texts(spark.read.parquet(f"{tmp_path}/documents")).mapInArrow(run, "size bigint, n bigint").collect()
    assert sum(r.n for r in sizes) == 60 and max(r.size for r in sizes) < 2 * BATCH_BYTES


def test_the_driver_gives_memory_back_after_learning(spark, monkeypatch):
    given = []
    monkeypatch.setattr(language, "release", lambda: given.append(1))
    model = language.train(shared.documents(spark, [(i, shared.prose(i, 20), "ab"[i % 2], "s", 5) for i in range(30)]))
    assert sorted(model.labels) == ["a", "b"] and given == [1]

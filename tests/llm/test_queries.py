"""The numbered queries over the given tables: SQL counterparts, columns and types, and all rows."""

import os
import pathlib
import subprocess
import sys

import compare
import pytest

import __spark_entry__ as entry_points
from tracelark.llm.queries import QUERIES, SQL

COLUMNS = {
    "op1_license_index": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op2_disclosing_terms": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op3_benchmark_leaks": "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint, containment double",
    "op4_toxicity_pu": "doc_id bigint, held_out boolean, score double, predicted int",
    "op5_language_field": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op6_context_tree": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op7_chat_turns": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op8_fingerprint_edits": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op9_pack_mixture": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, source string",
    "op10_near_duplicates": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op11_target_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12_filter_audit": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
    "op13_simhash_balls": "doc_id bigint, fingerprint string, component_id bigint",
}


@pytest.fixture(scope="module")
def connection(folder):
    return compare.connect(folder)


def test_all_are_registered():
    assert set(COLUMNS) == set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, folder, connection, name):
    _, extra, missing = compare.differences(QUERIES[name](spark, folder), connection, SQL[name])
    assert not extra and not missing, (extra[:3], missing[:3])


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(SQL)))
def test_columns_and_rows(spark, folder, name):
    found = QUERIES[name](spark, folder)
    assert ", ".join(f"{n} {t}" for n, t in found.dtypes) == COLUMNS[name]
    ids = [r.doc_id for r in found.select("doc_id").collect()]
    every = [r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()]
    assert set(ids) == set(every) and (name == "op9_pack_mixture" or len(ids) == len(every))


def test_entry_points_do_without_the_subpackage(tmp_path):
    """A copy without it still imports and offers the other queries."""
    root = pathlib.Path(__file__).resolve().parents[2]
    for part in root.iterdir():
        if part.name not in ("tracelark", "corpus_pipeline.py", ".git", "tests"):
            (tmp_path / part.name).symlink_to(part)
    (tmp_path / "tracelark").mkdir()
    for part in (root / "tracelark").iterdir():
        if part.name != "llm":
            (tmp_path / "tracelark" / part.name).symlink_to(part)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'dfg_edges' in q and 'pipeline' not in q and not any(n.startswith('op') for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True, timeout=120)

"""The context tree's scores do not depend on how many nodes are sent to the tasks."""

import math

import pytest

from tests.llm import shared
from tests.llm.test_models import tree_by_hand
from tracelark.llm import contexttree


@pytest.mark.parametrize("nodes", [0, 300])
def test_nodes_that_are_not_sent_are_joined(spark, nodes):
    rows = [(i, shared.prose(i, 6) + (" Caf\xe9" if i % 4 else "")) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "ABC abc \x00 new"), (103, "q" * 500), (3, rows[3][1]), (None, "no id")]
    rows += [(i, f"{chr(200 + i)} unseen {i}{i}") for i in range(200, 240)]
    training = [r for r in rows if r[0] is None or not shared.crc(r[0], 10)]
    assert any(i is not None and i >= 200 and shared.crc(i, 10) for i, _ in rows)
    found = contexttree.scored(spark.createDataFrame(rows, "doc_id bigint, text string"), nodes=nodes).collect()
    assert len(found) == len(rows)
    score = tree_by_hand([t or "" for _, t in training], contexttree.DEPTH)
    by_id = {r.doc_id: r.score for r in found}
    for doc_id, text in rows:
        assert math.isclose(by_id[doc_id], score(text or ""), rel_tol=1e-5)

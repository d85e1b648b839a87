"""Terms that give an entity away are found and removed in the whole document."""

import math

from tests.llm import shared
from tracelark.llm import pii


def test_terms_far_from_their_entity(spark):
    rows = [(i, shared.prose(i, 30)) for i in range(100)]
    for i in range(100, 120):  # near the address in two documents only, in all of them somewhere else
        near = "Timbuktu" if i < 102 else "office"
        rows.append((i, f"\xe9 {near} boss@corp.example {shared.prose(i, 40)} Timbuktu.\n\n{shared.prose(i + 900, 40)} timbuktu"))
    rows.append((200, "Timbuktu alone"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    annotated = pii.annotated(docs).cache()
    found = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, annotated).collect()}
    pair = pii._entity("email", "boss@corp.example"), int(pii._term_hashes(["timbuktu"])[0])
    assert math.isclose(found[pair], math.log(20 * len(rows) / (20 * 21)) / math.log(len(rows) / 20), rel_tol=1e-9)
    spans = {r.doc_id: r.spans for r in pii.spans_of(docs, remove_at=0.8).collect()}
    texts = dict(rows)
    for i in range(100, 120):
        at = [k for k in range(len(texts[i])) if texts[i][k:].lower().startswith("timbuktu")]
        assert len(at) >= 2 and all(f"remove:{k}:{k + 8}" in spans[i].split(",") for k in at)
    clean = {r.doc_id: r.text for r in pii.sanitised(docs, remove_at=0.8).collect()}
    assert not any("timbuktu" in clean[i].lower() for i in range(100, 120)) and clean[200] == "Timbuktu alone"

"""Secrets found by their information content, and terms that give away a kind of entity whose values occur once."""

import hashlib
import math

from tests.llm import shared
from tracelark.llm import pii


def secret(i: int) -> str:
    return hashlib.sha1(str(i).encode()).hexdigest()


def table(spark):
    rows = [(i, shared.prose(i, 30) + " authentication and authorisation: authentication2authorisation") for i in range(300)]
    rows += [(i, f"{shared.prose(i, 30)} passphrase = {secret(i)} {shared.prose(i + 900, 30)}") for i in range(300, 330)]
    rows += [(i, f"{shared.prose(i, 20)} write to u{i}@mail.example {shared.prose(i + 900, 20)}") for i in range(330, 360)]
    rows += [(400 + i, rows[310][1]) for i in range(300)]  # one secret, copied often
    rows += [(900, None), (901, ""), (902, "a" * 40 + " " + "1" * 40), (903, "passphrase")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string")


def test_secrets_and_kinds(spark):
    rows, docs = table(spark)
    found = {r.doc_id: r for r in pii.spans_of(docs).collect()}
    for i, text in rows:
        held = 300 <= i < 330 or 400 <= i < 700
        assert found[i].n_secret == held, i
        spans = found[i].spans.split(",")
        if held:
            at = text.index("passphrase")
            assert f"secret:{at + 13}:{at + 53}" in spans
            assert f"remove:{at}:{at + 10}" in spans and found[i].n_added == len(spans)
        elif not 330 <= i < 360:
            assert found[i].spans == "" and found[i].n_added == 0
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert "[REMOVED] = [SECRET]" in clean[305] and clean[903] == "passphrase" and clean[5] == rows[5][1]


def test_kinds_by_brute_force(spark):
    rows, docs = table(spark)
    annotated = pii.annotated(docs).cache()
    found = {(r.kind, r.term): r.disclosure for r in pii.kind_disclosures(docs, annotated).collect()}
    near, n_kind, n_term = {}, {}, {}
    bits = pii.letter_bits(docs)
    for _, text in rows:
        spans = {**pii.base_spans(text or ""), "secret": pii.secret_spans(text or "", bits)}
        taken = [x for own in spans.values() for x in own]
        for word in set(shared.alnum_words(text)):
            n_term[word] = n_term.get(word, 0) + 1
        for kind, own in spans.items():
            n_kind[kind] = n_kind.get(kind, 0) + bool(own)
            for word in {w for s, e in own for _, _, w in pii._near(text, s, e, taken)}:
                near[kind, word] = near.get((kind, word), 0) + 1
    expected = {}
    for (kind, word), both in near.items():
        if both >= pii.KIND_SUPPORT:
            pmi = math.log(both * len(rows) / (n_kind[kind] * n_term[word]))
            expected[pii.ENTITIES.index(kind), int(pii._term_hashes([word])[0])] = pmi / math.log(len(rows) / n_kind[kind])
    assert set(found) == set(expected) and len(found) >= 3
    assert all(math.isclose(found[k], expected[k], rel_tol=1e-9) for k in found)


def test_bits_by_brute_force(spark):
    rows = [(1, "aa1 Ab"), (2, None), (3, "b" * 30 + " ab\xe9b1")]
    bits = pii.letter_bits(spark.createDataFrame(rows, "doc_id bigint, text string"))
    pairs = ["aa", "a1", "ab", "ab", "b1"]
    for a in "ab1z":
        for b in "ab19":
            of_a = sum(p[0] == a for p in pairs)
            assert math.isclose(bits[ord(a), ord(b)], -math.log2((pairs.count(a + b) + 0.5) / (of_a + 18)), rel_tol=1e-9)

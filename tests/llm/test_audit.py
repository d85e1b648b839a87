"""The filter audit against applying the filters one after the other."""

import re
from itertools import permutations

from tests.llm import shared
from tracelark.llm import audit

LABELS = "doc_id bigint, quality int, toxic int, n int"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(rows):
    """For each (doc_id, text, source): the letters of the filters it fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        tests = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        }
        out.append({f for f, failed in tests.items() if failed})
    return out


def expected(rows, labels):
    good, toxic = ({r[0] for r in labels if r[k] == 1 and r[0] is not None} for k in (1, 2))
    failures, out = fails(rows), {}
    for part in {s or "" for _, _, s in rows}:
        here = [(i, f) for (i, _, s), f in zip(rows, failures) if (s or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(here)
            for step, own in enumerate(order, 1):
                lost = [r for r in left if own in r[1]]
                left = [r for r in left if own not in r[1]]
                out[part, order, step] = [
                    len(left),
                    len(lost),
                    sum(own in f for _, f in here) - len(lost),
                    sum(f == {own} for _, f in here),
                    sum(i in good for i, _ in lost),
                    sum(i in toxic for i, _ in lost),
                ]
        for own in "ABCDE":
            total = sum(v[1] for (p, o, s), v in out.items() if p == part and o[s - 1] == own)
            for key, value in out.items():
                if key[0] == part and key[1][key[2] - 1] == own:
                    value.append(total)
    return sorted((*k, *v) for k, v in out.items())


def check(spark, docs, rows, labels):
    found = audit.filter_audit(docs, spark.createDataFrame([(*r, 3) for r in labels], LABELS))
    assert found.columns == COLUMNS
    assert dict(found.dtypes) == {"part": "string", "filter_order": "string", "step": "int", **{c: "bigint" for c in COLUMNS[3:]}}
    assert sorted(map(tuple, found.collect())) == expected(rows, labels)


def test_awkward_rows(spark):
    rows = [(r[0], r[1], r[3]) for r in shared.document_rows()]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (9, 1, 1), (10, 1, 1), (15, 1, 0), (None, 1, 1), (999, 1, 1)]
    check(spark, shared.documents(spark), rows, labels)


def test_every_set_of_failures(spark):
    long = " ".join(f"w{i}" for i in range(210))
    rows, doc_id = [], 0
    for mask in range(16):
        text = "few words" if mask & 1 else long
        text = (text + " ") * 3 if mask & 2 else text
        text += " " + "ABCDEFGH" * 40 if mask & 4 else ""
        text += " #" if mask & 8 else ""
        for _ in range(mask % 3 + 1):
            rows.append((doc_id, text, f"s{doc_id % 3}" if doc_id % 5 else None))
            doc_id += 1
    assert len({frozenset(f) for f in fails(rows)}) > 16
    check(spark, spark.createDataFrame(rows, "doc_id bigint, text string, source string"), rows, [(i, i % 2, i % 3) for i in range(0, doc_id, 2)])


def test_potentials_are_those_of_the_orders(spark):
    """Three filters and any counts: shapley adds up the marginal removals over all orders."""
    counts = spark.createDataFrame([("p", m, 7 * m + 1, m, 1) for m in range(8)], "part string, mask int, n long, good long, toxic long")
    rows = audit.interactions(counts, "XYZ").collect()
    assert len(rows) == 18
    for own in "XYZ":
        mine = [r for r in rows if r.filter_order[r.step - 1] == own]
        assert {r.shapley for r in mine} == {sum(r.removed for r in mine)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], LABELS)
    assert audit.filter_audit(docs, labels).collect() == []
    rows = [(1, "a", None), (1, "a", None), (2, "a", "")]
    check(spark, spark.createDataFrame(rows, docs.schema), rows, [])

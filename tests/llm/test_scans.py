"""Personal data, licences and chat texts against plain Python."""

import hashlib
import math
import re

import pytest

from tests.llm import shared
from tracelark.llm import chat, licenses, pii


def luhn(digits: str) -> bool:
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain_spans(text: str) -> str:
    found = [("email", m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        ("ip", m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))
    ]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.span()))
    found += [("phone", m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return ",".join(f"{k}:{s}:{e}" for k, (s, e) in found)


PRIVATE = [
    "write to a.b+c@mail.example.com, or x@y now",
    "@a.b c@d@e.f g@h.i..j k@-.l- %@x.y.z.",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.00004 1.2.3 9.9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111 5 4111  1111",
    "+1 (555) 010-9999, +12, +49.30.1234567 +(1) + 1 2",
    "١٢ +1 234 567 890٣ caf\xe9@caf\xe9.fr \U0001f600 a@b.co",
    "",
    "7" * 5000 + "." + "8" * 5000,
    "a" * 20000 + "@",
    "a@" * 3000 + "b.c",
]


@pytest.mark.parametrize("text", PRIVATE)
def test_base_spans(text):
    spans = pii.base_spans(text)
    assert ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in spans[k]) == plain_spans(text)


def private_rows():
    rows = [(i, t) for i, t in enumerate(PRIVATE)] + [(50, None), (None, "no id a@b.de"), (51, "twice a@b.de"), (51, "twice a@b.de")]
    # one address with a tell-tale neighbour, and common words around it
    for i in range(100, 120):
        rows.append((i, f"{shared.prose(i, 30)} the Zanzibar office mails boss@corp.example about {shared.prose(i + 500, 30)}"))
    for i in range(200, 260):
        rows.append((i, f"the office about {shared.prose(i, 20)} mails"))
    rows.append((300, "Zanzibar is an island"))
    return rows


def test_disclosure_is_that_of_plain_counts(spark):
    rows = private_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    annotated = pii.annotated(docs)
    found = {(r.entity, r.term): r.disclosure for r in pii.disclosures(docs, annotated.cache()).collect()}
    entity = pii._entity("email", "BOSS@corp.example")
    for term in ("zanzibar", "office"):
        number = int(pii._term_hashes([term])[0])
        with_term = sum(term in shared.alnum_words(t) for _, t in rows)
        pmi, ic = math.log(20 * len(rows) / (20 * with_term)), math.log(len(rows) / 20)
        assert math.isclose(found[entity, number], pmi / ic, rel_tol=1e-9)


def test_spans_and_rewritten_texts(spark):
    rows = private_rows()
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id bigint, text string, near bigint, gone int")
    found = pii.spans_of(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        texts = [t or "" for i, t in rows if i == r.doc_id]
        base = plain_spans(texts[0])
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.spans.startswith(base)
        extra = r.spans[len(base) :].strip(",")
        if 100 <= (r.doc_id or 0) < 120:
            at = texts[0].index("Zanzibar")
            assert f"remove:{at}:{at + 8}" in extra
        elif not base:
            assert not extra  # clean texts are left alone
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect() if r.doc_id is not None}
    assert "[EMAIL]" in clean[100] and "Zanzibar" not in clean[100] and clean[300] == "Zanzibar is an island" and clean[50] is None
    assert pii.sanitised(docs).columns == docs.columns
    none = docs.limit(0)
    assert pii.spans_of(none).collect() == [] and pii.sanitised(none).collect() == []


def test_awkward_rows(spark):
    docs = shared.documents(spark)
    kept = pii.sanitised(docs)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_blocks_of_terms_change_nothing(spark, monkeypatch):
    docs = spark.createDataFrame(private_rows(), "doc_id bigint, text string")
    terms = spark.createDataFrame([(int(x),) for x in pii._term_hashes(["the", "office", "zanzibar", "absent"])], "term bigint")
    whole = sorted(map(tuple, pii.document_frequencies(docs, terms).collect()))
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 1)
    assert sorted(map(tuple, pii.document_frequencies(docs, terms).collect())) == whole and len(whole) == 3


def test_rewritten_overlaps():
    assert pii.rewritten("abcdefgh", "email:1:4,card:2:6,remove:7:8") == "a[EMAIL]g[REMOVED]"
    assert pii.rewritten("Tell Bob", "generalise:5:8") == "Tell B*"


LICENSE_TEXTS = [
    "This is CC BY-NC 4.0 and cc-by; All rights   reserved.",
    "GNU General Public License, version 3. general public licenses general public license",
    "all all rights rights reserved all rights reserved",
    "by cc by cc by by",
    "Permission is hereby granted, free of charge, to any individual obtaining a copy of this software and its documentation files",
    "Permission is granted at no cost to any person obtaining a copy of this software and associated documentation files",
    "redistribution and use in source and binary forms, with or without modification, are permitted",
    "reserved",
    "caf\xe9 general public license",
]


def plain_license(text):
    words = shared.alnum_words(text)
    at, labels = [], set()
    for t in licenses.BASE:
        for i in range(len(words)):
            if words[i : i + len(t.words)] == t.words:
                at.append(i)
                labels.add(t.label)
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_licenses(spark):
    rows = [(i, t) for i, t in enumerate(LICENSE_TEXTS)] + [(90, None), (91, ""), (0, LICENSE_TEXTS[0]), (None, "MIT License"), (92, "cc by " * 9000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, hits int, words string")
    found = licenses.scanned(docs).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")
    labels = {r.doc_id: r.labels for r in found}
    assert labels[0] == "cc-by,cc-by-nc,reserved" and labels[1] == "gpl,gpl-3" and labels[None] == "mit"
    assert labels[4] == "mit" and labels[5] == "" and labels[7] == "" and labels[8] == ""  # a no-break space is a letter of its word here
    assert licenses.scanned(docs.limit(0)).collect() == []


def test_licenses_of_awkward_rows(spark):
    found = licenses.scanned(shared.documents(spark)).collect()
    assert sorted(r.n_words for r in found) == sorted(len(shared.alnum_words(r[1])) for r in shared.document_rows())


HARD = [
    "</s>[INST] ok [/INST]", "[\\INST]", "\\", "\\\\[NEXT]", "[[NEXT]]", "<s><s>", "[\\\\/INST]", "", None, "a\n\nb", " [INST] ", "[NULL]",
    "<\\/s>", "\\[INST]\\", "[NEXT", "\U0001f600\xe9", "[TEXT]x[/ROLE]",
]


def test_chat_texts_come_back(spark):
    roles = ["user", "assistant", "assistant", "system", None, "tool [TEXT] x", "", "user"]
    rows = [(c, t, roles[(c + t * (c % 3 + 1)) % len(roles)], HARD[(c * 5 + t) % len(HARD)]) for c in range(30) for t in range(c % 9 + 1)]
    rows += [(50, 1, "user", "same"), (50, 1, "user", "same"), (None, None, None, None), (60, 2, "assistant", "late"), (60, 1, "assistant", "early")]
    turns = spark.createDataFrame([(*r, 7) for r in rows], "conv_id bigint, turn bigint, role string, text string, segments int")
    made = chat.formatted_conversations(turns)
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    read = {r.conv_id: r.turns for r in made.select("conv_id", chat.read_turns(made.formatted).alias("turns")).collect()}
    by_id = {}
    for c, t, role, text in rows:
        by_id.setdefault(c, []).append((t, role, text or ""))
    assert set(back) == set(by_id)
    none_first = lambda x: tuple((v is not None, v if v is not None else "") for v in x)
    for c, own in by_id.items():
        own.sort(key=none_first)
        assert [(r.role, r.text) for r in read[c]] == [(role, text) for _, role, text in own]
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = back[c]
        assert r.n_turns == len(own) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        line = "".join(f"{role or ''}\n{text}\n" for _, role, text in own)
        assert r.turns_sha256 == hashlib.sha256(line.encode()).hexdigest()
    shown = {r.conv_id: r.formatted for r in made.collect()}
    assert shown[50] == "<s>[INST] same[NEXT]same [/INST]" and shown[60] == "<s>early[NEXT]late</s>"
    assert chat.read_back(chat.formatted_conversations(turns.limit(0))).collect() == []

"""Personal data: fixed patterns, and terms of their surroundings that would give them away.

Patterns find e-mail and IP addresses, card and phone numbers.  Every one found
is a protected entity, whose text may be replaced; but words that keep standing
next to it still tell who is meant.  Corpus counts say how strongly: with N
documents, n(e) of them with entity e, n(t) with term t and n(e,t) with both,

    disclosure(t, e) = PMI(t, e) / IC(e) = log(n(e,t) N / (n(e) n(t))) / log(N / n(e)),

which is 1 if the term occurs in documents of the entity only.  Pairs are those
that stand near each other at least once.  Wherever a document of the entity
holds the term, it is removed above one threshold and generalised above a lower
one.  A document without the entity keeps the term.  Counts are of document rows
and over all of them.

Secrets (keys, tokens, passwords made by machines) have no pattern.  They are
entities found by their information content: long runs of ASCII letters and
digits for which a model of the corpus' own letter pairs needs as many bits a
character as for random ones.  The model learns from shorter words only, so
no secret, however often it is copied, explains itself.

Most entities occur once, which leaves nothing to count for a single value.  So
every kind of entity is protected as well: n(e,t) is then the number of
documents in which the term stands near an entity of the kind, and n(e) that of
documents with one.  Such terms are removed or generalised where they stand near
an entity of their kind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .contexttree import _gathered
from .tables import BROADCAST_ROWS, TEXT_HASH, document_texts, narrow, text_hash, written
from .textops import NOT_ALNUM, chunks, text_array, tidy, word_hashes, word_spans

KINDS = ("email", "ip", "card", "phone")
#: Kinds of entities: those of the patterns, and secrets.
ENTITIES = (*KINDS, "secret")
#: Letters and digits that a secret has at least, and bits a character: more than an even choice among 16 digits takes, so that a
#: few rare pairs in an ordinary compound do not suffice.
SECRET_CHARS = 20
SECRET_BITS = 4.5
#: Words looked at on either side of an entity, and the characters they must lie in.
CONTEXT_WORDS = 6
CONTEXT_CHARS = 120
MIN_TERM_CHARS = 3
REMOVE_AT = 0.9
GENERALISE_AT = 0.6
#: Documents that must hold both a term and an entity before their counts say anything.
MIN_SUPPORT = 3
#: The same for a term and a kind; larger, as a kind has many documents and a rare word may be among them by chance.
KIND_SUPPORT = 20

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile("[0-9]")
# a run of digits is tried once, from its first digit: a later start in it would fail the same way
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_RUN = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z0-9]{{{SECRET_CHARS},}}+")
_NOT_RUN = np.ones(256, bool)
_NOT_RUN[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = False


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards so that long runs cost no more than their length."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
            last = match.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans by kind, in code points with the end left out."""
    out: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    if "@" in text:
        out["email"] = _emails(text)
    if _DIGIT.search(text):
        # a part of more than three digits may still be small: 0255
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out["card"].append(m.span())
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                    out["phone"].append(m.span())
    return out


def _entity(kind: str, value: str) -> int:
    """A number for what the span names, whatever its spelling."""
    plain = value.lower() if kind in ("email", "ip") else value if kind == "secret" else "".join(c for c in value if "0" <= c <= "9")
    return int.from_bytes(hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=8).digest(), "little", signed=True)


def letter_bits(docs: DataFrame) -> np.ndarray:
    """[byte, next byte] bits of each pair of lower-case ASCII letters and digits, from all words too short for secrets."""

    def run(batches):
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(text_array(batch)):
                start, end, _ = word_spans(data, offsets, _NOT_RUN)
                inside = np.zeros(len(data) + 1, np.int32)
                short = end - start < SECRET_CHARS
                inside[start[short]] = 1
                inside[end[short] - 1] -= 1  # the last byte of a word begins no pair
                first = np.flatnonzero(np.cumsum(inside[:-1]))
                counts += np.bincount(data[first].astype(np.int64) << 8 | data[first + 1], minlength=1 << 16)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["pair", "n"])

    counted = document_texts(docs).select("text").mapInArrow(tidy(run), "pair bigint, n bigint")
    counts = np.zeros(1 << 16)
    for r in counted.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most 36 * 36 rows
        counts[r.pair] = r.n
    counts = counts.reshape(256, 256) + 0.5
    kept = ~_NOT_RUN
    kept[ord("A") : ord("Z") + 1] = False
    return np.log2(counts[:, kept].sum(1))[:, None] - np.log2(counts)


def secret_spans(text: str, bits: np.ndarray) -> list[tuple[int, int]]:
    """Runs with letters and digits that take at least ``SECRET_BITS`` a character."""
    found = []
    for m in _RUN.finditer(text):
        run = m.group().lower()
        if run.isalpha() or run.isdigit():
            continue
        codes = np.frombuffer(run.encode(), np.uint8)
        if bits[codes[:-1], codes[1:]].mean() >= SECRET_BITS:
            found.append(m.span())
    return found


def _near(text: str, start: int, end: int, taken: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Words near a span that are in no span themselves."""
    low = max(0, start - CONTEXT_CHARS)
    before = list(_WORD.finditer(text, low, start))
    if before and low and before[0].start() == low and _WORD.match(text[low - 1]):
        before = before[1:]  # cut through
    after = list(_WORD.finditer(text, end, min(len(text), end + CONTEXT_CHARS)))
    if after and after[-1].end() < len(text) and after[-1].end() == end + CONTEXT_CHARS:
        after = after[:-1]
    out = []
    for m in before[-CONTEXT_WORDS:] + after[:CONTEXT_WORDS]:
        if len(m.group()) >= MIN_TERM_CHARS and not any(s < m.end() and m.start() < e for s, e in taken):
            out.append((m.start(), m.end(), m.group().translate(_LOWER)))
    return out


def _term_hashes(terms: list[str]) -> np.ndarray:
    """As textops hashes the same words inside texts."""
    raw = [t.encode() for t in terms]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return word_hashes(data, ends - np.array([len(r) for r in raw]), ends).view(np.int64)


_NEAR = "array<struct<kind:int,entity:bigint,term:bigint,start:int,end:int>>"


def annotated(docs: DataFrame) -> DataFrame:
    """Each document row's key, counts by kind, digest of the base spans, spans of all entities as text, terms near them, and the entities.

    ``near.kind`` is a place in ``ENTITIES``.  A secret that overlaps a base span is part of it and not counted.
    Rows with an entity have their text as well, so that what follows need not read all documents.
    """
    bits = letter_bits(docs)
    near_type = pa.list_(
        pa.struct([("kind", pa.int32()), ("entity", pa.int64()), ("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
    )
    names = ["doc_id", TEXT_HASH, *[f"n_{k}" for k in ENTITIES], "base_sha256", "base_spans", "near", "entities", "text"]

    def run(batches):
        for batch in batches:
            texts = text_array(batch)
            for first, stop, data, offsets in chunks(texts, lower=False):
                counts, digests, shown, nears, entities, kept = [[] for _ in ENTITIES], [], [], [], [], []
                terms: list[str] = []
                start, end, _ = word_spans(data, offsets, _NOT_RUN)
                long = np.zeros(stop - first, bool)
                long[np.searchsorted(offsets, start[end - start >= SECRET_CHARS], "right") - 1] = True
                for text, runs in zip(texts.slice(first, stop - first).to_pylist(), long):
                    spans = base_spans(text)
                    line = ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in spans[k])
                    digests.append(hashlib.sha256(line.encode()).hexdigest())
                    taken = [x for k in KINDS for x in spans[k]]
                    secrets = secret_spans(text, bits) if runs else []
                    spans["secret"] = [(s, e) for s, e in secrets if not any(a < e and s < b for a, b in taken)]
                    taken += spans["secret"]
                    for column, kind in zip(counts, ENTITIES):
                        column.append(len(spans[kind]))
                    shown.append(",".join(f"{k}:{s}:{e}" for k in ENTITIES for s, e in spans[k]))
                    near, own = [], set()
                    for number, kind in enumerate(ENTITIES):
                        for s, e in spans[kind]:
                            entity = _entity(kind, text[s:e])
                            own.add(entity)
                            for a, b, term in _near(text, s, e, taken):
                                near.append({"kind": number, "entity": entity, "term": len(terms), "start": a, "end": b})
                                terms.append(term)
                    nears.append(near)
                    entities.append(sorted(own))
                    kept.append(text if own else None)
                if terms:
                    hashes = _term_hashes(terms).tolist()
                    for near in nears:
                        for x in near:
                            x["term"] = hashes[x["term"]]
                count = stop - first
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, count), batch.column(1).slice(first, count)]
                    + [pa.array(c, pa.int64()) for c in counts]
                    + [pa.array(digests, pa.string()), pa.array(shown, pa.string()), pa.array(nears, near_type)]
                    + [pa.array(entities, pa.list_(pa.int64())), pa.array(kept, pa.string())],
                    names=names,
                )

    plain = document_texts(docs).select("doc_id", text_hash().alias(TEXT_HASH), "text")
    numbers = ", ".join(f"n_{k} bigint" for k in ENTITIES)
    return plain.mapInArrow(tidy(run), f"doc_id bigint, {TEXT_HASH} bigint, {numbers}, base_sha256 string, base_spans string, near {_NEAR}, entities array<bigint>, text string")


def document_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_term): rows of ``docs`` with each of the hashed ``terms``; they are sent out in blocks of bounded size."""
    spark = docs.sparkSession
    total = terms.count()
    blocks = max(1, -(-total // BROADCAST_ROWS))
    result = None
    for block in range(blocks):
        part = terms.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(np.unique(np.array([r.term for r in part.collect()], np.int64)))

        def run(batches, sent=sent):
            wanted = sent.value
            seen = np.zeros(1 << 20, bool)
            seen[wanted.view(np.uint64) >> np.uint64(44)] = True
            counts = np.zeros(len(wanted), np.int64)
            for batch in batches:
                for _, _, data, offsets in chunks(text_array(batch)):
                    start, end, bounds = word_spans(data, offsets, NOT_ALNUM)
                    hashes = word_hashes(data, start, end)
                    at = np.flatnonzero(seen[hashes >> np.uint64(44)])
                    if not len(at) or not len(wanted):
                        continue
                    value = hashes[at].view(np.int64)
                    place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
                    hit = wanted[place] == value
                    row = np.searchsorted(bounds, at[hit], "right") - 1
                    once = np.unique(row * len(wanted) + place[hit]) % len(wanted)
                    counts += np.bincount(once, minlength=len(wanted))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[some]), pa.array(counts[some])], names=["term", "n"])

        counted = document_texts(docs).select("text").mapInArrow(tidy(run), "term bigint, n bigint")
        result = counted if result is None else result.unionByName(counted)
    return result.groupBy("term").agg(F.sum("n").alias("n_term"))


def _pair_blocks(pairs: DataFrame, *more: str):
    """Broadcast arrays of entities and their terms in order (and other columns), in blocks of bounded size."""
    spark = pairs.sparkSession
    blocks = max(1, -(-pairs.count() // BROADCAST_ROWS))
    for block in range(blocks):
        part = pairs.where(F.pmod(F.xxhash64("entity", "term"), F.lit(blocks)) == block)
        arrays = _gathered(part, {"entity": np.int64, "term": np.int64, **{m: np.int64 for m in more}})
        order = np.lexsort((arrays[1], arrays[0]))
        yield spark.sparkContext.broadcast([a[order] for a in arrays])


def _meetings(batch: pa.RecordBatch, entity: np.ndarray, term: np.ndarray):
    """(row, bytes, offset of the row, starts and ends of words, their hashes, places in ``entity`` and ``term`` of the pairs the row holds)."""
    owned = batch.column(batch.schema.get_field_index("entities"))
    for first, stop, data, offsets in chunks(text_array(batch)):
        start, end, bounds = word_spans(data, offsets, NOT_ALNUM)
        hashes = word_hashes(data, start, end).view(np.int64)
        for row in range(first, stop):
            a, b = bounds[row - first], bounds[row - first + 1]
            held, places = None, []
            for e in owned[row].as_py():
                low, high = np.searchsorted(entity, e, "left"), np.searchsorted(entity, e, "right")
                if low == high:
                    continue
                held = np.unique(hashes[a:b]) if held is None else held
                if high - low > len(held):
                    at = np.searchsorted(term[low:high], held)
                    at = at[(at < high - low) & (term[low + np.minimum(at, high - low - 1)] == held)]
                else:
                    at = np.searchsorted(held, term[low:high])
                    at = np.flatnonzero((at < len(held)) & (held[np.minimum(at, len(held) - 1)] == term[low:high])) if len(held) else at[:0]
                places.append(low + at)
            if places:
                yield row, data, offsets[row - first], start[a:b], end[a:b], hashes[a:b], np.concatenate(places)


def together(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(entity, term, n_both): annotated rows that hold both, anywhere in the text."""
    result = None
    for sent in _pair_blocks(pairs):

        def run(batches, sent=sent):
            entity, term = sent.value
            counts = np.zeros(len(entity), np.int64)
            for batch in batches:
                for *_, places in _meetings(batch, entity, term):
                    counts[places] += 1
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(entity[some]), pa.array(term[some]), pa.array(counts[some])], names=["entity", "term", "n"]
            )

        held = rows.where(F.size("entities") > 0).select("entities", "text")
        counted = held.mapInArrow(tidy(run), "entity bigint, term bigint, n bigint")
        result = counted if result is None else result.unionByName(counted)
    return result.groupBy("entity", "term").agg(F.sum("n").alias("n_both"))


def everywhere(rows: DataFrame, told: DataFrame) -> DataFrame:
    """(doc_id, text hash, start, end, gone): every place of a told term in the annotated rows that hold its entity."""
    flags = told.withColumn("gone", F.col("gone").cast("bigint"))
    result = None
    for sent in _pair_blocks(flags, "gone"):

        def run(batches, sent=sent):
            entity, term, gone = sent.value
            for batch in batches:
                out: list[list] = [[], [], [], []]
                bases = batch.column(batch.schema.get_field_index("base_spans"))
                for row, data, offset, start, end, hashes, places in _meetings(batch, entity, term):
                    if not len(places):
                        continue
                    taken = np.array([x.split(":")[1:] for x in bases[row].as_py().split(",")], np.int64)
                    for flag in (0, 1):
                        at = np.flatnonzero(np.isin(hashes, term[places[gone[places] == flag]]))
                        if not len(at):
                            continue
                        # code points: bytes that continue no letter
                        points = np.concatenate([[0], np.cumsum((data[offset : end[at[-1]]] & 0xC0) != 0x80)])
                        a, b = points[start[at] - offset], points[end[at] - offset]
                        free = ~((taken[:, 0] < b[:, None]) & (a[:, None] < taken[:, 1])).any(1)
                        for column, values in zip(out, (np.full(free.sum(), row), a[free], b[free], np.full(free.sum(), flag == 1))):
                            column.extend(values.tolist())
                at = pa.array(out[0], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at)]
                    + [pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.bool_())],
                    names=["doc_id", TEXT_HASH, "start", "end", "gone"],
                )

        held = rows.where(F.size("entities") > 0).select("doc_id", TEXT_HASH, "entities", "base_spans", "text")
        found = held.mapInArrow(tidy(run), f"doc_id bigint, {TEXT_HASH} bigint, start int, end int, gone boolean")
        result = found if result is None else result.unionByName(found)
    return result


def disclosures(docs: DataFrame, rows: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(entity, term, disclosure) of all pairs with enough support that stand near each other somewhere, from the annotated rows."""
    total = rows.count()
    entities = rows.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    entities = written(entities.where(F.col("n_entity") >= min_support), "entities")
    near = rows.select(F.explode("near").alias("x")).select("x.entity", "x.term").distinct()
    candidates = written(near.join(entities, "entity").select("entity", "term"), "candidates")
    pairs = written(together(rows, candidates).where(F.col("n_both") >= min_support), "pairs")
    terms = written(pairs.select("term").distinct(), "terms")
    frequencies = document_frequencies(docs, terms)
    counted = pairs.join(entities, "entity").join(frequencies, "term")
    information = F.log(F.lit(float(total)) / F.col("n_entity"))
    pmi = F.log(F.col("n_both") * float(total) / (F.col("n_entity").cast("double") * F.col("n_term")))
    return counted.where(information > 0).select("entity", "term", (pmi / information).alias("disclosure"))


def kind_disclosures(docs: DataFrame, rows: DataFrame, support: int = KIND_SUPPORT) -> DataFrame:
    """(kind, term, disclosure) of terms near entities of a kind in enough of the annotated rows; ``kind`` is a place in ``ENTITIES``."""
    kept = rows.agg(F.count("*").alias("rows"), *[F.count(F.when(F.col(f"n_{k}") > 0, 1)).alias(k) for k in ENTITIES]).first()
    once = F.array_distinct(F.transform("near", lambda x: F.struct(x["kind"].alias("kind"), x["term"].alias("term"))))
    met = rows.where(F.size("near") > 0).select(F.explode(once).alias("x")).groupBy("x.kind", "x.term").agg(F.count("*").alias("n_both"))
    met = written(met.where(F.col("n_both") >= support), "kind_terms")
    counted = met.join(document_frequencies(docs, met.select("term").distinct()), "term")
    n_kind = F.element_at(F.array(*[F.lit(float(kept[k])) for k in ENTITIES]), F.col("kind") + 1)
    information = F.log(F.lit(float(kept.rows)) / n_kind)
    pmi = F.log(F.col("n_both") * float(kept.rows) / (n_kind * F.col("n_term")))
    return counted.where(information > 0).select("kind", "term", (pmi / information).alias("disclosure"))


def spans_of(
    docs: DataFrame,
    remove_at: float = REMOVE_AT,
    generalise_at: float = GENERALISE_AT,
    min_support: int = MIN_SUPPORT,
    kind_support: int = KIND_SUPPORT,
) -> DataFrame:
    """doc_id, text hash, counts by kind, base_sha256, n_added and spans ("kind:start:end", comma-joined) of every document row.

    Kinds: email, ip, card, phone, then secret, then generalise and remove for
    terms; ``n_added`` counts those after phone.  A text without any of them (null
    and empty ones too) has an empty string.  Repeated rows have equal results; no
    rows give none.
    """
    rows = written(annotated(docs), "annotated")
    told = disclosures(docs, rows, min_support).where(F.col("disclosure") >= generalise_at)
    told = written(told.select("entity", "term", (F.col("disclosure") >= remove_at).alias("gone")), "disclosures")
    near = rows.where(F.size("near") > 0).select("doc_id", TEXT_HASH, F.explode("near").alias("x")).select("doc_id", TEXT_HASH, "x.*")
    places = near.join(told, ["entity", "term"]).select("doc_id", TEXT_HASH, "start", "end", "gone")
    kinds = kind_disclosures(docs, rows, kind_support).where(F.col("disclosure") >= generalise_at)
    kinds = narrow(written(kinds.select("kind", "term", (F.col("disclosure") >= remove_at).alias("gone")), "kinds"))
    places = places.unionByName(near.join(kinds, ["kind", "term"]).select("doc_id", TEXT_HASH, "start", "end", "gone"))
    flagged = places.unionByName(everywhere(rows, told)).groupBy("doc_id", TEXT_HASH, "start", "end").agg(F.max("gone").alias("gone"))
    flagged = flagged.withColumn("kind", F.when(F.col("gone"), "remove").otherwise("generalise"))
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end"))), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    )
    more = written(flagged.groupBy("doc_id", TEXT_HASH).agg(F.array_join(ordered, ",").alias("more"), F.count("*").alias("n_more")), "spans")
    other = more.select(F.col("doc_id").alias("__id"), F.col(TEXT_HASH).alias("__hash"), "more", "n_more")
    joined = rows.drop("near", "entities", "text").join(
        narrow(other), rows.doc_id.eqNullSafe(F.col("__id")) & (rows[TEXT_HASH] == F.col("__hash")), "left"
    )
    base = F.when(F.col("base_spans") != "", F.col("base_spans"))
    return joined.select(
        "doc_id",
        TEXT_HASH,
        *[f"n_{k}" for k in ENTITIES],
        "base_sha256",
        (F.col("n_secret") + F.coalesce("n_more", F.lit(0))).alias("n_added"),
        F.concat_ws(",", base, "more").alias("spans"),
    )


def rewritten(text: str, spans: str) -> str:
    """The text with base spans named, terms removed, or generalised to their first letter.

    Of overlapping spans the one that starts first (then the longer) counts, up to the end of the other.
    """
    out, last = [], 0
    parts = [x.split(":") for x in spans.split(",")]
    for start, end, kind in sorted((int(s), -int(e), k) for k, s, e in parts):
        end = -end
        if start < last:
            last = max(last, end)
            continue
        out.append(text[last:start])
        out.append({"remove": "[REMOVED]", "generalise": text[start] + "*"}.get(kind, f"[{kind.upper()}]"))
        last = end
    out.append(text[last:])
    return "".join(out)


def sanitised(docs: DataFrame, **thresholds) -> DataFrame:
    """The rows of ``docs`` with personal data replaced in ``text`` (and n_chars brought up to date, if there).

    Rows without personal data, null texts too, stay as they are.
    """
    found = spans_of(docs, **thresholds).where("spans <> ''").select("doc_id", TEXT_HASH, "spans").distinct()
    found = written(found, "private")
    other = found.select(F.col("doc_id").alias("__other"), F.col(TEXT_HASH).alias("__other_hash"), F.col("spans").alias("__spans"))
    keyed = docs.withColumn(TEXT_HASH, text_hash()).withColumn("__id", F.col("doc_id").cast("bigint"))
    same = F.col("__id").eqNullSafe(F.col("__other")) & (F.col(TEXT_HASH) == F.col("__other_hash"))
    other = narrow(other)

    place = docs.columns.index("text")

    def replaced(batches):
        for batch in batches:
            texts, spans = batch.column(place), batch.column(len(docs_columns))
            own = pa.array([rewritten(t.as_py(), s.as_py()) for t, s in zip(texts, spans)], texts.type)
            columns = [own if i == place else batch.column(i) for i in range(len(docs_columns))]
            yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = list(docs.columns)
    # only rows with something to replace go through Python
    changed = keyed.join(other, same).select(*docs_columns, "__spans").mapInArrow(tidy(replaced), docs.schema)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return keyed.join(other, same, "left_anti").select(*docs.columns).union(changed.select(*docs.columns))

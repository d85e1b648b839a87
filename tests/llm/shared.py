"""Small tables with every awkward case, and plain-Python versions of words and sets."""

from __future__ import annotations

import random
import re
import zlib

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYLLABLES = "lo rem ip sum do lor sit a met con sec te tur".split(" ")
LOW = str.maketrans(UPPER, UPPER.lower())
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that operators might use inside
    "node bigint, v bigint, n bigint, key string, row bigint, hash bigint, slice int, place int, score double, part int, words string"
)


def words(text: str | None) -> list[str]:
    return [w for w in re.split(r"[ \t-\r]+", (text or "").translate(LOW)) if w]


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def runs(sequence: list[str], width: int) -> set[tuple[str, ...]]:
    if not sequence:
        return set()
    return {tuple(sequence[i : i + width]) for i in range(max(1, len(sequence) - width + 1))}


def crc(doc_id: int, modulo: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulo == 0


def prose(seed: int, count: int) -> str:
    random.seed(seed)
    return " ".join(random.choice(SYLLABLES) + str(random.randrange(40)) for _ in range(count))


def edited(text: str, every: int, mark: str) -> str:
    return " ".join(f"{mark}{i}" if i % every == 0 else w for i, w in enumerate(text.split(" ")))


def document_rows() -> list[tuple]:
    base = prose(1, 120)
    texts = [
        (1, base),
        (2, base.upper()),
        (3, edited(base, 60, "x")),
        (4, edited(edited(base, 60, "x"), 50, "y")),
        (5, edited(base, 3, "z")),
        (6, None),
        (7, ""),
        (8, " \n\t "),
        (9, "one"),
        (10, "one"),
        (11, "One two"),
        (12, prose(2, 30_000)),
        (13, "é über 中文 \U0001f600 naïve café"),
        (14, "12 34 !!"),
        (15, prose(3, 40)),
        (15, prose(3, 40)),
        (16, prose(4, 40) + "\n" + prose(5, 40)),
        (17, "Ab cd \x1cef gh don't <|endoftext|> x\x85y"),
        (None, prose(6, 20)),
        (None, None),
    ]
    return [(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    return spark.createDataFrame([(*r, 1, 2, 3, "k", 4, 5, 6, 7, 0.5, 8, "w") for r in rows], SCHEMA)


def by_row(rows, *names):
    """Results as a sorted list of tuples, nulls as text, so repeated rows and null ids compare."""
    return sorted(tuple(r[n] for n in names) for r in rows) if None not in {r[n] for r in rows for n in names} else sorted(
        (tuple(r[n] for n in names) for r in rows), key=repr
    )

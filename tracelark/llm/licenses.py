"""Licence scan with Spark expressions only: a positional index of rare template words.

Templates are phrases (every word must stand in its place) and sentences (most
words must).  The corpus tells how rare each template word is; the rarest words
of a template are its index words.  In a file the places of index words are
looked up, the postings of a template's index words are intersected by relative
position (place in the file minus place in the template), and what remains is
verified word by word, with the mandatory phrases of sentences.  A sentence has
two more indexed places than words that may differ, so at least two of them agree
in every file it is to be found in, whichever words those are.  Words put in or
left out move what follows, so places of a sentence agree within a drift of ``DRIFT``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: A sentence is recognised when this share of its words stands in place.
SENTENCE_SHARE = 0.7
#: How far words of a sentence may have moved by words put in or left out.
DRIFT = 2


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    #: Phrases a sentence must hold in full; a template without any is a phrase itself.
    mandatory: tuple[str, ...] = ()

    @property
    def words(self) -> list[str]:
        return self.text.split()


# Labels and phrases the queries ask for.
BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
TEMPLATES = (
    *BASE,
    Template("agpl", "affero general public license"),
    Template("apache", "apache license"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("agpl-3", "agpl 3 0"),
    Template("apache-2.0", "apache 2 0"),
    Template("boost", "boost software license"),
    Template("boost", "bsl 1 0"),
    Template("bsd", "bsd license"),
    Template("bsd-2-clause", "bsd 2 clause"),
    Template("bsd-3-clause", "bsd 3 clause"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0"),
    Template("creative-commons", "creative commons attribution"),
    Template("epl", "eclipse public license"),
    Template("epl", "epl 2 0"),
    Template("gpl-2", "general public license version 2"),
    Template("gpl-3", "general public license version 3"),
    Template("gpl-2", "gpl 2 0"),
    Template("gpl-3", "gpl 3 0"),
    Template("isc", "isc license"),
    Template("isc", "license identifier isc"),
    Template("lgpl", "lesser general public license"),
    Template("lgpl-2.1", "lgpl 2 1"),
    Template("lgpl-3", "lgpl 3 0"),
    Template("mit", "mit license"),
    Template("mit", "license identifier mit"),
    Template("mpl", "mozilla public license"),
    Template("mpl", "mpl 2 0"),
    Template("public-domain", "released into the public domain"),
    Template("unlicense", "license identifier unlicense"),
    Template("zlib", "zlib license"),
    Template("zlib", "license identifier zlib"),
    Template(
        "apache",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        mandatory=("apache license",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        mandatory=("binary forms",),
    ),
    Template(
        "boost",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
        mandatory=("hereby granted", "accompanying documentation"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        mandatory=("general public license", "free software foundation"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        mandatory=("without fee", "all copies"),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files",
        mandatory=("hereby granted", "this software"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        mandatory=("unencumbered software",),
    ),
    Template(
        "zlib",
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter "
        "it and redistribute it freely subject to the following restrictions",
        mandatory=("commercial applications",),
    ),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str = "text") -> Column:
    """Runs of letters and digits with A-Z lowered; a null text has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower()), F.lit(_WORD), F.lit(0))


def rarity(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, int]:
    """In how many rows each template word stands: one number for each word of the fixed templates."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_intersect(F.array(*map(F.lit, vocabulary)), words_of())).alias("word"))
    found = {r.word: r["count"] for r in held.groupBy("word").count().collect()}
    return {word: found.get(word, 0) for word in vocabulary}


def _index_places(template: Template, frequency: dict[str, int]) -> list[tuple[str, int]]:
    """The places of a sentence with the rarest words, two more than the words that may differ."""
    count = len(template.words)
    differ = max(d for d in range(count + 1) if (count - d) / count >= SENTENCE_SHARE)
    order = sorted(range(count), key=lambda i: (frequency[template.words[i]], template.words[i], i))
    return [(template.words[i], i) for i in order[: differ + 2]]


def _index_words(template: Template, frequency: dict[str, int], most: int) -> list[tuple[str, int]]:
    """The rarest words of a template (highest inverse document frequency) with their places; one place for each."""
    places: dict[str, int] = {}
    for i, word in enumerate(template.words):
        places.setdefault(word, i)
    return sorted(places.items(), key=lambda x: (frequency[x[0]], x[0]))[:most]


def scanned(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, frequency: dict[str, int] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    score is the largest share of a recognised template's words in place (within
    ``DRIFT`` places for sentences): 1 for phrases, 0 if nothing is recognised.  first_word and last_word are null
    without a base phrase.  Null and empty texts have no words; repeated rows
    have equal results; other columns are left.
    """
    if frequency is None:
        frequency = rarity(docs, templates)
    index = {t: _index_places(t, frequency) if t.mandatory else _index_words(t, frequency, 2) for t in templates}
    looked_up = sorted({word for own in index.values() for word, _ in own})
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words_of().alias("words"))
    hit = F.transform("words", lambda w, i: F.when(w.isin(looked_up), F.struct(w.alias("word"), i.alias("place"))))
    rows = rows.withColumn("hits", F.filter(hit, lambda x: x.isNotNull()))

    def origins(word: str, at: int) -> Column:
        """Where the template would begin for each place of the word."""
        own = F.filter("hits", lambda x: x["word"] == word)
        return F.filter(F.transform(own, lambda x: x["place"] - F.lit(at)), lambda o: o >= 0)

    sentences = [t for t in templates if t.mandatory]
    # sorted origins, so that equal ones stand side by side
    rows = rows.select("*", *[F.array_sort(F.flatten(F.array(*[origins(*x) for x in index[t]]))).alias(f"o{i}") for i, t in enumerate(sentences)])

    def places(template: Template) -> Column:
        words = F.array(*map(F.lit, template.words))
        if not template.mandatory:
            postings = [origins(word, at) for word, at in index[template]]
            both = F.array_intersect(postings[0], postings[1]) if len(postings) > 1 else F.array_distinct(postings[0])
            found = F.filter(both, lambda o: F.slice("words", o + 1, len(template.words)) == words)
            return F.transform(found, lambda o: F.struct(o.alias("at"), F.lit(1.0).alias("share")))
        every = f"o{sentences.index(template)}"
        either = F.array_distinct(F.filter(every, lambda o, i: F.coalesce(F.get(every, i + 1) <= o + DRIFT, F.lit(len(index[template]) < 2))))

        def share(o: Column) -> Column:
            near = [F.slice("words", F.greatest(o + (i - DRIFT), F.lit(0)) + 1, 2 * DRIFT + 1) for i in range(len(template.words))]
            same = [F.array_contains(place, w).cast("int") for place, w in zip(near, template.words)]
            return sum(same[1:], same[0]) / len(same)

        def complete(o: Column) -> Column:
            around = F.slice("words", F.greatest(o - DRIFT, F.lit(0)) + 1, len(template.words) + 4 + DRIFT)
            window = F.concat(F.lit(" "), F.array_join(around, " "), F.lit(" "))
            out = F.lit(True)
            for phrase in template.mandatory:
                out = out & F.contains(window, F.lit(f" {phrase} "))
            return out

        # the phrases first: few candidates hold them, and only those are gone through word by word
        rated = F.transform(either, lambda o: F.struct(o.alias("at"), F.when(complete(o), share(o)).otherwise(0.0).alias("share")))
        return F.filter(rated, lambda x: x["share"] >= SENTENCE_SHARE)

    found = rows.select(
        "doc_id", F.size("words").cast("bigint").alias("n_words"), *[places(t).alias(f"t{i}") for i, t in enumerate(templates)]
    )
    base = [i for i, t in enumerate(templates) if t.base]
    base_places = F.flatten(F.array(*[F.col(f"t{i}") for i in base]))
    every = F.flatten(F.array(*[F.col(f"t{i}") for i in range(len(templates))]))

    def named(chosen: list[int]) -> Column:
        names = F.array(*[F.when(F.size(f"t{i}") > 0, F.lit(templates[i].label)) for i in chosen])
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(names))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base_places).cast("bigint").alias("n_base"),
        F.array_min(F.transform(base_places, lambda x: x["at"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform(base_places, lambda x: x["at"])).cast("bigint").alias("last_word"),
        named(base).alias("base_labels"),
        named(list(range(len(templates)))).alias("labels"),
        F.coalesce(F.array_max(F.transform(every, lambda x: x["share"])), F.lit(0.0)).alias("score"),
    )
